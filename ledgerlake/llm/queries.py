"""The registered queries of this subpackage and their SQL."""
from __future__ import annotations

from . import context_tree, language, mixing, near_dup, neighbours, phrase_index, runs, sharding, substring_dedup, token_records, toxicity, url_lists, whitening

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_token_records": token_records.op2_token_records,
    "op3_context_tree": context_tree.op3_context_tree,
    "op4_phrase_index": phrase_index.op4_phrase_index,
    "op5_near_dup": near_dup.op5_near_dup,
    "op6_language": language.op6_language,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_url_lists": url_lists.op8_url_lists,
    "op9_mixing": mixing.op9_mixing,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_sharding": sharding.op11_sharding,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op4_phrase_index": phrase_index.OP4_SQL,
    "op8_url_lists": url_lists.OP8_SQL,
    "op9_mixing": mixing.OP9_SQL,
}
