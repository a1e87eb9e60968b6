"""The pipeline against its stages done by brute force on a small corpus."""
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import mixing, toxicity

from .test_mixing import water_fill
from .test_near_dup import brute as near_dup_brute
from .test_phrase_index import brute as phrase_brute
from .test_toxicity import corpus

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture_rows():
    rng = random.Random(8)
    rows, labels = corpus(300, seed=8)
    vocabulary = sorted({w for _, t in rows for w in t.split()})
    item = " ".join(rng.choice(vocabulary) for _ in range(14))
    out = []
    for k, text in rows:
        if k % 11 == 3:
            text = rows[(k + 11) % 300][1]  # an exact copy
        elif k % 11 == 5:
            text = rows[(k + 1) % 300][1] + " " + rng.choice(vocabulary)  # a near copy
        elif k % 11 == 7:
            text = " ".join(rng.choice(vocabulary) for _ in range(30)) + " " + item + " and more"
        out.append((k, text))
    out += [(400, None), (401, ""), (402, "one two"), (403, "one two")]
    return out, labels, [(1, item), (2, "no such words at all here")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = fixture_rows()
    base = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_rows_equal_the_stages_by_brute_force(spark, folder):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    left = {i: r["text"] for i, r in docs.items() if model.score(r["text"] or "") < 0.5}
    assert 0 < len(left) < len(docs)
    left = {i: left[i] for i in {c for _, c, _ in near_dup_brute(sorted(left.items()))}}
    left = {i: left[i] for i, *_, hit in phrase_brute(sorted(left.items()), items) if not hit}
    sizes = {i: len((t or "").split()) for i, t in left.items()}
    sources = sorted({docs[i]["source"] for i in left}, key=lambda s: (s is None, (s or "").encode()))
    totals = [sum(n for i, n in sizes.items() if docs[i]["source"] == s) for s in sources]
    targets = water_fill(totals, [mixing.WEIGHTS[k % 3] for k in range(len(sources))])
    rate = {s: t / n if n else 0.0 for s, t, n in zip(sources, targets, totals)}
    units = {r["doc_id"]: r["u"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", mixing.unit_hash(mixing.F.col("doc_id")).alias("u")).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for i in sorted(left):
        r = rate[docs[i]["source"]]
        for _ in range(int(r) + (units[i] < r - int(r))):
            ids = tokenizer.encode(left[i] or "", add_special_tokens=False).ids + [1]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=lambda r: r[1])
    assert got == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontamination", "mixing", "token_records"]
    assert corpus_pipeline.ORACLE_SQL is None and Counter(len(s) for s in corpus_pipeline.STAGES) == {2: 5}
