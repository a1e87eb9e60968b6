"""All queries."""
from . import q_cards, q_chain, q_checks, q_files, q_load, q_marts, q_more, q_refresh  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
