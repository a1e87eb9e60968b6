import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def docs_of(spark: SparkSession):
    """documents from (doc_id, text) pairs, with columns whose names the operators might use themselves."""
    def make(rows, lang=None):
        data = [(i, t, (lang or {}).get(i, "en"), f"src{(i or 0) % 3}", len(t or ""), "x", 1.5, "y", [1]) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string, key double, t string, bands array<int>")
    return make


AWKWARD = [(None, "one two three"), (1, None), (2, ""), (3, "   \n"), (4, "x"), (4, "x"), (5, "word " * 30_000), (6, "ÄÖ ß é 12 3.5 <|endoftext|> it's"), (7, "\x00\x01 a\x0bb\x0cc"), (None, "one two three")]


@pytest.fixture
def awkward():
    return list(AWKWARD)
