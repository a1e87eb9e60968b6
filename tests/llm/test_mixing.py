import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing


def water_fill(sizes, weights, share=1.5, rate=2.0):
    """Reshare the excess by weight until no target is above its cap."""
    left, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if weights[k] * unit >= rate * sizes[k]]
        if not full:
            for k in open_:
                target[k] = weights[k] * unit
            break
        for k in full:
            target[k] = rate * sizes[k]
            left -= target[k]
            open_.discard(k)
    return target


@pytest.mark.parametrize("sizes", [[100, 10, 1000], [5, 5, 5, 5], [1], [0, 7, 900, 3, 2, 40, 0], [1000, 1, 1, 1, 1, 1]])
def test_targets_reach_the_reshared_level(spark, sizes):
    names = [chr(ord("a") + k) for k in range(len(sizes))]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()}
    want = water_fill(sizes, [[3, 1, 2][k % 3] for k in range(len(sizes))])
    assert [got[n] for n in names] == pytest.approx(want)


def test_sources_rank_by_code_point_and_null_last(spark):
    rows = spark.createDataFrame([(s, 10) for s in ("b", None, "B", "é", "a", "")], "source string, source_size long")
    got = {r["source"]: r["weight"] for r in mixing.targets(rows).collect()}
    assert got == {"": 3.0, "B": 1.0, "a": 2.0, "b": 3.0, "é": 1.0, None: 2.0}


def test_mix_is_repeatable_near_targets_and_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
                                    F.repeat(F.lit("w "), (F.col("id") % 17 + 1).cast("int")).alias("text"), F.lit(1).alias("size"))
    first, again = (sorted(map(tuple, mixing.with_copies(docs).select("doc_id", "_copies", "_rate").collect())) for _ in range(2))
    assert first == again and all(0 <= c <= 2 and abs(c - r) < 1 for _, c, r in first)
    by = mixing.with_copies(docs).groupBy("source").agg(F.sum(F.col("_copies") * F.col("_size")).alias("taken"), F.first("_target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.12 * r["target"] for r in by)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(c for _, c, _ in first)


def test_awkward_and_empty_tables(docs_of, awkward):
    docs = docs_of(awkward)
    got = mixing.with_copies(docs).select("doc_id", "_size", "_copies").collect()
    assert len(got) == len(awkward)
    assert {r["_size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix(docs_of([])).count() == 0


def test_columns_named_like_helpers_pass_through(spark, docs_of):
    docs = docs_of([(k, "w " * (k + 1)) for k in range(6)])
    want = mixing.mix(docs).count()
    for name in ("_size", "_source_size", "_target", "_rate", "_copies", "_copy", "_source", "row", "rank", "weight", "cap", "a.b"):
        got = mixing.mix(docs.withColumn(name, F.lit(777)))
        assert got.count() == want and {r[name] for r in got.select(f"`{name}`").collect()} == {777}, name
