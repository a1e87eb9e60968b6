"""Mix sources to target weights: rates from token totals, whole copies plus one hash-seeded Bernoulli copy.

Sizes are words of the text. A source's target is its share, by weight, of `total_share` times all words,
but at most `max_rate` times its own words; what is cut off is shared again by weight. A document is emitted
floor(rate) times, and once more if the hash of its id lies below the rate's fraction.

Defined cases: null and blank texts have size 0 and are emitted like others (they take 0 words); a null source
is a source of its own, ranked last; a source without words has rate 0; an empty table gives an empty mix; rows
repeated with one id decide alike; other columns pass through untouched.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, saved, table

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_RATE = 2.0
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame, *order: Column) -> DataFrame:
    """Add `rank` (from 0) in the given order without sorting everything in one task.

    Rows are range-partitioned and counted per partition; only the counts meet in one place.
    """
    at = sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    at = saved(at.withColumn("_part", F.shiftright("_at", 33)), "ranks")
    counts = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    in_part = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return at.join(before, "_part").withColumn("rank", in_part + F.col("_before")).drop("_at", "_part", "_n", "_before")


def targets(sources: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_rate: float = MAX_RATE) -> DataFrame:
    """source, source_size, weight, target of each row of (source, source_size); the weights repeat in code point order.

    Sharing again until no target is above its cap ends at min(cap, level * weight): each pass raises the level
    by what the capped sources leave. Passes read sums over the sources only, and end when no source is newly capped.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = numbered(sources, F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = saved(ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_rate)), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        n, cap, weight_left = ranked.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or weight_left == 0:
            break
        capped, level = n, (total_share * total - cap) / weight_left
    return ranked.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(level))).select("source", "source_size", "weight", "target")


def unit_hash(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the MD5 of seed and key; a null key counts as the empty text."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_copies(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: str = SEED, **rules) -> DataFrame:
    """`docs` with _size, _source_size, _target, _rate and _copies."""
    sized = docs.withColumn("_size", word_count(F.col(text)))
    sources = saved(sized.groupBy(F.col(source).alias("source")).agg(F.sum("_size").alias("source_size")), "sources")
    plan = targets(sources, **rules).select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    # The sources are few rows beside the documents; whether they are broadcast is left to Spark's size check,
    # and a hot source is split by AQE where they are not.
    out = sized.join(plan, sized[source].eqNullSafe(plan["_source"]), "left").drop("_source")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    out = out.withColumn("_rate", rate)
    extra = (unit_hash(F.col(key), seed) < F.col("_rate") - F.floor("_rate")).cast("long")
    return out.withColumn("_copies", F.floor("_rate") + extra)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: each row of `docs` as often as its copies say, with the columns of `docs`.

    The row travels as one struct, so that no column of `docs` meets a helper column of the same name.
    """
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(a) for c, a in at.items()]).alias("row"))
    planned = with_copies(packed, f"row.{at[text]}", f"row.{at[source]}", f"row.{at[key]}", **options).where(F.col("_copies") > 0)
    repeated = planned.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    return repeated.select(*[F.col(f"row.{a}").alias(c) for c, a in at.items()])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    planned = with_copies(docs)
    return planned.select(
        "doc_id", "source", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"),
    )


#: Closed form of the same rule: with sources in the order of cap / weight, the level is the first one that the
#: next cap is not below.
OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sources),
running AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER after AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
final AS (SELECT arg_min(level, cap / weight) AS level FROM running WHERE level <= cap / weight),
targets AS (SELECT source, source_size, least(cap, weight * level) AS target FROM weighted, final),
rated AS (
  SELECT doc_id, s.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copied AS (
  SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rated)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM copied
"""
