"""Integer surrogate keys and keyed upsert without MERGE."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BUCKET, _OFFSET = "__bucket", "__offset"


def _bucket(key: Column, hex_chars: int) -> Column:
    return F.left(F.md5(key.cast("string").cast("binary")), F.lit(hex_chars))


def _repeats(key: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string")))


def number_rows(df: DataFrame, key: str, out: str, start: Column | int = 0, hex_chars: int = 3, unique: bool = False) -> DataFrame:
    """Dense numbers start+1, start+2, ... over unique keys, without a global sort.

    Rows without a key are left out. Keys go to 16**hex_chars even buckets by the head of their MD5. Rows are ranked inside a bucket,
    and the buckets' running sizes (at most 16**hex_chars rows) are added. Nothing depends on how
    the input happens to be partitioned, so a recomputed task gives the same numbers again.
    With `unique` a key that stands twice fails the job: equal keys lie next to each other in their bucket's order.
    """
    if not 1 <= hex_chars <= 4:
        raise ValueError("hex_chars must be 1 to 4, which bounds the buckets to 65,536")
    start = F.lit(start) if isinstance(start, int) else start
    tagged = df.where(F.col(key).isNotNull()).withColumn(_BUCKET, _bucket(F.col(key), hex_chars))
    sizes = tagged.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BUCKET, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    in_bucket = Window.partitionBy(_BUCKET).orderBy(key)
    rank = F.row_number().over(in_bucket)
    if unique:
        rank = F.when(F.lag(key).over(in_bucket) == F.col(key), _repeats(key).cast("int")).otherwise(rank)
    # the offsets have at most 16**hex_chars rows, a size fixed by the parameter
    numbered = tagged.withColumn("__rank", rank).join(F.broadcast(offsets), _BUCKET)
    return numbered.withColumn(out, (start + F.col(_OFFSET) + F.col("__rank")).cast("bigint")).drop(
        _BUCKET, _OFFSET, "__rank")


def assign_keys(source: DataFrame, business_key: str, surrogate: str,
                existing: DataFrame | None = None) -> DataFrame:
    """source with its integer key: known business keys keep theirs, new ones get the next numbers.

    `source` must hold each business key once; rows without a key are refused (left out).
    """
    source = source.where(F.col(business_key).isNotNull())
    if existing is None:
        return number_rows(source, business_key, surrogate)
    top = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).scalar()
    met = source.join(existing.select(business_key, surrogate), business_key, "left")
    fresh = met.where(F.col(surrogate).isNull()).drop(surrogate)  # only unknown keys are ranked
    return met.where(F.col(surrogate).isNotNull()).unionByName(number_rows(fresh, business_key, surrogate, start=top))


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, unmatched source rows are added, nothing is deleted.

    Source rows that lack a key are refused: they would match nothing and be added at every load.
    """
    source = source.dropna(subset=list(keys))
    if target is None:
        return source
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def upsert_dimension(existing: DataFrame | None, source: DataFrame, business_key: str,
                     surrogate: str) -> DataFrame:
    """Type 1 dimension load: attributes overwritten, integer keys stable, one row per business key.

    A business key that stands for several rows fails the job that reads the result. The check takes part in the
    ranking of a first load, and in the shuffle by key that the join with the known keys needs in any other.
    """
    if existing is None:
        keyed = number_rows(source, business_key, surrogate, unique=True)
    else:
        per_key = F.count(F.lit(1)).over(Window.partitionBy(business_key))
        once = source.where(F.col(business_key).isNotNull()).withColumn("__rows", per_key)
        once = once.where(F.when(F.col("__rows") > 1, _repeats(business_key).cast("boolean")).otherwise(F.lit(True))).drop("__rows")
        keyed = assign_keys(once, business_key, surrogate, existing)
    columns = [surrogate, business_key, *[c for c in source.columns if c != business_key]]
    keyed = keyed.select(*columns)
    return keyed if existing is None else upsert(existing.select(*columns), keyed, [business_key])
