"""Writing warehouse tables as plain Parquet.

A table is a folder. Tables replaced as a whole live in numbered sub-folders; readers take the
highest one that carries Spark's _SUCCESS marker, so a job that dies half way, or a table rebuilt
from itself, never shows partial data. Period facts (by DateKey) and merged tables (by hash bucket
of their key) have versions with manifests (`versions`): only the partitions that change are written,
and each change becomes visible as a whole.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.keys import upsert
from . import versions
from .landing import path_exists

#: Partition column of merged tables, which readers do not see, and how many there are unless a table says otherwise.
BUCKET, BUCKETS = "key_bucket", 64


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of a folder."""
    fs, p, _ = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[2:]) for n in children(spark, path) if n.startswith("v=") and n[2:].isdigit()
                  and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def current_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders with the table's current files; none if it was never written."""
    found = versions.snapshot(spark, path)
    if found is not None:
        return sorted(f"{path}/{versions.DATA}/{f}" for folders in found.parts.values() for f in folders)
    whole = _versions(spark, path)
    return [f"{path}/v={whole[-1]}"] if whole else []


def read_table(spark: SparkSession, path: str, found: versions.Snapshot | None = None, parts=None) -> DataFrame | None:
    """Current content, or that of a pinned version or some of its partitions; None when the table was never written."""
    found = versions.snapshot(spark, path) if found is None else found
    if found is not None:
        rows = versions.read(spark, path, found, parts)
        return rows.drop(BUCKET) if "buckets" in found.settings else rows
    whole = current_folders(spark, path)
    return spark.read.parquet(whole[0]) if whole else None


def full_reload(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Replace the whole table; the query may read the table itself."""
    spark = df.sparkSession
    base = versions.snapshot(spark, path)
    if base is not None:
        rows = df.withColumn(BUCKET, bucket_of(base.settings["keys"], base.settings["buckets"])) if "buckets" in base.settings else df
        return read_table(spark, path, versions.commit(rows, path, base.key, None, base))
    whole = _versions(spark, path)
    new = (whole[-1] if whole else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={new}")
    fs, _, jvm = _fs(spark, path)
    for old in whole[: max(0, len(whole) + 1 - keep)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/v={old}"), True)
    return spark.read.parquet(f"{path}/v={new}")


def store(df: DataFrame, path: str) -> DataFrame:
    """`df` computed now, written and read back; what its job shuffled is deleted when the job ends.

    A plan over many facts holds the shuffled rows of all of them until it is done. Stored part by part it holds those of one.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return full_reload(df, path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def stage(df: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Truncate and insert into staging, columns matched by name."""
    return full_reload(df.select(*columns), path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(f"{path}/v=1")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge(source: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> versions.Snapshot:
    """Rows of `source` replace those of their keys or are added; only buckets in which something changes are written.

    Rows that equal what the table holds change nothing, so a delivery that comes again leaves every file as it is.
    The number of buckets is the table's own from its first merge on; each merge reads the buckets of its keys.
    Rows that lack a key are refused. A key must stand once in `source`.
    """
    spark, keys = source.sparkSession, list(keys)
    base = versions.snapshot(spark, path)
    settings = base.settings if base else {"buckets": buckets, "keys": keys}
    if settings["keys"] != keys:
        raise ValueError(f"{path} is stored by {settings['keys']}, not by {keys}")
    bucket = bucket_of(keys, settings["buckets"])
    rows = source.dropna(subset=keys).withColumn(BUCKET, bucket)
    if base is None:
        before = read_table(spark, path)  # a table that was written as a whole until now
        first = rows if before is None else upsert(before.withColumn(BUCKET, bucket), rows, keys)
        return versions.commit(first, path, BUCKET, None, settings=settings)
    arrived = versions.write_folder(rows, path, BUCKET)  # computed once; its folder names are the buckets to read
    try:
        new = versions.read(spark, path, versions.Snapshot(0, BUCKET, rows.schema.json(), arrived))
        held = versions.read(spark, path, base, arrived)
        others = [c for c in held.columns if c not in (*keys, BUCKET)]
        now, was = F.struct(*others) if others else F.lit(0), F.col("__was")
        known = held.select(*keys, BUCKET, now.alias("__was"))
        changed = new.join(known, [*keys, BUCKET], "left").where(was.isNull() | ~now.eqNullSafe(was)).select(*held.columns)
        moved = versions.write_folder(changed, path, BUCKET)
        try:
            touched = versions.Snapshot(0, BUCKET, base.schema, moved)
            after = upsert(versions.read(spark, path, base, moved), versions.read(spark, path, touched), [*keys, BUCKET])
            return versions.commit(after, path, BUCKET, moved, base) if moved else base
        finally:
            versions.drop_folders(spark, path, moved)
    finally:
        versions.drop_folders(spark, path, arrived)


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    return read_table(spark, path, merge(source, path, keys))


def replace_periods(df: DataFrame, path: str, key: str = "DateKey") -> versions.Snapshot:
    """Each period in the input replaces that period of the table; other periods stay."""
    return versions.commit(df, path, key)


def replace_parts(df: DataFrame, path: str, key: str, touched: Sequence) -> versions.Snapshot:
    """The touched keys get the rows of `df`; those without rows there disappear."""
    return versions.commit(df, path, key, touched)


def replace_range(df: DataFrame, path: str, low: int, high: int, key: str = "DateKey") -> versions.Snapshot:
    """Every key between low and high is replaced; keys without new rows disappear. Both are one change."""
    base = versions.snapshot(df.sparkSession, path)
    inside = [v for v in (base.parts if base else ()) if low <= int(v) <= high]
    return versions.commit(df, path, key, inside, base)


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Drop and select-into."""
    return full_reload(df, path)
