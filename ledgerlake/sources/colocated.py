"""Versioned facts whose partitions are bucketed, so that joins and sums by the bucket key need no shuffle of the fact.

A fact is shuffled once, when it is loaded; each partition's folder then holds one file per hash bucket. Spark uses
that order only of tables in its catalog, so a version is shown to it as an external table for the time it is read:
the table's partitions are the folders that the version's manifest names. Nothing is copied, and dropping the table
leaves the files.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from . import versions


def _name() -> str:
    return f"ledgerlake_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, by: str, buckets: int) -> dict[str, tuple[str, ...]]:
    """Write the rows by partition and bucket into a folder of their own; visible to nobody until a manifest names it."""
    spark, folder, name = df.sparkSession, f"w={uuid.uuid4().hex}", _name()
    # One task per bucket writes that bucket's file of every partition; a bucket key with very many rows makes one
    # long file per partition, as any bucketing does.
    writer = df.repartition(buckets, by).write.partitionBy(key).bucketBy(buckets, by).sortBy(by).format("parquet")
    writer.option("path", f"{path}/{versions.DATA}/{folder}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    made = [n for n in versions.names(spark, f"{path}/{versions.DATA}/{folder}") if n.startswith(f"{key}=")]
    return {n[len(key) + 1:]: (f"{folder}/{n}",) for n in made}


def commit_bucketed(df: DataFrame, path: str, by: str, buckets: int, key: str = "DateKey", replaced: Iterable = ()) -> versions.Snapshot:
    """A new version of a bucketed fact: the partitions of `df` and those in `replaced` are replaced, others stay."""
    spark = df.sparkSession
    base = versions.snapshot(spark, path)
    settings = {"bucketed_by": by, "files": buckets}
    if base is not None and base.settings != settings:
        raise ValueError(f"{path} is stored by {base.settings}, not by {settings}")
    written = write_bucketed(df, path, key, by, buckets)
    gone = {str(v) for v in replaced} | set(written)
    parts = {**{v: f for v, f in (base.parts if base else {}).items() if v not in gone}, **written}
    fields = [f for f in df.schema.fields if f.name != key] + [df.schema[key]]
    new = versions.publish(spark, path, versions.Snapshot((base.version if base else 0) + 1, key, StructType(fields).json(), parts, settings=settings))
    versions.expire(spark, path)
    return new


@contextmanager
def bucketed(spark: SparkSession, path: str, found: versions.Snapshot | None = None, parts: Iterable | None = None) -> Iterator[DataFrame]:
    """A version of a bucketed fact, or some of its partitions, as a table that Spark knows to be bucketed.

    Use it inside the `with`: the table is dropped from the catalog at its end.
    """
    found = versions.snapshot(spark, path) if found is None else found
    schema, name = StructType.fromJson(json.loads(found.schema)), _name()
    by, files = found.settings["bucketed_by"], found.settings["files"]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # the folder of the table itself stays empty: all partitions have folders of their own
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{found.key}`) "
              f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {files} BUCKETS LOCATION '{path}/{versions.DATA}/_none'")
    try:
        wanted = set(found.parts) if parts is None else {str(v) for v in parts} & set(found.parts)
        specs = [f"PARTITION (`{found.key}` = '{v}') LOCATION '{path}/{versions.DATA}/{found.parts[v][0]}'" for v in sorted(wanted)]
        for k in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(specs[k:k + 500]))
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def totals_by(fact: DataFrame, by: str, dim: DataFrame, attributes: list[str], keys: list[str], values: list[str]) -> DataFrame:
    """Sums of a bucketed fact by its own keys and attributes of the entity it is bucketed by.

    The fact is summed inside its buckets and meets the dimension there; what is shuffled are the sums.
    """
    inside = fact.groupBy(by, *keys).agg(*[F.sum(v).alias(v) for v in values], F.count(F.lit(1)).alias("n"))
    met = inside.join(dim.select(by, *attributes), by)
    return met.groupBy(*keys, *attributes).agg(*[F.sum(v).alias(v) for v in values], F.sum("n").alias("n"))
