"""Joins from facts to dimensions.

Plain equi-joins: Catalyst and AQE broadcast a side only when its measured size is below
spark.sql.autoBroadcastJoinThreshold, and AQE splits a skewed shuffle partition otherwise.
`split_hot_lookup` is for joins AQE cannot split (a later operator needs the key's partitioning, or
the hot key is known to hold a large share).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    return fact.join(dim, on, how)


def split_hot_lookup(fact: DataFrame, dim: DataFrame, on: str, how: str = "inner",
                     share: float = 0.001) -> DataFrame:
    """Exact lookup of a unique-key dimension that never shuffles the hot keys of the fact.

    A key is hot when it holds more than `share` of the fact's rows, so there are fewer than
    1/share hot keys. Their dimension rows are broadcast (that bound holds for any data) and their
    fact rows stay where they are; all other rows take the ordinary join.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left only")
    if not 0.0001 <= share < 1:
        raise ValueError("share must be at least 0.0001, which bounds the hot keys to 10,000, and below 1")
    counts = fact.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg((F.sum("n") * F.lit(share)).alias("limit")).scalar()
    hot = counts.filter((F.col("n") > limit) & F.col(on).isNotNull()).select(on)
    hot_dim = dim.join(F.broadcast(hot), on, "left_semi")
    hot_part = fact.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(hot_dim), on, how)
    cold_part = fact.join(F.broadcast(hot), on, "left_anti").join(dim, on, how)
    return hot_part.unionByName(cold_part)


def previous_period(events: DataFrame, snapshots: DataFrame, key: str, date_key: str,
                    previous_key: str, columns: Sequence[str], prefix: str = "Old") -> DataFrame:
    """Each event with the same entity's snapshot of the exactly preceding period.

    An equi-join on (key, period), so an entity with a missing month finds nothing, where a lag
    would wrongly reach further back.
    """
    old = snapshots.select(F.col(key), F.col(date_key).alias(previous_key),
                           *[F.col(c).alias(prefix + c) for c in columns])
    return events.join(old, [key, previous_key])
