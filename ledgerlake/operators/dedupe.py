"""Keeping one row per key.

Both operators rank inside the key and keep rank 1. Spark pushes that limit below the shuffle
(WindowGroupLimit, partial then final), so each task sends at most one row per key and a key that
holds a third of all rows costs no more than any other.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def _first_per_key(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _total_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in sorted(df.columns) if c not in used]


def keep_latest(df: DataFrame, keys: Sequence[str], timestamp: str) -> DataFrame:
    """Newest row per key; ties fall to the smallest remaining columns, so the result is stable."""
    order = [F.col(timestamp).desc_nulls_last(), *_total_order(df, [*keys, timestamp])]
    return _first_per_key(df, keys, order)


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Any one row per key, always the same one: smallest by `order_by`, then by the other columns."""
    first = [F.col(c).asc_nulls_first() for c in (order_by or [])]
    return _first_per_key(df, keys, first + _total_order(df, [*keys, *(order_by or [])]))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """One row: total rows and rows that repeat an earlier one in every column."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )
