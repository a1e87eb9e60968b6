"""Group-level operators: argmax, shares, top categories, stacking of aggregates, year ends."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def most_frequent(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """The most frequent non-null value per key; equal counts go to the smallest value.

    Two partial aggregations: the shuffle carries counts, never the rows of a group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.alias("b")).select(key, F.col("b.v").alias(out or value))


def share_of_total(df: DataFrame, within: Sequence[str], value: str, out: str) -> DataFrame:
    """value / sum of value in its group; for aggregated rows (a report axis)."""
    total = F.sum(value).over(Window.partitionBy(*within))
    return df.withColumn(out, F.try_divide(F.col(value).cast("double"), total.cast("double")))


def top_categories(df: DataFrame, category: str, by: Column, n: int) -> DataFrame:
    """Rows whose category is among the n largest by an aggregate; ties by category name."""
    top = df.groupBy(category).agg(by.alias("__by")).orderBy(F.desc("__by"), category).limit(n)
    return df.join(top.select(category), category, "left_semi")


def stack_aggregates(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """UNION ALL of aggregates of different shape, absent measures as zero, summed again by key."""
    measures: dict[str, str] = {}
    for part in parts:
        for f in part.schema.fields:
            if f.name not in keys:
                measures.setdefault(f.name, f.dataType.simpleString())
    padded = [
        p.select(*keys, *[(F.col(m) if m in p.columns else F.lit(0)).cast(t).alias(m) for m, t in measures.items()])
        for p in parts
    ]
    union = padded[0]
    for p in padded[1:]:
        union = union.unionByName(p)
    return union.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def last_of_each(df: DataFrame, group: Column, period: str) -> DataFrame:
    """Rows at the last period of their group; for aggregated rows (month totals of a year)."""
    last = F.max(period).over(Window.partitionBy(group))
    return df.withColumn("__last", last).filter(F.col("__last") == F.col(period)).drop("__last")


def pivot_sum(df: DataFrame, rows: Sequence[str], columns: str, values: Sequence, measure: str) -> DataFrame:
    """Named pivot; giving the values saves a pass over the data. `Other` sums what is under none of them."""
    known = F.coalesce(F.col(columns).isin(list(values)), F.lit(False))
    named = [F.sum(F.when(F.col(columns) == v, F.col(measure))).alias(str(v)) for v in values]
    return df.groupBy(*rows).agg(*named, F.sum(F.when(~known, F.col(measure))).alias("Other"))


def unpivot_steps(df: DataFrame, keys: Sequence[str], steps: Sequence[tuple[int, str, str]],
                  value: str = "value") -> DataFrame:
    """Columns to rows: each (order, label, column) becomes a row."""
    rows = F.array(*[F.struct(F.lit(o).alias("step_order"), F.lit(label).alias("step"),
                              F.col(c).cast("double").alias(value)) for o, label, c in steps])
    return df.select(*keys, F.explode(rows).alias("s")).select(*keys, "s.*")
