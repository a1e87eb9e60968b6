"""Time-series operators: spines, filling, interpolation, trailing windows, cumulative counts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.dates import _col


def day_spine(spark: SparkSession, start, end, name: str = "Date") -> DataFrame:
    """One row per day from start to end (dates or date columns without row context)."""
    start = start if isinstance(start, Column) else F.lit(start).cast("date")
    end = end if isinstance(end, Column) else F.lit(end).cast("date")
    return spark.range(1).select(F.explode(F.sequence(start, end)).alias(name))


def month_end_spine(spark: SparkSession, start, end, name: str = "Date") -> DataFrame:
    """Month ends from the month of start to the month of end."""
    start = start if isinstance(start, Column) else F.lit(start).cast("date")
    end = end if isinstance(end, Column) else F.lit(end).cast("date")
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(F.transform(months, F.last_day)).alias(name))


def _by(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def forward_fill(df: DataFrame, order: str, value: str, keys: Sequence[str] = (),
                 leading: str = "first") -> DataFrame:
    """Nulls take the last known value; those before the first one take that first value.

    Without `keys` the series is one calendar (its length is a number of days). For a series per
    entity pass the entity columns.
    """
    w = _by(keys, order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.last(value, ignorenulls=True).over(back)
    if leading == "first":
        ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        filled = F.coalesce(filled, F.first(value, ignorenulls=True).over(ahead))
    return df.withColumn(value, filled)


def interpolate_linear(df: DataFrame, x: str, value: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Piecewise-linear values between known points; flat beyond the first and the last."""
    w = _by(keys, x)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known_x = F.when(F.col(value).isNotNull(), F.col(x))
    x0, y0 = F.last(known_x, True).over(back), F.last(value, True).over(back)
    x1, y1 = F.first(known_x, True).over(ahead), F.first(value, True).over(ahead)
    slope = (y1 - y0) / F.nullif(x1 - x0, F.lit(0))
    inside = F.coalesce(y0 + slope * (F.col(x) - x0), y0)
    return df.withColumn(out, F.coalesce(F.when(y1.isNull(), y0), F.when(y0.isNull(), y1), inside))


def trailing_mean(df: DataFrame, order: str, value: str, out: str, periods: int,
                  keys: Sequence[str] = (), pad: float | None = None) -> DataFrame:
    """Mean of the last `periods` values incl. the current one.

    With `pad`, the history before the first row counts as that constant.
    """
    w = _by(keys, order).rowsBetween(-(periods - 1), Window.currentRow)
    if pad is None:
        return df.withColumn(out, F.avg(value).over(w))
    seen = F.count(F.lit(1)).over(w)
    return df.withColumn(out, (F.sum(value).over(w) + (F.lit(periods) - seen) * F.lit(pad)) / F.lit(periods))


def lead_clamped(df: DataFrame, order: str, value: str, out: str, periods: int,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Value `periods` rows ahead, the last value where the series ends before."""
    w = _by(keys, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(out, F.coalesce(F.lead(value, periods).over(w), F.last(value).over(whole)))


def average_balance(df: DataFrame, key: str, month: str, balance: str, out: str = "avg_balance",
                    first_share: float = 0.6) -> DataFrame:
    """Mean of this and the previous end balance; the first month takes a share as its previous one."""
    w = Window.partitionBy(key).orderBy(month)
    previous = F.lag(balance).over(w)
    previous = F.when(previous > 0, previous).otherwise(F.col(balance) * first_share)
    return df.withColumn(out, (previous + F.col(balance)) / 2)


def spread_month_to_days(monthly: DataFrame, days: DataFrame, month: str, date: str, total: str,
                         weight: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Monthly totals over the month's days: total x weight / mean weight / number of days."""
    per_month = days.groupBy(month).agg(F.avg(weight).alias("__mean"), F.count(F.lit(1)).alias("__days"))
    weighted = days.join(per_month, month)
    value = F.col(total) * F.col(weight) / F.nullif(F.col("__mean"), F.lit(0.0)) / F.col("__days")
    return monthly.join(weighted, month).select(*keys, month, date, value.alias(out))


def active_over_time(events: DataFrame, spine: DataFrame, groups: Sequence[str], date: str,
                     delta: str, out: str) -> DataFrame:
    """Running number of active members per group on every spine date.

    `events` holds +1/-1 changes already summed per (group, date). The window sees one row per
    group and date, never the members themselves.
    """
    dates = spine.agg(F.collect_set(date).alias("d")).scalar()  # the calendar, not the data
    grid = events.select(*groups).distinct().withColumn(date, F.explode(dates))
    joined = grid.join(events, [*groups, date], "left")
    w = Window.partitionBy(*groups).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(out, F.sum(F.coalesce(F.col(delta), F.lit(0))).over(w).cast("bigint"))
