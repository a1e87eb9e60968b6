"""Finance series over month x region x product balances: impairment, budget, cost drivers, price index."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.amounts import ratio
from ..functions.risk import regional_index
from ..operators.series import lead_clamped, trailing_mean

CELL = ["region", "product"]


def balances_by_cell(rows: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("month_end", *CELL)) -> DataFrame:
    """Metrics summed per month, region and product."""
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics])


def impairment_flow(cells: DataFrame, ecl: str = "ecl", net_write_off: str = "net_write_off",
                    first_share: float = 0.02) -> DataFrame:
    """Change of provision plus net write-off; the first month takes a share of its provision."""
    before = F.lag(ecl).over(Window.partitionBy(*CELL).orderBy("month_end"))
    moved = F.coalesce(F.col(ecl) - before, F.col(ecl) * first_share)
    return cells.withColumn("impairment", moved + F.col(net_write_off))


def budget_seed(cells: DataFrame, bias: DataFrame, months_ahead: int, growth: float = 1.002, decay: float = 0.995,
                ) -> DataFrame:
    """Budget from actuals x a yearly bias; the months after the last actual roll that month forward.

    `cells` has balance, nii, fees, impairment per month, region and product; `bias` has year and four
    factors. Impairment is smoothed over three months and never negative.
    """
    smooth = trailing_mean(cells, "month_end", "impairment", "smoothed", 3, CELL)
    last = cells.agg(F.max("month_end").alias("m")).scalar()
    steps = F.when(F.col("month_end") == last, F.sequence(F.lit(0), F.lit(months_ahead))).otherwise(F.array(F.lit(0)))
    rolled = smooth.withColumn("k", F.explode(steps)).withColumn(
        "month_end", F.last_day(F.add_months("month_end", F.col("k"))))
    priced = rolled.withColumn("year", F.year("month_end")).join(bias, "year")
    return priced.select(
        "month_end", *CELL,
        (F.col("balance") * F.col("bias_balance") * F.pow(F.lit(growth), "k")).alias("budget_balance"),
        (F.col("nii") * F.col("bias_nii") * F.pow(F.lit(decay), "k")).alias("budget_nii"),
        (F.col("fees") * F.col("bias_fees")).alias("budget_fees"),
        (F.greatest("smoothed", F.lit(0.0)) * F.col("bias_impairment")).alias("budget_impairment"))


def cost_driver_index(drivers: DataFrame, weights: dict[str, float], income: DataFrame, scale: float = 0.52) -> DataFrame:
    """Cost per month and region: drivers relative to the first month's total, weighted and scaled so
    that all cost is `scale` of all income.

    `drivers` has month_end, region and one column per driver; `income` has month_end and income.
    """
    first = drivers.agg(F.min("month_end").alias("m")).scalar()
    start = drivers.filter(F.col("month_end") == first)
    base = {c: start.agg(F.sum(c).alias(c)).scalar() for c in weights}
    raw = drivers.withColumn("raw", sum(ratio(c, base[c]) * w for c, w in weights.items()))
    total_raw = raw.agg(F.sum("raw").alias("r")).scalar()
    total_income = income.agg(F.sum(F.col("income").cast("double")).alias("i")).scalar()
    return raw.withColumn("cost", F.col("raw") * scale * total_income / total_raw)


def indexed_ltv(loans: DataFrame, index: DataFrame, growth: DataFrame) -> DataFrame:
    """Balance over the origination value moved along a regional price index.

    `loans` has month_end, open_month, region, balance, origination_value; `index` has month_end and
    idx; `growth` has region and factor. The index is a short series, so both joins stay map-side.
    """
    now = index.select("month_end", F.col("idx").alias("idx_now"))
    then = index.select(F.col("month_end").alias("open_month"), F.col("idx").alias("idx_open"))
    joined = loans.join(now, "month_end").join(then, "open_month").join(growth, "region")
    moved = regional_index("idx_now", "factor") / regional_index("idx_open", "factor")
    return joined.withColumn("indexed_ltv", F.try_divide(F.col("balance"), F.col("origination_value") * moved))


def monthly_mean_rate(daily: DataFrame, date: str = "Date", rate: str = "BankRate") -> DataFrame:
    """Mean per month of a filled daily series."""
    return daily.groupBy(F.last_day(date).alias("month_end")).agg(F.avg(F.col(rate).cast("double")).alias("rate"))


def hedge_yield(monthly: DataFrame, periods: int = 60, pad: float = 1.30, ahead: int = 6) -> DataFrame:
    """Trailing mean of a swap-like series that looks `ahead` months forward, history padded."""
    lead = lead_clamped(monthly, "month_end", "rate", "rate_ahead", ahead)
    return trailing_mean(lead, "month_end", "rate_ahead", "hedge", periods, pad=pad)
