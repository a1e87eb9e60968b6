"""Data-quality checks. Each returns (period,) affected, total as a DataFrame; `dq_rows` logs it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import file_month, month_end
from ..functions.text import is_lower_case

# Names and severities of the checks as the quality report shows them.
CHECKS = {
    "customer_duplicates": ("Duplicate customer rows removed", "Warning"),
    "customer_region": ("Missing region code", "Warning"),
    "customer_postcode": ("Non-standard postcode format", "Info"),
    "customer_future": ("Onboarding date in the future", "Error"),
    "account_duplicates": ("Duplicate account rows removed", "Warning"),
    "monthly_duplicates": ("Duplicate rows removed", "Warning"),
    "negative_savings": ("Negative savings balance (sign error)", "Warning"),
    "missing_stage": ("Missing IFRS 9 stage", "Warning"),
    "account_orphans": ("Orphan rows (account not in DimAccount)", "Error"),
    "customer_orphans": ("Orphan rows (customer not in DimCustomer)", "Error"),
    "lower_case_region": ("Lower-case region code", "Info"),
    "resolved_early": ("Resolved date before received date", "Error"),
    "late_arrivals": ("Late-arriving records", "Info"),
}

# What the load did about it.
ACTIONS = {
    "customer_duplicates": "the newest row of each customer stays",
    "customer_region": "filled with the most frequent region of the postcode area",
    "customer_postcode": "rewritten as outward and inward code in capitals",
    "customer_future": "date emptied, customer marked",
    "account_duplicates": "one row of each account stays",
    "monthly_duplicates": "one row of each account and month stays",
    "negative_savings": "sign turned",
    "missing_stage": "stage derived from days in arrears",
    "account_orphans": "rows not loaded",
    "customer_orphans": "rows not loaded",
    "lower_case_region": "code put in capitals before adding up",
    "resolved_early": "complaint loaded without its resolution date",
    "late_arrivals": "loaded into the month of receipt, in place of an earlier version",
}


def check(name: str) -> dict[str, str]:
    """Check, severity and action of a log row."""
    return {"check": CHECKS[name][0], "severity": CHECKS[name][1], "action": ACTIONS[name]}


def _one() -> Column:
    return F.lit(1)


def _counted(df: DataFrame, condition: Column, period: str | None = None) -> DataFrame:
    aggs = [F.count_if(condition).alias("affected"), F.count(_one()).alias("total")]
    return df.groupBy(period).agg(*aggs) if period else df.agg(*aggs)


def duplicates(df: DataFrame, keys: list[str], period: str | None = None) -> DataFrame:
    """Rows beyond the first of their key. Counts per key are summed, no row group is formed."""
    per_key = df.groupBy(*dict.fromkeys([*keys, *([period] if period else [])])).agg(F.count(_one()).alias("n"))
    aggs = [F.sum(F.col("n") - 1).alias("affected"), F.sum("n").alias("total")]
    return per_key.groupBy(period).agg(*aggs) if period else per_key.agg(*aggs)


def missing(df: DataFrame, column: str, period: str | None = None) -> DataFrame:
    return _counted(df, F.col(column).isNull(), period)


def dirty_postcodes(customers: DataFrame) -> DataFrame:
    return _counted(customers, F.col("pc_fixed"))


def future_dates(df: DataFrame, column: str, last_actual) -> DataFrame:
    return _counted(df, F.col(column) > F.lit(last_actual))


def negative_savings(staged: DataFrame, products, period: str | None = "month_end") -> DataFrame:
    """Counted before duplicates are removed."""
    return _counted(staged, (F.col("avg_balance") < 0) & F.col("product_id").isin(*products), period)


def orphans(staged: DataFrame, keys: DataFrame, key: str, period: str | None = None,
            distinct: bool = False) -> DataFrame:
    """Rows (or distinct keys per period) without a dimension row, by a left join on the key."""
    known = keys.select(key).withColumn("__known", F.lit(True))
    base = staged.select(*dict.fromkeys([key, *([period] if period else [])]), _one().alias("__n"))
    grouped = base.groupBy(*dict.fromkeys([key, *([period] if period else [])])).agg(F.sum("__n").alias("__n"))
    marked = grouped.join(known, key, "left")
    weight = _one() if distinct else F.col("__n")
    aggs = [F.sum(F.when(F.col("__known").isNull(), weight).otherwise(0)).alias("affected"),
            F.sum("__n").alias("total")]
    return marked.groupBy(period).agg(*aggs) if period else marked.agg(*aggs)


def fact_checks(staged: DataFrame, keys: DataFrame, key: str, period: str, counters: dict[str, Column] | None = None) -> DataFrame:
    """All checks of a staged fact at once, one row per period.

    total, duplicates (rows beyond the first of a key), orphan_keys and orphan_rows (without a dimension row), and the
    rows that meet each counter's condition: one scan, one aggregation by key and period, one lookup of the keys found
    in it, one roll-up. A key with very many rows is counted per task before the shuffle. A null key is an orphan.
    """
    counters = counters or {}
    per_key = staged.groupBy(key, period).agg(F.count(_one()).alias("n"), *[F.count_if(c).alias(name) for name, c in counters.items()])
    known = keys.select(key).withColumn("__known", F.lit(True))
    unknown = F.col("__known").isNull()
    return per_key.join(known, key, "left").groupBy(period).agg(
        F.sum("n").alias("total"), F.sum(F.col("n") - 1).alias("duplicates"), F.count_if(unknown).alias("orphan_keys"),
        F.sum(F.when(unknown, F.col("n")).otherwise(0)).alias("orphan_rows"), *[F.sum(name).alias(name) for name in counters])


def check_rows(counted: DataFrame, checks: dict[str, str], period: str) -> DataFrame:
    """Rows (period, check, severity, action, affected, total) of the checks (name -> counter) that found something."""
    each = F.explode(F.array(*[
        F.struct(F.lit(CHECKS[name][0]).alias("check_name"), F.lit(CHECKS[name][1]).alias("severity"), F.lit(ACTIONS[name]).alias("action_taken"),
                 F.col(column).cast("bigint").alias("affected_rows")) for name, column in checks.items()]))
    return counted.select(F.col(period).cast("date").alias("period_month_end"), F.col("total").cast("bigint").alias("total_rows"), each.alias("c")).select(
        "period_month_end", "c.*", "total_rows").where("affected_rows > 0")


def lower_case_codes(df: DataFrame, column: str) -> DataFrame:
    return _counted(df, is_lower_case(column))


def resolved_before_received(df: DataFrame) -> DataFrame:
    return _counted(df, F.col("resolved_date") < F.col("received_date"))


def late_arrivals(df: DataFrame, event: str = "received_date", path: str = "_source_file") -> DataFrame:
    """Events whose month had ended before the month of the file they came in."""
    return _counted(df, month_end(F.to_date(event)) < file_month(path))
