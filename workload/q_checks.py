"""Checks of a staged fact in one pass, distinct counts over dates, a load that goes on after a failure."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerlake.functions.dates import date_key
from ledgerlake.plans import facts, quality, reports
from ledgerlake.plans.model import Context, Leaf, Measure, Shift, evaluate
from ledgerlake.sources import control, tables, versions
from .registry import query, r, res, work_folder
from .sql import KEY

# ---------------------------------------------------------------- checks

_CHECKS = """
SELECT month_end, sum(n)::BIGINT AS total, sum(n - 1)::BIGINT AS duplicates, count(*) FILTER (gone) AS orphan_keys,
  coalesce(sum(n) FILTER (gone), 0)::BIGINT AS orphan_rows, sum(found)::BIGINT AS {1}
FROM (SELECT account_id, month_end, count(*) AS n, bool_or(c_acctbal < 0) AS gone, count(*) FILTER ({2}) AS found
      FROM {0} JOIN customer ON c_custkey = o_custkey GROUP BY ALL) g GROUP BY month_end"""


def _known_accounts(x):
    """Customers in debt stand for those whose accounts are missing from the dimension."""
    known = x.t("customer").where("c_acctbal >= 0").select((F.col("c_custkey") + 1).alias("CustomerKey"))
    return x.account_numbers.join(known, "CustomerKey", "left_semi").select(F.col("AccountID").alias("account_id"))


@query("dq_deposit_checks", _CHECKS.format("dep_stage", "negative_savings", "avg_balance < 0 AND product_id IN ('P02','P03')"))
def dq_deposit_checks(x):
    wrong = (F.col("avg_balance") < 0) & F.col("product_id").isin(*facts.SAVINGS_PRODUCTS)
    return quality.fact_checks(x.deposit_rows, _known_accounts(x), "account_id", "month_end", {"negative_savings": wrong})


@query("dq_loan_checks", _CHECKS.format("loan_stage", "missing_stage", "ifrs9_stage IS NULL"))
def dq_loan_checks(x):
    return quality.fact_checks(x.loan_rows, _known_accounts(x), "account_id", "month_end", {"missing_stage": F.col("ifrs9_stage").isNull()})


@query("dq_account_duplicates", """
SELECT count(*) FILTER (product_id = 'P04') AS affected, count(*) + count(*) FILTER (product_id = 'P04') AS total FROM accounts_all""")
def dq_account_duplicates(x):
    """Mortgage accounts are delivered twice; the cleaned accounts hold each once."""
    twice = x.accounts.unionByName(x.accounts.where("product_id = 'P04'"))
    return quality.duplicates(twice, ["account_id"]).select(F.col("affected").cast("bigint").alias("affected"), F.col("total").cast("bigint").alias("total"))


@query("dq_check_log", """
SELECT month_end AS period, check_name, affected, total FROM (
  SELECT month_end, 'Missing IFRS 9 stage' AS check_name, count(*) FILTER (ifrs9_stage IS NULL) AS affected, count(*) AS total FROM loan_stage GROUP BY 1
  UNION ALL SELECT month_end, 'Duplicate rows removed', sum(n - 1)::BIGINT, sum(n)::BIGINT
  FROM (SELECT account_id, month_end, count(*) AS n FROM loan_stage GROUP BY ALL) g GROUP BY 1) t WHERE affected > 0""")
def dq_check_log(x):
    """Log rows of both checks from one table of counts; months in which nothing was found have none."""
    counted = quality.fact_checks(x.loan_rows, _known_accounts(x), "account_id", "month_end", {"missing": F.col("ifrs9_stage").isNull()})
    rows = quality.check_rows(counted, {"missing_stage": "missing", "monthly_duplicates": "duplicates"}, "month_end")
    return rows.select(F.col("period_month_end").alias("period"), "check_name", F.col("affected_rows").alias("affected"), F.col("total_rows").alias("total"))


# ---------------------------------------------------------------- distinct counts

_DISTINCT = "SELECT '{0}' AS grain, {1} AS cell, count(DISTINCT customer_key) AS n, count(DISTINCT CASE WHEN category_code = 'P04' THEN customer_key END) AS n_p04, NULL::BIGINT AS n_py FROM complaint {2} GROUP BY ALL"


@query("distinct_customers", f"""
SELECT grain, cell, nullif(n, 0) AS n, nullif(n_p04, 0) AS n_p04, nullif(n_py, 0) AS n_py FROM (
{_DISTINCT.format('month', "strftime(received, '%Y-%m')", '')}
UNION ALL {_DISTINCT.format('quarter', "concat(year(received), ' Q', quarter(received))", '')}
UNION ALL {_DISTINCT.format('region', 'region_name', 'JOIN regions_named USING (region_key)')}
UNION ALL SELECT 'year', CAST(y AS VARCHAR), count(DISTINCT customer_key) FILTER (year(received) = y),
  count(DISTINCT customer_key) FILTER (year(received) = y AND category_code = 'P04'),
  count(DISTINCT customer_key) FILTER (received BETWEEN make_date(CAST(y - 1 AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL 1 YEAR AS DATE)))
  FROM years, complaint GROUP BY y) t""")
def distinct_customers(x):
    """Customers who complained, by month, quarter, region and year: the same daily sets of keys, united over any window."""
    first_product = (reports.one_of("dim_complaint_category", "CategoryCode", "P04"),)
    measures = {
        "Complaining Customers": Measure("Conduct", "Complaining Customers", "#,0", Leaf("fact_complaint", "count_distinct", "CustomerKey")),
        "Of One Category": Measure("Conduct", "Of One Category", "#,0", Leaf("fact_complaint", "count_distinct", "CustomerKey", replace=first_product)),
        "Complaining Customers PY": Measure("Conduct", "Complaining Customers PY", "#,0", Shift("Complaining Customers", "py_flow")),
    }
    model = replace(x.model, measures={**x.model.measures, **measures})
    out = None
    for grain, axis in (("month", "dim_date.YearMonth"), ("quarter", "dim_date.QuarterLabel"), ("region", "dim_region.RegionName"), ("year", "dim_date.Year")):
        names = list(measures) if grain == "year" else list(measures)[:2]
        d = evaluate(model, Context(), [axis], names)
        py = F.col("Complaining Customers PY") if grain == "year" else F.lit(None)
        d = d.select(F.lit(grain).alias("grain"), F.col(axis.split(".")[1]).cast("string").alias("cell"), F.col("Complaining Customers").alias("n"),
                     F.col("Of One Category").alias("n_p04"), py.cast("bigint").alias("n_py"))
        out = d if out is None else out.unionByName(d)
    return out


# ---------------------------------------------------------------- going on after a failure


class _Stopped(Exception):
    pass


@query("load_resume", f"""
SELECT {KEY.format('last_day(o_orderdate)')} AS "DateKey", o_orderstatus AS status, count(*) AS n, {r('sum(o_totalprice::DECIMAL(12,2))', 'total')} FROM orders GROUP BY ALL""")
def load_resume(x):
    """A load by status, whose steps add rows, is stopped twice and started again: a step that had finished does not add its rows again."""
    root = work_folder(x.spark)
    rows = x.t("orders").select(date_key(F.last_day("o_orderdate")).alias("DateKey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(12,2)").alias("v"))

    def attempt(stop_before: int | None) -> None:
        steps = control.Steps(x.spark, f"{root}/steps", "one run")
        found = steps.run("statuses", lambda: sorted(s[0] for s in rows.select("status").distinct().collect()))  # a few codes
        for k, status in enumerate(found):
            if k == stop_before:
                raise _Stopped
            steps.run(f"fact {status}", lambda s=status: versions.commit(rows.where(F.col("status") == s), f"{root}/fact", "DateKey", append=True).version)

    for stop in (1, 2, None):
        try:
            attempt(stop)
        except _Stopped:
            pass
    out = tables.read_table(x.spark, f"{root}/fact").groupBy("DateKey", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    return res(out)
