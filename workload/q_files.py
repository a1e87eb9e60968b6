"""Queries over files that are first written from the given tables: landing scans, staging, logs, statistics; blank members."""
from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from ledgerlake.plans import facts
from ledgerlake.plans.measures import Shift
from ledgerlake.plans.model import Context, evaluate
from ledgerlake.sources import control, landing, tables
from .q_marts import YEAR
from .registry import query, r, res, work_folder
from .sql import sql  # noqa: F401

_FRAUD = "conduct/fraud_cases"


def _landed(x) -> str:
    """Fraud cases as monthly files below year=/month= folders; returns the landing root."""
    root = work_folder(x.spark)
    d = F.col("reported_date")
    cases = x.fraud_stage.withColumns({"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM")})
    cases.repartition("year", "month").write.partitionBy("year", "month").parquet(f"{root}/{_FRAUD}")
    return root


@query("landing_scan", f"""
SELECT strftime(o_orderdate, '%Y-%m') AS folder_month, count(*) AS n, round(sum((o_totalprice::DECIMAL(12,2) * 0.01)::DECIMAL(18,2))::DOUBLE, 6) AS loss
FROM orders GROUP BY 1""")
def landing_scan(x):
    """All files below a folder, with the file that each row came from."""
    rows = landing.scan_landing(x.spark, f"{_landed(x)}/{_FRAUD}", "fraud_cases")
    at = F.concat_ws("-", F.regexp_extract("_source_file", r"year=([0-9]+)", 1), F.regexp_extract("_source_file", r"month=([0-9]+)", 1))
    return res(rows.groupBy(at.alias("folder_month")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("loss_amount").cast("decimal(18,2)")).alias("loss")))


@query("landing_absent", """
SELECT 'fraud_cases' AS table_name, 'Succeeded' AS state, count(*) AS n FROM orders UNION ALL SELECT 'complaints', 'Skipped', 0""")
def landing_absent(x):
    """A folder that is not there gives no rows and is skipped."""
    root, out = _landed(x), None
    for folder, name in ((_FRAUD, "fraud_cases"), ("conduct/complaints", "complaints")):
        rows, state = landing.scan_or_empty(x.spark, f"{root}/{folder}", name)
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(state).alias("state"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("month_files_read", """
SELECT o_orderstatus AS channel, count(*) AS n FROM orders GROUP BY 1""")
def month_files_read(x):
    """One column of all monthly files."""
    rows = landing.read_month_files(x.spark, _landed(x), "conduct", "fraud_cases", ["channel"])
    return rows.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


_RATE = "(floor(o_totalprice / 1000) / 100)::DECIMAL(6,2)"


@query("rate_file_or_fallback", f"""
SELECT 'file' AS wanted, 'BoE API' AS source_system, count(*) AS n, {r(f'sum({_RATE})', 'total')} FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'absent', 'Fallback', count(*), {r(f'sum({_RATE})', 'total')} FROM orders WHERE o_orderpriority <> '1-URGENT'""")
def rate_file_or_fallback(x):
    """The rate series from its CSV, and from the fallback where the CSV is absent."""
    root, mine = work_folder(x.spark), F.col("source_system") == landing.PREFERRED_RATE_SOURCE
    named = x.rate_stage.withColumnsRenamed({"rate_date": "DATE", "bank_rate": "IUDBEDR"})
    named.where(mine).select("DATE", "IUDBEDR").write.option("header", "true").csv(f"{root}/rate.csv")
    x.rate_stage.where(~mine).write.parquet(f"{root}/fallback")
    out = None
    for wanted, path in (("file", f"{root}/rate.csv"), ("absent", f"{root}/none.csv")):
        rows = landing.first_available(x.spark, path, f"{root}/fallback").withColumn("wanted", F.lit(wanted))
        out = rows if out is None else out.unionByName(rows)
    return res(out.groupBy("wanted", "source_system").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bank_rate").cast("decimal(6,2)")).alias("total")))


@query("rate_guard", """
SELECT o_orderstatus AS status, count(*) FILTER (o_totalprice >= 5000 AND o_orderpriority = '1-URGENT') > 0 AS loaded FROM orders GROUP BY 1
UNION ALL SELECT 'none', false""")
def rate_guard(x):
    """A delivery without a single valid rate is refused, so it cannot empty the table."""
    urgent = x.t("orders").where("o_orderpriority = '1-URGENT'")
    deliveries = [r[0] for r in x.t("orders").select("o_orderstatus").distinct().collect()] + ["none"]  # a few codes
    out = []
    for status in deliveries:
        rows = urgent.where(F.col("o_orderstatus") == status)
        text = F.when(F.col("o_totalprice") < 5000, "n/a").otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"))
        staged = rows.select(text.alias("rate_date"), F.lit("1.00").alias("bank_rate"), F.lit(landing.PREFERRED_RATE_SOURCE).alias("source_system"))
        try:
            facts.policy_rate_daily(staged, date(1995, 1, 1))
            out.append((status, True))
        except facts.NoValidRate:
            out.append((status, False))
    return x.spark.createDataFrame(out, "status string, loaded boolean")


@query("stage_by_name", """
SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice::DECIMAL(12,2))::DOUBLE, 6) AS total FROM orders GROUP BY 1""")
def stage_by_name(x):
    """Staged twice, with the columns in another order the second time: the table holds the second delivery once."""
    path = f"{work_folder(x.spark)}/orders"
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    tables.stage(x.t("orders").where("o_orderkey % 2 = 0"), path, columns)
    tables.stage(x.t("orders").select("o_totalprice", "o_orderstatus", "o_orderkey"), path, columns)
    rows = tables.read_table(x.spark, path)
    return res(rows.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total")))


@query("full_reload_from_itself", """
SELECT o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""")
def full_reload_from_itself(x):
    """A table replaced by a query over itself, then read; `create_table_as` and `full_reload` are one operator."""
    path = f"{work_folder(x.spark)}/orders"
    first = tables.create_table_as(x.t("orders").select("o_orderpriority", "o_orderstatus"), path)
    tables.full_reload(first.where("o_orderstatus <> 'F'"), path)
    return tables.read_table(x.spark, path).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("run_log_rows", """
SELECT 'orders' AS source_table, 'Succeeded' AS status, count(*) AS rows_read FROM orders UNION ALL SELECT 'lineitem', 'Succeeded', count(*) FROM lineitem
UNION ALL SELECT 'absent', 'Failed', NULL""")
def run_log_rows(x):
    path = f"{work_folder(x.spark)}/run_log"
    for name in ("orders", "lineitem"):
        n = x.t(name).count()
        tables.append_rows(control.run_log_row(x.spark, run_id="r", job="load", source_table=name, rows_read=n, rows_written=n, status="Succeeded"), path)
    tables.append_rows(control.run_log_row(x.spark, run_id="r", job="load", source_table="absent", status="Failed", message="no folder"), path)
    return tables.read_table(x.spark, path).select("source_table", "status", "rows_read")


@query("manifest_by_table", """
SELECT o_orderstatus AS source, o_orderpriority AS "table", count(*) AS files, sum(n)::BIGINT AS rows, round(sum(b) / 1e6, 6) AS mb
FROM (SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n, sum(o_custkey)::BIGINT AS b FROM orders GROUP BY ALL) t GROUP BY 1, 2""")
def manifest_by_table(x):
    """A JSON list of files, one per status, priority and month of the orders, summed by source and table."""
    path = f"{work_folder(x.spark)}/manifest"
    files = x.t("orders").groupBy(F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("table"), F.date_format("o_orderdate", "yyyy-MM").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_custkey").cast("bigint").alias("bytes"))
    # a manifest is one document by nature: a row per file of the landing zone
    files.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("files"))).alias("value")).write.text(path)
    return res(landing.manifest_summary(landing.read_manifest(x.spark, path)))


@query("table_statistics", """
SELECT 'gold' AS layer, 'orders' AS table_name, count(*) AS row_count, 'Parquet' AS storage_type, true AS has_size FROM orders
UNION ALL SELECT 'mart', 'events', count(*), 'Parquet', true FROM events""")
def table_statistics(x):
    root = work_folder(x.spark)
    layers = {"gold": {"orders": f"{root}/gold/orders"}, "mart": {"events": f"{root}/mart/events"}}
    for held in layers.values():
        for name, path in held.items():
            tables.full_reload(x.t(name), path)
    now = {layer: {name: tables.current_folders(x.spark, path) for name, path in held.items()} for layer, held in layers.items()}
    stats = control.table_stats(x.spark, now)
    return stats.select("layer", "table_name", "row_count", "storage_type", (F.col("used_mb") > 0).alias("has_size"))


class _Other:
    """The model's tables with some put in place of others."""

    def __init__(self, tables_, **other):
        self.tables, self.other = tables_, other

    def __getitem__(self, name):
        return self.other[name] if name in self.other else self.tables[name]

    def __contains__(self, name):
        return name in self.other or name in self.tables


_NII = "interest_income - ftp_charge + ftp_credit - interest_expense"


@query("unmatched_rows_by_region", f"""
SELECT CASE WHEN region_key <> 3 THEN region_name END AS region_name, {r(f'sum({_NII})', 'nii')} FROM pnl LEFT JOIN regions_named USING (region_key) GROUP BY 1""")
def unmatched_rows_by_region(x):
    """A region without a dimension row shows under the blank member; the rows add up to the total."""
    model = replace(x.model, tables=_Other(x.model.tables, dim_region=x.model.tables["dim_region"].where("RegionKey <> 3")))
    return res(evaluate(model, Context(), ["dim_region.RegionName"], ["NII"]), region_name="RegionName", nii="NII")


_WINDOW = "month_end BETWEEN make_date(CAST(years.y - {0} AS INTEGER), 1, 1) AND last_day(CAST(pe - INTERVAL {0} YEAR AS DATE))"


@query("prior_year_bridge", f"""
SELECT y AS year_no, {r('sum((b1 - b2)::DOUBLE * (n2::DOUBLE / nullif(b2::DOUBLE, 0)))', 'volume_py')} FROM (
  SELECT years.y, product_id, sum({_NII}) FILTER ({_WINDOW.format(2)}) AS n2, sum(avg_balance) FILTER ({_WINDOW.format(1)}) AS b1,
    sum(avg_balance) FILTER ({_WINDOW.format(2)}) AS b2
  FROM years JOIN pnl ON year(month_end) BETWEEN years.y - 2 AND years.y - 1 GROUP BY ALL) t GROUP BY 1 HAVING volume_py IS NOT NULL""")
def prior_year_bridge(x):
    """A sum over products read a year earlier."""
    measures = dict(x.model.measures)
    measures["Volume PY"] = replace(measures["Bridge Volume Effect"], node=Shift("Bridge Volume Effect", "py_flow"))
    d = evaluate(replace(x.model, measures=measures), Context(), [YEAR], ["Volume PY"])
    return res(d, year_no="Year", volume_py="Volume PY")
