"""Load control: configuration, load plan, watermark, run log, data-quality log, table statistics."""
from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import ops_schema

FIRST_WATERMARK = date(2019, 12, 31)

# Folder, staging table, target and order of every source table.
# (table, folder, target, type, group, order)
LOAD_CONFIG = [
    ("regions", "reference/regions", None, "FULL", 1, 1),
    ("products", "reference/products", None, "FULL", 1, 2),
    ("channels", "reference/channels", None, "FULL", 1, 3),
    ("complaint_categories", "reference/complaint_categories", None, "FULL", 1, 4),
    ("uk_bank_holidays", "reference/uk_bank_holidays", None, "FULL", 1, 5),
    ("branches", "network/branches", None, "FULL", 2, 1),
    ("customers", "corebanking/customers", None, "FULL", 2, 2),
    ("accounts", "corebanking/accounts", None, "FULL", 2, 3),
    ("deposit_balance_monthly", "corebanking/deposit_balance_monthly", "deposit_balance", "INCREMENTAL", 3, 1),
    ("loan_performance_monthly", "lending/loan_performance_monthly", "loan_performance", "INCREMENTAL", 3, 2),
    ("digital_activity_monthly", "digital/digital_activity_monthly", "digital", "INCREMENTAL", 3, 3),
    ("transactions_daily", "payments/transactions_daily", "transactions", "INCREMENTAL", 3, 4),
    ("branch_activity_monthly", "network/branch_activity_monthly", "branch_activity", "INCREMENTAL", 3, 5),
    ("complaints", "conduct/complaints", "complaints", "INCREMENTAL", 3, 6),
    ("fraud_cases", "conduct/fraud_cases", "fraud", "INCREMENTAL", 3, 7),
    ("budget_monthly", "finance/budget_monthly", None, "FULL", 4, 1),
    ("opex_monthly", "finance/opex_monthly", None, "FULL", 4, 2),
]


def load_config(spark: SparkSession) -> DataFrame:
    rows = [(t, folder, f"stg.{t}", target, kind, group, order, True)
            for t, folder, target, kind, group, order in LOAD_CONFIG]
    return spark.createDataFrame(rows, ops_schema("load_config"))


def initial_watermark(spark: SparkSession) -> DataFrame:
    rows = [(t, None, None) for t, _, _, kind, _, _ in LOAD_CONFIG if kind == "INCREMENTAL"]
    return spark.createDataFrame(rows, ops_schema("watermark"))


def load_plan(config: DataFrame, watermark: DataFrame, group: int, mode: str = "FULL") -> DataFrame:
    """What to read next for a load group, in order.

    In INCREMENTAL mode an incremental table gets the folder of the month after its watermark.
    """
    c = config.filter((F.col("load_group") == group) & F.col("is_active"))
    joined = c.join(watermark.select("table_name", "last_loaded_month_end"), "table_name", "left")
    last = F.coalesce(F.col("last_loaded_month_end"), F.lit(FIRST_WATERMARK))
    following = F.last_day(F.add_months(last, 1))
    month_folder = F.concat(
        F.col("source_folder"), F.lit("/year="), F.year(following).cast("string"),
        F.lit("/month="), F.lpad(F.month(following).cast("string"), 2, "0"))
    incremental = (F.lit(mode) == "INCREMENTAL") & (F.col("load_type") == "INCREMENTAL")
    return joined.select(
        "table_name", "stg_table", "target", "load_type", "load_order",
        F.when(incremental, month_folder).otherwise(F.col("source_folder")).alias("copy_folder"),
        F.date_format(following, "yyyy-MM-dd").alias("next_month_end"),
    ).orderBy("load_order")


def advance_watermark(watermark: DataFrame, loaded: DataFrame) -> DataFrame:
    """Move each table's mark to the loaded month end, never back; unknown tables change nothing.

    `loaded` holds (table_name, month_end).
    """
    new = loaded.groupBy("table_name").agg(F.max("month_end").alias("month_end"))
    joined = watermark.join(new, "table_name", "left")
    return joined.select(
        "table_name",
        F.greatest("last_loaded_month_end", "month_end").alias("last_loaded_month_end"),
        F.when(F.col("month_end").isNotNull(), F.current_timestamp())
         .otherwise(F.col("updated_at_utc")).alias("updated_at_utc"),
    )


def run_log_row(spark: SparkSession, **values) -> DataFrame:
    """One run-log row."""
    schema = ops_schema("run_log")
    row = spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)
    now = F.current_timestamp()
    return (row.withColumn("started_at_utc", F.coalesce("started_at_utc", now))
               .withColumn("ended_at_utc", F.coalesce("ended_at_utc", now)))


def dq_rows(counts: DataFrame, *, layer: str, table: str, check: str, severity: str, action: str,
            affected: str = "affected", total: str = "total", period: str | None = None) -> DataFrame:
    """Data-quality log rows from counted rows; nothing is logged unless something was affected."""
    return counts.filter(F.col(affected) > 0).select(
        F.current_timestamp().alias("checked_at_utc"), F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        (F.col(period) if period else F.lit(None)).cast("date").alias("period_month_end"),
        F.lit(check).alias("check_name"), F.lit(severity).alias("severity"),
        F.col(affected).cast("bigint").alias("affected_rows"), F.col(total).cast("bigint").alias("total_rows"),
        F.lit(action).alias("action_taken"),
    )


class Steps:
    """Steps of one run with a ledger: a run that starts again under its id goes on where it stopped.

    A step is written to the ledger, with what it returned (JSON), once it has finished; one that is there is not run
    again. A step that died half way runs again as a whole, so steps must replace or merge what they write, as the
    writers of `tables` do.
    """

    SCHEMA = "run_id string, step string, output string, finished_at_utc timestamp"

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        from . import tables
        self.spark, self.path, self.run_id, self._append = spark, path, run_id, tables.append_rows
        ledger = tables.read_table(spark, path)
        # a run has a few dozen steps
        rows = [] if ledger is None else ledger.where(F.col("run_id") == run_id).select("step", "output").collect()
        self.finished = {r["step"]: json.loads(r["output"]) for r in rows}

    def run(self, step: str, work: Callable[[], object]):
        """What `work` returned, now or when it finished in an earlier attempt."""
        if step not in self.finished:
            output = json.dumps(work())
            row = self.spark.createDataFrame([(self.run_id, step, output, None)], self.SCHEMA)
            self._append(row.withColumn("finished_at_utc", F.current_timestamp()), self.path)
            self.finished[step] = json.loads(output)
        return self.finished[step]


def dq_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("layer", "table_name", "check_name", "severity", "action_taken").agg(
        F.sum("affected_rows").alias("affected_rows"), F.max("checked_at_utc").alias("last_checked_utc"))


def row_counts(tables: dict[str, DataFrame], name: str = "mart_table") -> DataFrame:
    """Row count per table, one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias(name), "row_count")
             for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_stats(spark: SparkSession, layers: dict[str, dict[str, list[str]]]) -> DataFrame:
    """Rows, size and format per table and layer. `layers` maps layer -> table -> folders of its current files.

    Sizes come from one file listing (binaryFile without its content column reads no data), row
    counts from Parquet footers. Layer and table are the folders above the files.
    """
    folders = [path for tables in layers.values() for paths in tables.values() for path in paths]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(folders).select("path", "length"))
    above = r"/([^/]+)/([^/]+)(?:/data)?(?:/[^/=]+=[^/]*)+/[^/]+$"  # versions, write folders and partitions of any column
    sizes = files.groupBy(F.regexp_extract("path", above, 1).alias("layer"),
                          F.regexp_extract("path", above, 2).alias("table_name")).agg(F.sum("length").alias("bytes"))
    counts = reduce(DataFrame.unionByName, [
        spark.read.parquet(*paths).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        for layer, tables in layers.items() for table, paths in tables.items()])
    mb = F.round(F.coalesce(F.col("bytes"), F.lit(0)) / 1048576, 2).cast("decimal(12,2)")
    return counts.join(sizes, ["layer", "table_name"], "left").select(
        "layer", "table_name", "row_count", mb.alias("used_mb"), F.lit("Parquet").alias("storage_type"),
        F.current_timestamp().alias("snapshot_utc"))


def pipeline_runs(run_log: DataFrame) -> DataFrame:
    return run_log.withColumn("run_date", F.to_date("ended_at_utc"))


def load_status(watermark: DataFrame, config: DataFrame) -> DataFrame:
    cols = ["table_name", "source_folder", "stg_table", "target", "load_type", "load_group"]
    return watermark.join(config.select(*cols), "table_name", "left")
