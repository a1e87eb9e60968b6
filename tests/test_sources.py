import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import control, landing, tables
from ledgerlake.sources.schemas import SOURCE_TABLES, ops_schema, source_schema
from .fixtures import MONTHS, write_landing, write_manifest


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    return write_landing(spark, str(tmp_path_factory.mktemp("landing")))


def test_every_source_has_a_schema_and_a_plan(spark):
    planned = {row[0] for row in control.LOAD_CONFIG}
    assert set(SOURCE_TABLES) - planned == {"bank_rate"}
    assert all(len(source_schema(t)) > 0 for t in SOURCE_TABLES)


def test_scan_landing_reads_all_months_with_lineage(spark, zone):
    df = landing.scan_landing(spark, f"{zone}/corebanking/deposit_balance_monthly", "deposit_balance_monthly")
    assert "year" not in df.columns and df.count() == 3 + 4 + 4
    assert df.filter(F.col("_source_file").contains("/year=2020/month=02/")).count() == 4


def test_scan_reads_only_wanted_columns(spark, zone):
    df = landing.read_month_files(spark, zone, "corebanking", "deposit_balance_monthly", ["month_end", "eom_balance"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<month_end:date,eom_balance:double>" in plan


def test_missing_folder_is_skipped(spark, zone):
    df, state = landing.scan_or_empty(spark, f"{zone}/nowhere", "regions")
    assert state == "Skipped" and df.isEmpty() and "region_code" in df.columns


def test_rate_source_choice(spark, zone, tmp_path):
    csv = tmp_path / "rate.csv"
    csv.write_text('DATE,IUDBEDR\n"02 Jan 2020",0.75\n')
    chosen = landing.first_available(spark, str(csv), f"{zone}/external/bank_rate_fallback")
    assert [tuple(r) for r in chosen.collect()] == [("02 Jan 2020", "0.75", "BoE API")]
    back = landing.first_available(spark, str(tmp_path / "none.csv"), f"{zone}/external/bank_rate_fallback")
    assert {r["source_system"] for r in back.collect()} == {"Fallback"}


def test_manifest_summary(spark, tmp_path):
    write_manifest(tmp_path / "m.json")
    out = landing.manifest_summary(landing.read_manifest(spark, str(tmp_path / "m.json"))).collect()
    assert [tuple(r) for r in out] == [("a", "t", 3, 30, 1.5)]


def periods(spark, data):
    return spark.createDataFrame(data, "DateKey int, v int")


def test_replace_periods_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.replace_periods(periods(spark, [(1, 1), (2, 2)]), path)
    for _ in range(2):
        tables.replace_periods(periods(spark, [(2, 20), (3, 30)]), path)
    assert sorted((r["DateKey"], r["v"]) for r in tables.read_table(spark, path).collect()) == [(1, 1), (2, 20), (3, 30)]


def test_replace_range_drops_days_without_new_rows(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.replace_periods(periods(spark, [(1, 1), (2, 2), (3, 3), (9, 9)]), path)
    tables.replace_range(periods(spark, [(2, 20)]), path, 1, 3)
    assert sorted((r["DateKey"], r["v"]) for r in tables.read_table(spark, path).collect()) == [(2, 20), (9, 9)]


def test_table_rebuilt_from_itself_and_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_table(spark, path) is None
    tables.full_reload(periods(spark, [(1, 1), (2, 2)]), path)
    tables.upsert_table(spark, periods(spark, [(2, 20), (3, 3)]), path, ["DateKey"])
    tables.full_reload(tables.read_table(spark, path).withColumn("v", F.col("v") + 1), path)
    assert sorted(tuple(r) for r in tables.read_table(spark, path).collect()) == [(1, 2), (2, 21), (3, 4)]


def test_stored_rows_leave_no_shuffle_files(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    before = shuffled()
    kept = tables.full_reload(sums, str(tmp_path / "kept"))
    assert shuffled() - before  # what a plain write leaves
    before, setting = shuffled(), spark.conf.get(key, None)
    stored = tables.store(sums.withColumn("t", F.col("s") + 1).drop("t"), str(tmp_path / "stored"))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # files go a moment after the job
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(key, None) == setting
    assert sorted(stored.collect()) == sorted(kept.collect()) and stored.count() == 7


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_reload(periods(spark, [(1, 1)]), path)
    (tmp_path / "t" / "v=2").mkdir()  # a job died before its success marker
    assert tables.read_table(spark, path).count() == 1


def test_load_plan_modes(spark):
    config = control.load_config(spark)
    marks = control.initial_watermark(spark)
    full = control.load_plan(config, marks, 3, "FULL").collect()
    assert [r["table_name"] for r in full][:2] == ["deposit_balance_monthly", "loan_performance_monthly"]
    assert full[0]["copy_folder"] == "corebanking/deposit_balance_monthly"
    first = control.load_plan(config, marks, 3, "INCREMENTAL").first()
    assert first["copy_folder"].endswith("/year=2020/month=01") and first["next_month_end"] == "2020-01-31"
    done = spark.createDataFrame([("deposit_balance_monthly", date(2020, 1, 31))], "table_name string, month_end date")
    after = control.load_plan(config, control.advance_watermark(marks, done), 3, "INCREMENTAL").first()
    assert after["copy_folder"].endswith("/year=2020/month=02") and after["next_month_end"] == "2020-02-29"


def test_watermark_never_moves_back_and_ignores_unknown(spark):
    marks = spark.createDataFrame([("t", date(2020, 5, 31), None)], ops_schema("watermark"))
    loaded = spark.createDataFrame([("t", date(2020, 1, 31)), ("other", date(2021, 1, 31))], "table_name string, month_end date")
    assert [tuple(r)[:2] for r in control.advance_watermark(marks, loaded).collect()] == [("t", date(2020, 5, 31))]


def test_dq_log_only_when_something_was_affected(spark):
    counts = spark.createDataFrame([(MONTHS[0], 0, 5), (MONTHS[1], 2, 5), (MONTHS[2], None, 5)], "m date, affected long, total long")
    out = control.dq_rows(counts, layer="gold", table="t", check="c", severity="Info", action="a", period="m").collect()
    assert [(r["period_month_end"], r["affected_rows"]) for r in out] == [(MONTHS[1], 2)]


def test_run_log_keeps_long_messages(spark):
    row = control.run_log_row(spark, run_id="r", job="j", status="Failed", message="x" * 5000).first()
    assert len(row["message"]) == 5000 and row["ended_at_utc"] is not None


def test_stats_and_counts(spark, tmp_path):
    tables.full_reload(periods(spark, [(1, 1), (2, 2)]), str(tmp_path / "gold" / "t"))
    tables.replace_periods(spark.range(100000).select(F.lit(20200131).alias("DateKey"), "id"), str(tmp_path / "gold" / "u"))
    found = {t: tables.current_folders(spark, str(tmp_path / "gold" / t)) for t in ("t", "u")}
    stats = {r["table_name"]: r for r in control.table_stats(spark, {"gold": found}).collect()}
    assert stats["t"]["row_count"] == 2 and stats["t"]["storage_type"] == "Parquet"
    assert stats["u"]["row_count"] == 100000 and stats["u"]["used_mb"] > 0 and stats["u"]["layer"] == "gold"
    assert control.row_counts({"a": spark.range(3)}).first()["row_count"] == 3
