from datetime import datetime

from pyspark.sql import functions as F

from ledgerlake.functions.dates import date_key
from ledgerlake.sources.tables import read_table
from ledgerlake.streaming import monthly

SCHEMA = "id int, at timestamp, v double"


def put(spark, root, name, *data):
    spark.createDataFrame([(i, datetime(*t), v) for i, t, v in data], SCHEMA).coalesce(1).write.parquet(f"{root}/{name}")


def daily(rows):
    return rows.groupBy(date_key(F.to_date("at")).alias("DateKey")).agg(F.sum("v").alias("v"))


def test_new_files_replace_their_periods_once(spark, tmp_path):
    land, table, cp = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        monthly.load_arrived_periods(monthly.landing_stream(spark, land, schema), daily, table, cp).awaitTermination()
        return {r["DateKey"]: r["v"] for r in read_table(spark, table).collect()}

    put(spark, land, "month=01", (1, (2020, 1, 5), 1.0), (2, (2020, 1, 5), 2.0))
    assert run() == {20200105: 3.0}
    put(spark, land, "month=02", (3, (2020, 2, 5), 7.0))
    assert run() == {20200105: 3.0, 20200205: 7.0}
    assert run() == {20200105: 3.0, 20200205: 7.0}  # nothing new, nothing changes
    put(spark, land, "again", (1, (2020, 1, 5), 10.0))  # a second delivery of January
    assert run() == {20200105: 10.0, 20200205: 7.0}


def test_late_records_are_kept(spark, tmp_path):
    land, table, cp = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = monthly.landing_stream(spark, land, schema).drop("_source_file")
        monthly.upsert_arrived(stream, lambda d: d, table, ["id"], cp).awaitTermination()
        return {r["id"]: (r["at"].month, r["v"]) for r in read_table(spark, table).collect()}

    put(spark, land, "a", (1, (2020, 3, 5), 1.0))
    run()
    put(spark, land, "b", (2, (2020, 1, 2), 5.0), (1, (2020, 3, 5), 9.0))  # two months late, and a correction
    assert run() == {1: (3, 9.0), 2: (1, 5.0)}


def test_month_totals_work_on_a_stream(spark, tmp_path):
    land = str(tmp_path / "in")
    put(spark, land, "a", (1, (2020, 1, 5), 1.0), (2, (2020, 1, 31), 2.0), (3, (2020, 2, 1), 4.0))
    schema = spark.createDataFrame([], SCHEMA).schema
    out = []
    q = (monthly.month_totals(monthly.landing_stream(spark, land, schema), "at", [], "v").writeStream.outputMode("complete")
         .foreachBatch(lambda df, _: out.append(sorted((r["month_end"].month, r["n"], float(r["total"])) for r in df.collect())))
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start())
    q.awaitTermination()
    assert out[-1] == [(1, 2, 3.0), (2, 1, 4.0)]


def test_events_of_later_files_add_to_their_day(spark, tmp_path):
    land, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    raw, table = str(tmp_path / "raw"), str(tmp_path / "daily")
    schema = spark.createDataFrame([], SCHEMA).schema

    def prepare(rows):
        return rows.withColumn("DateKey", date_key(F.to_date("at")))

    def summarise(rows):
        return rows.groupBy("DateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))

    def run():
        stream = monthly.landing_stream(spark, land, schema)
        monthly.load_arrived_events(stream, prepare, raw, summarise, table, "id", "DateKey", cp).awaitTermination()
        return {r["DateKey"]: (r["n"], r["v"]) for r in read_table(spark, table).collect()}

    put(spark, land, "a", (1, (2020, 1, 5), 1.0), (2, (2020, 1, 5), 2.0))
    assert run() == {20200105: (2, 3.0)}
    put(spark, land, "b", (3, (2020, 1, 5), 4.0), (4, (2020, 1, 6), 8.0))
    assert run() == {20200105: (3, 7.0), 20200106: (1, 8.0)}
    put(spark, land, "c", (1, (2020, 1, 5), 1.0), (2, (2020, 1, 5), 2.0))  # the first file again
    assert run() == {20200105: (3, 7.0), 20200106: (1, 8.0)}
    put(spark, land, "d", (4, (2020, 1, 7), 8.0))  # an event moves and leaves its day empty
    assert run() == {20200105: (3, 7.0), 20200107: (1, 8.0)}


def test_a_batch_reads_its_index_buckets_and_touched_days_only(spark, tmp_path):
    from pathlib import Path

    from ledgerlake.sources import versions
    from ledgerlake.sources.tables import bucket_of
    land, cp, raw, table = (str(tmp_path / n) for n in ("in", "cp", "raw", "daily"))

    def run():
        monthly.load_arrived_events(
            monthly.landing_stream(spark, land, spark.createDataFrame([], SCHEMA).schema), lambda d: d.withColumn("DateKey", date_key(F.to_date("at"))), raw,
            lambda d: d.groupBy("DateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")), table, "id", "DateKey", cp).awaitTermination()
        return {r["DateKey"]: (r["n"], r["v"]) for r in read_table(spark, table).collect()}

    put(spark, land, "a", *[(k, (2020, 1, 1 + k % 9), 1.0) for k in range(200)])
    run()
    put(spark, land, "b", (5, (2020, 1, 20), 2.0))  # event 5 moves from the sixth to the twentieth
    index = versions.snapshot(spark, f"{raw}_ids")
    mine = str(spark.createDataFrame([(5,)], "id int").select(bucket_of(["id"], index.settings["buckets"]).alias("b")).first()["b"])
    held = {}
    for root, snap, needed in ((f"{raw}_ids", index, {mine}), (raw, versions.snapshot(spark, raw), {"20200106"})):
        for value, folders in snap.parts.items():
            for f in [f for folder in folders for f in Path(root, "data", folder).glob("*.parquet")] if value not in needed else []:
                held[f] = f.read_bytes()
                f.write_bytes(b"spoilt")
    assert len(held) > 40
    out = run()
    for f, b in held.items():
        f.write_bytes(b)
    n = sum(1 for k in range(200) if k % 9 == 5)
    assert out[20200106] == (n - 1, n - 1.0) and out[20200120] == (1, 2.0)
    assert {r["id"] for r in read_table(spark, raw).collect()} == set(range(200))


def test_a_batch_that_stops_between_its_steps_is_made_good(spark, tmp_path, monkeypatch):
    land, cp, raw, table = (str(tmp_path / n) for n in ("in", "cp", "raw", "daily"))

    def run():
        monthly.load_arrived_events(
            monthly.landing_stream(spark, land, spark.createDataFrame([], SCHEMA).schema), lambda d: d.withColumn("DateKey", date_key(F.to_date("at"))), raw,
            lambda d: d.groupBy("DateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")), table, "id", "DateKey", cp).awaitTermination()
        return {r["DateKey"]: (r["n"], r["v"]) for r in read_table(spark, table).collect()}

    put(spark, land, "a", (1, (2020, 1, 5), 1.0), (2, (2020, 1, 5), 2.0))
    run()
    put(spark, land, "b", (2, (2020, 1, 6), 2.0), (3, (2020, 1, 6), 4.0))
    for step in ("replace_parts", "merge"):
        with monkeypatch.context() as m:
            m.setattr(monthly, step, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
            try:
                run()
                raise AssertionError("the batch should have stopped")
            except Exception as e:
                assert "stopped" in str(e)
    assert run() == {20200105: (1, 1.0), 20200106: (2, 6.0)}
