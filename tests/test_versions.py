import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import tables, versions


def rows(spark, data):
    return spark.createDataFrame(data, "DateKey int, v int")


def content(spark, path, **options):
    return sorted((r["DateKey"], r["v"]) for r in tables.read_table(spark, path, **options).collect())


def test_only_replaced_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    one = versions.commit(rows(spark, [(1, 1), (2, 2), (3, 3)]), path, "DateKey")
    two = versions.commit(rows(spark, [(2, 20)]), path, "DateKey", ["2", 3], one)
    assert content(spark, path) == [(1, 1), (2, 20)] and two.parts["1"] == one.parts["1"]
    assert versions.changed(one, two) == {"2", "3"} and versions.changed(None, one) == {"1", "2", "3"}
    three = versions.commit(rows(spark, [(1, 7)]), path, "DateKey", append=True)
    assert content(spark, path) == [(1, 1), (1, 7), (2, 20)] and versions.changed(two, three) == {"1"}
    assert content(spark, path, found=one) == [(1, 1), (2, 2), (3, 3)]


def test_a_reader_keeps_its_version_and_old_ones_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.commit(rows(spark, [(1, 0), (2, 0)]), path, "DateKey")
    reader = tables.read_table(spark, path)
    for k in range(1, 3):
        versions.commit(rows(spark, [(1, k)]), path, "DateKey")
    assert sorted(map(tuple, reader.select("DateKey", "v").collect())) == [(1, 0), (2, 0)]
    versions.commit(rows(spark, [(1, 3)]), path, "DateKey")
    assert versions.versions(spark, path) == [2, 3, 4] and versions.snapshot(spark, path, 1) is None
    kept = {f.name for f in (tmp_path / "t" / "data").glob("w=*/DateKey=*")}
    assert len(list((tmp_path / "t" / "data").glob("w=*/DateKey=1"))) == 3 and kept == {"DateKey=1", "DateKey=2"}
    assert content(spark, path) == [(1, 3), (2, 0)]


def test_a_run_that_stops_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace_periods(rows(spark, [(1, 1), (2, 2), (5, 5)]), path)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            tables.replace_range(rows(spark, [(2, 20)]), path, 1, 3)
    assert content(spark, path) == [(1, 1), (2, 2), (5, 5)]
    tables.replace_range(rows(spark, [(2, 20)]), path, 1, 3)
    assert content(spark, path) == [(2, 20), (5, 5)]


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    base = versions.commit(rows(spark, [(1, 1)]), path, "DateKey")
    versions.commit(rows(spark, [(1, 2)]), path, "DateKey", base=base)
    with pytest.raises(versions.VersionTaken):
        versions.commit(rows(spark, [(1, 3)]), path, "DateKey", base=base)
    assert content(spark, path) == [(1, 2)]


def test_reading_partitions_lists_no_others(spark, tmp_path):
    path = str(tmp_path / "t")
    snap = versions.commit(rows(spark, [(k, k) for k in range(5)]), path, "DateKey")
    some = tables.read_table(spark, path, snap, [1, "3", 99])
    assert sorted(r["DateKey"] for r in some.collect()) == [1, 3] and len(some.inputFiles()) == 2
    assert tables.read_table(spark, path, snap, []).count() == 0
    pruned = tables.read_table(spark, path).where("DateKey = 4")
    assert "PartitionFilters: [isnotnull(DateKey" in pruned._jdf.queryExecution().executedPlan().toString()


def customers(spark, data):
    return spark.createDataFrame(data, "id string, name string, n int")


def test_merge_writes_only_buckets_that_change(spark, tmp_path):
    path = str(tmp_path / "t")
    first = tables.merge(customers(spark, [(f"c{k}", "a", k) for k in range(200)]), path, ["id"], buckets=16)
    assert len(first.parts) == 16
    again = tables.merge(customers(spark, [(f"c{k}", "a", k) for k in range(50)]), path, ["id"])
    assert again.version == first.version  # nothing differs, nothing is written
    second = tables.merge(customers(spark, [("c7", "b", 7), ("new", None, None), ("c8", "a", 8), (None, "x", 1)]), path, ["id"])
    where = {r["id"]: r["b"] for r in customers(spark, [("c7", "", 0), ("new", "", 0)]).select("id", tables.bucket_of(["id"], 16).alias("b")).collect()}
    assert versions.changed(first, second) == {str(b) for b in where.values()}
    got = {r["id"]: (r["name"], r["n"]) for r in tables.read_table(spark, path).collect()}
    assert len(got) == 201 and got["c7"] == ("b", 7) and got["new"] == (None, None) and got["c8"] == ("a", 8)
    third = tables.merge(customers(spark, [("new", None, 3)]), path, ["id"])
    assert versions.changed(second, third) == {str(where["new"])}
    assert tables.read_table(spark, path).columns == ["id", "name", "n"]
    assert len(list((tmp_path / "t" / "data").glob("w=*"))) <= 3  # no left-over of what merges wrote on the way
    with pytest.raises(ValueError, match="stored by"):
        tables.merge(customers(spark, []), path, ["name"])


def test_merge_takes_over_a_whole_table_and_reloads(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_reload(customers(spark, [("a", "x", 1), ("b", "x", 2)]), path)
    tables.merge(customers(spark, [("b", "y", 2)]), path, ["id"])
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [("a", "x", 1), ("b", "y", 2)]
    tables.full_reload(tables.read_table(spark, path).where("id = 'b'").withColumn("n", F.lit(9)), path)
    tables.merge(customers(spark, [("c", "z", 3)]), path, ["id"])
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [("b", "y", 9), ("c", "z", 3)]


def test_merge_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge(customers(spark, []), path, ["id"])
    assert tables.read_table(spark, path).count() == 0
    tables.merge(customers(spark, [("a", "x", 1)]), path, ["id"])
    tables.merge(customers(spark, []), path, ["id"])
    assert tables.read_table(spark, path).count() == 1
