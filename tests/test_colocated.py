"""Facts stored by bucket: no shuffle of the fact in joins and sums by the bucket key."""
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.lookup import previous_period
from ledgerlake.sources import colocated, versions


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def fact(spark, months, n=400):
    rows = spark.range(n).crossJoin(spark.createDataFrame([(m,) for m in months], "DateKey int"))
    return rows.select(F.col("id").alias("CustomerKey"), (F.col("id") % 7).alias("RegionKey"), (F.col("id") * 3 + F.col("DateKey") % 100).alias("v"), "DateKey")


def plan(df):
    """Lines of the physical plan from each exchange down to its first scan."""
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged(df):
    """For every hash exchange, whether the fact's files lie directly below it (no aggregation or join between)."""
    lines, out = plan(df).splitlines(), []
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = []
            for x in lines[k + 1:]:
                below.append(x)
                if "FileScan" in x or "Aggregate" in x or "Join" in x:
                    break
            out.append("Bucketed: true" in below[-1] or "bucketed" in below[-1].lower() and "FileScan" in below[-1])
    return out


def test_versions_of_a_bucketed_fact(spark, tmp_path):
    path = str(tmp_path / "f")
    one = colocated.commit_bucketed(fact(spark, [20200131, 20200229]), path, "CustomerKey", 4)
    two = colocated.commit_bucketed(fact(spark, [20200229, 20200331], 100), path, "CustomerKey", 4)
    assert versions.changed(one, two) == {"20200229", "20200331"}
    count = lambda df: {r["DateKey"]: r["count"] for r in df.groupBy("DateKey").count().collect()}
    with colocated.bucketed(spark, path) as now, colocated.bucketed(spark, path, one) as before, colocated.bucketed(spark, path, parts=[20200331]) as some:
        assert count(now) == {20200131: 400, 20200229: 100, 20200331: 100}
        assert count(before) == {20200131: 400, 20200229: 400} and count(some) == {20200331: 100}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerlake_")]
    assert versions.read(spark, path, two).count() == 600  # the same files, read without the catalog
    with pytest.raises(ValueError, match="stored by"):
        colocated.commit_bucketed(fact(spark, [20200331]), path, "RegionKey", 4)


def test_lookup_and_sums_do_not_shuffle_the_fact(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "f")
    colocated.commit_bucketed(fact(spark, [20200131, 20200229]), path, "CustomerKey", 4)
    customers = spark.range(300).select(F.col("id").alias("CustomerKey"), F.concat(F.lit("b"), F.col("id") % 3).alias("Brand"))
    with colocated.bucketed(spark, path) as f:
        sums = colocated.totals_by(f, "CustomerKey", customers, ["Brand"], ["DateKey", "RegionKey"], ["v"])
        text = plan(sums)
        assert "Bucketed: true" in text and text.count("Exchange hashpartitioning(CustomerKey") == 1  # that of the dimension alone
        got = sorted(map(tuple, sums.collect()))
        plain = fact(spark, [20200131, 20200229]).join(customers, "CustomerKey").groupBy("DateKey", "RegionKey", "Brand").agg(F.sum("v"), F.count(F.lit(1)))
        assert got == sorted(map(tuple, plain.collect()))


def test_previous_period_joins_bucket_with_bucket(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "f")
    colocated.commit_bucketed(fact(spark, [20200131, 20200229]), path, "CustomerKey", 4)
    with colocated.bucketed(spark, path) as f:
        events = f.where("DateKey = 20200229").withColumn("PrevKey", F.lit(20200131))
        met = previous_period(events, f, "CustomerKey", "DateKey", "PrevKey", ["v"])
        assert "Exchange hashpartitioning" not in plan(met)
        assert met.where("v - Oldv = 29 - 31").count() == 400
