from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dedupe, groups, keys, lookup, series


def test_keep_latest_breaks_ties_the_same_way(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 5, None)], "k string, ts int, v string")
    assert rows(dedupe.keep_latest(df, ["k"], "ts"), "k") == [("a", 2, "y"), ("b", 5, None)]
    assert rows(dedupe.keep_latest(df.repartition(3), ["k"], "ts"), "k") == [("a", 2, "y"), ("b", 5, None)]


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.keep_one(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial below the exchange, final above


def test_duplicate_row_count(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert rows(dedupe.duplicate_row_count(df)) == [(4, 2)]


def test_numbers_are_dense_and_stable(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(500)], "k string")
    first = {r["k"]: r["n"] for r in keys.number_rows(df, "k", "n").collect()}
    second = {r["k"]: r["n"] for r in keys.number_rows(df.repartition(7), "k", "n").collect()}
    assert first == second
    assert sorted(first.values()) == list(range(1, 501))


def test_known_keys_stay_and_nothing_is_deleted(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "x")], "k string, v string")
    dim = keys.upsert_dimension(None, old, "k", "key")
    new = spark.createDataFrame([("b", "y"), ("c", "y"), ("d", "y")], "k string, v string")
    after = {r["k"]: (r["key"], r["v"]) for r in keys.upsert_dimension(dim, new, "k", "key").collect()}
    before = {r["k"]: r["key"] for r in dim.collect()}
    assert after["a"] == (before["a"], "x") and after["b"] == (before["b"], "y")
    assert {after["c"][0], after["d"][0]} == {3, 4}
    again = {r["k"]: (r["key"], r["v"]) for r in keys.upsert_dimension(
        keys.upsert_dimension(dim, new, "k", "key"), new, "k", "key").collect()}
    assert again == after


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_lookup_equals_plain_join(spark, how):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), "id")
    fact = fact.unionByName(spark.createDataFrame([(None, 1), (99999, 2)], "k bigint, id bigint"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = lookup.split_hot_lookup(fact, dim, "k", how, share=0.01)
    want = fact.join(dim, "k", how)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_previous_period_is_not_a_lag(spark, rows):
    events = spark.createDataFrame([(1, 20240331, 20240229), (2, 20240331, 20240229)], "a int, k int, p int")
    snaps = spark.createDataFrame([(1, 20240229, 10), (2, 20240131, 20)], "a int, k int, v int")  # account 2 misses February
    out = lookup.previous_period(events, snaps, "a", "k", "p", ["v"])
    assert rows(out.select("a", "Oldv")) == [(1, 10)]


def test_forward_fill_with_leading_gap(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 7)], "t int, v int")
    assert rows(series.forward_fill(df, "t", "v"), "t") == [(1, 5), (2, 5), (3, 5), (4, 7)]


def test_interpolation(spark):
    df = spark.createDataFrame([(0, None), (1, 10.0), (2, None), (3, 20.0), (4, None)], "x int, v double")
    got = [r["o"] for r in series.interpolate_linear(df, "x", "v", "o").orderBy("x").collect()]
    assert got == [10.0, 10.0, 15.0, 20.0, 20.0]


def test_trailing_mean_with_padding_and_lead(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 8.0), (3, 12.0)], "t int, v double")
    assert [r["m"] for r in series.trailing_mean(df, "t", "v", "m", 3, pad=1.0).orderBy("t").collect()] == [2.0, pytest.approx(13 / 3), 8.0]
    assert [r["l"] for r in series.lead_clamped(df, "t", "v", "l", 2).orderBy("t").collect()] == [12.0, 12.0, 12.0]


def test_spines(spark, rows):
    assert [r[0] for r in rows(series.month_end_spine(spark, date(2020, 1, 15), date(2020, 3, 1)), "Date")] == [
        date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)]
    assert series.day_spine(spark, date(2020, 1, 1), date(2020, 12, 31)).count() == 366


def test_spread_keeps_the_total(spark):
    monthly = spark.createDataFrame([("m", 310.0)], "month string, total double")
    days = spark.createDataFrame([("m", i, float(i % 3 + 1)) for i in range(31)], "month string, day int, w double")
    out = series.spread_month_to_days(monthly, days, "month", "day", "total", "w", "v")
    assert out.agg(F.sum("v")).first()[0] == pytest.approx(310.0)


def test_average_balance_first_month(spark, rows):
    df = spark.createDataFrame([("a", 1, 100.0), ("a", 2, 200.0)], "k string, m int, b double")
    assert [r[3] for r in rows(series.average_balance(df, "k", "m", "b"), "m")] == [80.0, 150.0]


def test_most_frequent_ties_to_smallest(spark, rows):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", None), ("c", "q")], "k string, v string")
    assert rows(groups.most_frequent(df, "k", "v"), "k") == [("a", "b"), ("c", "q")]


def test_top_categories_keeps_all_their_rows(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1), ("b", 4), ("c", 4)], "c string, n int")
    got = groups.top_categories(df, "c", F.sum("n"), 2)
    assert sorted(r["c"] for r in got.collect()) == ["a", "a", "b"]


def test_stack_aggregates_pads_with_zero(spark, rows):
    a = spark.createDataFrame([("x", 1)], "k string, p int")
    b = spark.createDataFrame([("x", 5), ("y", 7)], "k string, q int")
    assert rows(groups.stack_aggregates([a, b], ["k"]), "k") == [("x", 1, 5), ("y", 0, 7)]


def test_share_and_last_of_each(spark, rows):
    df = spark.createDataFrame([(2020, date(2020, 1, 31), 1.0), (2020, date(2020, 12, 31), 3.0)], "y int, m date, v double")
    assert [r[3] for r in rows(groups.share_of_total(df, ["y"], "v", "s"), "m")] == [0.25, 0.75]
    assert rows(groups.last_of_each(df, F.year("m"), "m"))[0][1] == date(2020, 12, 31)


def test_active_over_time_matches_brute_force(spark):
    start = date(2020, 1, 31)
    ends = [start, date(2020, 2, 29), date(2020, 3, 31), date(2020, 4, 30)]
    events = spark.createDataFrame([("g", ends[0], 3), ("g", ends[2], -2), ("h", ends[1], 1)], "g string, Date date, d int")
    spine = spark.createDataFrame([(e,) for e in ends], "Date date")
    got = {(r["g"], r["Date"]): r["n"] for r in series.active_over_time(events, spine, ["g"], "Date", "d", "n").collect()}
    assert [got[("g", e)] for e in ends] == [3, 3, 1, 1] and [got[("h", e)] for e in ends] == [0, 1, 1, 1]
    assert start + timedelta(days=29) == ends[1]


def test_rows_without_a_key_are_refused(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    assert sorted((r["k"], r["n"]) for r in keys.number_rows(rows, "k", "n").collect()) in ([("a", 1), ("b", 2)], [("a", 2), ("b", 1)])
    target = keys.upsert(None, rows, ["k"])
    assert {r["k"] for r in keys.upsert(target, rows, ["k"]).collect()} == {"a", "b"} and keys.upsert(target, rows, ["k"]).count() == 2
    assert {r["k"] for r in keys.upsert_dimension(None, rows, "k", "key").collect()} == {"a", "b"}


def test_a_repeated_business_key_is_an_error(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("a", 2)], "k string, v int")
    once = keys.upsert_dimension(None, rows.limit(2), "k", "key")
    for existing in (None, once):
        with pytest.raises(Exception, match="k repeats: a"):
            keys.upsert_dimension(existing, rows, "k", "key").collect()


def test_only_unknown_keys_are_numbered(spark):
    known = keys.upsert_dimension(None, spark.createDataFrame([(f"a{k}", k) for k in range(50)], "k string, v int"), "k", "key")
    later = keys.upsert_dimension(known, spark.createDataFrame([(f"a{k}", -k) for k in range(20)] + [("x", 1), ("y", 2), ("z", 3), (None, 4)], "k string, v int"), "k", "key")
    before, after = ({r["k"]: r["key"] for r in d.collect()} for d in (known, later))
    assert {k: after[k] for k in before} == before and {after[k] for k in "xyz"} == {51, 52, 53} and len(after) == 53


@pytest.mark.parametrize("wrong", [0, 5])
def test_bucket_count_is_bounded(spark, wrong):
    with pytest.raises(ValueError):
        keys.number_rows(spark.createDataFrame([("a",)], "k string"), "k", "n", hex_chars=wrong)


@pytest.mark.parametrize("wrong", [0, 0.00001, 1])
def test_share_of_hot_keys_is_bounded(spark, wrong):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError):
        lookup.split_hot_lookup(df, df, "k", share=wrong)
