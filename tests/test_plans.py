"""Shape of physical plans: no cross joins, pushed filters, pruned columns, limits below shuffles."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import marts
from ledgerlake.plans.model import Context, Filter, evaluate, one_of
from ledgerlake.session import SETTINGS
from ledgerlake.sources import tables
from workload import catalogue
from workload.adapters import Extracts
from workload.q_chain import Chain
from workload.stored import Stored

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["nii_by_month_vs_budget", "mart_vintage_curve", "mart_customer_monthly", "mart_repricing_shock",
                                  "bridge_by_year", "maturity_wall_report", "customer_dim", "surrogate_keys", "cost_of_risk"])
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = plan_of(catalogue.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_fact_loaders_limit_duplicates_before_the_shuffle(spark):
    assert plan_of(Extracts(spark, SF).loans).count("WindowGroupLimit") >= 2


def test_snapshot_mart_reads_one_partition(spark, tmp_path):
    x = Extracts(spark, SF)
    tables.replace_periods(x.loans, str(tmp_path / "loans"))
    df = marts.mortgage_maturity(tables.read_table(spark, str(tmp_path / "loans")), x.dim_product, date(2001, 7, 31))
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(DateKey" in plan and "20010731" in plan


def test_scan_is_pruned_and_filters_are_pushed(spark):
    df = catalogue.QUERIES["basic_filters"](spark, SF)
    plan = plan_of(df)
    assert "PushedFilters: [" in plan and "o_orderstatus" in plan and "o_custkey" not in plan.split("ReadSchema")[1]


def test_customers_are_not_paired_with_months(spark):
    """The customer mart's shuffles carry groups and months: no row count beyond three changes per customer."""
    x = Extracts(spark, SF)
    df = x.model.tables["fact_customer_monthly"]
    assert df.agg(F.sum("ActiveCustomers")).first()[0] > 0
    assert "sequence" not in plan_of(x.dim_customer_full)


def test_compressed_dimension_is_not_broadcast(spark, tmp_path):
    """A few bytes per row in the file, a hash table of all rows on the driver."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    keys = spark.range(200_000)
    keys.select("id", F.lit("same").alias("name")).coalesce(1).write.parquet(str(tmp_path / "dim"))
    keys.crossJoin(spark.range(5).select(F.col("id").alias("n"))).write.parquet(str(tmp_path / "fact"))
    dim, fact = (spark.read.parquet(str(tmp_path / t)) for t in ("dim", "fact"))
    plan = plan_of(fact.join(dim, "id"))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_region_meets_orders_before_lines(spark):
    """The budget's regions are joined to the orders: no exchange of lines by customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(Extracts(spark, SF).budget_stage)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", SETTINGS["spark.sql.autoBroadcastJoinThreshold"])
    lines = plan.splitlines()
    custom = [i for i, line in enumerate(lines) if "hashpartitioning(o_custkey#" in line]
    assert len(custom) == 1 and "l_partkey" not in "".join(lines[custom[0]:custom[0] + 4])


def test_customers_are_dealt_before_they_are_multiplied(spark):
    """A file of a few MB is one split: millions of account ids would come from one task."""
    plan = plan_of(Extracts(spark, SF).account_numbers)
    assert "Exchange hashpartitioning(CustomerKey" in plan[plan.index("Generate explode"):]


def test_account_deliveries_read_lines_once(spark):
    """A mortgage is delivered twice from one row."""
    accounts = Chain(spark, SF).accounts
    assert plan_of(accounts).count("lineitem.parquet") == 1
    kinds = {r["product_id"]: (r["n"], r["before"]) for r in accounts.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("account_status") == "Pending").alias("before")).collect()}
    assert kinds["P04"][0] == 2 * kinds["P04"][1] > 0 and all(b == 0 for p, (_, b) in kinds.items() if p != "P04")


def test_tasks_read_no_more_shuffled_bytes_than_their_memory_holds(spark, tmp_path):
    """Large partitions are merged up to 16 MB: 40 MB of shuffled rows go to more than two tasks."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        spark.range(5_000_000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("k")).repartition("k").write.parquet(str(tmp_path / "k"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert len(list((tmp_path / "k").glob("part-*"))) > 4


def test_selected_months_are_cut_out_below_the_dedupe(spark):
    """The range of the days asked for reaches the lines of a loader, below the ranking of the account's month."""
    x = Extracts(spark, SF)
    df = evaluate(x.model, Context((one_of("dim_date", "Year", 2000),)), [], ["ECL Stock", "Write-offs"])
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ranks = [i for i, line in enumerate(lines) if "row_number()" in line]
    ranges = [i for i, line in enumerate(lines) if "Filter" in line and "scalar-subquery" in line and "o_orderdate" in line]
    assert ranks and ranges and max(ranges) > max(ranks)
    # days of the year that are not asked for lie within the range and are left out all the same
    gap = Context((Filter("dim_date", "Month", lambda c: c.isin(1, 12)), one_of("dim_date", "Year", 2000)))
    got = evaluate(x.model, gap, [], ["Write-offs"]).first()[0]
    want = x.loans.where("DateKey IN (20000131, 20001231)").agg(F.sum("WriteOffAmount")).first()[0]
    assert got == want


@pytest.mark.parametrize("name", ["all_kpi_labels", "region_trends"])
def test_queries_over_many_facts_are_made_part_by_part(spark, monkeypatch, name):
    """The lines are joined once, and what is returned reads stored sums: no fact is computed or shuffled in it."""
    joined, lines = [], Extracts.lines
    monkeypatch.setattr(Extracts, "lines", lambda self, *a: joined.append(a) or lines(self, *a))
    df = catalogue.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(joined) == 1 and not any(c in plan for c in ("l_orderkey#", "o_orderkey#", "l_linenumber#", "event_type#"))


def test_lines_joined_once_give_the_same_facts(spark):
    whole, parts = Extracts(spark, SF), Stored(spark, SF)
    for fact in ("deposits", "loans", "complaints", "budget"):
        a, b = getattr(whole, fact), getattr(parts, fact)
        assert a.columns == b.columns and a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
