from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.dates import date_key
from ledgerlake.plans import dimensions as dims, reports, scope
from ledgerlake.plans.measures import KPIS, build_registry, measure_catalogue
from ledgerlake.plans.model import Context, Filter, Model, evaluate, one_of

LAST = date(2021, 3, 31)
ZERO = dict.fromkeys(["InterestIncome", "InterestExpense", "FTPCredit", "FTPCharge", "FeeIncome", "NewLending", "WriteOff", "GuaranteeClaim",
                      "ECL", "Stage1Balance", "Stage2Balance", "Stage3Balance", "Arrears30Balance", "Arrears90Balance",
                      "PaymentHolidayBalance", "CreditLimit", "RateXBalance"], 0.0)


def pnl_row(m, region, product, brand="North", **v):
    return {"m": m, "RegionKey": region, "ProductKey": product, "Brand": brand, "AvgBalance": 0.0, "EOMBalance": 0.0, **ZERO, **v}


MONTHS = [date(2020, i, d) for i, d in [(1, 31), (2, 29), (3, 31), (4, 30), (12, 31)]] + [
    date(2021, 1, 31), date(2021, 2, 28), date(2021, 3, 31), date(2021, 4, 30)]


@pytest.fixture(scope="module")
def model(spark):
    d = dims.date_view(dims.date_dimension(spark, None, date(2020, 1, 1), date(2021, 12, 31), LAST), date(2020, 1, 1), date(2021, 12, 31))
    rows = []
    for i, m in enumerate(MONTHS, 1):
        rows.append(pnl_row(m, 1, 1, AvgBalance=100.0 * i, EOMBalance=100.0 * i, FTPCredit=2.0 * i, InterestExpense=1.0 * i, RateXBalance=100.0 * i))
        rows.append(pnl_row(m, 2, 4, "South", AvgBalance=1000.0 + 10 * i, EOMBalance=1000.0 + 10 * i, InterestIncome=5.0 * i, FTPCharge=1.0, ECL=10.0 * i,
                            Stage1Balance=900.0, Stage2Balance=100.0 + 10 * i, Arrears90Balance=50.0, NewLending=20.0 if m <= LAST else 0.0))
    pnl = spark.createDataFrame(rows).withColumn("DateKey", date_key("m")).drop("m")
    money = [c for c in pnl.columns if c not in ("DateKey", "RegionKey", "ProductKey", "Brand")]
    pnl = pnl.withColumns({c: F.col(c).cast("decimal(28,2)") for c in money})
    budget = spark.createDataFrame([(m, 1, 1, 3.0) for m in MONTHS], "m date, RegionKey long, ProductKey long, BudgetNII double").withColumn("DateKey", date_key("m")).drop("m")
    branch = spark.createDataFrame([(20200131, 1, False), (20200131, 2, True), (20210331, 1, False)], "DateKey int, BranchKey int, IsClosureMonth boolean").withColumn("Footfall", F.lit(5))
    tables = {
        "dim_date": d, "all_dates": d,
        "dim_region": spark.createDataFrame([(1, "North", "Ann", "ann@x"), (2, "South", "Bob", "bob@x")], "RegionKey long, RegionName string, RegionalDirector string, DirectorEmail string"),
        "dim_product": spark.createDataFrame([(1, "P01", "Current", "Deposits", "Personal"), (4, "P04", "Mortgage", "Lending", "Personal"), (9, "P09", "Guaranteed", "Lending", "SME")],
                                             "ProductKey long, ProductID string, ProductName string, ProductGroup string, Segment string"),
        "dim_segment": spark.createDataFrame([("Personal",), ("SME",)], "Segment string"), "dim_brand": spark.createDataFrame([("North",), ("South",)], "Brand string"),
        "bridge_steps": spark.createDataFrame(dims.BRIDGE_STEPS, "Step string, `Order` int"),
        "dim_branch": spark.createDataFrame([(1, 1, "North"), (2, 2, "South")], "BranchKey int, RegionKey long, Brand string"),
        "fact_product_monthly": pnl, "fact_budget_monthly": budget, "fact_branch_monthly": branch,
        "fact_customer_monthly": spark.createDataFrame([(20210331, 1, 10, 4), (20210331, 2, 30, 6)], "DateKey int, RegionKey long, ActiveCustomers long, MonthlyActiveUsers long"),
        "fact_opex_monthly": spark.createDataFrame([(20210131, 1, 4.0, 5.0)], "DateKey int, RegionKey long, ActualAmount double, BudgetAmount double"),
    }
    return Model(tables, LAST, build_registry())


def year(y):
    return Context((one_of("dim_date", "Year", y),))


def one_row(model, ctx, *names):
    row = evaluate(model, ctx, [], names).first()
    return [None if row[n] is None else float(row[n]) for n in names]


def test_balances_are_read_at_the_capped_period_end(model):
    deposits, loans, months = one_row(model, year(2021), "Customer Deposits", "Loan Book", "Months In Period")
    assert (deposits, loans, months) == (800.0, 1080.0, 3.0)  # March, not April


def test_months_after_the_last_actual_repeat_it(model):
    got = {r["YearMonth"]: float(r["Loan Book"]) for r in evaluate(model, year(2021), ["dim_date.YearMonth"], ["Loan Book"]).collect()}
    assert got["2021-03"] == got["2021-04"] == got["2021-12"] == 1080.0 and len(got) == 12


def test_prior_year_balance_and_flow(model):
    # the window Jan-Mar 2021 moves to Jan-Mar 2020; the flow itself also holds April 2021
    py, nii, nii_py = one_row(model, year(2021), "Customer Deposits PY", "NII", "NII PY")
    assert py == 300.0
    assert nii == sum(i + 5 * i - 1 for i in (6, 7, 8, 9)) and nii_py == sum(i + 5 * i - 1 for i in (1, 2, 3))


def test_prior_year_of_a_ratio_is_re_evaluated(model):
    nim, nim_py = one_row(model, year(2021), "NIM", "NIM PY")
    loans, loans_py = (1060 + 1070 + 1080) / 3, (1010 + 1020 + 1030) / 3
    assert nim == pytest.approx(sum(6 * i - 1 for i in (6, 7, 8, 9)) * 12 / 3 / loans)
    assert nim_py == pytest.approx(sum(6 * i - 1 for i in (1, 2, 3)) * 12 / 3 / loans_py)


def test_months_after_the_last_actual_have_no_prior_flow(model):
    got = {r["YearMonth"]: r["NII PY"] for r in evaluate(model, year(2021), ["dim_date.YearMonth"], ["NII PY", "Loan Book"]).collect()}
    assert float(got["2021-03"]) == 17.0 and got["2021-05"] is None  # start after end


def test_replacing_filter_overrides_its_own_column_only(model):
    ctx = year(2021)
    by_group = {r["ProductGroup"]: float(r["Customer Deposits"]) for r in evaluate(model, ctx, ["dim_product.ProductGroup"], ["Customer Deposits"]).collect()}
    assert by_group == {"Deposits": 800.0, "Lending": 800.0}
    by_name = {r["ProductName"]: float(r["Customer Deposits"]) for r in evaluate(model, ctx, ["dim_product.ProductName"], ["Customer Deposits"]).collect()}
    assert by_name == {"Current": 800.0}
    sliced = ctx.keep(one_of("dim_product", "ProductGroup", "Lending"))
    assert one_row(model, sliced, "Customer Deposits", "Loan Book") == [800.0, 1080.0]


def test_unrelated_dimension_leaves_the_measure_unchanged(model):
    rows = {r["Brand"]: r for r in evaluate(model, year(2020), ["dim_brand.Brand"], ["NII", "NII Budget"]).collect()}
    assert float(rows["North"]["NII"]) == 15.0 and float(rows["South"]["NII"]) == 70.0
    assert rows["North"]["NII Budget"] == rows["South"]["NII Budget"] == 15.0


def test_segment_reaches_facts_through_product(model):
    assert one_row(model, year(2021).keep(one_of("dim_segment", "Segment", "SME")), "Loan Book", "NII") == [None, None]


def test_blank_is_not_zero(model):
    none = year(2020).keep(one_of("dim_product", "ProductID", "P09"))
    assert one_row(model, none, "NII", "NII Budget", "NII vs Budget", "Cost Income Ratio", "Net Loans") == [None, None, None, None, None]
    only_budget = year(2020).keep(one_of("dim_product", "ProductID", "P01"))
    assert one_row(model, only_budget, "Loan Book", "ECL Stock", "Customer Deposits")[2] == 500.0


def test_budget_stops_at_the_last_actual_month(model):
    assert one_row(model, year(2021), "NII Budget", "NII Budget Full Year") == [9.0, 12.0]


def test_opening_and_impairment(model):
    opening, stock, charge = one_row(model, year(2021), "ECL Opening", "ECL Stock", "Impairment Charge")
    assert (opening, stock, charge) == (50.0, 80.0, 30.0)


def test_bridge_parts_sum_to_the_change(model):
    py, v, m, o, now, low = one_row(model, year(2021), "NII PY", "Bridge Volume Effect", "Bridge Margin Effect", "Bridge Other", "NII", "Bridge Axis Min")
    assert py + v + m + o == pytest.approx(now) and low == pytest.approx(py * 0.9)
    steps = evaluate(model, year(2021), ["bridge_steps.Order", "bridge_steps.Step"], ["NII Bridge Value"]).orderBy("Order").collect()
    assert [r["Step"] for r in steps] == ["Prior year NII", "Volume", "Margin", "Other"]
    assert [r["NII Bridge Value"] for r in steps] == pytest.approx([py, v, m, o])
    shown = reports.nii_bridge(model, year(2021)).collect()
    assert [r["step"] for r in shown] == ["Prior year NII", "Volume", "Margin"]


def test_stages_and_rates(model):
    s2, rate, cov, dep_rate, beta = one_row(model, year(2021), "Stage 2 Share", "Arrears 90+ Rate", "ECL Coverage", "Customer Rate Deposits", "Loan to Deposit Ratio")
    assert s2 == pytest.approx(180 / 1080) and rate == pytest.approx(50 / 1080) and cov == pytest.approx(80 / 1080)
    assert dep_rate == pytest.approx(0.01) and beta == pytest.approx(1080 / 800)


def test_branches_end_index_and_region_through_branch(model):
    base = replace(model, index_base=date(2020, 1, 31))
    assert one_row(base, year(2021), "Open Branches", "Open Branches Index", "Branch Closures") == [1.0, 50.0, None]
    north = Context((one_of("dim_region", "RegionName", "North"), one_of("dim_date", "YearMonth", "2020-01")))
    assert one_row(base, north, "Open Branches", "Branch Footfall") == [1.0, 5.0]
    assert one_row(base, Context((one_of("dim_date", "YearMonth", "2020-01"),)), "Open Branches", "Branch Closures") == [1.0, 1.0]


def test_context_operations(model):
    f = one_of("dim_product", "ProductGroup", "Lending")
    c = Context((f,)).replace(one_of("dim_product", "ProductGroup", "Deposits"))
    assert len(c.filters) == 1 and len(c.keep(f).filters) == 2 and c.clear("dim_product").filters == ()


def test_gap_in_the_selection_fills_the_prior_window(model):
    ctx = Context((one_of("dim_date", "YearMonth", "2020-12", "2021-03"),))
    nii, py = one_row(model, ctx, "NII", "NII PY")
    assert nii == (6 * 5 - 1) + (6 * 8 - 1) and py == sum(6 * i - 1 for i in (1, 2, 3))


def test_titles_and_labels(model):
    row = evaluate(model, year(2021).keep(one_of("dim_region", "RegionName", "South")), [],
                   ["Selected Region Title", "Selected Period Label", "Data As Of", "Deposits YoY Label", "Deposits YoY Colour", "Loan Book YoY Label"]).first()
    assert row["Selected Region Title"] == "South | Regional Director: Bob"
    assert row["Selected Period Label"] == "Jan 2021 to Mar 2021" and row["Data As Of"] == "31 Mar 2021"
    assert row["Deposits YoY Label"] == "no comparison" and row["Deposits YoY Colour"] == "neutral"
    assert row["Loan Book YoY Label"] == "▲ 4.9% vs PY"


def test_hidden_months_without_new_lending(model):
    got = reports.stage_trend(model, year(2021)).collect()
    assert {r["YearMonth"] for r in got} == {"2021-01", "2021-02", "2021-03", "2021-04"}  # April: zero is not blank


def test_row_scope(model):
    seen = scope.row_scope(model, "bob@x")
    rows = evaluate(seen, year(2021), ["dim_region.RegionName"], ["NII"]).collect()
    assert [r["RegionName"] for r in rows] == ["South"]
    assert one_row(seen, Context((one_of("dim_date", "YearMonth", "2020-01"),)), "Open Branches", "Branch Closures") == [None, 1.0]
    assert scope.row_scope(model, "anyone", executive=True) is model


def test_drill_through_and_slicers(model):
    card = reports.region_scorecard(model, "South")
    assert {r["ProductName"] for r in card["products"].collect()} == {"Mortgage"}
    digital = {r["YearMonth"]: (r["Digital Active Share"], r["Digital Active Share UK"]) for r in card["digital"].collect()}
    assert digital["2021-03"] == (pytest.approx(0.2), pytest.approx(0.25))
    assert [r[0] for r in reports.slicer_values(model)["month"].collect()][:3] == ["Jan", "Feb", "Mar"]


def test_filter_on_measure_table_column(model):
    ctx = Context((Filter("fact_product_monthly", "Brand", lambda c: c == "South"),))
    assert one_row(model, ctx.keep(one_of("dim_date", "YearMonth", "2020-01")), "NII") == [4.0]


def test_registry_is_complete(spark):
    names = [r["name"] for r in measure_catalogue(spark).collect()]
    assert len(names) == len(set(names)) == 201  # measures deployed in the report
    assert len(KPIS) == 19 and {"NII", "Cost of Risk PY", "DQ Severity Colour", "Bridge Axis Min"} <= set(names)


def with_strangers(model):
    """One more row of a region without a dimension row, and one after the calendar."""
    pnl = model.tables["fact_product_monthly"]
    row = pnl.filter("DateKey = 20210228 AND RegionKey = 1")
    more = row.withColumn("RegionKey", F.lit(99).cast("long")).unionByName(row.withColumn("DateKey", F.lit(20300131)))
    return replace(model, tables={**model.tables, "fact_product_monthly": pnl.unionByName(more)})


def test_rows_without_a_dimension_row_count_under_the_blank_member(model):
    strange = with_strangers(model)
    total = evaluate(strange, Context(), [], ["Funding Credit"]).first()[0] if "Funding Credit" in strange.measures else evaluate(strange, Context(), [], ["NII"]).first()[0]
    name = "Funding Credit" if "Funding Credit" in strange.measures else "NII"
    by_region = {r["RegionName"]: r[name] for r in evaluate(strange, Context(), ["dim_region.RegionName"], [name]).collect()}
    assert None in by_region and sum(by_region.values()) == total
    by_month = {r["YearMonth"]: r[name] for r in evaluate(strange, Context(), ["dim_date.YearMonth"], [name]).collect()}
    assert None in by_month and sum(by_month.values()) == total
    north = evaluate(strange, Context((one_of("dim_region", "RegionName", "North"),)), ["dim_region.RegionName"], [name]).collect()
    assert [r["RegionName"] for r in north] == ["North"]


def test_sums_over_products_follow_a_shift_in_time(model):
    from ledgerlake.plans.model import Measure, Shift
    r = dict(model.measures)
    sample = r["Bridge Volume Effect"]
    r["Volume PY"] = replace(sample, node=Shift("Bridge Volume Effect", "py_flow")) if hasattr(sample, "node") else sample
    shifted = replace(model, measures=r)
    assert isinstance(r["Volume PY"], Measure)
    this = evaluate(shifted, year(2020), [], ["Bridge Volume Effect"]).first()[0]
    later = evaluate(shifted, year(2021), [], ["Volume PY", "Bridge Volume Effect"]).first()
    assert later["Volume PY"] == this and later["Volume PY"] != later["Bridge Volume Effect"]


def test_a_grid_over_a_large_further_axis_is_whole(spark, model):
    """No measure covers both axes, and the second has more values than are sent with the plan."""
    steps = spark.range(6000).select(F.format_string("step%d", "id").alias("Step"), F.col("id").cast("int").alias("Order"))
    large = replace(model, tables={**model.tables, "bridge_steps": steps})
    want = {r["Brand"]: r["NII"] for r in evaluate(model, Context(), ["dim_brand.Brand"], ["NII"]).collect()}
    rows = evaluate(large, Context(), ["dim_brand.Brand", "bridge_steps.Step"], ["NII"]).collect()
    assert len(rows) == len({(r["Brand"], r["Step"]) for r in rows}) == 6000 * len(want)
    assert all(r["NII"] == want[r["Brand"]] for r in rows)


def test_sums_over_values_scan_no_more_than_their_totals():
    """A sum over products and the plain totals of the same mart come from one scan."""
    from pyspark.sql import SparkSession
    from workload.adapters import Extracts
    spark = SparkSession.getActiveSession()

    def scans(names):
        df = evaluate(Extracts(spark, "/root/testdata/sf0.001").model, Context(), ["dim_date.Year"], names)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("l_extendedprice") and sum("l_orderkey" in line and "Relation [" in line for line in plan.splitlines())

    alone = scans(["NII", "Balance Months"])
    assert alone > 0 and scans(["NII", "Balance Months", "Balance Months PY", "Bridge Volume Effect", "Bridge Margin Effect", "Bridge Other"]) == alone


def test_days_outside_the_calendar_need_no_second_scan(spark, model, tmp_path):
    """Rows of days that the calendar lacks, or of no day, count under its blank member; the fact is read once for all days."""
    strange = with_strangers(model)
    pnl = strange.tables["fact_product_monthly"]
    undated = pnl.limit(1).withColumns({"DateKey": F.lit(None).cast("int"), "FTPCredit": F.lit(7).cast("decimal(28,2)")})
    pnl.unionByName(undated).write.parquet(str(tmp_path / "pnl"))
    stored = replace(strange, tables={**strange.tables, "fact_product_monthly": spark.read.parquet(str(tmp_path / "pnl"))})
    df = evaluate(stored, Context(), ["dim_date.YearMonth"], ["NII", "NII PY"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("FTPCredit#" in line and "Relation [" in line for line in plan.splitlines()) == 1
    rows = {r["YearMonth"]: r for r in df.collect()}
    money = F.coalesce(F.col("InterestIncome"), F.lit(0)) + F.coalesce(F.col("FTPCredit"), F.lit(0)) - F.coalesce(F.col("FTPCharge"), F.lit(0)) - F.coalesce(F.col("InterestExpense"), F.lit(0))
    facts = spark.read.parquet(str(tmp_path / "pnl"))
    blank = facts.join(stored.tables["dim_date"], "DateKey", "left_anti").agg(F.sum(money)).first()[0]
    assert facts.filter("DateKey IS NULL").count() == 1 and rows[None]["NII"] == blank and rows[None]["NII PY"] is None
    assert sum(r["NII"] for r in rows.values() if r["NII"] is not None) == facts.agg(F.sum(money)).first()[0]


def test_monthly_visuals_of_a_region_from_one_evaluation(model):
    card = reports.region_scorecard(model, "South")
    months = {r["YearMonth"]: r for r in reports.region_months(model, "South").collect()}
    for part, names in reports.REGION_VISUALS.items():
        got = {r["YearMonth"]: r for r in card[part].collect()}
        assert got and all(got[m][n] == row[n] if m in got else row[n] is None for m, row in months.items() for n in names)
        assert set(got) <= set(months)
