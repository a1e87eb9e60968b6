from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import facts
from ledgerlake.plans.load import Warehouse
from ledgerlake.plans.model import Context, evaluate, one_of
from .fixtures import LAST_ACTUAL, MONTHS, write_landing


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("warehouse")
    w = Warehouse(spark, write_landing(spark, str(base / "landing")), str(base / "wh"), LAST_ACTUAL)
    counts = w.load_all("FULL")
    return w, {r["mart_table"]: r["row_count"] for r in counts.collect()}


def dq(w):
    return {(r["table_name"], r["check_name"], r["period_month_end"]): (r["affected_rows"], r["total_rows"]) for r in w.read("ops", "dq_results").collect()}


def test_dimensions(loaded):
    w, _ = loaded
    cust = {r["CustomerID"]: r for r in w.read("gold", "dim_customer").collect()}
    regions = {r["RegionCode"]: r["RegionKey"] for r in w.read("gold", "dim_region").collect()}
    assert set(cust) == {"C1", "C2", "C3", "C4"}
    assert cust["C2"]["RegionKey"] == regions["NE"] and cust["C2"]["DQFlag"] == "Region derived from postcode"
    assert cust["C3"]["OnboardingDate"] is None and cust["C3"]["DQFlag"] == "Future onboarding date removed"
    assert cust["C3"]["TenureBand"] == "Unknown" and cust["C1"]["TenureBand"] == "< 1 year"
    assert cust["C2"]["PostcodeSector"] == "NE1 2"
    branch = {r["BranchID"]: r["BranchStatus"] for r in w.read("gold", "dim_branch").collect()}
    assert branch == {"B1": "Open", "B2": "Closed"}
    days = w.read("gold", "dim_date")
    assert days.count() == 3287 and days.filter("IsUKBankHoliday").count() == 1
    acc = {r["AccountID"]: r for r in w.read("gold", "dim_account").collect()}
    assert acc["A3"]["OriginationLTVBand"] == "60-75%" and acc["A4"]["VintageQuarter"] == "2020 Q1"


def test_quality_log(loaded):
    log = dq(loaded[0])
    assert log[("customers", "Duplicate customer rows removed", None)] == (1, 5)
    assert log[("customers", "Missing region code", None)] == (1, 4)
    assert log[("customers", "Non-standard postcode format", None)] == (1, 4)
    assert log[("customers", "Onboarding date in the future", None)] == (1, 4)
    assert log[("accounts", "Duplicate account rows removed", None)] == (1, 6)
    for m in MONTHS:
        total = 3 if m == MONTHS[0] else 4
        assert log[("FactDepositBalanceMonthly", "Duplicate rows removed", m)] == (1, total)
        assert log[("FactDepositBalanceMonthly", "Orphan rows (account not in DimAccount)", m)] == (1, total)
        assert log[("FactDigitalMonthly", "Orphan rows (customer not in DimCustomer)", m)] == (1, 2)
    assert ("FactDepositBalanceMonthly", "Negative savings balance (sign error)", MONTHS[0]) not in log  # nothing to log
    assert log[("FactDepositBalanceMonthly", "Negative savings balance (sign error)", MONTHS[1])] == (1, 4)
    assert log[("FactLoanPerformanceMonthly", "Missing IFRS 9 stage", MONTHS[1])] == (3, 3)
    assert log[("FactTransactionDaily", "Lower-case region code", None)] == (3, 9)
    assert log[("FactComplaint", "Resolved date before received date", None)] == (3, 10)
    assert log[("FactComplaint", "Late-arriving records", None)] == (1, 10)


def test_facts(loaded):
    w, _ = loaded
    dep = {(r["DateKey"], r["AvgBalance"]): r["EOMBalance"] for r in w.read("gold", "fact_deposit_balance").collect()}
    assert len(dep) == 5 and (20200131, -50) in dep and (20200229, 200) in dep  # only savings signs are repaired
    loans = {(r["DateKey"], int(r["BalanceEOM"])): r["IFRS9Stage"] for r in w.read("gold", "fact_loan_performance").collect()}
    assert loans[(20200229, 90000)] == 1 and loans[(20200229, 4000)] == 3 and loans[(20200229, 7000)] == 2
    txn = w.read("gold", "fact_transactions").groupBy("TxnType").agg(F.sum("TxnCount").alias("n"), F.count("*").alias("r")).orderBy("TxnType")
    assert [tuple(r) for r in txn.collect()] == [("Card", 15, 3), ("Cash", 3, 3)]
    br = {(r["DateKey"], r["Footfall"]) for r in w.read("gold", "fact_branch_activity").collect()}
    assert (20200131, 120) in br and len(br) == 5
    co = {r["ComplaintID"]: r for r in w.read("gold", "fact_complaints").collect()}
    assert co["D1"]["ResolvedDateKey"] is None and co["D1"]["IsOpen"] is False and co["D1"]["IsResolvedWithin8Weeks"] is None
    assert co["O1"]["IsOpen"] is True and co["K1"]["IsResolvedWithin8Weeks"] is True and co["L1"]["ReceivedDateKey"] == 20200130
    rate = {r["DateKey"]: float(r["BankRate"]) for r in w.read("gold", "fact_bank_rate_daily").collect()}
    assert rate[20200101] == 0.75 and rate[20200214] == 0.75 and rate[20200330] == 0.5 and len(rate) == 91


def test_marts(loaded):
    w, counts = loaded
    pnl = w.read("mart", "fact_product_monthly")
    fact = w.read("gold", "fact_deposit_balance").agg(F.sum("EOMBalance")).first()[0] + w.read("gold", "fact_loan_performance").agg(F.sum("BalanceEOM")).first()[0]
    assert pnl.agg(F.sum("EOMBalance")).first()[0] == fact
    assert counts["fact_mortgage_maturity"] == 1
    rep = w.read("mart", "fact_mortgage_repricing").collect()
    assert [(r["Repricings"], int(r["OldPayment"]), int(r["NewPayment"])) for r in rep] == [(1, 500, 600)]
    curve = {r["MonthsOnBook"]: (r["Loans"], r["DefaultedLoans"], int(r["DefaultedAmount"])) for r in w.read("mart", "fact_bbl_vintage").collect()}
    assert curve == {0: (2, 0, 0), 1: (2, 1, 5000), 2: (1, 1, 5000)}
    cust = w.read("mart", "fact_customer_monthly").groupBy("DateKey").agg(
        F.sum("ActiveCustomers").alias("a"), F.sum("NewCustomers").alias("n"), F.sum("ChurnedCustomers").alias("c"),
        F.sum("DigitalRegistered").alias("d")).orderBy("DateKey")
    assert [tuple(r) for r in cust.collect()] == [(20200131, 3, 0, 0, 1), (20200229, 3, 1, 1, 1), (20200331, 2, 0, 1, 1)]


def test_model_over_the_warehouse(loaded):
    w, _ = loaded
    m = w.model()
    ctx = Context((one_of("dim_date", "Year", 2020),))
    row = evaluate(m, ctx, [], ["Loan Book", "Customer Deposits", "NII", "NII Budget", "NII Budget Full Year", "Open Branches", "Months In Period",
                                "Complaints", "Resolved Within 8 Weeks %", "Payment Shock %", "Tables Monitored", "Data Freshness",
                                "Selected Region Title", "Bank Rate Period End"]).first()
    assert float(row["Loan Book"]) == 97000 and float(row["Customer Deposits"]) == 300
    assert float(row["NII Budget"]) == 3 and float(row["NII Budget Full Year"]) == 4
    assert row["Open Branches"] == 1 and row["Months In Period"] == 3 and row["Complaints"] == 10
    assert row["Resolved Within 8 Weeks %"] == 1.0 and row["Payment Shock %"] == pytest.approx(0.2)
    assert row["Data Freshness"] == "Loaded to Mar 2020" and row["Selected Region Title"] == "All UK regions"
    assert row["Bank Rate Period End"] == pytest.approx(0.001) and row["Tables Monitored"] > 20


def test_second_load_changes_nothing(loaded):
    w, counts = loaded
    before = {t: w.read("gold", t).count() for t in ("dim_customer", "dim_account", "fact_deposit_balance", "fact_complaints", "fact_transactions")}
    keys = {r["CustomerID"]: r["CustomerKey"] for r in w.read("gold", "dim_customer").collect()}
    again = {r["mart_table"]: r["row_count"] for r in w.load_all("FULL").collect()}
    assert {t: w.read("gold", t).count() for t in before} == before
    assert {r["CustomerID"]: r["CustomerKey"] for r in w.read("gold", "dim_customer").collect()} == keys
    skip = "platform_table_stats"
    assert {k: v for k, v in again.items() if k != skip} == {k: v for k, v in counts.items() if k != skip}


def test_incremental_takes_the_next_month(spark, tmp_path):
    zone = write_landing(spark, str(tmp_path / "landing"))
    w = Warehouse(spark, zone, str(tmp_path / "wh"), LAST_ACTUAL)
    for group in (1, 2):
        w.stage_group(group, "FULL")
    w.load_dimensions()
    for n, month in enumerate(MONTHS, 1):
        for table, target in w.stage_group(3, "INCREMENTAL"):
            w.load_fact(table, target)
        marks = {r["table_name"]: r["last_loaded_month_end"] for r in w.watermark().collect()}
        assert marks["deposit_balance_monthly"] == month
        assert w.read("gold", "fact_deposit_balance").select("DateKey").distinct().count() == n
    assert w.read("gold", "fact_complaints").count() == 10
    assert w.stage_group(3, "INCREMENTAL") == []  # nothing has arrived for the next month
    states = {r["status"] for r in w.read("ops", "run_log").collect()}
    assert states == {"Succeeded", "Skipped"}


def test_no_valid_rate_raises(spark):
    bad = spark.createDataFrame([("n/a", "x", "BoE API")], "rate_date string, bank_rate string, source_system string")
    with pytest.raises(facts.NoValidRate):
        facts.policy_rate_daily(bad)


def test_preferred_source_wins(spark):
    both = spark.createDataFrame([("2020-01-02", "1.0", "Fallback"), ("2020-01-02", "2.0", "BoE API"), ("bad", "2.0", "BoE API"),
                                  ("2020-01-03", "12345678", "BoE API")], "rate_date string, bank_rate string, source_system string")
    got = facts.valid_rates(both).collect()
    assert [(r["Date"], float(r["BankRate"]), r["SourceSystem"]) for r in got] == [(date(2020, 1, 2), 2.0, "BoE API")]


def test_the_calendar_covers_what_facts_carry(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "none"), str(tmp_path / "wh"), LAST_ACTUAL)
    from ledgerlake.plans import dimensions as dims
    from ledgerlake.sources import tables
    tables.full_reload(dims.date_dimension(spark, None, date(2020, 1, 1), date(2020, 12, 31)), w.path("gold", "dim_date"))
    tables.full_reload(spark.createDataFrame([], "holiday_date date"), w.path("stg", "uk_bank_holidays"))
    tables.replace_periods(spark.createDataFrame([(20180630, 1.0), (20330131, 2.0)], "DateKey int, v double"), w.path("gold", "fact_branch_activity"))
    w.cover_facts()
    assert w.read("gold", "dim_date").agg(F.min("Date"), F.max("Date")).first()[:] == (date(2018, 1, 1), date(2033, 12, 31))


def test_vintages_have_no_last_month_on_book(spark):
    from ledgerlake.plans import marts
    accounts = spark.createDataFrame([(1, 9, "2010 Q1", date(2010, 1, 15), 100.0)], "AccountKey long, ProductKey long, VintageQuarter string, OpenDate date, OriginalAmount double")
    accounts = accounts.withColumn("OriginalAmount", F.col("OriginalAmount").cast("decimal(18,2)"))
    loans = spark.createDataFrame([], "AccountKey long, ProductKey long, DateKey int, ArrearsBucket string, AccountStatus string")
    products = spark.createDataFrame([(9, "P09")], "ProductKey long, ProductID string")
    got = marts.loan_vintage(accounts, loans, products, date(2020, 3, 31)).collect()
    assert sorted(r["MonthsOnBook"] for r in got) == list(range(123))


def test_full_and_monthly_loads_end_with_the_newest_delivery(spark):
    rows = [("c1", "2020/01/a.parquet", None), ("c1", "2020/02/a.parquet", date(2020, 2, 3))]
    staged = spark.createDataFrame(rows, "complaint_id string, _source_file string, resolved_date date")
    whole = facts.newest_delivery(staged, "complaint_id").collect()
    assert [r["resolved_date"] for r in whole] == [date(2020, 2, 3)]


def test_a_load_that_dies_goes_on_with_the_step_that_failed(spark, tmp_path, loaded):
    w = Warehouse(spark, write_landing(spark, str(tmp_path / "landing")), str(tmp_path / "wh"), LAST_ACTUAL)
    done, load_fact = [], w.load_fact

    def dies(table, target):
        if target == "transactions" and "transactions" not in done:
            done.append(target)
            raise RuntimeError("lost")
        done.append(target)
        load_fact(table, target)

    w.load_fact = dies
    with pytest.raises(RuntimeError) as failed:
        w.load_all("FULL", attempt="night")
    assert "attempt='night'" in failed.value.__notes__[0]
    before = list(done)
    counts = {r["mart_table"]: r["row_count"] for r in w.load_all("FULL", attempt="night").collect()}
    assert done[len(before):] == ["transactions", "branch_activity", "complaints", "fraud"]  # finished steps do not run again
    undisturbed, whole = loaded
    skip = "platform_table_stats"
    assert {k: v for k, v in counts.items() if k != skip} == {k: v for k, v in whole.items() if k != skip}
    for t in ("fact_deposit_balance", "fact_transactions", "fact_complaints", "dim_customer"):
        assert sorted(map(str, (tuple(r) for r in w.read("gold", t).collect()))) == sorted(map(str, (tuple(r) for r in undisturbed.read("gold", t).collect()))), t
