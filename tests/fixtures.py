"""A tiny landing zone with one case of every known defect."""
from __future__ import annotations

import json
from datetime import date, datetime

from ledgerlake.sources.schemas import source_schema

LAST_ACTUAL = date(2020, 3, 31)
MONTHS = [date(2020, 1, 31), date(2020, 2, 29), date(2020, 3, 31)]


def ts(*a):
    return datetime(*a)


def customer(cid, region, postcode, onboarded, churned=None, segment="Personal", age="18-34", brand="North"):
    return (cid, segment, "Mass", brand, region, "Town", postcode, age, None, None, None, "Good", onboarded, "Branch",
            None, "B1", churned, "Active")


def deposit(acc, m, product, avg, eom, rate=1.0):
    return (acc, m, product, avg, eom, rate, 2.0, 1.0, 3.0, 0.5)


def loan(acc, m, product, bal, dpd, bucket, stage, status="Open", wo=0.0, pay=100.0, rate=3.0, transfer=False, end=None, ltv=0.5, new=0.0):
    return (acc, m, product, "2y Fixed", bal, None, rate, 1.0, 10.0, 4.0, 1.0, pay, dpd, bucket, stage, 0.01, 0.4, bal, 5.0,
            wo, 0.0, False, end, False, transfer, ltv, new, status)


REFERENCE = {
    "regions": [("NE", "North East", "England", "Ann", "ann@bank.example"), ("SC", "Scotland", "Scotland", "Bob", "bob@bank.example")],
    "products": [("P01", "Current", "Deposits", "Personal", False, False), ("P02", "Savings", "Deposits", "Personal", False, False),
                 ("P04", "Mortgage", "Lending", "Personal", True, False), ("P09", "Guaranteed", "Lending", "SME", False, True)],
    "channels": [("CH01", "Branch"), ("CH02", "App"), ("CH06", "Auto")],
    "complaint_categories": [("C1", "Fees", "Banking"), ("C2", "Service", "Banking")],
    "uk_bank_holidays": [(date(2020, 1, 1),), (date(2020, 1, 1),)],
    "branches": [("B1", "Main", "North", "ne", "Town", 54.9, -1.6, "Full", ts(2000, 1, 1), None),
                 ("B2", "High", "North", "SC", "City", 55.9, -3.2, "Full", ts(2000, 1, 1), ts(2020, 2, 29))],
}
MASTER = {
    "customers": [
        customer("C1", "NE", "NE1 1AA", ts(2019, 5, 1)), customer("C1", "NE", "NE1 1AA", ts(2019, 5, 1)),
        customer("C2", None, "ne12ab", ts(2020, 2, 10), ts(2020, 3, 15)), customer("C3", "sc", "EH1 1AA", ts(2030, 2, 10)),
        customer("C4", "SC", "EH2 1AA", None, ts(2020, 2, 2), "SME", None)],
    "accounts": [
        ("A1", "C1", "P01", "B1", ts(2019, 5, 1), None, "Open", None, None, None, None),
        ("A1", "C1", "P01", "B1", ts(2019, 5, 1), None, "Open", None, None, None, None),
        ("A2", "C2", "P02", None, ts(2020, 2, 10), None, "Open", None, None, None, None),
        ("A3", "C3", "P04", "B2", ts(2020, 1, 5), None, "Open", 100000.0, 300.0, 3.0, 0.75),
        ("A4", "C4", "P09", None, ts(2020, 1, 7), None, "Open", 5000.0, 60.0, 2.5, None),
        ("A5", "C4", "P09", None, ts(2020, 2, 7), None, "Open", 7000.0, 60.0, 2.5, None)],
}
FINANCE = {
    "budget_monthly": [("NE", m, "P01", 100.0, 1.0, 0.5, 0.0) for m in [*MONTHS, date(2020, 4, 30)]],
    "opex_monthly": [("NE", m, "Staff", 10.0 if m <= LAST_ACTUAL else None, 11.0) for m in [*MONTHS, date(2020, 4, 30)]],
}


def monthly(m):
    """Fact extracts of one month."""
    first, second, third = MONTHS
    dep = [deposit("A1", m, "P01", -50.0, 100.0), deposit("A1", m, "P01", -50.0, 100.0), deposit("GONE", m, "P01", 9.0, 9.0)]
    if m > first:
        dep.append(deposit("A2", m, "P02", -200.0, 200.0))
    loans = [loan("A3", m, "P04", 90000.0, 0, "Current", 1.0 if m != second else None, rate=3.0 if m < third else 4.5,
                  pay=500.0 if m < third else 600.0, transfer=m == third, end=date(2022, 1, 31), new=90000.0 if m == first else 0.0),
             loan("A4", m, "P09", 4000.0 if m < third else 0.0, 95 if m >= second else 0, "90+" if m >= second else "Current", None,
                  status="Open" if m < third else "Written Off", wo=0.0 if m < third else 4000.0, ltv=None)]
    if m > first:
        loans.append(loan("A5", m, "P09", 7000.0, 31, "30-59", None, ltv=None))
    day = m.replace(day=10)
    complaints = [(f"K{m.month}", "C1", ts(m.year, m.month, 5), ts(m.year, m.month, 25), "C1", "Delay", "Phone", True, 10.0, False),
                  (f"D{m.month}", "C1", ts(m.year, m.month, 5), ts(m.year, m.month, 1), "C2", "Delay", "Phone", False, 0.0, False),
                  (f"O{m.month}", "C2", ts(m.year, m.month, 5), None, "C1", "Delay", "Phone", False, 0.0, True)]
    if m == second:  # arrives a month late
        complaints.append(("L1", "C1", ts(2020, 1, 30), ts(2020, 2, 20), "C1", "Delay", "Phone", True, 1.0, False))
    return {
        "deposit_balance_monthly": dep, "loan_performance_monthly": loans,
        "digital_activity_monthly": [("C1", m, 3, 5, True, 2), ("NOBODY", m, 1, 1, True, 1)],
        "transactions_daily": [(day, "NE", "P01", "CH02", "Card", 3, 30.0), (day, " ne", "P01", "CH02", "Card", 2, 20.0),
                               (day, "SC", "P01", "CH01", "Cash", 1, 5.0)],
        "branch_activity_monthly": [("B1", m, 100, 10, 4.5, False), ("B1", m, 120, 9, 4.0, False),
                                    ("B2", m, 50, 5, 2.0, m == second)] if m <= second else [("B1", m, 100, 10, 4.5, False)],
        "complaints": complaints,
        "fraud_cases": [(f"F{m.month}", "C1", ts(m.year, m.month, 3), "APP Scam", "App", 100.0, 60.0, 10.0, "Closed")],
    }


FOLDERS = {
    "regions": "reference", "products": "reference", "channels": "reference", "complaint_categories": "reference",
    "uk_bank_holidays": "reference", "branches": "network", "customers": "corebanking", "accounts": "corebanking",
    "deposit_balance_monthly": "corebanking", "loan_performance_monthly": "lending", "digital_activity_monthly": "digital",
    "transactions_daily": "payments", "branch_activity_monthly": "network", "complaints": "conduct", "fraud_cases": "conduct",
    "budget_monthly": "finance", "opex_monthly": "finance",
}


def write_landing(spark, root, months=MONTHS):
    def put(table, data, sub=""):
        spark.createDataFrame(data, source_schema(table)).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/{FOLDERS[table]}/{table}{sub}")

    for tables in (REFERENCE, MASTER, FINANCE):
        for table, data in tables.items():
            put(table, data)
    for m in months:
        for table, data in monthly(m).items():
            put(table, data, f"/year={m.year}/month={m.month:02d}")
    spark.createDataFrame([("2020-01-03", "0.75"), ("2020-02-15", "0.50"), ("2020-03-31", "0.10")],
                          "rate_date string, bank_rate string").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/external/bank_rate_fallback")
    return root


def write_manifest(path):
    files = [{"source": "a", "table": "t", "file": f"f{i}", "rows": 10, "bytes": 500_000} for i in range(3)]
    path.write_text(json.dumps({"scale": 1.0, "total_rows": 30, "total_bytes": 1_500_000, "files": files}))
