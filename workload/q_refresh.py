"""Marts brought up to date after a second delivery: their rows equal those of marts built at once."""
from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, functions as F

from ledgerlake.plans.refresh import CUSTOMERS, DEPOSITS, DIGITAL, LOANS, TRANSACTIONS, Refresh
from ledgerlake.sources import tables
from . import q_marts
from .adapters import FIRST_MONTH, LAST_ACTUAL
from .registry import query, work_folder

#: The first delivery ends here, and holds half of this month, which the second one corrects.
FIRST_ENDS, CORRECTED = 20001231, 19970331


def _facts(x, table: str) -> DataFrame:
    return {DEPOSITS: lambda: x.deposits, LOANS: lambda: x.loans, DIGITAL: lambda: x.digital, TRANSACTIONS: lambda: x.transactions}[table]()


def _two_deliveries(x, facts: list[str], mart: str, refresh: Callable[[Refresh], object], changes: dict, split: dict[str, int] | None = None):
    """A mart built over a first delivery and refreshed over a second one.

    Customers who join after the first delivery are not in it, those who leave in its last months have not left yet,
    and a few have other attributes (`changes`).
    """
    root = work_folder(x.spark)
    now = x.dim_customer_full
    few = F.pmod(F.col("CustomerKey"), F.lit(500)) == 1
    was = now.where(F.coalesce(F.col("OnboardingDate") < "2001-01-01", F.lit(True)))
    was = was.withColumn("ChurnDate", F.when(F.col("ChurnDate") < "2000-07-01", F.col("ChurnDate")))
    was = was.withColumns({c: F.when(few, F.lit(v)).otherwise(F.col(c)) for c, v in changes.items()})
    for customers, first in ((was, True), (now, False)):
        tables.merge(customers, f"{root}/gold/{CUSTOMERS}", ["CustomerID"])
        for table in facts:
            rows, end = _facts(x, table), (split or {}).get(table, FIRST_ENDS)
            half = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
            day, fixed = F.col("DateKey"), F.col("DateKey") == CORRECTED
            part = rows.where((day <= end) & (~fixed | half)) if first else rows.where((day > end) | fixed)
            tables.replace_periods(part, f"{root}/gold/{table}")
        refresh(Refresh(x.spark, root, LAST_ACTUAL, FIRST_MONTH))
    return SimpleNamespace(model=SimpleNamespace(tables={mart: tables.read_table(x.spark, f"{root}/mart/{mart}")}))


@query("refresh_product_pnl", like="mart_product_pnl")
def refresh_product_pnl(x):
    return q_marts.mart_product_pnl(_two_deliveries(x, [DEPOSITS, LOANS], "fact_product_monthly", Refresh.product_pnl, {"Brand": "Before"}))


@query("refresh_credit_risk", like="mart_credit_risk")
def refresh_credit_risk(x):
    return q_marts.mart_credit_risk(_two_deliveries(x, [LOANS], "fact_credit_risk_monthly", Refresh.credit_risk, {"CreditScoreBand": "Before"}))


@query("refresh_repricing", like="mart_repricing_shock")
def refresh_repricing(x):
    return q_marts.mart_repricing_shock(_two_deliveries(x, [LOANS], "fact_mortgage_repricing", lambda r: r.mortgage_repricing(x.dim_product), {}))


@query("refresh_customers", like="mart_customer_monthly")
def refresh_customers(x):
    return q_marts.mart_customer_monthly(_two_deliveries(x, [DIGITAL], "fact_customer_monthly", Refresh.customer_monthly, {}))


@query("refresh_transactions", like="mart_txn_monthly")
def refresh_transactions(x):
    """Days up to the twentieth, then the others: one month's sums are made anew from all of its days."""
    return q_marts.mart_txn_monthly(_two_deliveries(x, [TRANSACTIONS], "fact_transactions_monthly", Refresh.transactions_monthly, {}, {TRANSACTIONS: 20240120}))
