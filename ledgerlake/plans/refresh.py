"""Marts kept up to date by what has changed in the tables below them.

Every mart version carries the versions of the facts and of the customer dimension it was made from. The partitions
that differ since then come from comparing manifests; only these months are read from the facts, aggregated with the
same code as a whole build, and replaced in the mart. A customer whose attributes changed touches the months in which
that customer has rows. Where a mart has no version yet, or what it was made from has expired, it is built as a whole.

product and credit risk marts follow their month; repricing also looks back one month, so a changed month touches the
next one too; the customer mart counts from joining on, so a changed customer touches all months from the first one
that sees the change; the transactions mart sums days to months.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import date_key
from ..sources import tables, versions
from . import marts

DEPOSITS, LOANS, DIGITAL, TRANSACTIONS, CUSTOMERS = "fact_deposit_balance", "fact_loan_performance", "fact_digital", "fact_transactions", "dim_customer"


def _month_end(key: int | str) -> date:
    k = int(key)
    first = date(k // 10000, k // 100 % 100, 1)
    return (first + timedelta(31)).replace(day=1) - timedelta(1)


def month_key(key: int | str) -> int:
    """Month-end key of a day key."""
    return int(_month_end(key).strftime("%Y%m%d"))


def following_key(key: int | str) -> int:
    return int(_month_end((_month_end(key) + timedelta(1)).strftime("%Y%m%d")).strftime("%Y%m%d"))


def previous_key(key: int | str) -> int:
    return int((_month_end(key).replace(day=1) - timedelta(1)).strftime("%Y%m%d"))


@dataclass
class Refresh:
    """Incremental marts below one warehouse root."""
    spark: SparkSession
    root: str
    last_actual: date
    first_month: date = marts.DEFAULT_START

    def __post_init__(self) -> None:
        # Inputs are pinned: all marts of one refresh see the same versions, whatever is loaded meanwhile.
        self.pinned = {t: versions.snapshot(self.spark, f"{self.root}/gold/{t}") for t in (DEPOSITS, LOANS, DIGITAL, TRANSACTIONS, CUSTOMERS)}

    # -- reading -------------------------------------------------------------------------------
    def rows(self, table: str, parts: Iterable | None = None) -> DataFrame:
        found = self.pinned[table]
        if found is None:
            raise LookupError(f"gold.{table} has not been loaded")
        return tables.read_table(self.spark, f"{self.root}/gold/{table}", found, parts)

    def changed_parts(self, table: str, version: int | None) -> set[int] | None:
        """Partitions that differ from the version a mart was made from; None if that is no longer known."""
        old = versions.snapshot(self.spark, f"{self.root}/gold/{table}", version) if version is not None else None
        return None if old is None else {int(v) for v in versions.changed(old, self.pinned[table])}

    def changed_customers(self, version: int | None, columns: list[str]) -> DataFrame | None:
        """CustomerKey, was, now (structs of `columns`) of customers that differ; `was` is null for new ones. Reads changed buckets only."""
        path = f"{self.root}/gold/{CUSTOMERS}"
        old = versions.snapshot(self.spark, path, version) if version is not None else None
        if old is None:
            return None
        buckets = versions.changed(old, self.pinned[CUSTOMERS])
        before = tables.read_table(self.spark, path, old, buckets).select("CustomerKey", F.struct(*columns).alias("was"))
        after = self.rows(CUSTOMERS, buckets).select("CustomerKey", F.struct(*columns).alias("now"))
        return after.join(before, "CustomerKey", "left").where(~F.col("now").eqNullSafe(F.col("was")))

    def months_of(self, customers: DataFrame | None, facts: list[str], known: set[int]) -> set[int] | None:
        """Months, other than those in `known`, in which customers that had other attributes before have rows."""
        if customers is None:
            return None
        moved = customers.where("was IS NOT NULL").select("CustomerKey")
        if moved.isEmpty():
            return set()
        found: set[int] = set()
        for table in facts:
            rest = [v for v in self.pinned[table].parts if int(v) not in known | found]
            rows = self.rows(table, rest).select("DateKey", "CustomerKey").join(moved, "CustomerKey", "left_semi")
            found |= {r["DateKey"] for r in rows.select("DateKey").distinct().collect()}  # months
        return found

    # -- writing -------------------------------------------------------------------------------
    def put(self, mart: str, inputs: dict[str, int], touched: set[int] | None, build: Callable[[], DataFrame]) -> versions.Snapshot:
        """Replace the touched months of a mart (None: all of them)."""
        path = f"{self.root}/mart/{mart}"
        base = versions.snapshot(self.spark, path)
        if touched is not None and not touched:
            same = versions.Snapshot(base.version + 1, base.key, base.schema, base.parts, inputs, base.settings)
            return base if base.inputs == inputs else versions.publish(self.spark, path, same)
        rows = build()
        if touched is not None:
            rows = rows.where(F.col("DateKey").isin(sorted(touched)))
        return versions.commit(rows, path, "DateKey", touched, base, inputs)

    def _start(self, mart: str, needs: list[str], **settings: int) -> tuple[dict[str, int], dict[str, int]]:
        """What the mart was last made from, and what it is made from now."""
        missing = [t for t in needs if self.pinned[t] is None]
        if missing:
            raise LookupError(f"gold.{missing[0]} has not been loaded")
        base = versions.snapshot(self.spark, f"{self.root}/mart/{mart}")
        return (base.inputs if base else {}), {**{t: self.pinned[t].version for t in needs}, **settings}

    # -- marts ---------------------------------------------------------------------------------
    def product_pnl(self) -> versions.Snapshot:
        was, now = self._start("fact_product_monthly", [DEPOSITS, LOANS, CUSTOMERS])
        touched = self._follow(was, [DEPOSITS, LOANS], ["Brand", "SubSegment"])
        return self.put("fact_product_monthly", now, touched, lambda: marts.product_pnl(
            self.rows(DEPOSITS, touched), self.rows(LOANS, touched), self.rows(CUSTOMERS)))

    def credit_risk(self) -> versions.Snapshot:
        was, now = self._start("fact_credit_risk_monthly", [LOANS, CUSTOMERS])
        touched = self._follow(was, [LOANS], ["CreditScoreBand"])
        return self.put("fact_credit_risk_monthly", now, touched, lambda: marts.credit_risk(self.rows(LOANS, touched), self.rows(CUSTOMERS)))

    def _follow(self, was: dict[str, int], facts: list[str], attributes: list[str]) -> set[int] | None:
        """Months whose facts changed, or whose customers did."""
        parts = [self.changed_parts(t, was.get(t)) for t in facts]
        if any(p is None for p in parts):
            return None
        touched = set().union(*parts)
        more = self.months_of(self.changed_customers(was.get(CUSTOMERS), attributes), facts, touched)
        return None if more is None else touched | more

    def mortgage_repricing(self, products: DataFrame) -> versions.Snapshot:
        was, now = self._start("fact_mortgage_repricing", [LOANS])
        parts = self.changed_parts(LOANS, was.get(LOANS))
        touched = None if parts is None else parts | {following_key(k) for k in parts}
        reads = None if touched is None else touched | {previous_key(k) for k in touched}
        return self.put("fact_mortgage_repricing", now, touched, lambda: marts.mortgage_repricing(self.rows(LOANS, reads), products, months=touched))

    def customer_monthly(self) -> versions.Snapshot:
        first = int(self.first_month.strftime("%Y%m%d"))
        was, now = self._start("fact_customer_monthly", [DIGITAL, CUSTOMERS], first_month=first)
        parts = self.changed_parts(DIGITAL, was.get(DIGITAL)) if was.get("first_month") == first else None
        low = self._first_month_changed(was.get(CUSTOMERS)) if parts is not None else None
        touched = None
        if parts is not None and low is not None:
            base = versions.snapshot(self.spark, f"{self.root}/mart/fact_customer_monthly")
            months, key, end = set(), month_key(first), month_key(self.last_actual.strftime("%Y%m%d"))
            while key <= end:
                months.add(key)
                key = following_key(key)
            held = {int(v) for v in base.parts}
            touched = {k for k in months if k in parts or k >= low or k not in held} | (held - months)
        return self.put("fact_customer_monthly", now, touched, lambda: marts.customer_monthly(
            self.rows(CUSTOMERS), self.rows(DIGITAL, touched), self.first_month, self.last_actual))

    def _first_month_changed(self, version: int | None) -> int | None:
        """The first month in which a changed customer counts otherwise than before; None: all months, or not known."""
        columns = [*marts.CUSTOMER_GROUP, "OnboardingDate", "ChurnDate"]
        moved = self.changed_customers(version, columns)
        if moved is None:
            return None
        start = F.last_day(F.lit(self.first_month))

        def joined(side: str) -> Column:
            return F.greatest(F.coalesce(F.last_day(f"{side}.OnboardingDate"), start), start)

        stayed = F.col("was.OnboardingDate").eqNullSafe(F.col("now.OnboardingDate"))
        for c in marts.CUSTOMER_GROUP:
            stayed &= F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}"))
        left = F.least(F.last_day("was.ChurnDate"), F.last_day("now.ChurnDate"))
        at = F.when(F.col("was").isNull(), F.least(joined("now"), F.last_day("now.ChurnDate"))).when(stayed, left).otherwise(start)
        low, new = moved.agg(F.min(date_key(at)), F.count(F.lit(1))).first()
        if not new:
            return 99999999
        # A group that appears has a row in every month, a group that is gone has none.
        group = [F.coalesce(F.col(f"now.{c}"), F.lit("SME")).alias(c) if c == "AgeBand" else F.col(f"now.{c}").alias(c) for c in marts.CUSTOMER_GROUP]
        mart = versions.snapshot(self.spark, f"{self.root}/mart/fact_customer_monthly")
        one = tables.read_table(self.spark, f"{self.root}/mart/fact_customer_monthly", mart, [max(mart.parts)] if mart.parts else [])
        same = F.lit(True)
        asked = moved.select(*group).distinct()
        known = one.select(*[F.col(c).alias(f"k_{c}") for c in marts.CUSTOMER_GROUP]).distinct()
        for c in marts.CUSTOMER_GROUP:
            same &= F.col(c).eqNullSafe(F.col(f"k_{c}"))
        return None if not asked.join(known, same, "left_anti").isEmpty() else low

    def transactions_monthly(self) -> versions.Snapshot:
        was, now = self._start("fact_transactions_monthly", [TRANSACTIONS])
        days = self.changed_parts(TRANSACTIONS, was.get(TRANSACTIONS))
        touched = None if days is None else {month_key(d) for d in days}
        reads = None if touched is None else [d for d in self.pinned[TRANSACTIONS].parts if month_key(d) in touched]
        return self.put("fact_transactions_monthly", now, touched, lambda: marts.transactions_monthly(self.rows(TRANSACTIONS, reads)))

    def run(self, products: DataFrame) -> dict[str, versions.Snapshot]:
        return {
            "fact_product_monthly": self.product_pnl(), "fact_credit_risk_monthly": self.credit_risk(),
            "fact_mortgage_repricing": self.mortgage_repricing(products), "fact_customer_monthly": self.customer_monthly(),
            "fact_transactions_monthly": self.transactions_monthly(),
        }
