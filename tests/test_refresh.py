"""Incremental marts: same rows as a whole build, and nothing read or written beside what changed."""
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import marts, refresh
from ledgerlake.plans.load import Warehouse
from ledgerlake.plans.refresh import Refresh, following_key, month_key, previous_key
from ledgerlake.sources import tables, versions
from .fixtures import LAST_ACTUAL, MONTHS, write_landing

FOLLOWED = ["fact_product_monthly", "fact_credit_risk_monthly", "fact_mortgage_repricing", "fact_customer_monthly", "fact_transactions_monthly"]


def mart_rows(spark, root, mart):
    df = tables.read_table(spark, f"{root}/mart/{mart}")
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def spoil(root, snap):
    """Make every file of a version unreadable; returns a function that mends them."""
    files = [f for folders in snap.parts.values() for folder in folders for f in Path(root, "data", folder).glob("*.parquet")]
    held = {f: f.read_bytes() for f in files}
    for f in files:
        f.write_bytes(b"not a Parquet file")
    return lambda: [f.write_bytes(b) for f, b in held.items()]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two months loaded and their marts built; the third month's facts loaded, marts not refreshed yet."""
    base = tmp_path_factory.mktemp("refresh")
    w = Warehouse(spark, write_landing(spark, str(base / "landing")), str(base / "wh"), LAST_ACTUAL)
    for group in (1, 2):
        w.stage_group(group, "FULL")
    w.load_dimensions()
    for _ in MONTHS[:2]:
        for table, target in w.stage_group(3, "INCREMENTAL"):
            w.load_fact(table, target)
    first = Refresh(spark, w.root, LAST_ACTUAL, w.first_month).run(w.read("gold", "dim_product"))
    for table, target in w.stage_group(3, "INCREMENTAL"):
        w.load_fact(table, target)
    return w, first


def test_a_month_reads_and_writes_its_own_partitions(spark, loaded):
    w, first = loaded
    old = {t: versions.snapshot(spark, w.path("gold", t), 1) for t in ("fact_deposit_balance", "fact_transactions", "fact_digital")}
    mend = [spoil(w.path("gold", t), snap) for t, snap in old.items()]
    r = Refresh(spark, w.root, LAST_ACTUAL, w.first_month)
    try:
        with pytest.raises(Exception, match="not a Parquet file|Parquet|PARQUET"):
            r.rows("fact_deposit_balance").select(F.sum("EOMBalance")).collect()  # a whole read would meet the spoilt files
        again = {"fact_product_monthly": r.product_pnl(), "fact_transactions_monthly": r.transactions_monthly(), "fact_customer_monthly": r.customer_monthly()}
    finally:
        for f in mend:
            f()
    last = int(MONTHS[2].strftime("%Y%m%d"))
    for mart, snap in again.items():
        assert versions.changed(first[mart], snap) == {str(last)}, mart
    r.credit_risk()
    rep = r.mortgage_repricing(w.read("gold", "dim_product"))
    assert {int(v) for v in versions.changed(first["fact_mortgage_repricing"], rep)} <= {last, following_key(last)}


def test_equal_to_a_whole_build(spark, loaded, tmp_path):
    w, _ = loaded
    Refresh(spark, w.root, LAST_ACTUAL, w.first_month).run(w.read("gold", "dim_product"))
    g = lambda t: w.read("gold", t)
    whole = {
        "fact_product_monthly": marts.product_pnl(g("fact_deposit_balance"), g("fact_loan_performance"), g("dim_customer")),
        "fact_credit_risk_monthly": marts.credit_risk(g("fact_loan_performance"), g("dim_customer")),
        "fact_mortgage_repricing": marts.mortgage_repricing(g("fact_loan_performance"), g("dim_product")),
        "fact_customer_monthly": marts.customer_monthly(g("dim_customer"), g("fact_digital"), w.first_month, LAST_ACTUAL),
        "fact_transactions_monthly": marts.transactions_monthly(g("fact_transactions")),
    }
    for mart, df in whole.items():
        assert mart_rows(spark, w.root, mart) == sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect()))), mart
    before = {m: versions.snapshot(spark, w.path("mart", m)).version for m in FOLLOWED}
    Refresh(spark, w.root, LAST_ACTUAL, w.first_month).run(w.read("gold", "dim_product"))
    assert {m: versions.snapshot(spark, w.path("mart", m)).version for m in FOLLOWED} == before  # nothing changed, nothing written


def test_a_customer_with_new_attributes_moves_through_all_months(spark, loaded):
    w, _ = loaded
    Refresh(spark, w.root, LAST_ACTUAL, w.first_month).run(w.read("gold", "dim_product"))
    path = w.path("gold", "dim_customer")
    one = tables.read_table(spark, path).where("CustomerID = 'C1'").withColumn("Brand", F.lit("Other"))
    tables.merge(one, path, ["CustomerID"])
    r = Refresh(spark, w.root, LAST_ACTUAL, w.first_month)
    r.run(w.read("gold", "dim_product"))
    for mart, whole in (("fact_product_monthly", marts.product_pnl(r.rows("fact_deposit_balance"), r.rows("fact_loan_performance"), r.rows("dim_customer"))),
                        ("fact_customer_monthly", marts.customer_monthly(r.rows("dim_customer"), r.rows("fact_digital"), w.first_month, LAST_ACTUAL))):
        got = mart_rows(spark, w.root, mart)
        assert any("Other" in x for x in got) and got == sorted(map(str, (tuple(x) for x in whole.select(*sorted(whole.columns)).collect())))


def test_lost_history_means_a_whole_build(spark, loaded):
    w, _ = loaded
    Refresh(spark, w.root, LAST_ACTUAL, w.first_month).run(w.read("gold", "dim_product"))
    path = w.path("gold", "fact_transactions")
    for _ in range(4):  # the version the mart was made from expires
        tables.replace_periods(tables.read_table(spark, path), path)
    r = Refresh(spark, w.root, LAST_ACTUAL, w.first_month)
    assert r.changed_parts("fact_transactions", versions.snapshot(spark, w.path("mart", "fact_transactions_monthly")).inputs["fact_transactions"]) is None
    before = mart_rows(spark, w.root, "fact_transactions_monthly")
    r.transactions_monthly()
    assert mart_rows(spark, w.root, "fact_transactions_monthly") == before


def test_month_keys():
    assert month_key(20240105) == 20240131 and following_key("20231231") == 20240131 and previous_key(20240331) == 20240229
    assert refresh._month_end(20200229) == date(2020, 2, 29)
