"""A sample of the registered queries against their SQL; check.py runs all of them."""
from pathlib import Path

import duckdb
import pytest

from check import close, rows_of
from workload import catalogue

SF = "/root/testdata/sf0.001"
SAMPLE = ["nii_by_month_vs_budget", "loan_fact", "mart_credit_risk", "mart_customer_monthly", "mart_vintage_curve", "margin_kpis",
          "complaint_fact", "customer_dim", "story_yearly_nii", "rate_forward_fill", "period_replace", "stream_late_upsert",
          "chain_dimension_keys", "chain_customers", "chain_accounts_by_branch", "chain_report", "profit_cards", "customer_cards", "all_kpi_labels",
          "selection_labels", "region_trends"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return c


def test_every_sql_has_a_query():
    assert set(catalogue.SQL) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    cur = con.execute(catalogue.SQL[name])
    cols = [d[0] for d in cur.description]
    got, want = rows_of(df.columns, df.collect()), rows_of(cols, cur.fetchall())
    assert sorted(cols) == sorted(df.columns) and len(got) == len(want)
    assert all(close(p, q) for a, b in zip(got, want) for p, q in zip(a, b))
