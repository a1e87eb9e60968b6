"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs from the raw Parquet files to its result; nothing is cached between queries. The
result is written to Spark's noop sink, so all rows are computed and none is collected.
"""
from __future__ import annotations

import json
import os
import sys
import time

from ledgerlake.session import local_session
from workload import catalogue

QUERIES = [
    "dedupe_latest", "customer_dim", "account_dim", "deposit_fact", "loan_fact", "complaint_fact", "mart_product_pnl",
    "mart_credit_risk", "mart_repricing_shock", "mart_vintage_curve", "mart_customer_monthly", "mart_txn_monthly",
    "nii_by_month_vs_budget", "income_kpis", "cost_of_risk", "bridge_by_year", "story_yearly_nii", "pd_lgd_ead_ecl",
    "all_kpi_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("mart_txn_monthly")  # start the JVM's compilers once, outside the figures
    seconds = {name: round(run(name), 3) for name in QUERIES}
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
