"""Session settings."""
from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that change plans, not results. Broadcast joins are left to the size check of
# spark.sql.autoBroadcastJoinThreshold and of AQE; no plan in this package forces one on a
# table that grows with the data. The size check goes by bytes of files: a dimension of a few
# bytes per row stays below Spark's 10 MB with a million rows, which the driver holds as some
# 100 MB of hash table, once per join of the plan. AQE goes by bytes of rows.
# Shuffled bytes are compressed too: a task that reads 64 MB of them, Spark's advisory size, sorts
# and counts over 600 MB of rows; one that reads 16 MB, a quarter of that.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the next operator would have to shuffle once more
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Settings a session takes only when it starts. Call sites of every column expression are not
# recorded: plans here are large and built by code.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def get_session(app: str = "ledgerlake", **extra: str) -> SparkSession:
    """A session with the package settings; on a cluster pass master and sizes as usual."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**START_SETTINGS, **SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | None = None, **extra: str) -> SparkSession:
    """Single-process session for tests and the benchmark; the web page stays off."""
    n = cores or os.cpu_count() or 8
    return get_session(
        "ledgerlake-local",
        **{
            "spark.master": f"local[{n}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": str(n),
            "spark.driver.memory": "12g",
            **extra,
        },
    )
