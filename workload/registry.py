"""Registration of queries: a Spark function over the extracts and, where there is one, its SQL."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.session import SETTINGS
from .adapters import Extracts
from .sql import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir.

    A temporary folder stands in only where that setting is absent and the master is local, as in tests.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="workload-")
    return f"{shared.rstrip('/')}/work-{uuid.uuid4().hex}"


def query(name: str, oracle: str | None = None, like: str | None = None):
    """Register fn(extracts) under a name; `oracle` is a SQL body over the tables and the CTEs, `like` a query with the same rows."""
    def wrap(fn: Callable[[Extracts], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in SETTINGS.items():
                spark.conf.set(key, value)
            return fn(Extracts(spark, sf_dir))
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = sql(oracle)
        if like is not None:
            SQL[name] = SQL[like]
        return fn
    return wrap


def res(df: DataFrame, **columns: str) -> DataFrame:
    """Select and rename (new=old); decimals become doubles, doubles are rounded to six places."""
    if columns:
        df = df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        if kind in ("decimal", "double", "float"):
            c = F.round(c, 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, name: str) -> str:
    """SQL counterpart of `res` for one column."""
    return f"round(({expr})::DOUBLE, 6) AS {name}"


def rs(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)
