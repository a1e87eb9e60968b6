"""Extracts whose parts are computed one after the other."""
from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ledgerlake.sources import tables
from .adapters import Extracts, account_ids
from .registry import work_folder


class Stored(Extracts):
    """The extracts for queries over many facts: what is put is made by a job of its own, and the lines are joined once for all facts."""

    @cached_property
    def root(self) -> str:
        return work_folder(self.spark)

    def put(self, df: DataFrame) -> DataFrame:
        return tables.store(df, f"{self.root}/{uuid.uuid4().hex}")

    @cached_property
    def base(self) -> DataFrame:
        rows = super().base
        texts = {"month_end": F.last_day("order_date"), **account_ids()}
        return self.put(rows.drop(*texts, "l_partkey", "p_partkey", "o_orderkey")).withColumns(texts)

    @cached_property
    def budget_stage(self) -> DataFrame:
        c = self.customer_region.select("c_custkey", "r_name")
        return self.budgets(self.base.join(c, F.col("o_custkey") == F.col("c_custkey")))
