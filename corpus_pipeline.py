"""A training corpus from `documents`: each stage works on what its predecessor kept.

Rejected are documents predicted toxic, all but one document of each near-duplicate class, and documents that hold a
window of a benchmark item; the rest is mixed to the target weights, and written as token records and read back.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import mixing, near_dup, phrase_index, token_records, toxicity
from ledgerlake.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrase_index.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_records.encode_and_read(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: The learnt toxicity model and the tokenizer have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; between stages the corpus is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
