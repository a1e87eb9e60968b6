"""Small helpers shared by the corpus operators: tables, the shared folder, written intermediates."""
from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Any byte but tab, line feed, vertical tab, form feed, carriage return and space.
WORD = r"[^\x20\x09-\x0D]+"

#: Words whose hashes a Python worker remembers before it starts anew.
KNOWN_WORDS = 250_000
_HASHES: dict[bytes, int] = {}


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """The first 64 bits of each word's BLAKE2b."""
    if len(_HASHES) > KNOWN_WORDS:
        _HASHES.clear()
    for w in set(tokens).difference(_HASHES):
        _HASHES[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    A temporary folder is made only where that setting is absent and the master is local, as in tests.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "LLM_TEST_SHARED" not in os.environ:
        os.environ["LLM_TEST_SHARED"] = tempfile.mkdtemp(prefix="llm-shared-")
    return "file://" + os.environ["LLM_TEST_SHARED"]


#: Paths written since each open `scratch` began.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside is deleted at the end, but for what is kept. Results must not be read lazily from it."""
    own: list[str] = []
    _SCRATCH.append(own)
    try:
        yield
    finally:
        _SCRATCH.pop()
        for name in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that `saved` wrote and nothing reads any more."""
    spark, path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A path in the shared folder that nothing else uses; kept ones belong to the scratch around, if there is one."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if len(_SCRATCH) > keep:
        _SCRATCH[-1 - keep].append(path)
    return path


def saved(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write `df` once as Parquet into the shared folder and return the written table.

    Cuts the lineage: a lost executor costs a read, not the computation.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name, keep)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.saved_path = path
    return out


def cogrouped(left: DataFrame, right: DataFrame, keys: list[str], by, schema: str) -> DataFrame:
    """`by` over the Arrow tables of both sides with one key.

    A cogroup hashes each side's keys as they are and does not cast them as a join does: an int and a long of one
    value go to different partitions and never meet. Keys of different types are refused.
    """
    kinds = [[frame.schema[k].dataType for k in keys] for frame in (left, right)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"cogroup keys {keys} differ in type: {kinds[0]} and {kinds[1]}")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(by, schema)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def clean_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
