"""Partitioned tables with versions.

A table is a folder of write folders, each holding partitions as Spark writes them, and of manifests. A manifest names,
for each partition value, the folders that hold its rows; it is written under a name of its own and published by one
rename that fails if the version exists. So

- a run that stops anywhere before the rename leaves the old version as it was, for readers and for the next run;
- a reader pins a version: it reads the folders that manifest names, whatever is published meanwhile;
- replacing a partition writes that partition only, all others keep their folders;
- two versions differ in the partitions whose folders differ, which needs no data to be read.

A manifest has one entry per partition, never per row, and also carries the versions of the tables it was made from.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MANIFESTS, DATA = "_manifests", "data"
KEEP = 3


class VersionTaken(RuntimeError):
    """Another run has published this version; nothing of the table has changed."""


@dataclass(frozen=True)
class Snapshot:
    """One version: partition value (as text) -> folders below the table's data folder."""
    version: int
    key: str
    schema: str
    parts: dict[str, tuple[str, ...]]
    inputs: dict[str, int] = field(default_factory=dict)
    settings: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "key": self.key, "schema": json.loads(self.schema),
                           "parts": {k: list(v) for k, v in sorted(self.parts.items())}, "inputs": self.inputs, "settings": self.settings})

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        d = json.loads(text)
        return cls(d["version"], d["key"], json.dumps(d["schema"]), {k: tuple(v) for k, v in d["parts"].items()}, d["inputs"], d["settings"])


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    _, p, fs = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    return sorted(int(n[2:-5]) for n in names(spark, f"{path}/{MANIFESTS}") if n.startswith("v=") and n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """A version of the table (the newest if not named); None if there is none, or if it has expired."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    name = f"{path}/{MANIFESTS}/v={known[-1] if version is None else version:08d}.json"
    jvm, p, fs = _hadoop(spark, name)
    stream = fs.open(p)
    try:
        return Snapshot.from_json(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read(spark: SparkSession, path: str, found: Snapshot, parts: Iterable | None = None) -> DataFrame:
    """The rows of one version, or of some of its partitions; nothing else of the table is listed or read.

    The key column comes from the folder names, so filters on it prune folders.
    """
    schema = StructType.fromJson(json.loads(found.schema))
    wanted = found.parts if parts is None else {str(v) for v in parts} & set(found.parts)
    folders = sorted(f"{path}/{DATA}/{f}" for v in wanted for f in found.parts[v])
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", f"{path}/{DATA}").schema(schema).parquet(*folders)
    return rows.select(*schema.names)


def changed(old: Snapshot | None, new: Snapshot) -> set[str]:
    """Partition values that do not hold the same folders in both versions."""
    before = {} if old is None else old.parts
    return {v for v in {*before, *new.parts} if before.get(v) != new.parts.get(v)}


def publish(spark: SparkSession, path: str, new: Snapshot) -> Snapshot:
    """Make `new` visible, or raise VersionTaken."""
    base = f"{path}/{MANIFESTS}"
    jvm, temporary, fs = _hadoop(spark, f"{base}/.{uuid.uuid4().hex}")
    out = fs.create(temporary)
    try:
        out.write(bytearray(new.to_json().encode()))
    finally:
        out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{base}/v={new.version:08d}.json")
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(temporary), context.makeQualified(final), options)
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise VersionTaken(f"{path} has a version {new.version} already") from e
        raise
    return new


def write_folder(df: DataFrame, path: str, key: str) -> dict[str, tuple[str, ...]]:
    """Write the rows by partition into a folder of their own; visible to nobody until a manifest names it.

    One job for all partitions: rows are clustered by the key first, and REBALANCE lets AQE split a large partition
    over several tasks and files.
    """
    spark, name = df.sparkSession, f"w={uuid.uuid4().hex}"
    df.hint("rebalance", F.col(key)).write.partitionBy(key).parquet(f"{path}/{DATA}/{name}")
    made = [n for n in names(spark, f"{path}/{DATA}/{name}") if n.startswith(f"{key}=")]
    if not made:  # no rows: nothing would name the folder
        jvm, folder, fs = _hadoop(spark, f"{path}/{DATA}/{name}")
        fs.delete(folder, True)
    return {n[len(key) + 1:]: (f"{name}/{n}",) for n in made}


def drop_folders(spark: SparkSession, path: str, parts: dict[str, tuple[str, ...]]) -> None:
    """Delete the write folders of partitions that no manifest names."""
    jvm, _, fs = _hadoop(spark, path)
    for name in {f.split("/")[0] for folders in parts.values() for f in folders}:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{DATA}/{name}"), True)


def commit(df: DataFrame, path: str, key: str, replaced: Iterable | None = (), base: Snapshot | None = None,
           inputs: dict[str, int] | None = None, settings: dict | None = None, append: bool = False, keep: int = KEEP) -> Snapshot:
    """A new version: the rows of `df` replace their partitions and those in `replaced` (None: all); others stay.

    With `append` the rows join what their partitions hold. `base` is the version the rows were made from; if another
    one was published since, VersionTaken is raised and the table is as it was.
    """
    spark = df.sparkSession
    base = snapshot(spark, path) if base is None else base
    written = write_folder(df, path, key)
    old = {} if base is None or replaced is None else base.parts
    gone = set() if append else {str(v) for v in replaced or ()} | set(written)
    parts = {v: f for v, f in old.items() if v not in gone}
    for value, folders in written.items():
        parts[value] = parts.get(value, ()) + folders
    fields = [f for f in df.schema.fields if f.name != key] + [df.schema[key]]
    new = publish(spark, path, Snapshot((base.version if base else 0) + 1, key, StructType(fields).json(), parts, inputs or {},
                                        settings if settings is not None else (base.settings if base else {})))
    expire(spark, path, keep)
    return new


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Forget all but the newest `keep` versions, and delete the folders that only those named.

    Folders that no manifest ever named (of runs that died, or still run) are left alone.
    """
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return
    held = {f for v in kept for folders in snapshot(spark, path, v).parts.values() for f in folders}
    jvm, _, fs = _hadoop(spark, path)
    for v in old:
        named = {f for folders in snapshot(spark, path, v).parts.values() for f in folders}
        # The manifest goes first: a reader sees a version whole or not at all.
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/v={v:08d}.json"), False)
        for f in named - held:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{DATA}/{f}"), True)
