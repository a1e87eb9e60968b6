"""Reading the landing zone."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import source_schema

PREFERRED_RATE_SOURCE = "BoE API"  # fixed value: the tag of rows that came from the public rate service
FALLBACK_RATE_SOURCE = "Fallback"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan_files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Every Parquet file below a folder with the declared schema.

    year=/month= folders are not turned into columns: the file's own dates decide. Columns that a
    query does not use are not read.
    """
    return (
        spark.read.schema(source_schema(table))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(folder)
    )


def scan_landing(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The files of a folder with each row's file path as _source_file."""
    return scan_files(spark, folder, table).withColumn("_source_file", F.col("_metadata.file_path"))


def scan_or_empty(spark: SparkSession, folder: str, table: str) -> tuple[DataFrame, str]:
    """The folder's rows and 'Succeeded', or no rows and 'Skipped' where the folder is absent."""
    if path_exists(spark, folder):
        return scan_landing(spark, folder, table), "Succeeded"
    empty = spark.createDataFrame([], source_schema(table)).withColumn("_source_file", F.lit(None).cast("string"))
    return empty, "Skipped"


def scan_rate_csv(spark: SparkSession, path: str, source_system: str = PREFERRED_RATE_SOURCE) -> DataFrame:
    """A landed CSV of the rate series (DATE, IUDBEDR), both columns kept as text."""
    raw = spark.read.option("header", "true").option("quote", '"').schema("DATE string, IUDBEDR string").csv(path)
    return raw.withColumnsRenamed({"DATE": "rate_date", "IUDBEDR": "bank_rate"}).withColumn(
        "source_system", F.lit(source_system))


def first_available(spark: SparkSession, primary: str, fallback: str) -> DataFrame:
    """The rate series from the landed service file, else from the fallback Parquet, tagged."""
    if path_exists(spark, primary):
        return scan_rate_csv(spark, primary)
    back = spark.read.parquet(fallback)
    return back.select(F.col("rate_date").cast("string").alias("rate_date"),
                       F.col("bank_rate").cast("string").alias("bank_rate"),
                       F.lit(FALLBACK_RATE_SOURCE).alias("source_system"))


def read_month_files(spark: SparkSession, root: str, source: str, table: str,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """All months of a table in one scan that reads only `columns`."""
    df = scan_files(spark, f"{root}/{source}/{table}", table)
    return df.select(*columns) if columns else df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    from .schemas import ops_schema
    return spark.read.schema(ops_schema("manifest")).option("multiLine", "true").json(path)


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Files, rows and MB per source and table."""
    f = manifest.select(F.explode("files").alias("f")).select("f.*")
    return f.groupBy("source", "table").agg(
        F.count("file").alias("files"), F.sum("rows").alias("rows"), (F.sum("bytes") / 1e6).alias("mb"))
