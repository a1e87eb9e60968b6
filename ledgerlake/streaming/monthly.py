"""Incremental loads with Structured Streaming.

Late records are accepted into their own period and counted, so there is no watermark that would
drop them. Each run takes what has arrived (availableNow) and stops; the checkpoint folder remembers
which files were read, the tables' own replace and upsert rules make a repeated batch harmless.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedupe import keep_latest
from ..sources.schemas import source_schema
from ..sources import versions
from ..sources.tables import bucket_of, merge, read_table, replace_parts, replace_periods, upsert_table


def landing_stream(spark: SparkSession, folder: str, schema: StructType | str, recursive: bool = True,
                   glob: str = "*.parquet") -> DataFrame:
    """New files of a landing folder with their path; `schema` may name a source table."""
    schema = source_schema(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(folder).withColumn("_source_file", F.col("_metadata.file_path"))


def load_arrived_periods(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str,
                         checkpoint: str, key: str = "DateKey") -> StreamingQuery:
    """Everything that arrived, transformed and put in place of its periods.

    For extracts that deliver whole periods: a file that comes later for the same period replaces it.
    Events, of which later files bring more for the same period, go through `load_arrived_events`.
    """
    def batch(rows: DataFrame, _: int) -> None:
        replace_periods(transform(rows), table, key)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def load_arrived_events(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], events: str,
                        summarise: Callable[[DataFrame], DataFrame], summary: str, event_id: str, part: str,
                        checkpoint: str) -> StreamingQuery:
    """Events that arrived join those that came before; summaries of the touched parts are made anew from all of them.

    `prepare` adds the column `part` (a period, or a bucket of an entity), by which both tables are stored;
    `summarise` keeps it. An event that comes again replaces itself, in its old part too if that has changed,
    so a file read twice changes nothing and a late file adds to its period. Events without an id are refused.

    Where an event lies is known from an index (`<events>_ids`: event id, part) that is stored by hash bucket of
    the id: a batch reads the buckets of its own ids and the touched parts, not the history. Events, summary and
    index change one after the other, each as a whole; a batch that stops between them is replayed by the stream and
    makes all three good, as the index is written last: until then it names the parts from before the batch.
    """
    def batch(rows: DataFrame, _: int) -> None:
        spark, index = rows.sparkSession, f"{events}_ids"
        once = keep_latest(prepare(rows).where(F.col(event_id).isNotNull()), [event_id], "_source_file")
        arrived = versions.write_folder(once, events, part)  # computed once
        new = versions.read(spark, events, versions.Snapshot(0, part, once.schema.json(), arrived))
        ids, touched = new.select(event_id), set(arrived)
        known = versions.snapshot(spark, index)
        if known is not None:
            bucket = bucket_of([event_id], known.settings["buckets"])
            buckets = [r[0] for r in ids.select(bucket).distinct().collect()]  # a number fixed by the index
            before = read_table(spark, index, known, buckets).join(ids, event_id, "left_semi")
            touched |= {str(r[0]) for r in before.select(part).distinct().collect()}  # days or buckets, never events
        base = versions.snapshot(spark, events)
        if base is not None:
            new = read_table(spark, events, base, touched).join(ids, event_id, "left_anti").unionByName(new)
        now = versions.commit(new, events, part, touched, base)
        replace_parts(summarise(read_table(spark, events, now, touched)), summary, part, touched)
        merge(versions.read(spark, events, versions.Snapshot(0, part, once.schema.json(), arrived)).select(event_id, part), index, [event_id])
        versions.drop_folders(spark, events, arrived)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def upsert_arrived(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str,
                   keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Everything that arrived, upserted by key, whatever period it belongs to: rows that come again replace themselves.

    For rows that are final values of their key; sums and counts over events need `load_arrived_events`.
    """
    def batch(rows: DataFrame, _: int) -> None:
        upsert_table(rows.sparkSession, transform(rows), table, keys)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def month_totals(events: DataFrame, event_time: str, keys: Sequence[str], value: str) -> DataFrame:
    """Counts and sums per calendar month; works on a stream (complete or update mode) and on a table."""
    month = F.last_day(F.to_date(event_time)).alias("month_end")
    return events.groupBy(month, *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
