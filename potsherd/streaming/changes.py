"""Exports that arrive one by one, and counts and postings that follow changes.

The batch cycle needs no streams. These are for running it continuously: a file source takes the place of a queue with a
"processed" mark, for its checkpoint remembers which files were read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from potsherd.operators import segments
from potsherd.sources import buckets


def file_queue(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """(path, fileSize, modified) of files below a folder as they appear; their content isn't read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    read = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_batch).load(folder)
    return read.select("path", F.col("length").alias("fileSize"), F.col("modificationTime").alias("modified"))


def append_new(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each item of the queue is written once, whatever fails in between; ends when all that is there has been read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(stream: DataFrame, by: list[str], time: str | None = None, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Running counts; with a time column per window of time, and rows that come later than ``late`` are left out."""
    if time is None:
        return stream.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    timed = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return timed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def follow_changes(changes: DataFrame, table: str, keys: list[str], checkpoint: str, order: str, deleted: str | None = None, by: list[str] | None = None) -> StreamingQuery:
    """Upsert a stream of changed rows into a table of buckets (``buckets.read``, ``buckets.counts``): batch n is version n, which comes into being once."""

    def upsert(batch: DataFrame, n: int) -> None:
        kept = batch.persist()
        try:
            buckets.apply(kept, table, keys, order, n, deleted, by)
        finally:
            kept.unpersist()

    return changes.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_index(changes: DataFrame, index: str, pk: str, fields: list[str], checkpoint: str, table: str = "", deleted: str | None = None) -> StreamingQuery:
    """Keep an index of segments current as rows change: batch n is version n, and writes what it changes."""

    def reindex(batch: DataFrame, n: int) -> None:
        segments.apply(batch, index, pk, fields, n, table, deleted)

    return changes.writeStream.foreachBatch(reindex).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
