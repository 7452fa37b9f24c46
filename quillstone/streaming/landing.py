"""Landed files as a stream that merges into a versioned table, and event-time counts with a watermark.

A table is kept in parts by a hash of its keys. A micro-batch reads, merges and writes only the parts that its keys fall into; the others are taken over by
name. The version is named after the batch, so a batch that is run again after a failure writes the same version again and the result is the same as if it
had run once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from quillstone.operators import merge
from quillstone.sources.versions import Versions

def lines(spark: SparkSession, folder: str, per_trigger: int = 1000, archive: str | None = None) -> DataFrame:
    """Text lines of files as they land, with their file's name; (c0, file_name). Files whose batch has been committed move to ``archive``, which must lie
    outside ``folder``; a file of that name that is there already is never overwritten."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select(F.col("value").alias("c0"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("file_name"))


def records(spark: SparkSession, folder: str, schema: StructType | str, per_trigger: int = 1000) -> DataFrame:
    """Parquet files as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def merge_into(stream: DataFrame, table: Versions, keys: list[str], order: list[str], checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, parts: int = merge.PARTS) -> StreamingQuery:
    """Merges what has landed into ``table``, micro-batch by micro-batch; ends when all is read."""

    def step(batch: DataFrame, number: int) -> None:
        fresh = merge.last_per_key(transform(batch), keys, order).persist()  # asked for its parts, then merged
        try:
            merge.merge_parts(table, fresh, keys, order, f"v-{number:012d}", parts)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(stream: DataFrame, at: str, by: list[str], size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Event-time counts per window; rows later than the watermark are dropped by the engine."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


def first_seen(stream: DataFrame, keys: list[str], at: str, late: str = "7 days") -> DataFrame:
    """The first row of each key within the watermark; state older than it is freed."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
