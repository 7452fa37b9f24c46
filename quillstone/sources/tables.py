"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstone.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` under ``folder``; column pruning and filters reach the scan."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan, dealt out over all cores if its files split into fewer parts than there are cores; for Python stages over a few large row groups. A scan with
    enough parts is left alone, so nothing is moved at scale."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
