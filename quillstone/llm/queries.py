"""Queries of the text problems 8 to 10, over whole tables and whole texts. SQL cannot express them; tests/llm holds them against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe, packing, reading
from quillstone.sources.tables import spread, table


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(_texts(spark, sf), "doc_id", "text")


def p9_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(bpe.lengths(_texts(spark, sf), "doc_id", "text"), "doc_id", table(spark, sf, "documents").count())


def p9_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How many containers are filled to which hundredth."""
    filled = packing.fills(p9_containers(spark, sf))
    return filled.groupBy(F.floor(F.col("n_tokens") * 100 / packing.CAPACITY).cast("int").alias("percent")).agg(F.count("*").alias("containers"), F.sum("n_tokens").alias("n_tokens"))


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return reading.levels(_texts(spark, sf), reading.fit(table(spark, sf, "documents"), table(spark, sf, "reading_label")))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).filter("english_prose and level >= 4").select("doc_id").distinct()


def p10_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Number of texts and words per level, prose and other text apart."""
    return _levels(spark, sf).groupBy("english_prose", "level").agg(F.count("*").alias("documents"), F.sum("n_words").alias("words"))


QUERIES = {f.__name__: f for f in (p8_ids, p9_containers, p9_fill, p10_found, p10_levels)}
SQL: dict[str, str] = {}
