"""Documents as objects addressed by their content, on whatever file system Arrow or Spark reach.

An object's path says what it holds, so writing it again changes nothing: a task that runs twice, or dies in between, leaves whole objects only (each is written
under another name and moved). Reading goes through Spark's binary files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import filings as X


def put(df: DataFrame, folder: str, key: str = "accession_number", body: str = "body") -> DataFrame:
    """(key, raw_uri, content_sha256) of documents, each stored under ``folder``. Null documents have no object. The objects are written when the rows are
    read."""
    rows = df.filter(F.col(body).isNotNull()).select(F.col(key).cast("string").alias("key"), X.content_sha(body).alias("sha"), F.col(body).cast("binary").alias("body"))
    rows = rows.select("key", "sha", X.content_path("", "key", "sha").alias("path"), "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            uris = []
            for path, data in zip(batch.column("path").to_pylist(), batch.column("body").to_pylist(), strict=True):
                at = f"{root}/{path}"
                if store.get_file_info(at).type == fs.FileType.NotFound:
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    hidden = f"{at}.{uuid.uuid4().hex}"
                    with store.open_output_stream(hidden) as out:
                        out.write(data)
                    store.move(hidden, at)
                uris.append(f"{folder.rstrip('/')}/{path}")
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(uris, pa.string()), batch.column("sha")], names=["key", "raw_uri", "content_sha256"])

    return rows.mapInArrow(run, "key string, raw_uri string, content_sha256 string").withColumnRenamed("key", key)


def get(spark: SparkSession, folder: str) -> DataFrame:
    """(raw_uri, body) of all stored documents; only those that are asked for by a join or filter on their address need be kept."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(folder)
    root = folder.rstrip("/")
    # an address as it was given, whatever form of it the file system reports
    tail = F.regexp_extract("path", r"([^/]+/[^/]+\.xml)$", 1)
    return found.select(F.concat(F.lit(f"{root}/"), tail).alias("raw_uri"), F.col("content").alias("body"))
