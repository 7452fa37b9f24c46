"""What changed between full snapshots, by a kept index of key to hash in buckets.

The index of the last snapshot holds, per key, only a 64-bit hash of its values. It lies on shared storage as a table bucketed by a hash of the key, so that a
probe reads it where it lies: only the new rows are shuffled, to the bucket's task. There the new rows probe the index, the task emits what was added, removed
or changed, and the new index takes the old one's place; several snapshots that were delivered since go through the bucket one after the other. Old and
new values are fetched afterwards, from the snapshots, for the changed keys alone. A finished index is published by a pointer, so a job that dies leaves
the old one in use.

A call takes as many snapshots at once as fit ``BUCKET_ROWS`` rows a bucket, at least one; the rest follow in further rounds. The result is the same.

Defined results
* null keys or snapshot days are no rows. Repeated rows, in any order, are one. A key with null values differs from a key with others.
* the first snapshot gives no changes, nor does an empty table. Days without delivery are skipped over; a day not after the last one applied is left out.
* two different value sets with equal 64-bit hashes would be missed (about n / 2^64 for n shared keys per pair).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.sources.versions import Versions

BUCKET_ROWS = 1_000_000
SCHEMA = "bucket int, snapshot date, before date, key string, hash bigint, change string"
_ARROW = pa.schema([("bucket", pa.int32()), ("snapshot", pa.date32()), ("before", pa.date32()), ("key", pa.string()), ("hash", pa.int64()), ("change", pa.string())])


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def fold(df: DataFrame, snapshot: str, key: str, value: str) -> DataFrame:
    """One row per snapshot and key with the sorted set of its values: (snapshot, key, state). A key has few values by definition."""
    rows = df.select(F.col(snapshot).cast("date").alias("snapshot"), F.col(key).cast("string").alias("key"), F.col(value).alias("value")).filter("snapshot is not null and key is not null")
    return rows.groupBy("snapshot", "key").agg(F.array_sort(F.collect_set("value")).alias("state"))


def state_hash(state: str = "state") -> Column:
    return F.xxhash64(F.concat_ws("\x1f", state), F.size(state))


def probe(old_keys: pa.Array, old_hash: np.ndarray, keys: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the new rows that are added, of those that are changed, and of the old rows that are removed. Keys are unique on each side."""
    if len(old_keys) == 0 or len(keys) == 0:
        return np.arange(len(keys)), np.zeros(0, np.int64), np.arange(len(old_keys))
    at = pc.index_in(keys, value_set=old_keys).fill_null(-1).to_numpy(zero_copy_only=False)
    known = np.flatnonzero(at >= 0)
    gone = np.ones(len(old_keys), dtype=bool)
    gone[at[known]] = False
    return np.flatnonzero(at < 0), known[old_hash[at[known]] != hashes[known]], np.flatnonzero(gone)


def _steps(old: pa.Table, new: pa.Table, days: list, last) -> Iterator[pa.Table]:
    """One bucket: the kept index, then each delivered day in turn probing it and taking its place; in the end the index of the last day."""
    keys, hashes = old.column("key").combine_chunks(), old.column("hash").to_numpy()
    bucket = (new if new.num_rows else old).column("bucket")[0].as_py()
    new = new.sort_by("snapshot")
    stamp = new.column("snapshot").cast(pa.int32()).to_numpy()
    new_keys, new_hash = new.column("key").combine_chunks(), new.column("hash").to_numpy()
    ordinal = pa.array(days, pa.date32()).cast(pa.int32()).to_numpy()
    lo, hi = np.searchsorted(stamp, ordinal, "left"), np.searchsorted(stamp, ordinal, "right")

    def rows(day, before, key: pa.Array, hashed: np.ndarray | None, change: str | None) -> pa.Table:
        n = len(key)
        whole = lambda v, t: pa.array([v], t).take(pa.array(np.zeros(n, np.int64)))
        return pa.Table.from_arrays([whole(bucket, pa.int32()), whole(day, pa.date32()), whole(before, pa.date32()), key, pa.nulls(n, pa.int64()) if hashed is None else pa.array(hashed, pa.int64()), whole(change, pa.string())], schema=_ARROW)

    for i, day in enumerate(days):
        now_keys, now_hash = new_keys.slice(int(lo[i]), int(hi[i] - lo[i])), new_hash[lo[i] : hi[i]]
        if last is not None:
            added, changed, removed = probe(keys, hashes, now_keys, now_hash)
            for change, from_keys, at in (("added", now_keys, added), ("changed", now_keys, changed), ("removed", keys, removed)):
                if len(at):
                    yield rows(day, last, from_keys.take(pa.array(at)), None, change)
        keys, hashes, last = now_keys, now_hash, day
    yield rows(last, None, keys, hashes, None)


class SnapshotIndex:
    """The index of the last snapshot in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.versions, self.bucket_rows = spark, Versions(spark, folder), bucket_rows

    def _table(self, name: str, buckets: int) -> DataFrame:
        """A version as a table bucketed by ``bucket``, whatever session reads it."""
        table = f"quillstone_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {table} ({SCHEMA}) USING parquet CLUSTERED BY (bucket) INTO {buckets} BUCKETS LOCATION '{self.versions.path(name)}'")
        found = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # the files stay; the session's catalogue forgets the name
        return found

    def _write(self, df: DataFrame, name: str, buckets: int) -> None:
        """Each bucket lies in one task, so that bucketing on write moves nothing and makes one file a bucket."""
        table = f"quillstone_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, "bucket").option("path", self.versions.path(name)).mode("overwrite").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")

    def index(self) -> DataFrame | None:
        """(bucket, key, hash) of the last snapshot."""
        said = self.versions.entry()
        return self._table(said["name"], said["buckets"]).filter("change is null").select("bucket", "key", "hash") if said else None

    def apply(self, df: DataFrame, snapshot: str, key: str, value: str) -> DataFrame:
        """Probes the index with each snapshot of ``df`` in turn, publishes the index of the last, and returns the changes (snapshot, before, key, change), which can
        be read until the next call: it begins by removing what is no longer in use."""
        self.versions.prune()
        said = self.versions.entry()
        done = said.get("snapshot")
        rows = df if done is None else df.filter(F.col(snapshot).cast("date") > F.lit(done).cast("date"))
        sizes = rows.filter(F.col(snapshot).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(snapshot).cast("date").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # a row per delivered day
        if not sizes:
            return self.spark.createDataFrame([], "snapshot date, before date, key string, change string")
        largest = max(r["n"] for r in sizes)
        # enough buckets that one holds at most half of ``bucket_rows`` keys of the largest day; as many as the index has if that is enough
        need = max(self.spark.sparkContext.defaultParallelism, -(-2 * largest // self.bucket_rows))
        buckets = said["buckets"] if said and need <= said["buckets"] else need
        changes, at = [], 0
        while at < len(sizes):
            take, held = 0, 0
            while at + take < len(sizes) and (take == 0 or held + sizes[at + take]["n"] <= buckets * self.bucket_rows):
                held += sizes[at + take]["n"]
                take += 1
            days = [r["d"] for r in sizes[at : at + take]]
            name = self._round(rows.filter(F.col(snapshot).cast("date").between(days[0], days[-1])), snapshot, key, value, days, buckets)
            changes.append(self._table(name, buckets).filter("change is not null").select("snapshot", "before", "key", "change"))
            at += take
        out = changes[0]
        for more in changes[1:]:
            out = out.unionByName(more)
        return out

    def _round(self, rows: DataFrame, snapshot: str, key: str, value: str, days: list, buckets: int) -> str:
        said = self.versions.entry()
        last = said.get("snapshot")
        old = self.index()
        if old is None:
            old = self.spark.createDataFrame([], "bucket int, key string, hash bigint")
        elif said["buckets"] != buckets:
            old = old.withColumn("bucket", _bucket(F.col("key"), buckets))
        new = fold(rows, snapshot, key, value).select(_bucket(F.col("key"), buckets).alias("bucket"), "snapshot", "key", state_hash().alias("hash"))
        before = None if last is None else date.fromisoformat(last)

        def run(kept: pa.Table, fresh: pa.Table) -> pa.Table:
            return pa.concat_tables([_ARROW.empty_table(), *_steps(kept, fresh, days, before)])

        out = old.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInArrow(run, SCHEMA)
        name = f"v-{uuid.uuid4().hex}"
        self._write(out, name, buckets)
        self.versions.use(name, buckets=buckets, snapshot=days[-1].isoformat())
        return name


def with_values(changes: DataFrame, df: DataFrame, snapshot: str, key: str, value: str) -> DataFrame:
    """Changes with old_state and new_state, fetched for the changed keys alone: the snapshots' rows meet the changes before anything of them is shuffled or
    folded, if the engine finds the changes small enough to send."""
    sides = F.array(F.struct(F.lit(False).alias("now"), F.col("before").alias("at")), F.struct(F.lit(True).alias("now"), F.col("snapshot").alias("at")))
    wanted = changes.select("snapshot", "key", "change", F.inline(sides))
    rows = df.select(F.col(snapshot).cast("date").alias("at"), F.col(key).cast("string").alias("key"), F.col(value).alias("value"))
    side = lambda now: F.array_sort(F.collect_set(F.when(F.col("now") == F.lit(now), F.col("value"))))
    got = wanted.join(rows, ["at", "key"]).groupBy("snapshot", "key", "change").agg(side(False).alias("old_state"), side(True).alias("new_state"))
    return got.withColumns({"old_state": F.when(F.col("change") != "added", F.col("old_state")), "new_state": F.when(F.col("change") != "removed", F.col("new_state"))})
