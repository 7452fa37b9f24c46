"""Keyed merges on immutable files: the new state is computed in one pass and written beside the old one; readers switch by a pointer.

Each merge is one shuffle on the keys. Both sides are reduced to one row per key first, map-side combined, so a key that was delivered very often is
no hot spot. Null keys never match and are kept as they are. Empty sides are fine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.sources.versions import Versions


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``, of equals the greatest by all other columns."""
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order if c in rest]
    names = [*lead, *[c for c in rest if c not in lead]]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*names)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """Target with source merged in by key. A column of ``rules`` gets ``rule(old, new)`` where both rows exist; others take the new value."""
    rules = rules or {}
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    out = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        both = rules[c](old, new) if c in rules else new
        out.append((F.coalesce(new, old) if c in keys else F.when(F.col("__s").isNull(), old).when(F.col("__t").isNull(), new).otherwise(both)).alias(c))
    return joined.select(*out)


PARTS = 256


def merge_parts(table: Versions, fresh: DataFrame, keys: list[str], order: list[str] | None = None, name: str | None = None, parts: int = PARTS, keep: int = 2) -> None:
    """Merges rows into a versioned table that lies in parts by a hash of its keys; only the parts that the rows fall into are read and written, each by one
    task and in one shuffle. The last row per key by ``order`` wins, also over rows merged before; without an order the fresh row does. ``fresh`` has one row per
    key and is read twice. A version that is in use already is not merged again."""
    said = table.entry()
    if name is not None and said.get("name") == name:
        return
    parts = int(said.get("of", parts))  # how a table is split stays as it began
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("__part")
    touched = [str(r[0]) for r in fresh.select(part).distinct().collect()]  # at most as many rows as there are parts
    if not touched:
        return
    turn = lambda df, n: df.select("*", part, F.lit(n).alias("__turn"))
    old = table.read_parts(touched)
    rows = turn(fresh, 1) if old is None else turn(old, 0).unionByName(turn(fresh, 1))
    merged = last_per_key(rows.repartition(len(touched), "__part"), ["__part", *keys], [*(order or []), "__turn"]).drop("__turn")
    name = name or f"v-{uuid.uuid4().hex}"
    table.use(name, parts=table.write_parts(merged, "__part", name, touched), of=parts)
    table.prune(keep)


def keep_old_if_null(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def keep_old(old: Column, _new: Column) -> Column:
    return old


def replace_children(target: DataFrame, source: DataFrame, parent: str) -> DataFrame:
    """All children of a parent that ``source`` has are replaced by those of ``source``."""
    return target.join(source.select(parent).distinct(), parent, "left_anti").unionByName(source)


def pending(wanted: DataFrame, state: DataFrame, keys: list[str], hash_column: str = "content_hash") -> DataFrame:
    """Rows of ``wanted`` with ``pending``: no state, a state that is not ok, or another hash."""
    known = state.select(*keys, F.col("status").alias("__status"), F.col(hash_column).alias("__hash"))
    joined = wanted.join(known, keys, "left")
    todo = F.col("__status").isNull() | (F.col("__status") != "ok") | ~F.col("__hash").eqNullSafe(F.col(hash_column))
    return joined.withColumn("pending", todo).drop("__status", "__hash")
