"""Texts into containers of fixed capacity by sum-of-squares online packing.

An item is a whole text, or, of a text longer than a container, its rest after as many full containers as it fills. Items arrive one by one and go
to the fill level that keeps the sum over levels of (number of containers at that level) squared least, a new container being level 0. The level
array holds, per fill, how many partly filled containers there are; choosing is one vector sum and an argmin over at most ``capacity`` entries, however
many containers are open. The containers that are still partly filled when the stream ends hold few items; those items alone are placed
again, longest first into the fullest container that takes them, which closes the gaps that an online rule has to leave.

Distribution: items are spread over shards of about ``shard_items`` by a hash of their key, so a shard is bounded whatever the data, and each shard
packs on its own; at most a container or two per shard stays unfilled. Only (key, size) is shuffled. Sizes come from the token counts of the
encoder, taken before the shuffle.

Defined results
* empty texts (null or without tokens) need no room: one row with a null container.
* a text is divided only if longer than the capacity; then all its pieces but the last fill a container each.
* repeated keys are items of their own. Null keys are items too. The result is the same on every run over the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.grouped import map_sorted_groups, starts

CAPACITY = 1024
SHARD_ITEMS = 50_000
_BIG = 1 << 60


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container number of each item and the number of containers; sizes lie in 1..capacity."""
    take = np.full(capacity + 1, _BIG, dtype=np.int64)  # change of the sum when a container leaves the level; level 0 is free
    give = np.ones(capacity + 1, dtype=np.int64)  # change when one arrives; a full container counts nowhere
    take[0], give[capacity] = 0, 0
    count = [0] * (capacity + 1)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    home = np.empty(len(sizes), dtype=np.int64)
    used = 0
    for i, s in enumerate(sizes.tolist()):
        cost = take[: capacity - s + 1] + give[s:]
        h = capacity - s - int(cost[::-1].argmin())  # of equal levels the fullest
        if h == 0:
            box, used = used, used + 1
        else:
            box = open_at[h].pop()
            count[h] -= 1
            take[h] = 1 - 2 * count[h] if count[h] else _BIG
            give[h] = 2 * count[h] + 1
        home[i] = box
        t = h + s
        if t < capacity:
            open_at[t].append(box)
            count[t] += 1
            take[t] = 1 - 2 * count[t]
            give[t] = 2 * count[t] + 1
    return home, used


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Longest first, each into the fullest container that takes it."""
    home = np.empty(len(sizes), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    has = np.zeros(capacity + 1, dtype=bool)
    used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        k = int(has[s:].argmax())
        if has[s + k]:
            left = s + k
            box = room[left].pop()
            has[left] = bool(room[left])
        else:
            left, box, used = capacity, used, used + 1
        home[i] = box
        left -= s
        if left:
            room[left].append(box)
            has[left] = True
    return home, used


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item: the online rule, then the items of its unfilled containers once more."""
    if len(sizes) == 0:
        return np.zeros(0, dtype=np.int64)
    home, used = sum_of_squares(sizes, capacity)
    fill = np.bincount(home, weights=sizes, minlength=used)
    loose = np.flatnonzero(fill[home] < capacity)
    if len(loose):
        again, more = best_fit(sizes[loose], capacity)
        if more <= int((fill < capacity).sum()):
            home[loose] = used + again
    return np.unique(home, return_inverse=True)[1]


def _pack_shards(table: pa.Table, capacity: int) -> pa.Table:
    """Whole shards of (shard, key, n_tokens): rests are packed, then the pieces that fill a container by themselves get the next numbers."""
    begin = np.append(starts(table, ["shard"]), table.num_rows)
    tokens = table.column("n_tokens").to_numpy().astype(np.int64)
    shard = table.column("shard").to_numpy().astype(np.int64)
    full, rest = tokens // capacity, tokens % capacity
    row, piece, size, box, start = [], [], [], [], []
    for a, b in zip(begin, begin[1:], strict=False):
        at = a + np.flatnonzero(rest[a:b])
        sizes = rest[at]
        own = pack(sizes, capacity)
        order = np.argsort(own, kind="stable")
        total = np.cumsum(sizes[order]) - sizes[order]
        first = np.append(True, own[order][1:] != own[order][:-1])[: len(order)]
        offset = np.empty(len(at), dtype=np.int64)
        offset[order] = total - np.maximum.accumulate(np.where(first, total, 0)) if len(order) else total
        used = int(own.max()) + 1 if len(own) else 0
        whole = np.repeat(np.arange(a, b), full[a:b])
        which = np.arange(len(whole)) - np.repeat(np.cumsum(full[a:b]) - full[a:b], full[a:b])
        row += [at, whole]
        piece += [full[at], which]
        size += [sizes, np.full(len(whole), capacity)]
        box += [(shard[a] << 32) + own, (shard[a] << 32) + used + np.arange(len(whole))]
        start += [offset, np.zeros(len(whole), dtype=np.int64)]
    join = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind))
    return pa.table({"key": table.column("key").combine_chunks().take(join(row, np.int64)), "piece": join(piece, np.int32), "n_tokens": join(size, np.int32), "container": join(box, np.int64), "start": join(start, np.int32)})


def containers(sizes: DataFrame, key: str, items: int, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(key, piece, first_token, n_tokens, container, start): where each piece of each item lies. ``sizes`` has (key, n_tokens); ``items`` is about how
    many rows it has and only sets the number of shards."""
    kind = sizes.schema[key].dataType.simpleString()
    shards = max(1, -(-items // shard_items))
    rows = sizes.select(F.col(key).alias("key"), F.coalesce("n_tokens", F.lit(0)).cast("int").alias("n_tokens"))
    # empty items take part in the pass with no size, so that the sizes are computed once
    rows = rows.withColumns({"shard": F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"), "turn": F.xxhash64("key", F.lit(7))})
    schema = f"key {kind}, piece int, n_tokens int, container bigint, start int"

    def run(table: pa.Table) -> pa.Table:
        packed = _pack_shards(table, capacity)
        empty = table.filter(pc.equal(table.column("n_tokens"), 0)).column("key")
        n = len(empty)
        none = pa.table({"key": empty, "piece": pa.array(np.zeros(n, np.int32)), "n_tokens": pa.array(np.zeros(n, np.int32)), "container": pa.nulls(n, pa.int64()), "start": pa.nulls(n, pa.int32())})
        return pa.concat_tables([packed, none])

    out = map_sorted_groups(rows, ["shard"], ["turn", "key", "n_tokens"], run, schema)
    return out.select(F.col("key").alias(key), "piece", (F.col("piece") * F.lit(capacity)).alias("first_token"), "n_tokens", "container", "start")


def fills(packed: DataFrame) -> DataFrame:
    """(container, n_pieces, n_tokens) of each container."""
    return packed.filter("container is not null").groupBy("container").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
