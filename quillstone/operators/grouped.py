"""Sorted groups as Arrow blocks: many whole groups per call, so a vectorised function sees long columns, never one group at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def starts(table: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key begins, in a table sorted by the keys. Null keys equal each other."""
    n = table.num_rows
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for key in keys:
        column = table.column(key)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if n > 1:
            a, b = column.slice(1), column.slice(0, n - 1)
            differs = pc.fill_null(pc.not_equal(a, b), True).to_numpy(zero_copy_only=False)
            both_null = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
            change[1:] |= differs & ~both_null
    return np.flatnonzero(change)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroups sorted batches so that no group is cut; holds one group and one batch at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held:
            joint = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            fresh = len(starts(joint, keys)) == 2
            inner = starts(batch, keys)
            cut = 0 if fresh else (int(inner[1]) if len(inner) > 1 else None)
            if cut is None:
                held.append(batch)
                continue
            if cut:
                held.append(batch.slice(0, cut))
            done = held
            rest = batch.slice(cut)
        else:
            done, rest = [], batch
        last = int(starts(rest, keys)[-1])
        if last:
            done = [*done, rest.slice(0, last)]
        if done:
            yield pa.Table.from_batches(done).combine_chunks()
        held = [rest.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def map_sorted_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` over tables of whole groups, sorted by keys and order. One shuffle on the keys; a group must be bounded by its definition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            yield from fn(table).to_batches(max_chunksize=50_000)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
