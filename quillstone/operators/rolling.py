"""Totals over trailing calendar windows, days without activity included, by a two-stack monoid queue.

A queue that holds the active window keeps a back stack with running aggregates of what came in and a front stack with aggregates of what
will leave; when the front is empty the back is flipped over. On a dense grid of days the flip falls on every w-th day, so the stacks of a
whole block are one prefix scan and one suffix scan, and a window is the front top combined with the back top. Nothing is ever subtracted,
so any associative operation works: sums and counts, and minimum and maximum, which have no inverse.

Distribution: rows are reduced to one per entity and day (map-side combined), then cut into blocks of ``block_days`` per entity, each with
the ``max(windows) - 1`` days before it. A task sees blocks, never an entity's whole history, and a hot entity spreads over its blocks.

Defined results
* rows without entity, day or required value are no activity; an entity without any has no days. Empty table, no rows.
* of several rows of one entity and day the last known counts.
* totals and counts are 0 and averages, minimum and maximum null in a window without values.
* whole numbers and decimals are summed exactly, at the scale of their type, whatever their size: sums run on parts of a value that can't overflow. A total
  of more than 38 digits is null. Floating-point measures are summed in floating point.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from quillstone.operators.grouped import map_sorted_groups, starts

BLOCK_DAYS = 364
_HALF = 32
_MASK = (1 << _HALF) - 1
#: Upper halves of the least and the greatest 128-bit numbers of 38 digits.
_MOST = 10**38 >> 64


def two_stack(padded: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """Window aggregates over the last ``w`` slots. Length is a multiple of ``w``; each w-th slot flips the back stack to the front."""
    grid = padded.reshape(-1, w)
    back = op.accumulate(grid, axis=1).reshape(-1)
    front = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    out = back.copy()
    if len(padded) > w:
        at = np.arange(w, len(padded))
        at = at[at % w != w - 1]
        out[at] = op(front[at - w + 1], back[at])
    return out


Scan = Callable[[np.ndarray, object, np.ufunc], np.ndarray]


@dataclass(frozen=True)
class Measure:
    """A column to total: ``long`` (whole numbers and decimals of up to 18 digits, as unscaled longs), ``wide`` (longer decimals) or ``float``."""

    name: str
    kind: str
    scale: int = 0

    @staticmethod
    def of(name: str, kind: DataType) -> Measure:
        if isinstance(kind, (FloatType, DoubleType)):
            return Measure(name, "float")
        if isinstance(kind, DecimalType):
            return Measure(name, "long" if kind.precision <= 18 else "wide", kind.scale)
        if kind.typeName() not in ("byte", "short", "integer", "long"):
            raise ValueError(f"{name} is no number: {kind.simpleString()}")
        return Measure(name, "long")

    def column(self, c: Column) -> Column:
        """The column as it goes to the workers."""
        if self.kind == "long" and self.scale:
            return (c * F.lit(10**self.scale)).cast("decimal(38,0)").cast("bigint")
        return c.cast({"long": "bigint", "wide": f"decimal(38,{self.scale})", "float": "double"}[self.kind])

    @property
    def type(self) -> pa.DataType:
        """Of totals and extremes."""
        return pa.float64() if self.kind == "float" else pa.decimal128(38 if self.kind == "wide" else 28, self.scale)

    def totals(self, column: pa.Array, scan: Scan) -> tuple[pa.Array, np.ndarray]:
        """Totals and, as doubles, what averages are made of."""
        if self.kind == "float":
            total = scan(column.fill_null(0).to_numpy(zero_copy_only=False), 0.0, np.add)
            return pa.array(total), total
        parts = [scan(p, 0, np.add) for p in _parts(column, self.kind)]
        units = sum(p.astype(np.float64) * 2.0 ** (_HALF * i) for i, p in reversed([*enumerate(parts)]))
        low, high, fits = _carry(parts)
        return _decimals(low, high, fits, self.type), units / 10.0**self.scale

    def extreme(self, column: pa.Array, there: np.ndarray, scan: Scan, op: np.ufunc) -> pa.Array:
        """Least or greatest value; what stands for windows without values is left to the caller."""
        if self.kind == "float":
            rest = np.inf if op is np.minimum else -np.inf
            return pa.array(scan(np.where(there, column.fill_null(0).to_numpy(zero_copy_only=False), rest), rest, op))
        if self.kind == "long":
            info = np.iinfo(np.int64)
            rest = info.max if op is np.minimum else info.min
            best = scan(np.where(there, column.fill_null(0).to_numpy(), rest), rest, op)
            empty = best == rest
            best = np.where(empty, 0, best)
            return _decimals(best.view(np.uint64), best >> 63, np.ones(len(best), dtype=bool), self.type)
        # longer than a machine word: the window works on ranks
        order = np.lexsort(_parts(column, self.kind))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        rest = len(order) if op is np.minimum else -1
        best = scan(np.where(there, rank, rest), rest, op)
        none = (best < 0) | (best >= len(order))
        return column.take(pa.array(np.append(order, 0)[np.where(none, len(order), best)], mask=none))


def _parts(column: pa.Array, kind: str) -> list[np.ndarray]:
    """Values as sums of 32-bit parts, least first, the last one signed; nulls are 0."""
    if kind == "long":
        v = column.fill_null(0).to_numpy()
        return [v & _MASK, v >> _HALF]
    if len(column) == 0:
        return [np.zeros(0, dtype=np.int64)] * 4
    words = np.frombuffer(column.buffers()[1], dtype=np.uint64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    words = np.where(column.is_valid().to_numpy(zero_copy_only=False)[:, None], words, np.uint64(0))
    low, high = words[:, 0], words[:, 1].view(np.int64)
    return [(low & np.uint64(_MASK)).astype(np.int64), (low >> np.uint64(_HALF)).astype(np.int64), high & _MASK, high >> _HALF]


def _carry(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of parts as the lower and upper 64 bits of the number, and whether it has at most 38 digits."""
    if len(parts) == 2:
        parts = [*parts[:1], parts[1], np.zeros_like(parts[0]), np.zeros_like(parts[0])]
    digits, carry = [], np.zeros_like(parts[0])
    for p in parts[:3]:
        p = p + carry
        digits.append(p & _MASK)
        carry = p >> _HALF
    top = parts[3] + carry
    fits = (top >= -(_MOST >> _HALF) - 1) & (top <= _MOST >> _HALF)
    low = digits[0].astype(np.uint64) | (digits[1].astype(np.uint64) << np.uint64(_HALF))
    high = digits[2] | (np.where(fits, top, 0) << _HALF)
    return low, high, fits & (high < _MOST) & (high >= -_MOST)


def _decimals(low: np.ndarray, high: np.ndarray, fits: np.ndarray, kind: pa.DataType) -> pa.Array:
    words = np.empty((len(low), 2), dtype=np.uint64)
    words[:, 0], words[:, 1] = low, high.view(np.uint64)
    words[~fits] = 0
    return pa.Array.from_buffers(kind, len(low), [pa.py_buffer(np.packbits(fits, bitorder="little").tobytes()), pa.py_buffer(words.tobytes())])


def _windows(table: pa.Table, windows: Sequence[int], measures: Sequence[Measure], schema: pa.Schema, extremes: bool) -> pa.Table:
    """Whole (entity, block) groups, each led by its marker row (``day`` null, ``first`` and ``last`` set)."""
    begin = starts(table, ["entity", "block"])
    size = np.diff(np.append(begin, table.num_rows))
    marked = table.column("day").is_null().to_numpy()[begin]
    group = np.repeat(np.arange(len(begin)), size)
    day = table.column("day").fill_null(0).to_numpy()
    first, last = table.column("first").fill_null(0).to_numpy()[begin], table.column("last").fill_null(-1).to_numpy()[begin]
    reach = max(windows) - 1
    length = np.where(marked, last - first + 1 + reach, 0)  # grid of a group: the reach, then its own days
    is_row = np.ones(table.num_rows, dtype=bool)
    is_row[begin[marked]] = False
    is_row &= marked[group]
    slot = day - (first - reach)[group]
    is_row &= (slot >= 0) & (slot < length[group])
    rows, home, slot = np.flatnonzero(is_row), group[is_row], slot[is_row]
    own = np.where(marked, last - first + 1, 0)
    out_group = np.repeat(np.arange(len(begin)), own)
    step = np.arange(len(out_group)) - np.repeat(np.cumsum(own) - own, own)
    out_slot = step + reach
    columns = {m.name: table.column(m.name).combine_chunks().take(pa.array(rows)) for m in measures}
    columns = {n: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for n, c in columns.items()}
    result: list[pa.Array] = [table.column("entity").combine_chunks().take(pa.array(begin[out_group])), pa.array((first[out_group] + step).astype(np.int32))]
    for w in windows:
        padded = -(-length // w) * w
        base = np.cumsum(padded) - padded
        total = int(padded.sum())
        put, read = base[home] + slot, base[out_group] + out_slot

        def scan(values: np.ndarray, rest: object, op: np.ufunc, w: int = w, total: int = total, put: np.ndarray = put, read: np.ndarray = read) -> np.ndarray:
            grid = np.full(total, rest, dtype=values.dtype)
            grid[put] = values
            return two_stack(grid, w, op)[read] if total else grid

        result.append(pa.array(scan(np.ones(len(rows), dtype=np.int64), 0, np.add)))
        for m in measures:
            there = columns[m.name].is_valid().to_numpy(zero_copy_only=False)
            count = scan(there.astype(np.int64), 0, np.add)
            totals, units = m.totals(columns[m.name], scan)
            none = count == 0
            with np.errstate(invalid="ignore", divide="ignore"):
                result += [pa.array(count), totals, pa.array(np.where(none, 0.0, units / np.maximum(count, 1)), mask=none)]
            for op in (np.minimum, np.maximum) if extremes else ():
                best = m.extreme(columns[m.name], there, scan, op)
                result.append(best.take(pa.array(np.arange(len(best)), mask=none)))
    return pa.Table.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(result, schema, strict=True)], schema=schema)


def trailing(df: DataFrame, entity: Column, day: Column, known_at: Column, measures: dict[str, Column], windows: Sequence[int] = (7, 30), required: Column | None = None, extremes: bool = True, block_days: int = BLOCK_DAYS) -> DataFrame:
    """One row per entity and calendar day from its first to its last row: per window w ``rows_w``, and per measure m ``m_count_w``, ``m_total_w``,
    ``m_average_w`` and, with ``extremes``, ``m_min_w`` and ``m_max_w``."""
    reach = max(windows) - 1
    if reach > block_days:
        raise ValueError("block_days must not be less than the longest window")
    if clash := {"entity", "day", "block", "first", "last", "known_at"} & set(measures):
        raise ValueError(f"measures may not be named {sorted(clash)}")
    kinds = df.select(*[c.alias(n) for n, c in measures.items()]).schema
    ordered = [Measure.of(n, kinds[n].dataType) for n in measures]
    rows = df.filter(required) if required is not None else df
    rows = rows.select(entity.cast("string").alias("entity"), F.unix_date(day.cast("date")).alias("day"), known_at.alias("known_at"), *[m.column(measures[m.name]).alias(m.name) for m in ordered]).filter("entity is not null and day is not null")
    names = [m.name for m in ordered]
    if names:
        daily = rows.groupBy("entity", "day").agg(F.max(F.struct("known_at", *names)).alias("r")).select("entity", "day", *[f"r.{n}" for n in names])
    else:
        daily = rows.select("entity", "day").distinct()
    block = F.floor(F.col("day") / block_days).cast("int")
    also_next = F.col("day") >= (block + 1) * block_days - reach
    data = daily.withColumn("block", F.explode(F.when(also_next, F.array(block, block + 1)).otherwise(F.array(block))))
    data = data.withColumns({"first": F.lit(None).cast("int"), "last": F.lit(None).cast("int")})
    span = daily.groupBy("entity").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))  # of the daily rows, which are there already
    mark = span.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block_days).cast("int"), F.floor(F.col("hi") / block_days).cast("int"))))
    blank = {f.name: F.lit(None).cast(f.dataType) for f in daily.schema if f.name in names}
    mark = mark.withColumns({"first": F.greatest("lo", F.col("block") * block_days), "last": F.least("hi", (F.col("block") + 1) * block_days - 1), "day": F.lit(None).cast("int")} | blank).drop("lo", "hi")
    fields = [("entity", pa.string()), ("day", pa.int32())]
    for w in windows:
        fields.append((f"rows_{w}", pa.int64()))
        for m in ordered:
            fields += [(f"{m.name}_count_{w}", pa.int64()), (f"{m.name}_total_{w}", m.type), (f"{m.name}_average_{w}", pa.float64())]
            fields += [(f"{m.name}_{x}_{w}", m.type) for x in ("min", "max") if extremes]
    schema = pa.schema(fields)
    sql = {pa.string(): "string", pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double"}
    ddl = ", ".join(f"`{f.name}` {sql.get(f.type) or f'decimal({f.type.precision},{f.type.scale})'}" for f in schema)
    grid = map_sorted_groups(data.unionByName(mark), ["entity", "block"], ["day"], lambda t: _windows(t, windows, ordered, schema, extremes), ddl)
    return grid.withColumn("day", F.date_from_unix_date("day"))
