"""Implausible readings per source: physical bounds, Hampel filter, stuck values.

Readings are reduced to one per source and moment, the last known (map-side combined), and cut into blocks of ``block_days`` per source with the readings of
``halo_days`` around them, so that no source's history, however dense or hot, comes into one task. One Arrow block holds many such groups, on which everything
is vectorised.

* bounds: a reading that cannot be, by itself or against the others of its row.
* spike: on the log scale, further from the rolling median than ``sigmas`` times the source's scale around that time: the rolling median absolute deviation from
  the rolling median, or the rolling median size of its moves if that is more (a source that stands still on most days has no deviation; where it hardly ever moves, that of all its
  moves in the block). Nothing is fixed across sources. The scale's wide window is taken at every ``STRIDE``-th reading and holds for the readings around it. A spike must also stand away
  from the medians of the readings just before and just after it, so that the first reading of a level that lasts is none.
* stuck: a run of one repeated reading of at least ``stuck_run`` rows in a source most of whose readings are not repeated.

Defined results: null readings and rows without source or time are skipped, never flagged and do not cut a run; readings of zero or below have no
logarithm and take no part in medians; fewer than five readings around give no spike; repeated rows count once. Windows reach ``halo_days`` beyond a block at
most, and how usual repeats are is told per block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators.grouped import map_sorted_groups, starts


#: Every how many readings the wide window is evaluated.
STRIDE = 15
#: Fewer moves than this say nothing about the size of moves.
FEW = 5


@dataclass(frozen=True)
class Hampel:
    """Half width of the rolling median and of the rolling deviation in rows, and how many times the deviation is a spike."""

    half: int
    sigmas: float
    wide: int = 60


def medians(x: np.ndarray, begin: np.ndarray, before: int, after: int, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Median and number of finite values among ``before`` rows before, the row itself if ``own``, and ``after`` rows after, within the group."""
    n, pad = len(x), max(before, after)
    size = np.diff(np.append(begin, n))
    at = np.arange(n) + pad * (np.repeat(np.arange(len(begin)), size) + 1)
    wide = np.full(n + pad * (len(begin) + 1), np.nan)
    wide[at] = x
    view = sliding_window_view(wide, before + 1 + after)[at - before]
    if not own:
        view = np.delete(view, before, axis=1)
    view = np.sort(view, axis=1)  # NaN last
    count = (~np.isnan(view)).sum(axis=1)
    low, high = np.maximum(count - 1, 0) // 2, np.minimum(count // 2, view.shape[1] - 1)
    rows = np.arange(n)
    with np.errstate(invalid="ignore"):
        return np.where(count > 0, (view[rows, low] + view[rows, high]) / 2, np.nan), count


def wide_medians(x: np.ndarray, begin: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Median and number of finite values among ``half`` rows on both sides of the middle of each stretch of ``STRIDE`` rows, for all rows of the stretch."""
    n = len(x)
    size = np.diff(np.append(begin, n))
    first = np.repeat(begin, size)
    middle = np.minimum((np.arange(n) - first) // STRIDE * STRIDE + STRIDE // 2, np.repeat(size, size) - 1) + first
    at, of = np.unique(middle, return_inverse=True)
    wide = np.full(n + half * (len(begin) + 1), np.nan)
    slot = np.arange(n) + half * (np.repeat(np.arange(len(begin)), size) + 1)
    wide[slot] = x
    view = np.sort(sliding_window_view(wide, 2 * half + 1)[slot[at] - half], axis=1)  # NaN last
    count = (~np.isnan(view)).sum(axis=1)
    rows = np.arange(len(at))
    low, high = np.maximum(count - 1, 0) // 2, np.minimum(count // 2, view.shape[1] - 1)
    middle_of = np.where(count > 0, (view[rows, low] + view[rows, high]) / 2, np.nan)
    return middle_of[of], count[of]


def _by_group(values: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """Median of each group's finite values if it has ``FEW``, else 0, spread over its rows."""
    out = np.zeros(len(begin))
    for i, part in enumerate(np.split(values, begin[1:])):
        part = part[np.isfinite(part)]
        if len(part) >= FEW:
            out[i] = np.median(part)
    return np.repeat(out, np.diff(np.append(begin, n)))


def spike_mask(value: np.ndarray, begin: np.ndarray, how: Hampel) -> np.ndarray:
    """Rows whose reading is a passing spike."""
    n = len(value)
    if n == 0:
        return np.zeros(0, dtype=bool)
    with np.errstate(invalid="ignore", divide="ignore"):
        x = np.where(value > 0, np.log(value), np.nan)
    middle, count = medians(x, begin, how.half, how.half, True)
    away = np.abs(x - middle)
    step = np.full(n, np.nan)
    seen = np.flatnonzero(~np.isnan(x))
    if len(seen) > 1:
        home = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))[seen]
        move = np.abs(np.diff(x[seen]))
        step[seen[1:]] = np.where((home[1:] == home[:-1]) & (move > 0), move, np.nan)
    mad, _ = wide_medians(away, begin, how.wide)
    move, moves = wide_medians(step, begin, how.wide)
    usual = _by_group(step, begin, n)
    limit = how.sigmas * np.fmax(1.4826 * mad, np.where(moves >= FEW, move, usual))
    before, n_before = medians(x, begin, how.half, 0, False)
    after, n_after = medians(x, begin, 0, how.half, False)
    far = lambda m, k: np.where(k >= 2, np.abs(x - m), np.inf) > limit
    with np.errstate(invalid="ignore"):
        return (away > limit) & far(before, n_before) & far(after, n_after) & (count >= 5)


def stuck_mask(value: np.ndarray, begin: np.ndarray, run: int, usual_share: float) -> np.ndarray:
    """Rows of runs of at least ``run`` equal readings, in groups where fewer than ``usual_share`` of the distinct runs repeat a reading."""
    mask = np.zeros(len(value), dtype=bool)
    seen = np.flatnonzero(~np.isnan(value))
    if len(seen) == 0:
        return mask
    size = np.diff(np.append(begin, len(value)))
    home = np.repeat(np.arange(len(begin)), size)[seen]
    v = value[seen]
    fresh = np.append(True, (v[1:] != v[:-1]) | (home[1:] != home[:-1]))
    of = np.cumsum(fresh) - 1
    length = np.bincount(of)
    run_home = home[fresh]
    runs = np.bincount(run_home, minlength=len(begin))
    repeats = np.bincount(run_home, weights=length >= 2, minlength=len(begin))
    usual = repeats >= usual_share * np.maximum(runs, 1)
    hit = (length >= run) & ~(usual[run_home] & (runs[run_home] > 1))
    mask[seen] = hit[of]
    return mask


def _flags(table: pa.Table, spikes: dict[str, Hampel], stuck: tuple[str, ...], run: int, usual_share: float) -> pa.Table:
    begin = starts(table, ["source", "block"])
    values = {c: table.column(c).cast(pa.float64()).fill_null(float("nan")).to_numpy() for c in {*spikes, *stuck}}
    out = {"source": table.column("source"), "at": table.column("at"), "bounds": table.column("bounds")}
    for c, how in spikes.items():
        out[f"spike_{c}"] = pa.array(spike_mask(values[c], begin, how))
    for c in stuck:
        out[f"stuck_{c}"] = pa.array(stuck_mask(values[c], begin, run, usual_share))
    return pa.table(out).filter(table.column("own"))


def flags(df: DataFrame, source: Column, at: Column, known_at: Column, measures: dict[str, Column], bounds: Column, spikes: dict[str, Hampel], stuck: tuple[str, ...], stuck_run: int = 6, usual_share: float = 0.5, block_days: int = 1461, halo_days: int = 200) -> DataFrame:
    """One row per source and moment: source, at, ``bounds`` (kind or null), ``spike_<measure>`` and ``stuck_<measure>`` flags.

    ``at`` is a date or timestamp; readings within a day are kept apart. ``bounds`` is an expression over the measure names that gives the kind of an impossible
    row. For readings much denser than daily, choose shorter blocks."""
    if halo_days >= block_days:
        raise ValueError("halo_days must be less than block_days")
    used = list(dict.fromkeys([*spikes, *stuck]))
    rows = df.select(source.cast("string").alias("source"), at.alias("at"), known_at.alias("known_at"), *[c.alias(m) for m, c in measures.items()]).filter("source is not null and at is not null")
    # bounds are a matter of the row alone; told before the shuffle, the columns that only they need stay behind
    rows = rows.withColumn("bounds", bounds).select("source", "at", "known_at", "bounds", *[F.col(c).cast("double").alias(c) for c in used])
    last = rows.groupBy("source", "at").agg(F.max(F.struct("known_at", *used, "bounds")).alias("r")).select("source", "at", "r.bounds", *[f"r.{c}" for c in used])
    day = F.unix_date(F.col("at").cast("date"))
    own = F.floor(day / block_days).cast("int")
    inside = day - own * block_days
    blocks = F.array_compact(F.array(own, F.when(inside < halo_days, own - 1), F.when(inside >= block_days - halo_days, own + 1)))
    split = last.withColumn("own", own).withColumn("block", F.explode(blocks)).withColumn("own", F.col("own") == F.col("block"))
    schema = f"source string, at {rows.schema['at'].dataType.simpleString()}, bounds string" + "".join(f", spike_{c} boolean" for c in spikes) + "".join(f", stuck_{c} boolean" for c in stuck)
    return map_sorted_groups(split, ["source", "block"], ["at"], lambda t: _flags(t, spikes, stuck, stuck_run, usual_share), schema)
