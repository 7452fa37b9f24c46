import datetime as dt
import random

import pytest

from quillstone.operators import snapdiff
from quillstone.sources.versions import Versions


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def brute(rows):
    states = {}
    for day, k, v in rows:
        if day is not None and k is not None:
            states.setdefault(day, {}).setdefault(k, set()).add(v)
    out, days = set(), sorted(states)
    for a, b in zip(days, days[1:]):
        for k in states[a].keys() | states[b].keys():
            x, y = states[a].get(k), states[b].get(k)
            x, y = x if x is None else x - {None}, y if y is None else y - {None}
            if x != y:
                out.add((b, k, "added" if x is None else "removed" if y is None else "changed"))
    return out


def index_at(spark, tmp_path, **more):
    return snapdiff.SnapshotIndex(spark, f"file://{tmp_path}/index", **more)


def rows_of(changes):
    return {(r.snapshot, r.key, r.change) for r in changes.collect()}


@pytest.mark.parametrize("bucket_rows", [1, 1_000_000])
def test_against_brute_force(spark, tmp_path, bucket_rows):
    rng = random.Random(1)
    rows = [(d(rng.choice([0, 1, 2, 5, 9])), rng.choice([*"abcdefgh", None]), rng.choice(["x", "y", None])) for _ in range(120)]
    rows += rows[:20] + [(None, "a", "x")]
    df = spark.createDataFrame([(*r, "own", 3) for r in rows], "s date, k string, v string, snapshot string, hash int")
    found = index_at(spark, tmp_path, bucket_rows=bucket_rows).apply(df, "s", "k", "v")
    assert rows_of(found) == brute(rows) and found.count() == len(brute(rows))
    full = snapdiff.with_values(found, df, "s", "k", "v").collect()
    assert {(r.snapshot, r.key, r.change) for r in full} == brute(rows) and len(full) == len(brute(rows))
    assert all((r.old_state is None) == (r.change == "added") and (r.new_state is None) == (r.change == "removed") for r in full)
    sets = {}
    for day, k, v in rows:
        if day and k:
            sets.setdefault((day, k), set()).add(v)
    assert all(set(r.new_state) == sets[r.snapshot, r.key] - {None} for r in full if r.new_state is not None)


def test_one_snapshot_and_none(spark, tmp_path):
    index = index_at(spark, tmp_path)
    assert index.apply(spark.createDataFrame([], "s date, k string, v string"), "s", "k", "v").count() == 0 and index.index() is None
    assert index.apply(spark.createDataFrame([(d(0), "a", "x")], "s date, k string, v string"), "s", "k", "v").count() == 0
    assert [r.key for r in index.index().collect()] == ["a"]


def test_kept_index_swaps_day_by_day(spark, tmp_path):
    make = lambda n, rows: spark.createDataFrame([(d(n), *r) for r in rows], "s date, k string, v string")
    step = lambda n, rows: {(r.key, r.change) for r in index_at(spark, tmp_path).apply(make(n, rows), "s", "k", "v").collect()}
    assert step(0, [("a", "x"), ("b", "x"), ("b", "y")]) == set()
    assert step(1, [("a", "x"), ("b", "y"), ("b", "x"), ("c", None)]) == {("c", "added")}
    assert step(1, [("z", "x")]) == set()  # that day is done
    assert step(3, [("a", "z"), ("c", None)]) == {("a", "changed"), ("b", "removed")}
    assert step(4, [("q", "z")]) == {("q", "added"), ("a", "removed"), ("c", "removed")}
    step(5, [("q", "z")])
    assert len([p for p in (tmp_path / "index").iterdir() if p.name.startswith("v-")]) == 2  # the index in use and the one before it


def test_a_job_that_dies_leaves_the_old_index_in_use(spark, tmp_path, monkeypatch):
    make = lambda n, rows: spark.createDataFrame([(d(n), *r) for r in rows], "s date, k string, v string")
    index_at(spark, tmp_path).apply(make(0, [("a", "x"), ("b", "x")]), "s", "k", "v")
    monkeypatch.setattr(Versions, "use", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        index_at(spark, tmp_path).apply(make(1, [("a", "y")]), "s", "k", "v")
    monkeypatch.undo()
    assert {(r.key, r.change) for r in index_at(spark, tmp_path).apply(make(1, [("a", "y")]), "s", "k", "v").collect()} == {("a", "changed"), ("b", "removed")}


def test_the_kept_index_is_read_where_it_lies(spark, tmp_path):
    index = index_at(spark, tmp_path)
    index.apply(spark.createDataFrame([(d(0), str(i), "x") for i in range(500)], "s date, k string, v string"), "s", "k", "v")
    kept = index.index()
    plan = kept.groupBy("bucket").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert {r.key for r in kept.collect()} == {str(i) for i in range(500)}
