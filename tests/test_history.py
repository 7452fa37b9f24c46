import datetime as dt
import random

from pyspark.sql import functions as F

from quillstone.functions import keys as K
from quillstone.operators import history

SCHEMA = "k string, day date, v string, at timestamp_ntz, attribute string, same string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    said = history.statements(df, F.col("k"), F.col("day"), F.col("at"), {"v": (F.col("v"), K.loose_text("v"))})
    out = history.versions(history.last_of_day(said)).collect()
    return sorted((r.entity_key, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.value) for r in out)


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def t(n, h=0):
    return dt.datetime(2024, 1, 1, h) + dt.timedelta(n)


def test_rules(spark):
    rows = [
        ("a", d(0), "Tech", t(0)), ("a", d(1), "TECH.", t(1)), ("a", d(2), None, t(2)), ("a", d(3), "Health", t(3, 1)), ("a", d(3), "Energy", t(3, 5)), ("a", d(3), "Energy", t(3, 5)),
        ("b", d(1), "Tech", t(1)), ("a", d(5), "Tech", t(5)), ("b", d(5), "--", t(5)), (None, d(1), "Tech", t(1)), ("c", None, "Tech", t(1)),
    ]
    assert run(spark, rows) == [("a", "2024-01-01", "2024-01-04", "Tech"), ("a", "2024-01-04", "2024-01-06", "Energy"), ("a", "2024-01-06", None, "Tech"), ("b", "2024-01-02", None, "Tech")]


def stated(spark, rows):
    df = spark.createDataFrame(rows, "k string, day date, v string, at timestamp_ntz")
    return history.last_of_day(history.statements(df, F.col("k"), F.col("day"), F.col("at"), {"v": (F.col("v"), F.col("v"))}))


def test_each_state_is_compared_with_what_is_carried_to_it(spark):
    said = stated(spark, [("a", d(0), "x", t(0)), ("b", d(1), "x", t(1)), ("a", d(1), "y", t(1)), ("b", d(2), "x", t(2)), ("a", d(7), "y", t(7)), ("a", d(9), "z", t(9))])
    events = {(r.entity_key, r.day, r.event, r.previous) for r in history.changes(said).collect()}
    assert events == {("a", d(0), "inserted", None), ("a", d(1), "changed", "x"), ("b", d(1), "inserted", None), ("a", d(9), "changed", "y")}


def test_full_snapshots_delete_what_they_leave_out(spark):
    said = stated(spark, [("a", d(0), "x", t(0)), ("b", d(1), "x", t(1)), ("a", d(1), "y", t(1)), ("b", d(2), "x", t(2)), ("a", d(7), "y", t(7)), ("b", d(7), "w", t(7))])
    events = {(r.entity_key, r.day, r.event) for r in history.changes(said, carry=False).collect()}
    assert events == {("a", d(0), "inserted"), ("a", d(1), "changed"), ("b", d(1), "inserted"), ("a", d(2), "deleted"), ("a", d(7), "inserted"), ("b", d(7), "changed")}
    got = sorted((r.entity_key, r.value, r.valid_from, r.valid_to) for r in history.versions(said, carry=False).filter("valid_to is not null").collect())
    assert got == [("a", "x", d(0), d(1)), ("a", "y", d(1), d(2)), ("b", "x", d(1), d(7))]


def test_the_join_decides_what_is_a_version(spark):
    """An equal statement after a carried one is no version only because the join finds what was carried to it."""
    said = stated(spark, [("a", d(i), "x", t(i)) for i in range(5)])
    assert history.versions(said).count() == 1 and said.count() == 5


def test_empty_table(spark):
    assert run(spark, []) == []


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(600):
        n = rng.randrange(40)
        rows.append((rng.choice(["hot", "hot", "hot", "b", "c", None]), d(n), rng.choice(["A", "a ", "B", "b.", None, ""]), t(n, rng.randrange(24))))
    rows += rows[:50]
    best = {}
    for k, day, v, at in rows:
        same = "".join(c for c in (v or "").lower() if c.isalnum())
        if k and same:
            best.setdefault((k, day), []).append((at, same, v))
    want, last = [], {}
    for (k, day), options in sorted(best.items()):
        _, same, v = max(options)
        if last.get(k) != same:
            want.append((k, str(day), v))
            last[k] = same
    assert [(a, b, v) for a, b, _, v in run(spark, rows)] == sorted(want)
