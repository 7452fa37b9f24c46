import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quillstone.operators import asof


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def run(spark, events, rows, bucket=64):
    e = spark.createDataFrame([(*x, "own", "own") for x in events], "id int, k string, day date, value string, entity string")
    a = spark.createDataFrame([(*x, "own") for x in rows], "k string, own date, at timestamp_ntz, v int, entity string")
    best = lambda name, rows: asof.daily_best(rows, name, F.col("k"), F.col("own"), F.col("at"), F.col("v"))
    out = asof.as_known(e, F.col("k"), F.col("day"), asof.intervals(best("v", a), best("w", a.limit(0)), best("x", a.filter("k = 'a'"))), bucket).collect()
    assert sorted((r.id, r.value) for r in out if r.attribute == "x") == sorted((r.id, r.value) for r in out if r.attribute == "v" and r.entity == "a")
    return sorted((r.id, r.own_day, r.known_at, int(r.value)) for r in out if r.attribute == "v")


@pytest.mark.parametrize("bucket", [1, 7, 64])
def test_against_brute_force(spark, bucket):
    rng = random.Random(bucket)
    rows = []
    for _ in range(150):
        own = rng.randrange(100)
        rows.append((rng.choice(["a", "b", "c", None]), d(own), dt.datetime(2024, 1, 1) + dt.timedelta(own + rng.choice([-3, 0, 0, 1, 30]), hours=rng.randrange(3)), rng.choice([None, 1, 2, 3])))
    events = [(i, rng.choice(["a", "a", "a", "b", "x", None]), d(rng.randrange(-5, 130)) if rng.random() < 0.95 else None) for i in range(120)]
    want = []
    for i, k, day in events:
        ok = [(own, at, v) for kk, own, at, v in rows if k is not None and day is not None and kk == k and v is not None and own <= day and at.date() <= day]
        if ok:
            want.append((i, *max(ok)))
    assert run(spark, events + events[:10], rows + rows[:10], bucket) == sorted(want)


def test_a_late_row_of_an_older_day_never_hides_a_newer_one(spark):
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(n)
    rows = [("a", d(1), at(1), 1), ("a", d(5), at(5), 2), ("a", d(3), at(20), 9)]
    assert [x[3] for x in run(spark, [(1, "a", d(4)), (2, "a", d(30)), (3, "a", d(0))], rows)] == [1, 2]


def test_far_days_cost_no_buckets(spark):
    rows = [("a", dt.date(1, 1, 1), dt.datetime(1, 1, 1), 1), ("a", d(5), dt.datetime(2024, 1, 6), 2)]
    assert [x[3] for x in run(spark, [(1, "a", d(4)), (2, "a", dt.date(9999, 12, 31)), (3, "a", dt.date(1500, 1, 1))], rows, 1)] == [1, 2, 1]


def test_empty_inputs(spark):
    assert run(spark, [], [("a", d(0), dt.datetime(2024, 1, 1), 1)]) == []
    assert run(spark, [(1, "a", d(0))], []) == []
