import datetime as dt
import random
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.operators import rolling

SCHEMA = "t string, d date, c decimal(18,6), v bigint, at timestamp_ntz, entity string, block int"


@pytest.mark.parametrize("w", [1, 2, 7, 30])
@pytest.mark.parametrize(("op", "rest"), [(np.add, 0), (np.minimum, 10**6), (np.maximum, -(10**6))])
def test_two_stack_against_plain_windows(w, op, rest):
    rng = np.random.default_rng(w)
    x = rng.integers(-1000, 1000, w * 5)
    got = rolling.two_stack(x, w, op)
    for i in range(len(x)):
        assert got[i] == op.reduce(x[max(0, i - w + 1) : i + 1])


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA)
    return {(r.entity, r.day): r for r in rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {"c": F.col("c"), "v": F.col("v")}, (7, 30), required=F.col("c").isNotNull(), **kw).collect()}


@pytest.mark.parametrize("block", [29, 31, 364])
def test_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = []
    for k in ("hot", "b", "c"):
        day = rng.randrange(-50, 50)
        for _ in range(60):
            day += rng.choice([1, 1, 1, 2, 3, 9, 45])
            rows.append((k, d(day), Decimal(rng.randrange(1, 10**9)) / 10**6 if rng.random() < 0.9 else None, rng.choice([None, rng.randrange(10**6)]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(999))))
    rows += [(r[0], r[1], Decimal("1.5"), 7, dt.datetime(2025, 1, 1)) for r in rows[:20]] + rows[:10] + [(None, d(0), Decimal(1), 1, None), ("z", None, Decimal(1), 1, None), ("z", d(0), None, 1, None)]
    got = run(spark, rows, block_days=block)
    bars = {}
    for k, day, c, v, at in rows:
        if k and day and c is not None:
            bars.setdefault(k, {}).setdefault(day, []).append((at is not None, at or dt.datetime.min, c, v is not None, v or 0))
    want = 0
    for k, days in bars.items():
        best = {day: max(o) for day, o in days.items()}
        for n in range((max(best) - min(best)).days + 1):
            day = min(best) + dt.timedelta(n)
            want += 1
            r = got[(k, day)]
            for w in (7, 30):
                inside = [best[x] for x in best if 0 <= (day - x).days < w]
                vol = [x[4] for x in inside if x[3]]
                assert r[f"rows_{w}"] == len(inside) and r[f"c_count_{w}"] == len(inside) and r[f"v_count_{w}"] == len(vol)
                assert r[f"c_total_{w}"] == sum((x[2] for x in inside), Decimal(0)) and r[f"v_total_{w}"] == sum(vol)
                assert (r[f"c_min_{w}"], r[f"c_max_{w}"]) == ((min(x[2] for x in inside), max(x[2] for x in inside)) if inside else (None, None))
                assert r[f"v_average_{w}"] == (pytest.approx(sum(vol) / len(vol)) if vol else None)
    assert len(got) == want


def test_totals_beyond_a_long_are_exact(spark):
    big = 2**63 - 1
    got = run(spark, [("a", d(i), Decimal("999999999999.999999"), big, None) for i in range(5)])
    assert got[("a", d(4))].v_total_7 == 5 * big and got[("a", d(4))].c_total_30 == 5 * Decimal("999999999999.999999") and got[("a", d(4))].v_max_7 == big


def test_measures_keep_the_scale_and_size_of_their_type(spark):
    rng = random.Random(3)
    wide = [Decimal(rng.choice([-1, 1]) * rng.randrange(10**rng.randrange(1, 37))).scaleb(-10) for _ in range(40)]
    fine = [Decimal(rng.randrange(-(10**18), 10**18)).scaleb(-9) for _ in range(40)]
    rows = [("a", d(i), wide[i] if i % 7 else None, fine[i], i / 3, -i) for i in range(40)] + [("big", d(i), Decimal(10) ** 26 * 9, Decimal("99999999999999.0").scaleb(-6), 1e300, -(2**31)) for i in range(3)]
    df = spark.createDataFrame(rows, "t string, d date, w decimal(38,10), f decimal(18,9), x double, n int").withColumn("at", F.lit(None).cast("timestamp"))
    got = {(r.entity, r.day): r for r in rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {c: F.col(c) for c in "wfxn"}, (7,), block_days=10).collect()}
    with localcontext() as c:
        c.prec = 60
        for i in range(40):
            r, inside = got[("a", d(i))], [j for j in range(max(0, i - 6), i + 1)]
            some = [wide[j] for j in inside if j % 7]
            assert r.w_count_7 == len(some) and r.w_total_7 == sum(some, Decimal(0)) and (r.w_min_7, r.w_max_7) == ((min(some), max(some)) if some else (None, None))
            assert r.f_total_7 == sum(fine[j] for j in inside) and r.f_min_7 == min(fine[j] for j in inside)
            assert r.x_total_7 == pytest.approx(sum(inside) / 3) and r.x_max_7 == i / 3 and r.n_total_7 == -sum(inside) and r.n_max_7 == -inside[0]
            if some:
                assert r.w_average_7 == pytest.approx(float(sum(some) / len(some)), rel=1e-9, abs=1e-6)
    r = got[("big", d(2))]
    assert r.w_total_7 == Decimal(10) ** 26 * 27 and r.w_max_7 == Decimal(10) ** 26 * 9 and r.n_total_7 == -3 * 2**31


def test_a_total_of_more_than_38_digits_is_null(spark):
    df = spark.createDataFrame([("a", d(i), Decimal(10) ** 37 * 9) for i in range(3)], "t string, d date, w decimal(38,0)").withColumn("at", F.lit(None).cast("timestamp"))
    got = {r.day: r for r in rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {"w": F.col("w")}, (7,)).collect()}
    assert got[d(0)].w_total_7 == Decimal(10) ** 37 * 9 and got[d(1)].w_total_7 is None and got[d(1)].w_average_7 == 9e37 and got[d(1)].w_max_7 == Decimal(10) ** 37 * 9


def test_empty_table_and_bad_arguments(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {}, (30,), block_days=10)
    with pytest.raises(ValueError):
        rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {"day": F.col("v")})
    with pytest.raises(ValueError, match="no number"):
        rolling.trailing(df, F.col("t"), F.col("d"), F.col("at"), {"x": F.col("t")})
