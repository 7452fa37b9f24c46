import numpy as np
import pytest

from quillstone.llm import packing


def plain_sum_of_squares(sizes, capacity):
    """The rule as stated: try every level, recompute the whole sum."""
    fills, home = [], []
    for s in sizes:
        levels = sorted({f for f in fills if f + s <= capacity} | {0}, reverse=True)

        def total(h):
            after = list(fills)
            if h:
                after.remove(h)
            after.append(h + s)
            return sum(after.count(x) ** 2 for x in set(after) if 0 < x < capacity)

        costs = {h: total(h) for h in levels}
        best = max(h for h in levels if costs[h] == min(costs.values()))
        if best:
            i = max(i for i, f in enumerate(fills) if f == best)
            fills[i] += s
        else:
            fills.append(s)
            i = len(fills) - 1
        home.append(i)
    return fills


@pytest.mark.parametrize("seed", range(6))
def test_rule_against_its_statement(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 12, 150)
    home, used = packing.sum_of_squares(sizes, 12)
    assert sorted(np.bincount(home, weights=sizes, minlength=used).astype(int)) == sorted(plain_sum_of_squares(sizes.tolist(), 12))


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_tight_and_never_overfull(seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(1 + rng.exponential(200, 5000).astype(int), 1023)
    box = packing.pack(sizes, 1024)
    fill = np.bincount(box, weights=sizes)
    assert fill.max() <= 1024 and fill.min() > 0 and fill.mean() > 0.99 * 1024
    assert (np.bincount(packing.best_fit(sizes, 1024)[0], weights=sizes) <= 1024).all()
    assert len(packing.pack(np.zeros(0, int), 1024)) == 0


def test_over_spark(spark):
    rng = np.random.default_rng(1)
    sizes = [0, None, 1, 1024, 1025, 5000, 1023, *rng.integers(1, 900, 400).tolist()]
    rows = [(i, s, "own") for i, s in enumerate(sizes)] + [(4, 1025, "own"), (4, 1025, "own"), (None, 300, "own")]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens int, container string").repartition(5)
    out = packing.containers(df, "doc_id", len(rows), 1024, shard_items=100).collect()
    again = packing.containers(df.repartition(2), "doc_id", len(rows), 1024, shard_items=100).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    fill, spans = {}, {}
    for r in out:
        if r.n_tokens == 0:
            assert r.container is None and r.start is None
            continue
        fill[r.container] = fill.get(r.container, 0) + r.n_tokens
        spans.setdefault(r.container, []).append((r.start, r.start + r.n_tokens))
        assert r.first_token == 1024 * r.piece
    assert max(fill.values()) <= 1024
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    tokens = {}
    for r in out:
        tokens.setdefault(r.doc_id, []).append(r.n_tokens)
    assert sum(map(sum, tokens.values())) == sum((s or 0) for _, s, _ in rows)
    for i, s in enumerate(sizes):
        if i != 4:
            assert sorted(tokens[i]) == sorted(([1024] * ((s or 0) // 1024) + ([(s or 0) % 1024] if (s or 0) % 1024 or not s else [])))
    assert sorted(tokens[4]) == [1, 1, 1, 1024, 1024, 1024]
    assert packing.containers(df.limit(0), "doc_id", 0).count() == 0
    assert sum(r.n_tokens for r in packing.fills(packing.containers(df, "doc_id", len(rows))).collect()) == sum(fill.values())
