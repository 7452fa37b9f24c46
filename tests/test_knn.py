import numpy as np

from quillstone.operators import knn


def test_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(0)
    v = rng.normal(size=(150, 8)).astype(np.float32)
    v[10] = v[11] = v[12]
    rows = [(i, [float(x) for x in v[i]], "own") for i in range(150)] + [(200, None, "own"), (201, [], "own"), (202, [0.0] * 8, "own"), (203, [1.0] * 3, "own"), (204, [None] + [1.0] * 7, "own")]
    df = spark.createDataFrame(rows, "id long, v array<float>, rank string")
    queries = df.filter("id % 5 = 0")
    got = {}
    for r in knn.nearest_of_each(queries, df, "id", "v", 4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.neighbour_id, r.distance))
    n = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    assert set(got) == set(range(0, 150, 5))
    for q, found in got.items():
        d = np.round(1 - n @ n[q], 9)
        want = sorted((d[i], i) for i in range(150) if i != q)[:4]
        assert [(f[1]) for f in sorted(found)] == [i for _, i in want]
        assert np.allclose([f[2] for f in sorted(found)], [x for x, _ in want], atol=1e-8)


def test_single_query_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0])], "id long, v array<float>")
    assert [(r.id, round(r.distance, 4)) for r in knn.nearest(df, "id", "v", [2.0, 0.0], 3).collect()] == [(1, 0.0), (3, 0.2929), (4, 0.2929)]
    assert knn.nearest(df.limit(0), "id", "v", [1.0], 3).count() == 0
    assert knn.nearest_of_each(df.limit(0), df, "id", "v", 3).count() == 0
