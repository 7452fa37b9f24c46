import pyarrow as pa
import pytest

from quillstone.operators.grouped import map_sorted_groups, starts, whole_groups


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_groups_are_never_cut(size):
    keys = ["a"] * 7 + ["b"] + ["c"] * 4 + [None] * 3
    rows = pa.table({"k": keys, "v": list(range(len(keys)))})
    batches = rows.to_batches(max_chunksize=size)
    parts = list(whole_groups(iter(batches), ["k"]))
    assert pa.concat_tables(parts).column("v").to_pylist() == list(range(len(keys)))
    seen = [set(p.column("k").to_pylist()) for p in parts]
    assert all(not (a & b) for i, a in enumerate(seen) for b in seen[i + 1 :])


def test_starts_of_empty_and_null_keys():
    assert len(starts(pa.table({"k": pa.array([], pa.string())}), ["k"])) == 0
    assert starts(pa.table({"k": [None, None, "a", "a", "b"]}), ["k"]).tolist() == [0, 2, 4]


def test_map_sorted_groups_over_spark(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(f"k{i % 5}", i) for i in range(50)], "k string, v int")

        def total(t: pa.Table) -> pa.Table:
            at = starts(t, ["k"])
            v = t.column("v").to_numpy()
            ends = [*at[1:], t.num_rows]
            return pa.table({"k": t.column("k").take(pa.array(at)), "n": [int(b - a) for a, b in zip(at, ends)], "ordered": [bool((v[a:b][1:] > v[a : b - 1]).all()) for a, b in zip(at, ends)]})

        rows = map_sorted_groups(df, ["k"], ["v"], total, "k string, n long, ordered boolean").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k, r.n, r.ordered) for r in rows) == [(f"k{i}", 10, True) for i in range(5)]
