import os

import pytest

from quillstone.operators import merge
from quillstone.sources.versions import Versions

S = "k string, a string, b int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_per_key_with_ties_nulls_and_repeats(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("x", "q", 2), ("x", "z", 1), ("y", None, None), (None, "n", 1)], S)
    assert rows(merge.last_per_key(df, ["k"], ["b"])) == sorted([("x", "q", 2), ("y", None, None), (None, "n", 1)], key=str)


def test_upsert_rules_and_idempotence(spark):
    t = spark.createDataFrame([("x", "old", 1), ("y", "old", 2), (None, "keep", 3)], S)
    s = spark.createDataFrame([("x", None, 9), ("z", "new", 4), (None, "own", 5)], S)
    once = merge.upsert(t, s, ["k"], {"a": merge.keep_old_if_null})
    assert rows(once) == sorted([("x", "old", 9), ("y", "old", 2), ("z", "new", 4), (None, "keep", 3), (None, "own", 5)], key=str)
    again = merge.upsert(once.filter("k is not null"), s.filter("k is not null"), ["k"], {"a": merge.keep_old_if_null})
    assert rows(again) == rows(once.filter("k is not null"))
    assert rows(merge.upsert(t, s, ["k"], {"b": merge.keep_old}).filter("k = 'x'")) == [("x", None, 1)]
    assert rows(merge.upsert(t.limit(0), s, ["k"])) == rows(s) and rows(merge.upsert(t, s.limit(0), ["k"])) == rows(t)


def test_replace_children(spark):
    t = spark.createDataFrame([("x", "1", 1), ("x", "2", 2), ("y", "1", 1)], S)
    assert rows(merge.replace_children(t, spark.createDataFrame([("x", "9", 9)], S), "k")) == [("x", "9", 9), ("y", "1", 1)]


def test_pending(spark):
    wanted = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "h"), ("d", "h")], "id string, content_hash string")
    state = spark.createDataFrame([("a", "h", "ok"), ("b", "h", "error"), ("c", "g", "ok")], "id string, content_hash string, status string")
    assert {r.id for r in merge.pending(wanted, state, ["id"]).filter("pending").collect()} == {"b", "c", "d"}


def test_versions(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}/t")
    assert v.current() is None and v.read() is None
    a = v.write(spark.range(3).toDF("n"))
    assert v.current() is None
    v.use(a)
    b = v.write(spark.range(5).toDF("n"))
    assert v.read().count() == 3
    v.use(b)
    assert v.read().count() == 5 and v.prune() == 1 and v.read().count() == 5


def test_a_writer_that_dies_leaves_the_old_version_in_use(spark, tmp_path, monkeypatch):
    v = Versions(spark, f"file://{tmp_path}/t")
    v.use(v.write(spark.range(3).toDF("n")))
    b = v.write(spark.range(5).toDF("n"))
    real = os.listdir(f"{tmp_path}/t")
    (tmp_path / "t" / ".pointer-half").write_text('{"na')  # killed while it wrote the pointer
    (tmp_path / "t" / "v-half").mkdir()  # killed while it wrote a version
    assert v.read().count() == 3 and set(real) < set(os.listdir(f"{tmp_path}/t"))

    def dies(*_args, **_more):
        raise KeyboardInterrupt

    monkeypatch.setattr(Versions, "_pointers", dies)
    with pytest.raises(KeyboardInterrupt):
        v.use(b)
    monkeypatch.undo()
    assert Versions(spark, f"file://{tmp_path}/t").read().count() == 3
    v.use(b)
    assert v.read().count() == 5
    with pytest.raises(ValueError, match="in use"):
        v.write(spark.range(1).toDF("n"), b)
    assert v.prune() == 2 and v.read().count() == 5  # the old version and the half one


def test_two_writers_cannot_publish_the_same_number(spark, tmp_path, monkeypatch):
    v = Versions(spark, f"file://{tmp_path}/t")
    a, b = v.write(spark.range(1).toDF("n")), v.write(spark.range(2).toDF("n"))
    v.use(a)
    monkeypatch.setattr(Versions, "_pointers", lambda self: [])  # as a writer that looked before the first one published
    with pytest.raises(RuntimeError, match="another writer"):
        v.use(b)
    monkeypatch.undo()
    assert v.current() == a
