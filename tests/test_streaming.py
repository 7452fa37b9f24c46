import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillstone.operators import merge, parsefail
from quillstone.sources.versions import Versions
from quillstone.streaming import landing


def test_landed_lines_merge_and_replay(spark, tmp_path):
    source, table = tmp_path / "in", Versions(spark, f"file://{tmp_path}/table")
    source.mkdir()

    def rows(df):
        return parsefail.screen_rows(df).filter("row is not null").select("row.symbol", "row.latest", "file_name")

    def run():
        landing.merge_into(landing.lines(spark, str(source)), table, ["symbol"], ["file_name"], str(tmp_path / "cp"), rows).awaitTermination()

    (source / "a.csv").write_text("AA,n,1,,,,,,,\nBB,n,2,,,,,,,\nbroken\n")
    run()
    assert {(r.symbol, float(r.latest)) for r in table.read().collect()} == {("AA", 1.0), ("BB", 2.0)}
    (source / "b.csv").write_text("AA,n,3,,,,,,,\nCC,n,4,,,,,,,\n")
    run()
    run()
    assert {(r.symbol, float(r.latest)) for r in table.read().collect()} == {("AA", 3.0), ("BB", 2.0), ("CC", 4.0)}


def test_a_batch_moves_only_the_parts_it_touches_and_survives_a_crash(spark, tmp_path, monkeypatch):
    table = Versions(spark, f"file://{tmp_path}/table")
    base = spark.range(200).selectExpr("id as k", "0 as at", "'old' as v")
    merge.merge_parts(table, base, ["k"], ["at"], "v-000000000000", 16)
    before = table.entry()["parts"]
    one = spark.createDataFrame([(7, 1, "new")], "k long, at int, v string")
    monkeypatch.setattr(Versions, "use", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        merge.merge_parts(table, one, ["k"], ["at"], "v-000000000001", 16)
    monkeypatch.undo()
    assert table.read().filter("v = 'old'").count() == 200  # written, not published
    merge.merge_parts(table, one, ["k"], ["at"], "v-000000000001", 99)
    merge.merge_parts(table, one, ["k"], ["at"], "v-000000000001", 99)  # replayed
    after = table.entry()["parts"]
    assert len(after) == 16 and sum(before[p] != after[p] for p in before) == 1
    assert {(r.k, r.v) for r in table.read().collect()} == {(i, "new" if i == 7 else "old") for i in range(200)}
    merge.merge_parts(table, one.limit(0), ["k"], ["at"], "v-000000000002", 16)
    assert table.current() == "v-000000000001"


def test_committed_files_are_archived(spark, tmp_path):
    source, kept = tmp_path / "in", tmp_path / "kept"
    source.mkdir()
    table = Versions(spark, f"file://{tmp_path}/table")
    for name in ("a", "b", "c"):
        (source / f"{name}.csv").write_text(f"{name}\n")
        landing.merge_into(landing.lines(spark, str(source), 1, str(kept)), table, ["c0"], ["file_name"], str(tmp_path / "cp")).awaitTermination()
    assert {r.c0 for r in table.read().collect()} == {"a", "b", "c"}
    assert [p.name for p in kept.rglob("*.csv")] and not {p.name for p in kept.rglob("*.csv")} & {p.name for p in source.iterdir()}


def test_event_time_windows_drop_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    at = lambda day, hour=0: dt.datetime(2024, 1, day, hour)
    schema = "ts timestamp, kind string"
    for rows in ([(at(1), "a"), (at(1, 5), "a"), (at(2), "b")], [(at(10), "a")], [(at(1), "a"), (at(11), "b")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        q = landing.counts_by_window(landing.records(spark, str(source), schema), "ts", ["kind"]).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {(r.window_start.day, r.kind, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert (1, "a", 2) in got and (2, "b", 1) in got and not any(d == 1 and k == "a" and n != 2 for d, k, n in got)


def test_first_seen(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(dt.datetime(2024, 1, 1), "x"), (dt.datetime(2024, 1, 2), "x"), (dt.datetime(2024, 1, 1), "y")], "ts timestamp, k string").write.parquet(str(source))
    q = landing.first_seen(landing.records(spark, str(source), "ts timestamp, k string"), ["k"], "ts").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("k").agg(F.count("*").alias("n")).filter("n = 1").count() == 2
