"""Write modes, reshapes and snapshot streams; each stream must give its batch twin's rows."""

import json

import pytest
from pyspark.sql import functions as F

from duelbook.operators import frames
from duelbook.plans import serve
from duelbook.sources import adapter, io
from duelbook.streaming import snapshots

FOLDER = "/root/testdata/sf0.001"


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda rows: spark.createDataFrame(rows, "id long, season long, v string")
    read = lambda: {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    io.write_merge(df([(1, 1, "a"), (2, 1, "b")]), path, ["id"])
    io.write_merge(df([(2, 1, "c"), (3, 2, "d")]), path, ["id"])
    assert read() == {1: "a", 2: "c", 3: "d"}
    (tmp_path / "t").rename(tmp_path / "t.old")  # as if cut off between the renames
    io.write_merge(df([(3, 2, "e")]), path, ["id"])
    assert read() == {1: "a", 2: "c", 3: "e"} and not (tmp_path / "t.old").exists()
    by_season = str(tmp_path / "m")
    for rows in ([(1, 1, "a"), (2, 2, "b")], [(2, 2, "c"), (3, 2, "d")]):
        io.write_merge(df(rows), by_season, ["id"], "season")
    assert {(r["id"], r["season"], r["v"]) for r in spark.read.parquet(by_season).collect()} == {(1, 1, "a"), (2, 2, "c"), (3, 2, "d")}
    io.write_merge(df([(3, 2, "d")]), path, ["id"])
    io.write_append(df([(4, 2, "e")]), path)
    assert len(read()) == 4
    io.write_replace([df([(9, 1, "x")]), df([(8, 1, "y")])], path)
    assert read() == {9: "x", 8: "y"}
    part = str(tmp_path / "p")
    io.write_partition_replace(df([(1, 1, "a"), (2, 2, "b")]), part, "season")
    io.write_partition_replace(df([(3, 2, "c")]), part, "season")
    assert {r["id"] for r in spark.read.parquet(part).collect()} == {1, 3}
    snap = str(tmp_path / "s")
    for day, v in (("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "c")):
        io.write_daily_snapshot(df([(1, 1, v)]), snap, ["id"], day)
    assert {(str(r["snapshot_date"]), r["v"]) for r in spark.read.parquet(snap).collect()} == {("2024-01-01", "b"), ("2024-01-02", "c")}


def test_flat_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n,y\n")
    rows, dropped = io.scan_flat(spark, str(tmp_path / "a.csv"), ["id", "name"], key=["id"])
    assert rows.count() == 1 and dropped.first()[0] == 1
    with pytest.raises(ValueError):
        io.scan_flat(spark, str(tmp_path / "a.csv"), ["other"])
    (tmp_path / "n.json").write_text(json.dumps({"id": 1, "teams": [{"team": "a", "stats": [{"k": "x", "v": "1"}]}]}) + "\n")
    got = io.scan_ndjson(spark, str(tmp_path / "n.json"), "id long, teams array<struct<team:string,stats:array<struct<k:string,v:string>>>>")
    assert got.select(F.col("teams")[0]["stats"][0]["v"]).first()[0] == "1"
    files = spark.createDataFrame([("p", bytearray(b"1")), ("q", bytearray(b"2"))], "path string, content binary")
    ledger = files.limit(1).select(F.sha2("content", 256).alias("file_sha256"))
    assert [r["path"] for r in io.hash_skip(files, ledger).collect()] == ["q"]


def test_numbered(spark):
    df = spark.range(500).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3 END AS g", "CASE WHEN id % 50 = 0 THEN NULL ELSE id * 7 % 101 END AS a", "id AS b")
    got = {r["b"]: r["n"] for r in frames.numbered(df, ["g"], ["a", "b"], "n").collect()}
    want = {}
    for g in (None, 1, 2):
        for n, r in enumerate(sorted((r for r in df.collect() if r["g"] == g), key=lambda r: (r["a"] is not None, r["a"] or 0, r["b"]))):
            want[r["b"]] = n
    assert got == want and frames.numbered(df.limit(0), ["g"], ["a", "b"], "n").count() == 0


def test_reshapes(spark):
    pairs, bad = io.pair_consecutive_rows(spark.createDataFrame([(1, "V", 10), (2, "H", 7), (3, "H", 1), (4, "V", 2)], "n long, kind string, pts long").withColumn("g", F.lit(1)), ["g"], ["n"], "kind", ["pts"])
    assert [(r["visitor_pts"], r["home_pts"]) for r in pairs.collect()] == [(10, 7)] and bad.count() == 1
    spread, total = io.split_spread_total(F.col("v"), F.col("h"))
    got = spark.createDataFrame([(45.0, 3.0), (7.0, 50.0), (None, 3.0)], "v double, h double").select(spread, total).collect()
    assert [tuple(r) for r in got] == [(-3.0, 45.0), (7.0, 50.0), (None, None)]
    with pytest.raises(ValueError):
        io.orphan_filter(spark.range(10), spark.range(1), ["id"])


def streamed(spark, caps, tmp_path, job, mode):
    """Rows that a stream job emits over the captures, given in two files by time."""
    edge = sorted(r[0] for r in caps.select("captured_at").collect())[caps.count() // 2]
    for name, part in (("1", caps.filter(F.col("captured_at") <= edge)), ("2", caps.filter(F.col("captured_at") > edge))):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / name))
    source = spark.readStream.schema(caps.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    table = job.__name__
    query = job(source).writeStream.format("memory").queryName(table).option("checkpointLocation", str(tmp_path / "c")).outputMode(mode).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    return spark.table(table)


@pytest.fixture(scope="module")
def caps(spark):
    return adapter.Tables(spark, FOLDER)["captures"].select("game_id", "captured_at", "event_id", "status", "points", "state_hash")


def test_changes_stream_equals_batch(spark, caps, tmp_path):
    want = {r["event_id"] for r in snapshots.changes(caps).collect()}
    assert {r["event_id"] for r in streamed(spark, caps, tmp_path, snapshots.changes_stream, "append").collect()} == want


def test_latest_stream_equals_batch(spark, caps, tmp_path):
    got = snapshots.live_now(streamed(spark, caps, tmp_path, snapshots.latest_in_horizon, "update"))
    want = serve.live_scoreboard(adapter.Tables(spark, FOLDER))
    assert {(r["game_id"], r["captured_at"], r["state_hash"]) for r in got.collect()} == {(r["game_id"], r["captured_at"], r["state_hash"]) for r in want.collect()}


def test_capture_appends_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    for _ in range(2):
        snapshots.capture(spark.readStream.schema("id long").parquet(src), out, str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.select("run_at").distinct().count() == 1
