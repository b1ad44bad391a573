"""Facts of contests: runs that make changed contests only, top plays and swings against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from duelbook.functions.exprs import live_win_probability
from duelbook.sources.adapter import Tables
from duelbook.stats import facts as fa

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    t = Tables(spark, FOLDER)
    for name in fa.INPUTS:
        t._made[name] = t[name].persist()
    return t


def changed(t, spark, **tables):
    return Tables(spark, FOLDER, dict(t._made) | tables)


def test_second_run_makes_changed_contests_only(spark, t, tmp_path):
    path = str(tmp_path / "facts")
    first = fa.refresh_facts(t, path)
    n = first.count()
    assert n == fa.finished(t["games"]).count() == spark.read.parquet(path).count()
    ids = sorted(r[0] for r in first.select("game_id").collect())
    assert fa.refresh_facts(t, path).count() == 0
    play = t["plays"].filter(F.col("game_id") == ids[3]).select("id").first()[0]
    other = changed(
        t, spark,
        plays=t["plays"].withColumn("play_text", F.when(F.col("id") == play, "edited").otherwise(F.col("play_text"))).repartition(7),
        lines=t["lines"].withColumn("spread", F.when(F.col("game_id") == ids[5], 0.5).otherwise(F.col("spread"))),
        games=t["games"].withColumn("home_points", F.when(F.col("id") == ids[7], 99).otherwise(F.col("home_points"))).withColumn("attendance", F.lit(1)),
    )
    had_line = t["lines"].filter(F.col("game_id") == ids[5]).count() > 0
    want = {ids[3], ids[7]} | ({ids[5]} if had_line else set())
    made = fa.refresh_facts(other, path)
    assert {r[0] for r in made.select("game_id").collect()} == want
    stored = spark.read.parquet(path)
    assert stored.count() == n and stored.filter(F.col("game_id") == ids[7]).first()["facts"]["home_points"] == 99
    assert fa.refresh_facts(other, path).count() == 0
    # A repeated input row is another input; a limit takes the latest contests.
    twice = changed(t, spark, plays=t["plays"].unionByName(t["plays"].filter(F.col("id") == play)))
    games = fa.finished(t["games"])
    a, b = ({r[0]: r[1] for r in fa.fingerprints(x, games).collect()} for x in (t, twice))
    assert {k for k in a if a[k] != b[k]} == {ids[3]}
    late = fa.due(games, fa.fingerprints(t, games), stored.limit(0), 4).collect()
    every = sorted(games.collect(), key=lambda g: (g["season"], g["week"], g["start_date"], g["id"]), reverse=True)
    assert [g["id"] for g in late] == [g["id"] for g in every[:4]]
    asked = stored.withColumn("regenerate", F.col("game_id") == ids[0])
    assert [r["id"] for r in fa.due(fa.finished(other["games"]), fa.fingerprints(other, fa.finished(other["games"])), asked).collect()] == [ids[0]]


def test_fold_keeps_the_best(spark):
    rng = random.Random(4)
    rows = [(i, [(float(rng.randint(0, 3)), rng.randint(0, 99)) for _ in range(rng.choice([0, 1, 4, 5, 6, 60]))]) for i in range(30)]
    df = spark.createDataFrame(rows, "i int, a array<struct<k: double, v: int>>")
    got = {r["i"]: [tuple(x) for x in r["b"]] for r in df.select("i", fa.best_of(F.col("a"), F.array().cast("array<struct<k: double, v: int>>"), 5).alias("b")).collect()}
    assert got == {i: sorted(a)[:5] for i, a in rows}


def test_swings(spark):
    paths = [[0.4, 0.6, 0.5, 0.7, 0.2], [0.5, 0.5], [0.9], [], None, [0.1, 0.9, 0.1]]
    got = [r["s"] for r in fa.swings(spark.createDataFrame(list(enumerate(paths)), "i int, p array<double>"), F.col("p")).orderBy("i").select(F.col("swing").alias("s")).collect()]
    assert tuple(got[0]) == (0.5, 0.2, 0.7, 2) and tuple(got[1]) == (0.0, 0.5, 0.5, 0) and tuple(got[5]) == (0.8, 0.1, 0.9, 2)
    assert got[2] is None and got[3] is None and got[4] is None


def test_contests_without_plays_or_lines(spark, t):
    one = fa.finished(t["games"]).limit(3)
    bare = changed(t, spark, plays=t["plays"].limit(0), lines=t["lines"].limit(0), play_stats=t["play_stats"].limit(0))
    rows = fa.game_facts(bare, one).collect()
    assert len(rows) == 3 and not any(r["wp_available"] for r in rows)
    f = rows[0]["facts"]
    assert f["top_plays"] == [] and f["leaders"]["passing"] is None and f["spread_result"] is None and f["wp_swing"]["largest_epa_play_epa"] is None
    assert fa.game_facts(bare, one.limit(0)).count() == 0
    no_line = changed(t, spark, lines=t["lines"].limit(0))
    told = [r["facts"] for r in fa.game_facts(no_line, fa.finished(t["games"])).collect() if r["facts"]["top_plays"]]
    assert told and all(f["wp_swing"]["largest_epa_play_epa"] == f["top_plays"][0]["epa"] for f in told)
    assert spark.range(1).select(live_win_probability(F.lit(0.0), F.lit(0.0), F.lit(1800))).first()[0] == pytest.approx(0.5, abs=1e-6)
