"""Projections of a season against plain versions, and the latest row of each side."""

import itertools

import pytest
from pyspark.sql import functions as F

from duelbook.sources.adapter import Tables
from duelbook.stats import outlook as ol

GAMES = "id long, season long, season_type string, completed boolean, conference_game boolean, home_team string, away_team string, home_conference string, away_conference string, home_classification string, away_classification string, home_points long, away_points long"


def game(i, home, away, points=None, season=2020, kind="regular", division="fbs"):
    a, b = points or (None, None)
    return (i, season, kind, points is not None, True, home, away, "east", "east", division, division, a, b)


def tables(spark):
    games = [game(1, "A", "B", (20, 10)), game(2, "B", "C", (7, 7)), game(3, "C", "A"), game(4, "A", "B"), game(5, "B", "C"), game(6, "A", "C", (9, 0), kind="postseason"), game(7, "D", "A", (3, 0), season=2019, division="fcs")]
    said = [(3, "m", 1, 0.25), (3, "m", 2, 0.75), (4, "m", 2, 0.5), (4, "n", 1, 0.9), (1, "m", 1, 0.01)]
    return (
        spark.createDataFrame(games, GAMES),
        spark.createDataFrame(said, "game_id long, model_version string, prediction_day long, home_win_prob double"),
        spark.createDataFrame([("A", 1600.0), ("B", 1500.0)], "team string, rating double"),
    )


def test_projection(spark):
    games, said, ratings = tables(spark)
    rows = {(r["season"], r["team"], r["projection_date"]): r for r in ol.project(games, said, ratings, [("m", 1), ("m", 2)]).collect()}
    assert set(rows) == {(2020, t, d) for t in "ABC" for d in (1, 2)} | {(2019, t, d) for t in "AD" for d in (1, 2)}
    a1, a2 = rows[2020, "A", 1], rows[2020, "A", 2]
    assert (a1["games_scheduled"], a1["games_simulated"], a1["games_completed"], a1["actual_wins"]) == (3, 2, 1, 1)
    assert a1["projected_wins"] == pytest.approx(1.75) and a2["projected_wins"] == pytest.approx(1 + 0.25 + 0.5) and a2["games_simulated"] == 3
    chances = {}
    for x, y in itertools.product((0, 1), repeat=2):
        chances[x + y] = chances.get(x + y, 0) + (0.25 if x else 0.75) * 0.5
    assert list(a2["dist"]) == pytest.approx([chances[k] for k in range(3)])
    assert (a2["wins_p10"], a2["median_wins"], a2["wins_p90"]) == (1, 2, 3) and a2["p_bowl_eligible"] == 0.0
    # A tie is no win; a decided season's distribution is one point; below the first division there are no bowls.
    assert rows[2020, "B", 1]["actual_wins"] == 0 and rows[2020, "C", 2]["actual_wins"] == 0
    d = rows[2019, "D", 2]
    assert d["actual_wins"] == 1 and list(d["dist"]) == [1.0] and d["wins_p10"] == d["wins_p90"] == 1 and d["p_bowl_eligible"] is None
    assert a2["sos_rating"] == 1500.0 and rows[2020, "C", 2]["sos_rating"] == pytest.approx((1600 + 1500 + 1500) / 3)
    # B meets A twice and C, which has no rating.
    assert rows[2020, "B", 2]["sos_rating"] == 1600.0 and [rows[2020, x, 2]["sos_rank"] for x in "BCA"] == [1, 2, 3]
    assert not a2["schedule_complete"]
    assert {r["id"] for r in ol.unscored(games, said, "m", 1).collect()} == {4, 5} and {r["id"] for r in ol.unscored(games, said, "m", 2).collect()} == {5}


def test_titles(spark):
    """Every replicate is drawn anew in Python."""
    import hashlib

    games, said, ratings = tables(spark)
    got = {r["team"]: r["conf_title_prob"] for r in ol.title_shares(ol.slate_by_run(games, said, [("m", 2)]).filter("season = 2020"), 50).collect()}
    want = dict.fromkeys("ABC", 0.0)
    for k in range(50):
        u = lambda g, k=k: int(hashlib.md5(f"{g}:{k}".encode()).hexdigest()[:8], 16) / 2**32
        c, a = u(3) < 0.75, u(4) < 0.5
        share = {"A": (1 + (not c) + a) / 3, "B": (0 + (not a)) / 3, "C": (0 + c) / 2}
        best = [t for t, v in share.items() if round(v, 9) == round(max(share.values()), 9)]
        for t in best:
            want[t] += 1 / len(best) / 50
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(1)


def test_outlook(spark):
    games, said, ratings = tables(spark)
    teams = spark.createDataFrame([("A", "fcs"), ("E", "ii"), ("E", None)], "school string, classification string")
    ledger = ol.project(games, said, ratings, [("m", 1), ("m", 2), ("n", 1)])
    other = ledger.filter("team = 'A' AND season = 2020 AND model_version = 'n'").withColumn("team", F.explode(F.array(F.lit("E"), F.lit("F"))))
    rows = {(r["season"], r["team"], r["model_version"]): r for r in ol.season_outlook(ledger.unionByName(other), games, teams).collect()}
    assert {k: r["projection_date"] for k, r in rows.items() if k[2] == "m"} == {k: 2 for k in rows if k[2] == "m"}
    assert rows[2020, "B", "m"]["games_unscored"] == 1 and rows[2020, "A", "m"]["games_unscored"] == 0 and rows[2020, "A", "n"]["games_unscored"] == 1
    assert rows[2020, "A", "m"]["is_projection"] and not rows[2019, "A", "m"]["is_projection"] and not rows[2020, "C", "n"]["is_projection"]
    assert rows[2019, "A", "m"]["classification"] == "fcs" and rows[2020, "A", "m"]["classification"] == "fbs"
    assert rows[2020, "E", "n"]["classification"] == "ii" and rows[2020, "F", "n"]["classification"] is None


def test_unscored_is_what_the_anti_join_finds(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    rows = ol.outlook_of_seasons(t).filter("model_version = 'blend'").agg(F.sum("games_unscored")).first()[0]
    last = t["games"].agg(F.max("season")).first()[0]
    assert rows == 2 * ol.unscored(t["games"].filter(F.col("season") >= last - 1), t["game_predictions"], "blend", 1).count() > 0
