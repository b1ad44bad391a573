"""Contests kept by week: what they hold, and that vectors, fits and scores are those of whole vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.plans import marts_more as mm
from duelbook.sources.adapter import Tables
from duelbook.stats import features as ft
from duelbook.stats import fitted as fi
from duelbook.stats import jobs
from duelbook.stats import preseason as ps
from duelbook.stats import weekly as wk
from duelbook.stats.predictions import market_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def close(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


def test_contests_by_week_have_the_vectors(t):
    """Of every contest both sides' values by its weeks are those of M5's vectors."""
    weeks, rows = ft.calendar(t, True)
    got = {r["game_id"]: r for r in fi.in_full(rows, weeks, fi.FEATURES).collect()}
    want = {r["game_id"]: r for r in fi.contests(ft.fitted_features(t), t["games"], fi.FEATURES).collect()}
    assert got.keys() == want.keys() and len(got) > 1000
    for k, w in want.items():
        g = got[k]
        assert all(g[c] == w[c] for c in ("season", "neutral", "played", "margin")) and (g["won"] == w["won"] or w["margin"] is None)
        assert all(close(a, b) for s in ("home", "away") for a, b in zip(g[s], w[s], strict=True))


def test_contests_are_kept_without_vectors(t):
    """what M13 keeps of a contest are numbers of weeks and own ratings, not two arrays of features, and its scores are those of the arrays."""
    scored = fi.scores(t)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in plan.splitlines() if "InMemoryRelation [" in line and "game_id#" in line]
    assert kept and not any("home#" in line or "away#" in line for line in kept)
    weeks, rows, fits = fi.trained(t, fi.FEATURES)
    assert not any(kind.startswith("array") for _, kind in rows.dtypes) and weeks.count() <= 25 * 8 * 110
    lines = t.spark.createDataFrame([], "game_id long, spread double")
    got = {r["game_id"]: r for r in fi.score_by_week(rows, weeks, fits, fi.FEATURES, lines).collect()}
    want = {r["game_id"]: r for r in fi.score(fi.in_full(rows, weeks, fi.FEATURES), fits, fi.FEATURES, lines).collect()}
    assert got.keys() == want.keys() and len(got) > 500
    assert all(close(g[c], want[k][c]) for k, g in got.items() for c in ("expected_margin", "home_win_prob"))
    assert all(g["through"] == want[k]["through"] and g["played"] == want[k]["played"] for k, g in got.items())


def test_weeks_give_the_designs_of_lists(spark):
    """``Weeks`` reads contests as ``_arrays`` reads their lists: nulls, the contest's own feature, and seasons in order."""
    rng = np.random.default_rng(4)
    names = ["a", fi.OWN, "b"]
    value = lambda: None if rng.random() < 0.3 else float(rng.normal())
    weeks = spark.createDataFrame([(i, value(), value()) for i in range(12)], "id int, a double, b double")
    rows = [(i, 2015 + int(rng.integers(4)), bool(i % 2), True, float(rng.integers(-3, 4)), *(int(x) for x in rng.integers(0, 12, 2)), *map(float, rng.normal(size=2))) for i in range(60)]
    df = spark.createDataFrame(rows, "game_id long, season long, neutral boolean, played boolean, margin double, home_id int, away_id int, home_elo double, away_elo double")
    read, full = fi.Weeks(weeks, names), fi.in_full(df, weeks, names)
    batch, lists = df.toPandas().sort_values("game_id"), full.toPandas().sort_values("game_id")
    assert all(np.allclose(a, b) for a, b in zip(read.arrays(batch), fi._arrays(lists), strict=True))
    u, order = read.rows(batch), np.argsort(batch["season"].to_numpy(), kind="stable")
    d, k, _, _ = fi._arrays(lists)
    assert np.allclose(u["d"], d[order]) and (u["k"] == k[order]).all() and (u["won"] == lists["won"].to_numpy()[order]).all() and (u["neutral"] == lists["neutral"].to_numpy()[order]).all()
    by_week, by_list = (fi.season_moments(rows, 3, w) for rows, w in ((df, read), (full, None)))
    assert by_week.keys() == by_list.keys() and all(np.allclose(by_week[s][c], by_list[s][c]) for s in by_list for c in by_list[s])


def test_week_frame_moves_no_contest(t):
    """candidates and controls meet a contest by its weeks: nothing is grouped by contest, and no vectors are kept; rows are those of both sides by themselves."""
    frame = wk.week_frame(t, ft.fitted_features(t))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [game_id" not in plan and "returning_ppa_pct" not in plan.split("InMemoryRelation")[0]
    games = wk.screened_contests(t["games"])
    sides = wk.as_of_candidates(games, t["drive_scores"], ft.play_events({"games": games, "plays": t["plays"]}))
    told = {(r["game_id"], r["side"]): r for r in sides.join(ft.fitted_features(t).select("game_id", "side", "elo_pregame", "adj_epa_net"), ["game_id", "side"]).collect()}
    got = frame.collect()
    assert len(got) == len(told) / 2 > 500
    for r in got:
        home, away = told[r["game_id"], "home"], told[r["game_id"], "away"]
        assert r["home_margin"] == home["home_margin"] and r["season"] == home["season"]
        for c in wk.CANDIDATES:
            assert close(r[c], None if None in (home[c], away[c]) else home[c] - away[c])
        assert close(r["elo_diff"], home["elo_pregame"] - away["elo_pregame"])
        assert close(r["adj_epa_net_diff"], None if None in (home["adj_epa_net"], away["adj_epa_net"]) else home["adj_epa_net"] - away["adj_epa_net"])


def test_slate_puts_first_days_in_order(spark):
    """Contests of a team's first days alone are put in order, the rows are those of all of them in order, ids that stand twice and days that are not known included."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        home, away = rng.choice(list("ABCDE"), 2, replace=False)
        rows.append((int(i % 390), 2017 + i % 2, "regular", None if i % 50 == 0 else f"2017-{9 + i % 3:02d}-{1 + int(rng.integers(28)):02d}", True, str(home), str(away), 7, int(rng.integers(20))))
    games = spark.createDataFrame(rows, "id long, season long, season_type string, start_date string, completed boolean, home_team string, away_team string, home_points long, away_points long")
    nth, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r[3] is None, r[3] or "", r[0])):
        for team in r[5:7]:
            seen[team, r[1]] = seen.get((team, r[1]), 0) + 1
            nth[r[0]] = max(nth.get(r[0], 0), seen[team, r[1]])
    for most in (5, 12, 200):
        assert sorted(r["id"] for r in ps.slate(games, most).collect()) == sorted(r[0] for r in rows if nth[r[0]] <= most)
    plan = ps.slate(games, 12)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "row_number()" in line and "Window" in line)
    assert any("home_before" in line or "_home" in line for line in plan[at:])


@pytest.mark.parametrize("plan", [jobs.projection_eval, jobs.residual_sigma, mm.prediction_accuracy], ids=["M26_fitted", "M28_fitted", "K38_fitted"])
def test_fitted_reports_keep_no_vectors(t, plan):
    """Reports over M13's rows keep no vectors either, and are those over the scores of whole vectors."""
    got = fi.over_fitted(plan, t)
    kept = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "InMemoryRelation [" in line and "game_id#" in line]
    assert kept and not any("home#" in line or "away#" in line for line in kept)
    weeks, rows, fits = fi.trained(t, fi.FEATURES)
    scored = fi.score(fi.in_full(rows, weeks, fi.FEATURES), fits, fi.FEATURES, market_lines(t))
    given = scored.select("game_id", "season", F.lit("fitted").alias("model_version"), F.lit(1).cast("long").alias("prediction_day"), "expected_margin", "home_win_prob", "market_spread")
    keys = [c for c in ("model_version", "season", "edge_threshold", "bucket") if c in got.columns]
    want = {tuple(r[c] for c in keys): r for r in plan(Tables(t.spark, FOLDER, {"game_predictions": given})).collect()}
    told = got.collect()
    assert len(told) == len(want) > 0
    for r in told:
        assert all(a == b or isinstance(a, float) and close(a, b) for a, b in zip(r, want[tuple(r[c] for c in keys)], strict=True))
