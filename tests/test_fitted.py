"""Feature vectors and fitted models: no leak of later rows, and fits against dense versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.sources.adapter import Tables
from duelbook.stats import features as ft
from duelbook.stats import fitted as fi
from duelbook.stats import jobs

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "game_id long, season long, neutral double, played boolean, margin double, won double, home array<double>, away array<double>"
NAMES = ["a", "b", "c", "constant_one", "never"]


def test_later_rows_change_no_vector(spark):
    """Plays, drives and ratings of a season from week 30 on: vectors up to that week stay as they are, later ones change."""
    t = Tables(spark, FOLDER)
    late = t["games"].filter("season > 2018 OR season = 2018 AND (week >= 30 OR season_type = 'postseason')").select(F.col("id").alias("l_orderkey"), F.lit(1).alias("late"))
    plays = t["lineitem"].join(late, "l_orderkey", "left")
    changed = plays.select(*[F.when(F.col("late") == 1, F.col(c) * 0 + v).otherwise(F.col(c)).cast(t["lineitem"].schema[c].dataType).alias(c) if (v := {"l_discount": 0.0, "l_quantity": 12, "l_suppkey": 7}.get(c)) is not None else F.col(c) for c in t["lineitem"].columns])
    other = Tables(spark, FOLDER, {"lineitem": changed})
    ratings = t["house_elo_game"].join(late.withColumnRenamed("l_orderkey", "game_id"), "game_id", "left")
    other._made["house_elo_game"] = ratings.withColumn("home_postgame_elo", F.when(F.col("late") == 1, 1.0).otherwise(F.col("home_postgame_elo"))).drop("late")

    def vectors(tables):
        plays_ = jobs.ridge_plays(tables)
        return {(r["game_id"], r["team"]): r for r in ft.team_week_features(tables, (jobs.two_way_ridge_asof(plays_, tables["games"]), jobs.two_way_ridge(plays_))).collect()}

    before, after = vectors(t), vectors(other)
    assert before.keys() == after.keys()
    same = lambda a, b: all(x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-9 for x, y in zip(a, b, strict=True))
    early = [k for k, r in before.items() if r["season"] < 2018 or r["season"] == 2018 and r["week_index"] <= 30]
    assert len(early) > 1000 and all(same(before[k], after[k]) for k in early)
    assert any(not same(before[k], after[k]) for k in before.keys() - set(early))


def test_fit_ladder(spark):
    """A week's fit with enough plays, the latest up to the week; else the season before's; else none."""
    t = Tables(spark, FOLDER)
    team = "NATION_7"
    weeks = spark.createDataFrame([(2017, 20, team, 1.0, 0.25, 0.5, 200), (2017, 25, team, 2.0, 0.5, 0.5, 149), (2017, 30, team, 3.0, 1.0, 0.5, 150)], "season long, week_index long, team string, off_coef double, def_coef double, hfa double, plays long")
    years = spark.createDataFrame([(2016, team, 7.0, 2.0, 0.5)], "season long, team string, off_coef double, def_coef double, hfa double")
    rows = ft.team_week_features(t, (weeks, years)).filter(F.col("team") == team).collect()
    for r in rows:
        want = (None, None, None)
        if r["season"] == 2017:
            want = ("prior_season", 7.0, 5.0) if r["week_index"] < 20 else ("week", 1.0, 0.75) if r["week_index"] < 30 else ("week", 3.0, 2.0)
        assert (r["adj_epa_source"], r["adj_epa_off"], r["adj_epa_net"]) == want
    assert {r["adj_epa_source"] for r in rows} == {None, "week", "prior_season"}


def dense_logistic(x, y, alpha, steps=60):
    beta, penalty = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, alpha)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        change = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty), x.T @ (p - y) + penalty * beta)
        beta = beta - change
        if np.abs(change).max() < 1e-10:
            break
    return beta


def frame(rng, seasons, per=60):
    rows = []
    for s in seasons:
        for _ in range(per):
            home, away = (np.r_[rng.normal(s - 2015, 2, 3), 1.0, np.nan] for _ in "ha")
            for side in (home, away):
                side[:3][rng.random(3) < 0.15] = np.nan
            margin = float(round(3 * np.nan_to_num(home[0]) - 3 * np.nan_to_num(away[0]) + rng.normal(0, 8)))
            rows.append([len(rows), s, float(rng.random() < 0.2), bool(s < max(seasons) or rng.random() < 0.7), margin, float(margin > 0), home, away])
    return rows


@pytest.fixture(scope="module")
def data(spark):
    rows = frame(np.random.default_rng(8), range(2015, 2021))
    clean = lambda v: [None if np.isnan(x) else float(x) for x in v]
    return rows, spark.createDataFrame([(*r[:4], r[4] if r[3] else None, r[5] if r[3] else None, clean(r[6]), clean(r[7])) for r in rows], SCHEMA).repartition(5).persist()


def dense_fit(rows, through):
    own = [r for r in rows if r[1] <= through and r[3]]
    both = np.array([v for r in own for v in (r[6], r[7])])
    means = np.array([c[~np.isnan(c)].mean() if (~np.isnan(c)).any() else 0.0 for c in both.T])
    fill = lambda v: np.where(np.isnan(v), means, v)
    x = np.array([fill(r[6]) - fill(r[7]) for r in own])
    mu, sd = x.mean(axis=0), x.std(axis=0)
    z = np.where(sd > 1e-9, (x - mu) / np.where(sd > 1e-9, sd, 1), 0.0)
    design = np.column_stack([np.ones(len(own)), [r[2] for r in own], z])
    y, won = np.array([r[4] for r in own]), np.array([r[5] for r in own])
    margin = np.linalg.solve(design.T @ design + np.diag([0.0, *[7.0] * (len(NAMES) + 1)]), design.T @ y)
    win = dense_logistic(design, won, 1e-3)
    b, a = dense_logistic(np.column_stack([np.ones(len(own)), design @ win]), won, 0.0)
    return len(own), means, mu, sd, margin, win, (a, b)


def test_walk_forward_is_each_window_from_scratch(data):
    rows, df = data
    fits = {f.through: f for f in fi.walk_forward_train(df, NAMES)}
    assert sorted(fits) == [2017, 2018, 2019, 2020]
    for through, f in fits.items():
        n, means, mu, sd, margin, win, calibrated = dense_fit(rows, through)
        assert f.n == n and np.allclose(np.nan_to_num(f.means), means) and np.isnan(f.means[-1])
        assert np.allclose(f.diff_means, mu, atol=1e-9) and np.allclose(f.diff_stds, sd, atol=1e-8)
        assert np.allclose(f.margin, margin, atol=1e-8) and np.allclose(f.win, win, atol=1e-7) and np.allclose(f.platt, calibrated, atol=1e-6)
    # Later seasons change no earlier fit.
    again = {f.through: f for f in fi.walk_forward_train(df.filter("season <= 2018"), NAMES)}
    assert sorted(again) == [2017, 2018] and all(np.allclose(again[k].margin, fits[k].margin, atol=1e-10) for k in again)


def test_one_scan_for_all_windows(spark, data):
    """All windows' moments: one aggregate over the contests."""
    moments = fi.season_moments(data[1], len(NAMES))
    assert sorted(moments) == list(range(2015, 2021))
    assert sum(m["n"][0] for m in moments.values()) == sum(r[3] for r in data[0])


def test_scores_and_design(spark, data):
    rows, df = data
    fits = fi.walk_forward_train(df, NAMES)
    by = {f.through: f for f in fits}
    table = fi.fit_rows(spark, fits)
    market = spark.createDataFrame([(5, "consensus", -3.0), (300, "consensus", 2.0), (359, "consensus", 1.5)], "game_id long, provider string, spread double")
    got = {r["game_id"]: r for r in fi.score(df, table, NAMES, market).collect()}
    design = {r["game_id"]: r for r in fi.design_matrix(df, table, NAMES).collect()}
    # Seasons up to 2017 have no fit of a season before; contests to come have the latest one.
    assert got.keys() == design.keys() == {r[0] for r in rows if r[1] >= 2018}
    for r in rows:
        if r[0] in got:
            through = r[1] - 1 if r[3] else 2020
            f, g = by[through], got[r[0]]
            known = lambda v: np.nan_to_num(v)[None, :]
            x = f.design(known(r[6]) - known(r[7]), (np.isnan(r[6]).astype(float) - np.isnan(r[7]))[None, :], np.array([r[2]]))[0]
            assert g["through"] == through and np.isclose(g["expected_margin"], x @ f.margin)
            assert np.isclose(g["home_win_prob"], 1 / (1 + np.exp(-(f.platt[0] * (x @ f.win) + f.platt[1]))))
            assert np.allclose([design[r[0]][f"d_{c}"] for c in NAMES], x[2:], atol=1e-9)
    assert got[300]["edge"] == pytest.approx(got[300]["expected_margin"] + 2.0) and got[300]["edge_pick"] in ("home", "away") and got[299]["edge_pick"] is None
    with pytest.raises(Exception, match="other features"):
        fi.score(df, table, ["b", "a", *NAMES[2:]], market).collect()


def test_newton_edge_cases(spark):
    """Outcomes that one feature separates stay finite; a model without rows keeps zeros."""
    df = spark.createDataFrame([(float(i), float(i >= 10)) for i in range(20)], "x double, y double").repartition(3)
    designs = lambda b: {1: (np.column_stack([np.ones(len(b)), (b["x"] - 9.5) / 6]), b["y"].to_numpy()), 2: (np.zeros((0, 2)), np.zeros(0))}
    got = fi.newton(df, designs, {1: 2, 2: 2}, 1e-3)
    assert np.isfinite(got[1]).all() and got[1][1] > 3 and (got[2] == 0).all()


@pytest.mark.parametrize(("pending", "scored", "share", "ok"), [(0, 0, 1.0, True), (10, 9, 0.9, True), (10, 8, 0.8, False), (5, 0, 0.0, False)])
def test_coverage(spark, pending, scored, share, ok):
    ids = lambda n: spark.createDataFrame([(i,) for i in range(n)], "game_id long")
    got = fi.coverage(ids(pending), ids(scored)).first()
    assert (got["pending"], got["scored"], got["share"], got["ok"]) == (pending, scored, pytest.approx(share), ok)
