"""Preseason candidates, their screen, and replayed projections against plain versions."""

import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.sources.adapter import Tables
from duelbook.stats import preseason as ps

FOLDER = "/root/testdata/sf0.001"


def partial(xy, xz, yz):
    below = math.sqrt(max(0.0, (1 - xz**2) * (1 - yz**2)))
    return (xy - xz * yz) / below if below else 0.0


def corr(a, b):
    return float(np.corrcoef(a, b)[0, 1]) if np.std(a) > 0 and np.std(b) > 0 else 0.0


def test_screen(spark):
    """Partials equal correlations of residuals; q-values equal the textbook loop; nulls drop a row for their candidate only."""
    rng = np.random.default_rng(3)
    n = 400
    z, w = rng.normal(size=n), rng.normal(size=n)
    y = 0.6 * z + 0.4 * w + rng.normal(size=n)
    cols = {"strong": 0.5 * y + rng.normal(size=n), "weak": rng.normal(size=n), "echo": z + 0.01 * rng.normal(size=n), "flat": np.ones(n), "proxy": w + 0.3 * rng.normal(size=n), "rare": rng.normal(size=n), "w": w}
    missing = {k: rng.random(n) < 0.1 for k in ("strong", "w")} | {"rare": rng.random(n) < 0.9}
    value = lambda k, i: None if k in missing and missing[k][i] else float(cols[k][i])
    rows = [(float(y[i]), float(z[i]), *[value(k, i) for k in cols]) for i in range(n)]
    frame = spark.createDataFrame(rows, "rating double, prior_rating double, " + ", ".join(f"{k} double" for k in cols))
    got = {r["candidate"]: r for r in ps.feature_screen(frame, list(cols), "w").collect()}
    want_p = {}
    for k in cols:
        ok = ~missing.get(k, np.zeros(n, bool))
        both = ok & ~missing["w"]
        x = cols[k]
        r = partial(corr(x[ok], y[ok]), corr(x[ok], z[ok]), corr(y[ok], z[ok]))
        a, b, c = (partial(corr(p[both], q[both]), corr(p[both], z[both]), corr(q[both], z[both])) for p, q in ((x, y), (x, w), (y, w)))
        assert got[k]["n"] == ok.sum() and got[k]["partial_r"] == pytest.approx(r, abs=1e-9)
        if k == "w":  # given itself, nothing is left of it
            assert got[k]["partial_r_second"] == 0.0
        else:
            assert got[k]["n_second"] == both.sum() and got[k]["partial_r_second"] == pytest.approx(partial(a, b, c), abs=1e-8)
        design = np.column_stack([np.ones(ok.sum()), z[ok]])
        rest = lambda v: v - design @ np.linalg.lstsq(design, v, rcond=None)[0]  # noqa: E731, B023
        if k != "flat":
            assert r == pytest.approx(corr(rest(x[ok]), rest(y[ok])), abs=1e-9)
        freedom = ok.sum() - 3
        if freedom >= 200:
            want_p[k] = math.erfc(abs(r) * math.sqrt(freedom / (1 - r * r)) / math.sqrt(2))
            assert got[k]["p_value"] == pytest.approx(want_p[k], abs=1e-6)
        else:
            assert k == "rare" and got[k]["p_value"] is None and got[k]["q_value"] is None and got[k]["verdict"] == "reject"
    order = sorted(want_p, key=want_p.get)
    least = 1.0
    for rank in range(len(order), 0, -1):
        least = min(least, want_p[order[rank - 1]] * len(order) / rank)
        assert got[order[rank - 1]]["q_value"] == pytest.approx(least, abs=1e-5)
    assert got["strong"]["verdict"] == "ship" and got["weak"]["verdict"] == got["flat"]["verdict"] == got["echo"]["verdict"] == "reject"
    assert abs(got["proxy"]["partial_r"]) > 0.2 > abs(got["proxy"]["partial_r_second"])


def test_fan_out_is_an_error(spark):
    df = spark.createDataFrame([(2018, "A", 1), (2018, "B", 2), (2019, "A", 3)], "season long, team string, x long")
    assert ps.one_row_each(df, ["season", "team"]).count() == 3
    with pytest.raises(Exception, match="several rows of"):
        ps.one_row_each(df.unionByName(df.limit(1)), ["season", "team"]).collect()


def test_win_distribution(spark):
    probs = [0.2, 0.5, 0.9, 0.75]
    want = np.zeros(5)
    for wins in product((0, 1), repeat=4):
        want[sum(wins)] += np.prod([p if x else 1 - p for p, x in zip(probs, wins, strict=True)])
    row = spark.createDataFrame([(probs,)], "p array<double>").select(ps.win_distribution(F.col("p")).alias("d")).select("d", ps._quantile("d", 0.1).alias("lo"), ps._quantile("d", 0.9).alias("hi")).first()
    assert np.allclose(row["d"], want)
    assert row["lo"] == np.searchsorted(np.cumsum(want), 0.1) and row["hi"] == np.searchsorted(np.cumsum(want), 0.9)


def test_slate_keeps_both_sides_first_contests(spark):
    games = Tables(spark, FOLDER)["games"]
    rows = sorted((r for r in games.collect() if r["season_type"] == "regular" and r["completed"]), key=lambda r: (r["start_date"], r["id"]))
    seen, want = {}, set()
    for r in rows:
        nth = []
        for team in (r["home_team"], r["away_team"]):
            seen[team, r["season"]] = seen.get((team, r["season"]), 0) + 1
            nth.append(seen[team, r["season"]])
        if max(nth) <= 4:
            want.add(r["id"])
    assert {r["id"] for r in ps.slate(games, 4).collect()} == want


def test_backtest_and_report(spark):
    """Projections of a small season by hand, with the next season's baseline from it."""
    t = Tables(spark, FOLDER)
    games = spark.createDataFrame([(1, 2017, "regular", "2017-09-01", True, "A", "B", 10, 3), (2, 2017, "regular", "2017-09-08", True, "A", "C", 10, 30)], "id long, season long, season_type string, start_date string, completed boolean, home_team string, away_team string, home_points long, away_points long")
    t._made["games"] = games
    scored = spark.createDataFrame([(11, 2018, 2017, "A", "B", True, False, 0, 0, 0.75), (12, 2018, 2017, "B", "A", True, False, 0, 0, 0.5), (13, 2018, 2017, "C", "D", False, True, 0, 0, 0.25)], "game_id long, season long, through long, home_team string, away_team string, home_won boolean, away_won boolean, home_known long, away_known long, home_win_prob double")
    rows = ps.preseason_backtest(t, scored)
    got = {r["team"]: r for r in rows.collect()}
    assert got["A"]["projected_wins"] == pytest.approx(1.25) and got["A"]["actual_wins"] == 1 and got["A"]["games"] == 2 and got["A"]["baseline_prior"] == pytest.approx(1.0)
    assert (got["A"]["wins_p10"], got["A"]["wins_p90"]) == (0, 2) and got["B"]["baseline_prior"] == 0.0 and got["C"]["baseline_prior"] == 1.0 and got["D"]["baseline_prior"] == 0.5
    report = ps.projection_report(rows.withColumn("scope", F.lit("all")), ["scope"]).first()
    p = np.array([got[k]["projected_wins"] for k in "ABCD"])
    a = np.array([got[k]["actual_wins"] for k in "ABCD"])
    assert report["win_mae"] == pytest.approx(np.abs(p - a).mean()) and report["rmse"] == pytest.approx(np.sqrt(((p - a) ** 2).mean())) and report["bias"] == pytest.approx((p - a).mean())
    for q in (5, 10, 25, 50, 75, 90, 95):
        assert report[f"resid_p{q:02d}"] == pytest.approx(np.percentile(a - p, q))
    assert report["coverage"] == np.mean([got[k]["wins_p10"] <= got[k]["actual_wins"] <= got[k]["wins_p90"] for k in "ABCD"]) and report["max_games_known"] == 0


def test_latest_run_by_null_safe_key(spark):
    rows = [("m", "all", 2018, 2020, None, 1, 5, 1.0, 2.0, 0.5), ("m", "all", 2018, 2020, None, 2, 9, 3.0, 2.0, 4.0), ("m", "all", 2018, 2020, 0.15, 1, 5, 1.5, 2.0, 1.0), ("m", None, None, 2020, None, 1, 5, 1.5, 1.5, 2.0)]
    df = spark.createDataFrame(rows, "model_version string, scope string, season_start long, season_end long, strength_share double, run long, run_date long, win_mae double, baseline_prior_mae double, baseline_flat_mae double")
    got = {(r["scope"], r["strength_share"]): (r["run_date"], r["beats_prior_baseline"], r["beats_flat_baseline"]) for r in ps.model_backtest(df).collect()}
    assert got == {("all", None): (9, False, True), ("all", 0.15): (5, True, False), (None, None): (5, False, True)}
