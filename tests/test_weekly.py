"""Week candidates against a plain version, and that nothing of a week or later reaches its contests."""

import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from duelbook.sources.adapter import Tables
from duelbook.stats import features as ft
from duelbook.stats import weekly as wk

FOLDER = "/root/testdata/sf0.001"


def index(r):
    return r["week"] + 100 if r["season_type"] == "postseason" else r["week"]


@pytest.fixture(scope="module")
def t(spark):
    t = Tables(spark, FOLDER)
    for name in ("games", "plays", "drive_scores"):  # read once, so that rows can be changed
        t._made[name] = t[name].persist()
    return t


def candidates(t):
    games = wk.screened_contests(t["games"])
    return wk.as_of_candidates(games, t["drive_scores"], ft.play_events({"games": games, "plays": t["plays"]}))


def test_candidates(spark, t):
    games = {g["id"]: g for g in wk.screened_contests(t["games"]).collect()}
    assert all("fbs" in (g["home_classification"], g["away_classification"]) and g["completed"] for g in games.values())
    drives = defaultdict(list)
    for d in t["drive_scores"].collect():
        if d["game_id"] in games:
            for role in ("offense", "defense"):
                drives[role, d[role], d["season"]].append((index(games[d["game_id"]]), d))
    values = defaultdict(list)
    from duelbook.plans import marts_base as mb

    for p in mb.play_epa(t).filter("NOT is_garbage_time").collect():
        if p["game_id"] in games:
            for role in ("offense", "defense"):
                values[role, p[role], p["season"], index(games[p["game_id"]])].append(p["epa"])
    weeks = sorted({k[3] for k in values})
    mean = lambda xs: sum(xs) / len(xs) if xs else None

    def plain(team, season, at):
        out = {}
        for role, ppd, fp in (("offense", "off_ppd", "off_field_pos"), ("defense", "def_ppd_allowed", "def_field_pos_allowed")):
            old = [d for w, d in drives[role, team, season] if w < at]
            out[ppd] = mean([d["end_offense_score"] - d["start_offense_score"] for d in old if None not in (d["start_offense_score"], d["end_offense_score"])])
            out[fp] = mean([d["start_yards_to_goal"] for d in old if d["start_yards_to_goal"] is not None])
        nets = [mean(values["offense", team, season, w]) - mean(values["defense", team, season, w]) for w in weeks if w < at and ("offense", team, season, w) in values and ("defense", team, season, w) in values]
        out["form_net_epa_last4"] = mean(nets[-4:]) - mean(nets) if len(nets) >= 4 else None
        out["vol_net_epa"] = statistics.pstdev(nets) if len(nets) >= 2 else None
        return out

    got = candidates(t).collect()
    assert len(got) == 2 * len(games)
    seen = set()
    for r in got:
        g = games[r["game_id"]]
        assert r["home_margin"] == g["home_points"] - g["away_points"]
        for k, v in plain(g[f"{r['side']}_team"], g["season"], index(g)).items():
            assert (r[k] is None) == (v is None), (k, r)
            if v is not None:
                seen.add(k)
                assert r[k] == pytest.approx(v, abs=1e-9), k
    assert seen == set(wk.CANDIDATES)


def test_no_later_row_reaches_a_week(spark, t):
    season, at = 2018, 20
    late = (F.col("season") > season) | ((F.col("season") == season) & (F.col("at") >= at))
    weeks = t["games"].select(F.col("id").alias("game_id"), F.when(F.col("season_type") == "postseason", F.col("week") + 100).otherwise(F.col("week")).alias("at"))
    other = Tables(spark, FOLDER, dict(t._made))
    other._made["drive_scores"] = t["drive_scores"].join(weeks, "game_id").withColumn("end_offense_score", F.when(late, 90).otherwise(F.col("end_offense_score"))).drop("at")
    other._made["plays"] = t["plays"].join(weeks, "game_id").withColumn("ppa", F.when(late, 9.0).otherwise(F.col("ppa"))).drop("at")
    upto = lambda df: df.join(weeks, "game_id").filter(~late | ((F.col("season") == season) & (F.col("at") == at))).drop("at")
    a, b = ({(r["game_id"], r["side"]): r for r in upto(candidates(x)).collect()} for x in (t, other))
    assert a == b and any(r["season"] == season for r in a.values())
    assert candidates(t).exceptAll(candidates(other)).count()


def test_screen_modes(spark):
    """Both modes judge on their own controls; a candidate that only echoes a control is rejected, and nulls drop a contest for it alone."""
    import numpy as np

    rng = np.random.default_rng(5)
    n = 500
    elo, net, own = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    margin = elo + net + own + 0.5 * rng.normal(size=n)
    cols = dict(zip(wk.CANDIDATES, (own + 0.2 * rng.normal(size=n), net + 0.01 * rng.normal(size=n), rng.normal(size=n), np.ones(n), own, rng.normal(size=n)), strict=True))
    rows = [(i, float(margin[i]), float(elo[i]), float(net[i]), *[None if k == "vol_net_epa" and i % 2 else float(v[i]) for k, v in cols.items()]) for i in range(n)]
    frame = spark.createDataFrame(rows, "game_id long, home_margin double, elo_diff double, adj_epa_net_diff double, " + ", ".join(f"{c} double" for c in wk.CANDIDATES))
    margins = spark.createDataFrame([(i, float(elo[i] + net[i])) for i in range(0, n, 2)], "game_id long, model_margin double")
    got = {(r["mode"], r["candidate"]): r for r in wk.week_screen(frame, margins, least_freedom=100).collect()}
    rest = lambda v, *z: v - np.column_stack([np.ones(len(v)), *z]) @ np.linalg.lstsq(np.column_stack([np.ones(len(v)), *z]), v, rcond=None)[0]
    for k in wk.CANDIDATES:
        if k == "def_field_pos_allowed":
            continue
        ok = np.arange(n) % 2 == 0 if k == "vol_net_epa" else np.ones(n, bool)
        x = cols[k]
        want = np.corrcoef(rest(x[ok], elo[ok], net[ok]), rest(margin[ok], elo[ok], net[ok]))[0, 1]
        assert got["features", k]["partial_r_second"] == pytest.approx(want, abs=1e-8) and got["features", k]["n_second"] == ok.sum()
        half = np.arange(n) % 2 == 0
        assert got["margin", k]["partial_r"] == pytest.approx(np.corrcoef(rest(x[half], (elo + net)[half]), rest(margin[half], (elo + net)[half]))[0, 1], abs=1e-8)
    verdicts = {k: r["verdict"] for k, r in got.items()}
    assert all(verdicts[mode, k] == "ship" for mode in ("features", "margin") for k in ("off_ppd", "form_net_epa_last4"))
    assert verdicts["features", "def_ppd_allowed"] == verdicts["features", "off_field_pos"] == verdicts["features", "def_field_pos_allowed"] == "reject"
