"""Statistical jobs and column functions: hand-computed values, recovery, analytic solutions, boundaries."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.functions import exprs as x
from duelbook.operators import frames, quality
from duelbook.stats import chain, jobs, predictions


def one(spark, col):
    return spark.range(1).select(col).first()[0]


def test_garbage_time_grid(spark):
    grid = [(p, d) for p in (1, 2, 3, 4, 5) for d in (None, 0, 28, 29, -29, 35, 36, -36)]
    got = {(r[0], r[1]): r[2] for r in spark.createDataFrame(grid, "period long, score_diff long").select("period", "score_diff", x.is_garbage_time()).collect()}
    for p, d in grid:
        lead = abs(d or 0)
        assert got[(p, d)] == ((p == 4 and lead > 28) or (p >= 3 and lead > 35))


def test_normal_cdf(spark):
    zs = [i / 7 for i in range(-30, 31)]
    got = {r[0]: r[1] for r in spark.createDataFrame([(z,) for z in zs], "z double").select("z", x.normal_cdf("z")).collect()}
    assert all(abs(got[z] - 0.5 * (1 + math.erf(z / 2**0.5))) < 1.5e-7 for z in zs)


def test_text_and_clock(spark):
    df = spark.createDataFrame([("6-2", 1, "10:30"), ("x", 5, "1:00"), (None, 4, "bad")], "h string, p int, c string")
    got = df.select(x.height_inches("h"), x.seconds_remaining("p", "c")).collect()
    assert [tuple(r) for r in got] == [(74, 10 * 60 + 30 + 2700), (None, 0), (None, None)]
    assert one(spark, x.trigram_similarity(F.lit("word"), F.lit("two words"))) == pytest.approx(4 / 11)
    assert one(spark, x.matched(F.lit("ab 12 yards"), r"(\d+) yard")) == "12" and one(spark, x.matched(F.lit("none"), r"(\d+)")) is None


def test_ridge_recovers_effects_and_equals_dense(spark):
    rng = np.random.default_rng(0)
    teams = [f"t{i}" for i in range(6)]
    off, dfn = rng.normal(0, 0.3, 6), rng.normal(0, 0.3, 6)
    rows = []
    for _ in range(4000):
        i, j = rng.choice(6, 2, replace=False)
        home = bool(rng.integers(2))
        rows.append((2020, teams[i], teams[j], teams[i] if home else teams[j], float(0.1 + 0.2 * home + off[i] + dfn[j] + rng.normal(0, 0.1))))
    plays = spark.createDataFrame(rows, "season long, offense string, defense string, home string, ppa double")
    got = {r["team"]: r for r in jobs.two_way_ridge(plays, 5.0).collect()}
    design = np.zeros((len(rows), 14))
    for k, (_, o, d, h, _) in enumerate(rows):
        design[k, [0, 2 + teams.index(o), 8 + teams.index(d)]] = 1
        design[k, 1] = o == h
    beta = np.linalg.solve(design.T @ design + 5.0 * np.diag([0, 0] + [1] * 12), design.T @ np.array([r[4] for r in rows]))
    for i, t in enumerate(teams):
        assert abs(got[t]["off_coef"] - beta[2 + i]) < 1e-9 and abs(got[t]["def_coef"] - beta[8 + i]) < 1e-9
    assert abs(got["t0"]["hfa"] - 0.2) < 0.03
    assert np.corrcoef([got[t]["off_coef"] for t in teams], off)[0, 1] > 0.99


def test_asof_ridge_sees_only_earlier_weeks(spark):
    rng = random.Random(1)
    games = [(g, g // 3 + 1, "regular") for g in range(9)]
    plays = [(g, 2020, f"t{rng.randrange(3)}", f"u{rng.randrange(3)}", "t0", rng.random()) for g in range(9) for _ in range(20)]
    p = spark.createDataFrame(plays, "game_id long, season long, offense string, defense string, home string, ppa double")
    g = spark.createDataFrame(games, "id long, week long, season_type string")
    got = jobs.two_way_ridge_asof(p, g).collect()
    assert {r["week_index"] for r in got} == {2, 3}
    early = {r["team"]: r["off_coef"] for r in jobs.two_way_ridge(p.filter("game_id < 3")).collect()}
    week2 = {r["team"]: r["off_coef"] for r in got if r["week_index"] == 2}
    assert all(abs(week2[t] - v) < 1e-9 for t, v in early.items())


def test_states(spark):
    """Every down, distance and yard line against the rule told plainly."""
    cases = [(d, far, y) for d in range(1, 5) for far in range(1, 46) for y in (1, 2, 5, 9, 10, 11, 20, 21, 50, 90, 91, 99)]
    got = {tuple(r)[:3]: r[3] for r in spark.createDataFrame(cases, "down long, distance long, yards_to_goal long").select("*", chain.state_key()).collect()}
    for d, far, y in cases:
        name = "goal" if far >= y else ("standard" if far == 10 else "short" if far < 10 else "long") if d == 1 else "short" if far <= 3 else "med" if far <= 6 else "long" if far <= 10 else "xlong"
        assert got[d, far, y] == f"d{d}|{name}|z{min(10, max(1, (y + 9) // 10))}"


def test_chain(spark):
    one, two = "d1|standard|z1", "d1|standard|z2"
    edges = [("e", one, "TD", 0.5), ("e", one, two, 0.5), ("e", two, one, 0.25), ("e", two, "PUNT", 0.5), ("e", two, "SAFETY", 0.25)]
    got = {r["state"]: r for r in chain.absorbing_chain(spark.createDataFrame(edges, "era string, from_state string, to_state string, p double")).collect()}
    td, safe = 0.5 / 0.875, 0.5 * 0.25 / 0.875
    assert got[one]["p_td"] == pytest.approx(td) and got[one]["expected_points"] == pytest.approx(6.97 * td - 2 * safe)
    counts = [("e", "d1|short|z1", "TD", 5), ("e", "d1|long|z1", "PUNT", 2), ("e", "d1|long|z2", "FG", 1)]
    rows = chain.shrink(spark.createDataFrame(counts, "era string, from_state string, to_state string, n long"))
    sums = {r[0]: r[1] for r in rows.groupBy("from_state").agg(F.sum("p")).collect()}
    assert all(abs(v - 1) < 1e-12 for v in sums.values()) and len(sums) == 3


def test_net_points_solve_the_recursion(spark):
    """Values put back into their own recursion: points now, less what the other side is worth where it takes over."""
    rng = np.random.default_rng(4)
    heads = ["d1|goal|z1", *[f"d1|standard|z{z}" for z in range(2, 11)]]
    step, given = {}, {}
    for s in heads:
        p = rng.dirichlet(np.ones(len(heads) + len(chain.ENDS)))
        step[s] = dict(zip([*heads, *chain.ENDS], p))
    for e in chain.HANDED_OVER:
        for x in range(1, 11):
            given[e, x] = rng.dirichlet(np.ones(10))
    probs = spark.createDataFrame([("e", s, to, float(p)) for s, row in step.items() for to, p in row.items()], "era string, from_state string, to_state string, p double")
    hands = spark.createDataFrame([("e", e, x, z + 1, float(p)) for (e, x), row in given.items() for z, p in enumerate(row)], "era string, ending string, exit_zone long, zone long, p double")
    net = {r["state"]: r["net_points"] for r in chain.net_expected_points(probs, hands).collect()}
    for s in heads:
        want = 0.0
        for to, p in step[s].items():
            if to in net:
                want += p * net[to]
            elif to in chain.HANDED_OVER:
                want -= p * sum(q * net[heads[z]] for z, q in enumerate(given[to, int(s.rsplit("z", 1)[1])]))
            else:
                want += p * chain.POINTS.get(to, 0.0)
        assert net[s] == pytest.approx(want)


    few = probs.filter(~F.col("from_state").isin(heads[:2]))
    assert {r["net_points"] for r in chain.net_expected_points(few, hands, strict=False).collect()} == {None}
    with pytest.raises(Exception, match="no state"):
        chain.net_expected_points(few, hands).collect()


def test_bootstrap_and_unmapped(spark):
    state = "d1|standard|z3"
    rows = [("2021+", g, g, state, "TD" if g % 2 else "PUNT", True, "x") for g in range(400)]
    df = spark.createDataFrame(rows, "era string, game_id long, drive_id long, from_state string, to_state string, first boolean, end string")
    got = chain.cluster_bootstrap_se(df, 100, alpha=0.0).collect()
    assert len(got) == 1 and got[0]["replicates"] == 100 and got[0]["se"] == pytest.approx(6.97 * 0.5 / 20, rel=0.3)
    few = lambda n: df.withColumn("end", F.when(F.col("game_id") >= n, F.col("end"))).withColumn("to_state", F.when(F.col("end").isNotNull(), F.col("to_state")))
    # 8 of 400 unmapped drives are left out, 9 are too many.
    assert chain.guarded(chain.transitions(few(8)), ("era",)).agg(F.sum("n")).first()[0] == 392
    for over in (lambda: chain.guarded(chain.transitions(few(9)), ("era",)), lambda: chain.cluster_bootstrap_se(few(9), 5)):
        with pytest.raises(Exception, match="unmapped result"):
            over().collect()


@pytest.mark.parametrize(("name", "most"), [("M15", 2), ("M16", 2), ("M17", 2), ("M18", 2), ("M19", 4), ("M20", 2), ("M21", 2)])
def test_chain_plans_scan_plays_once(spark, name, most):
    """Plays and drives (here a view over plays) are read once each, M19's two parts once each; building the query runs no job."""
    from duelbook import catalog

    df = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert sum("FileScan" in x and "l_returnflag" in x for x in plan.splitlines()) <= most


def test_gates_are_those_of_the_solved_chain(spark):
    """M21 against M16 and M17 put together in plain Python."""
    from duelbook import catalog
    from duelbook.sources.adapter import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    solved = {(r["era"], r["state"]): r for r in chain.absorbing_chain(chain.shrink(chain.drive_state_transitions(t))).collect()}
    starts = {}
    for r in chain.chain_rows(t).filter("first AND end IS NOT NULL").collect():
        starts.setdefault((r["era"], r["from_state"]), []).append(r["end"] == "TD")
    want = {}
    for era in {e for e, _ in solved}:
        points = {s: r["expected_points"] for (e, s), r in solved.items() if e == era}
        for gate, steps in (
            ("zone", [(f"{d}|{b}", [f"{d}|{b}|z{z}" for z in range(1, 11) if f"{d}|{b}|z{z}" in points]) for d, b in (("d1", "standard"), ("d2", "med"), ("d3", "med"), ("d3", "short"))]),
            ("down", [(z, [f"{d}|med|z{z}" for d in ("d2", "d3") if f"{d}|med|z{z}" in points]) for z in range(2, 10)]),
        ):
            pairs = [(points[a], points[b]) for _, own in steps for a, b in zip(own, own[1:])]
            if pairs:
                want[era, gate] = (len(pairs), sum(b > a + chain.TOLERANCE for a, b in pairs), None)
        met = [(len(v), abs(solved[k]["p_td"] - sum(v) / len(v))) for k, v in starts.items() if k[0] == era and len(v) >= chain.LEAST_STARTS]
        if met:
            want[era, "calibration"] = (len(met), 0, sum(n * e for n, e in met) / sum(n for n, _ in met))
    got = {(r["era"], r["gate"]): (r["cases"], r["violations"], r["error"]) for r in catalog.queries()["M21"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == want.keys() and all(got[k][:2] == want[k][:2] and got[k][2] == pytest.approx(want[k][2]) for k in want)


def test_ridge_rows(spark):
    """Garbage time is left out; on neutral sites nobody is at home."""
    from duelbook.sources.adapter import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    want = t["plays"].join(t["games"].select(F.col("id").alias("game_id"), "neutral_site"), "game_id").filter(F.col("ppa").isNotNull() & ~F.col("play_type").isin("Timeout", "End Period", "End of Half", "End of Game", "Kickoff", "Kickoff Return (Offense)"))
    want = [r for r in want.collect() if not ((r["period"] == 4 and abs(r["score_diff"]) > 28) or (r["period"] >= 3 and abs(r["score_diff"]) > 35))]
    cells = jobs.effect_cells(jobs.ridge_plays(t)).agg(F.sum("n"), F.sum(F.when(F.col("at_home") == 1, F.col("n")))).first()
    assert cells[0] == len(want) and cells[1] == sum(r["offense"] == r["home"] and not r["neutral_site"] for r in want)


def test_replicates_of_seasons_stay_apart(spark):
    rows = [(s, w, h, "c", a, "c", x, y, True) for s, w, h, a, x, y in ((2018, 1, "A", "B", 9, 0), (2019, 1, "C", "D", 9, 0), (2019, 2, "A", "C", 0, 9))]
    games = spark.createDataFrame(rows, "season long, week long, home_team string, home_conference string, away_team string, away_conference string, home_points long, away_points long, completed boolean")
    games = games.withColumns({"id": F.monotonically_increasing_id(), "start_date": F.current_date(), "neutral_site": F.lit(False), "season_type": F.lit("regular"), "conference_game": F.lit(True), "home_classification": F.lit("fbs"), "away_classification": F.lit("fbs")})
    share = {r["team"]: r["title_share"] for r in jobs.best_share(jobs._season_replicates({"games": games}), "conference", "team", "wins").collect()}
    assert share == {"A": 0.5, "B": 0.0, "C": 1.0, "D": 0.0}


def test_replicates(spark):
    rows = [(r, k, v) for r, vs in enumerate([(1, 3), (2, 2), (5, 1), (4, 4)]) for k, v in zip("ab", vs)]
    df = spark.createDataFrame(rows, "replicate long, team string, wins long").withColumn("conf", F.lit("c"))
    got = {r["team"]: r for r in jobs.replicate_summary(df, "team", "wins").collect()}
    assert got["a"]["mean"] == 3.0 and (got["a"]["p10"], got["a"]["p50"], got["a"]["p90"]) == (1, 2, 4) and abs(sum(got["a"]["distribution"].values()) - 1) < 1e-12
    share = {r["team"]: r["title_share"] for r in jobs.best_share(df, "conf", "team", "wins").collect()}
    assert share == {"a": 0.5, "b": 0.5}


def test_frames(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 3, 3)], "k string, t long, id long")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 4, "y"), ("b", 9, "z")], "k string, t long, v string")
    assert {r["id"]: r["v"] for r in frames.asof_latest(left, right, ["k"], "t", ["v"]).collect()} == {1: "y", 2: "x", 3: None}
    assert {r["id"]: r["v"] for r in frames.asof_latest(left, right, ["k"], "t", ["v"], strict=True).collect()} == {1: "y", 2: None, 3: None}
    prior = {(r["k"], r["t"]): r["prior_id"] for r in frames.prior_sums(left, ["k"], "t", ["id"]).collect()}
    assert prior == {("a", 1): None, ("a", 5): 2, ("b", 3): None}
    assert frames.flatten_struct(spark.range(1).select(F.struct(F.struct(F.lit(1).alias("b")).alias("a")).alias("s"))).columns == ["s__a__b"]


def test_quality_and_names(spark):
    with pytest.raises(ValueError):
        quality.assert_not_empty(spark.range(0), "t")
    rows, walk = spark.createDataFrame([("  Foo  State",), ("bar",)], "name string"), spark.createDataFrame([("foo state", "FS"), ("Bar", "B")], "source_name string, canonical string")
    assert {tuple(r) for r in jobs.resolve_names(rows, walk, "name").collect()} == {("  Foo  State", "FS"), ("bar", "B")}
    with pytest.raises(ValueError):
        jobs.resolve_names(rows, walk.limit(1), "name")
    got = {r["name"]: (r["canonical"], r["tier"]) for r in jobs.match_entities(spark.createDataFrame([("Alabama",), ("alabama ",), ("Alabamma",), ("Xyz",)], "name string"), spark.createDataFrame([("Alabama",), ("Auburn",)], "name string")).collect()}
    assert got == {"Alabama": ("Alabama", "exact"), "alabama ": ("Alabama", "normalised"), "Alabamma": ("Alabama", "fuzzy")}


def test_resolve_rating(spark):
    snapshot = spark.createDataFrame([("a", 1800.0, 2020), ("b", 1200.0, 2018), ("c", 1700.0, 2021)], "team string, rating double, snapshot_season long")
    sides = spark.createDataFrame([("a", 2020), ("a", 2021), ("b", 2020), ("c", 2020), ("d", 2020), (None, 2020)], "team string, season long")
    got = {(r["team"], r["season"]): r["rating"] for r in predictions.resolve_rating(sides, snapshot).collect()}
    assert got == pytest.approx({("a", 2020): 1800.0, ("a", 2021): 1700.0, ("b", 2020): 1500 - 300 * 4 / 9, ("c", 2020): 1700.0, ("d", 2020): 1500.0, (None, 2020): 1500.0})


def test_baseline_predictions(spark):
    games = spark.createDataFrame(
        [(1, 2021, "a", "b", False), (2, 2021, "a", "b", True), (3, 2021, "a", "d", None), (4, 2021, "b", "a", False)], "game_id long, season long, home_team string, away_team string, neutral_site boolean"
    )
    snapshot = spark.createDataFrame([("a", 1600.0, 2021), ("b", 1500.0, 2021)], "team string, rating double, snapshot_season long")
    # b has no fit of its own season, and of the two earlier ones only the last is in reach.
    coefs = spark.createDataFrame([("a", 2021, 0.2, -0.1, 0.01), ("a", 2020, 9.0, 9.0, 9.0), ("b", 2020, 0.1, 0.05, 0.02), ("d", 2019, 1.0, 1.0, 1.0)], "team string, season long, off_coef double, def_coef double, hfa double")
    market = spark.createDataFrame([(1, "consensus", -7.5), (2, "alpha", -100 / 22), (4, "beta", None)], "game_id long, provider string, spread double")
    got = {(r["game_id"], r["model_version"]): r for r in predictions.baseline_predictions(games, snapshot, coefs, market).collect()}
    assert len(got) == 8
    edge = (0.2 + 0.05) - (0.1 - 0.1)
    for game, rating, fitted in ((1, 165 / 22, (edge + 0.01) * 68), (2, 100 / 22, edge * 68), (3, 165 / 22, None), (4, -35 / 22, (-edge + 0.02) * 68)):
        alone, blend = got[game, "rating"], got[game, "blend"]
        assert alone["expected_margin"] == pytest.approx(rating) and alone["fitted_margin"] is None
        assert blend["expected_margin"] == pytest.approx(rating if fitted is None else 0.6 * rating + 0.4 * fitted)
        assert blend["fitted_margin"] == (None if fitted is None else pytest.approx(fitted))
        assert alone["home_win_prob"] == blend["home_win_prob"] == pytest.approx(1 / (1 + 10 ** (-rating * 22 / 400)))
    assert got[1, "rating"]["edge"] == pytest.approx(0) and got[1, "rating"]["edge_pick"] == "home"
    assert got[1, "blend"]["edge"] == pytest.approx(0.6 * 7.5 + 0.4 * 0.26 * 68 - 7.5) and got[1, "blend"]["edge_pick"] == "home"
    assert got[2, "rating"]["edge_pick"] == "home" and got[4, "rating"]["edge"] is None and got[4, "blend"]["edge_pick"] is None and got[3, "rating"]["market_provider"] is None
