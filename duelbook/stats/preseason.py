"""What is known before a season: candidate columns and their screen (M24, M23), replayed projections and their report."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import normal_cdf, ratio
from ..operators.frames import latest_per_key, unpivot_sides
from . import features as ft
from . import fitted as fi
from .predictions import market_lines

#: How strong a candidate must be, the false discoveries that are put up with, and the freedom that the normal curve needs.
LEAST_PARTIAL, MOST_FALSE, LEAST_FREEDOM = 0.08, 0.10, 200
#: What rounding leaves beside a control that tells all: a column given itself.
NOTHING_LEFT = 1e-6
#: Contests of a slate that are known before the season, wins of a bowl and of a great season.
SLATE, BOWL, GREAT = 12, 6, 10
CANDIDATES = ["recruiting_points", "recruiting_points_regime", "blue_chips", "net_transfers", "draft_capital", "draft_picks_3yr", "returning_ppa", "first_year", "unproven", "line_yards", "stuff_rate"]


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, if no key has two of them: a join that fans out is an error when the rows are read."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    text = F.concat_ws(" ", F.lit("several rows of"), *keys)
    return df.withColumn(keys[0], F.when(n == 1, F.col(keys[0])).otherwise(F.raise_error(text).cast(df.schema[keys[0]].dataType)))


def transfers(t) -> DataFrame:
    """(season, team, net): ratings that came less those that left, an unrated player as 0; both signs from one scan."""
    flow = lambda team, sign: F.struct(F.col(team).alias("team"), (sign * F.coalesce("rating", F.lit(0.0))).alias("v"))
    rows = t["transfer_portal"].select("season", F.explode(F.array(flow("destination", 1.0), flow("origin", -1.0))).alias("x")).select("season", "x.*")
    return rows.filter("team IS NOT NULL").groupBy("season", "team").agg(F.sum("v").alias("net"))


def preseason_frame(t) -> DataFrame:
    """(season, team, rating, prior_rating, CANDIDATES) of every team rated in a season and the one before.

    The regime column sums the decayed classes of the last four years from the coach's start on: without a known start it is null,
    and for a new coach, who has signed none, too. Sums over flows and drafts are 0 only where that year's table was loaded.
    """
    sp = t["sp_ratings"]
    spine = sp.select(F.col("year").alias("season"), "team", "rating").filter("rating IS NOT NULL")
    spine = spine.join(sp.select((F.col("year") + 1).alias("season"), "team", F.col("rating").alias("prior_rating")).filter("prior_rating IS NOT NULL"), ["season", "team"])
    spells = ft.coach_spells(t).select("team", "season", "start")
    later = F.explode(F.sequence(F.col("year") + 1, F.col("year") + ft.CLASSES))
    classes = t["team_recruiting"].filter("points IS NOT NULL").select("team", "year", later.alias("season"), "points").join(spells, ["team", "season"], "left")
    worth = F.col("points") * F.pow(F.lit(ft.DECAY), F.col("season") - F.col("year") - 1)
    classes = classes.groupBy("team", "season").agg(F.sum(worth).alias("flat"), F.sum(F.when(F.col("year") >= F.col("start"), worth)).alias("recruiting_points_regime"))
    picks = t["draft_picks"].filter("college_team IS NOT NULL")
    capital = picks.groupBy(F.col("year").alias("season"), F.col("college_team").alias("team")).agg(F.sum(8 - F.least(F.lit(7), F.coalesce("round", F.lit(7)))).cast("double").alias("capital"))
    loaded = lambda df, name: df.select("season").distinct().withColumn(name, F.lit(True))
    flows = transfers(t)
    returning, _, trench = ft.yearly_events(t)
    signed = ft.class_events(t).select("team", "season", F.col("blue_share").alias("blue_chips"))
    rows = spine
    for part in (classes, signed, capital, flows, ft.draft_events(t).select("team", "season", F.col("picks_3yr").alias("draft_picks_3yr")), returning.select("team", "season", F.col("ret_ppa").alias("returning_ppa")), ft.coach_events(t), trench):
        rows = rows.join(part, ["season", "team"], "left")
    rows = rows.join(F.broadcast(loaded(capital, "has_draft")), "season", "left").join(F.broadcast(loaded(flows, "has_flow")), "season", "left")  # one row a season
    rows = rows.withColumns({
        "recruiting_points": F.coalesce("flat", F.lit(0.0)), "net_transfers": F.when(F.col("has_flow"), F.coalesce("net", F.lit(0.0))),
        "draft_capital": F.when(F.col("has_draft"), F.coalesce("capital", F.lit(0.0))),
    })
    return one_row_each(rows.select("season", "team", "rating", "prior_rating", *CANDIDATES), ["season", "team"])


def _partial(xy: Column, xz: Column, yz: Column) -> Column:
    """First-order partial correlation; 0 where a control tells all, up to rounding."""
    below = F.sqrt(F.greatest(F.lit(0.0), (1 - xz * xz) * (1 - yz * yz)))
    return F.when(below < NOTHING_LEFT, 0.0).otherwise((xy - xz * yz) / below)


def p_value(r: Column, n: Column, controls: int, least: int) -> Column:
    """Two-sided, by the normal curve; null below ``least`` degrees of freedom."""
    freedom = n - 2 - controls
    t = F.abs(r) * F.sqrt(freedom / (1 - r * r))
    return F.when(freedom < least, None).when(F.abs(r) >= 1, 0.0).otherwise(F.round(2 * (1 - normal_cdf(t)), 9))


def feature_screen(frame: DataFrame, candidates: list[str], control: str = "recruiting_points", *, target: str = "rating", given: str = "prior_rating", judged: str = "first", least_freedom: int = LEAST_FREEDOM, least_partial: float = LEAST_PARTIAL, most_false: float = MOST_FALSE) -> DataFrame:
    """Candidate, n, partial_r (of ``target`` given ``given``), n_second, partial_r_second (given ``control`` too), p_value, q_value, verdict.

    Each candidate is measured on the rows that it, the ratings and, for the second, the control have: all candidates' moments come
    from one aggregate. A constant correlates with nothing. Q-values are Benjamini and Hochberg's over the partials that are
    ``judged``: the first ones, or the second.
    """
    each = F.array(*[F.struct(F.lit(c).alias("candidate"), F.col(c).cast("double").alias("x")) for c in candidates])
    rows = frame.select(F.col(target).cast("double").alias("y"), F.col(given).cast("double").alias("z"), F.col(control).cast("double").alias("w"), F.explode(each).alias("e")).select("y", "z", "w", "e.*")
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    first = finite("x") & finite("y") & finite("z")
    second = first & finite("w")

    def seen(a: str, b: str, ok: Column) -> Column:
        a, b = F.when(ok, F.col(a)), F.when(ok, F.col(b))
        return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))

    pairs = [("x", "y"), ("x", "z"), ("y", "z")], [("x", "y"), ("x", "z"), ("y", "z"), ("x", "w"), ("y", "w"), ("w", "z")]
    sums = rows.groupBy("candidate").agg(
        F.count(F.when(first, 1)).alias("n"), F.count(F.when(second, 1)).alias("n_second"),
        *[seen(a, b, ok).alias(f"{k}{a}{b}") for k, (ok, own) in enumerate(zip((first, second), pairs, strict=True)) for a, b in own],
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    sums = sums.withColumns({c: zero(c) for c in sums.columns if c[0] in "01"})
    c = F.col
    xw, yw = _partial(c("1xw"), c("1xz"), c("1wz")), _partial(c("1yw"), c("1yz"), c("1wz"))
    out = sums.select("candidate", "n", _partial(c("0xy"), c("0xz"), c("0yz")).alias("partial_r"), "n_second", _partial(_partial(c("1xy"), c("1xz"), c("1yz")), xw, yw).alias("partial_r_second"))
    told = ("partial_r", "n", 1) if judged == "first" else ("partial_r_second", "n_second", 2)
    out = out.withColumn("p_value", p_value(c(told[0]), c(told[1]), told[2], least_freedom))
    # One row a candidate.
    tested = F.count("p_value").over(Window.partitionBy())
    order = Window.orderBy(F.col("p_value").asc_nulls_last(), "candidate")
    scaled = out.withColumn("scaled", c("p_value") * tested / F.row_number().over(order))
    q = F.when(c("p_value").isNotNull(), F.least(F.lit(1.0), F.min("scaled").over(order.rowsBetween(0, Window.unboundedFollowing))))
    ships = (F.abs(told[0]) >= least_partial) & F.coalesce(c("q_value") <= most_false, F.lit(False))
    return scaled.withColumn("q_value", F.round(q, 9)).withColumn("verdict", F.when(ships, "ship").otherwise("reject")).drop("scaled")


def screened(t) -> DataFrame:
    """M23 as a query. The test tables have 25 teams, so fewer degrees of freedom are asked for."""
    return feature_screen(preseason_frame(t), CANDIDATES, least_freedom=50)


def slate(games: DataFrame, most: int = SLATE) -> DataFrame:
    """Regular contests that are among both sides' first ``most`` of the season: later ones may owe their sides to results."""
    regular = games.filter("season_type = 'regular' AND completed AND home_points IS NOT NULL AND away_points IS NOT NULL")
    asked = regular.select("id", "season", "start_date", "home_team", "away_team")
    days = unpivot_sides(asked).groupBy("team", "season", "start_date").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("team", "season").orderBy(F.col("start_date").asc_nulls_last())
    # Contests of days that begin past the first ``most`` are not among them: of the calendar's first days alone are contests put in order.
    early = days.withColumn("before", F.sum("n").over(run) - F.col("n")).filter(F.col("before") < most)
    for side in ("home", "away"):
        own = early.select(F.col("team").alias("_team"), F.col("season").alias("_season"), F.col("start_date").alias("_day"), F.col("before").alias(f"_{side}"))
        met = [F.col(a).eqNullSafe(F.col(b)) for a, b in ((f"{side}_team", "_team"), ("season", "_season"), ("start_date", "_day"))]
        asked = asked.join(F.broadcast(own), met, "left").drop("_team", "_season", "_day")  # a few days of each team and season
    order = Window.partitionBy("team", "season").orderBy(F.col("start_date").asc_nulls_last(), "id")
    firsts = asked.filter("_home IS NOT NULL OR _away IS NOT NULL").withColumnsRenamed({"_home": "home_before", "_away": "away_before"})
    # A side that is past its first days is past ``most``, wherever in that day it stands.
    nth = F.when(F.col("before").isNotNull(), F.row_number().over(order)).otherwise(most + 1)
    kept = unpivot_sides(firsts).withColumn("nth", nth).groupBy(F.col("id").alias("_id")).agg(F.max("nth").alias("nth"), F.count(F.lit(1)).alias("_sides")).filter(F.col("nth") <= most)
    found = regular.join(F.broadcast(kept), F.col("id") == F.col("_id"))  # at most so many contests of each team and season
    # An id that stands twice is kept only if none of its rows lies past the first days.
    return found.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("id"))).filter("_sides = 2 * _rows").select(*regular.columns)


def first_vectors(vectors: DataFrame, names: list[str]) -> DataFrame:
    """(team, season, v, played): each team's first vector of a season, and how many contests it already knows of (0, if nothing leaks)."""
    values = F.struct(F.array(*[F.col(c).cast("double") for c in names]).alias("v"), F.col("games_played_to_date").alias("known"))
    return vectors.groupBy("team", "season").agg(F.min_by(values, F.struct("week_index", "game_id")).alias("x")).select("team", "season", "x.*")


def first_of_weeks(rows: DataFrame, weeks: DataFrame, names: list[str]) -> DataFrame:
    """``first_vectors`` of contests by week (``features.contest_weeks``): of each week's first contest the rating, then each team's first week that has one."""
    side = lambda s: F.struct(F.col(f"{s}_id").alias("id"), F.col(f"{s}_elo").alias("elo_pregame"))
    of_week = rows.select("game_id", F.explode(F.array(side("home"), side("away"))).alias("x")).groupBy("x.id").agg(F.min_by("x.elo_pregame", "game_id").alias("elo_pregame"), F.min("game_id").alias("game_id"))
    rated = weeks.join(F.broadcast(of_week), "id").withColumn("week_index", F.col("at"))  # one row a team and week
    return first_vectors(rated, names)


def preseason_scores(t, first: DataFrame, fits: DataFrame, names: list[str]) -> DataFrame:
    """Contests of the slate as the fit of the season before would have had them: both sides by their ``first`` vectors."""
    rows = slate(t["games"]).select(F.col("id").alias("game_id"), "season", F.coalesce(F.col("neutral_site").cast("double"), F.lit(0.0)).alias("neutral"), F.lit(True).alias("played"), "home_team", "away_team", (F.col("home_points") > F.col("away_points")).alias("home_won"), (F.col("home_points") < F.col("away_points")).alias("away_won"))
    for side in ("home", "away"):
        rows = rows.join(first.select(F.col("team").alias(f"{side}_team"), "season", F.col("v").alias(side), F.col("known").alias(f"{side}_known")), [f"{side}_team", "season"])
    scored = fi.score(rows, fits, names, market_lines(t)).select("game_id", "through", "expected_margin", "home_win_prob")
    return rows.select("game_id", "season", "home_team", "away_team", "home_won", "away_won", "home_known", "away_known").join(scored, "game_id")


#: Up to so many chances are multiplied out; longer factors by Fourier transforms, whose errors are of rounding's size.
PLAIN_FACTORS = 64


def _all_wins(probs: np.ndarray) -> np.ndarray:
    """Coefficients of the product of (1 - p + p x): factors are multiplied in pairs, all pairs at once, so n chances take n log^2 n steps."""
    n = len(probs)
    size = 1 << max(0, n - 1).bit_length()
    p = np.concatenate([probs, np.zeros(size - n)])  # a chance of 0 changes nothing
    d = np.stack([1 - p, p], axis=1)
    while len(d) > 1:
        a, b, k = d[::2], d[1::2], d.shape[1]
        if k <= PLAIN_FACTORS + 1:
            d = np.zeros((len(a), 2 * k - 1))
            for i in range(k):
                d[:, i : i + k] += a[:, [i]] * b
        else:
            d = np.maximum(np.fft.irfft(np.fft.rfft(a, 2 * k) * np.fft.rfft(b, 2 * k), 2 * k)[:, : 2 * k - 1], 0.0)
    return d[0, : n + 1]


def win_distribution(probs: Column) -> Column:
    """Chances of 0, 1, 2, ... wins in independent contests with these chances, exactly."""

    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else _all_wins(np.asarray(x, dtype=float)) for x in batch], dtype=object)

    return F.pandas_udf(run, "array<double>")(probs)


def _quantile(dist: str, p: float) -> Column:
    """The least number of wins that a share ``p`` of the distribution does not exceed."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("w"))
    step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.when(s["sum"] + x < p - 1e-12, s["w"] + 1).otherwise(s["w"]).alias("w"))
    return F.aggregate(dist, start, step)["w"].cast("long")


def preseason_backtest(t, scored: DataFrame) -> DataFrame:
    """Season, team, through, games, projected_wins, wins_p10, wins_p90, p_bowl, p_great, actual_wins, baseline_prior, baseline_flat, known.

    The baseline is last season's share of wins times this slate's contests; without last season, a half.
    """
    side = lambda own, p: F.struct(F.col(f"{own}_team").alias("team"), p.alias("p"), F.col(f"{own}_won").cast("int").alias("won"), F.col(f"{own}_known").alias("known"))
    rows = scored.select("season", "through", F.explode(F.array(side("home", F.col("home_win_prob")), side("away", 1 - F.col("home_win_prob")))).alias("x")).select("season", "through", "x.*")
    out = rows.groupBy("season", "team", "through").agg(F.count(F.lit(1)).alias("games"), F.array_sort(F.collect_list("p")).alias("probs"), F.sum("won").alias("actual_wins"), F.max("known").alias("known"))
    before = unpivot_sides(slate(t["games"])).groupBy("team", (F.col("season") + 1).alias("season")).agg(ratio(F.sum((F.col("points") > F.col("opp_points")).cast("int")), F.count(F.lit(1))).alias("rate"))
    out = out.withColumn("dist", win_distribution(F.col("probs"))).join(before, ["team", "season"], "left")
    most = lambda k: F.aggregate(F.slice("dist", k + 1, 100), F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "season", "team", "through", "games", F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("projected_wins"), _quantile("dist", 0.1).alias("wins_p10"), _quantile("dist", 0.9).alias("wins_p90"),
        most(BOWL).alias("p_bowl"), most(GREAT).alias("p_great"), "actual_wins", (F.coalesce("rate", F.lit(0.5)) * F.col("games")).alias("baseline_prior"), (0.5 * F.col("games")).alias("baseline_flat"), "known",
    )


def projection_report(rows: DataFrame, keys: list[str]) -> DataFrame:
    """M26 over M27's rows: error, bias, cover of p10 to p90, both baselines' errors, Brier scores, and quantiles of actual less projected wins."""
    e = F.col("projected_wins") - F.col("actual_wins")
    off = lambda c: F.avg(F.abs(F.col(c) - F.col("actual_wins")))
    brier = lambda p, least: F.avg(F.pow(F.col(p) - (F.col("actual_wins") >= least).cast("double"), F.lit(2.0)))
    inside = F.col("actual_wins").between(F.col("wins_p10"), F.col("wins_p90")).cast("double")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("through").alias("train_through_min"), F.max("through").alias("train_through_max"), F.max("known").alias("max_games_known"),
        F.avg(F.abs(e)).alias("win_mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.avg(inside).alias("coverage"), off("baseline_prior").alias("baseline_prior_mae"), off("baseline_flat").alias("baseline_flat_mae"),
        brier("p_bowl", BOWL).alias("bowl_brier"), brier("p_great", GREAT).alias("great_brier"),
        *[F.percentile(-e, F.lit(q / 100)).alias(f"resid_p{q:02d}") for q in (5, 10, 25, 50, 75, 90, 95)],
    )


CONFIGURATION = ["model_version", "scope", "season_start", "season_end", "strength_share"]


def model_backtest(ledger: DataFrame) -> DataFrame:
    """Of each configuration, told by five columns of which any may be null, the last run, and whether it beats the baselines."""
    last = latest_per_key(ledger, CONFIGURATION, [F.col("run_date").desc(), F.col("run").desc()])
    return last.withColumns({"beats_prior_baseline": F.col("win_mae") < F.col("baseline_prior_mae"), "beats_flat_baseline": F.col("win_mae") < F.col("baseline_flat_mae")})


def backtest_rows(t) -> DataFrame:
    """M27 as a query."""
    weeks, rows, fits = fi.trained(t, fi.FEATURES)
    return preseason_backtest(t, preseason_scores(t, first_of_weeks(rows, weeks, fi.FEATURES), fits, fi.FEATURES))


def win_report(t) -> DataFrame:
    """M26 over M27's rows, for all teams and for those of the first division."""
    division = unpivot_sides(t["games"]).groupBy("team", "season").agg(F.mode("classification").alias("division"))
    rows = backtest_rows(t).join(division, ["team", "season"], "left")
    scopes = F.when(F.col("division") == "fbs", F.array(F.lit("all"), F.lit("fbs"))).otherwise(F.array(F.lit("all")))
    return projection_report(rows.withColumn("scope", F.explode(scopes)), ["scope"])


def backtest_ledger(t) -> DataFrame:
    """M26's figures as runs of a ledger: one for each season that ends a range from the first one on, as if run after it, and rerun after the last."""
    rows = backtest_rows(t).persist()
    years = rows.select(F.col("season").alias("season_end")).distinct()
    ranged = rows.join(F.broadcast(years), F.col("season") <= F.col("season_end"))  # some ten seasons
    first, last = (f(F.col("season_end")).over(Window.partitionBy()) for f in (F.min, F.max))
    out = projection_report(ranged, ["season_end"]).withColumns({"season_start": first, "last": last})
    runs = F.array(F.struct(F.lit(1).alias("run"), F.col("season_end").alias("run_date")), F.struct(F.lit(2).alias("run"), F.col("last").alias("run_date")))
    out = out.withColumn("r", F.explode(runs)).select(F.lit("fitted").alias("model_version"), F.lit("all").alias("scope"), "season_start", "season_end", F.lit(None).cast("double").alias("strength_share"), F.col("r.run").cast("long").alias("run"), F.col("r.run_date").alias("run_date"), *[c for c in out.columns if c not in ("season_start", "season_end", "last", "r")])
    return out


def latest_backtests(t) -> DataFrame:
    """L22 as a query."""
    return model_backtest(backtest_ledger(t))


FRAME_SQL = """
WITH cy AS (SELECT school, year, first_name || '|' || last_name AS coach, count(*) OVER (PARTITION BY school, year) AS n FROM {coach_seasons} QUALIFY row_number() OVER (PARTITION BY school, year ORDER BY games DESC NULLS LAST, first_name, last_name) = 1),
ci AS (SELECT *, min(year) OVER (PARTITION BY school, coach, grp) AS start FROM (SELECT *, year - row_number() OVER (PARTITION BY school, coach ORDER BY year) AS grp FROM cy)),
cr AS (SELECT cy.coach, cy.year, rating FROM cy LEFT JOIN {sp_ratings} sp ON sp.team = school AND sp.year = cy.year WHERE n = 1),
co AS (SELECT school, ci.year, ci.start, count(cr.year) AS seasons, avg(rating) AS mean FROM ci LEFT JOIN cr ON cr.coach = ci.coach AND cr.year < ci.year WHERE n = 1 GROUP BY ALL),
fl AS (SELECT season, team, sum(v) AS net FROM (SELECT season, destination AS team, coalesce(rating, 0) AS v FROM {transfer_portal} UNION ALL SELECT season, origin, -coalesce(rating, 0) FROM {transfer_portal}) WHERE team IS NOT NULL GROUP BY ALL),
dp AS (SELECT year, college_team AS team, count(*) AS picks, sum(8 - least(7, coalesce(round, 7)))::DOUBLE AS capital FROM {draft_picks} WHERE college_team IS NOT NULL GROUP BY ALL),
s AS (SELECT a.year AS season, a.team, a.rating, b.rating AS prior_rating, co.start, co.seasons, co.mean FROM {sp_ratings} a JOIN {sp_ratings} b ON b.team = a.team AND b.year = a.year - 1 LEFT JOIN co ON co.school = a.team AND co.year = a.year)
SELECT s.season, s.team, s.rating, s.prior_rating,
  coalesce((SELECT sum(points * pow(0.8::DOUBLE, s.season - r.year - 1)) FROM {team_recruiting} r WHERE r.team = s.team AND r.year BETWEEN s.season - 4 AND s.season - 1), 0) AS recruiting_points,
  CASE WHEN s.start IS NOT NULL THEN (SELECT sum(points * pow(0.8::DOUBLE, s.season - r.year - 1)) FROM {team_recruiting} r WHERE r.team = s.team AND r.year BETWEEN greatest(s.season - 4, s.start) AND s.season - 1) END AS recruiting_points_regime,
  (SELECT (count(*) FILTER (stars >= 4))::DOUBLE / nullif(count(*), 0) FROM {recruits} r WHERE committed_to = s.team AND r.year BETWEEN s.season - 4 AND s.season - 1) AS blue_chips,
  CASE WHEN s.season IN (SELECT season FROM fl) THEN coalesce(fl.net, 0) END AS net_transfers,
  CASE WHEN s.season IN (SELECT year FROM dp) THEN coalesce(dp.capital, 0) END AS draft_capital,
  CASE WHEN (SELECT count(DISTINCT year) FROM dp WHERE year BETWEEN s.season - 3 AND s.season - 1) = 3 AND EXISTS (SELECT 1 FROM {games} g WHERE g.season = s.season AND s.team IN (g.home_team, g.away_team))
    THEN coalesce((SELECT sum(picks) FROM dp WHERE dp.team = s.team AND year BETWEEN s.season - 3 AND s.season - 1), 0)::DOUBLE END AS draft_picks_3yr,
  rd.percent_ppa AS returning_ppa, (CASE WHEN s.start >= s.season THEN 1.0 WHEN s.start IS NOT NULL THEN 0.0 END)::DOUBLE AS first_year,
  (CASE WHEN s.start IS NULL THEN NULL WHEN s.start < s.season THEN 0.0 WHEN s.seasons = 0 THEN 1.0 WHEN s.mean < 0 THEN 1.0 WHEN s.mean IS NOT NULL THEN 0.0 END)::DOUBLE AS unproven,
  ats.defense_line_yards AS line_yards, ats.defense_stuff_rate AS stuff_rate
FROM s LEFT JOIN fl ON fl.season = s.season AND fl.team = s.team LEFT JOIN dp ON dp.year = s.season AND dp.team = s.team
LEFT JOIN {returning_detail} rd ON rd.season = s.season AND rd.team = s.team LEFT JOIN {advanced_team_stats} ats ON ats.season = s.season - 1 AND ats.team = s.team
"""


def screen_sql(cdf: Callable[[str], str]) -> str:
    """Reference SQL of ``screened``; ``cdf`` writes the normal curve."""
    r = lambda a, b, ok: f"coalesce(corr({a}, {b}) FILTER ({ok}), 0)"
    first, second = "x IS NOT NULL", "x IS NOT NULL AND w IS NOT NULL"

    def part(xy: str, xz: str, yz: str) -> str:
        below = f"sqrt(greatest(0, (1 - {xz} * {xz}) * (1 - {yz} * {yz})))"
        return f"CASE WHEN {below} < {NOTHING_LEFT} THEN 0 ELSE ({xy} - {xz} * {yz}) / {below} END"

    safe = lambda a, b, ok, n: f"CASE WHEN isnan({r(a, b, ok)}) THEN 0 ELSE {r(a, b, ok)} END AS {n}"
    cols = [safe(a, b, ok, f"{k}{a}{b}") for k, ok, own in (("f", first, ("xy", "xz", "yz")), ("s", second, ("xy", "xz", "yz", "xw", "yw", "wz"))) for a, b in own]
    t = "(abs(partial_r) * sqrt((n - 3) / (1 - partial_r * partial_r)))"
    p = f"CASE WHEN n - 3 < 50 THEN NULL WHEN abs(partial_r) >= 1 THEN 0 ELSE round(2 * (1 - ({cdf(t)})), 9) END"
    return f"""WITH fr AS ({FRAME_SQL}),
l AS (SELECT candidate, x::DOUBLE AS x, rating AS y, prior_rating AS z, w FROM (SELECT rating, prior_rating, recruiting_points::DOUBLE AS w, {', '.join(f'{c}::DOUBLE AS {c}' for c in CANDIDATES)} FROM fr) UNPIVOT INCLUDE NULLS (x FOR candidate IN ({', '.join(CANDIDATES)}))),
m AS (SELECT candidate, count(*) FILTER ({first}) AS n, count(*) FILTER ({second}) AS n_second, {', '.join(cols)} FROM l GROUP BY candidate),
r AS (SELECT candidate, n, {part('fxy', 'fxz', 'fyz')} AS partial_r, n_second, {part('sxy', 'sxz', 'syz')} AS a, {part('sxw', 'sxz', 'swz')} AS b, {part('syw', 'syz', 'swz')} AS c FROM m),
v AS (SELECT *, {part('a', 'b', 'c')} AS partial_r_second, {p} AS p_value FROM r),
q AS (SELECT *, p_value * count(p_value) OVER () / row_number() OVER (ORDER BY p_value NULLS LAST, candidate) AS scaled FROM v),
z AS (SELECT *, CASE WHEN p_value IS NOT NULL THEN round(least(1.0, min(scaled) OVER (ORDER BY p_value NULLS LAST, candidate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) END AS q_value FROM q)
SELECT candidate, n, partial_r, n_second, partial_r_second, p_value, q_value, CASE WHEN abs(partial_r) >= 0.08 AND q_value <= 0.1 THEN 'ship' ELSE 'reject' END AS verdict FROM z"""
