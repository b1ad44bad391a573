"""What is known before a week's contest: candidate columns of both sides, and their screen against the margin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import week_index
from ..operators.frames import unpivot_sides
from . import features as ft
from . import fitted as fi
from .preseason import feature_screen

#: The weeks that make up a side's form, and those that its spread needs.
FORM_WEEKS, SPREAD_WEEKS = 4, 2
#: Form and spread are differences of means: past twelve decimals they hold only what rounding left.
DECIMALS = 12
CANDIDATES = ["off_ppd", "def_ppd_allowed", "off_field_pos", "def_field_pos_allowed", "form_net_epa_last4", "vol_net_epa"]


def screened_contests(games: DataFrame) -> DataFrame:
    """Contests with a result and at least one side of the first division."""
    return games.filter("completed AND home_points IS NOT NULL AND away_points IS NOT NULL AND (home_classification = 'fbs' OR away_classification = 'fbs')")


def drive_sums(drives: DataFrame, games: DataFrame) -> DataFrame:
    """(team, season, at) with sums and counts of a week's drives, of those with the ball and those against it; one scan of the drives.

    A drive's points are the difference of its two scores, unknown if one of them is.
    """
    finite = lambda c: F.when(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), c.cast("double"))
    weeks = games.select(F.col("id").alias("game_id"), week_index().cast("long").alias("at"))
    points = finite(F.col("end_offense_score")) - finite(F.col("start_offense_score"))
    rows = drives.select("game_id", "season", "offense", "defense", points.alias("points"), finite(F.col("start_yards_to_goal")).alias("start")).join(weeks, "game_id")
    sums = [F.sum("points").alias("p"), F.count("points").alias("pn"), F.sum("start").alias("f"), F.count("start").alias("fn")]
    rows = rows.groupBy("season", "at", "offense", "defense").agg(*sums)
    names = ("p", "pn", "f", "fn")
    side = lambda team, own: F.struct(F.col(team).alias("team"), *[(F.col(c) if o == own else F.lit(None).cast("long" if c.endswith("n") else "double")).alias(f"{o}_{c}") for o in ("off", "def") for c in names])
    both = rows.select("season", "at", F.explode(F.array(side("offense", "off"), side("defense", "def"))).alias("x")).select("season", "at", "x.*").filter("team IS NOT NULL")
    return both.groupBy("team", "season", "at").agg(*[F.sum(f"{o}_{c}").alias(f"{o}_{c}") for o in ("off", "def") for c in names])


def net_values(plays: DataFrame) -> DataFrame:
    """(team, season, at, net) from ``features.play_events``: a week's mean value of own plays less that of plays against, null without either."""
    mean = lambda own: F.col(f"{own}_epa") / F.nullif(F.col(f"{own}_plays"), F.lit(0))
    return plays.select("team", "season", "at", (mean("off") - mean("def")).alias("net"))


def asked_sides(games: DataFrame) -> DataFrame:
    """(team, season, at, game_id, side, home_margin): two rows a contest."""
    rows = unpivot_sides(games.withColumns({"at": week_index().cast("long"), "home_margin": (F.col("home_points") - F.col("away_points")).cast("double")}).select("id", "season", "at", "home_margin", "home_team", "away_team"))
    return rows.select("team", "season", "at", F.col("id").alias("game_id"), "side", "home_margin")


def candidates_by_week(games: DataFrame, drives: DataFrame, plays: DataFrame) -> DataFrame:
    """(team, season, at, CANDIDATES) of each week, from strictly earlier weeks of the season.

    All sources are events of (team, season, week), one row a week; one window folds them, so an event of a week cannot reach that week's
    contests, and the fold reads as many rows as the calendar has. ``plays``: rows of ``features.play_events``.
    """
    rows = ft.by_week(asked_sides(games).select(*ft.WEEK).unionByName(drive_sums(drives, games), allowMissingColumns=True).unionByName(net_values(plays), allowMissingColumns=True))
    before = Window.partitionBy("team", "season").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    per = lambda a, b: F.sum(a).over(before) / F.nullif(F.sum(b).over(before), F.lit(0))
    rows = rows.select(*ft.WEEK, F.collect_list("net").over(before).alias("_nets"), F.avg("net").over(before).alias("_mean"), F.stddev_pop("net").over(before).alias("_spread"), *[per(f"{o}_{c}", f"{o}_{c}n").alias(n) for o, c, n in (("off", "p", "off_ppd"), ("def", "p", "def_ppd_allowed"), ("off", "f", "off_field_pos"), ("def", "f", "def_field_pos_allowed"))])
    last = F.aggregate(F.slice("_nets", -FORM_WEEKS, FORM_WEEKS), F.lit(0.0), lambda a, x: a + x) / FORM_WEEKS
    told = {
        "form_net_epa_last4": F.when(F.size("_nets") >= FORM_WEEKS, F.round(last - F.col("_mean"), DECIMALS) + 0.0),
        "vol_net_epa": F.when(F.size("_nets") >= SPREAD_WEEKS, F.round("_spread", DECIMALS) + 0.0),
    }
    return rows.withColumns(told).select(*ft.WEEK, *CANDIDATES)


def as_of_candidates(games: DataFrame, drives: DataFrame, plays: DataFrame) -> DataFrame:
    """(game_id, side, season, home_margin, CANDIDATES) of both sides of each contest: their week's candidates, which meet them by broadcast."""
    return ft.of_week(asked_sides(games), candidates_by_week(games, drives, plays), CANDIDATES).select("game_id", "side", "season", "home_margin", *CANDIDATES)


def week_frame(t, vectors: DataFrame) -> DataFrame:
    """game_id, season, home_margin, elo_diff, adj_epa_net_diff, CANDIDATES: home less away, null where either side's is not known.

    ``vectors`` (M5 of these tables) tells whether there are fits; without them the second control is null. Both sides' candidates and
    controls are their week's, which meet a contest by broadcast (but for its own ratings), so no contest is moved for them.
    """
    weeks, contests = ft.calendar(t, "adj_epa_net" in vectors.columns)
    games = screened_contests(t["games"])
    net = F.col("adj_epa_net") if "adj_epa_net" in weeks.columns else F.lit(None).cast("double")
    told = ft.of_week(weeks.select(*ft.WEEK, "id", net.alias("net")), candidates_by_week(games, t["drive_scores"], ft.play_events({"games": games, "plays": t["plays"]})), CANDIDATES).select("id", "net", *CANDIDATES).persist()
    rows = contests.filter("played AND first_division")
    for s in ("home", "away"):
        rows = rows.join(F.broadcast(told.select(*[F.col(c).alias(f"{s}_{c}") for c in told.columns])), f"{s}_id")  # one row a team and week
    diff = lambda c, n: (F.col(f"home_{c}") - F.col(f"away_{c}")).alias(n)
    return rows.select("game_id", "season", F.col("margin").alias("home_margin"), diff("elo", "elo_diff"), diff("net", "adj_epa_net_diff"), *[diff(c, c) for c in CANDIDATES])


def week_screen(frame: DataFrame, margins: DataFrame, **limits) -> DataFrame:
    """M25's screen: mode and M23's columns. ``features``: candidates against the margin beside both controls; ``margin``: beside what a
    fit that ends with the season before expected (``margins``: game_id, model_margin), on the contests that have one."""
    beside = feature_screen(frame, CANDIDATES, "adj_epa_net_diff", target="home_margin", given="elo_diff", judged="second", **limits)
    fitted = feature_screen(frame.join(margins, "game_id"), CANDIDATES, "elo_diff", target="home_margin", given="model_margin", **limits)
    return beside.withColumn("mode", F.lit("features")).unionByName(fitted.withColumn("mode", F.lit("margin")))


def frozen_margins(scored: DataFrame) -> DataFrame:
    """(game_id, model_margin) from M13's rows: only fits that end with the season before the contest's."""
    return scored.filter("played AND through = season - 1").select("game_id", F.col("expected_margin").alias("model_margin"))


def frame_of_contests(t) -> DataFrame:
    """M25 as a query, with M3's and M1's fits."""
    return week_frame(t, ft.fitted_features(t))


def candidates_of_contests(t) -> DataFrame:
    """M25 over vectors without fits."""
    return week_frame(t, ft.team_week_features(t)).drop("adj_epa_net_diff")


def screen_of_contests(t) -> DataFrame:
    """M25's screen as a query; frame and fits read the same weeks and contests, which are made once."""
    vectors = ft.fitted_features(t)
    return week_screen(week_frame(t, vectors), frozen_margins(fi.scores(t, vectors)))


_BY_WEEK = lambda alias, team, columns, source: f"{alias} AS (SELECT {team} AS team, season, wk, {columns} FROM {source} GROUP BY ALL)"
_SUMS = "sum(end_offense_score - start_offense_score) AS p, count(end_offense_score - start_offense_score) AS pn, sum(start_yards_to_goal) AS f, count(start_yards_to_goal) AS fn"
_MEANS = lambda alias, source: f"{alias} AS (SELECT s.game_id, s.side, sum(p)::DOUBLE / nullif(sum(pn), 0) AS ppd, sum(f)::DOUBLE / nullif(sum(fn), 0) AS fp FROM s JOIN {source} x ON x.team = s.team AND x.season = s.season AND x.wk < s.wk GROUP BY ALL)"
_DIFFS = {"off_ppd": "o{}.ppd", "def_ppd_allowed": "d{}.ppd", "off_field_pos": "o{}.fp", "def_field_pos_allowed": "d{}.fp", "form_net_epa_last4": "n{}.form", "vol_net_epa": "n{}.vol", "elo_diff": "v{}.elo_pregame"}
#: Reference SQL of the frame over vectors without fits.
FRAME_SQL = f"""
WITH g AS (SELECT *, {ft._AT} AS wk FROM {{games}} WHERE completed AND home_points IS NOT NULL AND away_points IS NOT NULL AND (home_classification = 'fbs' OR away_classification = 'fbs')),
s AS (SELECT id AS game_id, season, wk, home_team AS team, 'home' AS side FROM g UNION ALL SELECT id, season, wk, away_team, 'away' FROM g),
dr AS (SELECT d.*, wk FROM {{drive_scores}} d JOIN g ON g.id = d.game_id),
pl AS (SELECT p.*, wk FROM ({ft.oracle_marts.K10}) p JOIN g ON g.id = p.game_id WHERE NOT is_garbage_time),
{_BY_WEEK("ow", "offense", _SUMS, "dr")}, {_BY_WEEK("dw", "defense", _SUMS, "dr")}, {_BY_WEEK("oe", "offense", "avg(epa) AS e", "pl")}, {_BY_WEEK("de", "defense", "avg(epa) AS e", "pl")},
nw AS (SELECT team, season, wk, oe.e - de.e AS net FROM oe JOIN de USING (team, season, wk)),
{_MEANS("o", "ow")}, {_MEANS("d", "dw")},
n AS (SELECT s.game_id, s.side, CASE WHEN count(net) >= 4 THEN round(list_sum(list(net ORDER BY x.wk)[-4:]) / 4 - avg(net), 12) + 0.0 END AS form, CASE WHEN count(net) >= 2 THEN round(stddev_pop(net), 12) + 0.0 END AS vol
  FROM s JOIN nw x ON x.team = s.team AND x.season = s.season AND x.wk < s.wk GROUP BY ALL),
v AS ({ft.SQL})
SELECT g.id AS game_id, g.season, (home_points - away_points)::DOUBLE AS home_margin, {", ".join(f"{x.format('h')} - {x.format('a')} AS {n}" for n, x in _DIFFS.items())}
FROM g JOIN v vh ON vh.game_id = g.id AND vh.side = 'home' JOIN v va ON va.game_id = g.id AND va.side = 'away'
{" ".join(f"LEFT JOIN {x} {x}{k} ON {x}{k}.game_id = g.id AND {x}{k}.side = '{side}'" for x in "odn" for k, side in (("h", "home"), ("a", "away")))}
"""
