"""A season's outlook: a ledger of projections by day, and the latest of each side with what it leaves out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if
from ..operators.frames import latest_per_key, unpivot_sides
from . import jobs
from .predictions import rating_snapshot
from .preseason import BOWL, GREAT, _quantile, win_distribution

#: A full slate by division (and where that is unknown), sides that a conference needs to tell its own, replicates of title chances.
SLATES, OTHER_SLATE, COHORT, REPLICATES = {"fbs": 12, "fcs": 11, "ii": 11, "iii": 10}, 11, 3, 200
LEDGER_KEYS = ["season", "team", "model_version"]
#: A run of the query: a model and the day it was run on; the blend stopped after the first day.
RUNS = [("elo", 1), ("elo", 3), ("blend", 1)]
#: Shares and titles are compared at so many decimals.
DECIMALS = 9


def slate_by_run(games: DataFrame, predictions: DataFrame, runs: list[tuple[str, int]]) -> DataFrame:
    """Regular contests by run, with ``p``: the home side's chance by the last prediction that the run's day knew of, or the result.

    A contest to come that has no prediction by then has no ``p``: it is on the slate, but no projection counts it.
    """
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model_version"), F.lit(d).cast("long").alias("projection_date")) for m, d in runs]))
    known = predictions.withColumn("r", each).filter("r.model_version = model_version AND prediction_day <= r.projection_date")
    known = known.groupBy("game_id", "r").agg(F.max_by("home_win_prob", "prediction_day").alias("said")).select("game_id", "r.*", "said")
    rows = games.filter("season_type = 'regular'").withColumn("r", each).select(F.col("id").alias("game_id"), "season", "conference_game", F.coalesce("completed", F.lit(False)).alias("done"), "r.*", *[f"{s}_{c}" for s in ("home", "away") for c in ("team", "conference", "classification", "points")])
    rows = rows.join(known, ["game_id", "model_version", "projection_date"], "left")
    won = lambda a, b: F.when(F.col("done"), (F.col(a) > F.col(b)).cast("double"))
    out = rows.withColumns({"home_p": F.coalesce(won("home_points", "away_points"), F.col("said")), "away_p": F.coalesce(won("away_points", "home_points"), 1 - F.col("said"))})
    return unpivot_sides(out.drop("said")).filter("team IS NOT NULL")


def draw(game: Column, replicate: Column) -> Column:
    """A number from 0 to 1 that a contest has in a replicate, the same wherever it is computed."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", game.cast("string"), replicate.cast("string"))), 1, 8), 16, 10).cast("double") / 2.0**32


def title_shares(sides: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """(season, model_version, projection_date, team, conf_title_prob): how often a side has the best share of wins in contests within
    its conference, ties split; null for conferences of one.

    Contests to come are drawn in each replicate, the same draw for both sides; decided ones are added up before.
    """
    group = ["season", "model_version", "projection_date", "conference", "team"]
    own = sides.filter("conference_game AND conference IS NOT NULL AND p IS NOT NULL")
    n, at = F.lit(replicates), F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))
    base = own.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("done"), F.col("p")).otherwise(0.0)).alias("won"))
    u = draw(F.col("game_id"), F.col("replicate"))
    wins = F.when(F.col("side") == "home", u < F.col("p")).otherwise(u >= 1 - F.col("p")).cast("int")
    drawn = own.filter("NOT done").withColumn("replicate", at).groupBy(*group, "replicate").agg(F.sum(wins).alias("drawn"))
    rows = base.withColumn("replicate", at).join(drawn, [*group, "replicate"], "left")
    rows = rows.select(F.struct(*group[:4]).alias("g"), "team", "replicate", F.round((F.col("won") + F.coalesce("drawn", F.lit(0))) / F.col("n"), DECIMALS).alias("share"))
    return jobs.best_share(rows, "g", "team", "share").select("g.*", "team", F.col("title_share").alias("conf_title_prob")).withColumn("n_sims", n.cast("long"))


def expected_slate(rows: DataFrame) -> Column:
    """Contests of a full slate: the usual number in the side's conference, but the division's own or one less; one less where a conference has too few sides."""
    standard = F.coalesce(F.create_map(*[F.lit(x) for kv in SLATES.items() for x in kv])[F.coalesce("classification", F.lit(""))], F.lit(OTHER_SLATE))
    w = Window.partitionBy("season", "model_version", "projection_date", "conference")
    usual = F.when(F.col("conference").isNotNull() & (F.count(F.lit(1)).over(w) >= COHORT), F.col("_usual"))
    return F.coalesce(F.least(F.greatest(usual, standard - 1), standard), standard - 1).cast("long")


def project(games: DataFrame, predictions: DataFrame, ratings: DataFrame, runs: list[tuple[str, int]]) -> DataFrame:
    """The ledger's rows of these runs: one a season, side, model and day, over the contests that were played or predicted by then.

    Chances of numbers of wins are exact, not drawn; only titles are. A side none of whose contests has a chance or a result has no row.
    ``ratings``: (team, rating); opponents without one do not count in the strength of a slate.
    """
    keys = [*LEDGER_KEYS, "projection_date"]
    sides = slate_by_run(games, predictions, runs)
    rated = ratings.select(F.col("team").alias("opp_team"), "rating")
    rows = sides.join(rated, "opp_team", "left").groupBy(*keys).agg(
        F.mode("conference", True).alias("conference"), F.mode("classification", True).alias("classification"), F.count(F.lit(1)).alias("games_scheduled"), F.count("p").alias("games_simulated"), count_if(F.col("done")).alias("games_completed"),
        F.sum(F.when(F.col("done"), F.col("p")).otherwise(0.0)).cast("long").alias("actual_wins"), F.sort_array(F.collect_list(F.when(~F.col("done"), F.col("p")))).alias("probs"), F.avg("rating").alias("sos_rating"),
    ).filter("games_simulated > 0")
    counts = rows.filter("conference IS NOT NULL").groupBy("season", "model_version", "projection_date", "conference").agg(F.mode(-F.col("games_scheduled"), True).alias("m"))
    rows = rows.join(counts, ["season", "model_version", "projection_date", "conference"], "left").withColumn("_usual", -F.col("m"))
    rows = rows.withColumn("expected_games", expected_slate(rows)).withColumn("dist", win_distribution(F.col("probs")))
    order = Window.partitionBy("season", "model_version", "projection_date").orderBy(F.round("sos_rating", DECIMALS).desc())
    least = lambda k: F.when(F.col("actual_wins") >= k, 1.0).otherwise(F.aggregate(F.slice("dist", F.greatest(F.lit(1), k + 1 - F.col("actual_wins")).cast("int"), F.size("dist")), F.lit(0.0), lambda a, x: a + x))
    wins = F.col("actual_wins") + F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    at = {n: F.col("actual_wins") + _quantile("dist", p) for n, p in (("wins_p10", 0.1), ("wins_p25", 0.25), ("median_wins", 0.5), ("wins_p75", 0.75), ("wins_p90", 0.9))}
    out = rows.select(
        *keys, "conference", "games_scheduled", "games_simulated", "games_completed", "actual_wins", (F.col("games_scheduled") >= F.col("expected_games")).alias("schedule_complete"),
        wins.alias("projected_wins"), (F.col("games_simulated") - wins).alias("projected_losses"), *[v.alias(k) for k, v in at.items()],
        F.when(F.col("classification") == "fbs", least(BOWL)).alias("p_bowl_eligible"), least(GREAT).alias("p_ten_plus"), "dist",
        "sos_rating", F.when(F.col("sos_rating").isNotNull(), F.rank().over(order)).cast("long").alias("sos_rank"),
    )
    return out.join(title_shares(sides).drop("conference"), keys, "left")


def season_division(games: DataFrame, teams: DataFrame, wanted: DataFrame) -> DataFrame:
    """(season, team, classification) of the wanted (season, team): what a side was in that season's contests, else what it is listed as."""
    sides = unpivot_sides(games).join(F.broadcast(wanted.select("season").distinct()), "season", "left_semi")  # seasons only
    played = sides.filter("classification IS NOT NULL").groupBy("season", "team").agg(F.mode("classification", True).alias("played"))
    listed = teams.filter("classification IS NOT NULL").groupBy(F.col("school").alias("team")).agg(F.min("classification").alias("listed"))
    return wanted.join(played, ["season", "team"], "left").join(listed, "team", "left").select("season", "team", F.coalesce("played", "listed").alias("classification"))


def season_outlook(ledger: DataFrame, games: DataFrame, teams: DataFrame) -> DataFrame:
    """Of each season, side and model the row of the latest day, with games_unscored, classification and is_projection.

    ``games_unscored``: contests to come that the model had not predicted by that day. ``is_projection``: some contest is still
    projected, told from the latest row alone, as older ones would mark a season that is over. No row is lost for want of a division.
    """
    last = latest_per_key(ledger, LEDGER_KEYS, [F.col("projection_date").desc()])
    division = season_division(games, teams, last.select("season", "team").distinct())
    return last.join(division, ["season", "team"], "left").withColumns({"games_unscored": F.col("games_scheduled") - F.col("games_simulated"), "is_projection": F.col("games_simulated") > F.col("games_completed")})


def ledger_of_runs(t) -> DataFrame:
    """The ledger of RUNS over the last two seasons."""
    last = t["games"].agg(F.max("season").alias("last"))
    games = t["games"].join(F.broadcast(last), F.col("season") >= F.col("last") - 1).drop("last")  # one row
    return project(games, t["game_predictions"], rating_snapshot(t), RUNS)


def outlook_of_seasons(t) -> DataFrame:
    """L21 as a query. The distribution is told by its length."""
    return season_outlook(ledger_of_runs(t), t["games"], t["teams"]).withColumn("outcomes", F.size("dist").cast("long")).drop("dist")


def unscored(games: DataFrame, predictions: DataFrame, model: str, day: int) -> DataFrame:
    """Regular contests to come that a model had not predicted by a day, by anti-join."""
    known = predictions.filter((F.col("model_version") == model) & (F.col("prediction_day") <= day)).select(F.col("game_id").alias("id"))
    return games.filter("season_type = 'regular' AND NOT coalesce(completed, false)").join(known, "id", "left_anti")


def _cut(k: int) -> str:
    return f"CASE WHEN actual_wins >= {k} THEN 1.0 ELSE coalesce(list_sum(dist[{k} + 1 - actual_wins:]), 0) END::DOUBLE"


_AT = lambda p: f"actual_wins + len(list_filter(range(1, len(dist) + 1), lambda i: list_sum(dist[1:i]) < {p} - 1e-12))"
_DIV = "CASE classification " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLATES.items()) + f" ELSE {OTHER_SLATE} END"
#: Reference SQL of ``outlook_of_seasons``.
SQL = f"""
WITH runs AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {d}::BIGINT)" for m, d in RUNS)}) r(model_version, projection_date)),
kn AS (SELECT game_id, p.model_version, projection_date, arg_max(home_win_prob, prediction_day) AS said FROM {{game_predictions}} p JOIN runs r ON r.model_version = p.model_version AND prediction_day <= projection_date GROUP BY ALL),
g AS (SELECT g.*, r.*, said FROM (SELECT * FROM {{games}} WHERE season_type = 'regular' AND season >= (SELECT max(season) - 1 FROM {{games}})) g CROSS JOIN runs r LEFT JOIN kn ON kn.game_id = g.id AND kn.model_version = r.model_version AND kn.projection_date = r.projection_date),
s AS (SELECT id, season, model_version, projection_date, home_team AS team, away_team AS opp, home_conference AS conference, home_classification AS classification, conference_game, completed AS done, true AS home, CASE WHEN completed THEN (home_points > away_points)::INT ELSE said END::DOUBLE AS p FROM g
  UNION ALL SELECT id, season, model_version, projection_date, away_team, home_team, away_conference, away_classification, conference_game, completed, false, CASE WHEN completed THEN (away_points > home_points)::INT ELSE 1 - said END::DOUBLE FROM g),
rt AS (SELECT team, arg_max(r, (start_date, game_id)) AS rating FROM (SELECT home_team AS team, home_postgame_elo AS r, start_date, game_id FROM {{house_elo_game}} UNION ALL SELECT away_team, away_postgame_elo, start_date, game_id FROM {{house_elo_game}}) GROUP BY team),
a AS (SELECT season, s.team, model_version, projection_date, max(conference) AS conference, max(classification) AS classification, count(*) AS games_scheduled, count(p) AS games_simulated, count(*) FILTER (done) AS games_completed, coalesce(sum(p) FILTER (done), 0)::BIGINT AS actual_wins,
  coalesce(list(p ORDER BY p) FILTER (NOT done AND p IS NOT NULL), []::DOUBLE[]) AS probs, avg(rating) AS sos_rating FROM s LEFT JOIN rt ON rt.team = opp GROUP BY season, s.team, model_version, projection_date HAVING count(p) > 0),
u AS (SELECT season, model_version, projection_date, conference, games_scheduled AS usual FROM a GROUP BY season, model_version, projection_date, conference, games_scheduled QUALIFY row_number() OVER (PARTITION BY season, model_version, projection_date, conference ORDER BY count(*) DESC, games_scheduled DESC) = 1),
b AS (SELECT a.*, CASE WHEN count(*) OVER (PARTITION BY season, model_version, projection_date, conference) >= {COHORT} THEN least(greatest(usual, {_DIV} - 1), {_DIV}) ELSE {_DIV} - 1 END AS expected,
  list_reduce(list_transform(probs, lambda x: [x]), lambda d, x: list_transform(range(1, len(d) + 2), lambda i: coalesce(d[i], 0) * (1 - x[1]) + coalesce(d[i - 1], 0) * x[1]), [1.0::DOUBLE]) AS dist FROM a JOIN u USING (season, model_version, projection_date, conference)),
cs AS (SELECT season, model_version, projection_date, conference, team, count(*) AS n, coalesce(sum(p) FILTER (done), 0) AS won FROM s WHERE conference_game AND p IS NOT NULL GROUP BY ALL),
dw AS (SELECT season, model_version, projection_date, team, k, count(*) FILTER (CASE WHEN home THEN x < p ELSE x >= 1 - p END) AS drawn FROM (SELECT s.*, k, ('0x' || substr(md5(id || ':' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS x FROM s, (SELECT unnest(range({REPLICATES})) AS k) WHERE conference_game AND p IS NOT NULL AND NOT done) GROUP BY ALL),
sh AS (SELECT cs.*, kk.k, round((won + coalesce(drawn, 0)) / n, {DECIMALS}) AS share FROM cs CROSS JOIN (SELECT unnest(range({REPLICATES})) AS k) kk LEFT JOIN dw ON dw.season = cs.season AND dw.model_version = cs.model_version AND dw.projection_date = cs.projection_date AND dw.team = cs.team AND dw.k = kk.k),
tt AS (SELECT season, model_version, projection_date, team, avg(v) AS conf_title_prob FROM (SELECT *, (share = top)::INT / sum((share = top)::INT) OVER w AS v, count(*) OVER w AS m FROM (SELECT *, max(share) OVER (PARTITION BY season, model_version, projection_date, conference, k) AS top FROM sh) WINDOW w AS (PARTITION BY season, model_version, projection_date, conference, k)) WHERE m >= 2 GROUP BY ALL),
r AS (SELECT b.*, rank() OVER (PARTITION BY season, model_version, projection_date ORDER BY round(sos_rating, {DECIMALS}) DESC NULLS LAST) AS rk FROM b)
SELECT season, team, model_version, projection_date, conference, games_scheduled, games_simulated, games_completed, actual_wins, games_scheduled >= expected AS schedule_complete,
  actual_wins + coalesce(list_sum(probs), 0) AS projected_wins, games_simulated - (actual_wins + coalesce(list_sum(probs), 0)) AS projected_losses, {', '.join(f'{_AT(p)} AS {n}' for n, p in (('wins_p10', 0.1), ('wins_p25', 0.25), ('median_wins', 0.5), ('wins_p75', 0.75), ('wins_p90', 0.9)))},
  CASE WHEN classification = 'fbs' THEN {_cut(BOWL)} END AS p_bowl_eligible, {_cut(GREAT)} AS p_ten_plus, sos_rating, CASE WHEN sos_rating IS NOT NULL THEN rk END AS sos_rank, conf_title_prob, CASE WHEN conf_title_prob IS NOT NULL THEN {REPLICATES} END AS n_sims,
  classification, games_scheduled - games_simulated AS games_unscored, games_simulated > games_completed AS is_projection, len(dist) AS outcomes
FROM r LEFT JOIN tt USING (season, model_version, projection_date, team) QUALIFY row_number() OVER (PARTITION BY season, team, model_version ORDER BY projection_date DESC) = 1"""
