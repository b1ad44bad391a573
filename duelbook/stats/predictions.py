"""Baseline predictions of contests: ratings with carry-over, a blend with fitted play values, the market's line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import carry_over, win_expectancy
from ..operators.frames import latest_per_key
from . import jobs

#: The seed and yearly keep of ratings, what a home side gets, rating points a point of margin, plays a contest, weights of the blend.
SEED, KEEP, HOME, DIVISOR, PLAYS, BLEND = 1500.0, 2 / 3, 65.0, 22.0, 68, (0.6, 0.4)


def resolve_rating(sides: DataFrame, snapshot: DataFrame) -> DataFrame:
    """M8: adds ``rating`` to rows of (team, season) from a snapshot of (team, rating, snapshot_season), one row a team.

    A rating of an earlier season is pulled towards the seed once for each season since; a team without one gets the seed.
    """
    known = snapshot.select("team", F.col("rating").alias("_rating"), "snapshot_season")
    since = F.greatest(F.col("season") - F.col("snapshot_season"), F.lit(0))
    rating = F.coalesce(carry_over("_rating", SEED, F.pow(F.lit(KEEP), since)), F.lit(SEED))
    return sides.join(known, "team", "left").withColumn("rating", rating).drop("_rating", "snapshot_season")


def coefs_in_force(coefs: DataFrame, lookback: int) -> DataFrame:
    """Fits of (team, season), each also standing for up to ``lookback`` later seasons that have no later fit."""
    valid = coefs.withColumn("valid", F.explode(F.sequence(F.col("season"), F.col("season") + lookback)))
    best = valid.groupBy("team", "valid").agg(F.max_by(F.struct("off_coef", "def_coef", "hfa"), "season").alias("fit"))
    return best.select("team", F.col("valid").alias("season"), "fit")


def _margins(neutral: Column) -> tuple[Column, Column]:
    """Rating difference with the home side's bonus, and the margin of fitted values (null unless both sides have a fit)."""
    diff = F.col("home_rating") - F.col("away_rating") + F.when(neutral, 0.0).otherwise(HOME)
    home, away = F.col("home_fit"), F.col("away_fit")
    # Fitted defence is value allowed: the lower, the better.
    edge = (home["off_coef"] + away["def_coef"]) - (away["off_coef"] + home["def_coef"]) + F.when(neutral, 0.0).otherwise(home["hfa"])
    return diff, edge * PLAYS


def baseline_predictions(games: DataFrame, snapshot: DataFrame, coefs: DataFrame, market: DataFrame, lookback: int = 1) -> DataFrame:
    """M7: two rows a contest, by ratings alone and blended with fitted values where both sides have a fit.

    ``games``: game_id, season, home_team, away_team, neutral_site; ``market``: game_id, provider, spread, one row a contest at most.
    The win probability is that of the ratings in both rows. Edge and pick are null without a line.
    """
    fits, neutral = coefs_in_force(coefs, lookback), F.coalesce("neutral_site", F.lit(False))
    rows = games
    for side in ("home", "away"):
        team = f"{side}_team"
        rated = resolve_rating(rows.withColumn("team", F.col(team)), snapshot).withColumnRenamed("rating", f"{side}_rating")
        rows = rated.join(fits.withColumnRenamed("fit", f"{side}_fit"), ["team", "season"], "left").drop("team")
    diff, fitted = _margins(neutral)
    rows = rows.join(market.select("game_id", F.col("provider").alias("market_provider"), F.col("spread").alias("market_spread")), "game_id", "left")
    rows = rows.withColumns({"rating_margin": diff / DIVISOR, "home_win_prob": win_expectancy(diff), "fitted": fitted})
    blended = F.coalesce(BLEND[0] * F.col("rating_margin") + BLEND[1] * F.col("fitted"), F.col("rating_margin"))
    models = F.array(
        F.struct(F.lit("rating").alias("model_version"), F.lit(None).cast("double").alias("fitted_margin"), F.col("rating_margin").alias("expected_margin")),
        F.struct(F.lit("blend").alias("model_version"), F.col("fitted").alias("fitted_margin"), blended.alias("expected_margin")),
    )
    out = rows.withColumn("m", F.explode(models)).withColumn("edge", F.col("m.expected_margin") + F.col("market_spread"))
    pick = F.when(F.col("edge") >= 0, "home").when(F.col("edge") < 0, "away").alias("edge_pick")
    return out.select("game_id", "season", "home_team", "away_team", "home_rating", "away_rating", "rating_margin", "home_win_prob", "market_provider", "market_spread", "m.*", "edge", pick)


def pending(t) -> DataFrame:
    """Contests not yet played, from the latest season with a played one on."""
    last = t["games"].filter("completed").agg(F.max("season").alias("last"))
    games = t["games"].filter(~F.coalesce("completed", F.lit(False))).crossJoin(F.broadcast(last)).filter(F.col("season") >= F.coalesce("last", F.lit(0)))
    return games.select(F.col("id").alias("game_id"), "season", "home_team", "away_team", "neutral_site")


def rating_snapshot(t) -> DataFrame:
    """Last rating of each team with its season: K34's history, latest contest first."""
    rows = t["house_elo_game"]
    parts = [rows.select(F.col(f"{s}_team").alias("team"), F.col(f"{s}_postgame_elo").alias("rating"), F.col("season").alias("snapshot_season"), "start_date", "game_id") for s in ("home", "away")]
    last = F.max_by(F.struct("rating", "snapshot_season"), F.struct("start_date", "game_id"))
    return parts[0].unionByName(parts[1]).groupBy("team").agg(last.alias("l")).select("team", "l.*")


def market_lines(t) -> DataFrame:
    """One line a contest: the consensus, else the first provider by name."""
    return latest_per_key(t["lines"].select("game_id", "provider", "spread"), ["game_id"], [F.col("provider") != "consensus", F.col("provider")])


def predictions_of_pending(t) -> DataFrame:
    """M7 over the contests to come, with M1's fits."""
    return baseline_predictions(pending(t), rating_snapshot(t), jobs.two_way_ridge(jobs.ridge_plays(t)), market_lines(t))


def ratings_of_sides(t) -> DataFrame:
    """M8 over all contests' sides: ratings carried on from the last season but one, as a season's start would see them."""
    last = t["games"].agg(F.max("season").alias("last"))
    earlier = t["house_elo_game"].crossJoin(F.broadcast(last)).filter(F.col("season") < F.col("last")).drop("last")
    sides = t["games"].select(F.col("id").alias("game_id"), "season", F.explode(F.array("home_team", "away_team")).alias("team"))
    return resolve_rating(sides, rating_snapshot({"house_elo_game": earlier}))
