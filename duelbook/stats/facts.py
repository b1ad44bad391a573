"""Facts of finished contests, told apart by a fingerprint of their inputs, so that a later run makes those of changed contests only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import STATE_SECONDS_SQL, live_win_probability
from ..plans import marts_base as mb
from ..plans import marts_more as mm
from ..plans import serve as sv
from ..sources import io

#: The first season with facts, top plays of a contest, decimals of probabilities.
FIRST_SEASON, TOP, DECIMALS = 2014, 5, 4
#: Whose statistic leads a category.
LEADS = {"passing": "Completion", "rushing": "Rush", "receiving": "Reception"}
#: The columns that facts are made of, by table: a change in any of them changes the fingerprint, one in other columns does not.
INPUTS = {
    "games": ["id", "season", "week", "home_team", "away_team", "home_points", "away_points", "excitement_index"],
    "plays": ["game_id", "id", "play_number", "period", "clock_minutes", "clock_seconds", "offense", "defense", "ppa", "play_type", "play_text", "score_diff"],
    "play_stats": ["game_id", "play_id", "athlete_id", "athlete_name", "stat_type", "team"],
    "lines": ["game_id", "provider", "spread", "over_under"],
}


def finished(games: DataFrame, first: int = FIRST_SEASON) -> DataFrame:
    return games.filter(F.col("completed") & (F.col("season") >= first) & (F.col("home_classification") == "fbs"))


def fingerprints(t, games: DataFrame) -> DataFrame:
    """(game_id, input_hash) of the contests: SHA-256 over the number of rows and the sum of row hashes of each input table.

    Sums do not depend on the order of rows and are made before the shuffle: of the plays one row a contest and task moves. Every
    value goes into the hash as text after its length, null as a mark of its own, so that neither order nor type of columns matters.
    """
    told = lambda c: F.coalesce(F.concat_ws(":", F.length(F.col(c).cast("string")).cast("string"), F.col(c).cast("string")), F.lit("-"))
    parts = []
    for table, columns in INPUTS.items():
        key = columns[0]
        row = F.xxhash64(F.concat(*[told(c) for c in sorted(columns)]))
        rows = games if table == "games" else t[table]
        parts.append(rows.groupBy(F.col(key).alias("game_id")).agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(20,0)")).alias("h")).withColumn("part", F.lit(table)))
    each = reduce(DataFrame.unionByName, parts).groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("part", "n", "h"))).alias("p"))
    # A contest that is not asked for has no part of its own table.
    return each.filter(F.exists("p", lambda x: x["part"] == "games")).select("game_id", F.sha2(F.array_join(F.transform("p", lambda x: F.concat_ws(":", x["part"], x["n"].cast("string"), x["h"].cast("string"))), "|"), 256).alias("input_hash"))


def _quarters(points: Column, key: Column) -> Column:
    """Four quarters, and the sum of extra periods: null where there are none."""
    s = sv.line_scores(points, key)
    extra = F.aggregate(F.slice(s, 5, F.greatest(F.size(s) - 4, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.struct(*[F.get(s, F.lit(i)).alias(f"q{i + 1}") for i in range(4)], F.when(F.size(s) > 4, extra).alias("ot"))


def best_of(rows: Column, none: Column, most: int) -> Column:
    """The ``most`` first structs of an array by their own order, by a fold from ``none`` that holds no more than those: no sort of all."""
    return F.aggregate(rows, none, lambda best, x: F.slice(F.array_sort(F.concat(best, F.array(x))), 1, most))


def swings(rows: DataFrame, path: Column) -> DataFrame:
    """Adds ``swing``: of the probabilities in order of plays the largest step, least, most, and how often the favourite changes; null for
    fewer than two. A step from or to exactly a half changes nothing.

    Path and steps are columns of their own, as functions of arrays would be worked out anew at each mention.
    """
    n = F.size("_path")
    steps = F.zip_with(F.slice("_path", 1, F.greatest(n - 1, F.lit(0))), F.slice("_path", 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(F.abs(b - a).alias("d"), ((a != 0.5) & (b != 0.5) & ((a > 0.5) != (b > 0.5))).cast("long").alias("x")))
    value = F.struct(
        F.round(F.array_max("_steps")["d"], DECIMALS).alias("max_swing"), F.round(F.array_min("_path"), DECIMALS).alias("min_wp"), F.round(F.array_max("_path"), DECIMALS).alias("max_wp"),
        F.aggregate("_steps", F.lit(0).cast("long"), lambda a, s: a + s["x"]).alias("lead_changes"),
    )
    return rows.withColumn("_path", path).withColumn("_steps", steps).withColumn("swing", F.when(n >= 2, value)).drop("_path", "_steps")


def play_facts(plays: DataFrame) -> DataFrame:
    """(game_id, top, states): a contest's plays of most value either way, and its states in order; one aggregate, one shuffle of the plays."""
    valued = F.col("ppa").isNotNull() & ~F.col("play_type").isin(mb.NOT_PLAYS)
    play = F.struct((-F.abs("ppa")).alias("key"), F.col("id").alias("play_id"), F.col("ppa").alias("epa"), "period", "offense", "defense", "play_text")
    state = F.struct("play_number", "id", F.col("score_diff").cast("double").alias("margin"), F.expr(STATE_SECONDS_SQL).alias("seconds"))
    none = F.array().cast(plays.select(F.array(play).alias("a")).schema["a"].dataType)
    out = plays.groupBy("game_id").agg(F.collect_list(F.when(valued, play)).alias("_v"), F.collect_list(F.when(F.col("score_diff").isNotNull(), state)).alias("_s"))
    return out.select("game_id", best_of(F.col("_v"), none, TOP).alias("top"), F.array_sort("_s").alias("states"))


def leaders(stats: DataFrame) -> DataFrame:
    """(game_id, one struct a category): who has most of its statistic, ties by the athlete's key."""
    counts = stats.filter(F.col("stat_type").isin(*LEADS.values())).groupBy("game_id", "stat_type", "team", "athlete_id", "athlete_name").agg(F.count(F.lit(1)).alias("stat"))
    who, order = F.struct(F.col("athlete_name").alias("player_name"), "team", "stat"), F.struct((-F.col("stat")).alias("s"), "athlete_id", "team")
    return counts.groupBy("game_id").agg(*[F.min_by(who, F.when(F.col("stat_type") == kind, order)).alias(name) for name, kind in LEADS.items()])


def game_facts(t, games: DataFrame) -> DataFrame:
    """game_id, season, week, facts (nested), wp_available of each of the contests.

    The chance of the home side runs by the closed form from the line; contests without a line have none, and tell their largest
    value instead. Plays are read for the asked contests only and shuffled once; nothing is sorted but a contest's states.
    """
    asked = games.select(F.col("id").alias("game_id"))
    of = lambda name: t[name].join(asked, "game_id", "left_semi")
    line = mm.best_line(of("lines")).select("game_id", "spread", "over_under")
    rows = games.withColumnRenamed("id", "game_id").join(line, "game_id", "left").join(play_facts(of("plays")), "game_id", "left").join(leaders(of("play_stats")), "game_id", "left")
    path = F.transform("states", lambda s: live_win_probability(s["margin"], -F.col("spread"), s["seconds"]))
    rows = swings(rows, F.when(F.col("spread").isNotNull(), path)).withColumn("top", F.coalesce("top", F.array()))
    swing, first = F.col("swing"), F.try_element_at("top", F.lit(1))
    known = swing.isNotNull()
    section = F.struct(known.alias("available"), *[swing[c].alias(c) for c in ("max_swing", "min_wp", "max_wp", "lead_changes")], F.when(~known, first["epa"]).alias("largest_epa_play_epa"), F.when(~known, first["period"]).alias("largest_epa_play_period"))
    total, margin = F.col("home_points") + F.col("away_points"), F.col("home_points") - F.col("away_points")
    rows = rows.withColumn("_margin", margin).withColumns({"spread_result": sv.cover_result("_margin", "spread"), "ou_result": F.when(total > F.col("over_under"), "over").when(total < F.col("over_under"), "under").when(total == F.col("over_under"), "push")})
    plays = F.transform("top", lambda p: F.struct(*[p[c].alias(c) for c in ("play_id", "epa", "period", "offense", "defense", "play_text")]))
    facts = F.struct(
        "game_id", "season", "week", "home_team", "away_team", "home_points", "away_points", *[_quarters(F.col(f"{s}_points"), F.col("game_id")).alias(f"{s}_quarters") for s in ("home", "away")],
        plays.alias("top_plays"), section.alias("wp_swing"), F.struct(*LEADS).alias("leaders"), "spread", "spread_result", "over_under", "ou_result", "excitement_index",
    )
    return rows.select("game_id", "season", "week", facts.alias("facts"), known.alias("wp_available"))


def due(games: DataFrame, hashes: DataFrame, stored: DataFrame, most: int | None = None) -> DataFrame:
    """Contests without stored facts, with facts of other inputs, or marked ``regenerate``, with their input_hash; the latest ``most``, if given."""
    same = stored.filter("facts IS NOT NULL AND NOT coalesce(regenerate, false)").select("game_id", "input_hash")
    rows = games.withColumnRenamed("id", "game_id").join(hashes.join(same, ["game_id", "input_hash"], "left_anti"), "game_id").withColumnRenamed("game_id", "id")
    return rows if most is None else rows.orderBy(F.col("season").desc(), F.col("week").desc(), F.col("start_date").desc_nulls_last(), F.col("id").desc()).limit(most)


STORED = "game_id long, season long, week long, facts {facts}, wp_available boolean, input_hash string, regenerate boolean"


def refresh_facts(t, path: str, season: int | None = None, most: int | None = None) -> DataFrame:
    """Brings the table of facts at ``path`` (by season) up to date and returns the rows that this run made, none if no input changed;
    they can be read until the next run.

    A first pass reads fingerprints only; facts are then made of due contests. Their rows are written beside the table before
    they are merged by contest, so that neither a lost executor nor a lost run leaves half of them in the table.
    """
    spark = t.spark
    games = finished(t["games"])
    games = games if season is None else games.filter(F.col("season") == season)
    kind = game_facts(t, games).schema["facts"].dataType.simpleString()
    files, maker = io.files_of(spark, path)
    there = files.exists(maker(path))
    stored = spark.read.schema(STORED.format(facts=kind)).parquet(path) if there else spark.createDataFrame([], STORED.format(facts=kind))
    todo = due(games, fingerprints(t, games), stored, most)
    todo.write.mode("overwrite").parquet(path + ".due")
    todo = spark.read.parquet(path + ".due")
    made = game_facts(t, todo).join(todo.select(F.col("id").alias("game_id"), "input_hash"), "game_id").withColumn("regenerate", F.lit(False))
    made.write.mode("overwrite").parquet(path + ".made")
    made = spark.read.parquet(path + ".made")
    if not made.isEmpty():
        io.write_merge(made, path, ["game_id"], partition="season")
    return made


def served_facts(stored: DataFrame) -> DataFrame:
    """Of the stored contests those that have facts, without what tells how they came about."""
    return stored.filter("facts IS NOT NULL").select("game_id", "season", "week", "facts", "wp_available")


def flat(rows: DataFrame) -> DataFrame:
    """Facts as plain columns, plays by key."""
    f = lambda c: F.col(f"facts.{c}")
    plain = ["game_id", "season", "week", "home_team", "away_team", "home_points", "away_points", "spread", "spread_result", "over_under", "ou_result", "excitement_index"]
    quarters = [f(f"{s}_quarters.{q}").alias(f"{s}_{q}") for s in ("home", "away") for q in ("q1", "q2", "q3", "q4", "ot")]
    swing = [f(f"wp_swing.{c}").alias(c) for c in ("max_swing", "min_wp", "max_wp", "lead_changes", "largest_epa_play_epa", "largest_epa_play_period")]
    lead = [f(f"leaders.{c}.{x}").alias(f"{c}_{x}") for c in LEADS for x in ("player_name", "team", "stat")]
    return rows.select(*[f(c).alias(c) for c in plain], *quarters, F.array_join(F.transform(f("top_plays"), lambda p: p["play_id"]), ",").alias("top_plays"), *swing, *lead, "wp_available")


def facts_of_contests(t) -> DataFrame:
    """M32 as a query."""
    return flat(game_facts(t, finished(t["games"])))


def ledger_of_contests(t) -> DataFrame:
    """L19 as a query, over a ledger where all finished contests have a row but only those of the first division have facts."""
    made = game_facts(t, finished(t["games"])).select("game_id", "facts", "wp_available")
    rows = t["games"].filter("completed").select(F.col("id").alias("game_id"), "season", "week").join(made, "game_id", "left")
    return served_facts(rows).select("game_id", "season", "week", "wp_available", F.col("facts.home_points").alias("home_points"), F.col("facts.away_points").alias("away_points"), F.size("facts.top_plays").cast("long").alias("n_top_plays"))
