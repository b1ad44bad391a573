"""Serving views and parameterised lookups: plain functions of the tables that return DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import all_of, avg_if, bucket, count_if, matched, optional, ratio, share, trigram_similarity
from ..operators.frames import latest_per_key, percent_ranks, unpivot_sides
from . import marts_base as mb
from . import marts_more as mm

OPS = {"eq": lambda c, v: c == v, "gte": lambda c, v: c >= v, "lte": lambda c, v: c <= v, "in": lambda c, v: c.isin(list(v))}


def serve(mart: DataFrame, columns: list[str] | None = None, filters: list[tuple[str, str, object]] = (), order: list[Column] = (), limit: int | None = None) -> DataFrame:
    """Projection, eq / gte / lte / in filters, order and limit over any mart."""
    out = mart.filter(all_of(*[OPS[op](F.col(c), v) for c, op, v in filters]))
    out = out.select(*columns) if columns else out
    out = out.orderBy(*order) if order else out
    return out if limit is None else out.limit(limit)


def _rank(partition, order):
    return F.rank().over(Window.partitionBy(*partition).orderBy(order))


def team_detail(t) -> DataFrame:
    """Dimension and the latest season's rows."""
    season = mb.team_season_summary(t).groupBy(F.col("team").alias("school")).agg(F.max_by(F.struct("season", "wins", "losses", "sp_rating"), "season").alias("s"))
    epa = mb.team_epa_season(t).groupBy(F.col("team").alias("school")).agg(F.max_by(F.struct("epa_per_play", "epa_tier"), "season").alias("e"))
    return mb.distinct_schools(t).select("id", "school", "mascot", "abbreviation", "conference", "color").join(season, "school", "left").join(epa, "school", "left").select("id", "school", "mascot", "abbreviation", "conference", "color", "s.*", "e.*")


def team_history(t, team: str | None = None) -> DataFrame:
    """L02."""
    epa = mb.team_epa_season(t).select("team", "season", "epa_per_play", "success_rate", "epa_tier")
    return mb.team_season_summary(t).filter(all_of(optional("team", team))).join(epa, ["team", "season"], "left")


def cover_result(margin, spread) -> Column:
    """home, away or push against the spread (negative: the home side gives points)."""
    v = F.col(margin) + F.col(spread)
    return F.when(v > 0, "home").when(v < 0, "away").when(v == 0, "push")


def game_detail(t) -> DataFrame:
    """Best line, cover, over or under, and both sides' metrics."""
    line = mm.best_line(t["lines"]).select(F.col("game_id").alias("id"), "provider", "spread", "over_under")
    epa = mb.game_epa(t).select(F.col("game_id").alias("id"), "team", "epa_per_play", "success_rate")
    side = lambda s: epa.withColumnsRenamed({"team": f"{s}_team", "epa_per_play": f"{s}_epa", "success_rate": f"{s}_success"})
    rows = t["games"].select("id", "season", "week", "start_date", "home_team", "away_team", "home_points", "away_points", "completed").join(line, "id", "left").join(side("home"), ["id", "home_team"], "left").join(side("away"), ["id", "away_team"], "left")
    total = F.col("home_points") + F.col("away_points")
    done = F.col("completed")
    return rows.withColumn("margin", F.col("home_points") - F.col("away_points")).withColumns({"cover": F.when(done, cover_result("margin", "spread")), "total_result": F.when(done, F.when(total > F.col("over_under"), "over").when(total < F.col("over_under"), "under").when(total == F.col("over_under"), "push"))}).withColumnRenamed("id", "game_id")


def matchup(t, recent: int = 5) -> DataFrame:
    """Pair summary with an array of the last results, newest first."""
    rows = t["games"].filter("completed").select(F.least("home_team", "away_team").alias("team1"), F.greatest("home_team", "away_team").alias("team2"), "start_date", F.col("id").alias("game_id"), "home_team", "home_points", "away_points")
    rn = F.row_number().over(Window.partitionBy("team1", "team2").orderBy(F.col("start_date").desc(), F.col("game_id").desc()))
    last = rows.withColumn("n", rn).filter(F.col("n") <= recent).groupBy("team1", "team2").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "game_id"))), lambda x: x["game_id"]).alias("recent_games"))
    return mb.matchup_history(t).select("team1", "team2", "total_games", "team1_wins", "team2_wins", "ties", "last_winner").join(last, ["team1", "team2"])


def leaderboard_teams(t) -> DataFrame:
    """The season's division is the mode of the contests played; ranks inside it."""
    division = unpivot_sides(t["games"]).filter("classification IS NOT NULL").groupBy("team", "season", "classification").count()
    division = latest_per_key(division, ["team", "season"], [F.col("count").desc(), F.col("classification")]).select("team", "season", F.col("classification").alias("division"))
    rows = mb.team_season_summary(t).select("team", "season", "wins", "losses", "ppg", "sp_rating").join(mb.team_epa_season(t).select("team", "season", "epa_per_play"), ["team", "season"], "left").join(division, ["team", "season"], "left")
    rank = {"wins_rank": F.col("wins").desc_nulls_last(), "ppg_rank": F.round("ppg", 9).desc_nulls_last(), "sp_rank": F.col("sp_rating").desc_nulls_last(), "epa_rank": F.round("epa_per_play", 9).desc_nulls_last()}
    return rows.withColumns({k: _rank(["season", "division"], o) for k, o in rank.items()})


def roster_lookup(t, team: str | None = None, year: int | None = None) -> DataFrame:
    """L06."""
    return t["rosters"].filter(all_of(optional("team", team), optional("year", year))).select("id", F.concat_ws(" ", "first_name", "last_name").alias("name"), "team", "year", "position", "height", "weight", "jersey")


LEADERS = {"passing": ["pass_yds", "pass_td", "pass_int"], "rushing": ["rush_car", "rush_yds", "rush_td"], "receiving": ["rec", "rec_yds", "rec_td"], "defensive": ["tackles", "sacks", "tfl"]}
LEAD_BY = {"passing": "pass_yds", "rushing": "rush_yds", "receiving": "rec_yds", "defensive": "tackles"}


def player_season_leaders(t, season: int | None = None, category: str | None = None, conference: str | None = None, limit: int | None = None) -> DataFrame:
    """Four pivots of one scan, padded to one shape and ranked by the category's own metric."""
    stats = t["player_season_stats"].filter(all_of(optional("season", season), optional("conference", conference)))
    parts = []
    for k, names in LEADERS.items():
        if category in (None, k):
            one = mm.pivot_stats(stats.filter(F.col("category") == k), ["player_id", "player", "team", "conference", "season"], {n: mm.PLAYER_STATS[n] for n in names}).withColumn("category", F.lit(k))
            parts.append(one.withColumn("leader_rank", _rank(["season"], F.col(LEAD_BY[k]).desc_nulls_last())))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out if limit is None else out.orderBy("leader_rank", "player_id").limit(limit)


def player_detail(t, player_id: str | None = None) -> DataFrame:
    """Latest roster row, all categories of its latest season, recruit."""
    roster = t["rosters"].filter(all_of(optional("id", player_id)))
    roster = latest_per_key(roster, ["id"], [F.col("year").desc(), F.col("team"), F.col("last_name")]).select(F.col("id").alias("player_id"), "first_name", "last_name", "team", "position")
    stats = mm.pivot_stats(t["player_season_stats"].filter(all_of(optional("player_id", player_id))), ["player_id", "season"], mm.PLAYER_STATS)
    last = latest_per_key(stats, ["player_id"], [F.col("season").desc()])
    recruit = latest_per_key(t["recruits"].filter("athlete_id IS NOT NULL"), ["athlete_id"], [F.col("rating").desc_nulls_last(), F.col("id")]).select(F.col("athlete_id").alias("player_id"), "stars", "ranking")
    return roster.join(last, "player_id", "left").join(recruit, "player_id", "left")


def player_season_detail(t, player_id: str, season: int | None = None) -> DataFrame:
    """One player's comparison row of a season (the latest without one), with the three categories' adjusted values."""
    rows = mm.player_comparison(t).filter((F.col("player_id") == player_id) & all_of(optional("season", season)))
    of = lambda column, k: F.max(F.when(F.col("category") == k, F.col(column)))
    values = mm.player_wepa_season(t).filter(F.col("athlete_id") == player_id).groupBy(F.col("athlete_id").alias("player_id"), "season")
    values = values.agg(of("wepa", "passing").alias("wepa_passing"), of("wepa", "rushing").alias("wepa_rushing"), of("paar", "kicking").alias("paar"))
    own = ["player_id", "name", "team", "position", "season", "jersey", "height", "weight", "stars", "recruit_rating", "national_ranking", "recruit_class"]
    stats = [k for k in mm.PLAYER_STATS if k not in ("fgm", "fga")]
    return rows.join(values, ["player_id", "season"], "left").select(*own, *stats, "wepa_passing", "wepa_rushing", "paar").orderBy(F.col("season").desc(), "team").limit(1)


def nested_games(t) -> DataFrame:
    """Box scores as the loader gets them: sides in a contest, categories in a side, entries in a category."""
    rows = t["play_stats"].groupBy("game_id", "team", "stat_type", "athlete_id", "athlete_name").agg(F.count(F.lit(1)).alias("stat"))
    rows = rows.groupBy("game_id", "team", "stat_type").agg(F.sort_array(F.collect_list(F.struct(F.col("athlete_id").alias("id"), F.col("athlete_name").alias("name"), F.col("stat").cast("string").alias("stat")))).alias("athletes"))
    rows = rows.groupBy("game_id", "team").agg(F.sort_array(F.collect_list(F.struct(F.col("stat_type").alias("name"), "athletes"))).alias("types"))
    return rows.groupBy(F.col("game_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("team", "types"))).alias("teams"))


def game_player_leaders(t) -> DataFrame:
    """Nested box scores laid flat, level by level; empty levels keep their row."""
    a = nested_games(t).select(F.col("id").alias("game_id"), F.explode_outer("teams").alias("s")).select("game_id", "s.team", F.explode_outer("s.types").alias("k"))
    return a.select("game_id", "team", F.col("k.name").alias("stat_type"), F.explode_outer("k.athletes").alias("p")).select("game_id", "team", "stat_type", F.col("p.id").alias("athlete_id"), F.col("p.name").alias("athlete_name"), F.col("p.stat").cast("long").alias("stat"))


def game_box_score(t) -> DataFrame:
    """Three levels: contest, side, statistic."""
    rows = unpivot_sides(t["games"]).select("id", "team", "side", F.array(F.struct(F.lit("points").alias("category"), F.col("points").cast("string").alias("stat")), F.struct(F.lit("allowed").alias("category"), F.col("opp_points").cast("string").alias("stat"))).alias("stats"))
    nested = rows.groupBy("id").agg(F.collect_list(F.struct("team", "side", "stats")).alias("teams"))
    return nested.select(F.col("id").alias("game_id"), F.explode_outer("teams").alias("s")).select("game_id", "s.team", "s.side", F.explode_outer("s.stats").alias("x")).select("game_id", "team", "side", "x.category", "x.stat")


def line_scores(points: Column, key: Column) -> Column:
    """A side's points split over four quarters and, for some contests, an extra period."""
    q = F.floor(points / 5).cast("long")
    rest = points - q * 3
    return F.when(key % 9 == 0, F.array(q, q, q, rest - q, q)).otherwise(F.array(q, q, q, rest))


def game_line_scores(t) -> DataFrame:
    """Quarters by index, extra periods as the sum of the tail."""
    rows = t["games"].select(F.col("id").alias("game_id"), *[line_scores(F.col(f"{s}_points"), F.col("id")).alias(s) for s in ("home", "away")])
    out = [F.get(s, F.lit(i)).alias(f"{s}_q{i + 1}") for s in ("home", "away") for i in range(4)]
    tail = [F.aggregate(F.slice(s, 5, F.greatest(F.size(s) - 4, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x).alias(f"{s}_ot") for s in ("home", "away")]
    return rows.select("game_id", *out, *tail)


def team_playcalling_profile(t) -> DataFrame:
    """Rates by situation, weighted success, percentiles in the season."""
    p = F.col("total_plays")
    early, late = F.col("down") <= 2, F.col("down") >= 3
    run = lambda cond: ratio(F.sum(F.when(cond, F.col("rush_plays"))), F.sum(F.when(cond, p)))
    calls = mb.team_playcalling_tendencies(t).groupBy("team", "season").agg(F.sum(p).alias("plays"), run(F.lit(True)).alias("run_rate"), run(early).alias("early_down_run_rate"), run(late).alias("late_down_run_rate"), run(F.col("field_position") == "red_zone").alias("red_zone_run_rate"), run(F.col("score_diff_bucket") == "big_lead").alias("big_lead_run_rate"))
    w = F.when(F.col("success_rate").isNotNull(), p)
    good = mb.team_situational_success(t).groupBy("team", "season").agg(ratio(F.sum(F.col("success_rate") * p), F.sum(w)).alias("weighted_success"))
    return percent_ranks(calls.join(good, ["team", "season"], "left"), ["season"], {"plays": "plays_pctl"}, "last", mask=True)


def line_movement(t) -> DataFrame:
    """Captures in order, what changed, and the number of captures since the last change."""
    w = Window.partitionBy("game_id").orderBy("captured_at", "event_id")
    rows = t["captures"].withColumns({"prev_points": F.lag("points").over(w), "same": F.when(F.lag("state_hash").over(w) == F.col("state_hash"), 1).otherwise(0)})
    rows = rows.withColumn("run", F.sum(1 - F.col("same")).over(w))
    streak = F.row_number().over(Window.partitionBy("game_id", "run").orderBy("captured_at", "event_id")) - 1
    return rows.select("game_id", "captured_at", "event_id", "points", (F.col("points") - F.col("prev_points")).alias("moved"), "run", streak.alias("unmoved_streak"))


def game_drives(t) -> DataFrame:
    """L14, drives."""
    return t["drives"].select("game_id", F.col("id").alias("drive_id"), "season", "offense", "defense", "drive_number", "plays", "yards", "drive_result", "start_yards_to_goal", "end_yards_to_goal", (F.col("start_yards_to_goal") - F.col("end_yards_to_goal")).alias("net_field"))


def game_plays(t) -> DataFrame:
    """L14, plays."""
    return t["plays"].select("game_id", F.col("id").alias("play_id"), "drive_id", "play_number", "period", "offense", "defense", "down", "distance", "yards_to_goal", "yards_gained", "play_type", "play_text", "ppa", "scoring")


def poll_rankings(t) -> DataFrame:
    """A poll's ranks have ties, so the school is part of the key."""
    return t["sp_ratings"].select(F.col("year").alias("season"), F.lit("regular").alias("season_type"), (F.col("ranking") % 15 + 1).alias("week"), F.lit("poll").alias("poll"), F.col("team").alias("school"), "conference", (F.col("ranking") % 25 + 1).alias("rank"))


def game_predictions(t) -> DataFrame:
    """L16."""
    return mm.latest_predictions(t, None).select("game_id", "model_version", "prediction_day", "expected_margin", "home_win_prob", "market_spread", "edge", "edge_pick", "completed")


def game_win_probability(t) -> DataFrame:
    """Play by play, the contest's prediction moved by the lead; the clock as text."""
    pre = mm.latest_predictions(t, None).filter("model_version = 'elo'").select("game_id", "home_win_prob")
    clock = F.format_string("%02d:%02d", F.col("clock_minutes"), F.col("clock_seconds"))
    return t["plays"].join(pre, "game_id", "left").select("game_id", F.col("id").cast("string").alias("play_id"), "season", "period", clock.alias("clock"), "down", "distance", "score_diff", F.coalesce("home_win_prob", F.lit(0.5)).alias("pregame_win_prob"))


def live_scoreboard(t, hours: int = 24) -> DataFrame:
    """The last capture of each contest inside the horizon before the newest one."""
    rows = t["captures"]
    newest = rows.agg(F.max("captured_at").alias("now"))
    recent = rows.crossJoin(F.broadcast(newest)).filter(F.col("captured_at") > F.col("now") - F.make_dt_interval(hours=F.lit(hours)))  # one row
    return latest_per_key(recent, ["game_id"], [F.col("captured_at").desc(), F.col("event_id").desc()]).select("game_id", "captured_at", "status", "points", "state_hash")


def coach_records(t) -> DataFrame:
    """Career totals with against-the-spread totals where they are known, and how many seasons that covers."""
    ats = t["team_ats"].select(F.col("team").alias("school"), "year", "ats_wins", "ats_losses")
    rows = t["coach_seasons"].join(ats, ["school", "year"], "left")
    return rows.groupBy("first_name", "last_name").agg(
        F.countDistinct("year").alias("seasons"), F.countDistinct("school").alias("schools"), F.sum("wins").alias("wins"), F.sum("losses").alias("losses"), F.sum("ats_wins").alias("ats_wins"), F.sum("ats_losses").alias("ats_losses"), F.count("ats_wins").alias("ats_seasons"),
        ratio(F.sum("ats_wins"), F.sum(F.col("ats_wins") + F.col("ats_losses"))).alias("ats_pct"),
    )


def expected_points_keys(t) -> DataFrame:
    """State keys as columns."""
    keys = t["plays"].select(F.concat_ws("|", F.concat(F.lit("d"), "down"), bucket("distance", [(3, "short"), (7, "medium")], "long"), F.concat(F.lit("z"), F.expr("(yards_to_goal + 9) div 10"))).alias("state")).groupBy("state").agg(F.count(F.lit(1)).alias("plays"))
    return keys.select("state", "plays", matched("state", r"^d(\d+)").cast("long").alias("down"), F.split_part("state", F.lit("|"), F.lit(2)).alias("distance_bucket"), matched("state", r"z(\d+)$").cast("long").alias("field_zone"))


def team_epa_public(t) -> DataFrame:
    """Ranks within the season's division; a missing defence value ranks last."""
    rows = mb._with_division(mb.team_epa_season(t), t).join(mb.defensive_havoc(t).select("team", "season", "opp_epa_per_play"), ["team", "season"], "left")
    return rows.select("team", "season", "division", "epa_per_play", "success_rate", "epa_tier", _rank(["season", "division"], F.round("epa_per_play", 9).desc_nulls_last()).alias("off_rank"), _rank(["season", "division"], F.coalesce(F.round("opp_epa_per_play", 9), F.lit(999.0))).alias("def_rank"))


def special_teams_sos(t) -> DataFrame:
    """Two sources, either of which may lack the row."""
    a, b = t["sp_ratings"].select("team", F.col("year").alias("season"), F.col("rating").alias("sp")), t["fpi_ratings"].select("team", F.col("year").alias("season"), "fpi")
    return a.join(b, ["team", "season"], "full")


def available_seasons(t) -> DataFrame:
    """All seasons, with the weeks of each."""
    return t["games"].groupBy("season").agg(F.array_join(F.sort_array(F.collect_set("week")), ",").alias("weeks"), F.countDistinct("week").alias("n_weeks"))


def _splits(rows: DataFrame, key: list) -> DataFrame:
    won = F.col("points") > F.col("opp_points")
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("games"), count_if(won).alias("wins"), count_if(F.col("points") < F.col("opp_points")).alias("losses"), share(won).alias("win_pct"), F.avg("points").alias("points_for"), F.avg("opp_points").alias("points_against"))


def home_away_splits(t, team: str, season: int) -> DataFrame:
    """L27."""
    return _splits(mb.team_rows(t.of_team(team, season)["games"]).filter(all_of(optional("team", team), optional("season", season))), ["side"])


def conference_splits(t, team: str, season: int) -> DataFrame:
    """Contests inside and outside the conference."""
    rows = mb.team_rows(t.of_team(team, season)["games"]).filter(all_of(optional("team", team), optional("season", season)))
    return _splits(rows.withColumn("kind", F.when(F.col("conference") == F.col("opp_conference"), "conference").otherwise("non_conference")), ["kind"])


def _side_plays(t, team: str, season: int) -> DataFrame:
    plays = mb.play_epa(t.of_team(team, season)).filter((F.col("season") == season) & ((F.col("offense") == team) | (F.col("defense") == team)))
    return plays.withColumn("side", F.when(F.col("offense") == team, "offense").otherwise("defense"))


_RATES = lambda: [F.count(F.lit(1)).alias("plays"), F.avg("epa").alias("epa_per_play"), F.avg("success").alias("success_rate"), F.avg("yards_gained").alias("yards_per_play")]


def down_distance_splits(t, team: str, season: int) -> DataFrame:
    """Both sides."""
    return _side_plays(t, team, season).groupBy("side", "down", "distance_bucket").agg(*_RATES())


def field_position_splits(t, team: str, season: int) -> DataFrame:
    """Zones as the side itself sees them, mirrored for the defence; in order from the own goal."""
    own = F.when(F.col("side") == "offense", F.col("yards_to_goal")).otherwise(100 - F.col("yards_to_goal"))
    zone = bucket("own", [(20, "red_zone"), (40, "opponent_territory"), (60, "midfield"), (80, "own_territory")], "backed_up")
    order = F.when(F.col("zone") == "backed_up", 1).when(F.col("zone") == "own_territory", 2).when(F.col("zone") == "midfield", 3).when(F.col("zone") == "opponent_territory", 4).otherwise(5)
    return _side_plays(t, team, season).withColumn("own", own).withColumn("zone", zone).groupBy("side", "zone").agg(*_RATES()).withColumn("zone_order", order)


def red_zone_splits(t, team: str, season: int) -> DataFrame:
    """Trips are drives with a play inside the 20."""
    trips = _side_plays(t, team, season).filter("yards_to_goal <= 20").select("side", "drive_id", "offense").distinct()
    drives = t.of_team(team, season)["drives"].select(F.col("id").alias("drive_id"), "offense", "drive_result")
    result = F.col("drive_result")
    return trips.join(drives, ["drive_id", "offense"], "left").groupBy("side").agg(F.count(F.lit(1)).alias("trips"), count_if(result.isin(mb.TD)).alias("touchdowns"), count_if(result.isin(mb.FG)).alias("field_goals"), share(result.isin(mb.TD)).alias("td_rate"), share(result.isin(mb.TD + mb.FG)).alias("score_rate"))


def player_season_stats_pivoted(t, team: str, season: int) -> DataFrame:
    """L32."""
    rows = t["player_season_stats"].filter(all_of(optional("team", team), optional("season", season)))
    return mm.pivot_stats(rows, ["player_id", "player", "position"], mm.PLAYER_STATS)


def trajectory_averages(t, conference: str, first: int, last: int) -> DataFrame:
    """A conference's seasons beside all sides'."""
    rows = mb.team_season_summary(t).select("team", "season", "conference", "wins").join(mb.team_epa_season(t).select("team", "season", "epa_per_play"), ["team", "season"]).filter(F.col("season").between(first, last))
    own = F.col("conference") == conference
    return rows.groupBy("season").agg(avg_if("wins", own).alias("conf_wins"), avg_if("epa_per_play", own).alias("conf_epa"), F.avg("wins").alias("all_wins"), F.avg("epa_per_play").alias("all_epa"))


def player_search(t, query: str, position: str | None = None, team: str | None = None, year: int | None = None, limit: int = 25, least: float = 0.3) -> DataFrame:
    """Names by trigram similarity; the optional filters come first, so that they prune the scan."""
    rows = t["rosters"].filter(all_of(optional("position", position), optional("team", team), optional("year", year))).withColumn("name", F.concat_ws(" ", "first_name", "last_name"))
    score = trigram_similarity("name", F.lit(query))
    return rows.select("id", "name", "team", "year", "position", score.alias("score")).filter(F.col("score") >= least).orderBy(F.col("score").desc(), "name", "id", "team", "year").limit(limit)


def conference_h2h(t, one: str, two: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The pair's record seen from the first conference asked for."""
    rows = mm.conference_head_to_head(t).filter(all_of(F.col("conference_1") == min(one, two), F.col("conference_2") == max(one, two), None if first is None else F.col("season") >= first, None if last is None else F.col("season") <= last))
    a, b, sign = ("conf1_wins", "conf2_wins", 1) if one < two else ("conf2_wins", "conf1_wins", -1)
    return rows.select("season", F.lit(one).alias("conference"), F.lit(two).alias("opponent"), "total_games", F.col(a).alias("wins"), F.col(b).alias("losses"), "ties", (F.col("avg_point_diff") * sign).alias("avg_point_diff"))


def stale_first(t) -> DataFrame:
    """L36."""
    return mm.freshness_of_events(t).orderBy(F.col("is_stale").desc(), F.col("days_since_activity").desc_nulls_first(), "table_name")


def drive_patterns(t, team: str, season: int, side: str = "offense") -> DataFrame:
    """Start and end in bins of ten yards, by outcome."""
    ten = lambda c: (F.floor(F.col(c) / 10) * 10).cast("long")
    return t.of_team(team, season)["drives"].filter((F.col(side) == team) & (F.col("season") == season)).groupBy(ten("start_yards_to_goal").alias("start_bin"), ten("end_yards_to_goal").alias("end_bin"), "drive_result").agg(F.count(F.lit(1)).alias("drives"), F.avg("plays").alias("avg_plays"), F.avg("yards").alias("avg_yards"))


def player_game_log(t, athlete: str, season: int) -> DataFrame:
    """Contest by contest, with result and opponent."""
    t = t.of_seasons([season])
    rows = mb.player_game_epa(t).filter((F.col("athlete_id") == athlete) & (F.col("season") == season))
    games = unpivot_sides(t["games"]).select(F.col("id").alias("game_id"), "team", "week", F.col("opp_team").alias("opponent"), "side", "points", "opp_points")
    return rows.join(games, ["game_id", "team"]).withColumn("result", F.when(F.col("points") > F.col("opp_points"), "W").when(F.col("points") < F.col("opp_points"), "L").otherwise("T")).select("game_id", "week", "team", "opponent", "side", "result", "play_category", "plays", "total_epa")


def player_percentiles(t, player: str) -> DataFrame:
    """L40."""
    rows = mm.player_comparison(t).filter(F.col("player_id") == player)
    return rows.select("player_id", "season", "position_group", *[c for c in rows.columns if c.endswith("_pctl")])


def recruiting_class_history(t, team: str) -> DataFrame:
    """L42."""
    return mb.recruiting_class(t).filter(F.col("team") == team).select("year", "national_rank", "total_points", "total_commits", "five_stars", "four_stars", "three_stars", "blue_chip_ratio")


def recruiting_roi_of(t, team: str) -> DataFrame:
    """L43."""
    return mm.recruiting_roi(t).filter(F.col("team") == team).select("season", "avg_class_rank_4yr", "blue_chip_ratio", "wins", "wins_over_expected", "players_drafted", "win_pct_pctl")


def team_portal_activity(t, team: str, season: int) -> DataFrame:
    """One nested row: who came, who went, counts; empty arrays, not nulls."""
    rows = t["transfer_portal"].filter((F.col("season") == season) & ((F.col("origin") == team) | (F.col("destination") == team)))
    who = F.struct(F.concat_ws(" ", "first_name", "last_name").alias("name"), "position", "stars")
    came, went = F.col("destination") == team, F.col("origin") == team
    return rows.agg(F.sort_array(F.collect_list(F.when(came, who))).alias("incoming"), F.sort_array(F.collect_list(F.when(went, who))).alias("outgoing"), count_if(came).alias("n_in"), count_if(went).alias("n_out"), avg_if("stars", came).alias("avg_stars_in"))


def team_signees(t, team: str, year: int) -> DataFrame:
    """L45."""
    return t["recruits"].filter((F.col("committed_to") == team) & (F.col("year") == year)).select("id", "name", "position", "stars", "rating", "ranking").orderBy(F.col("rating").desc_nulls_last(), "id")


def games_search(t, team: str | None = None, season: int | None = None, week: int | None = None, limit: int = 50) -> DataFrame:
    """Contests by optional side, season and week, newest first."""
    side = None if team is None else (F.col("home_team") == team) | (F.col("away_team") == team)
    return t["games"].filter(all_of(side, optional("season", season), optional("week", week))).select("id", "season", "week", "home_team", "away_team", "home_points", "away_points").orderBy(F.col("season").desc(), F.col("week").desc(), "id").limit(limit)
