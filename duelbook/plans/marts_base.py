"""Marts, first part: seasons, plays, drives, pairs of sides, classes, coaches, styles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import avg_if, bucket, count_if, contains, down_situation, enough, floor_bucket, is_garbage_time, play_category, ratio, score_state, share, share_if
from ..operators.frames import islands, latest_per_key, unpivot_sides
from ..sources.store import mart

NOT_PLAYS = ["Timeout", "End Period", "End of Half", "End of Game", "Kickoff", "Kickoff Return (Offense)"]


def _flag(cond):
    return F.when(cond, 1).otherwise(0).cast("long")


def team_rows(games: DataFrame) -> DataFrame:
    """Completed contests, one row for each side."""
    return unpivot_sides(games.filter("completed"))


@mart(by="season")
def team_season_summary(t) -> DataFrame:
    """K01."""
    same = F.col("conference") == F.col("opp_conference")
    won, lost = F.col("points") > F.col("opp_points"), F.col("points") < F.col("opp_points")
    record = team_rows(t["games"]).groupBy("season", "team").agg(
        F.max("conference").alias("conference"), F.count(F.lit(1)).alias("games"), count_if(won).alias("wins"), count_if(lost).alias("losses"),
        count_if(same & won).alias("conf_wins"), count_if(same & lost).alias("conf_losses"),
        F.avg("points").alias("ppg"), F.avg("opp_points").alias("opp_ppg"), F.avg(F.col("points") - F.col("opp_points")).alias("avg_margin"),
    )
    parts = {
        "sp_ratings": {"rating": "sp_rating", "ranking": "sp_rank", "offense_rating": "sp_offense", "defense_rating": "sp_defense"},
        "elo_ratings": {"elo": "elo"}, "fpi_ratings": {"fpi": "fpi"}, "core_ratings": {"overall": "core_overall", "offense": "core_offense", "defense": "core_defense"},
        "team_recruiting": {"rank": "recruiting_rank", "points": "recruiting_points"},
    }
    for name, columns in parts.items():
        record = record.join(t[name].select("team", F.col("year").alias("season"), *[F.col(a).alias(b) for a, b in columns.items()]), ["team", "season"], "left")
    return record


@mart(by="game")
def game_epa(t) -> DataFrame:
    """K02."""
    live = ~is_garbage_time()
    return t["plays"].filter("ppa IS NOT NULL").groupBy("game_id", F.col("offense").alias("team")).agg(
        avg_if("ppa", live).alias("epa_per_play"), share_if(F.col("ppa") > 0, live).alias("success_rate"), avg_if("ppa", live & (F.col("ppa") > 0)).alias("explosiveness"),
        count_if(live).alias("plays_non_garbage"), F.count(F.lit(1)).alias("plays_total"),
    )


@mart("game_epa", by="season")
def team_epa_season(t) -> DataFrame:
    """Means of means at twelve decimals, so that neither a value nor its tier depends on the order of a sum."""
    tier = floor_bucket(F.round("epa_per_play", 9), [(0.16, "elite"), (0.05, "above_avg"), (-0.05, "average"), (-0.15, "below_avg")], "struggling")
    return game_epa(t).join(t["games"].select(F.col("id").alias("game_id"), "season"), "game_id").groupBy("team", "season").agg(
        F.round(F.avg("epa_per_play"), 12).alias("epa_per_play"), F.avg("success_rate").alias("success_rate"), F.avg("explosiveness").alias("explosiveness"),
        F.sum("plays_non_garbage").alias("total_plays"), F.count(F.lit(1)).alias("games_played"),
    ).withColumn("epa_tier", tier)


@mart(by="season")
def situational_splits(t) -> DataFrame:
    """One pass over the plays, all splits as conditional aggregates."""
    live, ppa, good = ~is_garbage_time(), F.col("ppa"), F.col("ppa") > 0
    passing = ((F.col("down") == 2) & (F.col("distance") >= 8)) | ((F.col("down") == 3) & (F.col("distance") >= 5))
    zone = F.when(F.col("yards_to_goal") <= 20, "red_zone").when(F.col("yards_to_goal") <= 40, "scoring_position").when(F.col("yards_to_goal") >= 80, "backed_up").otherwise("between_20s")
    rows = t["plays"].filter("ppa IS NOT NULL").join(t["games"].select(F.col("id").alias("game_id"), F.col("season").alias("game_season")), "game_id")
    rows = rows.select(
        F.col("offense").alias("team"), F.col("game_season").alias("season"), "ppa", "down", live.alias("live"), passing.alias("passing"), zone.alias("zone"), down_situation().alias("situation"), play_category().alias("kind"),
        ((F.col("period") == 4) & (F.abs(F.coalesce("score_diff", F.lit(0))) <= 8)).alias("close"), (F.col("period").isin(2, 4) & (F.coalesce("clock_minutes", F.lit(0)) < 2)).alias("hurry"),
    )
    live, ppa, good = F.col("live"), F.col("ppa"), F.col("ppa") > 0
    out = [count_if(live).alias("total_plays"), avg_if(ppa, live).alias("epa_per_play"), share_if(good, live).alias("success_rate")]
    for n, label in ((1, "first"), (2, "second"), (3, "third")):
        out += [avg_if(ppa, live & (F.col("down") == n)).alias(f"{label}_down_epa"), share_if(good, live & (F.col("down") == n)).alias(f"{label}_down_success")]
    out += [count_if(live & (F.col("down") == 3)).alias("third_down_attempts")]
    out += [share_if(good, live & (F.col("situation") == s)).alias(f"{s}_success") for s in ("third_short", "third_medium", "third_long")]
    for label, cond in (("standard_down", ~F.col("passing")), ("passing_down", F.col("passing"))):
        out += [avg_if(ppa, live & cond).alias(f"{label}_epa"), share_if(good, live & cond).alias(f"{label}_success")]
    red = live & (F.col("zone") == "red_zone")
    out += [count_if(red).alias("red_zone_plays"), avg_if(ppa, red).alias("red_zone_epa"), share_if(good, red).alias("red_zone_success")]
    out += [avg_if(ppa, live & (F.col("zone") == z)).alias(f"{z}_epa") for z in ("backed_up", "scoring_position")]
    close, hurry = live & F.col("close"), live & F.col("hurry")
    out += [count_if(close).alias("late_close_plays"), avg_if(ppa, close).alias("late_close_epa"), share_if(good, close).alias("late_close_success"), count_if(hurry).alias("two_minute_plays"), avg_if(ppa, hurry).alias("two_minute_epa")]
    for k in ("rush", "pass"):
        one = live & (F.col("kind") == k)
        out += [count_if(one).alias(f"{k}_plays"), avg_if(ppa, one).alias(f"{k}_epa"), share_if(good, one).alias(f"{k}_success")]
    return rows.groupBy("team", "season").agg(*out).withColumn("rush_rate", ratio("rush_plays", F.col("rush_plays") + F.col("pass_plays")))


@mart(by="season")
def defensive_havoc(t) -> DataFrame:
    """Counts from play texts, and official rates whose columns come in two types."""
    live, kind = ~is_garbage_time(), F.col("play_type")
    run = contains(kind, "rush", "run")
    none = F.coalesce("yards_gained", F.lit(0))
    plays = t["plays"].filter("defense IS NOT NULL").groupBy(F.col("defense").alias("team"), "season").agg(
        count_if(live).alias("defensive_plays"), avg_if("ppa", live).alias("opp_epa_per_play"), share_if(F.col("ppa") > 0, live).alias("opp_success_rate"),
        count_if(live & contains(kind, "sack")).alias("sacks"), count_if(live & contains(kind, "interception")).alias("interceptions"), count_if(live & contains(kind, "fumble")).alias("fumbles"),
        count_if(live & run & (none <= 0)).alias("stuffs"), ratio(count_if(live & run & (none <= 0)), count_if(live & run)).alias("stuff_rate"), count_if(live & (none < 0)).alias("tfls"),
    ).withColumn("turnovers_forced", F.col("interceptions") + F.col("fumbles"))
    total = F.coalesce(F.col("total_havoc").cast("double"), F.col("total_havoc_v_double"))
    official = t["game_havoc"].groupBy("team", "season").agg(
        F.sum(total).alias("havoc_plays"), ratio(F.sum(total), F.sum("total_plays")).alias("havoc_rate"), ratio(F.sum("front_seven_havoc"), F.sum("total_plays")).alias("front_seven_havoc_rate"),
        ratio(F.sum("db_havoc"), F.sum("total_plays")).alias("db_havoc_rate"),
    )
    return plays.join(official, ["team", "season"], "left")


TD, FG = ["TD", "Touchdown"], ["FG", "Field Goal"]
LOST = ["INT", "FUMBLE", "Interception", "Fumble", "Fumble Lost", "Interception Return"]


@mart(by="season")
def scoring_opportunities(t) -> DataFrame:
    """K06."""
    result, n = F.col("drive_result"), F.count(F.lit(1))
    near = F.col("start_yards_to_goal") <= 20
    score = result.isin(TD + FG)
    return t["drives"].filter("offense IS NOT NULL").groupBy(F.col("offense").alias("team"), "season").agg(
        n.alias("total_drives"), count_if(score).alias("scoring_drives"), share(score).alias("scoring_rate"), count_if(result.isin(TD)).alias("td_drives"), share(result.isin(TD)).alias("td_rate"),
        ratio(count_if(result.isin(TD)) * 7 + count_if(result.isin(FG)) * 3, n).alias("points_per_drive"), count_if(result.isin(LOST)).alias("turnover_drives"), share(result.isin(LOST)).alias("turnover_rate"),
        count_if(result.isin("PUNT", "Punt")).alias("punt_drives"), share(result.isin("PUNT", "Punt")).alias("punt_rate"), F.avg("plays").alias("avg_plays_per_drive"), F.avg("yards").alias("avg_yards_per_drive"),
        F.avg("elapsed_minutes").alias("avg_time_per_drive"), count_if(near).alias("red_zone_drives"), count_if(near & score).alias("red_zone_scores"),
        ratio(count_if(near & score), count_if(near)).alias("red_zone_scoring_rate"), ratio(count_if(near & result.isin(TD)), count_if(near)).alias("red_zone_td_rate"),
    )


@mart()
def matchup_history(t, recent_from: int = 2015) -> DataFrame:
    """Unordered pairs. The last winner's date ties are broken by game id."""
    rows = t["games"].filter("completed AND home_points IS NOT NULL AND away_points IS NOT NULL")
    one, two = F.least("home_team", "away_team"), F.greatest("home_team", "away_team")
    own = F.when(F.col("home_team") == one, F.col("home_points")).otherwise(F.col("away_points"))
    other = F.when(F.col("home_team") == one, F.col("away_points")).otherwise(F.col("home_points"))
    rows = rows.select(one.alias("team1"), two.alias("team2"), "season", "start_date", "id", own.alias("a"), other.alias("b"))
    a, b, recent = F.col("a"), F.col("b"), F.col("season") >= recent_from
    winner = F.when(a > b, F.col("team1")).when(b > a, F.col("team2"))
    return rows.groupBy("team1", "team2").agg(
        F.count(F.lit(1)).alias("total_games"), count_if(a > b).alias("team1_wins"), count_if(b > a).alias("team2_wins"), count_if(a == b).alias("ties"),
        F.min("season").alias("first_meeting_year"), F.max("season").alias("last_meeting_year"), F.min("start_date").alias("first_meeting_date"), F.max("start_date").alias("last_meeting_date"),
        F.avg(F.abs(a - b)).alias("avg_margin"), F.max(F.abs(a - b)).alias("largest_margin"), F.avg(a - b).alias("team1_avg_margin"), F.sum(a).alias("team1_total_points"), F.sum(b).alias("team2_total_points"),
        count_if(recent & (a > b)).alias("team1_wins_recent"), count_if(recent & (b > a)).alias("team2_wins_recent"), count_if(recent).alias("games_recent"),
        F.max_by(F.struct(winner.alias("w")), F.struct("start_date", "id"))["w"].alias("last_winner"),
    )


GROUPS = {"qb": ["QB"], "rb": ["RB", "FB", "APB"], "receiver": ["WR", "TE"], "oline": ["OT", "OG", "OC", "OL"], "dline": ["DE", "DT", "DL", "EDGE", "SDE", "WDE"], "lb": ["ILB", "OLB", "LB"], "db": ["CB", "S", "DB"], "specialist": ["K", "P", "LS"]}


@mart()
def recruiting_class(t) -> DataFrame:
    """K08. The most frequent position group's ties go to the first by name."""
    group = F.lit("ath")
    for name, positions in reversed(GROUPS.items()):
        group = F.when(F.col("position").isin(positions), name).otherwise(group)
    rows = t["recruits"].filter("committed_to IS NOT NULL").select(F.col("committed_to").alias("team"), "year", "stars", "rating", "ranking", group.alias("grp"))
    stars = F.col("stars")
    counts = [count_if(F.col("grp") == g).alias(f"{g}_commits") for g in ("qb", "rb", "receiver", "oline", "dline", "lb", "db")]
    out = rows.groupBy("team", "year").agg(
        F.count(F.lit(1)).alias("total_commits"), *[count_if(stars == n).alias(f"{w}_stars") for n, w in ((5, "five"), (4, "four"), (3, "three"), (2, "two"))],
        count_if(stars.isNull() | (stars < 2)).alias("unrated"), share(stars >= 4).alias("blue_chip_ratio"), F.avg("rating").alias("avg_rating"), F.max("rating").alias("top_rating"), F.min("ranking").alias("best_recruit_rank"), *counts,
    )
    top = latest_per_key(rows.groupBy("team", "year", "grp").count(), ["team", "year"], [F.col("count").desc(), F.col("grp")]).select("team", "year", F.col("grp").alias("top_position_group"))
    national = t["team_recruiting"].select("team", "year", F.col("rank").alias("national_rank"), F.col("points").alias("total_points"))
    return out.join(top, ["team", "year"], "left").join(national, ["team", "year"], "left")


def _spells(t) -> DataFrame:
    return t["coach_seasons"].filter("school IS NOT NULL").withColumn("coach_name", F.concat_ws(" ", "first_name", "last_name")).withColumnsRenamed({"school": "team", "year": "season"})


@mart()
def coach_record(t) -> DataFrame:
    """K09."""
    rows = _spells(t).groupBy("coach_name", "first_name", "last_name", "team").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.countDistinct("season").alias("seasons_at_team"), F.sum(F.col("games").cast("long")).alias("total_games"),
        F.sum("wins").alias("total_wins"), F.sum("losses").alias("total_losses"), F.sum(F.coalesce("ties", F.lit(0)).cast("long")).alias("total_ties"),
        F.min("preseason_rank").alias("best_preseason_rank"), F.min("postseason_rank").alias("best_postseason_rank"), F.avg("sp_overall").alias("avg_sp_rating"),
    )
    ranks = t["team_recruiting"].select("team", "year", "rank")
    on = (rows["team"] == ranks["team"]) & ranks["year"].between(rows["first_season"], rows["last_season"])
    mean = rows.join(ranks, on).groupBy("coach_name", rows["team"]).agg(F.avg("rank").alias("avg_recruiting_rank"))
    return rows.join(mean, ["coach_name", "team"], "left").withColumn("win_pct", ratio("total_wins", F.col("total_wins") + F.col("total_losses")))


@mart(by="season")
def play_epa(t) -> DataFrame:
    """K10."""
    return t["plays"].filter(F.col("ppa").isNotNull() & ~F.col("play_type").isin(NOT_PLAYS)).select(
        F.col("id").alias("play_id"), "game_id", "drive_id", "season", "offense", "defense", "down", "distance", "yards_to_goal", "yards_gained", "play_type", "scoring", "period", "score_diff", F.col("ppa").alias("epa"),
        _flag(F.col("ppa") > 0).alias("success"), _flag(F.col("ppa") > 0.5).alias("explosive"),
        F.when(F.col("down") == 1, "first").when(F.col("down") == 2, "second").when(F.col("down") == 3, "third").when(F.col("down") == 4, "fourth").alias("down_name"),
        bucket("distance", [(3, "short"), (7, "medium")], "long").alias("distance_bucket"),
        bucket("yards_to_goal", [(20, "red_zone"), (40, "opponent_territory"), (60, "midfield")], "own_territory").alias("field_position"),
        is_garbage_time().alias("is_garbage_time"), play_category().alias("play_category"),
    )


ROLES = {"Completion": "passing", "Incompletion": "passing", "Interception Thrown": "passing", "Sack Taken": "passing", "Rush": "rushing", "Reception": "receiving", "Target": "receiving"}


def player_game_rows(t, least_plays: int = 3) -> DataFrame:
    """Live part of K11: players' plays by role, from play-level statistics."""
    role = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    stats = t["play_stats"]
    who = stats.select("game_id", "play_id", "athlete_id", "team", role[F.col("stat_type")].alias("play_category")).filter("play_category IS NOT NULL").distinct()
    names = stats.groupBy("game_id", "athlete_id").agg(F.max("athlete_name").alias("player_name"))
    plays = play_epa(t).filter("NOT is_garbage_time").select("game_id", "play_id", "season", F.col("offense").alias("team"), "epa", "success", "explosive", "yards_gained")
    out = who.join(plays, ["game_id", "play_id", "team"]).groupBy("game_id", "season", "team", "athlete_id", "play_category").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("epa").alias("total_epa"), F.avg("epa").alias("epa_per_play"), F.avg("success").alias("success_rate"), F.sum("explosive").alias("explosive_plays"), F.sum("yards_gained").alias("total_yards")
    )
    return out.filter(F.col("plays") >= least_plays).join(names, ["game_id", "athlete_id"], "left")


@mart("play_epa", by="season")
def player_game_epa(t, history: DataFrame | None = None, horizon: int = 2018, least_plays: int = 3) -> DataFrame:
    """Stored history up to the horizon, live rows after it. Without stored rows all are live."""
    live = player_game_rows(t, least_plays)
    if history is None:
        return live
    return history.filter(F.col("season") <= horizon).unionByName(live.filter(F.col("season") > horizon))


@mart("player_game_epa", may_be_empty=True)
def player_season_epa(t, least_plays: int = 20) -> DataFrame:
    """K12."""
    out = player_game_epa(t).groupBy("season", "team", "athlete_id", "play_category").agg(
        F.max("player_name").alias("player_name"), F.countDistinct("game_id").alias("games"), F.sum("plays").alias("total_plays"), F.sum("total_epa").alias("total_epa"),
        ratio(F.sum("total_epa"), F.sum("plays")).alias("epa_per_play"), ratio(F.sum(F.col("plays") * F.col("success_rate")), F.sum("plays")).alias("success_rate"),
        F.sum("explosive_plays").alias("explosive_plays"), F.sum("total_yards").alias("total_yards"), ratio(F.sum("plays"), F.countDistinct("game_id")).alias("plays_per_game"),
    ).filter(F.col("total_plays") >= least_plays)
    # Sums in another order differ in their last bits: the rank looks at nine decimals.
    return out.withColumn("epa_rank", F.rank().over(Window.partitionBy("season", "play_category").orderBy(F.round("total_epa", 9).desc())))


def season_division(t) -> DataFrame:
    """(team, season, classification) from the contests played, else from the dimension."""
    return unpivot_sides(t["games"]).filter("classification IS NOT NULL").groupBy("team", "season").agg(F.max("classification").alias("classification"))


def distinct_schools(t) -> DataFrame:
    """The team dimension without repeated names: a known classification comes first."""
    return latest_per_key(t["teams"], ["school"], [F.col("classification").asc_nulls_last(), F.col("id")])


def _with_division(df: DataFrame, t) -> DataFrame:
    named = distinct_schools(t).select(F.col("school").alias("team"), F.col("classification").alias("_dim"))
    out = df.join(season_division(t), ["team", "season"], "left").join(named, "team", "left")
    return out.withColumn("division", F.coalesce("classification", "_dim")).drop("classification", "_dim")


def eras_of(t) -> DataFrame:
    return t["eras"]


@mart("team_season_summary", "defensive_havoc", "team_epa_season")
def team_season_trajectory(t) -> DataFrame:
    """K13. Ranks look at nine decimals."""
    record = team_season_summary(t).select("team", "season", "wins", "losses", "conf_wins", "conf_losses", "recruiting_rank", "recruiting_points")
    havoc = defensive_havoc(t).select("team", "season", "opp_epa_per_play")
    rows = _with_division(team_epa_season(t), t).join(record, ["team", "season"], "left").join(havoc, ["team", "season"], "left")
    group, own = Window.partitionBy("season", "division"), Window.partitionBy("team").orderBy("season")
    rows = rows.withColumn("off_epa_rank", F.rank().over(group.orderBy(F.round("epa_per_play", 9).desc_nulls_first()))).withColumn("def_epa_rank", F.rank().over(group.orderBy(F.coalesce(F.round("opp_epa_per_play", 9), F.lit(999.0)))))
    era = F.broadcast(t["eras"])  # four fixed rows
    first = rows.select("season").distinct().join(era, (F.col("season") >= era["start_year"]) & (F.col("season") <= F.coalesce(era["end_year"], F.lit(9999)))).groupBy("season").agg(F.min(F.struct("code", "name")).alias("e")).select("season", F.col("e.code").alias("era_code"), F.col("e.name").alias("era_name"))
    pct = ratio("wins", F.col("wins") + F.col("losses"))
    rows = rows.join(first, "season", "left").withColumn("win_pct", pct)
    before = lambda x: F.lag(x).over(own)
    return rows.select(
        "team", "season", "epa_per_play", "success_rate", "epa_tier", "total_plays", "games_played", "wins", "losses", "win_pct", "conf_wins", "conf_losses", "recruiting_rank", "recruiting_points", "off_epa_rank", "def_epa_rank", "era_code", "era_name",
        before("epa_per_play").alias("prev_epa"), (F.col("epa_per_play") - before("epa_per_play")).alias("epa_delta"), before("win_pct").alias("prev_win_pct"), (F.col("win_pct") - before("win_pct")).alias("win_pct_delta"),
        before("recruiting_rank").alias("prev_recruiting_rank"), (before("recruiting_rank") - F.col("recruiting_rank")).alias("recruiting_rank_improvement"),
    )


@mart("team_epa_season")
def conference_era_summary(t) -> DataFrame:
    """K14. A team counts once for each home contest, and a season in each era it falls in."""
    era = F.broadcast(t["eras"])  # four fixed rows
    # Home contests are counted first, so that seasons are joined, not single contests.
    homes = t["games"].filter("home_conference IS NOT NULL AND home_conference <> ''").groupBy(F.col("home_team").alias("team"), "season", F.col("home_conference").alias("conference")).agg(F.count(F.lit(1)).alias("n"))
    rows = team_epa_season(t).join(homes, ["team", "season"])
    rows = rows.join(era, (F.col("season") >= era["start_year"]) & (F.col("season") <= F.coalesce(era["end_year"], F.lit(9999))))
    mean = lambda x: ratio(F.sum(F.col(x) * F.col("n")), F.sum(F.when(F.col(x).isNotNull(), F.col("n"))))
    seasons = rows.groupBy(F.col("code").alias("era_code"), F.col("name").alias("era_name"), "season", "conference").agg(mean("epa_per_play").alias("epa"), mean("success_rate").alias("success"), F.countDistinct("team").alias("teams"))
    out = seasons.groupBy("era_code", "era_name", "conference").agg(
        F.countDistinct("season").alias("seasons"), F.avg("epa").alias("avg_epa"), F.avg("success").alias("avg_success_rate"), F.avg("teams").alias("avg_teams"), F.max("epa").alias("best_season_epa"), F.min("epa").alias("worst_season_epa")
    )
    return out.withColumn("era_rank", F.rank().over(Window.partitionBy("era_code").orderBy(F.round("avg_epa", 9).desc())))


@mart("play_epa", by="season")
def team_style_profile(t) -> DataFrame:
    """Offence and defence each in one aggregate."""
    plays = play_epa(t).filter("NOT is_garbage_time")
    rush, pass_, n = F.col("play_category") == "rush", F.col("play_category") == "pass", F.count(F.lit(1))
    attack = plays.groupBy("season", F.col("offense").alias("team")).agg(
        share(rush).alias("run_rate"), share(pass_).alias("pass_rate"), avg_if("epa", rush).alias("epa_rushing"), avg_if("epa", pass_).alias("epa_passing"),
        avg_if("success", rush).alias("rush_success_rate"), avg_if("success", pass_).alias("pass_success_rate"), ratio(n, F.countDistinct("game_id")).alias("plays_per_game"),
    )
    defence = plays.groupBy("season", F.col("defense").alias("team")).agg(avg_if("epa", rush).alias("def_epa_vs_run"), avg_if("epa", pass_).alias("def_epa_vs_pass"), F.avg("epa").alias("def_epa_allowed"))
    out = attack.join(defence, ["season", "team"], "left")
    a, b = F.round("def_epa_vs_run", 9), F.round("def_epa_vs_pass", 9)
    return out.withColumns({
        "tempo_category": floor_bucket("plays_per_game", [(75, "up_tempo"), (65, "balanced")], "slow"),
        "offensive_identity": F.when(F.col("run_rate") >= 0.55, "run_heavy").when(F.col("pass_rate") >= 0.55, "pass_heavy").otherwise("balanced"),
        "defensive_identity": F.when(a < b, "run_stopper").when(b < a, "pass_stopper").otherwise("balanced_defense"),
    })


@mart("team_style_profile", by="season")
def matchup_edges(t, first_season: int = 2014) -> DataFrame:
    """K16."""
    style = team_style_profile(t).select("season", "team", "run_rate", "pass_rate", "offensive_identity", "epa_rushing", "epa_passing", "tempo_category", "plays_per_game", "def_epa_vs_run", "def_epa_vs_pass")
    one = style.select("season", *[F.col(x).alias(f"a_{x}") for x in style.columns[1:]])
    two = style.select("season", *[F.col(x).alias(f"b_{x}") for x in style.columns[1:]])
    rows = t["games"].filter(F.col("completed") & (F.col("season") >= first_season)).select("season", F.col("id").alias("game_id"), F.col("home_team").alias("a_team"), F.col("away_team").alias("b_team"), F.col("home_points").alias("a_points"), F.col("away_points").alias("b_points"))
    rows = rows.join(one, ["season", "a_team"]).join(two, ["season", "b_team"])
    edge = {x + k: F.col(f"{x}_epa_{v}ing") - F.col(f"{y}_def_epa_vs_{w}") for x, y in ("ab", "ba") for k, v, w in (("_rush_edge", "rush", "run"), ("_pass_edge", "pass", "pass"))}
    net = edge["a_rush_edge"] * F.col("a_run_rate") + edge["a_pass_edge"] * F.col("a_pass_rate") - edge["b_rush_edge"] * F.col("b_run_rate") - edge["b_pass_edge"] * F.col("b_pass_rate")
    return rows.select(
        "season", "game_id", "a_team", "b_team", "a_points", "b_points", "a_run_rate", "b_run_rate", "a_offensive_identity", "b_offensive_identity", "a_tempo_category", "b_tempo_category", *[v.alias(k) for k, v in edge.items()],
        F.abs(F.col("a_plays_per_game") - F.col("b_plays_per_game")).alias("tempo_mismatch"), net.alias("net_edge_a"),
        F.when(F.col("a_points") > F.col("b_points"), "team_a").when(F.col("b_points") > F.col("a_points"), "team_b").otherwise("tie").alias("actual_winner"), (F.col("a_points") - F.col("b_points")).alias("actual_margin"),
    )


@mart()
def team_talent_composite(t, window: int = 5) -> DataFrame:
    """K17. The recruit join is an equality on the id with a residual year range."""
    roster, rec = t["rosters"].select(F.col("id").alias("athlete_id"), "team", F.col("year").alias("season")), t["recruits"].filter("athlete_id IS NOT NULL").select("athlete_id", F.col("year").alias("class_year"), "stars", "rating")
    met = roster.join(rec, (roster["athlete_id"] == rec["athlete_id"]) & rec["class_year"].between(F.col("season") - window, F.col("season")), "left")
    s, n = F.col("stars"), F.count(F.lit(1))
    talent = met.groupBy("team", "season").agg(
        n.alias("roster_size"), count_if(s == 5).alias("five_stars"), count_if(s == 4).alias("four_stars"), count_if(s == 3).alias("three_stars"), count_if((s <= 2) | s.isNull()).alias("low_stars"),
        share(s >= 4).alias("blue_chip_ratio"), F.avg("rating").alias("avg_recruit_rating"),
    )
    moved = t["transfer_portal"].filter("destination IS NOT NULL").groupBy(F.col("destination").alias("team"), "season").agg(F.count(F.lit(1)).alias("transfers_in"), F.avg("stars").alias("avg_transfer_stars"))
    points = F.col("five_stars") * 5 + F.col("four_stars") * 4 + F.col("three_stars") * 3 + F.col("low_stars") * 2
    return talent.join(moved, ["team", "season"], "left").withColumn("transfers_in", F.coalesce("transfers_in", F.lit(0))).withColumn("talent_score", ratio(points, "roster_size"))


@mart("team_epa_season", by="season")
def team_tempo_metrics(t, least_games: int = 5, first_season: int = 2014) -> DataFrame:
    """K19."""
    plays = t["plays"].filter(~F.col("play_type").isin(NOT_PLAYS[:5]) & ~is_garbage_time() & (F.col("season") >= first_season))
    per_game = plays.groupBy("season", F.col("offense").alias("team"), "game_id").agg(F.count(F.lit(1)).alias("plays"))
    tempo = per_game.groupBy("season", "team").agg(F.countDistinct("game_id").alias("games"), F.sum("plays").alias("total_plays"), F.avg("plays").alias("plays_per_game")).filter(F.col("games") >= least_games)
    tempo = tempo.withColumn("tempo_tier", floor_bucket("plays_per_game", [(75, "up_tempo"), (65, "balanced")], "slow"))
    return tempo.join(team_epa_season(t).select("season", "team", "epa_per_play", "success_rate", "explosiveness"), ["season", "team"], "left")


CELL = ["team", "season", "down", "distance_bucket", "field_position", "score_diff_bucket"]


def _cells(t) -> DataFrame:
    return play_epa(t).filter("NOT is_garbage_time AND play_category IN ('rush', 'pass')").withColumn("score_diff_bucket", score_state()).withColumnRenamed("offense", "team")


@mart("play_epa", by="season")
def team_playcalling_tendencies(t) -> DataFrame:
    """K21."""
    rush, pass_ = F.col("play_category") == "rush", F.col("play_category") == "pass"
    return _cells(t).groupBy(*CELL).agg(F.count(F.lit(1)).alias("total_plays"), count_if(rush).alias("rush_plays"), count_if(pass_).alias("pass_plays"), share(rush).alias("run_rate"), share(pass_).alias("pass_rate"))


@mart("play_epa", by="season")
def team_situational_success(t, least: int = 10) -> DataFrame:
    """Rates of fewer than ``least`` plays are null."""
    n = F.count(F.lit(1))
    out = [n.alias("total_plays"), *[enough(F.avg(x), n, least).alias(y) for x, y in (("success", "success_rate"), ("epa", "avg_epa"), ("explosive", "explosive_rate"))]]
    for k in ("rush", "pass"):
        one = F.col("play_category") == k
        out += [enough(avg_if(x, one), count_if(one), least).alias(f"{k}_{y}") for x, y in (("success", "success_rate"), ("epa", "avg_epa"))]
    out.append(enough(share(F.col("yards_gained") >= F.col("distance")), n, least).alias("_made"))
    return _cells(t).groupBy(*CELL).agg(*out).withColumn("yardage_success_rate", F.when(F.col("down").isin(3, 4), F.col("_made"))).drop("_made")


@mart("team_season_summary", "recruiting_class")
def coaching_tenure(t) -> DataFrame:
    """Spells of a coach at a team, split where a season is missing."""
    key = ["coach_name", "first_name", "last_name", "team", "tenure_id"]
    rows = islands(_spells(t), ["first_name", "last_name", "team"], "season", name="tenure_id")
    zero = lambda x: F.sum(F.coalesce(F.col(x), F.lit(0)).cast("long"))
    spell = rows.groupBy(*key).agg(
        F.min("season").alias("tenure_start"), F.max("season").alias("tenure_end"), F.countDistinct("season").alias("seasons_count"), *[zero(x).alias(f"total_{x}") for x in ("games", "wins", "losses", "ties")],
        F.max("wins").alias("best_season_wins"), F.min("wins").alias("worst_season_wins"), F.min("preseason_rank").alias("best_preseason_rank"), F.min("postseason_rank").alias("best_postseason_rank"), F.avg("sp_overall").alias("avg_sp_rating"), F.max("sp_overall").alias("peak_sp_rating"),
    )
    # Sides first, then an equality on the team: no OR join.
    bowls = team_rows(t["games"]).filter("season_type = 'postseason'").groupBy("team", "season").agg(F.count(F.lit(1)).alias("bowl_games"), count_if(F.col("points") > F.col("opp_points")).alias("bowl_wins"))
    conf = team_season_summary(t).select("team", "season", "conf_wins", "conf_losses")
    ranks = recruiting_class(t).select("team", F.col("year").alias("season"), "national_rank")
    years = conf.join(bowls, ["team", "season"], "full").join(ranks, ["team", "season"], "full").withColumnsRenamed({"team": "_team", "season": "_season"})
    met = spell.join(years, (F.col("team") == F.col("_team")) & F.col("_season").between(F.col("tenure_start"), F.col("tenure_end")), "left")
    sums = met.groupBy(*key).agg(
        F.sum("conf_wins").alias("conf_wins"), F.sum("conf_losses").alias("conf_losses"), F.coalesce(F.sum("bowl_games"), F.lit(0)).alias("bowl_games"), F.coalesce(F.sum("bowl_wins"), F.lit(0)).alias("bowl_wins"),
        F.avg("national_rank").alias("avg_recruiting_rank"), F.min("national_rank").alias("best_recruiting_rank"), F.max(F.when(F.col("_season") == F.col("tenure_start"), F.col("national_rank"))).alias("inherited_talent_rank"),
    )
    third = ranks.select(F.col("team"), (F.col("season") - 2).alias("tenure_start"), F.col("national_rank").alias("_third"))
    last = t["coach_seasons"].agg(F.max("year").alias("_last"))
    out = spell.join(sums, key).join(third, ["team", "tenure_start"], "left").crossJoin(F.broadcast(last))  # one row
    third_rank = F.when(F.col("seasons_count") >= 3, F.col("_third"))
    return out.withColumns({
        "win_pct": ratio("total_wins", F.col("total_wins") + F.col("total_losses")), "conf_win_pct": ratio("conf_wins", F.col("conf_wins") + F.col("conf_losses")), "year3_talent_rank": third_rank,
        "talent_improvement": F.col("inherited_talent_rank") - third_rank, "is_active": F.col("tenure_end") >= F.col("_last") - 1,
    }).drop("_third", "_last")
