"""Marts, second part: quality, players, talent and portal, conferences, ratings, predictions, penalties, analytics, scouting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import avg_if, count_if, matched, ratio, share
from ..operators.frames import latest_per_key, percent_ranks, range_join_years, unpivot_sides
from ..sources.store import mart
from . import marts_base as mb


def _rank(partition: list[str], order: Column) -> Column:
    return F.rank().over(Window.partitionBy(*partition).orderBy(order))


def data_quality_dashboard(t) -> DataFrame:
    """Coverage of each table, and rows whose contest is missing. One small aggregate a table."""
    year = {"games": "season", "plays": "season", "drives": "season", "player_season_stats": "season", "sp_ratings": "year", "recruits": "year", "rosters": "year"}
    text = lambda c: c.cast("string")
    out = None
    for name, col in year.items():
        row = t[name].agg(F.lit("coverage").alias("check_type"), F.lit(name).alias("metric"), text(F.min(col)).alias("value_1"), text(F.max(col)).alias("value_2"), text(F.count(F.lit(1))).alias("value_3"), F.lit(None).cast("string").alias("notes"))
        out = row if out is None else out.unionByName(row)
    games = t["games"].select(F.col("id").alias("game_id"), F.lit(1).alias("found"))
    for name in ("plays", "drives"):
        lost = count_if(F.col("found").isNull())
        row = t[name].join(games, "game_id", "left").agg(
            F.lit("integrity").alias("check_type"), F.lit(f"{name}_without_games").alias("metric"), text(lost).alias("value_1"), text(F.count(F.lit(1))).alias("value_2"),
            F.concat(text(F.coalesce(F.floor(ratio(lost * 100, F.count(F.lit(1)))), F.lit(0))), F.lit("%")).alias("value_3"), F.when(lost > 0, f"WARNING: orphan {name}").otherwise("OK").alias("notes"),
        )
        out = out.unionByName(row)
    return out


POSITION_GROUPS = {"QB": ["QB"], "RB": ["RB", "FB"], "WR": ["WR"], "TE": ["TE"], "OL": ["OL", "OT", "OG", "C"], "DL": ["DL", "DE", "DT", "NT", "EDGE"], "LB": ["LB", "OLB", "ILB"], "DB": ["DB", "CB", "S", "FS", "SS"], "K/P": ["K", "P"]}
PLAYER_STATS = {
    "pass_att": ("passing", "ATT"), "pass_cmp": ("passing", "COMPLETIONS"), "pass_yds": ("passing", "YDS"), "pass_td": ("passing", "TD"), "pass_int": ("passing", "INT"), "pass_pct": ("passing", "PCT"),
    "rush_car": ("rushing", "CAR"), "rush_yds": ("rushing", "YDS"), "rush_td": ("rushing", "TD"), "rush_ypc": ("rushing", "YPC"), "rec": ("receiving", "REC"), "rec_yds": ("receiving", "YDS"), "rec_td": ("receiving", "TD"), "rec_ypr": ("receiving", "YPR"),
    "tackles": ("defensive", "TOT"), "sacks": ("defensive", "SACKS"), "tfl": ("defensive", "TFL"), "pass_def": ("defensive", "PD"), "fgm": ("kicking", "FGM"), "fga": ("kicking", "FGA"),
}


def stat_value() -> Column:
    """The statistic, kept as text, as a number; an empty text is null."""
    return F.nullif(F.col("stat"), F.lit("")).cast("double")


def pivot_stats(stats: DataFrame, keys: list[str], wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Key-value statistics as columns, in one aggregate."""
    return stats.groupBy(*keys).agg(*[F.max(F.when((F.col("category") == a) & (F.col("stat_type") == b), stat_value())).alias(n) for n, (a, b) in wanted.items()])


def position_group() -> Column:
    out = F.lit(None).cast("string")
    for name, positions in POSITION_GROUPS.items():
        out = F.when(F.col("position").isin(positions), name).otherwise(out)
    return out


@mart()
def player_comparison(t) -> DataFrame:
    """Exact roster match, else any of that year's, only where the first missed; percentiles with nulls first."""
    wanted = {k: v for k, v in PLAYER_STATS.items() if k not in ("fgm", "fga")}
    rows = pivot_stats(t["player_season_stats"].withColumnRenamed("player", "name"), ["player_id", "name", "team", "position", "season"], wanted)
    roster = t["rosters"].select(F.col("id").cast("string").alias("player_id"), "team", F.col("year").alias("season"), "height", "weight", "jersey", "last_name")
    order = [F.col(x) for x in ("team", "last_name")]
    exact = latest_per_key(roster, ["player_id", "season", "team"], order[1:]).select("player_id", "team", "season", F.struct("height", "weight", "jersey").alias("one"))
    other = latest_per_key(roster, ["player_id", "season"], order).select("player_id", "season", F.struct("height", "weight", "jersey").alias("any"))
    recruit = latest_per_key(t["recruits"].filter("athlete_id IS NOT NULL"), ["athlete_id"], [F.col("rating").desc_nulls_last(), F.col("id")]).select(
        F.col("athlete_id").alias("player_id"), "stars", F.col("rating").alias("recruit_rating"), F.col("ranking").alias("national_ranking"), F.col("year").alias("recruit_class")
    )
    rows = rows.join(exact, ["player_id", "team", "season"], "left").join(other, ["player_id", "season"], "left").join(recruit, "player_id", "left").withColumn("position_group", position_group())
    found = F.when(F.col("one").isNotNull(), F.col("one")).otherwise(F.col("any"))
    rows = rows.select("*", *[found[x].alias(x) for x in ("height", "weight", "jersey")]).drop("one", "any")
    ranked = ("pass_yds", "pass_td", "rush_yds", "rush_td", "rec_yds", "rec_td", "tackles", "sacks", "tfl")
    out = percent_ranks(rows, ["season", "position_group"], {m: f"{m}_pctl" for m in ranked}, "first")
    return out.withColumns({f"{m}_pctl": F.when(F.col("position_group").isNotNull(), F.col(f"{m}_pctl")) for m in ranked})


@mart("team_season_summary", "recruiting_class", "team_epa_season")
def recruiting_roi(t) -> DataFrame:
    """Classes of the four years before, bucket medians, and what a side made of them."""
    record = mb.team_season_summary(t).select("team", "season", "conference", "games", "wins", "losses", "sp_rating", "sp_rank").withColumns({"first": F.col("season") - 4, "last": F.col("season") - 1})
    cls = mb.recruiting_class(t).select("team", "year", "national_rank", "total_points", "total_commits", (F.col("five_stars") + F.col("four_stars")).alias("blue"))
    rolling = range_join_years(record.select("team", "season", "first", "last"), cls, ["team"], "first", "last", "year").groupBy("team", "season").agg(
        F.avg("national_rank").alias("avg_class_rank_4yr"), F.avg("total_points").alias("avg_class_points_4yr"), F.sum("blue").alias("total_blue_chips_4yr"), ratio(F.sum("blue"), F.sum("total_commits")).alias("blue_chip_ratio"), F.count("year").alias("n")
    ).filter("n >= 2").drop("n")
    epa = mb.team_epa_season(t).select("team", "season", "epa_per_play", "success_rate")
    rank = F.col("avg_class_rank_4yr")
    rows = record.drop("first", "last").join(rolling, ["team", "season"]).join(epa, ["team", "season"], "left").withColumn("talent_bucket", F.when(rank <= 10, "elite").when(rank <= 25, "high").when(rank <= 50, "mid").otherwise("low"))
    median = rows.groupBy("season", "talent_bucket").agg(F.percentile("wins", 0.5).alias("expected_wins"), F.percentile("epa_per_play", 0.5).alias("expected_epa"))
    drafted = t["draft_picks"].filter("college_team IS NOT NULL").groupBy(F.col("college_team").alias("team"), F.col("year").alias("season")).agg(F.count(F.lit(1)).alias("players_drafted"), F.sum(F.greatest(260 - F.coalesce("overall", F.lit(260)), F.lit(0))).alias("draft_picks_value"))
    out = rows.join(median, ["season", "talent_bucket"]).join(drafted, ["team", "season"], "left").withColumns({
        "players_drafted": F.coalesce("players_drafted", F.lit(0)), "draft_picks_value": F.coalesce("draft_picks_value", F.lit(0)), "win_pct": ratio("wins", "games"),
        "wins_over_expected": F.col("wins") - F.col("expected_wins"), "epa_over_expected": F.col("epa_per_play") - F.col("expected_epa"), "recruiting_efficiency": ratio("wins", rank),
    }).drop("expected_wins", "expected_epa", "games")
    return percent_ranks(out, ["season"], {"win_pct": "win_pct_pctl", "recruiting_efficiency": "recruiting_efficiency_pctl"}, "last", mask=True)


@mart("team_season_summary")
def transfer_portal_impact(t) -> DataFrame:
    """K25."""
    moves = t["transfer_portal"]
    came = moves.filter("destination IS NOT NULL").groupBy(F.col("destination").alias("team"), "season").agg(F.count(F.lit(1)).alias("came"), F.avg("stars").alias("avg_incoming_stars"), F.avg("rating").alias("avg_incoming_rating"), count_if(F.col("stars") >= 4).alias("high"))
    left = moves.filter("origin IS NOT NULL").groupBy(F.col("origin").alias("team"), "season").agg(F.count(F.lit(1)).alias("went"))
    size = t["rosters"].groupBy("team", F.col("year").alias("season")).agg(F.count(F.lit(1)).alias("roster"))
    own = Window.partitionBy("team").orderBy("season")
    record = mb.team_season_summary(t).select("team", "season", "conference", F.col("wins").alias("current_wins"), F.col("sp_rating").alias("current_sp_rating"))
    record = record.withColumns({"prior_season_wins": F.lag("current_wins").over(own), "prior_season_sp_rating": F.lag("current_sp_rating").over(own)}).filter("prior_season_wins IS NOT NULL")
    rows = record.join(came, ["team", "season"], "left").join(left, ["team", "season"], "left").join(size, ["team", "season"], "left").filter("came IS NOT NULL OR went IS NOT NULL")
    n_in, n_out, delta = F.coalesce("came", F.lit(0)), F.coalesce("went", F.lit(0)), F.col("current_wins") - F.col("prior_season_wins")
    out = rows.select(
        "team", "season", "conference", n_in.alias("transfers_in"), n_out.alias("transfers_out"), (n_in - n_out).alias("net_transfers"), "avg_incoming_stars", "avg_incoming_rating", F.coalesce("high", F.lit(0)).alias("incoming_high_stars"),
        "prior_season_wins", "prior_season_sp_rating", "current_wins", "current_sp_rating", delta.alias("win_delta"), (F.col("current_sp_rating") - F.col("prior_season_sp_rating")).alias("sp_delta"), ratio(n_in, "roster").alias("portal_dependency"), ratio(delta, "came").alias("win_delta_per_transfer_in"),
    )
    return percent_ranks(out, ["season"], {"net_transfers": "net_transfers_pctl", "win_delta": "win_delta_pctl", "portal_dependency": "portal_dependency_pctl"}, "last", mask=True)


@mart("team_season_summary", "team_epa_season", "recruiting_class")
def conference_comparison(t, least_members: int = 4) -> DataFrame:
    """K26. Ties for the best and worst side go to the first by name."""
    member = latest_per_key(t["teams"].filter("conference IS NOT NULL"), ["school"], [F.col("classification").asc_nulls_last(), F.col("id")]).select(F.col("school").alias("team"), F.col("conference").alias("conf"))
    record = mb.team_season_summary(t).select("team", "season", "wins", "sp_rating", "sp_rank")
    epa = mb.team_epa_season(t).select("team", "season", "epa_per_play", "success_rate")
    cls = mb.recruiting_class(t).select("team", F.col("year").alias("season"), "national_rank", "blue_chip_ratio", (F.col("five_stars") + F.col("four_stars")).alias("blue"))
    rows = record.join(member, "team").join(epa, ["team", "season"], "left").join(cls, ["team", "season"], "left")
    sp = F.col("sp_rating")
    # A missing rating comes after all others, at either end.
    best = F.min(F.struct(sp.isNull().alias("n"), (-sp).alias("s"), "team"))["team"]
    worst = F.min(F.struct(sp.isNull().alias("n"), sp.alias("s"), "team"))["team"]
    out = rows.groupBy(F.col("conf").alias("conference"), "season").agg(
        F.countDistinct("team").alias("member_count"), F.avg("wins").alias("avg_wins"), F.avg(sp).alias("avg_sp_rating"), F.percentile(sp, 0.5).alias("median_sp_rating"), best.alias("best_team"), F.max(sp).alias("best_team_sp"), worst.alias("worst_team"), F.min(sp).alias("worst_team_sp"),
        F.stddev_samp(sp).alias("std_dev_sp"), F.avg("epa_per_play").alias("avg_epa_per_play"), F.avg("success_rate").alias("avg_success_rate"), F.avg("national_rank").alias("avg_recruiting_rank"), F.sum("blue").alias("total_blue_chips"), F.avg("blue_chip_ratio").alias("avg_blue_chip_ratio"),
        count_if(F.col("sp_rank") <= 25).alias("ranked_team_count"),
    ).filter(F.col("member_count") >= least_members)
    away = mb.team_rows(t["games"]).filter("conference <> opp_conference").groupBy("conference", "season").agg(share(F.col("points") > F.col("opp_points")).alias("non_conf_win_pct"))
    out = out.join(away, ["conference", "season"], "left")
    out = percent_ranks(out, ["season"], {"avg_sp_rating": "avg_sp_pctl", "non_conf_win_pct": "non_conf_win_pct_pctl"}, "last", mask=True)
    return percent_ranks(out, ["season"], {"avg_recruiting_rank": "avg_recruiting_pctl"}, "first", descending=True, mask=True)


@mart(by="season")
def conference_head_to_head(t) -> DataFrame:
    """Contests between conferences, seen from the first by name."""
    rows = mb.team_rows(t["games"]).filter("conference < opp_conference AND points IS NOT NULL AND opp_points IS NOT NULL")
    a, b = F.col("points"), F.col("opp_points")
    return rows.groupBy(F.col("conference").alias("conference_1"), F.col("opp_conference").alias("conference_2"), "season").agg(
        F.count(F.lit(1)).alias("total_games"), count_if(a > b).alias("conf1_wins"), count_if(b > a).alias("conf2_wins"), count_if(a == b).alias("ties"), share(a > b).alias("conf1_win_pct"), F.avg(a - b).alias("avg_point_diff")
    )


CADENCE_DAYS = {"weekly": 14, "seasonal": 90}
TRACKED = {"games": "weekly", "plays": "weekly", "drives": "weekly", "lines": "weekly", "teams": "static", "recruits": "seasonal", "rosters": "seasonal", "player_season_stats": "seasonal"}


def data_freshness(spark, ledger: DataFrame, now: Column, tracked: dict[str, str] = TRACKED) -> DataFrame:
    """From a load ledger (table_name, loaded_at, row_count), the last load of each tracked table and whether it is overdue."""
    names = spark.createDataFrame(list(tracked.items()), "table_name string, cadence string")
    last = ledger.groupBy("table_name").agg(F.max("loaded_at").alias("last_activity"), F.max_by("row_count", "loaded_at").alias("row_count"))
    days = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("last_activity").cast("timestamp"))) / 86400
    late = F.lit(False)
    for cadence, limit in CADENCE_DAYS.items():
        late = F.when(F.col("cadence") == cadence, F.col("last_activity").isNull() | (days > limit)).otherwise(late)
    return names.join(last, "table_name", "left").select("table_name", "cadence", F.coalesce("row_count", F.lit(0)).alias("row_count"), "last_activity", days.alias("days_since_activity"), late.alias("is_stale"))


def freshness_of_events(t) -> DataFrame:
    """K28 over the test tables: the events are taken for a ledger, an event type's tables by turn."""
    names = list(TRACKED)[:-1]
    ledger = t["events"].select(F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("user_id") % len(names) + 1).cast("int")).alias("table_name"), (F.col("ts") - F.make_dt_interval((F.col("user_id") % len(names)).cast("int") * 20)).alias("loaded_at"), F.col("event_id").alias("row_count"))
    ledger = latest_per_key(ledger, ["table_name"], [F.col("loaded_at").desc(), F.col("row_count")])
    return data_freshness(t.spark, ledger, F.lit("2024-02-01").cast("timestamp_ntz"))


def team_wepa_season(t) -> DataFrame:
    """K29."""
    return t["team_wepa"].select(
        F.col("year").alias("season"), "team", "conference", "epa", "epa_allowed", "success_rate", (F.col("epa") - F.col("epa_allowed")).alias("net_epa"), _rank(["year"], F.col("epa").desc_nulls_last()).alias("offense_rank"), _rank(["year"], F.col("epa_allowed").asc_nulls_last()).alias("defense_rank")
    )


def player_wepa_season(t) -> DataFrame:
    """Three categories of different columns, padded and ranked apart."""
    rows = t["player_wepa"]
    parts = [rows.filter(F.col("category") == k).select("athlete_id", "athlete_name", "team", F.col("year").alias("season"), "category", F.col("wepa").alias("paar" if k == "kicking" else "wepa"), F.col("plays").alias("attempts" if k == "kicking" else "plays")) for k in ("passing", "rushing", "kicking")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True)
    return out.withColumn("category_rank", _rank(["season", "category"], F.coalesce("wepa", "paar").desc_nulls_last()))


def returning_production(t) -> DataFrame:
    """An integer column and its double twin as one."""
    value = F.coalesce(F.col("total_ppa").cast("double"), F.col("total_ppa_v_double"))
    return t["returning_production"].select("season", "team", "conference", value.alias("total_ppa"), "percent_ppa", _rank(["season"], F.col("percent_ppa").desc_nulls_last()).alias("returning_rank"))


def player_usage(t) -> DataFrame:
    """K32."""
    return t["player_usage"].select("id", "season", "team", "name", F.coalesce(F.col("usage_overall").cast("double"), F.col("usage_overall_v_double")).alias("usage_overall"))


def team_ats_records(t) -> DataFrame:
    """Pushes do not count."""
    return t["team_ats"].select(F.col("year").alias("season"), "team", "conference", "games", "ats_wins", "ats_losses", "ats_pushes", ratio("ats_wins", F.col("ats_wins") + F.col("ats_losses")).alias("cover_pct"))


@mart()
def house_elo(t, least_games: int = 4) -> DataFrame:
    """The last rating of each side and season."""
    rows = unpivot_sides(t["house_elo_game"])
    order = [F.col("start_date").desc(), F.col("game_id").desc()]
    last = latest_per_key(rows, ["team", "season"], order).select("team", "season", F.col("postgame_elo").alias("elo"), F.col("start_date").alias("last_game"))
    n = rows.groupBy("team", "season").agg(F.count(F.lit(1)).alias("games"))
    return last.join(n, ["team", "season"]).withColumns({"elo_rank": _rank(["season"], F.col("elo").desc()), "low_confidence": F.col("games") < least_games})


@mart(by="season")
def house_elo_game(t) -> DataFrame:
    """K35."""
    return t["house_elo_game"].select("game_id", "season", "week", "season_type", "home_team", "away_team", "home_pregame_elo", "away_pregame_elo", "home_postgame_elo", "away_postgame_elo", "expected_home_margin", "actual_home_margin", (F.col("actual_home_margin") - F.col("expected_home_margin")).alias("margin_error"), F.abs(F.col("actual_home_margin") - F.col("expected_home_margin")).alias("abs_margin_error"))


def latest_predictions(t, completed: bool | None) -> DataFrame:
    """The last prediction of each contest and model; of finished, unfinished or all contests."""
    games = t["games"].select(F.col("id").alias("game_id"), "week", "home_team", "away_team", "home_points", "away_points", "start_date", F.coalesce("completed", F.lit(False)).alias("completed"))
    rows = latest_per_key(t["game_predictions"], ["game_id", "model_version"], [F.col("prediction_day").desc()]).join(games, "game_id")
    edge = F.col("expected_margin") + F.col("market_spread")
    rows = rows.withColumns({"edge": edge, "edge_pick": F.when(edge >= 0, "home").when(edge < 0, "away")})
    return rows if completed is None else rows.filter(F.col("completed") == completed)


@mart()
def scored_matchup_edges(t) -> DataFrame:
    """K37."""
    return latest_predictions(t, False).select("game_id", "season", "week", "start_date", "home_team", "away_team", "model_version", "prediction_day", "expected_margin", "home_win_prob", "market_spread", "edge", "edge_pick", F.abs("edge").alias("abs_edge"))


@mart()
def prediction_accuracy(t, thresholds: tuple[int, ...] = (0, 3, 6, 10)) -> DataFrame:
    """Each prediction counts under every threshold that its edge reaches."""
    rows = latest_predictions(t, True).withColumn("edge_threshold", F.explode(F.array(*[F.lit(x).cast("long") for x in thresholds])))
    rows = rows.filter((F.col("edge_threshold") == 0) | (F.abs("edge") >= F.col("edge_threshold")))
    margin = (F.col("home_points") - F.col("away_points")).cast("double")
    result = F.when(margin > 0, 1.0).when(margin == 0, 0.5).otherwise(0.0)
    market, cover = F.col("market_spread").isNotNull(), margin + F.col("market_spread")
    won = ((F.col("edge_pick") == "home") & (cover > 0)) | ((F.col("edge_pick") == "away") & (cover < 0))
    err = F.col("expected_margin") - margin
    out = rows.groupBy("model_version", "season", "edge_threshold").agg(
        F.count(F.lit(1)).alias("n_games"), count_if(market).alias("n_with_market"), F.avg(F.abs(err)).alias("margin_mae"), F.sqrt(F.avg(err * err)).alias("margin_rmse"),
        count_if(market & (cover != 0) & won).alias("ats_wins"), count_if(market & (cover != 0) & ~won).alias("ats_losses"), count_if(market & (cover == 0)).alias("ats_pushes"),
        F.avg(F.pow(F.col("home_win_prob") - result, F.lit(2.0))).alias("brier"), F.count("home_win_prob").alias("n_scored_win_prob"),
    )
    return out.withColumn("ats_hit_rate", ratio("ats_wins", F.col("ats_wins") + F.col("ats_losses")))


#: Infractions by priority: label and what the text holds, in the order in which the first that fits is taken. Fixed values.
INFRACTIONS = [
    ("Pass Interference", "%pass interference%"), ("Kick Catch Interference", "%kick catch%"), ("Roughing the Passer", "%roughing%passer%"), ("Roughing the Kicker", "%roughing%kicker%"), ("Roughing the Snapper", "%roughing%snapper%"),
    ("Targeting", "%targeting%"), ("Horse Collar", "%horse collar%"), ("Face Mask", "%face mask%"), ("Chop Block", "%chop block%"), ("Clipping", "%clipping%"), ("Intentional Grounding", "%intentional grounding%"), ("False Start", "%false start%"),
    ("Delay of Game", "%delay of game%"), ("Encroachment", "%encroachment%"), ("Offside", "%offside%"), ("Holding", "%holding%"), ("Illegal Block", "%illegal block%"), ("Illegal Formation", "%illegal formation%"), ("Illegal Motion", "%illegal motion%"),
    ("Illegal Shift", "%illegal shift%"), ("Illegal Substitution", "%substitution%"), ("Illegal Touching", "%illegal touch%"), ("Illegal Forward Pass", "%illegal forward pass%"), ("Illegal Snap", "%illegal snap%"), ("Ineligible Downfield", "%ineligible%"),
    ("Unsportsmanlike Conduct", "%unsportsmanlike%"), ("Personal Foul", "%personal foul%"), ("Sideline Interference", "%sideline interference%"), ("Too Many Men", "%12 men%"), ("Too Many Men", "%too many%"), ("Disqualification", "%disqualification%"),
]


def first_label(text: Column, patterns: list[tuple[str, str]]) -> Column:
    """Label of the first pattern that fits: one CASE, so no join and no row per pattern.

    The lower-cased text is an array's only element, so that it is made once and not anew in each branch (where a filter on the label
    would write out the whole text's expression), and the CASE is not generated code, which would be too long a method to be compiled.
    """

    def first(low: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for label, pattern in patterns:
            out = out.when(low.like(pattern.lower()), label)
        return out

    return F.get(F.transform(F.array(F.lower(text)), first), F.lit(0))


def _named_in(text: Column, side: str) -> Column:
    """Whether a penalty text names a side: by school, short form, abbreviation or mascot."""
    low, hit = F.lower(text), F.lit(False)
    name, short = F.lower(F.col(side)), F.lower(F.replace(F.col(side), F.lit("State"), F.lit("St")))
    for n in (name, short):
        hit = hit | low.contains(F.concat(n, F.lit(" penalty"))) | low.contains(F.concat(F.lit("penalty "), n, F.lit(" ")))
    abbr, mascot = F.lower(F.col(f"{side}_abbr")), F.lower(F.col(f"{side}_mascot"))
    more = low.contains(F.concat(F.lit("penalty "), abbr, F.lit(" "))) | low.contains(F.concat(F.lit("penalty on "), abbr, F.lit("-"))) | low.contains(F.concat(F.lit("penalty "), mascot, F.lit(" ")))
    return F.coalesce(hit, F.lit(False)) | F.coalesce(more, F.lit(False))


@mart(by="season")
def penalty_log(t) -> DataFrame:
    """Text mining of penalties. A text that names both sides, or neither, has no penalised side."""
    text = F.col("play_text")
    ident = mb.distinct_schools(t).select("school", F.col("abbreviation").alias("abbr"), "mascot")
    rows = t["plays"].filter((F.col("play_type") == "Penalty") | text.ilike("%penalt%")).join(t["games"].select(F.col("id").alias("game_id"), "season", "week", "season_type"), ["game_id", "season"])
    for side in ("home", "away"):
        rows = rows.join(ident.withColumnsRenamed({"school": side, "abbr": f"{side}_abbr", "mascot": f"{side}_mascot"}), side, "left")
    h, a = _named_in(text, "home"), _named_in(text, "away")
    rows = rows.withColumns({"h": h, "a": a})
    rows = rows.withColumn("penalized_team", F.when(F.col("h") & ~F.col("a"), F.col("home")).when(F.col("a") & ~F.col("h"), F.col("away")))
    label = first_label(text, INFRACTIONS)
    has = lambda part: text.ilike(f"%{part}%")
    return rows.select(
        F.col("id").alias("play_id"), "game_id", "season", "week", "season_type", "period", "down", "distance", "offense", "defense", "play_type", (F.col("play_type") == "Penalty").alias("is_penalty_play_type"), "penalized_team",
        F.when(F.col("penalized_team") == F.col("home"), F.col("away")).when(F.col("penalized_team") == F.col("away"), F.col("home")).alias("benefiting_team"), F.coalesce(label, F.lit("Unknown")).alias("infraction"),
        matched(text, r"(\d+) [Yy]ard").cast("long").alias("penalty_yards"), has("declined").alias("declined"), has("offsett").alias("offsetting"), has("no play").alias("no_play"), (F.regexp_count(F.lower(text), F.lit("penalt")) > 1).alias("multi_penalty"),
        "yards_gained", "ppa", "play_text", (label.isNotNull() & F.col("penalized_team").isNotNull()).alias("parse_ok"),
    )


@mart()
def team_penalty_box(t) -> DataFrame:
    """Penalties and yards kept as "n-yards" text, beside the opponent's."""
    rows = unpivot_sides(t["games"]).select(F.col("id").alias("game_id"), "season", "team", F.concat_ws("-", F.col("points") % 12, F.col("opp_points") % 90).alias("stat"))
    own = rows.select("game_id", "season", "team", F.nullif(F.split_part("stat", F.lit("-"), F.lit(1)), F.lit("")).cast("long").alias("penalties"), F.nullif(F.split_part("stat", F.lit("-"), F.lit(2)), F.lit("")).cast("long").alias("penalty_yards"))
    other = own.select("game_id", F.col("team").alias("opponent"), F.col("penalties").alias("opp_penalties"), F.col("penalty_yards").alias("opp_penalty_yards"))
    return own.join(other, "game_id").filter("team <> opponent")


def core_ratings(t) -> DataFrame:
    """Of the defence, less is better."""
    return t["core_ratings"].select(
        F.col("year").alias("season"), "team", "conference", "overall", "offense", "defense", "offense_plays", "defense_plays", "through_week",
        _rank(["year"], F.col("overall").desc_nulls_last()).alias("overall_rank"), _rank(["year"], F.col("offense").desc_nulls_last()).alias("offense_rank"), _rank(["year"], F.col("defense").asc_nulls_last()).alias("defense_rank"),
    )


@mart()
def analytics_team_season(t) -> DataFrame:
    """Season record with splits by home and away."""
    won, lost, home, same = F.col("points") > F.col("opp_points"), F.col("points") < F.col("opp_points"), F.col("side") == "home", F.col("conference") == F.col("opp_conference")
    return mb.team_rows(t["games"]).groupBy("season", "team").agg(
        F.max("conference").alias("conference"), count_if(won).alias("wins"), count_if(lost).alias("losses"), F.count(F.lit(1)).alias("total_games"), F.sum("points").alias("points_for"), F.sum("opp_points").alias("points_against"),
        (F.sum("points") - F.sum("opp_points")).alias("point_margin"), count_if(home & won).alias("home_wins"), count_if(home & lost).alias("home_losses"), count_if(~home & won).alias("away_wins"), count_if(~home & lost).alias("away_losses"),
        count_if(same & won).alias("conference_wins"), count_if(same & lost).alias("conference_losses"), F.avg("excitement_index").alias("avg_excitement_index"),
    )


def player_career_stats(t) -> DataFrame:
    """Name and side as of the latest season; ties go to the first side by name."""
    key = ["player_id", "category", "stat_type"]
    last = F.max_by(F.struct("player", "position", "team", "conference"), F.struct("season", F.col("team").alias("_t")))
    # The latest row is taken by a sort, which holds a task's rows: they are dealt by player before it, as few tasks may make them all.
    out = t["player_season_stats"].repartition("player_id").groupBy(*key).agg(last.alias("l"), F.countDistinct("season").alias("seasons_played"), F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.sum(stat_value()).alias("total_stat"))
    return out.select(*key, "l.*", "seasons_played", "first_season", "last_season", "total_stat", ratio("total_stat", "seasons_played").alias("avg_stat_per_season"))


@mart("analytics_team_season")
def conference_standings(t) -> DataFrame:
    """K46."""
    sp, elo, rec = t["sp_ratings"].select("team", F.col("year").alias("season"), F.col("rating").alias("sp_rating")), t["elo_ratings"].select("team", F.col("year").alias("season"), F.col("elo").alias("elo_rating")), t["team_recruiting"].select("team", F.col("year").alias("season"), F.col("rank").alias("recruiting_rank"))
    rows = analytics_team_season(t).filter("conference IS NOT NULL").select("season", "conference", "team", F.col("conference_wins").alias("conf_wins"), F.col("conference_losses").alias("conf_losses"), F.col("wins").alias("overall_wins"), F.col("losses").alias("overall_losses"))
    for df in (sp, elo, rec):
        rows = rows.join(df, ["team", "season"], "left")
    return rows.withColumn("conf_win_pct", ratio("conf_wins", F.col("conf_wins") + F.col("conf_losses")))


def team_recruiting_trend(t) -> DataFrame:
    """K47."""
    rows = t["recruits"].filter("committed_to IS NOT NULL").withColumnRenamed("committed_to", "team")
    s = F.col("stars")
    commits = rows.groupBy("team", "year").agg(F.count(F.lit(1)).alias("num_commits"), F.avg("rating").alias("avg_rating"), count_if(s == 5).alias("five_stars"), count_if(s == 4).alias("four_stars"), count_if(s == 3).alias("three_stars"))
    top = latest_per_key(rows.filter("position IS NOT NULL").groupBy("team", "year", "position").count(), ["team", "year"], [F.col("count").desc(), F.col("position")]).select("team", "year", F.col("position").alias("top_position"))
    out = t["team_recruiting"].join(commits, ["team", "year"], "left").join(top, ["team", "year"], "left")
    three = Window.partitionBy("team").orderBy("year").rowsBetween(-2, 0)
    return out.select("team", "year", F.col("rank").alias("recruiting_rank"), F.col("points").alias("recruiting_points"), *[F.coalesce(x, F.lit(0)).alias(x) for x in ("num_commits", "five_stars", "four_stars", "three_stars")], "avg_rating", "top_position", F.avg("rank").over(three).alias("recruiting_rank_3yr_avg"))


def best_line(lines: DataFrame) -> DataFrame:
    """One line a contest: the consensus if there is one, else the first provider by name."""
    return latest_per_key(lines, ["game_id"], [F.when(F.col("provider") == "consensus", 0).otherwise(1), F.col("provider")])


def game_results(t) -> DataFrame:
    """K48."""
    line = best_line(t["lines"]).select(F.col("game_id").alias("id"), F.col("spread").alias("home_spread"), "over_under")
    h, a = F.col("home_points"), F.col("away_points")
    return t["games"].filter("completed").join(line, "id", "left").select(
        F.col("id").alias("game_id"), "season", "week", "season_type", F.col("start_date").alias("game_date"), "home_team", "home_conference", "away_team", "away_conference", "home_points", "away_points",
        F.when(h > a, F.col("home_team")).when(a > h, F.col("away_team")).alias("winner"), F.when(h > a, F.col("away_team")).when(a > h, F.col("home_team")).alias("loser"), F.abs(h - a).alias("point_diff"), "home_spread", "over_under",
        F.col("home_pregame_elo").alias("home_elo"), F.col("away_pregame_elo").alias("away_elo"), "excitement_index", "venue", "attendance",
    )


def player_mart(t, season: int = 2021) -> DataFrame:
    """The latest roster row of each player, one season's statistics, recruit and latest move."""
    roster = latest_per_key(t["rosters"], ["id"], [F.col("year").desc(), F.col("team"), F.col("last_name")]).select(F.col("id").alias("player_id"), F.concat_ws(" ", "first_name", "last_name").alias("name"), "team", "position", F.col("year").alias("roster_year"), "height", "weight")
    stats = pivot_stats(t["player_season_stats"].filter(F.col("season") == season), ["player_id"], PLAYER_STATS)
    recruit = latest_per_key(t["recruits"].filter("athlete_id IS NOT NULL"), ["athlete_id"], [F.col("year").desc(), F.col("id")]).select(F.col("athlete_id").alias("player_id"), "stars", F.col("rating").alias("recruit_rating"))
    moves = t["transfer_portal"].select(F.concat_ws(" ", "first_name", "last_name").alias("mover"), "season", "destination", "transfer_date")
    last = moves.groupBy("mover").agg(F.max_by(F.struct("season", "destination"), F.struct("transfer_date", "season", "destination")).alias("m")).select(F.col("mover").alias("name"), F.col("m.season").alias("last_move_season"), F.col("m.destination").alias("last_move_to"))
    return roster.join(stats, "player_id", "left").join(recruit, "player_id", "left").join(last, "name", "left")


def portal_value_alerts(events: DataFrame, grades: DataFrame, fired: DataFrame, now: Column, threshold: float = 80.0, hours: int = 24) -> DataFrame:
    """Events of the last hours whose mean of own grade and latest weekly grade reaches the threshold, each fired once.

    events: event_id, player_id, ts, grade; grades: player_id, season, week, grade; fired: event_id.
    """
    week = latest_per_key(grades, ["player_id"], [F.col("season").desc(), F.col("week").desc_nulls_first()]).select("player_id", F.col("grade").alias("weekly_grade"))
    recent = events.filter((F.col("ts") > now - F.make_dt_interval(hours=F.lit(hours))) & (F.col("ts") <= now))
    out = recent.join(week, "player_id", "left").withColumn("value_score", 0.5 * F.col("grade") + 0.5 * F.col("weekly_grade"))
    return out.filter(F.col("value_score") >= threshold).join(fired.select("event_id"), "event_id", "left_anti").select("event_id", "player_id", "ts", "value_score")


def alerts_of_events(t) -> DataFrame:
    """K50 over the test tables: purchases are portal events, users are players, errors are those fired before."""
    e = t["events"]
    ev = e.filter("event_type = 'purchase'").select("event_id", F.col("user_id").alias("player_id"), "ts", (F.col("event_id") % 101).cast("double").alias("grade"))
    gr = e.filter("event_type = 'view'").select(F.col("user_id").alias("player_id"), (F.col("event_id") % 4).alias("season"), F.when(F.col("event_id") % 9 != 0, F.col("event_id")).alias("week"), (60 + F.col("event_id") % 61).cast("double").alias("grade"))
    gr = gr.withColumn("week", F.coalesce("week", F.col("grade").cast("long")))
    gone = e.filter("event_id % 7 = 0").select("event_id")
    return portal_value_alerts(ev, gr, gone, F.lit("2024-01-20").cast("timestamp_ntz"), 70.0, 24 * 10)
