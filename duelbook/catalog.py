"""Names of all registered queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import marts_base as mb
from .plans import jobs_catalog
from .plans import marts_more as mm
from .plans import oracle_jobs, oracle_marts, oracle_more, oracle_serve, primitives
from .plans import serve as sv
from .sources import store
from .sources.adapter import Tables, with_views

#: What the lookups are asked for.
TEAM, SEASON, CONFERENCE = oracle_serve.TEAM, oracle_serve.SEASON, "AMERICA"
#: Query name -> function of the adapter's tables.
PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "K01": mb.team_season_summary, "K02": mb.game_epa, "K03": mb.team_epa_season, "K04": mb.situational_splits, "K05": mb.defensive_havoc, "K06": mb.scoring_opportunities,
    "K07": mb.matchup_history, "K08": mb.recruiting_class, "K09": mb.coach_record, "K10": mb.play_epa, "K11": mb.player_game_epa, "K12": mb.player_season_epa,
    "K13": mb.team_season_trajectory, "K14": mb.conference_era_summary, "K15": mb.team_style_profile, "K16": mb.matchup_edges, "K17": mb.team_talent_composite, "K19": mb.team_tempo_metrics,
    "K21": mb.team_playcalling_tendencies, "K22": mb.team_situational_success, "K23": mb.coaching_tenure,
    "K18": mm.data_quality_dashboard, "K20": mm.player_comparison, "K24": mm.recruiting_roi, "K25": mm.transfer_portal_impact, "K26": mm.conference_comparison, "K27": mm.conference_head_to_head, "K28": mm.freshness_of_events,
    "K29": mm.team_wepa_season, "K30": mm.player_wepa_season, "K31": mm.returning_production, "K32": mm.player_usage, "K33": mm.team_ats_records, "K34": mm.house_elo, "K35": mm.house_elo_game, "K37": mm.scored_matchup_edges,
    "K38": mm.prediction_accuracy, "K41": mm.penalty_log, "K42": mm.team_penalty_box, "K43": mm.core_ratings, "K44": mm.analytics_team_season, "K45": mm.player_career_stats, "K46": mm.conference_standings, "K47": mm.team_recruiting_trend,
    "K48": mm.game_results, "K49": mm.player_mart, "K50": mm.alerts_of_events,
    "L00": lambda t: sv.serve(mb.team_season_summary(t), ["team", "season", "wins", "losses"], [("season", "gte", 2017), ("wins", "gte", 3), ("conference", "in", ["AFRICA", "AMERICA", "ASIA"])], [F.col("wins").desc(), F.col("team"), F.col("season")], 20),
    "L01": sv.team_detail, "L02": lambda t: sv.team_history(t, TEAM), "L03": sv.game_detail, "L04": sv.matchup, "L05": sv.leaderboard_teams, "L06": lambda t: sv.roster_lookup(t, TEAM, SEASON), "L07": sv.player_season_leaders, "L08": sv.player_detail, "L09": sv.game_player_leaders,
    "L10": sv.game_box_score, "L11": sv.game_line_scores, "L12": sv.team_playcalling_profile, "L13": sv.line_movement, "L14": sv.game_drives, "L14_plays": sv.game_plays, "L15": sv.poll_rankings, "L16": sv.game_predictions, "L17": sv.game_win_probability, "L18": sv.live_scoreboard,
    "L20": sv.coach_records, "L23": sv.expected_points_keys, "L24": sv.team_epa_public, "L25": sv.special_teams_sos, "L26": sv.available_seasons, "L27": lambda t: sv.home_away_splits(t, TEAM, SEASON), "L28": lambda t: sv.conference_splits(t, TEAM, SEASON), "L29": lambda t: sv.down_distance_splits(t, TEAM, SEASON),
    "L30": lambda t: sv.field_position_splits(t, TEAM, SEASON), "L31": lambda t: sv.red_zone_splits(t, TEAM, SEASON), "L32": lambda t: sv.player_season_stats_pivoted(t, TEAM, 2017), "L33": lambda t: sv.trajectory_averages(t, CONFERENCE, 2016, 2020), "L34": lambda t: sv.player_search(t, "Customer 10"),
    "L35": lambda t: sv.conference_h2h(t, "EUROPE", CONFERENCE, 2016), "L36": sv.stale_first, "L37": lambda t: sv.drive_patterns(t, TEAM, SEASON), "L38": lambda t: sv.player_season_detail(t, "100"), "L39": lambda t: sv.player_game_log(t, "12", SEASON), "L40": lambda t: sv.player_percentiles(t, "100"), "L41": lambda t: sv.player_season_leaders(t, SEASON, "rushing", limit=20),
    "L42": lambda t: sv.recruiting_class_history(t, TEAM), "L43": lambda t: sv.recruiting_roi_of(t, TEAM), "L44": lambda t: sv.team_portal_activity(t, TEAM, SEASON), "L45": lambda t: sv.team_signees(t, TEAM, SEASON), "L46": lambda t: sv.games_search(t, TEAM, SEASON),
}
PLANS |= primitives.PLANS | jobs_catalog.PLANS
SQL: dict[str, str] = {**oracle_marts.SQL, **oracle_more.SQL, **oracle_serve.SQL, **primitives.SQL, **jobs_catalog.SQL, **oracle_jobs.SQL}
#: Marts and lookups that are served from the store of marts as well, with the marts they read from it.
SERVED = {"K13": ["team_season_trajectory"], "K23": ["coaching_tenure"], "K26": ["conference_comparison"], "L05": ["team_season_summary", "team_epa_season"], "L27": [], "L29": ["play_epa"], "L30": ["play_epa"], "L31": ["play_epa"], "L37": [], "L39": ["player_game_epa"]}
#: Of these the views that are written: plays are wide, so where one mart or view alone is made from them they are not.
VIEWS_OF = {"K23": ["games"], "K26": ["games"], "L05": ["games"], "L27": ["games"], "L29": ["games"], "L30": ["games"], "L31": ["games"], "L37": ["games", "drives"], "L39": ["games"]}
PLANS |= {f"{name}_stored": store.over_store(PLANS[name], *marts, views=VIEWS_OF.get(name, store.BY_SEASON)) for name, marts in SERVED.items()} | {"marts_refreshed": store.refreshed}
SQL |= {f"{name}_stored": SQL[name] for name in SERVED}
_LAYER = {name: i + 1 for i, names in enumerate(store.layers()) for name in names}
_QUERY = {f.__name__: name for name, f in PLANS.items() if f.__name__ in store.MARTS}
SQL["marts_refreshed"] = " UNION ALL ".join(f"SELECT '{m}' AS name, {_LAYER[m]} AS layer, (SELECT count(*) FROM ({SQL[_QUERY[m]]})) AS n_rows" for m in sorted(store.MARTS))


def _long(df: DataFrame) -> DataFrame:
    """Ranks and other ints as longs: one integer type for all results."""
    return df.select(*[F.col(f"`{c}`").cast("long").alias(c) if t == "int" else F.col(f"`{c}`") for c, t in df.dtypes])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: lambda spark, folder, f=f: _long(f(Tables(spark, folder))) for name, f in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(SQL[name]) for name in PLANS if name in SQL}
