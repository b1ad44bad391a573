"""The domain's tables, derived from the star-schema test tables.

Each view is one SQL text that Spark and DuckDB both read: ``{name}`` stands for another view or a base
table. ``tables`` gives lazy DataFrames; ``with_views`` puts the same texts before an oracle query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS: dict[str, str] = {
    "games": """
SELECT o.o_orderkey AS id, CAST(year(o.o_orderdate) + 20 AS BIGINT) AS season,
  CAST(floor((dayofyear(o.o_orderdate) + 6) / 7) AS BIGINT) AS week,
  CASE WHEN month(o.o_orderdate) >= 11 THEN 'postseason' ELSE 'regular' END AS season_type,
  o.o_orderdate AS start_date, o.o_orderstatus <> 'O' OR year(o.o_orderdate) < 2000 AS completed, o.o_orderpriority = '5-LOW' AS neutral_site,
  hr.r_name = ar.r_name AS conference_game,
  h.n_name AS home_team, hr.r_name AS home_conference, CASE WHEN h.n_nationkey % 5 = 0 THEN 'fcs' ELSE 'fbs' END AS home_classification,
  a.n_name AS away_team, ar.r_name AS away_conference, CASE WHEN a.n_nationkey % 5 = 0 THEN 'fcs' ELSE 'fbs' END AS away_classification,
  CAST(floor(o.o_totalprice) AS BIGINT) % 50 AS home_points, o.o_custkey % 45 AS away_points,
  CAST(1400 + (o.o_orderkey * 7) % 300 AS DOUBLE) AS home_pregame_elo, CAST(1400 + (o.o_orderkey * 11) % 300 AS DOUBLE) AS away_pregame_elo,
  concat('Stadium ', CAST(o.o_custkey % 40 AS VARCHAR(9))) AS venue, o.o_custkey % 40 AS venue_id,
  (o.o_orderkey % 97) * 250 AS attendance, CAST((o.o_orderkey % 101) AS DOUBLE) / 10 AS excitement_index
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} h ON h.n_nationkey = c.c_nationkey JOIN {region} hr ON hr.r_regionkey = h.n_regionkey
JOIN {nation} a ON a.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25 JOIN {region} ar ON ar.r_regionkey = a.n_regionkey""",
    "plays": """
SELECT l.l_orderkey AS game_id, concat(CAST(l.l_orderkey AS VARCHAR(20)), '-', CAST(l.l_linenumber AS VARCHAR(9)), '-', CAST(l.l_partkey AS VARCHAR(20)), '-', CAST(l.l_suppkey AS VARCHAR(20))) AS id,
  concat(CAST(l.l_orderkey AS VARCHAR(20)), '-', l.l_returnflag) AS drive_id, g.season,
  CAST(l.l_linenumber AS BIGINT) AS play_number,
  CASE WHEN l.l_returnflag <> 'R' THEN g.home_team ELSE g.away_team END AS offense,
  CASE WHEN l.l_returnflag <> 'R' THEN g.home_conference ELSE g.away_conference END AS offense_conference,
  CASE WHEN l.l_returnflag <> 'R' THEN g.away_team ELSE g.home_team END AS defense,
  g.home_team AS home, g.away_team AS away,
  CAST(1 + l.l_linenumber % 4 AS BIGINT) AS period, 1 + l.l_partkey % 4 AS down, 1 + l.l_suppkey % 15 AS distance,
  l.l_suppkey % 15 AS clock_minutes, l.l_partkey % 60 AS clock_seconds,
  1 + (l.l_partkey + l.l_suppkey) % 99 AS yards_to_goal, CAST(l.l_quantity AS BIGINT) - 10 AS yards_gained,
  CASE WHEN l.l_quantity = 50 THEN NULL ELSE CAST(CAST(round(l.l_discount * 100) AS BIGINT) - 5 AS DOUBLE) / 8 END AS ppa,
  CASE l.l_partkey % 12 WHEN 0 THEN 'Rush' WHEN 1 THEN 'Pass Reception' WHEN 2 THEN 'Pass Incompletion' WHEN 3 THEN 'Sack' WHEN 4 THEN 'Rushing Touchdown'
    WHEN 5 THEN 'Passing Touchdown' WHEN 6 THEN 'Interception Return' WHEN 7 THEN 'Fumble Recovery (Opponent)' WHEN 8 THEN 'Kickoff' WHEN 9 THEN 'Penalty'
    WHEN 10 THEN 'Timeout' ELSE 'Run' END AS play_type,
  CASE WHEN l.l_partkey % 12 = 9 THEN concat(g.home_team, CASE l.l_suppkey % 5 WHEN 0 THEN ' penalty 10 yard Holding' WHEN 1 THEN ' Penalty, False Start (-5 Yards)' WHEN 2 THEN ' pass interference defense (15 yards) accepted'
    WHEN 3 THEN ' PENALTY offside declined' ELSE ' personal foul, offsetting penalty' END) ELSE concat('Play by ', g.home_team) END AS play_text,
  (l.l_partkey % 91) - 45 AS score_diff, l.l_linestatus = 'F' AS scoring
FROM {lineitem} l JOIN {games} g ON g.id = l.l_orderkey""",
    "drives": """
SELECT drive_id AS id, game_id, season, offense, defense, CAST(count(*) AS BIGINT) AS plays, CAST(sum(yards_gained) AS BIGINT) AS yards,
  min(play_number) AS drive_number, min(period) AS start_period, max(yards_to_goal) AS start_yards_to_goal, min(yards_to_goal) AS end_yards_to_goal,
  CASE CAST(sum(yards_gained) AS BIGINT) % 7 WHEN 0 THEN 'TD' WHEN 1 THEN 'PUNT' WHEN 2 THEN 'FG' WHEN 3 THEN 'INT' WHEN 4 THEN 'FUMBLE' WHEN 5 THEN 'PUNT' ELSE 'DOWNS' END AS drive_result,
  CAST(max(clock_minutes) AS BIGINT) AS elapsed_minutes, offense = max(home) AS is_home_offense
FROM {plays} GROUP BY drive_id, game_id, season, offense, defense""",
    "teams": """
SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS school, concat(n.n_name, 's') AS mascot, substring(n.n_name, 1, 3) AS abbreviation, r.r_name AS conference,
  CASE WHEN n.n_nationkey % 5 = 0 THEN 'fcs' ELSE 'fbs' END AS classification, concat('#', CAST(100000 + n.n_nationkey AS VARCHAR(9))) AS color
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey
UNION ALL SELECT CAST(100 + n_nationkey AS BIGINT), n_name, NULL, NULL, NULL, NULL, NULL FROM {nation} WHERE n_nationkey < 5""",
    "seasons": "SELECT DISTINCT CAST(year(o_orderdate) + 20 AS BIGINT) AS year FROM {orders}",
    "team_years": "SELECT n.n_name AS team, CAST(n.n_nationkey AS BIGINT) AS k, r.r_name AS conference, y.year FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey CROSS JOIN {seasons} y",
    "sp_ratings": "SELECT year, team, conference, CAST((k * 37 + year * 11) % 61 - 30 AS DOUBLE) AS rating, (k * 37 + year * 11) % 130 + 1 AS ranking, CAST((k * 13 + year) % 40 AS DOUBLE) AS offense_rating, CAST((k * 17 + year) % 40 AS DOUBLE) AS defense_rating FROM {team_years} WHERE (k + year) % 11 <> 0",
    "elo_ratings": "SELECT year, team, CAST(1300 + (k * 53 + year * 7) % 500 AS DOUBLE) AS elo FROM {team_years} WHERE (k + year) % 13 <> 0",
    "fpi_ratings": "SELECT year, team, CAST((k * 29 + year * 3) % 50 - 25 AS DOUBLE) AS fpi FROM {team_years} WHERE (k + year) % 7 <> 0",
    "core_ratings": "SELECT year, team, conference, CAST((k * 19 + year * 5) % 40 - 20 AS DOUBLE) AS offense, CAST((k * 23 + year * 3) % 40 - 20 AS DOUBLE) AS defense, CAST((k * 19 + year * 5) % 40 - (k * 23 + year * 3) % 40 AS DOUBLE) AS overall, 100 + k AS offense_plays, 90 + k AS defense_plays, CAST(15 AS BIGINT) AS through_week FROM {team_years}",
    "team_recruiting": "SELECT year, team, (k * 31 + year * 17) % 60 + 1 AS rank, CAST((k * 41 + year * 13) % 300 AS DOUBLE) AS points FROM {team_years} WHERE (k + year) % 9 <> 0",
    "team_talent": "SELECT year, team, CAST((k * 43 + year * 29) % 1000 AS DOUBLE) AS talent FROM {team_years}",
    "recruits": """
SELECT c.c_custkey AS id, CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(c.c_custkey AS VARCHAR(20)) END AS athlete_id, 2013 + c.c_custkey % 9 AS year,
  CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE c.c_custkey % 300 + 1 END AS ranking, c.c_name AS name,
  CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE n.n_name END AS committed_to,
  CASE c.c_custkey % 10 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' WHEN 4 THEN 'OT' WHEN 5 THEN 'EDGE' WHEN 6 THEN 'LB' WHEN 7 THEN 'CB' WHEN 8 THEN 'K' ELSE 'ATH' END AS position,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE 1 + c.c_custkey % 5 END AS stars, CAST(700 + c.c_custkey % 300 AS DOUBLE) / 1024 AS rating
FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey""",
    "transfer_portal": """
SELECT 2015 + e.event_id % 7 AS season, concat('F', CAST(e.user_id AS VARCHAR(9))) AS first_name, concat('L', CAST(e.event_id % 50 AS VARCHAR(9))) AS last_name, o.n_name AS origin,
  CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE d.n_name END AS destination,
  CASE e.event_id % 4 WHEN 0 THEN 'QB' WHEN 1 THEN 'WR' WHEN 2 THEN 'LB' ELSE 'CB' END AS position,
  CASE WHEN e.event_id % 6 = 0 THEN NULL ELSE 1 + e.event_id % 5 END AS stars, CASE WHEN e.event_id % 6 = 0 THEN NULL ELSE CAST(50 + e.event_id % 50 AS DOUBLE) / 128 END AS rating, e.ts AS transfer_date
FROM {events} e JOIN {nation} o ON o.n_nationkey = e.user_id % 25 JOIN {nation} d ON d.n_nationkey = (e.user_id + 1 + e.event_id % 24) % 25""",
    "draft_picks": "SELECT 2015 + s.s_suppkey % 7 AS year, s.s_suppkey AS overall, 1 + s.s_suppkey % 7 AS round, n.n_name AS college_team FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey WHERE n.n_nationkey % 6 <> 0",
    "coach_seasons": """
SELECT concat('C', CAST(s.s_suppkey % 40 AS VARCHAR(9))) AS first_name, concat('Coach', CAST(s.s_suppkey % 37 AS VARCHAR(9))) AS last_name, n.n_name AS school, y.year,
  CAST(12 AS BIGINT) AS games, (s.s_suppkey * 3 + y.year) % 13 AS wins, 12 - (s.s_suppkey * 3 + y.year) % 13 AS losses, CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE CAST(0 AS BIGINT) END AS ties,
  CASE WHEN (s.s_suppkey + y.year) % 3 = 0 THEN (s.s_suppkey + y.year) % 25 + 1 END AS preseason_rank, CASE WHEN (s.s_suppkey + y.year) % 4 = 0 THEN (s.s_suppkey * 3 + y.year) % 25 + 1 END AS postseason_rank,
  CAST((s.s_suppkey * 7 + y.year) % 50 - 25 AS DOUBLE) AS sp_overall
FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey CROSS JOIN {seasons} y WHERE (s.s_suppkey + y.year * y.year) % 4 <> 0""",
    "rosters": """
SELECT CAST(c.c_custkey AS VARCHAR(20)) AS id, n.n_name AS team, 2015 + (c.c_custkey + v.d) % 7 AS year, concat('F', CAST(c.c_custkey % 50 AS VARCHAR(9))) AS first_name, c.c_name AS last_name,
  CASE c.c_custkey % 10 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' WHEN 4 THEN 'OT' WHEN 5 THEN 'EDGE' WHEN 6 THEN 'LB' WHEN 7 THEN 'CB' WHEN 8 THEN 'K' ELSE 'ATH' END AS position,
  70 + c.c_custkey % 10 AS height, 180 + c.c_custkey % 120 AS weight, c.c_custkey % 99 AS jersey
FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1) v""",
    "lines": """
SELECT g.id AS game_id, p.provider, CAST((g.id * (3 + p.k)) % 57 - 28 AS DOUBLE) / 2 AS spread, CAST(40 + (g.id * (5 + p.k)) % 31 AS DOUBLE) AS over_under
FROM {games} g CROSS JOIN (SELECT 'consensus' AS provider, 0 AS k UNION ALL SELECT 'alpha', 1 UNION ALL SELECT 'beta', 2) p WHERE (g.id + p.k) % 4 <> 0 AND g.id % 10 <> 7""",
    "player_season_stats": """
SELECT CAST(p.p_partkey AS VARCHAR(20)) AS player_id, y.year AS season, n.n_name AS team, t.category, t.stat_type, p.p_name AS player,
  CASE p.p_partkey % 5 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'LB' ELSE 'CB' END AS position, r.r_name AS conference,
  CASE WHEN (p.p_partkey + t.k) % 19 = 0 THEN '' ELSE CAST((p.p_partkey * (t.k + 3) + y.year) % 900 AS VARCHAR(9)) END AS stat
FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25 JOIN {region} r ON r.r_regionkey = n.n_regionkey
CROSS JOIN {seasons} y
CROSS JOIN (SELECT 'passing' AS category, 'YDS' AS stat_type, 0 AS k UNION ALL SELECT 'passing', 'TD', 1 UNION ALL SELECT 'passing', 'INT', 2 UNION ALL SELECT 'passing', 'ATT', 3 UNION ALL SELECT 'passing', 'COMPLETIONS', 4
  UNION ALL SELECT 'rushing', 'CAR', 5 UNION ALL SELECT 'rushing', 'YDS', 6 UNION ALL SELECT 'rushing', 'TD', 7 UNION ALL SELECT 'receiving', 'REC', 8 UNION ALL SELECT 'receiving', 'YDS', 9 UNION ALL SELECT 'receiving', 'TD', 10
  UNION ALL SELECT 'defensive', 'TOT', 11 UNION ALL SELECT 'defensive', 'SOLO', 12 UNION ALL SELECT 'defensive', 'SACKS', 13 UNION ALL SELECT 'defensive', 'TFL', 14 UNION ALL SELECT 'kicking', 'FGM', 15 UNION ALL SELECT 'kicking', 'FGA', 16) t
WHERE (p.p_partkey + y.year) % 5 = 0 AND (p.p_partkey + t.k) % 3 <> 0""",
    "play_stats": """
SELECT l.l_orderkey AS game_id, concat(CAST(l.l_orderkey AS VARCHAR(20)), '-', CAST(l.l_linenumber AS VARCHAR(9)), '-', CAST(l.l_partkey AS VARCHAR(20)), '-', CAST(l.l_suppkey AS VARCHAR(20))) AS play_id,
  CAST(x.n_nationkey + 25 * (l.l_orderkey % o.athletes) AS VARCHAR(20)) AS athlete_id, concat('Athlete ', CAST(x.n_nationkey + 25 * (l.l_orderkey % o.athletes) AS VARCHAR(20))) AS athlete_name,
  CASE l.l_partkey % 6 WHEN 0 THEN 'Rush' WHEN 1 THEN 'Completion' WHEN 2 THEN 'Incompletion' WHEN 3 THEN 'Reception' WHEN 4 THEN 'Target' ELSE 'Sack' END AS stat_type,
  x.n_name AS team, g.season
FROM {lineitem} l JOIN {games} g ON g.id = l.l_orderkey JOIN {nation} x ON x.n_name = CASE WHEN l.l_returnflag <> 'R' THEN g.home_team ELSE g.away_team END
CROSS JOIN (SELECT CAST(1 + floor(count(*) / 30000) AS BIGINT) AS athletes FROM {orders}) o""",
    "game_havoc": """
SELECT g.id AS game_id, CASE v.s WHEN 0 THEN g.home_team ELSE g.away_team END AS team, g.season,
  CASE WHEN g.id % 3 = 0 THEN NULL ELSE (g.id + v.s) % 12 END AS total_havoc, CASE WHEN g.id % 3 = 0 THEN CAST((g.id + v.s) % 12 AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS total_havoc_v_double,
  (g.id + v.s) % 7 AS front_seven_havoc, (g.id + v.s) % 5 AS db_havoc, 50 + (g.id + v.s) % 30 AS total_plays
FROM {games} g CROSS JOIN (SELECT 0 AS s UNION ALL SELECT 1) v WHERE g.id % 2 = 0""",
    "eras": "SELECT 'A' AS code, 'Early' AS name, CAST(2004 AS BIGINT) AS start_year, CAST(2013 AS BIGINT) AS end_year UNION ALL SELECT 'B', 'Playoff', 2014, 2021 UNION ALL SELECT 'C', 'Portal', 2018, 2021 UNION ALL SELECT 'D', 'Expansion', 2021, NULL",
    "team_wepa": "SELECT year, team, conference, CAST((k * 3 + year) % 41 - 20 AS DOUBLE) / 128 AS epa, CAST((k * 5 + year) % 37 - 18 AS DOUBLE) / 128 AS epa_allowed, CAST((k * 7 + year) % 60 AS DOUBLE) / 128 AS success_rate FROM {team_years} WHERE (k + year) % 6 <> 0",
    "player_wepa": """
SELECT CAST(p.p_partkey AS VARCHAR(20)) AS athlete_id, p.p_name AS athlete_name, n.n_name AS team, y.year, CASE p.p_partkey % 3 WHEN 0 THEN 'passing' WHEN 1 THEN 'rushing' ELSE 'kicking' END AS category,
  CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE CAST((p.p_partkey * 7 + y.year) % 200 - 100 AS DOUBLE) / 128 END AS wepa, 10 + p.p_partkey % 90 AS plays
FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25 CROSS JOIN {seasons} y WHERE (p.p_partkey + y.year) % 7 = 0""",
    "returning_production": "SELECT year AS season, team, conference, CASE WHEN k % 2 = 0 THEN CAST((k * 11 + year) % 100 AS BIGINT) END AS total_ppa, CASE WHEN k % 2 = 1 THEN CAST((k * 11 + year) % 100 AS DOUBLE) / 4 END AS total_ppa_v_double, CAST((k * 13 + year) % 100 AS DOUBLE) / 128 AS percent_ppa FROM {team_years}",
    "player_usage": "SELECT athlete_id AS id, year AS season, team, athlete_name AS name, CASE WHEN plays % 2 = 0 THEN CAST(plays AS BIGINT) END AS usage_overall, CASE WHEN plays % 2 = 1 THEN CAST(plays AS DOUBLE) / 128 END AS usage_overall_v_double FROM {player_wepa}",
    "drive_scores": """
SELECT id, game_id, season, offense, defense, CASE WHEN plays % 7 = 6 THEN NULL ELSE start_yards_to_goal END AS start_yards_to_goal,
  CASE WHEN plays % 5 = 4 THEN NULL ELSE drive_number END AS start_offense_score,
  drive_number + CASE drive_result WHEN 'TD' THEN 7 WHEN 'FG' THEN 3 ELSE 0 END AS end_offense_score FROM {drives}""",
    "havoc_allowed": """
SELECT game_id, team, season, total_havoc, total_havoc_v_double, total_plays, CASE WHEN game_id % 3 = 1 THEN NULL ELSE (total_plays * 3) % 11 END AS allowed,
  CASE WHEN game_id % 3 = 1 THEN CAST((total_plays * 3) % 11 AS DOUBLE) / 2 END AS allowed_v_double, total_plays + 3 AS allowed_plays FROM {game_havoc}""",
    "returning_detail": """
SELECT season, team, percent_ppa, CASE WHEN season % 4 = 0 THEN NULL ELSE percent_ppa / 2 END AS percent_passing_ppa, 1 - percent_ppa AS percent_rushing_ppa, percent_ppa / 4 AS usage FROM {returning_production}""",
    "advanced_team_stats": """
SELECT year AS season, team, CAST((k * 7 + year * 3) % 50 AS DOUBLE) / 16 AS defense_line_yards, CAST((k * 3 + year * 5) % 40 AS DOUBLE) / 128 AS defense_stuff_rate FROM {team_years} WHERE (k + year) % 8 <> 0""",
    "team_ats": "SELECT year, team, conference, CAST(12 AS BIGINT) AS games, (k * 3 + year) % 11 AS ats_wins, (k * 5 + year) % 9 AS ats_losses, (k + year) % 3 AS ats_pushes FROM {team_years}",
    "game_predictions": """
SELECT g.id AS game_id, g.season, m.model_version, CAST(v.d AS BIGINT) AS prediction_day, CAST((g.id * (3 + m.k) + v.d) % 41 - 20 AS DOUBLE) AS expected_margin, CAST((g.id * (7 + m.k) + v.d) % 127 + 1 AS DOUBLE) / 128 AS home_win_prob,
  CASE WHEN (g.id + m.k) % 5 = 0 THEN NULL ELSE CAST((g.id * 3) % 57 - 28 AS DOUBLE) / 2 END AS market_spread
FROM {games} g CROSS JOIN (SELECT 'elo' AS model_version, 0 AS k UNION ALL SELECT 'blend', 1) m CROSS JOIN (SELECT 1 AS d UNION ALL SELECT 2 UNION ALL SELECT 3) v WHERE (g.id + v.d) % 3 <> 0""",
    "captures": "SELECT user_id AS game_id, ts AS captured_at, event_id, event_type AS status, CAST(floor(value / 50) AS BIGINT) AS points, md5(concat(event_type, '|', CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR(20)))) AS state_hash FROM {events} WHERE value IS NOT NULL AND user_id IS NOT NULL",
    "house_elo_game": """
SELECT id AS game_id, season, week, season_type, start_date, neutral_site, home_team, away_team, CAST(1450 + (id * 7) % 200 AS DOUBLE) AS home_pregame_elo, CAST(1450 + (id * 11) % 200 AS DOUBLE) AS away_pregame_elo,
  CAST(1450 + (id * 7) % 200 + (id % 21) - 10 AS DOUBLE) AS home_postgame_elo, CAST(1450 + (id * 11) % 200 - (id % 21) + 10 AS DOUBLE) AS away_postgame_elo, CAST((id * 7) % 40 - 20 AS DOUBLE) AS expected_home_margin, home_points - away_points AS actual_home_margin
FROM {games} WHERE completed""",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Base tables and views by key, each made once as a lazy DataFrame; ``given`` ones take the place of their own."""

    def __init__(self, spark: SparkSession, folder: str, given: dict[str, DataFrame] | None = None):
        self.spark, self.folder, self._made = spark, folder, dict(given or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._view(name)
        return self._made[name]

    def _view(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = VIEWS[name]
        return self.spark.sql(sql.replace("VARCHAR(9)", "STRING").replace("VARCHAR(20)", "STRING"), **{n: self[n] for n in _needs(sql)})

    def mart(self, name: str) -> DataFrame | None:
        """A mart's stored rows; these tables have none."""
        return None

    def of_seasons(self, seasons: list[int]) -> Tables:
        """The tables over the contests of some seasons."""
        out = Tables(self.spark, self.folder, {k: v for k, v in self._made.items() if k in BASE})
        for name in ("games", "plays", "drives"):
            if name == "games" or name in self._made:
                out._made[name] = self[name].filter(F.col("season").isin(*seasons))
        return out

    def of_team(self, team: str | None, season: int | None) -> Tables:
        """The tables over one side's contests of one season: a date range that the scan of contests can use, and its
        few contests before plays and drives are joined or grouped."""
        given = {}
        if season is not None:
            day = F.col("o_orderdate")
            given["orders"] = self["orders"].filter((day >= F.lit(f"{season - 20}-01-01").cast("timestamp_ntz")) & (day < F.lit(f"{season - 19}-01-01").cast("timestamp_ntz")))
        out = Tables(self.spark, self.folder, given)
        if team is not None:
            out._made["games"] = out["games"].filter((F.col("home_team") == team) | (F.col("away_team") == team))
        return out


def with_views(sql: str) -> str:
    """An oracle query over views: the texts of all views it names in braces come before it."""
    order: list[str] = []

    def add(text: str) -> None:
        for n in _needs(text):
            if n in VIEWS and n not in order:
                add(VIEWS[n])
                order.append(n)

    add(sql)
    plain = lambda t: re.sub(r"\{(\w+)\}", r"\1", t)
    head = ", ".join(f"{n} AS ({plain(VIEWS[n]).strip()})" for n in order)
    body = plain(sql).strip()
    if not head:
        return body
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"
