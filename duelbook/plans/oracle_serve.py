"""Reference SQL (DuckDB) of the serving views and lookups."""

from .marts_more import PLAYER_STATS
from .oracle_marts import _K03, _K08, _K11, K01, K02, K05, K10, SIDES
from .oracle_more import _LATEST, _LINE, K20, K24, K27, K28, K30
from .serve import LEAD_BY, LEADERS

TEAM, SEASON = "NATION_3", 2018


def _stat(names) -> str:
    return ", ".join(f"max(nullif(stat, '')::DOUBLE) FILTER (category = '{PLAYER_STATS[n][0]}' AND stat_type = '{PLAYER_STATS[n][1]}') AS {n}" for n in names)


L00 = f"SELECT team, season, wins, losses FROM ({K01}) WHERE season >= 2017 AND wins >= 3 AND conference IN (SELECT r_name FROM {{region}} WHERE r_regionkey < 3) ORDER BY wins DESC, team, season LIMIT 20"
L01 = f"""WITH s AS ({K01}), e AS ({_K03}), d AS (SELECT * FROM {{teams}} QUALIFY row_number() OVER (PARTITION BY school ORDER BY classification NULLS LAST, id) = 1)
SELECT d.id, d.school, mascot, abbreviation, d.conference, color, s.season, s.wins, s.losses, s.sp_rating, e.epa_per_play, e.epa_tier FROM d LEFT JOIN (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY team ORDER BY season DESC) = 1) s ON s.team = school
LEFT JOIN (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY team ORDER BY season DESC) = 1) e ON e.team = school"""
L02 = f"SELECT s.*, epa_per_play, success_rate, epa_tier FROM ({K01}) s LEFT JOIN ({_K03}) e USING (team, season) WHERE s.team = '{TEAM}'"
L03 = f"""WITH e AS ({K02}) SELECT g.id AS game_id, season, week, start_date, home_team, away_team, home_points, away_points, completed, provider, spread, over_under, h.epa_per_play AS home_epa, h.success_rate AS home_success, a.epa_per_play AS away_epa, a.success_rate AS away_success,
  home_points - away_points AS margin, CASE WHEN completed THEN CASE sign(home_points - away_points + spread) WHEN 1 THEN 'home' WHEN -1 THEN 'away' WHEN 0 THEN 'push' END END AS cover,
  CASE WHEN completed THEN CASE sign(home_points + away_points - over_under) WHEN 1 THEN 'over' WHEN -1 THEN 'under' WHEN 0 THEN 'push' END END AS total_result
FROM {{games}} g LEFT JOIN (SELECT * FROM {{lines}} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY provider <> 'consensus', provider) = 1) l ON l.game_id = g.id LEFT JOIN e h ON h.game_id = g.id AND h.team = home_team LEFT JOIN e a ON a.game_id = g.id AND a.team = away_team"""
L04 = """WITH p AS (SELECT *, least(home_team, away_team) AS team1, greatest(home_team, away_team) AS team2, CASE WHEN home_team < away_team THEN home_points - away_points ELSE away_points - home_points END AS m FROM {games} WHERE completed)
SELECT team1, team2, count(*) AS total_games, count(*) FILTER (m > 0) AS team1_wins, count(*) FILTER (m < 0) AS team2_wins, count(*) FILTER (m = 0) AS ties, last({'w': CASE WHEN m > 0 THEN team1 WHEN m < 0 THEN team2 END} ORDER BY start_date, id)['w'] AS last_winner,
  list(id ORDER BY start_date DESC, id DESC)[1:5] AS recent_games FROM p GROUP BY team1, team2"""
L05 = f"""WITH {SIDES}, dv AS (SELECT team, season, cls AS division FROM sides GROUP BY team, season, cls QUALIFY row_number() OVER (PARTITION BY team, season ORDER BY count(*) DESC, cls) = 1), r AS ({K01}), e AS ({_K03}), x AS (SELECT team, season, wins, losses, ppg, sp_rating, epa_per_play, division FROM r LEFT JOIN (SELECT team, season, epa_per_play FROM e) USING (team, season) LEFT JOIN dv USING (team, season))
SELECT *, rank() OVER (w ORDER BY wins DESC) AS wins_rank, rank() OVER (w ORDER BY round(ppg, 9) DESC) AS ppg_rank, rank() OVER (w ORDER BY sp_rating DESC NULLS LAST) AS sp_rank, rank() OVER (w ORDER BY round(epa_per_play, 9) DESC NULLS LAST) AS epa_rank FROM x WINDOW w AS (PARTITION BY season, division)"""
L06 = f"SELECT id, first_name || ' ' || last_name AS name, team, year, position, height, weight, jersey FROM {{rosters}} WHERE team = '{TEAM}' AND year = {SEASON}"


def _leaders(extra: str = "") -> str:
    every = [n for names in LEADERS.values() for n in names]
    parts = []
    for k, names in LEADERS.items():
        pad = ", ".join(n if n in names else f"NULL::DOUBLE AS {n}" for n in every)
        parts.append(f"SELECT player_id, player, team, conference, season, {pad}, '{k}' AS category, rank() OVER (PARTITION BY season ORDER BY {LEAD_BY[k]} DESC NULLS LAST) AS leader_rank FROM (SELECT player_id, player, team, conference, season, {_stat(names)} FROM {{player_season_stats}} WHERE category = '{k}' {extra} GROUP BY ALL)")
    return " UNION ALL ".join(parts)


L07 = _leaders()
L08 = f"""WITH r AS (SELECT id AS player_id, first_name, last_name, team, position FROM {{rosters}} QUALIFY row_number() OVER (PARTITION BY id ORDER BY year DESC, team, last_name) = 1), s AS (SELECT player_id, season, {_stat(PLAYER_STATS)} FROM {{player_season_stats}} GROUP BY player_id, season),
x AS (SELECT athlete_id AS player_id, stars, ranking FROM {{recruits}} WHERE athlete_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY rating DESC NULLS LAST, id) = 1)
SELECT * FROM r LEFT JOIN (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY season DESC) = 1) USING (player_id) LEFT JOIN x USING (player_id)"""
L09 = "SELECT game_id, team, stat_type, athlete_id, athlete_name, count(*) AS stat FROM {play_stats} GROUP BY ALL"
L10 = f"WITH {SIDES} SELECT id AS game_id, team, CASE WHEN at_home THEN 'home' ELSE 'away' END AS side, c.category, CASE c.category WHEN 'points' THEN pf ELSE pa END::VARCHAR AS stat FROM sides, (SELECT unnest(['points', 'allowed']) AS category) c"
_Q = ", ".join(f"{s}_points // 5 AS {s}_q{i}" for s in ("home", "away") for i in (1, 2, 3))
_QE = ", ".join(f"CASE WHEN id % 9 = 0 THEN {s}_points - 4 * ({s}_points // 5) ELSE {s}_points - 3 * ({s}_points // 5) END AS {s}_q4, CASE WHEN id % 9 = 0 THEN {s}_points // 5 ELSE 0 END AS {s}_ot" for s in ("home", "away"))
L11 = f"SELECT id AS game_id, {_Q}, {_QE} FROM {{games}}"
L13 = """WITH w AS (SELECT *, lag(points) OVER o AS prev, coalesce(lag(state_hash) OVER o = state_hash, false) AS same FROM {captures} WINDOW o AS (PARTITION BY game_id ORDER BY captured_at, event_id)), r AS (SELECT *, sum((NOT same)::BIGINT) OVER (PARTITION BY game_id ORDER BY captured_at, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM w)
SELECT game_id, captured_at, event_id, points, points - prev AS moved, run, row_number() OVER (PARTITION BY game_id, run ORDER BY captured_at, event_id) - 1 AS unmoved_streak FROM r"""
L14 = "SELECT game_id, id AS drive_id, season, offense, defense, drive_number, plays, yards, drive_result, start_yards_to_goal, end_yards_to_goal, start_yards_to_goal - end_yards_to_goal AS net_field FROM {drives}"
L14_plays = "SELECT game_id, id AS play_id, drive_id, play_number, period, offense, defense, down, distance, yards_to_goal, yards_gained, play_type, play_text, ppa, scoring FROM {plays}"
L15 = "SELECT year AS season, 'regular' AS season_type, ranking % 15 + 1 AS week, 'poll' AS poll, team AS school, conference, ranking % 25 + 1 AS rank FROM {sp_ratings}"
L16 = f"SELECT game_id, model_version, prediction_day, expected_margin, home_win_prob, market_spread, edge, edge_pick, completed FROM ({_LATEST})"
L17 = f"SELECT p.game_id, p.id AS play_id, p.season, period, printf('%02d:%02d', clock_minutes, clock_seconds) AS clock, down, distance, score_diff, coalesce(x.home_win_prob, 0.5::DOUBLE) AS pregame_win_prob FROM {{plays}} p LEFT JOIN (SELECT game_id, home_win_prob FROM ({_LATEST}) WHERE model_version = 'elo') x USING (game_id)"
L18 = "SELECT game_id, captured_at, status, points, state_hash FROM {captures} WHERE captured_at > (SELECT max(captured_at) FROM {captures}) - INTERVAL 24 HOUR QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY captured_at DESC, event_id DESC) = 1"
L20 = """SELECT first_name, last_name, count(DISTINCT c.year) AS seasons, count(DISTINCT school) AS schools, sum(wins)::BIGINT AS wins, sum(losses)::BIGINT AS losses, sum(ats_wins)::BIGINT AS ats_wins, sum(ats_losses)::BIGINT AS ats_losses, count(ats_wins) AS ats_seasons, sum(ats_wins) / nullif(sum(ats_wins + ats_losses), 0) AS ats_pct
FROM {coach_seasons} c LEFT JOIN {team_ats} a ON a.team = c.school AND a.year = c.year GROUP BY first_name, last_name"""
L23 = "SELECT 'd' || down || '|' || b || '|z' || z AS state, count(*) AS plays, down, b AS distance_bucket, z AS field_zone FROM (SELECT down, CASE WHEN distance <= 3 THEN 'short' WHEN distance <= 7 THEN 'medium' ELSE 'long' END AS b, (yards_to_goal + 9) // 10 AS z FROM {plays}) GROUP BY down, b, z"
L24 = f"""WITH {SIDES}, c AS (SELECT team, season, max(cls) AS division FROM sides GROUP BY ALL), h AS ({K05}) SELECT e.team, e.season, division, e.epa_per_play, e.success_rate, epa_tier, rank() OVER (PARTITION BY e.season, division ORDER BY round(e.epa_per_play, 9) DESC NULLS LAST) AS off_rank,
  rank() OVER (PARTITION BY e.season, division ORDER BY coalesce(round(opp_epa_per_play, 9), 999.0)) AS def_rank FROM ({_K03}) e LEFT JOIN c USING (team, season) LEFT JOIN h USING (team, season)"""
L25 = "SELECT team, year AS season, rating AS sp, fpi FROM {sp_ratings} FULL JOIN {fpi_ratings} USING (team, year)"
L26 = "SELECT season, array_to_string(list(DISTINCT week ORDER BY week), ',') AS weeks, count(DISTINCT week) AS n_weeks FROM {games} GROUP BY season"
_REC = "count(*) AS games, count(*) FILTER (pf > pa) AS wins, count(*) FILTER (pf < pa) AS losses, avg((pf > pa)::INT) AS win_pct, avg(pf) AS points_for, avg(pa) AS points_against"
_ONE = f"FROM sides WHERE completed AND team = '{TEAM}' AND season = {SEASON}"
L27 = f"WITH {SIDES} SELECT CASE WHEN at_home THEN 'home' ELSE 'away' END AS side, {_REC} {_ONE} GROUP BY at_home"
L28 = f"WITH {SIDES} SELECT CASE WHEN conf = opp_conf THEN 'conference' ELSE 'non_conference' END AS kind, {_REC} {_ONE} GROUP BY conf = opp_conf"
_SP = f"SELECT *, CASE WHEN offense = '{TEAM}' THEN 'offense' ELSE 'defense' END AS side FROM ({K10}) WHERE season = {SEASON} AND '{TEAM}' IN (offense, defense)"
_RT = "count(*) AS plays, avg(epa) AS epa_per_play, avg(success) AS success_rate, avg(yards_gained) AS yards_per_play"
L29 = f"SELECT side, down, distance_bucket, {_RT} FROM ({_SP}) GROUP BY side, down, distance_bucket"
L30 = f"""SELECT side, ['red_zone', 'opponent_territory', 'midfield', 'own_territory', 'backed_up'][6 - o] AS zone, o AS zone_order, {_RT} FROM (SELECT *, CASE WHEN own <= 20 THEN 5 WHEN own <= 40 THEN 4 WHEN own <= 60 THEN 3 WHEN own <= 80 THEN 2 ELSE 1 END::BIGINT AS o
  FROM (SELECT *, CASE side WHEN 'offense' THEN yards_to_goal ELSE 100 - yards_to_goal END AS own FROM ({_SP}))) GROUP BY side, o"""
L31 = f"SELECT side, count(*) AS trips, count(*) FILTER (drive_result = 'TD') AS touchdowns, count(*) FILTER (drive_result = 'FG') AS field_goals, avg(coalesce(drive_result = 'TD', false)::INT) AS td_rate, avg(coalesce(drive_result IN ('TD', 'FG'), false)::INT) AS score_rate FROM (SELECT DISTINCT side, drive_id, offense FROM ({_SP}) WHERE yards_to_goal <= 20) t LEFT JOIN {{drives}} d ON d.id = drive_id AND d.offense = t.offense GROUP BY side"
L32 = f"SELECT player_id, player, position, {_stat(PLAYER_STATS)} FROM {{player_season_stats}} WHERE team = '{TEAM}' AND season = 2017 GROUP BY player_id, player, position"
L33 = f"SELECT season, avg(wins) FILTER (own) AS conf_wins, avg(epa_per_play) FILTER (own) AS conf_epa, avg(wins) AS all_wins, avg(epa_per_play) AS all_epa FROM (SELECT r.season, wins, e.epa_per_play, conference = 'AMERICA' AS own FROM ({K01}) r JOIN ({_K03}) e USING (team, season) WHERE r.season BETWEEN 2016 AND 2020) GROUP BY season"
L35 = f"SELECT season, 'EUROPE' AS conference, 'AMERICA' AS opponent, total_games, conf2_wins AS wins, conf1_wins AS losses, ties, -avg_point_diff AS avg_point_diff FROM ({K27}) WHERE conference_1 = 'AMERICA' AND conference_2 = 'EUROPE' AND season >= 2016"
L36 = K28
L37 = f"SELECT start_yards_to_goal // 10 * 10 AS start_bin, end_yards_to_goal // 10 * 10 AS end_bin, drive_result, count(*) AS drives, avg(plays) AS avg_plays, avg(yards) AS avg_yards FROM {{drives}} WHERE offense = '{TEAM}' AND season = {SEASON} GROUP BY ALL"
L38 = f"""SELECT pc.player_id, name, pc.team, position, pc.season, jersey, height, weight, stars, recruit_rating, national_ranking, recruit_class, {', '.join(k for k in PLAYER_STATS if k not in ('fgm', 'fga'))}, p.wepa AS wepa_passing, r.wepa AS wepa_rushing, k.paar
  FROM ({K20}) pc LEFT JOIN ({K30}) p ON p.athlete_id = pc.player_id AND p.season = pc.season AND p.category = 'passing'
  LEFT JOIN ({K30}) r ON r.athlete_id = pc.player_id AND r.season = pc.season AND r.category = 'rushing' LEFT JOIN ({K30}) k ON k.athlete_id = pc.player_id AND k.season = pc.season AND k.category = 'kicking'
  WHERE pc.player_id = '100' ORDER BY pc.season DESC, pc.team LIMIT 1"""
L39 = f"WITH {SIDES} SELECT k.game_id, week, k.team, opp AS opponent, CASE WHEN at_home THEN 'home' ELSE 'away' END AS side, CASE WHEN pf > pa THEN 'W' WHEN pf < pa THEN 'L' ELSE 'T' END AS result, play_category, plays, total_epa FROM ({_K11}) k JOIN sides s ON s.id = k.game_id AND s.team = k.team WHERE athlete_id = '12' AND k.season = {SEASON}"
L40 = f"SELECT player_id, season, position_group, COLUMNS('.*_pctl') FROM ({K20}) WHERE player_id = '100'"
L41 = f"SELECT * FROM ({_leaders(f'AND season = {SEASON}')}) WHERE category = 'rushing' ORDER BY leader_rank, player_id LIMIT 20"
L42 = f"SELECT year, national_rank, total_points, total_commits, five_stars, four_stars, three_stars, blue_chip_ratio FROM ({_K08}) WHERE team = '{TEAM}'"
L43 = f"SELECT season, avg_class_rank_4yr, blue_chip_ratio, wins, wins_over_expected, players_drafted, win_pct_pctl FROM ({K24}) WHERE team = '{TEAM}'"
L45 = f"SELECT id, name, position, stars, rating, ranking FROM {{recruits}} WHERE committed_to = '{TEAM}' AND year = {SEASON}"
L46 = f"SELECT id, season, week, home_team, away_team, home_points, away_points FROM {{games}} WHERE '{TEAM}' IN (home_team, away_team) AND season = {SEASON} ORDER BY season DESC, week DESC, id LIMIT 50"

for _n in ("L41",):  # only the category's own columns
    globals()[_n] = f"SELECT player_id, player, team, conference, season, {', '.join(LEADERS['rushing'])}, category, leader_rank FROM ({globals()[_n]})"

SQL = {k: v for k, v in globals().items() if k[0] == "L" and k[1:3].isdigit()}
