"""Reference SQL (DuckDB) of the marts, over the adapter's views."""

from ..functions.exprs import CATEGORY_SQL as KIND
from ..functions.exprs import GARBAGE_SQL as GARBAGE
from ..functions.exprs import SCORE_STATE_SQL as STATE

SIDES = """sides AS (
  SELECT *, home_team AS team, away_team AS opp, home_conference AS conf, away_conference AS opp_conf, home_classification AS cls, home_points AS pf, away_points AS pa, true AS at_home FROM {games}
  UNION ALL SELECT *, away_team, home_team, away_conference, home_conference, away_classification, away_points, home_points, false FROM {games})"""

K01 = f"""WITH {SIDES}, rec AS (
  SELECT season, team, max(conf) AS conference, count(*) AS games, count(*) FILTER (pf > pa) AS wins, count(*) FILTER (pf < pa) AS losses,
    count(*) FILTER (conf = opp_conf AND pf > pa) AS conf_wins, count(*) FILTER (conf = opp_conf AND pf < pa) AS conf_losses, avg(pf) AS ppg, avg(pa) AS opp_ppg, avg(pf - pa) AS avg_margin
  FROM sides WHERE completed GROUP BY ALL)
SELECT rec.*, sp.rating AS sp_rating, sp.ranking AS sp_rank, sp.offense_rating AS sp_offense, sp.defense_rating AS sp_defense, elo.elo, fpi.fpi,
  cr.overall AS core_overall, cr.offense AS core_offense, cr.defense AS core_defense, tr.rank AS recruiting_rank, tr.points AS recruiting_points
FROM rec LEFT JOIN {{sp_ratings}} sp ON sp.team = rec.team AND sp.year = season LEFT JOIN {{elo_ratings}} elo ON elo.team = rec.team AND elo.year = season
LEFT JOIN {{fpi_ratings}} fpi ON fpi.team = rec.team AND fpi.year = season LEFT JOIN {{core_ratings}} cr ON cr.team = rec.team AND cr.year = season
LEFT JOIN {{team_recruiting}} tr ON tr.team = rec.team AND tr.year = season"""

K02 = f"""SELECT game_id, offense AS team, avg(ppa) FILTER (NOT g) AS epa_per_play, avg((ppa > 0)::INT) FILTER (NOT g) AS success_rate, avg(ppa) FILTER (NOT g AND ppa > 0) AS explosiveness,
  count(*) FILTER (NOT g) AS plays_non_garbage, count(*) AS plays_total FROM (SELECT *, {GARBAGE} AS g FROM {{plays}} WHERE ppa IS NOT NULL) GROUP BY game_id, offense"""

_K03 = f"""SELECT team, season, round(avg(epa_per_play), 12) AS epa_per_play, avg(success_rate) AS success_rate, avg(explosiveness) AS explosiveness, sum(plays_non_garbage)::BIGINT AS total_plays, count(*) AS games_played,
  CASE WHEN round(avg(epa_per_play), 9) >= 0.16 THEN 'elite' WHEN round(avg(epa_per_play), 9) >= 0.05 THEN 'above_avg' WHEN round(avg(epa_per_play), 9) >= -0.05 THEN 'average' WHEN round(avg(epa_per_play), 9) >= -0.15 THEN 'below_avg' ELSE 'struggling' END AS epa_tier
FROM ({K02}) e JOIN {{games}} g ON g.id = e.game_id GROUP BY team, season"""
K03 = _K03


def _k04() -> str:
    ok = "(ppa > 0)::INT"
    cols = ["count(*) FILTER (ok) AS total_plays", "avg(ppa) FILTER (ok) AS epa_per_play", f"avg({ok}) FILTER (ok) AS success_rate", "count(*) FILTER (ok AND down = 3) AS third_down_attempts"]
    for n, w in ((1, "first"), (2, "second"), (3, "third")):
        cols += [f"avg(ppa) FILTER (ok AND down = {n}) AS {w}_down_epa", f"avg({ok}) FILTER (ok AND down = {n}) AS {w}_down_success"]
    for s, cond in (("short", "distance <= 3"), ("medium", "distance BETWEEN 4 AND 7"), ("long", "distance > 7")):
        cols.append(f"avg({ok}) FILTER (ok AND down = 3 AND {cond}) AS third_{s}_success")
    for w, cond in (("standard", "NOT pd"), ("passing", "pd")):
        cols += [f"avg(ppa) FILTER (ok AND {cond}) AS {w}_down_epa", f"avg({ok}) FILTER (ok AND {cond}) AS {w}_down_success"]
    red, late, two = "ok AND yards_to_goal <= 20", "ok AND period = 4 AND abs(coalesce(score_diff, 0)) <= 8", "ok AND period IN (2, 4) AND coalesce(clock_minutes, 0) < 2"
    cols += [f"count(*) FILTER ({red}) AS red_zone_plays", f"avg(ppa) FILTER ({red}) AS red_zone_epa", f"avg({ok}) FILTER ({red}) AS red_zone_success"]
    cols += ["avg(ppa) FILTER (ok AND yards_to_goal >= 80) AS backed_up_epa", "avg(ppa) FILTER (ok AND yards_to_goal BETWEEN 21 AND 40) AS scoring_position_epa"]
    cols += [f"count(*) FILTER ({late}) AS late_close_plays", f"avg(ppa) FILTER ({late}) AS late_close_epa", f"avg({ok}) FILTER ({late}) AS late_close_success", f"count(*) FILTER ({two}) AS two_minute_plays", f"avg(ppa) FILTER ({two}) AS two_minute_epa"]
    for k in ("rush", "pass"):
        cols += [f"count(*) FILTER (ok AND kind = '{k}') AS {k}_plays", f"avg(ppa) FILTER (ok AND kind = '{k}') AS {k}_epa", f"avg({ok}) FILTER (ok AND kind = '{k}') AS {k}_success"]
    cols.append("count(*) FILTER (ok AND kind = 'rush') / nullif(count(*) FILTER (ok AND kind IN ('rush', 'pass')), 0) AS rush_rate")
    return f"SELECT offense AS team, season, {', '.join(cols)} FROM (SELECT *, NOT {GARBAGE} AS ok, {KIND} AS kind, (down = 2 AND distance >= 8) OR (down = 3 AND distance >= 5) AS pd FROM {{plays}} WHERE ppa IS NOT NULL) GROUP BY offense, season"


K04 = _k04()

K05 = f"""WITH p AS (SELECT *, NOT {GARBAGE} AS ok, play_type ILIKE '%rush%' OR play_type ILIKE '%run%' AS run, coalesce(yards_gained, 0) AS y FROM {{plays}}),
a AS (SELECT defense AS team, season, count(*) FILTER (ok) AS defensive_plays, avg(ppa) FILTER (ok) AS opp_epa_per_play, avg(CASE WHEN ppa > 0 THEN 1.0 ELSE 0.0 END) FILTER (ok) AS opp_success_rate,
  count(*) FILTER (ok AND play_type ILIKE '%sack%') AS sacks, count(*) FILTER (ok AND play_type ILIKE '%interception%') AS interceptions, count(*) FILTER (ok AND play_type ILIKE '%fumble%') AS fumbles,
  count(*) FILTER (ok AND run AND y <= 0) AS stuffs, count(*) FILTER (ok AND run AND y <= 0) / nullif(count(*) FILTER (ok AND run), 0) AS stuff_rate, count(*) FILTER (ok AND y < 0) AS tfls FROM p GROUP BY ALL),
h AS (SELECT team, season, sum(coalesce(total_havoc::DOUBLE, total_havoc_v_double)) AS havoc_plays, sum(coalesce(total_havoc::DOUBLE, total_havoc_v_double)) / nullif(sum(total_plays), 0) AS havoc_rate,
  sum(front_seven_havoc) / nullif(sum(total_plays), 0) AS front_seven_havoc_rate, sum(db_havoc) / nullif(sum(total_plays), 0) AS db_havoc_rate FROM {{game_havoc}} GROUP BY ALL)
SELECT a.*, interceptions + fumbles AS turnovers_forced, havoc_plays, havoc_rate, front_seven_havoc_rate, db_havoc_rate FROM a LEFT JOIN h USING (team, season)"""

K06 = """WITH d AS (SELECT *, drive_result IN ('TD', 'FG') AS sc, drive_result = 'TD' AS td, drive_result IN ('INT', 'FUMBLE') AS lost, drive_result = 'PUNT' AS punt, start_yards_to_goal <= 20 AS rz FROM {drives})
SELECT offense AS team, season, count(*) AS total_drives, count(*) FILTER (sc) AS scoring_drives, avg(sc::INT) AS scoring_rate, count(*) FILTER (td) AS td_drives, avg(td::INT) AS td_rate,
  (count(*) FILTER (td) * 7 + count(*) FILTER (drive_result = 'FG') * 3) / count(*) AS points_per_drive, count(*) FILTER (lost) AS turnover_drives, avg(lost::INT) AS turnover_rate,
  count(*) FILTER (punt) AS punt_drives, avg(punt::INT) AS punt_rate, avg(plays) AS avg_plays_per_drive, avg(yards) AS avg_yards_per_drive, avg(elapsed_minutes) AS avg_time_per_drive,
  count(*) FILTER (rz) AS red_zone_drives, count(*) FILTER (rz AND sc) AS red_zone_scores, count(*) FILTER (rz AND sc) / nullif(count(*) FILTER (rz), 0) AS red_zone_scoring_rate, count(*) FILTER (rz AND td) / nullif(count(*) FILTER (rz), 0) AS red_zone_td_rate
FROM d GROUP BY offense, season"""

K07 = """WITH p AS (SELECT *, least(home_team, away_team) AS team1, greatest(home_team, away_team) AS team2, CASE WHEN home_team < away_team THEN home_points - away_points ELSE away_points - home_points END AS m,
  CASE WHEN home_team < away_team THEN home_points ELSE away_points END AS p1, CASE WHEN home_team < away_team THEN away_points ELSE home_points END AS p2 FROM {games} WHERE completed)
SELECT team1, team2, count(*) AS total_games, count(*) FILTER (m > 0) AS team1_wins, count(*) FILTER (m < 0) AS team2_wins, count(*) FILTER (m = 0) AS ties, min(season) AS first_meeting_year, max(season) AS last_meeting_year,
  min(start_date) AS first_meeting_date, max(start_date) AS last_meeting_date, avg(abs(m)) AS avg_margin, max(abs(m)) AS largest_margin, avg(m) AS team1_avg_margin, sum(p1)::BIGINT AS team1_total_points, sum(p2)::BIGINT AS team2_total_points,
  count(*) FILTER (season >= 2015 AND m > 0) AS team1_wins_recent, count(*) FILTER (season >= 2015 AND m < 0) AS team2_wins_recent, count(*) FILTER (season >= 2015) AS games_recent,
  last({'w': CASE WHEN m > 0 THEN team1 WHEN m < 0 THEN team2 END} ORDER BY start_date, id)['w'] AS last_winner FROM p GROUP BY team1, team2"""

_K08 = """WITH r AS (SELECT committed_to AS team, year, stars, rating, ranking, CASE position WHEN 'QB' THEN 'qb' WHEN 'RB' THEN 'rb' WHEN 'WR' THEN 'receiver' WHEN 'TE' THEN 'receiver' WHEN 'OT' THEN 'oline' WHEN 'EDGE' THEN 'dline'
    WHEN 'LB' THEN 'lb' WHEN 'CB' THEN 'db' WHEN 'K' THEN 'specialist' ELSE 'ath' END AS grp FROM {recruits} WHERE committed_to IS NOT NULL),
top AS (SELECT team, year, grp AS top_position_group FROM r GROUP BY team, year, grp QUALIFY row_number() OVER (PARTITION BY team, year ORDER BY count(*) DESC, grp) = 1)
SELECT r.team, r.year, top_position_group, tr.rank AS national_rank, tr.points AS total_points, count(*) AS total_commits, count(*) FILTER (stars = 5) AS five_stars, count(*) FILTER (stars = 4) AS four_stars, count(*) FILTER (stars = 3) AS three_stars,
  count(*) FILTER (stars = 2) AS two_stars, count(*) FILTER (stars IS NULL OR stars < 2) AS unrated, count(*) FILTER (stars >= 4) / count(*) AS blue_chip_ratio, avg(rating) AS avg_rating, max(rating) AS top_rating, min(ranking) AS best_recruit_rank,
  count(*) FILTER (grp = 'qb') AS qb_commits, count(*) FILTER (grp = 'rb') AS rb_commits, count(*) FILTER (grp = 'receiver') AS receiver_commits, count(*) FILTER (grp = 'oline') AS oline_commits, count(*) FILTER (grp = 'dline') AS dline_commits,
  count(*) FILTER (grp = 'lb') AS lb_commits, count(*) FILTER (grp = 'db') AS db_commits
FROM r JOIN top USING (team, year) LEFT JOIN {team_recruiting} tr ON tr.team = r.team AND tr.year = r.year GROUP BY ALL"""
K08 = _K08

K09 = """WITH c AS (SELECT first_name || ' ' || last_name AS coach_name, first_name, last_name, school AS team, min(year) AS first_season, max(year) AS last_season, count(DISTINCT year) AS seasons_at_team, sum(games)::BIGINT AS total_games,
  sum(wins)::BIGINT AS total_wins, sum(losses)::BIGINT AS total_losses, sum(coalesce(ties, 0))::BIGINT AS total_ties, min(preseason_rank) AS best_preseason_rank, min(postseason_rank) AS best_postseason_rank, avg(sp_overall) AS avg_sp_rating FROM {coach_seasons} GROUP BY ALL)
SELECT c.*, total_wins / nullif(total_wins + total_losses, 0) AS win_pct, (SELECT avg(rank) FROM {team_recruiting} t WHERE t.team = c.team AND t.year BETWEEN first_season AND last_season) AS avg_recruiting_rank FROM c"""

K10 = f"""SELECT id AS play_id, game_id, drive_id, season, offense, defense, down, distance, yards_to_goal, yards_gained, play_type, scoring, period, score_diff, ppa AS epa, (ppa > 0)::BIGINT AS success, (ppa > 0.5)::BIGINT AS explosive,
  ['first', 'second', 'third', 'fourth'][down] AS down_name, CASE WHEN distance <= 3 THEN 'short' WHEN distance <= 7 THEN 'medium' ELSE 'long' END AS distance_bucket,
  CASE WHEN yards_to_goal <= 20 THEN 'red_zone' WHEN yards_to_goal <= 40 THEN 'opponent_territory' WHEN yards_to_goal <= 60 THEN 'midfield' ELSE 'own_territory' END AS field_position, {GARBAGE} AS is_garbage_time, {KIND} AS play_category
FROM {{plays}} WHERE ppa IS NOT NULL AND play_type NOT IN ('Timeout', 'End Period', 'End of Half', 'End of Game', 'Kickoff', 'Kickoff Return (Offense)')"""

_K11 = f"""SELECT w.game_id, p.season, w.team, n.player_name, w.athlete_id, w.play_category, count(*) AS plays, sum(epa) AS total_epa, avg(epa) AS epa_per_play, avg(success) AS success_rate, sum(explosive)::BIGINT AS explosive_plays, sum(yards_gained)::BIGINT AS total_yards
FROM (SELECT DISTINCT game_id, play_id, athlete_id, team, CASE stat_type WHEN 'Rush' THEN 'rushing' WHEN 'Reception' THEN 'receiving' WHEN 'Target' THEN 'receiving' WHEN 'Completion' THEN 'passing' WHEN 'Incompletion' THEN 'passing' END AS play_category FROM {{play_stats}} WHERE stat_type <> 'Sack') w
JOIN ({K10}) p ON p.game_id = w.game_id AND p.play_id = w.play_id AND p.offense = w.team AND NOT p.is_garbage_time
JOIN (SELECT game_id, athlete_id, max(athlete_name) AS player_name FROM {{play_stats}} GROUP BY ALL) n ON n.game_id = w.game_id AND n.athlete_id = w.athlete_id
GROUP BY w.game_id, p.season, w.team, n.player_name, w.athlete_id, w.play_category HAVING count(*) >= 3"""
K11 = _K11

K12 = f"""SELECT season, team, athlete_id, play_category, max(player_name) AS player_name, count(DISTINCT game_id) AS games, sum(plays)::BIGINT AS total_plays, sum(total_epa) AS total_epa, sum(total_epa) / sum(plays) AS epa_per_play, sum(plays * success_rate) / sum(plays) AS success_rate,
  sum(explosive_plays)::BIGINT AS explosive_plays, sum(total_yards)::BIGINT AS total_yards, sum(plays) / count(DISTINCT game_id) AS plays_per_game, rank() OVER (PARTITION BY season, play_category ORDER BY round(sum(total_epa), 9) DESC) AS epa_rank
FROM ({_K11}) GROUP BY season, team, athlete_id, play_category HAVING sum(plays) >= 20"""

ERA = "season >= e.start_year AND season <= coalesce(e.end_year, 9999)"

K13 = f"""WITH {SIDES}, cls AS (SELECT team, season, max(cls) AS division FROM sides GROUP BY ALL), e3 AS ({_K03}), rec AS ({K01}), hav AS ({K05}),
m AS (SELECT e3.* EXCLUDE (explosiveness), rec.wins, rec.losses, rec.conf_wins, rec.conf_losses, rec.recruiting_rank, rec.recruiting_points, rec.wins / nullif(rec.wins + rec.losses, 0) AS win_pct,
  rank() OVER (PARTITION BY season, division ORDER BY round(e3.epa_per_play, 9) DESC NULLS FIRST) AS off_epa_rank, rank() OVER (PARTITION BY season, division ORDER BY coalesce(round(opp_epa_per_play, 9), 999.0)) AS def_epa_rank
  FROM e3 LEFT JOIN cls USING (team, season) LEFT JOIN rec USING (team, season) LEFT JOIN (SELECT team, season, opp_epa_per_play FROM hav) USING (team, season))
SELECT m.*, (SELECT min(e.code) FROM {{eras}} e WHERE {ERA}) AS era_code, (SELECT arg_min(e.name, e.code) FROM {{eras}} e WHERE {ERA}) AS era_name, lag(epa_per_play) OVER w AS prev_epa, epa_per_play - lag(epa_per_play) OVER w AS epa_delta, lag(win_pct) OVER w AS prev_win_pct,
  win_pct - lag(win_pct) OVER w AS win_pct_delta, lag(recruiting_rank) OVER w AS prev_recruiting_rank, lag(recruiting_rank) OVER w - recruiting_rank AS recruiting_rank_improvement FROM m WINDOW w AS (PARTITION BY team ORDER BY season)"""

K14 = f"""WITH s AS (SELECT e.code AS era_code, e.name AS era_name, x.season, home_conference AS conference, avg(epa_per_play) AS epa, avg(success_rate) AS success, count(DISTINCT team) AS teams
  FROM ({_K03}) x JOIN {{games}} g ON g.home_team = x.team AND g.season = x.season JOIN {{eras}} e ON x.{ERA.replace('AND season', 'AND x.season')} GROUP BY ALL)
SELECT era_code, era_name, conference, count(DISTINCT season) AS seasons, avg(epa) AS avg_epa, avg(success) AS avg_success_rate, avg(teams) AS avg_teams, max(epa) AS best_season_epa, min(epa) AS worst_season_epa, rank() OVER (PARTITION BY era_code ORDER BY round(avg(epa), 9) DESC) AS era_rank FROM s GROUP BY era_code, era_name, conference"""

_K15 = f"""SELECT a.*, def_epa_vs_run, def_epa_vs_pass, def_epa_allowed, CASE WHEN plays_per_game >= 75 THEN 'up_tempo' WHEN plays_per_game >= 65 THEN 'balanced' ELSE 'slow' END AS tempo_category,
  CASE WHEN run_rate >= 0.55 THEN 'run_heavy' WHEN pass_rate >= 0.55 THEN 'pass_heavy' ELSE 'balanced' END AS offensive_identity,
  CASE WHEN round(def_epa_vs_run, 9) < round(def_epa_vs_pass, 9) THEN 'run_stopper' WHEN round(def_epa_vs_pass, 9) < round(def_epa_vs_run, 9) THEN 'pass_stopper' ELSE 'balanced_defense' END AS defensive_identity
FROM (SELECT season, offense AS team, avg((play_category = 'rush')::INT) AS run_rate, avg((play_category = 'pass')::INT) AS pass_rate, avg(epa) FILTER (play_category = 'rush') AS epa_rushing, avg(epa) FILTER (play_category = 'pass') AS epa_passing,
  avg(success) FILTER (play_category = 'rush') AS rush_success_rate, avg(success) FILTER (play_category = 'pass') AS pass_success_rate, count(*) / count(DISTINCT game_id) AS plays_per_game FROM ({K10}) WHERE NOT is_garbage_time GROUP BY season, offense) a
LEFT JOIN (SELECT season, defense AS team, avg(epa) FILTER (play_category = 'rush') AS def_epa_vs_run, avg(epa) FILTER (play_category = 'pass') AS def_epa_vs_pass, avg(epa) AS def_epa_allowed FROM ({K10}) WHERE NOT is_garbage_time GROUP BY season, defense) d USING (season, team)"""
K15 = _K15

K16 = f"""WITH st AS ({_K15}) SELECT g.season, g.id AS game_id, home_team AS a_team, away_team AS b_team, home_points AS a_points, away_points AS b_points, a.run_rate AS a_run_rate, b.run_rate AS b_run_rate, a.offensive_identity AS a_offensive_identity, b.offensive_identity AS b_offensive_identity,
  a.tempo_category AS a_tempo_category, b.tempo_category AS b_tempo_category, a.epa_rushing - b.def_epa_vs_run AS a_rush_edge, a.epa_passing - b.def_epa_vs_pass AS a_pass_edge, b.epa_rushing - a.def_epa_vs_run AS b_rush_edge, b.epa_passing - a.def_epa_vs_pass AS b_pass_edge,
  abs(a.plays_per_game - b.plays_per_game) AS tempo_mismatch,
  (a.epa_rushing - b.def_epa_vs_run) * a.run_rate + (a.epa_passing - b.def_epa_vs_pass) * a.pass_rate - (b.epa_rushing - a.def_epa_vs_run) * b.run_rate - (b.epa_passing - a.def_epa_vs_pass) * b.pass_rate AS net_edge_a,
  CASE WHEN home_points > away_points THEN 'team_a' WHEN home_points < away_points THEN 'team_b' ELSE 'tie' END AS actual_winner, home_points - away_points AS actual_margin
FROM {{games}} g JOIN st a ON a.season = g.season AND a.team = home_team JOIN st b ON b.season = g.season AND b.team = away_team WHERE completed AND g.season >= 2014"""

K17 = """WITH r AS (SELECT r.team, r.year AS season, stars, rating FROM {rosters} r LEFT JOIN {recruits} x ON x.athlete_id = r.id AND x.year BETWEEN r.year - 5 AND r.year),
a AS (SELECT team, season, count(*) AS roster_size, count(*) FILTER (stars = 5) AS five_stars, count(*) FILTER (stars = 4) AS four_stars, count(*) FILTER (stars = 3) AS three_stars, count(*) FILTER (stars <= 2 OR stars IS NULL) AS low_stars,
  count(*) FILTER (stars >= 4) / count(*) AS blue_chip_ratio, avg(rating) AS avg_recruit_rating FROM r GROUP BY ALL),
m AS (SELECT destination AS team, season, count(*) AS transfers_in, avg(stars) AS avg_transfer_stars FROM {transfer_portal} WHERE destination IS NOT NULL GROUP BY ALL)
SELECT a.*, coalesce(transfers_in, 0) AS transfers_in, avg_transfer_stars, (five_stars * 5 + four_stars * 4 + three_stars * 3 + low_stars * 2) / roster_size AS talent_score FROM a LEFT JOIN m USING (team, season)"""

K19 = f"""WITH g AS (SELECT season, offense AS team, game_id, count(*) AS plays FROM {{plays}} WHERE play_type NOT IN ('Timeout', 'End Period', 'End of Half', 'End of Game', 'Kickoff') AND NOT {GARBAGE} AND season >= 2014 GROUP BY ALL)
SELECT a.*, epa_per_play, success_rate, explosiveness FROM (SELECT season, team, count(*) AS games, sum(plays)::BIGINT AS total_plays, avg(plays) AS plays_per_game, CASE WHEN avg(plays) >= 75 THEN 'up_tempo' WHEN avg(plays) >= 65 THEN 'balanced' ELSE 'slow' END AS tempo_tier FROM g GROUP BY ALL HAVING count(*) >= 5) a
LEFT JOIN ({_K03}) e USING (season, team)"""

_CELLS = f"SELECT *, offense AS team, {STATE} AS score_diff_bucket FROM ({K10}) WHERE NOT is_garbage_time AND play_category IN ('rush', 'pass')"
_KEYS = "team, season, down, distance_bucket, field_position, score_diff_bucket"
K21 = f"SELECT {_KEYS}, count(*) AS total_plays, count(*) FILTER (play_category = 'rush') AS rush_plays, count(*) FILTER (play_category = 'pass') AS pass_plays, avg((play_category = 'rush')::INT) AS run_rate, avg((play_category = 'pass')::INT) AS pass_rate FROM ({_CELLS}) GROUP BY ALL"


def _k22() -> str:
    cols = ["count(*) AS total_plays", *[f"CASE WHEN count(*) >= 10 THEN avg({x}) END AS {y}" for x, y in (("success", "success_rate"), ("epa", "avg_epa"), ("explosive", "explosive_rate"))]]
    for k in ("rush", "pass"):
        f = f"FILTER (play_category = '{k}')"
        cols += [f"CASE WHEN count(*) {f} >= 10 THEN avg({x}) {f} END AS {k}_{y}" for x, y in (("success", "success_rate"), ("epa", "avg_epa"))]
    cols.append("CASE WHEN down IN (3, 4) AND count(*) >= 10 THEN avg((yards_gained >= distance)::INT) END AS yardage_success_rate")
    return f"SELECT {_KEYS}, {', '.join(cols)} FROM ({_CELLS}) GROUP BY {_KEYS}"


K22 = _k22()

K23 = f"""WITH {SIDES}, cs AS (SELECT first_name || ' ' || last_name AS coach_name, first_name, last_name, school AS team, c.* EXCLUDE (first_name, last_name, school),
  year - lag(year) OVER (PARTITION BY first_name, last_name, school ORDER BY year) AS gap FROM {{coach_seasons}} c),
grp AS (SELECT *, CAST(sum(CASE WHEN gap <= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY first_name, last_name, team ORDER BY year) AS BIGINT) AS tenure_id FROM cs),
sp AS (SELECT coach_name, first_name, last_name, team, tenure_id, min(year) AS tenure_start, max(year) AS tenure_end, count(DISTINCT year) AS seasons_count, sum(games)::BIGINT AS total_games, sum(wins)::BIGINT AS total_wins, sum(losses)::BIGINT AS total_losses,
  sum(coalesce(ties, 0))::BIGINT AS total_ties, max(wins) AS best_season_wins, min(wins) AS worst_season_wins, min(preseason_rank) AS best_preseason_rank, min(postseason_rank) AS best_postseason_rank, avg(sp_overall) AS avg_sp_rating, max(sp_overall) AS peak_sp_rating FROM grp GROUP BY ALL),
yr AS (SELECT team, season, count(*) FILTER (conf = opp_conf AND pf > pa) AS cw, count(*) FILTER (conf = opp_conf AND pf < pa) AS cl, count(*) FILTER (season_type = 'postseason') AS bg, count(*) FILTER (season_type = 'postseason' AND pf > pa) AS bw FROM sides WHERE completed GROUP BY ALL),
rk AS (SELECT DISTINCT r.committed_to AS team, r.year, t.rank FROM {{recruits}} r LEFT JOIN {{team_recruiting}} t ON t.team = r.committed_to AND t.year = r.year WHERE committed_to IS NOT NULL)
SELECT *, inherited_talent_rank - year3_talent_rank AS talent_improvement, total_wins / nullif(total_wins + total_losses, 0) AS win_pct, conf_wins / nullif(conf_wins + conf_losses, 0) AS conf_win_pct, tenure_end >= (SELECT max(year) FROM {{coach_seasons}}) - 1 AS is_active FROM (SELECT sp.*, (SELECT sum(cw) FROM yr WHERE yr.team = sp.team AND season BETWEEN tenure_start AND tenure_end)::BIGINT AS conf_wins, (SELECT sum(cl) FROM yr WHERE yr.team = sp.team AND season BETWEEN tenure_start AND tenure_end)::BIGINT AS conf_losses,
  coalesce((SELECT sum(bg) FROM yr WHERE yr.team = sp.team AND season BETWEEN tenure_start AND tenure_end), 0)::BIGINT AS bowl_games, coalesce((SELECT sum(bw) FROM yr WHERE yr.team = sp.team AND season BETWEEN tenure_start AND tenure_end), 0)::BIGINT AS bowl_wins,
  (SELECT avg(rank) FROM rk WHERE rk.team = sp.team AND year BETWEEN tenure_start AND tenure_end) AS avg_recruiting_rank, (SELECT min(rank) FROM rk WHERE rk.team = sp.team AND year BETWEEN tenure_start AND tenure_end) AS best_recruiting_rank,
  (SELECT max(rank) FROM rk WHERE rk.team = sp.team AND year = tenure_start) AS inherited_talent_rank, CASE WHEN seasons_count >= 3 THEN (SELECT max(rank) FROM rk WHERE rk.team = sp.team AND year = tenure_start + 2) END AS year3_talent_rank FROM sp)"""

SQL = {k: v for k, v in globals().items() if k[0] == "K" and k[1:].isdigit()}
