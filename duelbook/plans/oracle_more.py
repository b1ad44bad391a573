"""Reference SQL (DuckDB) of the second part of the marts."""

from .marts_more import INFRACTIONS, PLAYER_STATS, POSITION_GROUPS, TRACKED
from .oracle_marts import _K03, _K08, K01, SIDES

_COVER = {"games": "season", "plays": "season", "drives": "season", "player_season_stats": "season", "sp_ratings": "year", "recruits": "year", "rosters": "year"}
K18 = " UNION ALL ".join(
    [f"SELECT 'coverage' AS check_type, '{n}' AS metric, min({y})::VARCHAR AS value_1, max({y})::VARCHAR AS value_2, count(*)::VARCHAR AS value_3, NULL::VARCHAR AS notes FROM {{{n}}}" for n, y in _COVER.items()]
    + [f"SELECT 'integrity', '{n}_without_games', b::VARCHAR, n::VARCHAR, (floor(100 * b / n)::BIGINT)::VARCHAR || '%', CASE WHEN b > 0 THEN 'WARNING: orphan {n}' ELSE 'OK' END FROM (SELECT count(*) FILTER (game_id NOT IN (SELECT id FROM {{games}})) AS b, count(*) AS n FROM {{{n}}})" for n in ("plays", "drives")]
)

_STATS = ", ".join(f"max(nullif(stat, '')::DOUBLE) FILTER (category = '{a}' AND stat_type = '{b}') AS {n}" for n, (a, b) in PLAYER_STATS.items() if n not in ("fgm", "fga"))
_GROUP = "CASE " + " ".join(f"WHEN position IN ({', '.join(repr(p) for p in ps)}) THEN '{g}'" for g, ps in POSITION_GROUPS.items()) + " END"
_PCT = ", ".join(f"CASE WHEN position_group IS NOT NULL THEN percent_rank() OVER (PARTITION BY season, position_group ORDER BY {m} NULLS FIRST) END AS {m}_pctl" for m in ("pass_yds", "pass_td", "rush_yds", "rush_td", "rec_yds", "rec_td", "tackles", "sacks", "tfl"))
K20 = f"""WITH p AS (SELECT player_id, player AS name, team, position, season, {_STATS} FROM {{player_season_stats}} GROUP BY ALL),
one AS (SELECT * FROM {{rosters}} QUALIFY row_number() OVER (PARTITION BY id, year, team ORDER BY last_name) = 1), alt AS (SELECT * FROM {{rosters}} QUALIFY row_number() OVER (PARTITION BY id, year ORDER BY team, last_name) = 1),
rec AS (SELECT * FROM {{recruits}} WHERE athlete_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY rating DESC NULLS LAST, id) = 1),
j AS (SELECT p.*, {_GROUP.replace('position IN', 'p.position IN')} AS position_group, CASE WHEN one.id IS NOT NULL THEN one.height ELSE alt.height END AS height, CASE WHEN one.id IS NOT NULL THEN one.weight ELSE alt.weight END AS weight,
  CASE WHEN one.id IS NOT NULL THEN one.jersey ELSE alt.jersey END AS jersey, rec.stars, rec.rating AS recruit_rating, rec.ranking AS national_ranking, rec.year AS recruit_class
  FROM p LEFT JOIN one ON one.id = player_id AND one.year = season AND one.team = p.team LEFT JOIN alt ON alt.id = player_id AND alt.year = season LEFT JOIN rec ON rec.athlete_id = player_id)
SELECT *, {_PCT} FROM j"""

K24 = f"""WITH tss AS ({K01}), rc AS ({_K08}), e AS ({_K03}),
rr AS (SELECT tss.team, tss.season, avg(national_rank) AS avg_class_rank_4yr, avg(rc.total_points) AS avg_class_points_4yr, sum(five_stars + four_stars)::BIGINT AS total_blue_chips_4yr, sum(five_stars + four_stars) / nullif(sum(total_commits), 0) AS blue_chip_ratio
  FROM tss JOIN rc ON rc.team = tss.team AND rc.year BETWEEN tss.season - 4 AND tss.season - 1 GROUP BY ALL HAVING count(*) >= 2),
x AS (SELECT tss.team, tss.season, tss.conference, wins, losses, games, sp_rating, sp_rank, rr.* EXCLUDE (team, season), epa_per_play, success_rate, CASE WHEN avg_class_rank_4yr <= 10 THEN 'elite' WHEN avg_class_rank_4yr <= 25 THEN 'high' WHEN avg_class_rank_4yr <= 50 THEN 'mid' ELSE 'low' END AS talent_bucket
  FROM tss JOIN rr ON rr.team = tss.team AND rr.season = tss.season LEFT JOIN e ON e.team = tss.team AND e.season = tss.season),
d AS (SELECT college_team AS team, year AS season, count(*) AS n, sum(greatest(260 - coalesce(overall, 260), 0))::BIGINT AS v FROM {{draft_picks}} GROUP BY ALL),
c AS (SELECT x.* EXCLUDE (games), coalesce(n, 0) AS players_drafted, coalesce(v, 0) AS draft_picks_value, wins / nullif(games, 0) AS win_pct, wins - quantile_cont(wins, 0.5) OVER b AS wins_over_expected, epa_per_play - quantile_cont(epa_per_play, 0.5) OVER b AS epa_over_expected,
  wins / nullif(avg_class_rank_4yr, 0) AS recruiting_efficiency FROM x LEFT JOIN d USING (team, season) WINDOW b AS (PARTITION BY x.season, talent_bucket))
SELECT *, CASE WHEN win_pct IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY win_pct NULLS LAST) END AS win_pct_pctl, CASE WHEN recruiting_efficiency IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY recruiting_efficiency NULLS LAST) END AS recruiting_efficiency_pctl FROM c"""

K25 = f"""WITH tss AS ({K01}), i AS (SELECT destination AS team, season, count(*) AS n_in, avg(stars) AS avg_incoming_stars, avg(rating) AS avg_incoming_rating, count(*) FILTER (stars >= 4) AS hi FROM {{transfer_portal}} WHERE destination IS NOT NULL GROUP BY ALL),
o AS (SELECT origin AS team, season, count(*) AS n_out FROM {{transfer_portal}} GROUP BY ALL), r AS (SELECT team, year AS season, count(*) AS n FROM {{rosters}} GROUP BY ALL),
p AS (SELECT team, season, conference, wins AS current_wins, sp_rating AS current_sp_rating, lag(wins) OVER w AS prior_season_wins, lag(sp_rating) OVER w AS prior_season_sp_rating FROM tss WINDOW w AS (PARTITION BY team ORDER BY season)),
c AS (SELECT p.*, coalesce(n_in, 0) AS transfers_in, coalesce(n_out, 0) AS transfers_out, coalesce(n_in, 0) - coalesce(n_out, 0) AS net_transfers, avg_incoming_stars, avg_incoming_rating, coalesce(hi, 0) AS incoming_high_stars, current_wins - prior_season_wins AS win_delta,
  current_sp_rating - prior_season_sp_rating AS sp_delta, coalesce(n_in, 0) / r.n AS portal_dependency, (current_wins - prior_season_wins) / nullif(n_in, 0) AS win_delta_per_transfer_in
  FROM p LEFT JOIN i USING (team, season) LEFT JOIN o USING (team, season) LEFT JOIN r USING (team, season) WHERE prior_season_wins IS NOT NULL AND (n_in IS NOT NULL OR n_out IS NOT NULL))
SELECT *, percent_rank() OVER (PARTITION BY season ORDER BY net_transfers) AS net_transfers_pctl, percent_rank() OVER (PARTITION BY season ORDER BY win_delta) AS win_delta_pctl, CASE WHEN portal_dependency IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY portal_dependency NULLS LAST) END AS portal_dependency_pctl FROM c"""

K26 = f"""WITH {SIDES}, tss AS ({K01}), e AS ({_K03}), rc AS ({_K08}), tc AS (SELECT school AS team, conference AS conf FROM {{teams}} WHERE conference IS NOT NULL),
nc AS (SELECT conf AS conference, season, avg((pf > pa)::INT) AS non_conf_win_pct FROM sides WHERE completed AND conf <> opp_conf GROUP BY ALL),
a AS (SELECT tc.conf AS conference, tss.season, count(DISTINCT tss.team) AS member_count, avg(wins) AS avg_wins, avg(sp_rating) AS avg_sp_rating, quantile_cont(sp_rating, 0.5) AS median_sp_rating, first(tss.team ORDER BY sp_rating DESC NULLS LAST, tss.team) AS best_team, max(sp_rating) AS best_team_sp,
  first(tss.team ORDER BY sp_rating NULLS LAST, tss.team) AS worst_team, min(sp_rating) AS worst_team_sp, stddev_samp(sp_rating) AS std_dev_sp, avg(epa_per_play) AS avg_epa_per_play, avg(success_rate) AS avg_success_rate, avg(national_rank) AS avg_recruiting_rank,
  sum(five_stars + four_stars)::BIGINT AS total_blue_chips, avg(blue_chip_ratio) AS avg_blue_chip_ratio, count(*) FILTER (sp_rank <= 25) AS ranked_team_count
  FROM tss JOIN tc ON tc.team = tss.team LEFT JOIN e ON e.team = tss.team AND e.season = tss.season LEFT JOIN rc ON rc.team = tss.team AND rc.year = tss.season GROUP BY tc.conf, tss.season HAVING count(DISTINCT tss.team) >= 4)
SELECT a.*, non_conf_win_pct, CASE WHEN avg_sp_rating IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY avg_sp_rating NULLS LAST) END AS avg_sp_pctl, CASE WHEN non_conf_win_pct IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY non_conf_win_pct NULLS LAST) END AS non_conf_win_pct_pctl,
  CASE WHEN avg_recruiting_rank IS NOT NULL THEN percent_rank() OVER (PARTITION BY season ORDER BY avg_recruiting_rank DESC NULLS FIRST) END AS avg_recruiting_pctl FROM a LEFT JOIN nc USING (conference, season)"""

K27 = f"""WITH {SIDES} SELECT conf AS conference_1, opp_conf AS conference_2, season, count(*) AS total_games, count(*) FILTER (pf > pa) AS conf1_wins, count(*) FILTER (pf < pa) AS conf2_wins, count(*) FILTER (pf = pa) AS ties,
  avg((pf > pa)::INT) AS conf1_win_pct, avg(pf - pa) AS avg_point_diff FROM sides WHERE completed AND conf < opp_conf GROUP BY ALL"""

_NAMES = list(TRACKED)[:-1]
K28 = f"""WITH n AS (SELECT unnest({list(TRACKED)}) AS table_name, unnest({list(TRACKED.values())}) AS cadence),
l AS (SELECT {_NAMES}[user_id % {len(_NAMES)} + 1] AS table_name, max(ts - to_days(((user_id % {len(_NAMES)}) * 20)::INT)) AS last_activity, arg_max(event_id, (ts - to_days(((user_id % {len(_NAMES)}) * 20)::INT), -event_id)) AS row_count FROM {{events}} GROUP BY 1)
SELECT table_name, cadence, coalesce(row_count, 0) AS row_count, last_activity, (epoch(TIMESTAMP '2024-02-01')::BIGINT - floor(epoch(last_activity))::BIGINT) / 86400 AS days_since_activity,
  CASE cadence WHEN 'weekly' THEN last_activity IS NULL OR days_since_activity > 14 WHEN 'seasonal' THEN last_activity IS NULL OR days_since_activity > 90 ELSE false END AS is_stale FROM n LEFT JOIN l USING (table_name)"""

K29 = "SELECT year AS season, team, conference, epa, epa_allowed, success_rate, epa - epa_allowed AS net_epa, rank() OVER (PARTITION BY year ORDER BY epa DESC) AS offense_rank, rank() OVER (PARTITION BY year ORDER BY epa_allowed) AS defense_rank FROM {team_wepa}"
K30 = """SELECT athlete_id, athlete_name, team, year AS season, category, CASE WHEN category <> 'kicking' THEN wepa END AS wepa, CASE WHEN category <> 'kicking' THEN plays END AS plays, CASE WHEN category = 'kicking' THEN wepa END AS paar, CASE WHEN category = 'kicking' THEN plays END AS attempts,
  rank() OVER (PARTITION BY year, category ORDER BY wepa DESC NULLS LAST) AS category_rank FROM {player_wepa}"""
K31 = "SELECT season, team, conference, coalesce(total_ppa, total_ppa_v_double) AS total_ppa, percent_ppa, rank() OVER (PARTITION BY season ORDER BY percent_ppa DESC) AS returning_rank FROM {returning_production}"
K32 = "SELECT id, season, team, name, coalesce(usage_overall, usage_overall_v_double) AS usage_overall FROM {player_usage}"
K33 = "SELECT year AS season, team, conference, games, ats_wins, ats_losses, ats_pushes, ats_wins / nullif(ats_wins + ats_losses, 0) AS cover_pct FROM {team_ats}"
K34 = """WITH s AS (SELECT home_team AS team, season, home_postgame_elo AS elo, start_date, game_id FROM {house_elo_game} UNION ALL SELECT away_team, season, away_postgame_elo, start_date, game_id FROM {house_elo_game}),
l AS (SELECT team, season, elo, start_date AS last_game, count(*) OVER (PARTITION BY team, season) AS games FROM s QUALIFY row_number() OVER (PARTITION BY team, season ORDER BY start_date DESC, game_id DESC) = 1)
SELECT *, rank() OVER (PARTITION BY season ORDER BY elo DESC) AS elo_rank, games < 4 AS low_confidence FROM l"""
K35 = """SELECT game_id, season, week, season_type, home_team, away_team, home_pregame_elo, away_pregame_elo, home_postgame_elo, away_postgame_elo, expected_home_margin, actual_home_margin, actual_home_margin - expected_home_margin AS margin_error, abs(actual_home_margin - expected_home_margin) AS abs_margin_error FROM {house_elo_game}"""

_LATEST = """SELECT p.*, g.week, g.home_team, g.away_team, g.home_points, g.away_points, g.start_date, g.completed, expected_margin + market_spread AS edge, CASE WHEN expected_margin + market_spread >= 0 THEN 'home' WHEN expected_margin + market_spread < 0 THEN 'away' END AS edge_pick
  FROM {game_predictions} p JOIN {games} g ON g.id = p.game_id QUALIFY row_number() OVER (PARTITION BY p.game_id, model_version ORDER BY prediction_day DESC) = 1"""
K37 = f"SELECT game_id, season, week, start_date, home_team, away_team, model_version, prediction_day, expected_margin, home_win_prob, market_spread, edge, edge_pick, abs(edge) AS abs_edge FROM ({_LATEST}) WHERE NOT completed"
K38 = f"""WITH s AS (SELECT *, (home_points - away_points)::DOUBLE AS m, CASE WHEN home_points > away_points THEN 1.0 WHEN home_points = away_points THEN 0.5 ELSE 0.0 END AS res FROM ({_LATEST}) WHERE completed),
x AS (SELECT *, m + market_spread AS cov, (edge_pick = 'home' AND m + market_spread > 0) OR (edge_pick = 'away' AND m + market_spread < 0) AS won FROM s, (SELECT unnest([0, 3, 6, 10])::BIGINT AS edge_threshold) WHERE edge_threshold = 0 OR abs(edge) >= edge_threshold)
SELECT model_version, season, edge_threshold, count(*) AS n_games, count(market_spread) AS n_with_market, avg(abs(expected_margin - m)) AS margin_mae, sqrt(avg((expected_margin - m) ** 2)) AS margin_rmse, count(*) FILTER (cov <> 0 AND won) AS ats_wins, count(*) FILTER (cov <> 0 AND NOT won) AS ats_losses,
  count(*) FILTER (cov = 0) AS ats_pushes, avg((home_win_prob - res::DOUBLE) ** 2) AS brier, count(home_win_prob) AS n_scored_win_prob, count(*) FILTER (cov <> 0 AND won) / nullif(count(*) FILTER (cov <> 0), 0) AS ats_hit_rate FROM x GROUP BY model_version, season, edge_threshold"""

_LABEL = "CASE " + " ".join(f"WHEN play_text ILIKE '{p}' THEN '{x}'" for x, p in INFRACTIONS) + " END"


def _hit(side: str, tag: str) -> str:
    n = f"lower({side})"
    t = "lower(play_text)"
    return f"(contains({t}, {n} || ' penalty') OR contains({t}, 'penalty ' || {n} || ' ') OR coalesce(contains({t}, 'penalty ' || lower({tag}.abbreviation) || ' ') OR contains({t}, 'penalty on ' || lower({tag}.abbreviation) || '-') OR contains({t}, 'penalty ' || lower({tag}.mascot) || ' '), false))"


K41 = f"""WITH d AS (SELECT school, abbreviation, mascot FROM {{teams}} QUALIFY row_number() OVER (PARTITION BY school ORDER BY classification NULLS LAST, id) = 1),
p AS (SELECT p.*, g.week, g.season_type, {_hit('home', 'h')} AS mh, {_hit('away', 'a')} AS ma, {_LABEL} AS label FROM {{plays}} p JOIN {{games}} g ON g.id = p.game_id AND g.season = p.season LEFT JOIN d h ON h.school = home LEFT JOIN d a ON a.school = away WHERE play_type = 'Penalty' OR play_text ILIKE '%penalt%'),
q AS (SELECT *, CASE WHEN mh AND NOT ma THEN home WHEN ma AND NOT mh THEN away END AS penalized_team FROM p)
SELECT id AS play_id, game_id, season, week, season_type, period, down, distance, offense, defense, play_type, play_type = 'Penalty' AS is_penalty_play_type, penalized_team, CASE penalized_team WHEN home THEN away WHEN away THEN home END AS benefiting_team, coalesce(label, 'Unknown') AS infraction,
  TRY_CAST(nullif(regexp_extract(play_text, '(\\d+) [Yy]ard', 1), '') AS BIGINT) AS penalty_yards, play_text ILIKE '%declined%' AS declined, play_text ILIKE '%offsett%' AS offsetting, play_text ILIKE '%no play%' AS no_play, len(regexp_extract_all(lower(play_text), 'penalt')) > 1 AS multi_penalty,
  yards_gained, ppa, play_text, label IS NOT NULL AND penalized_team IS NOT NULL AS parse_ok FROM q"""

K42 = f"""WITH {SIDES} SELECT a.id AS game_id, a.season, a.team, a.pf % 12 AS penalties, a.pa % 90 AS penalty_yards, b.team AS opponent, b.pf % 12 AS opp_penalties, b.pa % 90 AS opp_penalty_yards FROM sides a JOIN sides b ON a.id = b.id AND a.at_home <> b.at_home"""
K43 = """SELECT year AS season, team, conference, overall, offense, defense, offense_plays, defense_plays, through_week, rank() OVER (PARTITION BY year ORDER BY overall DESC) AS overall_rank, rank() OVER (PARTITION BY year ORDER BY offense DESC) AS offense_rank, rank() OVER (PARTITION BY year ORDER BY defense) AS defense_rank FROM {core_ratings}"""

_K44 = f"""WITH {SIDES} SELECT season, team, max(conf) AS conference, count(*) FILTER (pf > pa) AS wins, count(*) FILTER (pf < pa) AS losses, count(*) AS total_games, sum(pf)::BIGINT AS points_for, sum(pa)::BIGINT AS points_against, sum(pf - pa)::BIGINT AS point_margin,
  count(*) FILTER (at_home AND pf > pa) AS home_wins, count(*) FILTER (at_home AND pf < pa) AS home_losses, count(*) FILTER (NOT at_home AND pf > pa) AS away_wins, count(*) FILTER (NOT at_home AND pf < pa) AS away_losses, count(*) FILTER (conf = opp_conf AND pf > pa) AS conference_wins,
  count(*) FILTER (conf = opp_conf AND pf < pa) AS conference_losses, avg(excitement_index) AS avg_excitement_index FROM sides WHERE completed GROUP BY season, team"""
K44 = _K44
K45 = """SELECT player_id, category, stat_type, arg_max(player, (season, team)) AS player, arg_max(position, (season, team)) AS position, arg_max(s.team, (season, s.team)) AS team, arg_max(conference, (season, team)) AS conference, count(DISTINCT season) AS seasons_played, min(season) AS first_season, max(season) AS last_season,
  sum(nullif(stat, '')::DOUBLE) AS total_stat, sum(nullif(stat, '')::DOUBLE) / count(DISTINCT season) AS avg_stat_per_season FROM {player_season_stats} s GROUP BY player_id, category, stat_type"""
K46 = f"""SELECT k.season, k.conference, k.team, conference_wins AS conf_wins, conference_losses AS conf_losses, wins AS overall_wins, losses AS overall_losses, conference_wins / nullif(conference_wins + conference_losses, 0) AS conf_win_pct, sp.rating AS sp_rating, el.elo AS elo_rating, tr.rank AS recruiting_rank
FROM ({_K44}) k LEFT JOIN {{sp_ratings}} sp ON sp.team = k.team AND sp.year = k.season LEFT JOIN {{elo_ratings}} el ON el.team = k.team AND el.year = k.season LEFT JOIN {{team_recruiting}} tr ON tr.team = k.team AND tr.year = k.season"""
K47 = """WITH c AS (SELECT committed_to AS team, year, count(*) AS n, avg(rating) AS avg_rating, count(*) FILTER (stars = 5) AS s5, count(*) FILTER (stars = 4) AS s4, count(*) FILTER (stars = 3) AS s3 FROM {recruits} WHERE committed_to IS NOT NULL GROUP BY ALL),
p AS (SELECT committed_to AS team, year, position AS top_position FROM {recruits} WHERE committed_to IS NOT NULL GROUP BY committed_to, year, position QUALIFY row_number() OVER (PARTITION BY committed_to, year ORDER BY count(*) DESC, position) = 1)
SELECT t.team, t.year, rank AS recruiting_rank, points AS recruiting_points, coalesce(n, 0) AS num_commits, coalesce(s5, 0) AS five_stars, coalesce(s4, 0) AS four_stars, coalesce(s3, 0) AS three_stars, avg_rating, top_position, avg(rank) OVER (PARTITION BY t.team ORDER BY t.year ROWS 2 PRECEDING) AS recruiting_rank_3yr_avg
FROM {team_recruiting} t LEFT JOIN c USING (team, year) LEFT JOIN p USING (team, year)"""
_LINE = "SELECT game_id, spread, over_under FROM {lines} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY provider <> 'consensus', provider) = 1"
K48 = f"""SELECT g.id AS game_id, season, week, season_type, start_date AS game_date, home_team, home_conference, away_team, away_conference, home_points, away_points, CASE WHEN home_points > away_points THEN home_team WHEN home_points < away_points THEN away_team END AS winner,
  CASE WHEN home_points > away_points THEN away_team WHEN home_points < away_points THEN home_team END AS loser, abs(home_points - away_points) AS point_diff, l.spread AS home_spread, l.over_under, home_pregame_elo AS home_elo, away_pregame_elo AS away_elo, excitement_index, venue, attendance
FROM {{games}} g LEFT JOIN ({_LINE}) l ON l.game_id = g.id WHERE completed"""

_ALL = ", ".join(f"max(nullif(stat, '')::DOUBLE) FILTER (category = '{a}' AND stat_type = '{b}') AS {n}" for n, (a, b) in PLAYER_STATS.items())
K49 = f"""WITH r AS (SELECT id AS player_id, first_name || ' ' || last_name AS name, team, position, year AS roster_year, height, weight FROM {{rosters}} QUALIFY row_number() OVER (PARTITION BY id ORDER BY year DESC, team, last_name) = 1),
s AS (SELECT player_id, {_ALL} FROM {{player_season_stats}} WHERE season = 2021 GROUP BY player_id), x AS (SELECT athlete_id AS player_id, stars, rating AS recruit_rating FROM {{recruits}} WHERE athlete_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY year DESC, id) = 1),
m AS (SELECT first_name || ' ' || last_name AS name, season AS last_move_season, destination AS last_move_to FROM {{transfer_portal}} QUALIFY row_number() OVER (PARTITION BY first_name, last_name ORDER BY transfer_date DESC, season DESC, destination DESC NULLS LAST) = 1)
SELECT * FROM r LEFT JOIN s USING (player_id) LEFT JOIN x USING (player_id) LEFT JOIN m USING (name)"""
K50 = """WITH g AS (SELECT user_id AS player_id, event_id % 4 AS season, coalesce(CASE WHEN event_id % 9 <> 0 THEN event_id END, 60 + event_id % 61) AS week, (60 + event_id % 61)::DOUBLE AS grade FROM {events} WHERE event_type = 'view'),
l AS (SELECT player_id, grade FROM g QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY season DESC, week DESC) = 1)
SELECT event_id, user_id AS player_id, ts, 0.5::DOUBLE * (event_id % 101) + 0.5::DOUBLE * l.grade AS value_score FROM {events} e JOIN l ON l.player_id = user_id
WHERE event_type = 'purchase' AND ts > TIMESTAMP '2024-01-20' - INTERVAL 10 DAY AND ts <= TIMESTAMP '2024-01-20' AND event_id % 7 <> 0 AND 0.5 * (event_id % 101) + 0.5 * l.grade >= 70"""

SQL = {k: v for k, v in globals().items() if k[0] == "K" and k[1:].isdigit()}
del SQL["K01"]
