"""Reference SQL (DuckDB) of jobs, probabilities and similarity queries, over the adapter's views."""

from ..functions.exprs import STATE_SECONDS_SQL as SECONDS
from ..stats.preseason import screen_sql
from . import oracle_marts, oracle_more, oracle_serve


def normal_cdf(z: str) -> str:
    """The same rational approximation as the column function (Abramowitz and Stegun 7.1.26)."""
    x = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.3275911 * {x}))"
    erf = f"(1 - {t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))) * exp(-{x} * {x}))"
    return f"CASE WHEN {z} >= 0 THEN (1 + {erf}) / 2 ELSE (1 - {erf}) / 2 END"


def win_probability(margin: str, expected: str, seconds: str, sigma: str = "16") -> str:
    left = f"(({seconds}) / 3600.0::DOUBLE)"
    z = f"((({margin}) + ({expected}) * {left}) / ({sigma} * sqrt({left})))"
    return f"CASE WHEN {left} > 0 THEN {normal_cdf(z)} WHEN ({margin}) > 0 THEN 1.0 WHEN ({margin}) < 0 THEN 0.0 ELSE 0.5 END"


def trigrams(text: str) -> str:
    parts = f"list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda w: w <> '')"
    return f"list_distinct(flatten(list_transform({parts}, lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


def similarity(a: str, b: str) -> str:
    x, y = trigrams(a), trigrams(b)
    return f"len(list_intersect({x}, {y}))::DOUBLE / nullif(len(list_distinct(list_concat({x}, {y}))), 0)"


_LEAD = lambda name, kind: f"{name} AS (SELECT * FROM (SELECT game_id, team, athlete_id, athlete_name, count(*) AS stat FROM {{play_stats}} WHERE stat_type = '{kind}' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY stat DESC, athlete_id, team) = 1)"
_OT = ", ".join(f"CASE WHEN id % 9 = 0 THEN {s}_points // 5 END AS {s}_ot" for s in ("home", "away"))
_RESULT = lambda x, up, down: f"CASE sign({x}) WHEN 1 THEN '{up}' WHEN -1 THEN '{down}' WHEN 0 THEN 'push' END"
M32 = f"""WITH g AS (SELECT * FROM {{games}} WHERE completed AND season >= 2014 AND home_classification = 'fbs'),
ls AS (SELECT * EXCLUDE (home_ot, away_ot), {_OT} FROM ({oracle_serve.L11}) x JOIN (SELECT id, home_points, away_points FROM {{games}}) y ON y.id = x.game_id),
l AS (SELECT * FROM {{lines}} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY provider <> 'consensus', provider) = 1),
tp AS (SELECT game_id, list(play_id ORDER BY abs(epa) DESC, play_id)[1:5] AS ids, list(epa ORDER BY abs(epa) DESC, play_id)[1] AS e, list(period ORDER BY abs(epa) DESC, play_id)[1] AS ep FROM ({oracle_marts.K10}) GROUP BY game_id),
w AS (SELECT p.game_id, p.id, play_number, {win_probability('score_diff::DOUBLE', '(-spread)', SECONDS)} AS p FROM {{plays}} p JOIN l ON l.game_id = p.game_id WHERE spread IS NOT NULL),
sw AS (SELECT game_id, round(max(abs(p - q)), 4) AS max_swing, round(min(p), 4) AS min_wp, round(max(p), 4) AS max_wp, count(*) FILTER (p <> 0.5 AND q <> 0.5 AND (p > 0.5) <> (q > 0.5)) AS lead_changes
  FROM (SELECT *, lag(p) OVER (PARTITION BY game_id ORDER BY play_number, id) AS q FROM w) GROUP BY game_id HAVING count(*) >= 2),
{', '.join(_LEAD(f'{c}_l', k) for c, k in (('passing', 'Completion'), ('rushing', 'Rush'), ('receiving', 'Reception')))}
SELECT g.id AS game_id, season, week, home_team, away_team, g.home_points, g.away_points, spread, {_RESULT('g.home_points - g.away_points + spread', 'home', 'away')} AS spread_result, over_under, {_RESULT('g.home_points + g.away_points - over_under', 'over', 'under')} AS ou_result, excitement_index,
  {', '.join(f'{s}_{q}' for s in ('home', 'away') for q in ('q1', 'q2', 'q3', 'q4', 'ot'))}, coalesce(array_to_string(ids, ','), '') AS top_plays, max_swing, min_wp, max_wp, lead_changes,
  CASE WHEN sw.game_id IS NULL THEN e END AS largest_epa_play_epa, CASE WHEN sw.game_id IS NULL THEN ep END AS largest_epa_play_period,
  {', '.join(f'{c}_l.athlete_name AS {c}_player_name, {c}_l.team AS {c}_team, {c}_l.stat AS {c}_stat' for c in ('passing', 'rushing', 'receiving'))}, sw.game_id IS NOT NULL AS wp_available
FROM g JOIN ls ON ls.game_id = g.id LEFT JOIN l ON l.game_id = g.id LEFT JOIN tp ON tp.game_id = g.id LEFT JOIN sw ON sw.game_id = g.id LEFT JOIN passing_l ON passing_l.game_id = g.id LEFT JOIN rushing_l ON rushing_l.game_id = g.id LEFT JOIN receiving_l ON receiving_l.game_id = g.id"""

SQL = {
    "M32": M32,
    "L19": f"SELECT game_id, season, week, wp_available, home_points, away_points, CASE WHEN top_plays = '' THEN 0 ELSE len(string_split(top_plays, ',')) END AS n_top_plays FROM ({M32})",
    "H6": f"SELECT p_partkey, round({similarity('p_name', repr('Part 12'))}, 9) AS s FROM part",
    "H15": f"SELECT id, {win_probability('home_points - away_points', 'excitement_index', 'attendance % 3600')} AS p FROM {{games}}",
    "I4": f"SELECT game_id, count(*) AS captures, max(run) AS runs, max(unmoved_streak) AS longest_streak FROM ({oracle_serve.L13}) GROUP BY game_id",
    "I6": f"SELECT c.*, excitement_index AS expected, {win_probability('points::DOUBLE', 'coalesce(excitement_index, 0.0)', '1800')} AS win_prob FROM {{captures}} c LEFT JOIN {{games}} g ON g.id = c.game_id",
    "L12": f"""WITH c AS (SELECT team, season, sum(total_plays)::BIGINT AS plays, sum(rush_plays) / sum(total_plays) AS run_rate, sum(rush_plays) FILTER (down <= 2) / sum(total_plays) FILTER (down <= 2) AS early_down_run_rate,
  sum(rush_plays) FILTER (down >= 3) / sum(total_plays) FILTER (down >= 3) AS late_down_run_rate, sum(rush_plays) FILTER (field_position = 'red_zone') / sum(total_plays) FILTER (field_position = 'red_zone') AS red_zone_run_rate,
  sum(rush_plays) FILTER (score_diff_bucket = 'big_lead') / sum(total_plays) FILTER (score_diff_bucket = 'big_lead') AS big_lead_run_rate FROM ({oracle_marts.K21}) GROUP BY team, season),
g AS (SELECT team, season, sum(success_rate * total_plays) / sum(total_plays) FILTER (success_rate IS NOT NULL) AS weighted_success FROM ({oracle_marts.K22}) GROUP BY team, season)
SELECT c.*, weighted_success, percent_rank() OVER (PARTITION BY season ORDER BY plays) AS plays_pctl FROM c LEFT JOIN g USING (team, season)""",
    "L34": f"SELECT * FROM (SELECT id, name, team, year, position, {similarity('name', repr('Customer 10'))} AS score FROM (SELECT *, first_name || ' ' || last_name AS name FROM {{rosters}})) WHERE score >= 0.3 ORDER BY score DESC, name, id, team, year LIMIT 25",
    "M22": f"""SELECT sigma, avg((p - won) ** 2) AS brier, count(*) AS n, rank() OVER (ORDER BY avg((p - won) ** 2)) = 1 AS is_best FROM (
  SELECT sigma, won, {win_probability('score_diff::DOUBLE', '0.0', SECONDS, 'sigma')} AS p FROM {{plays}} JOIN (SELECT id, (home_points > away_points)::INT::DOUBLE AS won FROM {{games}} WHERE completed) g ON g.id = game_id, (SELECT unnest([10.0, 13.0, 16.0, 19.0]::DOUBLE[]) AS sigma)) GROUP BY sigma""",
    "M22_deciles": f"""SELECT least(floor(p * 10), 9)::BIGINT AS decile, count(*) AS n, avg(p) AS predicted, avg(won) AS observed FROM (
  SELECT won, {win_probability('score_diff::DOUBLE', '0.0', SECONDS)} AS p FROM {{plays}} JOIN (SELECT id, (home_points > away_points)::INT::DOUBLE AS won FROM {{games}} WHERE completed) g ON g.id = game_id) GROUP BY 1""",
    "M08": """WITH s AS (SELECT home_team AS team, season, home_postgame_elo AS r, start_date, game_id FROM {house_elo_game} UNION ALL SELECT away_team, season, away_postgame_elo, start_date, game_id FROM {house_elo_game}),
  l AS (SELECT team, season AS s, r FROM s WHERE season < (SELECT max(season) FROM {games}) QUALIFY row_number() OVER (PARTITION BY team ORDER BY start_date DESC, game_id DESC) = 1),
  g AS (SELECT id AS game_id, season, home_team AS team FROM {games} UNION ALL SELECT id, season, away_team FROM {games})
  SELECT game_id, season, team, coalesce(r * pow(2.0::DOUBLE / 3, greatest(season - s, 0)) + 1500 * (1 - pow(2.0::DOUBLE / 3, greatest(season - s, 0))), 1500) AS rating FROM g LEFT JOIN l USING (team)""",
    "M23": screen_sql(normal_cdf),
    "M36": f"""SELECT model_version, edge_threshold, sum(n_games)::BIGINT AS n_games, sum(margin_mae * n_games) / sum(n_games) AS margin_mae, sum(brier * n_scored_win_prob) / nullif(sum(n_scored_win_prob), 0) AS brier,
  sum(ats_wins) / nullif(sum(ats_wins + ats_losses), 0) AS ats_rate FROM ({oracle_more.K38}) GROUP BY model_version, edge_threshold""",
    "N4": f"SELECT table_name, CASE WHEN row_count = 0 THEN 'FAIL' WHEN is_stale THEN 'WARN' ELSE 'PASS' END AS status FROM ({oracle_more.K28})",
}
