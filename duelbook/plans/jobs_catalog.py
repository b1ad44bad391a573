"""Jobs, sources, quality and snapshot operators as queries, with reference SQL where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import GARBAGE_SQL, height_inches
from ..operators import quality as q
from ..sources import io
from ..stats import chain as ch
from ..stats import facts as fa
from ..stats import features as ft
from ..stats import fitted as fi
from ..stats import jobs as m
from ..stats import outlook as ol
from ..stats import predictions as pr
from ..stats import preseason as ps
from ..stats import weekly as wk
from ..streaming import snapshots as sn
from . import marts_more as mm
from . import serve as sv

C, L = F.col, F.lit
SPECS: dict[str, tuple] = {}


def add(name: str, plan, sql: str | None = None) -> None:
    SPECS[name] = (plan, sql)


_GRID = "(SELECT team, year, rank AS a, rank % 7 AS b, CASE WHEN rank % 3 = 0 THEN NULL ELSE rank % 11 END AS c FROM {team_recruiting})"


def _matrix(t):
    return t["team_recruiting"].select("team", "year", C("rank").alias("a"), (C("rank") % 7).alias("b"), F.when(C("rank") % 3 != 0, C("rank") % 11).alias("c"))


add("A5", lambda t: t["rosters"].select("id", "year", height_inches(F.concat_ws("-", F.expr("height div 12"), C("height") % 12)).alias("inches")), "SELECT id, year, height AS inches FROM {rosters}")
add("A6", lambda t: io.wide_matrix_to_long(_matrix(t), ["team", "year"], ["a", "b", "c"]), f"SELECT team, year, 2 + (c IS NOT NULL)::BIGINT AS n_systems, s.system, CASE s.system WHEN 'a' THEN a WHEN 'b' THEN b ELSE c END AS rank FROM {_GRID}, (SELECT unnest(['a', 'b', 'c']) AS system) s WHERE s.system <> 'c' OR c IS NOT NULL")
add("A7", lambda t: io.pair_consecutive_rows(t["lineitem"].select("l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.when(C("l_linenumber") % 2 == 1, "V").otherwise("H").alias("kind")), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "kind", ["l_orderkey"])[0].select("l_returnflag", "visitor_l_orderkey", "home_l_orderkey"),
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS n FROM lineitem) SELECT a.l_returnflag, a.l_orderkey AS visitor_l_orderkey, b.l_orderkey AS home_l_orderkey FROM r a JOIN r b ON a.l_returnflag = b.l_returnflag AND a.n % 2 = 0 AND b.n = a.n + 1 WHERE a.l_linenumber % 2 = 1 AND b.l_linenumber % 2 = 0")
add("A8", lambda t: (lambda st: t["lines"].select("game_id", "provider", st[0].alias("spread_col"), st[1].alias("total_col")))(io.split_spread_total(C("over_under"), F.abs("spread"))), "SELECT game_id, provider, CASE WHEN abs(spread) < over_under THEN -abs(spread) ELSE over_under END AS spread_col, greatest(over_under, abs(spread)) AS total_col FROM {lines}")
add("A9", lambda t: io.merged(t["elo_ratings"], t["elo_ratings"].filter("year >= 2019").withColumn("elo", C("elo") + 1), ["year", "team"]), "SELECT year, team, elo + (year >= 2019)::INT AS elo FROM {elo_ratings}")
add("A14", lambda t: io.incremental_antijoin(t["games"].select(C("id").alias("game_id")), t["plays"], ["game_id"], 100)[0], "SELECT id AS game_id FROM {games} WHERE id NOT IN (SELECT game_id FROM {plays}) ORDER BY id LIMIT 100")
add("A15", lambda t: io.orphan_filter(t["orders"].select(C("o_orderkey").alias("game_id")), t["plays"], ["game_id"]), "SELECT o_orderkey AS game_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
add("A17", lambda t: io.target_seasons(t["games"]), "SELECT DISTINCT season FROM {games} WHERE season >= (SELECT max(season) FROM {games} WHERE completed)")
add("A18", lambda t: io.scheduled_entities(t["games"], [2017]), "SELECT home_team AS team FROM {games} WHERE season = 2017 UNION SELECT away_team FROM {games} WHERE season = 2017")
add("I1", lambda t: sn.changes(t["captures"]), "SELECT * FROM {captures} QUALIFY coalesce(lag(state_hash) OVER (PARTITION BY game_id ORDER BY captured_at, event_id) <> state_hash, true)")
add("I3", lambda t: sv.live_scoreboard(t), "SELECT game_id, captured_at, status, points, state_hash FROM {captures} WHERE captured_at > (SELECT max(captured_at) FROM {captures}) - INTERVAL 24 HOUR QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY captured_at DESC, event_id DESC) = 1")
add("I4", lambda t: sv.line_movement(t).groupBy("game_id").agg(F.count(L(1)).alias("captures"), F.max("run").alias("runs"), F.max("unmoved_streak").alias("longest_streak")))
add("I5", lambda t: sn.normal_status(t["captures"]).select("event_id", "status"), "SELECT event_id, lower(status) AS status FROM {captures} WHERE lower(status) IN ('view', 'click', 'purchase')")
add("I6", lambda t: sn.enriched(t["captures"], t["games"].select(C("id").alias("game_id"), C("excitement_index").alias("expected"))))
add("N1", lambda t: q.assert_not_empty(t["core_ratings"], "core_ratings"), "SELECT * FROM {core_ratings}")
add("N2", lambda t: q.parents_without_children(t["games"].select(C("id").alias("game_id")), t["plays"], ["game_id"]), "SELECT count(*) AS parents, count(*) FILTER (bad) AS missing, avg(bad::INT) AS share, CASE WHEN avg(bad::INT) > 0.02 THEN 'FAIL' WHEN avg(bad::INT) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT id NOT IN (SELECT l_orderkey FROM lineitem) AS bad FROM {games})")
add("N3", lambda t: q.reconcile_counts(t["orders"], t["games"]), "SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM {games}) AS loaded_rows, CASE WHEN source_rows = loaded_rows THEN 'PASS' ELSE 'FAIL' END AS status".replace("CASE WHEN source_rows = loaded_rows", "CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM {games})"))
add("N4", lambda t: q.staleness(mm.freshness_of_events(t)).select("table_name", "status"))
add("N5", lambda t: q.snapshot_coverage(t["game_predictions"], "prediction_day", 100), "SELECT count(*) AS rows, CASE WHEN count(*) >= 100 THEN 'PASS' ELSE 'FAIL' END AS status FROM {game_predictions} WHERE prediction_day = 3")
add("N6", lambda t: q.scored_coverage(t["games"].filter("NOT completed").select(C("id").alias("game_id")), t["game_predictions"], ["game_id"]), "SELECT count(*) AS pending, count(*) FILTER (ok) AS scored, avg(ok::INT) AS share, CASE WHEN avg(ok::INT) >= 0.9 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT id IN (SELECT game_id FROM {game_predictions}) AS ok FROM {games} WHERE NOT completed)")
add("N7", lambda t: q.repeated_keys(t["lineitem"], ["l_orderkey", "l_linenumber"]), "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
add("N8", lambda t: q.identity_violations(t["core_ratings"], {"net": C("overall") == C("offense") - C("defense"), "known": C("through_week") > 0}), "SELECT count(*) FILTER (overall <> offense - defense) AS net, count(*) FILTER (through_week <= 0) AS known FROM {core_ratings}")
add("N8_grid", lambda t: q.missing_grid(t["sp_ratings"], t["team_years"], "team", "year", 2015, 2021), "SELECT team, year FROM {team_years} WHERE (team, year) NOT IN (SELECT (team, year) FROM {sp_ratings})")
add("N9", lambda t: q.imputation_audit(t["recruits"], ["stars", "ranking", "athlete_id"]), "SELECT count(*) AS rows, count(*) - count(stars) AS stars, count(*) - count(ranking) AS ranking, count(*) - count(athlete_id) AS athlete_id FROM {recruits}")
add("N10", lambda t: q.key_overlap(t["recruits"].select("athlete_id"), t["rosters"].select(C("id").alias("athlete_id")), "athlete_id"), "SELECT count(*) AS keys, count(*) FILTER (ok) AS matched, avg(ok::INT) AS share FROM (SELECT athlete_id, athlete_id IN (SELECT id FROM {rosters}) AS ok FROM (SELECT DISTINCT athlete_id FROM {recruits} WHERE athlete_id IS NOT NULL))")
add("K36", m.team_adjusted_epa)
add("M01", lambda t: m.two_way_ridge(m.ridge_plays(t)))
add("M02", m.ridge_validate)
add("M03", lambda t: m.two_way_ridge_asof(m.ridge_plays(t), t["games"]))
add("K40", lambda t: m.two_way_ridge_asof(m.ridge_plays(t), t["games"]).select("season", "week_index", "team", "off_coef", "def_coef", "plays"))
add("M06", m.coach_prior, "SELECT first_name, last_name, year, sum(w) OVER o::BIGINT AS prior_wins, sum(l) OVER o::BIGINT AS prior_losses, sum(w) OVER o / nullif(sum(w + l) OVER o, 0) AS prior_win_pct, sum(w) OVER o IS NULL AS unproven FROM (SELECT first_name, last_name, year, sum(wins) AS w, sum(losses) AS l FROM {coach_seasons} GROUP BY ALL) WINDOW o AS (PARTITION BY first_name, last_name ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
add("M10", m.margin_model)
_ZONE = "least(10, greatest(1, ({} + 9) // 10))"
_ERA = "CASE WHEN season >= 2021 THEN '2021+' WHEN season >= 2014 THEN '2014-2020' WHEN season >= 2004 THEN '2004-2013' END"
_ENDS = "CASE drive_result " + " ".join(f"WHEN '{r}' THEN '{e}'" for e, rs in ch.RESULTS.items() for r in rs) + " END"
_ST = f"""'d' || down || '|' || CASE WHEN distance >= yards_to_goal THEN 'goal' WHEN down = 1 AND distance = 10 THEN 'standard' WHEN down = 1 AND distance < 10 THEN 'short' WHEN down = 1 THEN 'long'
  WHEN distance <= 3 THEN 'short' WHEN distance <= 6 THEN 'med' WHEN distance <= 10 THEN 'long' ELSE 'xlong' END || '|z' || {_ZONE.format("yards_to_goal")}"""
_SNAPS = f"(SELECT * FROM {{plays}} WHERE play_type IN ({', '.join(repr(x) for x in ch.SCRIMMAGE)}) AND down BETWEEN 1 AND 4 AND distance BETWEEN 1 AND 45 AND yards_to_goal BETWEEN 1 AND 99 AND NOT {GARBAGE_SQL})"
_ROWS = f"""(SELECT {_ERA} AS era, game_id, from_state, coalesce(nxt, e) AS to_state FROM (
  SELECT season, p.game_id, {_ST} AS from_state, lead({_ST}) OVER (PARTITION BY p.game_id, drive_id ORDER BY play_number, p.id) AS nxt, e
  FROM {_SNAPS} p JOIN (SELECT id, game_id, {_ENDS} AS e FROM {{drives}} WHERE drive_result <> '{ch.OVERTIME}') d ON d.id = drive_id AND d.game_id = p.game_id) WHERE e IS NOT NULL)"""
_M15 = f"SELECT era, from_state, to_state, count(*) AS n FROM {_ROWS} WHERE era IS NOT NULL GROUP BY ALL"
add("M15", ch.drive_state_transitions, _M15)
add("M16", lambda t: ch.shrink(ch.drive_state_transitions(t)), f"""WITH x AS (SELECT *, split_part(from_state, '|', 1) AS g, split_part(from_state, '|', 1) || '|' || split_part(from_state, '|', 3) AS p FROM ({_M15})),
s AS (SELECT era, from_state, g, p, sum(n) AS nf FROM x GROUP BY ALL), gt AS (SELECT era, g, to_state, sum(n) AS ng FROM x GROUP BY ALL), pt AS (SELECT era, p, to_state, sum(n) AS np FROM x GROUP BY ALL)
SELECT s.era, s.from_state, gt.to_state, (coalesce(x.n, 0) + 50 * (coalesce(np, 0) + 50 * ng / sum_g) / (sum_p + 50)) / (nf + 50) AS p FROM s JOIN gt ON gt.era = s.era AND gt.g = s.g JOIN (SELECT era, g, sum(n) AS sum_g FROM x GROUP BY ALL) a ON a.era = s.era AND a.g = s.g JOIN (SELECT era, p, sum(n) AS sum_p FROM x GROUP BY ALL) b ON b.era = s.era AND b.p = s.p
LEFT JOIN pt ON pt.era = s.era AND pt.p = s.p AND pt.to_state = gt.to_state LEFT JOIN x ON x.era = s.era AND x.from_state = s.from_state AND x.to_state = gt.to_state""")
add("M17", lambda t: ch.absorbing_chain(ch.shrink(ch.drive_state_transitions(t))))
add("M18", ch.drive_handoffs, f"""WITH ls AS (SELECT game_id, drive_id, {_ZONE.format("yards_to_goal")} AS exit_zone FROM {_SNAPS} QUALIFY row_number() OVER (PARTITION BY game_id, drive_id ORDER BY play_number DESC, id DESC) = 1),
sq AS (SELECT *, lead(offense) OVER w AS no, lead(start_yards_to_goal) OVER w AS ns, lead(start_period <= 2) OVER w AS nh FROM {{drives}} WHERE start_period BETWEEN 1 AND 4 WINDOW w AS (PARTITION BY game_id ORDER BY drive_number, offense, id)),
c AS (SELECT {_ERA} AS era, {_ENDS} AS ending, exit_zone, {_ZONE.format("ns")} AS zone, count(*) AS n FROM sq JOIN ls ON ls.game_id = sq.game_id AND ls.drive_id = sq.id WHERE no <> offense AND nh = (start_period <= 2) AND ns BETWEEN 1 AND 99 GROUP BY ALL),
gr AS (SELECT * FROM (SELECT DISTINCT {_ERA} AS era FROM {{drives}}), (SELECT unnest(['PUNT', 'TURNOVER', 'DOWNS', 'MISSED_FG']) AS ending), (SELECT unnest(range(1, 11)) AS exit_zone), (SELECT unnest(range(1, 11)) AS zone) WHERE era IS NOT NULL),
f AS (SELECT gr.*, coalesce(n, 0) AS n FROM gr LEFT JOIN c USING (era, ending, exit_zone, zone))
SELECT era, ending, exit_zone, zone, n, (n + 20 * coalesce(sum(n) OVER (PARTITION BY era, ending, zone) / nullif(sum(n) OVER (PARTITION BY era, ending), 0), 0.1)) / (sum(n) OVER (PARTITION BY era, ending, exit_zone) + 20) AS p FROM f""")
add("M19", lambda t: ch.net_expected_points(ch.shrink(ch.drive_state_transitions(t)), ch.drive_handoffs(t), strict=False))
add("M20", lambda t: ch.cluster_bootstrap_se(ch.chain_rows(t)))
add("M21", ch.chain_gates)
add("M22", m.live_wp_calibration)
add("M22_deciles", m.live_wp_deciles)
_PRED = "(SELECT p.*, home_points, away_points, (home_points - away_points)::DOUBLE AS m FROM {game_predictions} p JOIN {games} g ON g.id = p.game_id AND completed QUALIFY row_number() OVER (PARTITION BY p.game_id, model_version ORDER BY prediction_day DESC) = 1)"
add("M26", m.projection_eval, f"SELECT model_version, least(floor(home_win_prob * 10), 9)::BIGINT AS bucket, count(*) AS n, avg(abs(expected_margin - m)) AS mae, sqrt(avg((expected_margin - m) ** 2)) AS rmse, avg(expected_margin - m) AS bias, avg(home_win_prob) AS predicted, avg((m > 0)::INT) AS observed FROM {_PRED} GROUP BY 1, 2")
add("M28", m.residual_sigma, f"SELECT model_version, count(*) AS n, round(stddev_pop(m - expected_margin), 9) AS sigma FROM {_PRED} GROUP BY model_version")
_REPL = "(SELECT season, week AS replicate, conference, team, count(*) FILTER (pf > pa) AS wins FROM (SELECT season, week, home_conference AS conference, home_team AS team, home_points AS pf, away_points AS pa FROM {games} WHERE completed UNION ALL SELECT season, week, away_conference, away_team, away_points, home_points FROM {games} WHERE completed) GROUP BY ALL)"
add("M29", lambda t: m.replicate_summary(m._season_replicates(t), "team", "wins").drop("distribution"), f"SELECT team, count(*) AS n, avg(wins) AS mean, {', '.join(f'list(wins ORDER BY wins)[floor({p} * (count(*) - 1))::BIGINT + 1] AS p{round(p * 100)}' for p in (0.1, 0.25, 0.5, 0.75, 0.9))} FROM {_REPL} GROUP BY team")
_SHARE = "SELECT {key} AS conference, team, avg(sh) AS title_share FROM (SELECT season, conference, team, (wins = mx)::INT / sum((wins = mx)::INT) OVER w AS sh, count(*) OVER w AS k FROM (SELECT *, max(wins) OVER (PARTITION BY conference, season, replicate) AS mx FROM {rows}) WINDOW w AS (PARTITION BY conference, season, replicate)) WHERE k >= 2 GROUP BY ALL"
add("M30", lambda t: m.best_share(m._season_replicates(t), "conference", "team", "wins"), _SHARE.replace("{key}", "conference").replace("{rows}", _REPL))
add("M30_seasons", lambda t: m.best_share(m._season_replicates(t).withColumn("conference", F.concat_ws(" ", "season", "conference")), "conference", "team", "wins"), _SHARE.replace("{key}", "season || ' ' || conference").replace("{rows}", _REPL))
add("M31", m.schedule_strength, "SELECT season, team, avg(rating) AS strength, count(rating) AS rated_games, rank() OVER (PARTITION BY season ORDER BY round(avg(rating), 9) DESC NULLS LAST) AS strength_rank FROM (SELECT season, home_team AS team, away_team AS opp FROM {games} UNION ALL SELECT season, away_team, home_team FROM {games}) g LEFT JOIN {sp_ratings} s ON s.team = opp AND s.year = season GROUP BY season, g.team".replace("SELECT season, team, avg", "SELECT season, g.team, avg"))
add("M33", lambda t: m.stale_fit_seasons(t, t["games"].filter("season < 2018").select("season").distinct()), "SELECT season, count(*) AS games, avg(completed::INT) AS done FROM {games} WHERE season >= 2018 GROUP BY season HAVING avg(completed::INT) >= 0.99 AND count(*) >= 100")
_NAMES = lambda t: t["recruits"].select(F.when(C("id") % 3 == 0, F.upper("name")).when(C("id") % 3 == 1, F.concat("name", L("s"))).otherwise(C("name")).alias("name"))
add("M35", lambda t: m.match_entities(_NAMES(t), t["rosters"].select(C("last_name").alias("name"))))
add("M34", lambda t: m.resolve_names(t["games"].select("id", F.concat(L(" "), F.lower("home_team")).alias("name")), t["teams"].select(C("school").alias("source_name"), C("school").alias("canonical")), "name"), "SELECT id, ' ' || lower(home_team) AS name, home_team AS canonical FROM {games}")
add("M36", m.accuracy_rollup)
add("M07", pr.predictions_of_pending)
add("M08", pr.ratings_of_sides)

add("M05", ft.fitted_features)
add("M05_vectors", ft.team_week_features, ft.SQL)
add("K39", ft.fitted_features)
_V = f"({ft.SQL})"
_EACH = lambda text: ", ".join(text.replace("#", c) for c in fi.PLAIN)
# A window ends with each season from the third on; contests played are scaled by the window before them, those to come by the last.
add("M09", fi.design_of_contests, f"""WITH v AS {_V}, c AS (
  SELECT g.id AS game_id, g.season, g.neutral_site::INT::DOUBLE AS neutral, g.completed, {_EACH("h.# AS h_#, a.# AS a_#")} FROM {{games}} g JOIN v h ON h.game_id = g.id AND h.side = 'home' JOIN v a ON a.game_id = g.id AND a.side = 'away'),
w AS (SELECT year AS y FROM {{seasons}} WHERE year >= 2017),
mn AS (SELECT y, {_EACH("coalesce((sum(h_#) + sum(a_#)) / (count(h_#) + count(a_#)), coalesce(avg(h_#), avg(a_#)), 0) AS m_#")} FROM w JOIN c ON season BETWEEN 2015 AND y WHERE completed GROUP BY y),
st AS (SELECT y, {_EACH("avg(coalesce(h_#, m_#) - coalesce(a_#, m_#)) AS u_#, stddev_pop(coalesce(h_#, m_#) - coalesce(a_#, m_#)) AS s_#")} FROM mn JOIN c ON season BETWEEN 2015 AND y WHERE completed GROUP BY y)
SELECT game_id, season, y AS through, neutral AS neutral_site, {_EACH("CASE WHEN s_# > 1e-6 THEN (coalesce(h_#, m_#) - coalesce(a_#, m_#) - u_#) / s_# ELSE 0 END AS d_#")}
FROM c JOIN mn ON y = CASE WHEN completed THEN season - 1 ELSE (SELECT max(y) FROM w WHERE y IN (SELECT season FROM c WHERE completed)) END JOIN st USING (y)""")
add("M09_means", fi.frozen_means, f"""SELECT train_through, n_train, feature, feature_mean FROM (SELECT y AS train_through, count(*) // 2 AS n_train, {{cols}} FROM {_V} v JOIN {{games}} g ON g.id = v.game_id AND completed JOIN (SELECT year AS y FROM {{seasons}} WHERE year >= 2017) w ON v.season <= y AND v.season >= 2015 GROUP BY y) UNPIVOT INCLUDE NULLS (feature_mean FOR feature IN (COLUMNS(* EXCLUDE (train_through, n_train))))""".replace("{cols}", ", ".join(f"avg({c}) AS {c}" for c in fi.PLAIN)))
add("M11", fi.ratings_logistic)
add("M12", fi.fits_of_seasons)
add("M13", fi.scores)
add("M13_coverage", fi.scored_coverage, "SELECT count(*) AS pending, count(*) AS scored, 1.0::DOUBLE AS share, true AS ok FROM {games} WHERE NOT completed")
add("K37_fitted", lambda t: fi.over_fitted(mm.scored_matchup_edges, t))
add("K38_fitted", lambda t: fi.over_fitted(mm.prediction_accuracy, t))
add("M26_fitted", lambda t: fi.over_fitted(m.projection_eval, t))
add("M28_fitted", lambda t: fi.over_fitted(m.residual_sigma, t))
add("M36_fitted", lambda t: fi.over_fitted(m.accuracy_rollup, t))
add("M23", ps.screened)
add("M24", ps.preseason_frame, ps.FRAME_SQL)
add("M27", ps.backtest_rows)
add("M26_wins", ps.win_report)
add("L22", ps.latest_backtests)
add("M32", fa.facts_of_contests)
add("L19", fa.ledger_of_contests)
add("L21", ol.outlook_of_seasons, ol.SQL)
add("M25", wk.frame_of_contests)
add("M25_candidates", wk.candidates_of_contests, wk.FRAME_SQL)
add("M25_screen", wk.screen_of_contests)

PLANS = {k: v[0] for k, v in SPECS.items()}
SQL = {k: v[1] for k, v in SPECS.items() if v[1]}
