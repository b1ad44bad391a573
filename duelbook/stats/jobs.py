"""Statistical jobs: the heavy part is grouped on Spark, only small dense systems are solved in a worker."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import STATE_SECONDS_SQL, count_if, live_win_probability, ratio, week_index
from ..operators.frames import latest_per_key, unpivot_sides
from ..plans import marts_base as mb
from ..plans import marts_more as mm

RIDGE_LAMBDA, MAX_UNMAPPED = 100.0, 0.02


def ridge_plays(t) -> DataFrame:
    """Plays that M1 and M3 fit: those of K10 outside garbage time; ``home`` is null on neutral sites, so that no side is at home."""
    sites = t["games"].select(F.col("id").alias("game_id"), F.when(~F.coalesce("neutral_site", F.lit(False)), F.col("home_team")).alias("home"))
    return mb.play_epa(t).filter("NOT is_garbage_time").select("game_id", "season", "offense", "defense", F.col("epa").alias("ppa")).join(sites, "game_id")


def effect_cells(plays: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Rows of (season, offense, defense, at home) with count and sum: at most 2 T^2 a season, however many plays."""
    home = F.coalesce((F.col("offense") == F.col("home")).cast("int"), F.lit(0))
    return plays.filter("ppa IS NOT NULL").groupBy("season", *extra, "offense", "defense", home.alias("at_home")).agg(F.count(F.lit(1)).alias("n"), F.sum("ppa").alias("s"))


def _normal_equations(g: pd.DataFrame, teams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size, t = 2 * len(teams) + 2, len(teams)
    cols = np.stack([np.zeros(len(g), int), np.ones(len(g), int), 2 + np.searchsorted(teams, g["offense"]), 2 + t + np.searchsorted(teams, g["defense"])], axis=1)
    vals = np.stack([np.ones(len(g)), g["at_home"], np.ones(len(g)), np.ones(len(g))], axis=1)
    gram, right = np.zeros((size, size)), np.zeros(size)
    n, s = g["n"].to_numpy(float), g["s"].to_numpy(float)
    for i in range(4):
        np.add.at(right, cols[:, i], vals[:, i] * s)
        for j in range(4):
            np.add.at(gram, (cols[:, i], cols[:, j]), vals[:, i] * vals[:, j] * n)
    return gram, right


def _effects(gram: np.ndarray, right: np.ndarray, teams: np.ndarray, lam: float) -> pd.DataFrame:
    """Ridge with a free intercept and a free home effect."""
    free = np.ones(len(right))
    free[:2] = 0
    beta = np.linalg.solve(gram + lam * np.diag(free), right)
    t = len(teams)
    return pd.DataFrame({"team": teams, "off_coef": beta[2 : 2 + t], "def_coef": beta[2 + t :], "mu": beta[0], "hfa": beta[1], "plays": np.diag(gram)[2 : 2 + t].round().astype("int64")})


EFFECTS = "season long, team string, off_coef double, def_coef double, mu double, hfa double, plays long"


def two_way_ridge(plays: DataFrame, lam: float = RIDGE_LAMBDA) -> DataFrame:
    """M1."""
    return ridge_of_cells(effect_cells(plays), lam)


def ridge_of_cells(cells: DataFrame, lam: float = RIDGE_LAMBDA) -> DataFrame:
    """M1 from ``effect_cells``."""

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        teams = np.unique(np.concatenate([g["offense"], g["defense"]]))
        out = _effects(*_normal_equations(g, teams), teams, lam)
        return out.assign(season=g["season"].iloc[0])[["season", "team", "off_coef", "def_coef", "mu", "hfa", "plays"]]

    return cells.groupBy("season").applyInPandas(solve, EFFECTS)


def two_way_ridge_asof(plays: DataFrame, games: DataFrame, lam: float = RIDGE_LAMBDA) -> DataFrame:
    """M3: coefficients on entering each week, from strictly earlier weeks; none before the first week or after the last."""
    weeks = games.select(F.col("id").alias("game_id"), week_index().alias("week_index"))
    return ridge_asof_of_cells(effect_cells(plays.join(weeks, "game_id"), ["week_index"]), lam)


def ridge_asof_of_cells(cells: DataFrame, lam: float = RIDGE_LAMBDA) -> DataFrame:
    """M3 from ``effect_cells`` by week_index."""

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        teams = np.unique(np.concatenate([g["offense"], g["defense"]]))
        gram = right = None
        out = []
        for week, part in g.sort_values("week_index").groupby("week_index"):
            if gram is not None:
                out.append(_effects(gram, right, teams, lam).assign(week_index=week))
            a, b = _normal_equations(part, teams)
            gram, right = (a, b) if gram is None else (gram + a, right + b)
        got = pd.concat(out) if out else _effects(np.eye(2 * len(teams) + 2), np.zeros(2 * len(teams) + 2), teams, lam).iloc[:0].assign(week_index=0)
        return got.assign(season=g["season"].iloc[0])[["season", "week_index", "team", "off_coef", "def_coef", "mu", "hfa", "plays"]]

    return cells.groupBy("season").applyInPandas(solve, EFFECTS.replace("team string", "week_index long, team string"))


def team_adjusted_epa(t) -> DataFrame:
    """Effects, net value and three ranks; of the defence, less is better."""
    rank = lambda o: F.rank().over(Window.partitionBy("season").orderBy(o))
    return two_way_ridge(ridge_plays(t)).withColumn("net", F.col("off_coef") - F.col("def_coef")).withColumns({"off_rank": rank(F.round("off_coef", 9).desc()), "def_rank": rank(F.round("def_coef", 9)), "net_rank": rank(F.round("net", 9).desc())})


def ridge_validate(t) -> DataFrame:
    """M2: correlation of the net effect with an outside rating, by season."""
    out = two_way_ridge(ridge_plays(t)).withColumn("net", F.col("off_coef") - F.col("def_coef")).join(t["sp_ratings"].select("team", F.col("year").alias("season"), "rating"), ["team", "season"])
    return out.groupBy("season").agg(F.corr("net", "rating").alias("r"), F.count(F.lit(1)).alias("n"))


def replicate_summary(replicates: DataFrame, key: str, value: str, at: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Distribution over the full range, mean and lower-interpolated percentiles of a (replicate, key, value) table."""
    counts = replicates.groupBy(key, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(key)
    run = counts.withColumns({"n": F.sum("c").over(w), "upto": F.sum("c").over(w.orderBy(value))})
    pick = [F.min(F.when(F.col("upto") > F.floor(F.lit(p) * (F.col("n") - 1)), F.col(value))).alias(f"p{round(p * 100)}") for p in at]
    dist = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(value).cast("string"), ratio("c", "n")))))
    return run.groupBy(key).agg(F.max("n").alias("n"), ratio(F.sum(F.col(value) * F.col("c")), F.sum("c")).alias("mean"), *pick, dist.alias("distribution"))


def best_share(replicates: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """How often a key has its group's best value, ties split evenly; groups of two or more."""
    w = Window.partitionBy(group, "replicate")
    rows = replicates.withColumns({"_best": (F.col(value) == F.max(value).over(w)).cast("int"), "_m": F.count(F.lit(1)).over(w)}).filter("_m >= 2")
    rows = rows.withColumn("_share", F.col("_best") / F.sum("_best").over(w))
    return rows.groupBy(group, key).agg(F.avg("_share").alias("title_share"))


def _season_replicates(t) -> DataFrame:
    """Each (season, week) as a replicate: wins of each side in it."""
    rows = mb.team_rows(t["games"])
    return rows.groupBy("season", F.struct("season", "week").alias("replicate"), "conference", "team").agg(count_if(F.col("points") > F.col("opp_points")).alias("wins"))


def schedule_strength(t) -> DataFrame:
    """Mean rating of the opponents, unrated ones skipped."""
    rows = unpivot_sides(t["games"]).select("season", "team", "opp_team").join(t["sp_ratings"].select(F.col("team").alias("opp_team"), F.col("year").alias("season"), "rating"), ["opp_team", "season"], "left")
    out = rows.groupBy("season", "team").agg(F.avg("rating").alias("strength"), F.count("rating").alias("rated_games"))
    return out.withColumn("strength_rank", F.rank().over(Window.partitionBy("season").orderBy(F.round("strength", 9).desc_nulls_last())))


def residual_sigma(t, least: int = 100) -> DataFrame:
    """Spread of actual less expected margin, one prediction a contest; refused below ``least`` contests."""
    rows = mm.latest_predictions(t, True)
    err = (F.col("home_points") - F.col("away_points")).cast("double") - F.col("expected_margin")
    out = rows.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(err).alias("s"))
    return out.select("model_version", "n", F.when((F.col("n") >= least) & (F.col("s") > 0), F.round("s", 9)).alias("sigma"))


def accuracy_rollup(t) -> DataFrame:
    """Over all seasons; errors weighted by contests, Brier by its own count, hit rate from sums."""
    n, k = F.col("n_games"), F.col("n_scored_win_prob")
    return mm.prediction_accuracy(t).groupBy("model_version", "edge_threshold").agg(F.sum(n).alias("n_games"), ratio(F.sum(F.col("margin_mae") * n), F.sum(n)).alias("margin_mae"), ratio(F.sum(F.col("brier") * k), F.sum(k)).alias("brier"), ratio(F.sum("ats_wins"), F.sum(F.col("ats_wins") + F.col("ats_losses"))).alias("ats_rate"))


def projection_eval(t) -> DataFrame:
    """Error, bias and coverage of the expected margin, by model and probability bucket (the last one closed)."""
    rows = mm.latest_predictions(t, True)
    margin = (F.col("home_points") - F.col("away_points")).cast("double")
    e = F.col("expected_margin") - margin
    b = F.least(F.floor(F.col("home_win_prob") * 10), F.lit(9))
    return rows.groupBy("model_version", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.avg("home_win_prob").alias("predicted"), F.avg(F.when(margin > 0, 1.0).otherwise(0.0)).alias("observed"))


def coach_prior(t) -> DataFrame:
    """M6: a coach's record strictly before the year; no record is null, not zero."""
    yearly = t["coach_seasons"].groupBy("first_name", "last_name", "year").agg(F.sum("wins").alias("w"), F.sum("losses").alias("l"))
    before = Window.partitionBy("first_name", "last_name").orderBy("year").rangeBetween(Window.unboundedPreceding, -1)
    out = yearly.select("first_name", "last_name", "year", F.sum("w").over(before).alias("prior_wins"), F.sum("l").over(before).alias("prior_losses"))
    return out.withColumns({"prior_win_pct": ratio("prior_wins", F.col("prior_wins") + F.col("prior_losses")), "unproven": F.col("prior_wins").isNull()})


def stale_fit_seasons(t, fits: DataFrame, least_done: float = 0.99, least_games: int = 100) -> DataFrame:
    """Finished seasons without a fit of the current feature set (fits: season)."""
    done = t["games"].groupBy("season").agg(F.count(F.lit(1)).alias("games"), ratio(count_if(F.col("completed")), F.count(F.lit(1))).alias("done"))
    return done.filter((F.col("done") >= least_done) & (F.col("games") >= least_games)).join(fits.select("season"), "season", "left_anti")


def resolve_names(rows: DataFrame, crosswalk: DataFrame, name: str, max_unmapped: float = MAX_UNMAPPED) -> DataFrame:
    """Canonical names by normalised spelling; unmapped rows go, too many of them raise an error; the source's spelling is kept."""
    from ..functions.exprs import normal_name

    keyed = rows.withColumn("_k", normal_name(name)).join(crosswalk.select(normal_name("source_name").alias("_k"), "canonical").distinct(), "_k", "left")
    n = keyed.agg(F.count(F.lit(1)).alias("n"), F.count("canonical").alias("k")).first()
    if n["n"] and 1 - n["k"] / n["n"] > max_unmapped:
        raise ValueError(f"{n['n'] - n['k']} of {n['n']} names are unmapped")
    return keyed.filter("canonical IS NOT NULL").drop("_k")


def one_edit_pairs(names: DataFrame, canonical: DataFrame) -> DataFrame:
    """(name, canonical) that may be one edit apart in normal form: one deletion, or none, in each of them gives the same text.

    Few names share a text without one character, however many names share its trigrams.
    """
    from ..functions.exprs import normal_name

    def shorter(df: DataFrame, c: str) -> DataFrame:
        k = normal_name(c)
        cut = F.transform(F.sequence(F.lit(1), F.length("_k")), lambda i: F.concat(F.substr("_k", F.lit(1), i - 1), F.substr("_k", i + 1)))
        cuts = F.array_distinct(F.concat(F.array("_k"), F.when(F.length("_k") > 0, cut).otherwise(F.array().cast("array<string>"))))
        return df.select(c, k.alias("_k")).select(c, F.explode(cuts).alias("_cut"))

    return shorter(names, "name").join(shorter(canonical, "canonical"), "_cut").select("name", "canonical").distinct()


def match_entities(source: DataFrame, canonical: DataFrame, least: float = 0.85) -> DataFrame:
    """Exact, then normalised, then fuzzy matches of names; the fuzzy tier has each name's most similar one.

    It looks for names one edit apart first. A name is settled by these if nothing that is more edits apart can be as similar;
    only the others are compared with the names that share a trigram.
    """
    from ..functions.exprs import edit_similarity, normal_name, trigrams

    s = source.select("name").distinct()
    c = canonical.select(F.col("name").alias("canonical")).distinct()
    exact = s.join(c, s["name"] == c["canonical"]).select("name", "canonical", F.lit("exact").alias("tier"), F.lit(1.0).alias("confidence"))
    rest = s.join(exact, "name", "left_anti")
    same = rest.join(c, normal_name("name") == normal_name("canonical")).groupBy("name").agg(F.min("canonical").alias("canonical")).select("name", "canonical", F.lit("normalised").alias("tier"), F.lit(0.95).alias("confidence"))
    rest = rest.join(same, "name", "left_anti")
    alike = lambda pairs: pairs.withColumn("s", edit_similarity(normal_name("name"), normal_name("canonical"))).filter(F.col("s") >= least)
    best = lambda near: near.groupBy("name").agg(F.min_by(F.struct("canonical", "s"), F.struct((-F.col("s")).alias("o"), "canonical")).alias("x")).select("name", "x.*")
    # Of a name of n characters, another two edits away is at most n + 2 long, so at most n / (n + 2) alike, and one that is further less.
    n = F.length(normal_name("name"))
    close = best(alike(one_edit_pairs(rest, c))).filter(F.col("s") > n / (n + 2) + 1e-12)
    rest = rest.join(close, "name", "left_anti")
    # An edit spoils at most three trigrams, so names that alike share one of the source's rarest ``allowed + 1``: no link is lost,
    # and common trigrams pair nothing.
    grams = c.select("canonical", F.explode(trigrams("canonical")).alias("g"))
    rare = rest.select("name", F.explode(trigrams("name")).alias("g")).join(grams.groupBy("g").agg(F.count(F.lit(1)).alias("df")), "g", "left")
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.coalesce("df", F.lit(0)), "g"))
    allowed = F.ceil(3 * (1 - least) * F.length(normal_name("name")) / least)
    rare = rare.withColumn("rank", rank).filter(F.col("rank") <= allowed + 1).select("name", "g")
    pairs = rare.join(grams, "g").select("name", "canonical").distinct()
    fuzzy = close.unionByName(best(alike(pairs))).select("name", "canonical", F.lit("fuzzy").alias("tier"), F.col("s").alias("confidence"))
    return exact.unionByName(same).unionByName(fuzzy)


def ridge_margin(rows: DataFrame, features: list[str], target: str, alpha: float = 7.0) -> DataFrame:
    """Standardised features, ridge with a free constant; sums on Spark, one small solve."""
    stats = rows.agg(*[x for f in features for x in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).first()
    z = [F.when(F.lit((stats[f"s_{f}"] or 0.0) > 0), (F.coalesce(f, F.lit(stats[f"m_{f}"])) - F.lit(stats[f"m_{f}"])) / F.lit(stats[f"s_{f}"] or 1.0)).otherwise(0.0) for f in features]
    cols = [F.lit(1.0), *z]
    sums = rows.agg(*[F.sum(a * b).alias(f"g_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j], *[F.sum(a * F.col(target)).alias(f"r_{i}") for i, a in enumerate(cols)]).first()
    k = len(cols)
    gram = np.array([[sums[f"g_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    penalty = np.diag([0.0, *[alpha] * (k - 1)])
    beta = np.linalg.solve(gram + penalty, np.array([sums[f"r_{i}"] for i in range(k)]))
    return rows.sparkSession.createDataFrame([(n, float(b)) for n, b in zip(["constant", *features], beta, strict=True)], "feature string, coefficient double")


def margin_model(t) -> DataFrame:
    """M10 over the test tables: margin from pregame ratings."""
    rows = t["house_elo_game"].select("home_pregame_elo", "away_pregame_elo", F.col("neutral_site").cast("double").alias("neutral"), F.col("actual_home_margin").cast("double").alias("margin"))
    return ridge_margin(rows, ["home_pregame_elo", "away_pregame_elo", "neutral"], "margin")


def _live_states(t) -> DataFrame:
    """Every play of finished contests: score_diff, seconds left, whether the home side won."""
    games = t["games"].filter("completed").select(F.col("id").alias("game_id"), (F.col("home_points") > F.col("away_points")).cast("double").alias("won"))
    return t["plays"].select("game_id", "score_diff", F.expr(STATE_SECONDS_SQL).alias("seconds")).join(games, "game_id")


def live_wp_calibration(t, sigmas: tuple[float, ...] = (10.0, 13.0, 16.0, 19.0)) -> DataFrame:
    """Brier score of the closed-form probability under each spread, and the best one."""
    states = _live_states(t).withColumn("sigma", F.explode(F.array(*[F.lit(s) for s in sigmas])))
    p = live_win_probability(F.col("score_diff").cast("double"), F.lit(0.0), F.col("seconds"), F.col("sigma"))
    out = states.groupBy("sigma").agg(F.avg(F.pow(p - F.col("won"), F.lit(2.0))).alias("brier"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("is_best", F.rank().over(Window.orderBy("brier")) == 1)  # one row for each spread


def live_wp_deciles(t, sigma: float = 16.0) -> DataFrame:
    """Predicted against observed by tenths of the probability, the last one closed."""
    states = _live_states(t).select("won", live_win_probability(F.col("score_diff").cast("double"), F.lit(0.0), F.col("seconds"), sigma).alias("p"))
    return states.groupBy(F.least(F.floor(F.col("p") * 10), F.lit(9)).alias("decile")).agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("predicted"), F.avg("won").alias("observed"))
