"""Fitted models of contests: frozen means, walk-forward ridge and logistic fits, calibration, scoring.

A contest's raw row is (1, neutral, d, k, y): d the differences of both sides' features with 0 for nulls, k the differences of
their null flags. A side imputed with a mean m before differencing is then d + m k, so the moments of these rows, summed once by
season, give every window's means, scales and ridge fit, whatever its means are; windows are prefix sums over seasons.
Logistic fits are Newton steps whose gradients and Hessians are summed on Spark for all windows in one job a step.
Contests are kept as ``features.contest_weeks``: the numbers of both sides' weeks and their own ratings. The weeks' vectors, one a team and
week of the calendar, go to the executors (``Weeks``), so a vector is not written once a contest. Beside them only matrices of the
number of features reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import features as ft
from .predictions import market_lines

#: What a fit reads of each side, and how strongly coefficients are pulled to zero.
FEATURES = [
    "elo_pregame", "adj_epa_off", "adj_epa_def", "off_epa_per_play", "def_epa_per_play_allowed", "off_success_rate", "def_success_rate_allowed", "off_explosiveness_rate", "off_plays_per_game",
    "havoc_rate_defense", "havoc_rate_offense_allowed", "returning_ppa_pct", "preseason_sp_rating", "recruiting_points_3yr", "blue_chip_pipeline", "hc_first_year_unproven", "draft_picks_3yr",
    "draft_departures", "prior_def_line_yards", "prior_def_stuff_rate", "off_ppd",
]
RIDGE, LOGISTIC_RIDGE = 7.0, 1e-3
#: The first season that is learned from, seasons that a window needs, and the share of contests to come that must have a score.
FIRST_SEASON, LEAST_SEASONS, LEAST_COVERAGE = 2015, 3, 0.90
MAX_LOGIT, LEAST_WEIGHT, STEPS, TOLERANCE = 35.0, 1e-6, 25, 1e-8


@dataclass
class Fit:
    """A frozen fit: its last season, what it was learned from, means, scales, and both models."""

    through: int
    n: int
    names: list[str]
    means: np.ndarray  # of a side's features, nan where all are null
    diff_means: np.ndarray
    diff_stds: np.ndarray
    margin: np.ndarray  # constant, neutral site, features
    win: np.ndarray = field(default_factory=lambda: np.zeros(0))
    platt: tuple[float, float] = (1.0, 0.0)

    def design(self, d: np.ndarray, k: np.ndarray, neutral: np.ndarray) -> np.ndarray:
        """Rows as the models read them: imputed, differenced, scaled by the frozen values; a feature that never varied is 0."""
        out = np.empty((len(d), d.shape[1] + 2))
        out[:, 0], out[:, 1] = 1.0, neutral
        z = np.multiply(k, np.nan_to_num(self.means), out=out[:, 2:])
        z += d
        z -= self.diff_means
        z *= self._scale()
        return out

    def _scale(self) -> np.ndarray:
        return np.where(self.diff_stds > 0, 1 / np.where(self.diff_stds > 0, self.diff_stds, 1.0), 0.0)

    def logit(self, d: np.ndarray, k: np.ndarray, neutral: np.ndarray) -> np.ndarray:
        """``design`` times ``win``, without the scaled rows."""
        own = self.win[2:] * self._scale()
        return self.win[0] - own @ self.diff_means + self.win[1] * neutral + d @ own + k @ (np.nan_to_num(self.means) * own)


#: The feature that is a contest's own; all others are those of a side's week.
OWN = "elo_pregame"
#: Columns of ``features.contest_weeks`` that fits read.
BY_WEEK = ["season", "neutral", "margin", "home_id", "away_id", "home_elo", "away_elo"]


class Weeks:
    """The vectors of ``features.week_vectors`` by id: as many rows as the calendar has of teams' weeks."""

    def __init__(self, weeks: DataFrame, names: list[str]):
        values = F.array(*[F.lit(None).cast("double") if c == OWN else F.col(c).cast("double") for c in names])
        got = weeks.select("id", values.alias("v")).toPandas().sort_values("id")  # one row a team and week
        rows = np.array([np.asarray(v, dtype=float) for v in got["v"]]).reshape(len(got), len(names))
        self.own = names.index(OWN) if OWN in names else None
        if self.own is not None:
            rows[:, self.own] = 0.0
        self.values, self.null = np.nan_to_num(rows), np.isnan(rows).astype(float)

    def arrays(self, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``_arrays`` of contests by week."""
        home, away = (self.values[batch[f"{s}_id"].to_numpy()] for s in ("home", "away"))
        no_home, no_away = (self.null[batch[f"{s}_id"].to_numpy()] for s in ("home", "away"))
        if self.own is not None:
            home[:, self.own], away[:, self.own] = batch["home_elo"], batch["away_elo"]
        return home - away, no_home - no_away, home + away, 2 - no_home - no_away

    def rows(self, batch: pd.DataFrame) -> dict[str, np.ndarray]:
        """What ``_unpacked_rows`` gives, by season."""
        batch = batch.iloc[np.argsort(batch["season"].to_numpy(), kind="stable")]
        home, away = batch["home_id"].to_numpy(), batch["away_id"].to_numpy()
        d, k = self.values[home] - self.values[away], self.null[home] - self.null[away]
        if self.own is not None:
            d[:, self.own] = batch["home_elo"] - batch["away_elo"]
        return {"season": batch["season"].to_numpy(), "neutral": batch["neutral"].to_numpy(dtype=float), "won": (batch["margin"].to_numpy() > 0).astype(float), "d": d, "k": k}


def in_full(rows: DataFrame, weeks: DataFrame, names: list[str]) -> DataFrame:
    """``features.contest_weeks`` in the form of ``contests``: the weeks' values meet them by broadcast."""
    values = F.array(*[F.lit(None).cast("double") if c == OWN else F.col(c).cast("double") for c in names])
    held = weeks.select("id", values.alias("v"))
    for s in ("home", "away"):
        rows = rows.join(F.broadcast(held.select(F.col("id").alias(f"{s}_id"), F.col("v").alias(f"_{s}"))), f"{s}_id")  # one row a team and week
    side = lambda s: F.array(*[F.col(f"{s}_elo") if c == OWN else F.col(f"_{s}")[i] for i, c in enumerate(names)]).alias(s)
    return rows.select("game_id", "season", F.col("neutral").cast("double").alias("neutral"), "played", "margin", (F.col("margin") > 0).cast("double").alias("won"), side("home"), side("away"))


def contests(vectors: DataFrame, games: DataFrame, names: list[str]) -> DataFrame:
    """(game_id, season, neutral, played, margin, won, home: array, away: array) of contests that have both sides' vectors."""
    values = F.array(*[F.col(c).cast("double") for c in names])
    both = vectors.groupBy("game_id").agg(F.first(F.when(F.col("side") == "home", values), ignorenulls=True).alias("home"), F.first(F.when(F.col("side") == "away", values), ignorenulls=True).alias("away"))
    margin = (F.col("home_points") - F.col("away_points")).cast("double")
    played = F.coalesce("completed", F.lit(False)) & margin.isNotNull()
    info = games.select(F.col("id").alias("game_id"), "season", F.coalesce(F.col("neutral_site").cast("double"), F.lit(0.0)).alias("neutral"), played.alias("played"), margin.alias("margin"), (F.col("home_points") > F.col("away_points")).cast("double").alias("won"))
    return info.join(both.filter("home IS NOT NULL AND away IS NOT NULL"), "game_id")


def _arrays(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of contests: differences with 0 for nulls, differences of null flags, and the sums and counts of both sides' known values."""
    home, away = (np.stack([np.asarray(v, dtype=float) for v in batch[c]]) for c in ("home", "away"))
    known = (~np.isnan(home)).astype(int) + (~np.isnan(away)).astype(int)
    return np.nan_to_num(home) - np.nan_to_num(away), np.isnan(home).astype(float) - np.isnan(away).astype(float), np.nan_to_num(home) + np.nan_to_num(away), known


def _packed_rows(batches):
    """Of contests: season, neutral, won, d and k as the bytes of one array of doubles each, so that steps need not take apart lists of numbers again."""
    for batch in batches:
        d, k, _, _ = _arrays(batch)
        u = np.column_stack([batch["season"], batch["neutral"], batch["won"], d, k]).astype(float)
        yield pd.DataFrame({"row": [x.tobytes() for x in u]})


def _unpacked_rows(rows: pd.Series, p: int) -> dict[str, np.ndarray]:
    """The arrays of ``_packed_rows``, by season, so that a window is a batch's first rows."""
    u = np.frombuffer(b"".join(rows), dtype=float).reshape(len(rows), 3 + 2 * p)
    u = u[np.argsort(u[:, 0], kind="stable")]
    return {"season": u[:, 0], "neutral": u[:, 1], "won": u[:, 2], "d": u[:, 3 : 3 + p], "k": u[:, 3 + p :]}


def season_moments(rows: DataFrame, p: int, weeks: Weeks | None = None) -> dict[int, dict[str, np.ndarray]]:
    """Of each season's played contests: n, sums and counts of known values, and the product sums of (1, neutral, d, k, margin). One scan.

    ``weeks``: of contests by week.
    """
    arrays = _arrays if weeks is None else weeks.arrays

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for season, own in batch.groupby("season"):
                d, k, total, known = arrays(own)
                u = np.column_stack([np.ones(len(own)), own["neutral"], d, k, own["margin"]]).astype(float)
                sums[season] = sums.get(season, 0) + np.concatenate([[len(own)], total.sum(axis=0), known.sum(axis=0), (u.T @ u).ravel()])
        if sums:  # a partition without rows has no columns that Arrow could type
            yield pd.DataFrame({"season": list(sums), "m": list(sums.values())})

    columns = ["season", "neutral", "margin", "home", "away"] if weeks is None else BY_WEEK
    sums = rows.filter("played").select(*columns).mapInPandas(run, "season long, m array<double>")
    return {r["season"]: _split(np.array(r["m"]), p) for r in _summed(sums, ["season"]).collect()}  # one row a season


def _summed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the arrays ``m`` by key, place by place."""
    flat = df.select(*keys, F.posexplode("m").alias("i", "v")).groupBy(*keys, "i").agg(F.sum("v").alias("v"))
    return flat.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("m"))


def _split(m: np.ndarray, p: int) -> dict[str, np.ndarray]:
    return {"n": m[:1], "total": m[1 : 1 + p], "known": m[1 + p : 1 + 2 * p], "gram": m[1 + 2 * p :].reshape(2 * p + 3, 2 * p + 3)}


def window_fit(through: int, m: dict[str, np.ndarray], names: list[str], alpha: float = RIDGE) -> Fit:
    """M9's statistics and M10's ridge from a window's moments."""
    p, n = len(names), float(m["n"][0])
    with np.errstate(invalid="ignore", divide="ignore"):
        means = np.where(m["known"] > 0, m["total"] / m["known"], np.nan)
    # (1, neutral, d + mean k, margin) from (1, neutral, d, k, margin).
    to = np.zeros((2 * p + 3, p + 3))
    to[0, 0] = to[1, 1] = to[-1, -1] = 1
    to[2 : 2 + p, 2 : 2 + p] = np.eye(p)
    to[2 + p : 2 + 2 * p, 2 : 2 + p] = np.diag(np.nan_to_num(means))
    gram = to.T @ m["gram"] @ to
    centre = gram[0, 2 : 2 + p] / n
    spread = np.diag(gram)[2 : 2 + p] / n - centre**2
    # What cancellation leaves of a feature that never varies is no spread.
    stds = np.sqrt(np.where(spread > 1e-12 * np.maximum(1.0, centre**2), spread, 0.0))
    scale = np.where(stds > 0, 1 / np.where(stds > 0, stds, 1), 0.0)
    norm = np.zeros((p + 3, p + 3))
    norm[0, 0] = norm[1, 1] = norm[-1, -1] = 1
    norm[2 : 2 + p, 2 : 2 + p] = np.diag(scale)
    norm[0, 2 : 2 + p] = -centre * scale
    gram = norm.T @ gram @ norm
    penalty = np.diag([0.0, *[alpha] * (p + 1)])
    return Fit(through, int(n), names, means, centre, stds, np.linalg.solve(gram[:-1, :-1] + penalty, gram[:-1, -1]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -MAX_LOGIT, MAX_LOGIT)))


def newton(rows: DataFrame, designs: Callable[[pd.DataFrame], dict[int, tuple[np.ndarray, np.ndarray]]], sizes: dict[int, int], alpha: float) -> dict[int, np.ndarray]:
    """Penalised logistic fits by Newton steps, of several models at once; the first coefficient is not penalised.

    ``designs`` gives a batch's (rows, outcomes) of each model that they belong to. Gradients, Hessians and likelihoods are summed on
    Spark, one job a step. Weights have a floor; a model that does not settle gets its best coefficients by likelihood.
    """
    beta = {k: np.zeros(p) for k, p in sizes.items()}
    best: dict[int, tuple[float, np.ndarray]] = {}
    settled: set[int] = set()
    for step in range(STEPS + 1):
        left = {k: b for k, b in beta.items() if k not in settled}
        if not left:
            break

        def run(batches, left=left):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, (x, y) in designs(batch).items():
                    if k not in left or not len(x):
                        continue
                    p = _sigmoid(x @ left[k])
                    w = np.maximum(p * (1 - p), LEAST_WEIGHT)
                    safe = np.clip(p, LEAST_WEIGHT, 1 - LEAST_WEIGHT)
                    loss = -(y * np.log(safe) + (1 - y) * np.log(1 - safe)).sum()
                    sums[k] = sums.get(k, 0) + np.concatenate([[loss], x.T @ (p - y), ((x.T * w) @ x).ravel()])
            if sums:  # a partition without rows has no columns that Arrow could type
                yield pd.DataFrame({"model": list(sums), "m": list(sums.values())})

        got = {r["model"]: np.array(r["m"]) for r in _summed(rows.mapInPandas(run, "model long, m array<double>"), ["model"]).collect()}  # one row a model
        for k, b in left.items():
            p = len(b)
            m = got.get(k, np.zeros(1 + p + p * p))
            penalty = np.array([0.0, *[alpha] * (p - 1)])
            loss = m[0] + 0.5 * float(penalty @ (b * b))
            if k not in best or loss < best[k][0]:
                best[k] = (loss, b)
            if step == STEPS:
                beta[k] = best[k][1]
                continue
            try:
                change = np.linalg.solve(m[1 + p :].reshape(p, p) + np.diag(penalty), m[1 : 1 + p] + penalty * b)
            except np.linalg.LinAlgError:
                beta[k] = best[k][1]
                settled.add(k)
                continue
            beta[k] = b - change
            if np.abs(change).max() < TOLERANCE:
                settled.add(k)
    return beta


def platt(rows: DataFrame, logits: Callable[[pd.DataFrame], dict[int, tuple[np.ndarray, np.ndarray]]], models: list[int]) -> dict[int, tuple[float, float]]:
    """(a, b) of each model, so that 1 / (1 + exp(-(a logit + b))) is calibrated: a second logistic fit, without penalty."""

    def designs(batch: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return {k: (np.column_stack([np.ones(len(z)), z]), y) for k, (z, y) in logits(batch).items()}

    return {k: (float(b[1]), float(b[0])) for k, b in newton(rows, designs, dict.fromkeys(models, 2), 0.0).items()}


def walk_forward_train(rows: DataFrame, names: list[str], first: int = FIRST_SEASON, least: int = LEAST_SEASONS, weeks: Weeks | None = None) -> list[Fit]:
    """A frozen fit for each season with ``least`` or more seasons up to it; that of season S is learned from ``first`` to S.

    All windows' moments come from one scan of ``rows`` (``contests``, or with ``weeks`` contests by week, kept by the caller), prefix sums
    over the seasons. Contests not played are not read.
    """
    own = rows.filter(F.col("played") & (F.col("season") >= first))
    if weeks is None:
        kept = own.select("season", "neutral", "margin", "won", "played", "home", "away").mapInPandas(_packed_rows, "row binary").persist()
        read = lambda batch: _unpacked_rows(batch["row"], len(names))
    else:
        kept, read = own.select(*BY_WEEK), weeks.rows
    try:
        by_season = season_moments(own, len(names), weeks)
        fits, run = [], None
        for season in sorted(by_season):
            m = by_season[season]
            run = m if run is None else {k: run[k] + m[k] for k in m}
            if season - first + 1 >= least:
                fits.append(window_fit(season, run, names))

        def windows(batch: pd.DataFrame):
            """Each fit with its contests' d, k and neutral, and whether they were won."""
            u = read(batch)
            ends = np.searchsorted(u["season"], [f.through for f in fits], side="right")
            for f, n in zip(fits, ends, strict=True):
                yield f, (u["d"][:n], u["k"][:n], u["neutral"][:n]), u["won"][:n]

        win = newton(kept, lambda batch: {f.through: (f.design(*x), y) for f, x, y in windows(batch)}, {f.through: len(names) + 2 for f in fits}, LOGISTIC_RIDGE)
        for f in fits:
            f.win = win[f.through]
        calibrated = platt(kept, lambda batch: {f.through: (f.logit(*x), y) for f, x, y in windows(batch)}, [f.through for f in fits])
        for f in fits:
            f.platt = calibrated[f.through]
    finally:
        if weeks is None:
            kept.unpersist()
    return fits


FIT_ROWS = "train_through long, n_train long, feature_order long, feature string, feature_mean double, diff_mean double, diff_std double, margin double, win double, platt_a double, platt_b double"


def fit_rows(spark, fits: list[Fit]) -> DataFrame:
    """Fits as rows (FIT_ROWS): with each fit its feature contract, so that scoring can check it."""
    out = []
    for f in fits:
        for i, name in enumerate(["constant", "neutral_site", *f.names]):
            own = [None, None, None] if i < 2 else [float(x) if x == x else None for x in (f.means[i - 2], f.diff_means[i - 2], f.diff_stds[i - 2])]
            out.append((f.through, f.n, i, name, *own, float(f.margin[i]), float(f.win[i]), *f.platt))
    return spark.createDataFrame(out, FIT_ROWS)


def in_force(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Contests with ``through``: of those played the season before, if it has a fit; of those to come the latest fit."""
    known = fits.select(F.col("train_through").alias("through")).distinct()
    latest = known.agg(F.max("through").alias("latest"))
    asked = rows.crossJoin(F.broadcast(latest)).withColumn("through", F.when(F.col("played"), F.col("season") - 1).otherwise(F.col("latest"))).drop("latest")
    return asked.join(F.broadcast(known), "through")  # one row a season


def packed(fits: DataFrame, names: list[str]) -> DataFrame:
    """(through, and arrays by feature): one row a fit. A fit of other features than ``names`` is an error."""
    order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("feature_order", F.col(c).alias("v")))), lambda x: x["v"])
    one = fits.groupBy(F.col("train_through").alias("through")).agg(order("feature").alias("features"), *[order(c).alias(f"f_{c}") for c in ("feature_mean", "diff_mean", "diff_std", "margin", "win")], F.max("platt_a").alias("platt_a"), F.max("platt_b").alias("platt_b"))
    contract = F.array(*[F.lit(x) for x in ["constant", "neutral_site", *names]])
    checked = F.when(F.col("features") == contract, F.col("through")).otherwise(F.raise_error(F.lit("fit of other features")).cast("long"))
    return one.withColumn("through", checked).drop("features")


def _scaled(i: int) -> Column:
    """The i-th feature of a contest, imputed, differenced and scaled by the fit in force."""
    at = i + 2
    mean = F.coalesce(F.col("f_feature_mean")[at], F.lit(0.0))
    x = F.coalesce(F.col("home")[i], mean) - F.coalesce(F.col("away")[i], mean)
    std = F.col("f_diff_std")[at]
    return F.when(std > 0, (x - F.col("f_diff_mean")[at]) / std).otherwise(0.0)


def design_matrix(rows: DataFrame, fits: DataFrame, names: list[str]) -> DataFrame:
    """M9: (game_id, season, through, neutral_site, one column a feature) under the statistics of the fit in force."""
    met = in_force(rows, fits).join(F.broadcast(packed(fits, names)), "through")
    return met.select("game_id", "season", "through", F.col("neutral").alias("neutral_site"), *[_scaled(i).alias(f"d_{c}") for i, c in enumerate(names)])


def score(rows: DataFrame, fits: DataFrame, names: list[str], market: DataFrame) -> DataFrame:
    """game_id, season, through, played, expected_margin, home_win_prob, market_spread, edge, edge_pick of each contest with a fit in force."""
    met = in_force(rows, fits).join(F.broadcast(packed(fits, names)), "through")
    z = F.array(F.lit(1.0), F.col("neutral"), *[_scaled(i) for i in range(len(names))])
    dot = lambda c: F.aggregate(F.zip_with("z", c, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return _told(met.withColumn("z", z).select("game_id", "season", "through", "played", "platt_a", "platt_b", dot("f_margin").alias("margin"), dot("f_win").alias("win")), market)


def _told(rows: DataFrame, market: DataFrame) -> DataFrame:
    """M13's columns from both models' sums."""
    limit = lambda x: F.greatest(F.lit(-MAX_LOGIT), F.least(F.lit(MAX_LOGIT), x))
    out = rows.select("game_id", "season", "through", "played", F.col("margin").alias("expected_margin"), (1 / (1 + F.exp(-limit(F.col("platt_a") * F.col("win") + F.col("platt_b"))))).alias("home_win_prob"))
    out = out.join(market.select("game_id", F.col("spread").alias("market_spread")), "game_id", "left").withColumn("edge", F.col("expected_margin") + F.col("market_spread"))
    return out.withColumn("edge_pick", F.when(F.col("edge") >= 0, "home").when(F.col("edge") < 0, "away"))


def week_terms(weeks: DataFrame, fits: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """What a fit's sums are made of: (through, id, margin, win) of each fit and week's vector, and of each fit what it adds to every contest.

    A model's sum is linear in both sides' imputed values, so it is a side's term less the other's; a contest's own feature is left out.
    """
    one = packed(fits, names)
    share = lambda c, i: F.when(F.col("f_diff_std")[i + 2] > 0, F.col(f"f_{c}")[i + 2] / F.col("f_diff_std")[i + 2]).otherwise(0.0)
    value = lambda c, i: F.coalesce(F.col(c).cast("double"), F.col("f_feature_mean")[i + 2], F.lit(0.0))
    total = lambda parts: reduce(add, parts, F.lit(0.0))
    sides = weeks.select("id", *[c for c in names if c != OWN]).crossJoin(F.broadcast(one))  # one row a season
    terms = sides.select("through", "id", *[total(share(m, i) * value(c, i) for i, c in enumerate(names) if c != OWN).alias(m) for m in ("margin", "win")])
    base = lambda m: F.col(f"f_{m}")[0] - total(share(m, i) * F.col("f_diff_mean")[i + 2] for i in range(len(names)))
    own = lambda m: share(m, names.index(OWN)) if OWN in names else F.lit(0.0)
    return terms, one.select("through", "platt_a", "platt_b", *[x for m in ("margin", "win") for x in (base(m).alias(f"{m}_base"), F.col(f"f_{m}")[1].alias(f"{m}_neutral"), own(m).alias(f"{m}_own"))])


def score_by_week(rows: DataFrame, weeks: DataFrame, fits: DataFrame, names: list[str], market: DataFrame) -> DataFrame:
    """``score`` of contests by week: both sides' terms and the fit meet a contest by broadcast, as many rows as weeks and fits there are."""
    terms, one = week_terms(weeks, fits, names)
    met = in_force(rows, fits).join(F.broadcast(one), "through")
    for s in ("home", "away"):
        met = met.join(F.broadcast(terms.select("through", F.col("id").alias(f"{s}_id"), *[F.col(m).alias(f"{s}_{m}") for m in ("margin", "win")])), ["through", f"{s}_id"])
    elo, neutral = F.col("home_elo") - F.col("away_elo"), F.col("neutral").cast("double")
    sums = [(F.col(f"{m}_base") + neutral * F.col(f"{m}_neutral") + elo * F.col(f"{m}_own") + (F.col(f"home_{m}") - F.col(f"away_{m}"))).alias(m) for m in ("margin", "win")]
    return _told(met.select("game_id", "season", "through", "played", "platt_a", "platt_b", *sums), market)


def coverage(pending: DataFrame, scored: DataFrame, least: float = LEAST_COVERAGE) -> DataFrame:
    """One row: contests to come, how many of them are scored, the share (1 where there are none), and whether that is enough."""
    met = pending.select("game_id").join(scored.select("game_id").distinct().withColumn("ok", F.lit(1)), "game_id", "left")
    share = F.when(F.col("pending") == 0, 1.0).otherwise(F.col("scored") / F.nullif("pending", F.lit(0)))
    return met.agg(F.count(F.lit(1)).alias("pending"), F.count("ok").alias("scored")).withColumn("share", share).withColumn("ok", F.col("share") >= least)


def trained(t, names: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The weeks' vectors (with fits only where one of ``names`` comes from fits), contests by week (kept, as every step reads them) and fits."""
    weeks, rows = ft.calendar(t, any(c in ft.FITTED for c in names))
    return weeks, rows, fit_rows(t.spark, walk_forward_train(rows, names, weeks=Weeks(weeks, names)))


#: Features that need no adjusted fits: those of the queries that SQL can follow.
PLAIN = [c for c in FEATURES if c not in ft.FITTED]


def fits_of_seasons(t) -> DataFrame:
    """M12 as a query."""
    return trained(t, FEATURES)[2]


def moments_by_window(rows: DataFrame, names: list[str], first: int = FIRST_SEASON, least: int = LEAST_SEASONS) -> DataFrame:
    """(train_through, n_train, feature, feature_mean): the frozen means of every window, prefix sums over the seasons' sums."""
    side = rows.filter(F.col("played") & (F.col("season") >= first)).select("season", F.explode(F.array("home", "away")).alias("v"))
    sums = side.groupBy("season").agg((F.count(F.lit(1)) / 2).cast("long").alias("n"), *[x for i in range(len(names)) for x in (F.sum(F.col("v")[i]).alias(f"s{i}"), F.count(F.col("v")[i]).alias(f"c{i}"))])
    upto = Window.orderBy("season").rowsBetween(Window.unboundedPreceding, 0)  # one row a season
    run = sums.select("season", *[F.sum(c).over(upto).alias(c) for c in sums.columns if c != "season"]).filter(F.col("season") >= first + least - 1)
    each = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"s{i}") / F.nullif(F.col(f"c{i}"), F.lit(0))).alias("feature_mean")) for i, c in enumerate(names)])
    return run.select(F.col("season").alias("train_through"), F.col("n").alias("n_train"), F.explode(each).alias("x")).select("train_through", "n_train", "x.*")


def frozen_means(t) -> DataFrame:
    """M9's statistics as a query."""
    weeks, rows = ft.calendar(t, False)
    return moments_by_window(in_full(rows, weeks, PLAIN), PLAIN)


def design_of_contests(t) -> DataFrame:
    """M9 as a query."""
    weeks, rows, fits = trained(t, PLAIN)
    return design_matrix(in_full(rows, weeks, PLAIN), fits, PLAIN)


def scores(t, vectors: DataFrame | None = None) -> DataFrame:
    """M13 as a query; ``vectors``: M5's with fits, where they are others than these tables' own."""
    if vectors is None or vectors is t._made.get("fitted_features"):
        weeks, rows, fits = trained(t, FEATURES)
        return score_by_week(rows, weeks, fits, FEATURES, market_lines(t))
    rows = contests(vectors, t["games"], FEATURES).persist()
    return score(rows, fit_rows(t.spark, walk_forward_train(rows, FEATURES)), FEATURES, market_lines(t))


def scored_coverage(t) -> DataFrame:
    """M13's verdict on the contests to come."""
    weeks, rows, fits = trained(t, PLAIN)
    return coverage(rows.filter("NOT played"), score_by_week(rows, weeks, fits, PLAIN, market_lines(t)))


def as_predictions(t) -> DataFrame:
    """M13's rows in the form of the predictions that K37, K38, M26, M28 and M36 read."""
    out = scores(t)
    return out.select("game_id", "season", F.lit("fitted").alias("model_version"), F.lit(1).cast("long").alias("prediction_day"), "expected_margin", "home_win_prob", "market_spread")


def over_fitted(plan: Callable, t) -> DataFrame:
    """A query over the predictions table, with M13's rows in its place."""
    given = dict(t._made)
    given["game_predictions"] = as_predictions(t)
    return plan(type(t)(t.spark, t.folder, given))


def ratings_logistic(t) -> DataFrame:
    """M11 over the test tables: whether the home side wins, from pregame ratings; calibrated."""
    rows = t["house_elo_game"].select(F.col("home_pregame_elo").alias("h"), F.col("away_pregame_elo").alias("a"), F.col("neutral_site").cast("double").alias("neutral"), (F.col("actual_home_margin") > 0).cast("double").alias("won")).persist()
    stats = rows.agg(F.avg(F.col("h") - F.col("a")).alias("m"), F.stddev_pop(F.col("h") - F.col("a")).alias("s")).first()
    mean, std = stats["m"] or 0.0, stats["s"] or 1.0

    def designs(batch: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return {0: (np.column_stack([np.ones(len(batch)), batch["neutral"], (batch["h"] - batch["a"] - mean) / std]), batch["won"].to_numpy(dtype=float))}

    beta = newton(rows, designs, {0: 3}, LOGISTIC_RIDGE)
    a, b = platt(rows, lambda batch: {0: (designs(batch)[0][0] @ beta[0], designs(batch)[0][1])}, [0])[0]
    rows.unpersist()
    names = ["constant", "neutral", "rating_difference", "platt_a", "platt_b"]
    return t.spark.createDataFrame([(n, float(v)) for n, v in zip(names, [*beta[0], a, b], strict=True)], "feature string, coefficient double")
