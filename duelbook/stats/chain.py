"""Drive chains: states of a possession as an absorbing Markov chain, by era.

Counting, shrinking and pairing run on Spark over all plays and drives; only the small systems of an era (at most some 200
states) are solved in a worker.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_if, is_garbage_time

#: Kinds of plays that are snaps from scrimmage.
SCRIMMAGE = [
    "Rush", "Pass Reception", "Pass Incompletion", "Pass Completion", "Sack", "Rushing Touchdown", "Passing Touchdown", "Interception", "Pass Interception Return",
    "Interception Return Touchdown", "Fumble Recovery (Own)", "Fumble Recovery (Opponent)", "Fumble Return Touchdown", "Safety",
]
#: What a drive's result absorbs into.
RESULTS = {
    "TD": ["TD", "RUSHING TD", "PASSING TD"],
    "FG": ["FG", "FG GOOD", "MADE FG"],
    "MISSED_FG": ["MISSED FG", "BLOCKED FG", "FG MISSED"],
    "PUNT": ["PUNT", "BLOCKED PUNT"],
    "TURNOVER": ["INT", "FUMBLE"],
    "TURNOVER_TD": ["MISSED FG TD", "PUNT RETURN TD", "PUNT TD", "BLOCKED PUNT TD", "INT TD", "FUMBLE TD", "FUMBLE RETURN TD", "INT RETURN TOUCH", "PUNT RETURN TD TD", "DOWNS TD"],
    "DOWNS": ["DOWNS", "TURNOVER ON DOWNS", "POSS. ON DOWNS"],
    "SAFETY": ["SF"],
    "END_OF_HALF": ["END OF HALF", "END OF HALF TD", "END OF GAME", "END OF 4TH QUARTER"],
}
#: Points of the absorbing states (others are worth 0), and those that hand the ball over without a score.
POINTS = {"TD": 6.97, "FG": 3.0, "SAFETY": -2.0, "TURNOVER_TD": -6.97}
HANDED_OVER = ["PUNT", "TURNOVER", "DOWNS", "MISSED_FG"]
OVERTIME = "POSSESSION (FOR OT DRIVES)"
SHRINK_ALPHA, HANDOFF_ALPHA, TOLERANCE, LEAST_STARTS = 50.0, 20.0, 0.02, 50
#: Eras by first season, and the share of drives with an unmapped result that each may have.
ERAS = [(2021, "2021+"), (2014, "2014-2020"), (2004, "2004-2013")]
MAX_UNMAPPED = {"2021+": 0.02, "2014-2020": 0.02, "2004-2013": 0.05}
ENDS = list(RESULTS)


def era_of(season: str = "season") -> Column:
    return reduce(lambda rest, era: F.when(F.col(season) >= era[0], era[1]).otherwise(rest), reversed(ERAS), F.lit(None).cast("string"))


def zone(yards: str) -> Column:
    """Ten-yard band: 1 at the goal to be reached, 10 at the own one."""
    return F.least(F.lit(10), F.greatest(F.lit(1), F.floor((F.col(yards) + 9) / 10))).cast("long")


def distance_name() -> Column:
    """Goal-to-go first; then by down: a first down's distance is told against 10, the others' in four steps."""
    far = F.col("distance")
    first = F.when(far == 10, "standard").when(far < 10, "short").otherwise("long")
    later = F.when(far <= 3, "short").when(far <= 6, "med").when(far <= 10, "long").otherwise("xlong")
    return F.when(far >= F.col("yards_to_goal"), "goal").when(F.col("down") == 1, first).otherwise(later)


def state_key() -> Column:
    return F.concat(F.lit("d"), F.col("down").cast("string"), F.lit("|"), distance_name(), F.lit("|z"), zone("yards_to_goal").cast("string"))


def part_of(state: str, number: int) -> Column:
    return F.split_part(F.col(state), F.lit("|"), F.lit(number))


def absorbed(result: Column) -> Column:
    return reduce(lambda rest, end: F.when(F.upper(result).isin(RESULTS[end]), end).otherwise(rest), ENDS, F.lit(None).cast("string"))


def snaps(plays: DataFrame) -> DataFrame:
    """Plays from scrimmage in contests that are not decided."""
    return plays.filter(F.col("play_type").isin(SCRIMMAGE) & F.col("down").between(1, 4) & F.col("distance").between(1, 45) & F.col("yards_to_goal").between(1, 99) & ~is_garbage_time())


def chain_rows(t) -> DataFrame:
    """era, game_id, drive_id, from_state, to_state (null: the drive's result is unmapped), first (whether it is the drive's first snap), end."""
    drives = t["drives"].filter(F.col("drive_result") != OVERTIME).select(F.col("id").alias("drive_id"), "game_id", absorbed(F.col("drive_result")).alias("end"))
    rows = snaps(t["plays"]).select("drive_id", "game_id", era_of().alias("era"), "play_number", "id", state_key().alias("from_state")).join(drives, ["drive_id", "game_id"])
    order = Window.partitionBy("game_id", "drive_id").orderBy("play_number", "id")
    follow = F.when(F.col("end").isNotNull(), F.coalesce(F.lead("from_state").over(order), F.col("end")))
    return rows.select("era", "game_id", "drive_id", "from_state", follow.alias("to_state"), F.lag("from_state").over(order).isNull().alias("first"), "end").filter("era IS NOT NULL")


def guarded(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, from_state, to_state, n, starts, scored) from rows that also count a state's first snaps with an unmapped result.

    If an era has too many of those, reading any count is an error; else drives with an unmapped result are left out.
    """
    of_era = Window.partitionBy(*keys)
    limit = F.create_map(*[F.lit(x) for kv in MAX_UNMAPPED.items() for x in kv])[F.col("era")]
    bad, all_ = F.sum("unmapped").over(of_era), F.sum(F.col("starts") + F.col("unmapped")).over(of_era)
    text = F.concat(bad.cast("string"), F.lit(" of "), all_.cast("string"), F.lit(" drives have an unmapped result in "), F.col("era"))
    n = F.when(bad > limit * all_, F.raise_error(text).cast("long")).otherwise(F.col("n"))
    return counts.withColumn("n", n).filter("to_state IS NOT NULL").drop("unmapped")


def transitions(rows: DataFrame, keys: tuple[str, ...] = ("era",), *more: Column) -> DataFrame:
    """(keys, from_state, to_state, n, and of the state's first snaps: starts, scored (those of drives that end in TD), unmapped; and ``more`` sums); one aggregate."""
    first = F.col("first")
    return rows.groupBy(*keys, "from_state", "to_state").agg(F.count(F.lit(1)).alias("n"), count_if(first & F.col("end").isNotNull()).alias("starts"), count_if(first & (F.col("end") == "TD")).alias("scored"), count_if(first & F.col("end").isNull()).alias("unmapped"), *more)


def drive_state_transitions(t) -> DataFrame:
    """(era, from_state, to_state, n)."""
    return guarded(transitions(chain_rows(t)), ("era",)).select("era", "from_state", "to_state", "n")


def _shrunk(g: pd.DataFrame, alpha: float) -> pd.DataFrame:
    """(from_state, to_state, p) of one down's counts."""
    froms, at = np.unique(g["from_state"], return_inverse=True)
    ends, to = np.unique(g["to_state"], return_inverse=True)
    n = np.zeros((len(froms), len(ends)))
    np.add.at(n, (at, to), g["n"].to_numpy(dtype=float))
    parts = [s.split("|") for s in froms]
    _, parent = np.unique([f"{x[0]}|{x[2]}" for x in parts], return_inverse=True)
    own = np.zeros((parent.max() + 1, len(ends)))
    np.add.at(own, parent, n)
    above = n.sum(axis=0) / n.sum()
    pulled = (own + alpha * above) / (own.sum(axis=1, keepdims=True) + alpha)
    p = (n + alpha * pulled[parent]) / (n.sum(axis=1, keepdims=True) + alpha)
    return pd.DataFrame({"from_state": np.repeat(froms, len(ends)), "to_state": np.tile(ends, len(froms)), "p": p.ravel()})


def shrink(counts: DataFrame, alpha: float = SHRINK_ALPHA, keys: tuple[str, ...] = ("era",)) -> DataFrame:
    """Each row pulled to its parent (down and zone), the parent to the grandparent (down), over all of the grandparent's targets.

    One down's counts, at most some 60 states by 70 targets, meet in one group; the counts are read once.
    """
    names = [*keys, "from_state", "to_state", "p"]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        return _shrunk(g, alpha).assign(**{k: g[k].iloc[0] for k in keys})[names]

    schema = ", ".join([*[f"{k} {counts.schema[k].dataType.simpleString()}" for k in keys], "from_state string, to_state string, p double"])
    return counts.withColumn("down", part_of("from_state", 1)).groupBy(*keys, "down").applyInPandas(run, schema)


def _matrices(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States, fundamental matrix, and one-step probabilities of absorption."""
    states = np.unique(g["from_state"])
    q, r = np.zeros((len(states), len(states))), np.zeros((len(states), len(ENDS)))
    at = np.searchsorted(states, g["from_state"])
    inside = g["to_state"].isin(states).to_numpy()
    q[at[inside], np.searchsorted(states, g["to_state"][inside])] = g["p"][inside]
    stop = g["to_state"].isin(ENDS).to_numpy()
    r[at[stop], [ENDS.index(x) for x in g["to_state"][stop]]] = g["p"][stop]
    return states, np.linalg.inv(np.eye(len(states)) - q), r


def absorbing_chain(probs: DataFrame, keys: dict[str, str] | None = None) -> DataFrame:
    """Absorption probabilities and expected points of each state; one small solve for each group of ``keys`` (name to type)."""
    keys = keys or {"era": "string"}
    columns = [*keys, "state", *[f"p_{e.lower()}" for e in ENDS], "expected_points"]

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        states, inverse, r = _matrices(g)
        b = inverse @ r
        out = pd.DataFrame(b, columns=[f"p_{e.lower()}" for e in ENDS])
        return out.assign(state=states, expected_points=b @ np.array([POINTS.get(e, 0.0) for e in ENDS]), **{k: g[k].iloc[0] for k in keys})[columns]

    schema = ", ".join([*[f"{k} {v}" for k, v in keys.items()], "state string", *[f"p_{e.lower()} double" for e in ENDS], "expected_points double"])
    return probs.groupBy(*keys).applyInPandas(solve, schema)


def drive_handoffs(t, alpha: float = HANDOFF_ALPHA) -> DataFrame:
    """(era, ending, exit_zone, zone, n, p): where the other side starts after a drive that ends without a score.

    Drives of regulation are paired before the pairs are cut to the same half and the other side; the exit zone is that of the
    drive's last snap in the chain. Rows are drawn to the ending's own distribution over zones (a tenth each where it never occurs).
    """
    last = snaps(t["plays"]).groupBy("game_id", "drive_id").agg(F.max_by(zone("yards_to_goal"), F.struct("play_number", "id")).alias("exit_zone"))
    half = F.when(F.col("start_period") <= 2, 1).otherwise(2)
    regular = F.col("start_period").between(1, 4)
    # Drives outside regulation stand in sequences of their own: they only tell which eras there are.
    w = Window.partitionBy("game_id", regular).orderBy("drive_number", "offense", "id")
    seq = t["drives"].withColumn("half", half)
    seq = seq.withColumns({"next_offense": F.lead("offense").over(w), "next_start": F.lead("start_yards_to_goal").over(w), "next_half": F.lead("half").over(w)})
    paired = regular & (F.col("next_offense") != F.col("offense")) & (F.col("next_half") == F.col("half")) & F.col("next_start").between(1, 99) & absorbed(F.col("drive_result")).isin(HANDED_OVER)
    rows = seq.select(era_of().alias("era"), "game_id", F.col("id").alias("drive_id"), F.when(paired, absorbed(F.col("drive_result"))).alias("ending"), F.when(paired, zone("next_start")).alias("zone")).filter("era IS NOT NULL")
    counted = rows.join(last, ["game_id", "drive_id"], "left").groupBy("era", "ending", "exit_zone", "zone").agg(F.count(F.lit(1)).alias("n"))
    names = ["era", "ending", "exit_zone", "zone", "n", "p"]

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros((len(HANDED_OVER), 10, 10))
        g_ = g[g["ending"].notna() & g["exit_zone"].notna()]
        np.add.at(n, ([HANDED_OVER.index(x) for x in g_["ending"]], g_["exit_zone"].to_numpy(dtype=int) - 1, g_["zone"].to_numpy(dtype=int) - 1), g_["n"].to_numpy(dtype=float))
        by_zone, total = n.sum(axis=1, keepdims=True), n.sum(axis=(1, 2), keepdims=True)
        own = np.where(total > 0, by_zone / np.maximum(total, 1), 0.1)
        p = (n + alpha * own) / (n.sum(axis=2, keepdims=True) + alpha)
        at = np.indices(n.shape)
        return pd.DataFrame({"era": g["era"].iloc[0], "ending": np.array(HANDED_OVER)[at[0].ravel()], "exit_zone": at[1].ravel() + 1, "zone": at[2].ravel() + 1, "n": n.ravel().astype("int64"), "p": p.ravel()})[names]

    # 400 rows an era, also for endings and zones that never occur.
    return counted.groupBy("era").applyInPandas(fill, "era string, ending string, exit_zone long, zone long, n long, p double")


def net_expected_points(probs: DataFrame, handoffs: DataFrame, strict: bool = True) -> DataFrame:
    """(era, state, net_points): value of the next score of the half. The ten states in which a side can take over are solved exactly, the others follow.

    An era that lacks one of the ten is an error, or, where that is not asked for, has null values.
    """

    def solve(key, g: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        states, inverse, r = _matrices(g)
        zones = np.array([int(s.rsplit("z", 1)[1]) for s in states])
        scored = inverse @ (r @ np.array([0.0 if e in HANDED_OVER else POINTS.get(e, 0.0) for e in ENDS]))
        given = np.zeros((len(states), 10))
        for end, part in h.groupby("ending"):
            table = np.zeros((11, 10))
            table[part["exit_zone"], part["zone"] - 1] = part["p"]
            given += inverse @ (r[:, [ENDS.index(end)]] * table[zones])
        # Inside the ten every first down is goal-to-go.
        heads = ["d1|goal|z1" if z == 1 else f"d1|standard|z{z}" for z in range(1, 11)]
        if missing := sorted(set(heads) - set(states)):
            if strict:
                raise ValueError(f"no state {missing}")
            return pd.DataFrame({"era": g["era"].iloc[0], "state": states, "net_points": pd.array([None] * len(states), dtype="Float64")})
        at = np.searchsorted(states, heads)
        taken = np.linalg.solve(np.eye(10) + given[at], scored[at])
        return pd.DataFrame({"era": g["era"].iloc[0], "state": states, "net_points": scored - given @ taken})

    return probs.groupBy("era").cogroup(handoffs.groupBy("era")).applyInPandas(solve, "era string, state string, net_points double")


#: Cumulative Poisson(1) probabilities.
POISSON = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676, 0.99998975]
#: Replicates whose counts are columns of one row.
BLOCK = 25


def cluster_bootstrap_se(rows: DataFrame, replicates: int = 200, alpha: float = SHRINK_ALPHA) -> DataFrame:
    """(era, state, se, replicates): spread of a state's points over resamples of whole contests.

    A contest counts Poisson(1) times in a replicate, drawn by a hash: the distributed form of drawing contests with
    replacement. Rows meet by transition before they are weighted, so a block of replicates is summed where a transition's rows
    lie, and what is shuffled after that does not grow with the contests; each replicate's chain is solved in a worker.
    """

    # Billionths, which a draw is compared with; the first test tells a third of all draws, the second three quarters.
    edges = [round(p * 1_000_000_000) for p in POISSON]
    times = lambda u: reduce(lambda rest, k: F.when(u < edges[k], k).otherwise(rest), reversed(range(len(edges))), F.lit(len(edges))).cast("long")
    blocks = -(-replicates // BLOCK)
    met = rows.repartition("era", "from_state", "to_state").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # Draws are columns of their own, so that each is made once.
    met = met.select("era", "block", "from_state", "to_state", "first", "end", *[F.pmod(F.xxhash64("game_id", F.col("block") * BLOCK + i), F.lit(1_000_000_000)).alias(f"u_{i}") for i in range(BLOCK)])
    counts = guarded(transitions(met, ("era", "block"), *[F.sum(times(F.col(f"u_{i}"))).alias(f"n_{i}") for i in range(BLOCK)]), ("era", "block")).filter("n > 0")

    def solve(g: pd.DataFrame) -> pd.DataFrame:
        era, first = g["era"].iloc[0], int(g["block"].iloc[0]) * BLOCK
        out = []
        for i in range(min(BLOCK, replicates - first)):
            own = g[["from_state", "to_state"]].assign(n=g[f"n_{i}"])
            own = own[own["n"] > 0]
            if len(own):
                states, points, _ = _solved(own, alpha)
                out.append(pd.DataFrame({"era": era, "state": states, "expected_points": points}))
        return pd.concat(out) if out else pd.DataFrame({"era": [], "state": [], "expected_points": []})

    packed = counts.select("era", "block", "from_state", "to_state", *[f"n_{i}" for i in range(BLOCK)])
    solved = packed.groupBy("era", "block").applyInPandas(solve, "era string, state string, expected_points double")
    return solved.groupBy("era", "state").agg(F.stddev_samp("expected_points").alias("se"), F.count(F.lit(1)).alias("replicates")).filter("replicates > 1")


def _solved(counts: pd.DataFrame, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States of one chain's counts, their expected points, and their probabilities of absorption: M16 and M17."""
    probs = pd.concat([_shrunk(own, alpha) for _, own in counts.groupby(counts["from_state"].str.split("|").str[0])])
    states, inverse, r = _matrices(probs)
    b = inverse @ r
    return states, b @ np.array([POINTS.get(e, 0.0) for e in ENDS]), b


def chain_states(counts: DataFrame, alpha: float = SHRINK_ALPHA) -> DataFrame:
    """(era, state, expected_points, p_td, starts, scored) from an era's guarded counts: M16 and M17 in one group."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        states, points, b = _solved(g, alpha)
        seen = g.groupby("from_state")[["starts", "scored"]].sum().reindex(states, fill_value=0)
        return pd.DataFrame({"era": g["era"].iloc[0], "state": states, "expected_points": points, "p_td": b[:, ENDS.index("TD")], "starts": seen["starts"].to_numpy(), "scored": seen["scored"].to_numpy()})

    return counts.groupBy("era").applyInPandas(run, "era string, state string, expected_points double, p_td double, starts long, scored long")


def chain_gates(t) -> DataFrame:
    """(era, gate, cases, violations, error): points that rise with the distance from the goal, later downs that are worth more, and the
    mean error of touchdown probabilities on drive starts."""
    solved = chain_states(guarded(transitions(chain_rows(t)), ("era",)))
    states = solved.select("*", part_of("state", 1).alias("down"), part_of("state", 2).alias("bucket"), F.regexp_extract("state", r"z(\d+)$", 1).cast("long").alias("zone"))
    asked = (F.col("down") == "d1") & (F.col("bucket") == "standard") | (F.col("down") == "d2") & (F.col("bucket") == "med") | (F.col("down") == "d3") & F.col("bucket").isin("med", "short")
    later = (F.col("bucket") == "med") & F.col("down").isin("d2", "d3") & F.col("zone").between(2, 9)
    before = lambda keys, order: F.lag("expected_points").over(Window.partitionBy("era", *keys).orderBy(order))
    # States that are not asked for stand in partitions of their own.
    states = states.withColumns({"asked": asked, "later": later}).withColumns({"nearer": before(["asked", "down", "bucket"], "zone"), "earlier": before(["later", "zone"], "down")})
    lost = lambda cond, c: count_if(cond & (F.col("expected_points") > F.col(c) + TOLERANCE))
    met, n = F.col("starts") >= LEAST_STARTS, F.when(F.col("starts") >= LEAST_STARTS, F.col("starts"))
    error = F.sum(n * F.abs(F.col("p_td") - F.col("scored") / F.nullif("starts", F.lit(0)))) / F.sum(n)
    row = lambda name, cases, violations, e: F.struct(F.lit(name).alias("gate"), cases.alias("cases"), violations.alias("violations"), e.alias("error"))
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    gates = F.array(
        row("zone", count_if(F.col("asked") & F.col("nearer").isNotNull()), lost(F.col("asked"), "nearer"), none),
        row("down", count_if(F.col("later") & F.col("earlier").isNotNull()), lost(F.col("later"), "earlier"), none),
        row("calibration", count_if(met), zero, error),
    )
    return states.groupBy("era").agg(gates.alias("x")).select("era", F.explode("x").alias("x")).select("era", "x.*").filter("cases > 0")
