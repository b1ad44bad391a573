"""Frame-level operators that marts and jobs share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_sides(games: DataFrame, first: str = "home_", second: str = "away_") -> DataFrame:
    """Two rows for each contest: side, own columns without prefix, the other side's as ``opp_...``; one scan, no union."""
    pairs = [x.removeprefix(first) for x in games.columns if x.startswith(first) and second + x.removeprefix(first) in games.columns]
    rest = [x for x in games.columns if not (x.startswith((first, second)) and x.split("_", 1)[1] in pairs)]

    def side(own: str, other: str) -> Column:
        return F.struct(F.lit(own.rstrip("_")).alias("side"), *[F.col(own + p).alias(p) for p in pairs], *[F.col(other + p).alias(f"opp_{p}") for p in pairs])

    return games.select(*rest, F.explode(F.array(side(first, second), side(second, first))).alias("_s")).select(*rest, "_s.*")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank_in_group", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank_in_group") <= k)


def prior_sums(df: DataFrame, keys: list[str], at: str, values: list[str], prefix: str = "prior_") -> DataFrame:
    """Sums of the values over strictly earlier points of the key; rows are added up to (key, point) first."""
    daily = df.groupBy(*keys, at).agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    return daily.select(*keys, at, *[F.sum(v).over(before).alias(prefix + v) for v in values])


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each left row with the values of the latest right row at or before it; one sort by key, no range join.

    Right rows should be unique in (keys, at). ``strict`` asks for earlier rows only.
    """
    held = F.struct(*values)
    a = left.withColumn("_left", F.struct(*left.columns)).select(*keys, F.col(at).alias("_at"), F.lit(0 if strict else 1).alias("_o"), "_left", F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType).alias("_v"))
    b = right.select(*keys, F.col(at).alias("_at"), F.lit(1 if strict else 0).alias("_o"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), held.alias("_v"))
    upto = Window.partitionBy(*keys).orderBy("_at", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = a.unionByName(b).withColumn("_v", F.last("_v", ignorenulls=True).over(upto)).filter("_left IS NOT NULL")
    return filled.select("_left.*", *[F.col(f"_v.{v}").alias(v) for v in values])


def range_join_years(left: DataFrame, right: DataFrame, keys: list[str], first: str, last: str, year: str, how: str = "inner") -> DataFrame:
    """right.year between left.first and left.last on equal keys; the equality keeps it a hash or merge join."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k) == F.col(f"_right_{k}") for k in keys] + [F.col(year).between(F.col(first), F.col(last))]
    return left.join(right, on, how).drop(*[f"_right_{k}" for k in keys])


def islands(df: DataFrame, keys: list[str], at: str, gap: int = 1, name: str = "island") -> DataFrame:
    """Numbers runs of points whose distance does not exceed the gap."""
    w = Window.partitionBy(*keys).orderBy(at)
    broken = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    return df.withColumn("_b", broken).withColumn(name, F.sum("_b").over(w)).drop("_b")


def islands_of_rows(df: DataFrame, keys: list[str], at: str, gap: int = 1, name: str = "island") -> DataFrame:
    """``islands`` of points that several rows may share: one row a point and distance to the row before it, so that a point
    after a gap (or the first one) that has more rows also stands once with distance 0. Rows of a point have the same number."""
    w = Window.partitionBy(*keys).orderBy(at)
    rows = df.select(*keys, at, (F.col(at) - F.lag(at).over(w)).alias("_g")).distinct()
    broken = F.when(F.col("_g") <= gap, 0).otherwise(1)
    return rows.withColumn("_b", broken).withColumn(name, F.sum("_b").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop("_b", "_g")


def percent_ranks(df: DataFrame, partition: list[str], metrics: dict[str, str], nulls: str, descending: bool = False, mask: bool = False) -> DataFrame:
    """PERCENT_RANK of each metric; null rows stay in the partition and, with ``mask``, get null themselves."""
    out = df
    for metric, name in metrics.items():
        col = F.col(metric)
        order = (col.desc_nulls_last() if nulls == "last" else col.desc_nulls_first()) if descending else (col.asc_nulls_last() if nulls == "last" else col.asc_nulls_first())
        r = F.percent_rank().over(Window.partitionBy(*partition).orderBy(order))
        out = out.withColumn(name, F.when(col.isNotNull(), r) if mask else r)
    return out


def flatten_struct(df: DataFrame, sep: str = "__") -> DataFrame:
    """Struct columns as flat ones, named by path."""
    while any(t.startswith("struct") for _, t in df.dtypes):
        df = df.select(*[F.col(f"{n}.{f.name}").alias(f"{n}{sep}{f.name}") for n, t in df.dtypes if t.startswith("struct") for f in df.schema[n].dataType], *[n for n, t in df.dtypes if not t.startswith("struct")])
    return df


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, slices: int = 64) -> DataFrame:
    """Numbers from 0 inside each group by ``order``, without one task for a group.

    A group is cut at quantiles of the first order column (a number, date or time stamp; null first): rows are counted by slice, the
    counts run up over the slices, and only a slice is sorted at once. Rows that tie in the first column share a slice.
    """
    at = F.percentile_approx(order[0], [i / slices for i in range(1, slices)])
    edges = df.agg(at.alias("e")).first()["e"] or []  # at most so many numbers
    cut = F.size(F.filter(F.array(*[F.lit(e) for e in sorted(set(edges))]), lambda e: e < F.col(order[0]))) if edges else F.lit(0)
    rows = df.withColumn("_slice", F.when(F.col(order[0]).isNull(), -1).otherwise(cut))
    counts = rows.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_slice").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    on = F.col("_slice") == F.col("_at")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order)) - 1
    return rows.withColumn("_in", inside).join(starts, on).select(*df.columns, (F.col("_from") + F.col("_in")).alias(name))
