"""Mixing sources to target weights.

Hash-random keys order the documents inside each source; a range sort over (source, key) and
distributed prefix sums of the sizes say where each source's budget ends. Budgets above a source's
size repeat it: whole epochs for all documents, then a last partial epoch cut at the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TOKEN, maybe_broadcast, prefix_sums, stored

#: Sources that a broadcast may carry (about 100 bytes each).
MOST_BROADCAST_SOURCES = 100_000


def word_count(c: Column) -> Column:
    """Number of maximal runs without white space; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0)).cast("long")


def source_key(c: Column) -> Column:
    """A never-null key that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("t"))


def source_targets(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Adds weight, rank, first (sizes of sources before it) and target to (src, source_size).

    Water filling: with sources in the order of cap * size / weight, the level is what is left after
    the filled ones over the weights of the rest; a target is the lesser of its cap and level * weight.
    This is what repeated resharing of the excess by weight ends at. Nothing to share gives targets 0.
    """
    order = [F.col("src")]
    ranked = prefix_sums(sources, order, {"rank": F.lit(1), "first": F.col("source_size")}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("rank") % len(cycle) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("ratio", (F.col("source_size") * cap).cast("double") / F.col("weight"))
    filled = prefix_sums(ranked, [F.col("ratio"), F.col("src")], {"cap_before": F.col("source_size") * cap, "weight_before": F.col("weight")}, "mix-levels")
    sums = filled.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = (F.col("all_size") - F.col("cap_before")).cast("double") / (F.col("all_weight") - F.col("weight_before"))
    tested = filled.crossJoin(F.broadcast(sums)).withColumn("level", level)  # one row of totals
    # The first source whose own ratio is not below the level it would set stops the filling.
    stop = tested.filter(F.col("ratio") >= F.col("level")).agg(F.min(F.struct("ratio", "src", "level")).alias("m")).select(F.col("m.level").alias("level"))
    out = filled.crossJoin(F.broadcast(stop))
    target = F.least((F.col("source_size") * cap).cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return out.select("src", "source_size", "rank", "first", "weight", target.alias("target"))


def mix(docs: DataFrame, *, text: str = "text", cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs`` (doc_id, source, text).

    ``taken`` sums to round(target) in each source, to the word: full epochs plus the documents that
    come first by md5(seed, doc_id) until the rest of the budget, the last of them in part.
    Nulls: a null source is a source of its own, sorted last; a null or empty text has size 0; rows
    with a null doc_id share one key. Repeated rows each count. An empty table gives no rows. Extra
    columns are left out. Nothing larger than the table of sources is ever broadcast, and that only
    after a count.
    """
    key = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 16)
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), source_key(F.col("source")).alias("src"), word_count(F.col(text)).alias("size"), key.alias("key")), "mix-sizes")
    sources = source_targets(stored(sized.groupBy("src").agg(F.sum("size").alias("source_size")), "mix-totals"), cycle, cap)
    order = [F.col(c) for c in ("src", "key", "doc_id", "size")]
    run = prefix_sums(sized, order, {"before": F.col("size")}, "mix-order")
    joined = run.join(maybe_broadcast(stored(sources, "mix-targets"), MOST_BROADCAST_SOURCES), "src")
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0))
    left = budget - F.col("epochs") * F.col("source_size") - (F.col("before") - F.col("first"))
    return joined.withColumn("epochs", epochs).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long").alias("taken")
    )
