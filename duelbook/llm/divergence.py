"""Source divergence audit by count cells: how far each source's words lie from its language's, and sources from each other.

A term's share in a group (a language and source) or in the language depends on its count alone, so all terms with one pair of
counts (in the group, in the language) have one divergence: it is evaluated once a cell. Cells are ranked by value
with their numbers of terms summed up, equal values merged, and only the terms of cells that reach the asked ranks
are looked up and put into UTF-8 order.

Pairs of sources: the differences of two groups' shares are summed over blocks of terms, as exact integers; a block adds up all
its sources' pairs at once, and gives one row a pair, not one a term.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, joined, stored, tasks_for

#: Between terms: ASCII but for letters.
TERM_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term is in, the count added to each term, parts of a share, and ranks of the term part.
LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Terms and sources in one block of the pair sums: two tiles of sources meet in one group.
TERM_BLOCK, SOURCE_TILE = 512, 256
ROWS_PER_TASK = 2_000_000


def terms(text: Column) -> Column:
    """Runs of letters and non-ASCII characters, A-Z lower-cased; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), TERM_GAP), lambda w: w != "")


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE (count + ADDED) / (total + ADDED kept)), exact at any size."""
    return F.expr(f"1L + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {ADDED} AS DECIMAL(20, 0)) DIV CAST({total} + {ADDED} * {kept} AS DECIMAL(20, 0))")


def counted(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, c, big): count of each kept term in each group that has it, and in the language. Stored.

    One pass over the texts: each batch is counted where it lies, both occurrences (c) and documents (d), and gives a row for each
    group and term; these are combined again before the shuffle.
    """

    def count(batches):
        for batch in batches:
            words = batch.column("words")
            text = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
            coded = words.flatten().dictionary_encode()
            if not len(coded):
                continue
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            n_terms = len(coded.dictionary)
            pair, times = np.unique(text * n_terms + coded.indices.to_numpy(), return_counts=True)  # a document and a term
            key, at = np.unique(group[pair // n_terms] * n_terms + pair % n_terms, return_inverse=True)
            group, term = key // n_terms, key % n_terms
            take = lambda values, where: values.take(pa.array(where))
            columns = [take(lang.dictionary, group // len(source.dictionary)), take(source.dictionary, group % len(source.dictionary)), take(coded.dictionary, term), pa.array(np.bincount(at, times).astype(np.int64)), pa.array(np.bincount(at).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "c", "d"])

    own = docs.select("lang", "source", terms(F.col("text")).alias("words"))
    each = own.mapInArrow(count, "lang string, source string, term string, c long, d long")
    by_group = each.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    # As many rows a term as the language has sources.
    of_term = Window.partitionBy("lang", "term")
    both = by_group.withColumns({"big": F.sum("c").over(of_term), "docs": F.sum("d").over(of_term)})
    return stored(both.filter(F.col("docs") >= least_docs).select("lang", "source", "term", "c", "big"), "divergence-counts")


def totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n, n_lang, kept, at, n_sources) of every group that occurs; ``at`` numbers a language's sources. Stored."""
    groups = docs.select("lang", "source").distinct()
    by_group = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    once = kept.groupBy("lang", "term").agg(F.max("big").alias("big")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("big").alias("n_lang"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    w = Window.partitionBy("lang")
    out = groups.join(by_group, ["lang", "source"], "left").join(once, ["lang"], "left").select("lang", "source", zero("n"), zero("n_lang"), zero("kept"))
    return stored(out.withColumns({"at": (F.row_number().over(w.orderBy("source")) - 1).cast("long"), "n_sources": F.count(F.lit(1)).over(w)}), "divergence-totals")


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group has more of than its language, furthest first, only ranks to ``top``."""
    total = int(groups.agg(F.sum("kept")).first()[0] or 0)
    cells = kept.groupBy("lang", "source", "c", "big").agg(F.count(F.lit(1)).alias("m"))
    met = cells.join(groups.filter("kept > 0").select("lang", "source", "n", "n_lang", "kept"), ["lang", "source"])
    valued = met.withColumns({"p": share("c", "n", "kept"), "q": share("big", "n_lang", "kept")}).filter("p > q").withColumn("value", F.col("p") - F.col("q"))
    of_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    # A cell has a term or more, so no cell beyond rank ``top`` is needed; Spark cuts each task's rows at that rank before the shuffle.
    best = stored(valued.withColumn("r", F.rank().over(of_group)).filter(F.col("r") <= top).select("lang", "source", "c", "big", "m", "value"), "divergence-cells")
    merged = best.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    reached = merged.withColumn("before", F.coalesce(F.sum("m").over(of_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter(F.col("before") < top)
    chosen = best.join(reached.select("lang", "source", "value"), ["lang", "source", "value"]).select("lang", "source", "c", "big", "value", "m")
    found = joined(kept, stored(chosen, "divergence-chosen"), ["lang", "source", "c", "big"], "m", total)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _pair_sums(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """(one, two, part, seen): over a block's terms, the sums of differences of its sources' shares; of different tiles, only pairs across."""
    if not len(rows) or not len(groups):
        return pd.DataFrame({"one": [], "two": [], "part": [], "seen": []}).astype("int64")
    at = np.sort(groups["at"].to_numpy())
    zero = groups.set_index("at")["p0"].reindex(at).to_numpy(dtype=np.int64)
    _, term = np.unique(rows["term"].to_numpy(), return_inverse=True)
    p = np.repeat(zero[None, :], term.max() + 1, axis=0)
    p[term, np.searchsorted(at, rows["at"])] = rows["p"]
    tile = at // SOURCE_TILE
    out = []
    for i in range(len(at)):
        other = np.flatnonzero((at > at[i]) & ((tile != tile[i]) | (tile[0] == tile[-1])))
        if len(other):
            sums = np.abs(p[:, other] - p[:, i : i + 1]).sum(axis=0)
            out.append(np.stack([np.full(len(other), at[i]), at[other], sums, np.full(len(other), len(p))], axis=1))
    return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 4), dtype=np.int64), columns=["one", "two", "part", "seen"])


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): each source of a language with each other one, by the summed difference of their shares."""
    sized = groups.withColumns({"p0": F.when(F.col("kept") > 0, F.expr(f"1L + CAST({SCALE} * {ADDED}L AS DECIMAL(20, 0)) DIV CAST(nullif(n + {ADDED} * kept, 0) AS DECIMAL(20, 0))")), "tile": F.floor(F.col("at") / SOURCE_TILE), "tiles": F.ceil(F.col("n_sources") / SOURCE_TILE)})
    sized = stored(sized, "divergence-sources")
    rows = kept.join(sized.select("lang", "source", "at", "tile", "tiles", "n", "kept"), ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / TERM_BLOCK))
    # Tiles i <= j: a row goes to one group for each tile of its language, mostly one.
    meet = lambda df: df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    left = meet(rows.select("lang", "term", "at", share("c", "n", "kept").alias("p"), block.alias("block"), "tile", "tiles")).select("lang", "term", "at", "p", "block", "i", "j")
    spread = sized.filter("kept > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("kept") / TERM_BLOCK) - 1)))
    right = meet(spread.select("lang", "at", "p0", "block", "tile", "tiles")).select("lang", "at", "p0", "block", "i", "j")
    right = right.toDF(*right.columns)  # both sides read ``sized``: columns of their own
    keys = ["lang", "block", "i", "j"]
    tasks = tasks_for(kept.sparkSession, kept.count(), ROWS_PER_TASK)

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _pair_sums(a, b).assign(lang=key[0])[["lang", "one", "two", "part", "seen"]]

    sides = [df.repartition(tasks, *keys).groupBy(*keys) for df in (left, right)]
    sums = sides[0].cogroup(sides[1]).applyInPandas(run, "lang string, one long, two long, part long, seen long")
    sums = stored(sums.groupBy("lang", "one", "two").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen")), "divergence-pairs")
    side = lambda name, other: sized.select("lang", F.col("at").alias(name), F.col("source").alias(f"{name}_source"), F.col("p0").alias(f"{name}_p0"), *other)
    # The result has a row for each two sources of a language: as many as this join gives.
    pairs = side("one", ["kept"]).join(side("two", []), "lang").filter("one < two").join(sums, ["lang", "one", "two"], "left")
    # Terms of blocks in which neither tile has any: both shares are those of no occurrence.
    unseen = (F.col("kept") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("one_p0") - F.col("two_p0"))
    pairs = pairs.select("lang", "one_source", "two_source", (F.coalesce("part", F.lit(0)) + F.coalesce(unseen, F.lit(0))).cast("long").alias("value"))
    both = F.array(F.struct(F.col("one_source").alias("source"), F.col("two_source").alias("item")), F.struct(F.col("two_source").alias("source"), F.col("one_source").alias("item")))
    out = pairs.select("lang", "value", F.explode(both).alias("x")).select("lang", "x.source", "x.item", "value")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: ``source_pairs`` and ``top_terms`` of all groups of ``docs``.

    Null text, lang and source are as empty ones. Groups without terms, and languages without kept ones, are in the pair part;
    such a language's values are 0. Repeated rows count again. Equal values come in UTF-8 order of the items. Very long texts are
    counted whole. An empty table gives no rows; other columns are left out, whatever their names.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = counted(plain, least_docs)
    groups = totals(plain, kept)
    pairs = source_pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(top_terms(kept, groups, top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
