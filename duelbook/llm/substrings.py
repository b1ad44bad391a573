"""Substring dedup by hashing lines or paragraphs.

A text is cut into units: lines, or paragraphs (lines up to a blank one). Units are normalised (case and white space) and
hashed to 128 bits; of each digest the occurrence that is first by (doc_id, row key, unit) stays, the others are
cut out, and their original character offsets are kept.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, joined, maybe_broadcast, row_key, stored

#: What ends a unit: a line break, or one with blank lines after it.
ENDS = {"line": r"\n", "paragraph": r"\n(?:[ \t\r\x0b\f]*\n)+"}
#: Units of fewer words are never taken for repeated; 1 looks at every unit that has a word.
MIN_WORDS = 1
MOST_BROADCAST_ROWS = 500_000
SPANS = "array<struct<start:int,end:int>>"


def pieces(text: Column, unit: str) -> Column:
    """The units of a text, without what ends them."""
    return F.split(text, ENDS[unit], -1)


def normal(unit: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(unit), r"(?U)\s+", " "))


def _units(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(d1, d2: digest, doc_id, row, at) of every unit of every document row with so many words; stored."""
    rows = docs.filter("text IS NOT NULL").select("doc_id", row_key().alias("row"), F.posexplode(pieces(F.col("text"), unit)).alias("at", "unit"))
    kept = rows.select("doc_id", "row", "at", normal(F.col("unit")).alias("unit")).filter(F.col("unit") != "")
    if min_words > 1:
        kept = kept.filter(F.size(F.split("unit", " ")) >= min_words)
    return stored(kept.select(F.xxhash64(F.lit(1), "unit").alias("d1"), F.xxhash64(F.lit(2), "unit").alias("d2"), "doc_id", "row", "at"), "substrings", "zstd")


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(row, at): the units of each document row, by number, that are not the first of their digest.

    Digests are counted before the shuffle; only those that occur twice are ranked, and the rows of a frequent unit meet
    its first place by broadcast where they lie.
    """
    every = _units(docs, unit, min_words)
    twice = stored(every.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "substrings-twice")
    total = every.count()
    again = joined(every, twice, ["d1", "d2"], "n", total).select("d1", "d2", "doc_id", "row", "at")
    place = F.struct("doc_id", "row", "at")
    first = again.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
    # Rows that repeat both doc_id and text have the same places: they count once.
    first = stored(first.filter("first <> last").select("d1", "d2", "n", "first"), "substrings-first")
    return joined(again, first, ["d1", "d2"], "n", total).filter(place != F.col("first")).select("row", "at").distinct()


def deduplicated(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` plus clean_text, removed (spans of characters cut out, by original offsets) and n_removed.

    A unit goes with what ends it. Null and empty texts stay as they are. Of rows that repeat doc_id and text each is
    treated alike; a null doc_id ranks first. Ties by doc_id are broken by a hash of the row. An empty table gives no rows.
    Columns of ``docs`` that have one of the three names are replaced.
    """
    end = ENDS[unit]

    @F.pandas_udf(f"clean_text string, removed {SPANS}")
    def cut(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
        import re

        out = []
        for t, numbers in zip(text, gone, strict=True):
            edges = [0, *[m.end() for m in re.finditer(end, t)], len(t)]
            drop = sorted(numbers)
            keep = [True] * (len(edges) - 1)
            for i in drop:
                keep[i] = False
            out.append(("".join(t[a:b] for a, b, k in zip(edges, edges[1:], keep, strict=False) if k), [{"start": edges[i], "end": edges[i + 1]} for i in drop]))
        return pd.DataFrame(out, columns=["clean_text", "removed"])

    docs = docs.drop("clean_text", "removed", "n_removed")
    key, numbers, cuts = fresh(docs, "_row", "_gone", "_cut")
    # As many as a document has units.
    gone = stored(repeated_units(docs, unit, min_words).groupBy(F.col("row").alias(key)).agg(F.collect_list("at").alias(numbers)), "substrings-gone")
    keyed = docs.withColumn(key, row_key())
    keys = maybe_broadcast(gone.select(key), MOST_BROADCAST_ROWS)
    hit = keyed.join(keys, key, "left_semi").join(gone, key).withColumn(cuts, cut("text", numbers))
    hit = hit.select(*docs.columns, f"{cuts}.clean_text", f"{cuts}.removed")
    rest = keyed.join(keys, key, "left_anti").select(*docs.columns, F.col("text").alias("clean_text"), F.array().cast(SPANS).alias("removed"))
    return hit.unionByName(rest).withColumn("n_removed", F.size("removed").cast("long"))


def repeats(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document row: doc_id, n_removed, removed (spans), chars_removed, clean_sha256, has_repeats."""
    got = deduplicated(docs.select("doc_id", "text"), unit, min_words)
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return got.select("doc_id", "n_removed", "removed", lost.alias("chars_removed"), F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"), (F.col("n_removed") > 0).alias("has_repeats"))
