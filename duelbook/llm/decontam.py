"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

The index holds postings (term, row, position) of the training documents for the terms that are asked for. Each distinct
window of the benchmark is looked up by its two rarest terms: their postings, the second moved back by the gap
between them, are intersected on (row, anchor). Places where both stand go on to a comparison of the whole window's words,
so neither frequent terms nor whole posting lists are ever paired up. Windows that share their rarest
terms share one look-up, and windows that items share are looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, maybe_broadcast, row_key, stored, words

#: Rows that a broadcast may carry; bytes are checked as well.
MOST_BROADCAST_ROWS = 500_000
#: Proximity: so many of an item's rarest distinct words, within so many words.
NEAR_TERMS, NEAR_SLOP = 3, 20
#: Stands for the end of a document in the index; no word is empty.
END = ""


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and a row key. Repeated rows share a key: they have the same words."""
    return docs.select("doc_id", "text", row_key().alias("row"))


def item_words(items: DataFrame) -> DataFrame:
    """Distinct (item_id, iw: words); items without words fall out. Stored."""
    got = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("iw"))
    return stored(got.filter(F.size("iw") > 0).distinct(), "decontam-items")


def item_windows(item: DataFrame, window: int) -> DataFrame:
    """(win: words joined by blanks, ws, item_id): every window of every item. Stored."""
    n = F.least(F.size("iw"), F.lit(window))
    each = item.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("iw") - n + 1), lambda s: F.slice("iw", s, n))).alias("ws"))
    return stored(each.select(F.array_join("ws", " ").alias("win"), "ws", "item_id").distinct(), "decontam-windows")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df): occurrences in all documents of the given terms; combined before the shuffle. Stored."""
    exploded = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return stored(exploded.join(maybe_broadcast(terms, MOST_BROADCAST_ROWS), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df")), "decontam-counts")


def positional_index(numbers: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, row, pos) of the given terms in ``numbered`` documents, and one (END, row, number of words, doc_id) for each document row."""
    wanted = terms.select("term").unionByName(terms.sparkSession.range(1).select(F.lit(END).alias("term")))
    exploded = numbers.select("row", "doc_id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "term"))
    met = exploded.join(maybe_broadcast(wanted, MOST_BROADCAST_ROWS), "term", "left_semi")
    return met.select("term", "row", "pos", F.when(F.col("term") == END, F.col("doc_id")).alias("doc_id"))


def seed_pairs(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(t1, t2, gap, off, len): the two rarest words of each distinct window, where the first stands in it; one word has no t2. Stored."""
    rare = windows.select("win", "ws").distinct().select("win", F.size("ws").alias("len"), F.posexplode("ws").alias("off", "term")).join(counts, "term", "left")
    # At most as many as a window has words.
    two = rare.groupBy("win", "len").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "off", "term"))), 1, 2).alias("r"))
    one = F.array_sort(F.transform("r", lambda x: F.struct(x["off"].alias("off"), x["term"].alias("term"))))
    got = two.select("len", one.alias("s")).select("len", F.col("s")[0]["term"].alias("t1"), F.get("s", F.lit(1))["term"].alias("t2"), F.col("s")[0]["off"].alias("off"), (F.coalesce(F.get("s", F.lit(1))["off"], F.col("s")[0]["off"]) - F.col("s")[0]["off"]).alias("gap"))
    return stored(got.select("t1", "t2", "gap", "off", "len").distinct(), "decontam-seeds")


def places(index: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, start, len): where the offset-adjusted lists of a window's two rarest words meet."""
    pair = F.xxhash64("t1", "t2", "gap").alias("pair")
    sides = seeds.select(pair, F.explode(F.array(F.struct(F.col("t1").alias("term"), F.lit(0).alias("back"), F.when(F.col("t2").isNull(), 3).otherwise(1).alias("side")), F.struct(F.col("t2").alias("term"), F.col("gap").alias("back"), F.lit(2).alias("side")))).alias("s"))
    sides = sides.select("pair", "s.*").filter("term IS NOT NULL").distinct()
    moved = index.join(maybe_broadcast(sides, MOST_BROADCAST_ROWS), "term").select("row", "pair", (F.col("pos") - F.col("back")).alias("anchor"), "side")
    met = moved.groupBy("row", "pair", "anchor").agg(F.bit_or("side").alias("sides")).filter("sides = 3")
    starts = met.join(maybe_broadcast(seeds.select(pair, "off", "len").distinct(), MOST_BROADCAST_ROWS), "pair")
    return starts.select("row", (F.col("anchor") - F.col("off")).alias("start"), "len").filter("start >= 0").distinct()


def verified(numbers: DataFrame, places: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, start, len, win): places where a whole window stands, word by word. Only texts with places are read again. Stored."""
    # As many as a document has places where a window may stand.
    by_row = stored(places.groupBy("row").agg(F.collect_list(F.struct("start", "len")).alias("spots")), "decontam-spots")
    keys = maybe_broadcast(by_row.select("row"), MOST_BROADCAST_ROWS)
    # explode keeps the words in a column of their own: a projection folded into the next would split the text for every spot.
    asked = numbers.select("row", "text").join(keys, "row", "left_semi").dropDuplicates(["row"]).join(by_row, "row").select("row", "spots", F.explode(F.array(words(F.col("text")))).alias("ws"))
    inside = F.filter("spots", lambda s: s["start"] + s["len"] <= F.size("ws"))
    found = asked.select("row", F.explode(F.transform(inside, lambda s: F.struct(s["start"].alias("start"), s["len"].alias("len"), F.array_join(F.slice("ws", s["start"] + 1, s["len"]), " ").alias("win")))).alias("s"))
    return stored(found.select("row", "s.*").join(maybe_broadcast(windows.select("win").distinct(), MOST_BROADCAST_ROWS), "win", "left_semi"), "decontam-hits")


def near_terms(item: DataFrame, counts: DataFrame, terms: int) -> DataFrame:
    """(item, item_id, term, need): the rarest distinct words of each item, ties by the word; items with fewer need all they have. Stored."""
    each = item.select(F.xxhash64("item_id", "iw").alias("item"), "item_id", F.explode(F.array_distinct("iw")).alias("term")).join(counts, "term", "left")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("df", F.lit(0)), "term"))
    chosen = each.withColumn("rank", rank).filter(F.col("rank") <= terms)
    return stored(chosen.select("item", "item_id", "term", F.max("rank").over(Window.partitionBy("item")).alias("need")), "decontam-near-terms")


def near_places(index: DataFrame, chosen: DataFrame, slop: int) -> DataFrame:
    """(row, item_id, pos): places from which all chosen words of an item follow, in any order, within ``slop`` words."""
    spots = index.select("term", "row", "pos").distinct().join(maybe_broadcast(chosen, MOST_BROADCAST_ROWS), "term")
    seen = F.size(F.collect_set("term").over(Window.partitionBy("row", "item").orderBy("pos").rangeBetween(0, slop)))
    return spots.withColumn("seen", seen).filter(F.col("seen") == F.col("need")).select("row", "item_id", "pos").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, *, terms: int = NEAR_TERMS, slop: int = NEAR_SLOP) -> DataFrame:
    """(doc_id, item_id, pos) of every document row: places from which all of an item's ``terms`` rarest distinct words follow within ``slop`` words."""
    numbers, item = numbered(docs), item_words(items)
    counts = term_counts(docs, item.select(F.explode("iw").alias("term")).distinct())
    chosen = near_terms(item, counts, terms)
    index = stored(positional_index(numbers, chosen.select("term").distinct()), "decontam-index")
    near = near_places(index.filter(F.col("term") != END), chosen, slop)
    return index.filter(F.col("term") == END).select("row", "doc_id").join(near, "row").select("doc_id", "item_id", "pos")


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 10, terms: int = NEAR_TERMS, slop: int = NEAR_SLOP) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a proximity match).

    A null or wordless text has 0 words and no hits; a null or wordless item matches nothing; items
    under ``window`` words are one window. A null item_id counts as the empty name; items that repeat
    an item_id count once. Repeated documents each get their row; ties do not matter; empty tables give
    no rows or no hits. Extra columns are left out.
    """
    numbers, item = numbered(docs), item_words(items)
    windows = item_windows(item, window)
    counts = term_counts(docs, item.select(F.explode("iw").alias("term")).distinct())
    seeds, chosen = seed_pairs(windows, counts), near_terms(item, counts, terms)
    asked = seeds.select(F.explode(F.array("t1", "t2")).alias("term")).filter("term IS NOT NULL").unionByName(chosen.select("term")).distinct()
    index = stored(positional_index(numbers, asked), "decontam-index")
    postings = index.filter(F.col("term") != END)
    hits = verified(numbers, places(postings, seeds), windows)
    # Postings of repeated rows fall together; a document has as many places and items as it has words and copied items.
    cover = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("start", "len")), lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    by_row = hits.groupBy("row").agg(F.size(cover).cast("long").alias("n_hit"))
    named = hits.select("row", "win").distinct().join(maybe_broadcast(windows.select("win", "item_id"), MOST_BROADCAST_ROWS), "win")
    by_item = named.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    near = near_places(postings, chosen, slop).groupBy("row").agg(F.countDistinct("item_id").alias("n_near"))
    found = stored(by_row.join(by_item, "row").join(near, "row", "full").select("row", "n_hit", "ids", "n_near"), "decontam-found")
    every = index.filter(F.col("term") == END).select("doc_id", "row", F.col("pos").cast("long").alias("n_words"))
    out = every.join(maybe_broadcast(found, MOST_BROADCAST_ROWS), "row", "left")
    ids, n_hit = F.coalesce("ids", F.array().cast("array<string>")), F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def without_contaminated(docs: DataFrame, items: DataFrame, *, window: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of an item occurs.

    Null and empty texts stay; rows that repeat a text go or stay together; empty tables, ties and columns of any name do no
    harm. Whole texts are read, however long.
    """
    numbers, item = numbered(docs), item_words(items)
    windows = item_windows(item, window)
    counts = term_counts(docs, item.select(F.explode("iw").alias("term")).distinct())
    seeds = seed_pairs(windows, counts)
    asked = seeds.select(F.explode(F.array("t1", "t2")).alias("term")).filter("term IS NOT NULL").distinct()
    index = stored(positional_index(numbers, asked).filter(F.col("term") != END), "decontam-index")
    (key,) = fresh(docs, "_row")
    bad = stored(verified(numbers, places(index, seeds), windows).select(F.col("row").alias(key)).distinct(), "decontam-bad")
    return docs.withColumn(key, row_key()).join(maybe_broadcast(bad, MOST_BROADCAST_ROWS), key, "left_anti").drop(key)
