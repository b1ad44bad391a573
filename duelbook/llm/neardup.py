"""MinHash near-duplicates of bags of word shingles: BagMinHash signatures, bands, exact check.

A text is the multiset of its five-word shingles; the weight of a shingle is its count. Weighted
Jaccard similarity (sum of lesser counts over sum of greater counts) of 0.8 or more links two texts;
a class is a connected component of links.

BagMinHash: the weight axis is cut at 0, 1, 2, 4, 8, ...; every (shingle, interval) owns a Poisson
process seeded by both, whose points carry a time, a signature component and a place inside the
interval. A weight that ends inside an interval keeps the points below it, so a lesser and a greater
weight share what they have in common. Each component keeps its earliest point, and a process
stops as soon as its next point comes after the latest of these: most shingles draw one or two points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CHAR, fresh, joined, maybe_broadcast, row_key, small_batches, stored, tasks_for, words
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
#: 20 bands of 4: a pair at 0.8 shares a band with probability 0.99997.
BANDS, BAND_ROWS = 20, 4
#: Four standard deviations of the estimate below the threshold.
ESTIMATE_MARGIN = 4 * (THRESHOLD * (1 - THRESHOLD) / (BANDS * BAND_ROWS)) ** 0.5
#: Words that a worker takes apart at once; it holds some twenty numbers a word meanwhile.
CHUNK_TOKENS = 100_000
MOST_BROADCAST_NODES = 500_000
#: Nodes that meet in one group: a star's members, and half of what is left of a bucket.
STAR_BLOCK, BLOCK = 64, 512
#: Rows that one task of such groups sees, however many there are in all.
ROWS_PER_TASK = 200_000
U = np.uint64


def token_hashes(text: str) -> Column:
    return F.transform(words(F.col(text)), lambda w: F.xxhash64(w))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def bags(tokens: list[np.ndarray], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, count) of texts given as word hashes, sorted by text and shingle.

    A text of 1 to k - 1 words is one shingle, filled up with zeros; one without words has none.
    """
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    padded = np.where((sizes > 0) & (sizes < k), k, sizes)
    starts = np.concatenate(([0], np.cumsum(padded)))[:-1]
    flat = np.zeros(int(padded.sum()), dtype=np.uint64)
    for at, t in zip(starts, tokens, strict=True):
        flat[at : at + len(t)] = np.asarray(t, dtype=np.int64).view(np.uint64)
    n = len(flat) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rolled = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            rolled = mix64(rolled + flat[j : j + n] + U(0x9E3779B97F4A7C15))
    owner = np.repeat(np.arange(len(tokens)), padded)
    inside = owner[:n] == owner[k - 1 :]
    text, shingle = owner[:n][inside], rolled[inside]
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    first = np.ones(len(text), dtype=bool)
    first[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(first)
    return text[at], shingle[at], np.diff(np.append(at, len(text)))


def bag_minhash(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """Signatures (n_texts x m, uint64) of bags; the chance that two agree in a component is their weighted Jaccard similarity."""
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    of = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    part = np.minimum((count[of] - low) / width, 1.0)
    owner = text[of]
    with np.errstate(over="ignore"):
        state = mix64(shingle[of] + mix64(level.astype(np.uint64) + U(1)))
    when = np.zeros(len(of))
    best = np.full(n_texts * m, np.inf)
    alive = np.arange(len(of))
    step = 0
    while len(alive):
        with np.errstate(over="ignore"):
            draw = mix64(state[alive] + U(step) * U(0x9E3779B97F4A7C15))
            other = mix64(draw ^ U(0xD6E8FEB86659FD93))
        when[alive] += -np.log(((draw >> U(11)).astype(np.float64) + 0.5) / 2.0**53) / (m * width[alive])
        component = (other % U(m)).astype(np.int64)
        kept = ((other >> U(11)).astype(np.float64) / 2.0**53) < part[alive]
        np.minimum.at(best, owner[alive[kept]] * m + component[kept], when[alive[kept]])
        latest = best.reshape(n_texts, m).max(axis=1)
        alive = alive[when[alive] < latest[owner[alive]]]
        step += 1
    return mix64(best.view(np.uint64)).reshape(n_texts, m)


def _chunks(rows: list[np.ndarray]):
    """Ranges of rows with about CHUNK_TOKENS words each; a longer text is a range of its own."""
    at, size = 0, 0
    for i, r in enumerate(rows):
        if i > at and size + len(r) > CHUNK_TOKENS:
            yield at, i
            at, size = i, 0
        size += len(r)
    if len(rows) > at:
        yield at, len(rows)


def _signed(batches):
    """Batches of (doc_id, row, tokens) -> those of ``signatures``."""
    m = BANDS * BAND_ROWS
    for batch in batches:
        tokens = list(batch["tokens"])
        for lo, hi in _chunks(tokens):
            text, shingle, count = bags(tokens[lo:hi])
            sig = bag_minhash(text, shingle, count, hi - lo, m)
            digest = np.zeros((2, hi - lo), dtype=np.uint64)
            with np.errstate(over="ignore"):
                each = mix64(shingle * U(0x9E3779B97F4A7C15) + mix64(count.astype(np.uint64)))
                np.add.at(digest[0], text, each)
                np.add.at(digest[1], text, mix64(each ^ U(0xA0761D6478BD642F)))
                band = sig.reshape(hi - lo, BANDS, BAND_ROWS)
                key = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], hi - lo, axis=0)
                for r in range(BAND_ROWS):
                    key = mix64(key * U(0x9E3779B97F4A7C15) + band[:, :, r])
            none = np.bincount(text, minlength=hi - lo) == 0
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[lo:hi].to_numpy(),
                    "row": batch["row"].iloc[lo:hi].to_numpy(),
                    "k1": pd.arrays.IntegerArray(digest[0].view(np.int64).copy(), none),
                    "k2": pd.arrays.IntegerArray(digest[1].view(np.int64).copy(), none),
                    "sig": [x.tobytes() for x in (sig & U(0xFFFF)).astype(np.uint16)],
                    "bands": list(key.view(np.int64)),
                }
            )


def signatures(hashed: DataFrame) -> DataFrame:
    """(doc_id, row, tokens) -> doc_id, row, k1 and k2 (128-bit digest of the bag, null without words), sig, bands."""
    return hashed.mapInPandas(_signed, "doc_id string, row binary, k1 long, k2 long, sig binary, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts given as word hashes; 0 if either has no words."""
    (_, x, n), (_, y, k) = bags([a]), bags([b])
    if not len(x) or not len(y):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(n[i], k[j]).sum()
    return float(both / (n.sum() + k.sum() - both))


def _agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).mean(axis=-1)


def _grouped(df: DataFrame, keys: list[str], run, schema: str, n_rows: int) -> DataFrame:
    """Calls ``run`` with each key's rows as arrays by column; it returns an integer array, rows by columns of ``schema``.

    Many small groups share one batch in and out; a group that goes on in the next batch is held back.
    """
    names = [x.split()[0] for x in schema.split(",")]
    n = tasks_for(df.sparkSession, n_rows, ROWS_PER_TASK)

    def over(batches):
        held = None
        for batch in _then_none(batches):
            if batch is not None and not len(batch):
                continue
            if held is not None and batch is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            last = batch is None
            batch = held if last else batch
            if batch is None:
                return
            cols = {c: batch[c].to_numpy() for c in batch.columns}
            key = np.stack([cols[k] for k in keys], axis=1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            ends = [*cut, len(batch)] if last else list(cut)
            out = [run({c: v[x:y] for c, v in cols.items()}) for x, y in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
            if out:
                yield pd.DataFrame(np.concatenate(out).reshape(-1, len(names)), columns=names)
            held = None if last else batch.iloc[ends[-1] if ends else 0 :]

    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInPandas(over, schema)


def _then_none(batches):
    yield from batches
    yield None


def _matrix(blobs: np.ndarray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=kind).reshape(len(blobs), -1)


def bag_bytes(hashed: DataFrame) -> DataFrame:
    """(node, tokens) -> (node, bag): sorted 64-bit hashes of (shingle, first / second / ... occurrence), so that bags become sets."""

    def run(batches):
        for batch in batches:
            tokens = list(batch["tokens"])
            for lo, hi in _chunks(tokens):
                text, shingle, count = bags(tokens[lo:hi])
                of = np.repeat(np.arange(len(text)), count)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                with np.errstate(over="ignore"):
                    member = mix64(shingle[of] + mix64(nth.astype(np.uint64)))
                owner = text[of]
                order = np.lexsort((member, owner))
                cut = np.searchsorted(owner, np.arange(1, hi - lo))
                yield pd.DataFrame({"node": batch["node"].iloc[lo:hi].to_numpy(), "bag": [x.tobytes() for x in np.split(member[order], cut)]})

    return hashed.mapInPandas(run, "node long, bag binary")


def bags_of(asked: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, bag) of the asked nodes, from one whole text of each; stored."""
    wanted = stored(asked.select("node").distinct().join(nodes.select("node", "row"), "node"), "neardup-asked")
    # Rows that repeat a doc_id and a text share a row key.
    text = texts.join(maybe_broadcast(wanted, MOST_BROADCAST_NODES), "row").select("node", "text").dropDuplicates(["node"])
    return stored(bag_bytes(text.select("node", token_hashes("text").alias("tokens"))), "neardup-bags")


def _members(stars: DataFrame) -> DataFrame:
    """(centre, block, node, head): each block's nodes, and the centre once a block as its head."""
    heads = stars.select("centre", "block").distinct().select("centre", "block", F.col("centre").alias("node"), F.lit(1).cast("long").alias("head"))
    return stars.select("centre", "block", "node", F.lit(0).cast("long").alias("head")).unionByName(heads)


def _near_head(stars: DataFrame, values: DataFrame, column: str, alike, n_rows: int) -> DataFrame:
    """Of (centre, block, node), those that are ``alike`` to the centre by ``column``: (a column of values, the centre's value) -> flags."""
    met = _members(stars).join(values.select("node", column), "node")

    def run(g):
        at = int(np.argmax(g["head"]))
        rest = np.flatnonzero(g["head"] == 0)
        rest = rest[alike(g[column][rest], g[column][at])] if len(rest) else rest
        return np.stack([np.full(len(rest), g["centre"][at]), np.full(len(rest), g["block"][at]), g["node"][rest]], axis=1)

    return _grouped(met, ["centre", "block"], run, "centre long, block long, node long", n_rows)


def _signatures_alike(many: np.ndarray, one: bytes) -> np.ndarray:
    return _agreement(_matrix(many, np.uint16), np.frombuffer(one, dtype=np.uint16)[None, :]) >= THRESHOLD - ESTIMATE_MARGIN


def _bags_alike(many: np.ndarray, one: bytes) -> np.ndarray:
    own = np.frombuffer(one, dtype=np.uint64)
    out = np.zeros(len(many), dtype=bool)
    for i, blob in enumerate(many):
        other = np.frombuffer(blob, dtype=np.uint64)
        both = len(np.intersect1d(own, other, assume_unique=True))
        out[i] = both > 0 and both / (len(own) + len(other) - both) >= THRESHOLD
    return out


def star_links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Of distinct pairs (centre, node), the links (a, b), counted exactly on whole texts. Stored.

    A centre's members are dealt into blocks of about STAR_BLOCK; the centre's value is sent once a block, not once a pair.
    """
    pairs = stored(pairs, "neardup-stars")
    sizes = stored(pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("n")), "neardup-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    stars = joined(pairs, sizes, ["centre"], "n", total).select("centre", "node", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / STAR_BLOCK)).alias("block"))
    near = stored(_near_head(stars, nodes, "sig", _signatures_alike, total), "neardup-near")
    bag = bags_of(near.select(F.explode(F.array("centre", "node")).alias("node")), nodes, texts)
    alike = _near_head(near, bag, "bag", _bags_alike, near.count())
    return stored(alike.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")), "neardup-links")


def _with_comp(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, node, comp), stored."""
    return stored(buckets.select("bucket", "node").join(components(links), "node", "left").withColumn("comp", F.coalesce("comp", "node")), "neardup-comps")


def open_nodes(buckets: DataFrame, nodes: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """(bucket, i, j, node, comp): nodes whose signature agrees well enough with one of another component in their bucket.

    Of a bucket's n nodes, r are outside its largest component. Where these are the lesser half, blocks of the r (i) meet
    blocks of all n (j), so that the largest component is never compared with itself; else every two blocks of all
    meet (i <= j). Each two blocks are a group of their own, which compares signatures and gives back nodes, not pairs.
    A pair that shares several buckets is looked at in the first band only.
    """
    with_comp = _with_comp(buckets, links)
    parts = with_comp.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    open_ = parts.groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.max("k").alias("most"), F.sum("k").alias("n")).filter("n > most").withColumn("even", 2 * F.col("most") < F.col("n"))
    open_ = stored(open_.select("bucket", "major", "n", "even", F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("few"), F.ceil(F.col("n") / BLOCK).alias("all")), "neardup-open-buckets")
    dealt_rows = open_.agg(F.sum(F.when(F.col("even"), F.col("n") * F.col("all")).otherwise(2 * F.col("n") * F.col("few")))).first()[0] or 0
    rows = joined(with_comp, open_, ["bucket"], "n", total)
    deal = lambda c: F.pmod(F.xxhash64("node"), c)
    span = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    uneven, even = rows.filter("NOT even"), rows.filter("even").withColumn("own", deal(F.col("all")))
    right = uneven.select("bucket", "node", "comp", F.explode(span("few")).alias("i"), deal(F.col("all")).alias("j"), F.lit(0).cast("long").alias("role"))
    left = uneven.filter("comp <> major").select("bucket", "node", "comp", deal(F.col("few")).alias("i"), F.explode(span("all")).alias("j"), F.lit(1).cast("long").alias("role"))
    # Roles 2 and 3: the first and the second of two blocks of all; in a group of one block it meets itself.
    each = even.select("bucket", "node", "comp", "own", F.explode(span("all")).alias("other"))
    each = each.select("bucket", "node", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 2).otherwise(3).cast("long").alias("role"))
    dealt = right.unionByName(left).unionByName(each).join(nodes.select("node", "sig", "bands"), "node")

    def run(g):
        sig, bands, comp, node = _matrix(g["sig"], np.uint16), np.stack(g["bands"]), g["comp"], g["node"]
        i, j, bucket = g["i"][0], g["j"][0], g["bucket"][0]
        here = int(np.argmax(bands[0] == bucket))
        role = g["role"]
        left, right = np.flatnonzero((role == 1) | (role == 2)), np.flatnonzero((role == 0) | (role == 3))
        right = left if i == j and role.max() >= 2 else right
        hit = np.zeros(len(node), dtype=bool)
        for k in left:
            other = right[comp[right] != comp[k]]
            if len(other):
                other = other[_agreement(sig[k], sig[other]) >= THRESHOLD - ESTIMATE_MARGIN]
                other = other[(bands[other] == bands[k]).argmax(axis=1) == here]
                hit[other] = True
                hit[k] |= len(other) > 0
        at = np.flatnonzero(hit)
        _, first = np.unique(node[at], return_index=True)
        at = at[first]
        return np.stack([np.full(len(at), bucket), np.full(len(at), i), np.full(len(at), j), node[at], comp[at]], axis=1)

    return _grouped(dealt, ["bucket", "i", "j"], run, "bucket long, i long, j long, node long, comp long", int(dealt_rows))


def _merging(g: dict[str, np.ndarray]) -> np.ndarray:
    """Links (a, b) at or above the threshold that join different components, as few as join them, by an all-pairs count of common members."""
    sets = [np.frombuffer(x, dtype=np.uint64) for x in g["bag"]]
    size = np.array([len(x) for x in sets], dtype=np.float64)
    row = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1
    row, col = row[seen[col] > 1], shared[col[seen[col] > 1]]
    both = np.zeros((len(sets), len(sets)))
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for start in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
        lo, hi = np.searchsorted(col, [start, start + 4096])
        x = np.zeros((len(sets), 4096), dtype=np.float32)
        x[row[lo:hi], col[lo:hi] - start] = 1
        both += x @ x.T
    alike = both / np.maximum(size[:, None] + size[None, :] - both, 1)
    label = g["comp"].copy()
    out = []
    for k in range(len(sets)):
        # One link is enough to each component that k is alike to.
        while len(other := np.flatnonzero((alike[k] >= THRESHOLD) & (label != label[k]))):
            out.append((max(g["node"][k], g["node"][other[0]]), min(g["node"][k], g["node"][other[0]])))
            label[label == label[other[0]]] = label[k]
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def leftover_links(buckets: DataFrame, nodes: DataFrame, links: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """Links that the stars missed, between nodes of one bucket; as few as join the same components."""
    left = stored(open_nodes(buckets, nodes, links, total), "neardup-open")
    return _grouped(left.join(bags_of(left, nodes, texts), "node"), ["bucket", "i", "j"], _merging, "a long, b long", left.count()).distinct()


def classified(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(doc_id, row, uid, k1, k2 of each document row; the class of each distinct bag; number of rows).

    Equal bags are one node, however many documents share it. All links are between nodes; classes are counted over nodes,
    and only then carried back to rows. The table of bags has k1, k2, n_rows, class_id, class_size, kept (row key that stays) and kept_uid (number of the one row that stays).
    """
    with small_batches(docs.sparkSession):
        return _classified(docs)


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``classified`` with the session's batches; all that goes through Python is stored when it returns."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", row_key().alias("row"))
    signed = signatures(rows.select(F.col("doc_id").cast("string").alias("doc_id"), "row", token_hashes("text").alias("tokens")))
    # Stored, so that the numbers of rows stay.
    signed = stored(signed.withColumn("uid", F.monotonically_increasing_id()), "neardup-signed")
    # A null doc_id comes after all others when the kept row is chosen.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast(kind).alias("doc_id"), "row", "uid"))
    known = signed.filter("k1 IS NOT NULL")
    least = F.min(F.col("doc_id").cast(kind))
    nodes = known.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_rows"), first.alias("first"), least.alias("least"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    # Stored, so that the numbers stay.
    nodes = stored(nodes.select("k1", "k2", "n_rows", "first", "least", "sig", "bands", F.col("first.row").alias("row"), F.monotonically_increasing_id().alias("node")), "neardup-nodes")
    sums = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows")).first()
    n_nodes, n_rows = sums["n"], int(sums["rows"] or 0)
    every = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stored(every.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "neardup-shared")
    buckets = stored(joined(every, shared, ["bucket"], "n", n_nodes * BANDS).select("bucket", "node", "centre"), "neardup-buckets")
    texts = rows.select("row", "text")
    # Each bucket as a star: all members against one. What that leaves apart meets block by block.
    links = star_links(buckets.filter("node <> centre").select("centre", "node").distinct(), nodes, texts)
    links = links.unionByName(stored(leftover_links(buckets, nodes, links, texts, n_nodes * BANDS), "neardup-more"))
    comps = stored(components(links), "neardup-components")
    of_node = stored(nodes.select("node", "k1", "k2", "n_rows", "first", "least").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "neardup-of-node")
    heads = of_node.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("n_rows").alias("class_size"), F.count(F.lit(1)).alias("n_nodes"), F.min("first").alias("stays"))
    classes = joined(of_node, stored(heads, "neardup-heads"), ["comp"], "n_nodes", n_nodes)
    classes = classes.select("k1", "k2", "n_rows", "class_id", "class_size", F.col("stays.row").alias("kept"), F.col("stays.uid").alias("kept_uid"))
    return signed.select("doc_id", "row", "uid", "k1", "k2"), stored(classes, "neardup-classes"), n_rows


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its class), class_size, is_duplicate (not the row of its class that is kept).

    Of each class one row is no duplicate: the one with the least doc_id, null last, then the least row key, then the first of equal rows. Texts without words, null or empty, are alike to nothing: each is a class of its own. Texts of
    under five words are one shingle. Repeated rows and exact copies are in one class; ties go to the
    least doc_id. A null doc_id gets the class of its text. An empty table gives no rows; extra
    columns are left out.
    """
    rows, classes, n_rows = classified(docs)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    out = joined(rows.filter("k1 IS NOT NULL"), classes, ["k1", "k2"], "n_rows", n_rows).select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "class_size", (F.col("uid") != F.col("kept_uid")).alias("is_duplicate"))
    alone = rows.filter("k1 IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(False).alias("is_duplicate"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without near duplicates: of each class the least (doc_id, row key) stays.

    All rows whose text has no words (null, empty, signs only) stay, repeated ones too. Of other rows that repeat both
    doc_id and text one stays: the least by all columns, written as JSON. A null doc_id stays only where
    its class has no other. An empty table gives no rows; columns of any name are carried through.
    """
    rows, classes, n_rows = classified(docs)
    (key,) = fresh(docs, "_row")
    met = joined(rows.filter("k1 IS NOT NULL"), classes, ["k1", "k2"], "n_rows", n_rows)
    gone = stored(met.filter(F.col("row") != F.col("kept")).select(F.col("row").alias(key)).distinct(), "neardup-gone")
    twice = stored(met.filter(F.col("row") == F.col("kept")).groupBy(F.col("row").alias(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "neardup-twice")
    wordless = ~F.coalesce(F.col("text").rlike(WORD_CHAR), F.lit(False))
    keyed = docs.withColumn(key, row_key())
    out = keyed.filter(~wordless).join(maybe_broadcast(gone, MOST_BROADCAST_NODES), key, "left_anti")
    if not twice.isEmpty():
        twice = maybe_broadcast(twice, MOST_BROADCAST_NODES)
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        one = out.join(twice, key, "left_semi").groupBy(key).agg(F.min_by(whole, F.to_json(whole)).alias("_whole")).select("_whole.*")
        out = out.join(twice, key, "left_anti").select(*docs.columns).unionByName(one)
    return out.select(*docs.columns).unionByName(docs.filter(wordless))
