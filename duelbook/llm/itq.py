"""Near-duplicate vectors by iterative quantisation.

A rotation of the principal axes is learned so that the signs of the rotated values, a balanced binary code, lose as little as
possible. Codes are cut into substrings, one hash table each: two vectors that share a substring and have few bits apart
meet, and their cosine is counted from the original vectors, in double precision. How long substrings are goes with
the logarithm of the number of vectors, how many tables there are with what share of pairs at the threshold they find on
the sample that the rotation was learned from.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, joined, stored, tasks_for
from .graph import components

THRESHOLD = 0.98
#: Vectors that the rotation is learned from, drawn by hash; rounds of ITQ.
SAMPLE, ROUNDS = 20_000, 30
#: Share of pairs at the threshold, made from the sample, that tables must find; codes at most, each with a rotation of its own.
RECALL, MOST_CODES = 0.985, 24
#: Vectors expected in one bucket are 2 to the power of -SPARSE.
SPARSE, LEAST_BITS, MOST_BITS = 2, 6, 30
#: Nodes of one block; blocks of a bucket meet two by two.
BLOCK = 512
ROWS_PER_TASK = 100_000
#: What a bucket is told by, and a group: two blocks of a bucket.
BUCKET = ["size", "table", "bucket"]
PAIR = [*BUCKET, "i", "j"]


@dataclass
class Index:
    """Codes of vectors of one length: mean, axes (one matrix a code), tables as (code, first bit), bits of a substring, most bits apart."""

    mean: np.ndarray
    axes: list[np.ndarray]
    tables: list[tuple[int, int]]
    bits: int
    apart: int

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """Of each code, (vectors x bits) signs."""
        return [(x - self.mean) @ a > 0 for a in self.axes]

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors x tables) substrings as integers, and (vectors x bytes) all codes packed."""
        codes = self.codes(x)
        weight = 1 << np.arange(self.bits, dtype=np.int64)
        keys = np.stack([codes[c][:, b : b + self.bits] @ weight[: codes[c].shape[1] - b] for c, b in self.tables], axis=1) if self.tables else np.zeros((len(x), 0), np.int64)
        return keys, np.packbits(np.concatenate(codes, axis=1), axis=1)


def rotation(v: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Of projected, centred vectors: the rotation that brings them closest to their own signs (ITQ), from a random start."""
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
        r = (u @ w).T
    return r


def neighbours(x: np.ndarray, cosine: float) -> np.ndarray:
    """For each unit vector one at exactly this cosine, in a random direction."""
    noise = np.random.default_rng(11).standard_normal(x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    return cosine * x + math.sqrt(1 - cosine * cosine) * noise


def fit(x: np.ndarray, n: int, threshold: float = THRESHOLD) -> Index:
    """An index for ``n`` vectors of a label, learned from a sample of unit vectors in random order.

    Codes are added until the tables find RECALL of pairs at the threshold, planted at a fifth of the sample that the rotations
    have not seen; if MOST_CODES do not, substrings get shorter.
    """
    held, x = (x[: len(x) // 5], x[len(x) // 5 :]) if len(x) >= 10 else (x, x)
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    near = neighbours(held, threshold)
    bits = max(LEAST_BITS, min(MOST_BITS, math.ceil(math.log2(max(n, 2))) + SPARSE))
    while True:
        bits = min(bits, len(axes))
        index, found, apart = Index(mean, [], [], bits, 0), np.zeros(len(held), dtype=bool), np.zeros(len(held), dtype=np.int64)
        while len(index.axes) < MOST_CODES and (not index.axes or found.mean() < RECALL):
            index.axes.append(axes.T @ rotation((x - mean) @ axes.T, len(index.axes)))
            one, two = (y - mean @ index.axes[-1] > 0 for y in (held @ index.axes[-1], near @ index.axes[-1]))
            apart += (one != two).sum(axis=1)
            for b in range(0, len(axes) - bits + 1, bits):
                if found.mean() < RECALL or not index.tables:
                    index.tables.append((len(index.axes) - 1, b))
                    found |= (one[:, b : b + bits] == two[:, b : b + bits]).all(axis=1)
        if found.mean() >= RECALL or bits <= 1:
            index.apart = int(math.ceil(apart.mean() + 4 * apart.std() + 1))
            return index
        bits -= 1


def unit(vectors: list, size: int) -> np.ndarray:
    x = np.stack([np.frombuffer(v, dtype="<f8") for v in vectors]).reshape(len(vectors), size)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, label, size, vec, n, least) of the distinct vectors of each label that can be compared, packed as doubles. Stored."""
    values = F.transform("embedding", lambda v: v.cast("double"))
    fine = (F.size("embedding") > 0) & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(values, lambda v: v != 0)
    usable = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)

    def packed(batches):
        for batch in batches:
            # Adding 0.0 turns -0.0 into 0.0.
            vec = [(np.asarray(v, dtype="<f8") + 0.0).tobytes() for v in batch["embedding"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "vec": vec})

    rows = usable.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("label").cast("string").alias("label"), values.alias("embedding"))
    rows = rows.mapInPandas(packed, "vec_id string, label string, vec binary")
    kind = vectors.schema["vec_id"].dataType
    keyed = rows.select(F.col("vec_id").cast(kind).alias("vec_id"), "label", "vec", F.md5("vec").alias("digest"))
    by_key = keyed.groupBy("label", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"))
    return stored(by_key.select(F.monotonically_increasing_id().alias("node"), "label", "digest", (F.octet_length("vec") / 8).cast("long").alias("size"), "vec", "n", "least"), "itq-nodes")


def learned(nodes: DataFrame, threshold: float, sample: int) -> dict[int, Index]:
    """An index for each length of vectors that the sample holds; others are compared without one."""
    total = nodes.count()
    share = F.lit(min(1.0, 2 * sample / max(total, 1)) * 2.0**63)
    drawn = nodes.filter(F.abs(F.xxhash64("digest").cast("double")) <= share).orderBy(F.xxhash64("digest"), "digest", "label").select("size", "vec").limit(sample)
    got = drawn.toPandas()  # at most ``sample`` vectors
    most = {r["size"]: r["n"] for r in nodes.groupBy("size", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("size").agg(F.max("k").alias("n")).filter(F.col("size").isin(got["size"].unique().tolist())).collect()}
    out = {}
    for size, own in got.groupby("size"):
        if len(own) > 1 and size > 1:
            out[int(size)] = fit(unit(list(own["vec"]), int(size)), most[size], threshold)
    return out


def buckets(nodes: DataFrame, index: dict[int, Index]) -> DataFrame:
    """(bucket, size, table, node, code): a row for each vector and table; the bucket is a hash of label and substring."""

    def run(batches):
        for batch in batches:
            for size, own in batch.groupby("size"):
                made = index.get(int(size))
                if made is None:
                    yield pd.DataFrame({"node": own["node"], "label": own["label"], "size": size, "table": 0, "key": 0, "code": b""})
                    continue
                keys, code = made.keys(unit(list(own["vec"]), int(size)))
                code = [c.tobytes() for c in code]
                for t in range(keys.shape[1]):
                    yield pd.DataFrame({"node": own["node"], "label": own["label"], "size": size, "table": t, "key": keys[:, t], "code": code})

    got = nodes.select("node", "label", "size", "vec").mapInPandas(run, "node long, label string, size long, table long, key long, code binary")
    return got.select(F.xxhash64("label", "key").alias("bucket"), "size", "table", "node", "code")


def _dealt(members: DataFrame) -> DataFrame:
    """(bucket, n, ...) with blocks (i, j), i <= j, of about BLOCK nodes: each node once with each block of its bucket. ``side`` 0: in i."""
    own = members.withColumns({"blocks": F.ceil(F.col("n") / BLOCK), "own": F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))})
    each = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return each.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("long")}).drop("blocks", "own", "other")


def _codes(blobs: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(len(blobs), -1)


def _two_sides(r: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
    first, second = np.flatnonzero(r["side"] == 0), np.flatnonzero(r["side"] == 1)
    same = r["i"][0] == r["j"][0]
    return first, first if same else second, same


def open_nodes(spread: DataFrame, index: dict[int, Index], tasks: int) -> DataFrame:
    """(bucket, i, j, size, table, node, side, code): nodes that have another one of the group within the most bits apart."""
    apart = {k: v.apart for k, v in index.items()}

    def run(r: dict[str, np.ndarray]) -> dict:
        one, two, same = _two_sides(r)
        code, hit = _codes(r["code"]), np.zeros(len(r["node"]), dtype=bool)
        limit = apart.get(int(r["size"][0]), 0)
        for k in one:
            near = two[np.bitwise_count(code[two] ^ code[k]).sum(axis=1) <= limit] if code.shape[1] else two
            near = near[near != k]
            hit[near] = True
            hit[k] |= len(near) > 0
        return {c: r[c][hit] for c in ("bucket", "i", "j", "size", "table", "node", "side", "code")}

    return grouped(spread, PAIR, run, "bucket long, i long, j long, size long, table long, node long, side long, code binary", tasks=tasks)


def _earlier(index: Index | None, code: np.ndarray, a: np.ndarray, b: np.ndarray, table: int) -> np.ndarray:
    """Whether pairs (a, b) share the substring of a table before this one: there they were counted."""
    out = np.zeros(len(a), dtype=bool)
    if index is None:
        return out
    bits, per_code = np.unpackbits(code, axis=1), index.axes[0].shape[1]
    for c, at in index.tables[:table]:
        own = bits[:, c * per_code + at : c * per_code + at + index.bits]
        out |= (own[a] == own[b]).all(axis=1)
    return out


def counted_links(opened: DataFrame, nodes: DataFrame, index: dict[int, Index], threshold: float, tasks: int) -> DataFrame:
    """(node, links, a, b): how many rows each node of a group is linked with, and links enough to join what they join. Stored.

    Cosines of a group's nodes are one product of two matrices; a pair that meets in several tables counts in the first one.
    """

    def run(r: dict[str, np.ndarray]) -> dict:
        one, two, same = _two_sides(r)
        none = {c: [] for c in ("node", "links", "a", "b")}
        if not len(one) or not len(two):
            return none
        size, table = int(r["size"][0]), int(r["table"][0])
        x = unit(list(r["vec"]), size)
        at, to = np.nonzero(x[one] @ x[two].T >= threshold)
        a, b = one[at], two[to]
        keep = a < b if same else a != b
        a, b = a[keep], b[keep]
        fresh_ = ~_earlier(index.get(size), _codes(r["code"]), a, b, table)
        a, b = a[fresh_], b[fresh_]
        links = np.bincount(a, r["n"][b], len(x)).astype(np.int64) + np.bincount(b, r["n"][a], len(x)).astype(np.int64)
        head, before = np.arange(len(x)), None
        while not np.array_equal(head, before):  # the least node that links lead to inside the group
            before = head.copy()
            np.minimum.at(head, a, before[b])
            np.minimum.at(head, b, before[a])
        linked = np.flatnonzero(links)
        return {"node": r["node"][linked], "links": links[linked], "a": r["node"][linked], "b": r["node"][head[linked]]}

    met = opened.join(nodes.select("node", "vec", "n"), "node")
    return stored(grouped(met, PAIR, run, "node long, links long, a long, b long", tasks=tasks), "itq-links")


def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows of one non-null label whose vectors have one length and a cosine of ``threshold`` or more are linked, if a table finds
    them; equal vectors always are. Null and zero vectors, empty ones, and those with null or non-finite components link with
    nothing, nor do rows with a null label. A component has its least vec_id; rows with a null vec_id count as rows, and their
    component is null only if it has no other id. Rows that repeat a vec_id are rows of their own. An empty table gives no rows;
    other columns are left out, whatever their names.
    """
    spark = vectors.sparkSession
    nodes = nodes_of(vectors)
    sums = nodes.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    n_nodes, n_rows = sums["k"], int(sums["n"] or 0)
    index = learned(nodes, threshold, sample)
    tables = max([len(i.tables) for i in index.values()], default=1)
    tasks = tasks_for(spark, n_nodes * tables, ROWS_PER_TASK)
    every = stored(buckets(nodes, index), "itq-buckets")
    shared = stored(every.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "itq-shared")
    opened = stored(open_nodes(_dealt(joined(every, shared, BUCKET, "n", n_nodes * tables)), index, tasks), "itq-open")
    links = counted_links(opened, nodes, index, threshold, tasks)
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(links.select("a", "b"))
    of_node = nodes.select("node", "label", "digest", "n", "least").join(n_links, "node", "left").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    of_node = stored(of_node, "itq-of-node")
    heads = stored(of_node.groupBy("comp").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("k")), "itq-heads")
    known = joined(of_node, heads, ["comp"], "k", n_nodes).select("label", "digest", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return _to_rows(vectors, stored(known, "itq-known"), n_rows)


def _to_rows(vectors: DataFrame, known: DataFrame, n_rows: int) -> DataFrame:
    """Each row's values from its label and vector; rows that link with nothing stand alone."""

    def digests(batches):
        for batch in batches:
            vec = [None if v is None else (np.asarray(v, dtype="<f8") + 0.0).tobytes() for v in batch["embedding"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "vec": vec})

    rows = vectors.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("label").cast("string").alias("label"), F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    rows = rows.mapInPandas(digests, "vec_id string, label string, vec binary").select(F.col("vec_id").cast(vectors.schema["vec_id"].dataType).alias("vec_id"), "label", F.md5("vec").alias("digest"))
    rows = stored(rows, "itq-rows")
    met = joined(rows, known, ["label", "digest"], "n", n_rows).select("vec_id", "n_links", "component_id")
    alone = rows.join(known, ["label", "digest"], "left_anti").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = met.unionByName(alone)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
