"""Language-model scores by deleted interpolation.

P(w | u v) = l3[b] c(u v w) / c(u v) + l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1), where b is the bucket of the
context's frequency: of c(u v) where that is above zero, else of c(v). The weights are learned by
expectation-maximisation: the counts come from the retained part of the training documents, the likelihood
from the deleted part. The final model has those weights and the counts of both parts. Unseen tokens
share one of the V + 1 equal parts.

Texts are read and split once, where they lie: each task packs its documents into blocks of bounded size (distinct words
and each token's number). Counts meet documents without a row for each token: a block sends its distinct n-grams, sorted and
packed, to the ranges of hash values that it has some of; a range adds up all blocks' counts and sends back to each block
the totals in the block's own order. An n-gram thus weighs on a range once a block, however frequent it is, and nothing
is kept by a driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

GAP = r"[\x20\x09-\x0D]+"
#: Tokens in a block, and bytes of text for each range of hash values. Both grow with the root of the corpus up to
#: GROWTH times, so that a block's row for a range keeps some hundred n-grams and rows grow in proportion to the text.
BLOCK_TOKENS, RANGE_BYTES, ROOT_AT, GROWTH = 700_000, 20_000_000, 2_000_000_000, 6
#: One in so many training documents is in the deleted part.
DELETED_OF = 12
#: EM ends when a round improves the log-likelihood by less than this share of it, or after so many rounds.
EM_GAIN, EM_ROUNDS = 1e-5, 40
#: Mixture weights at the start (uniform, unigram, bigram, trigram): unseen context, known word, known pair.
START_WEIGHTS = ((0.1, 0.9, 0.0, 0.0), (0.1, 0.3, 0.6, 0.0), (0.05, 0.15, 0.3, 0.5))
BUCKETS = 64
U = np.uint64
END, START = U(0x656E64), U(0x7374617274)
#: Bits of the key of a pair or triple. Of a billion n-grams one in 280,000 shares its key with another, of a trillion one in 280.
GRAM_BITS = 48


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id, as text, leaves 2 when divided by 7; a null id is as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def deleted(doc_id: Column) -> Column:
    """Whether a training document is in the deleted part."""
    return ~held_out(doc_id) & (F.pmod(F.xxhash64(F.lit("deleted"), doc_id.cast("string")), F.lit(DELETED_OF)) == 0)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def pack(values: np.ndarray) -> bytes:
    """Unsigned values as byte planes, without those that are all zero."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = 8
    while used and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + planes[:used].tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[: data[0]] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(data[0], n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


class Block:
    """The n-grams of a block's texts, as keys with where each token's are: from its distinct words, each token's word and the texts' sizes."""

    def __init__(self, words: np.ndarray, word_at: np.ndarray, sizes: np.ndarray):
        self.words, self.word_at = words, word_at
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        flat = words[word_at]
        self.first = np.zeros(len(flat), dtype=bool)
        self.first[np.cumsum(sizes)[:-1]] = True
        self.first[:1] = True
        before = np.roll(flat, 1)
        before[self.first] = START
        with np.errstate(over="ignore"):
            pair = _mix(_mix(before + U(0x9E3779B97F4A7C15)) + flat)
            triple = _mix(np.roll(pair, 1) * U(0x9E3779B97F4A7C15) + flat + U(3)) >> U(64 - GRAM_BITS)
        # A text's first token has no word before it but the start: its triple is never looked at.
        triple[self.first] = 0
        self.pairs, self.pair_at = np.unique(pair >> U(64 - GRAM_BITS), return_inverse=True)
        self.triples, self.triple_at = np.unique(triple, return_inverse=True)

    def kinds(self):
        return ((0, self.words, self.word_at, 64), (1, self.pairs, self.pair_at, GRAM_BITS), (2, self.triples, self.triple_at, GRAM_BITS))

    def context(self, word: np.ndarray, pair: np.ndarray, texts: float) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each token's contexts: of the word before it (or of text starts), and of the pair before it (0 for a first token)."""
        one, two = np.roll(word, 1), np.roll(pair, 1)
        one[self.first], two[self.first] = texts, 0
        return one, two


def _unpacked(row) -> Block:
    words = np.cumsum(unpack(row["words"], row["n_words"]), dtype=np.uint64)
    return Block(words, unpack(row["word_at"], row["n_tokens"]).astype(np.int64), unpack(row["sizes"], len(row["train"])).astype(np.int64))


def _edges(ranges: int, bits: int) -> np.ndarray:
    """Where each range of keys begins."""
    return np.array([i * (1 << bits) // ranges for i in range(ranges)], dtype=np.uint64)


BLOCKS = "block long, deleted boolean, doc_ids array<string>, train binary, sizes binary, n_tokens long, n_words long, words binary, word_at binary, train_texts long, train_tokens long"


def blocks(docs: DataFrame, most_tokens: int) -> DataFrame:
    """Documents packed where they lie (BLOCKS), stored. Deleted training documents are in blocks of their own.

    A block's number is its task's and the order in that; repeated rows spread over blocks like any others.
    """
    gap = F.filter(F.split(ascii_lower(F.coalesce("text", F.lit(""))), GAP), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), deleted(F.col("doc_id")).alias("deleted"), F.transform(gap, lambda w: F.xxhash64(w)).alias("tokens"))

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        held = {False: ([], [], [], 0), True: ([], [], [], 0)}

        def block(kind):
            nonlocal made
            ids, train, tokens, _ = held[kind]
            held[kind] = ([], [], [], 0)
            sizes = np.array([len(t) + 1 for t in tokens], dtype=np.int64)
            flat = np.concatenate([np.append(np.asarray(t, dtype=np.int64).view(np.uint64), END) for t in tokens])
            words, at = np.unique(flat, return_inverse=True)
            flags = np.array(train, dtype=bool)
            row = (part << 32 | made, kind, ids, flags.tobytes(), pack(sizes.astype(np.uint64)), len(flat), len(words), pack(np.diff(words, prepend=U(0))), pack(at.astype(np.uint64)), int(flags.sum()), int(sizes[flags].sum()))
            made += 1
            return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for doc_id, train, kind, tokens in zip(batch["doc_id"], batch["train"], batch["deleted"], batch["tokens"], strict=True):
                ids, flags, texts, size = held[bool(kind)]
                ids.append(doc_id)
                flags.append(train)
                texts.append(tokens)
                held[bool(kind)] = (ids, flags, texts, size + len(tokens) + 1)
                if size + len(tokens) + 1 >= most_tokens:
                    yield block(bool(kind))
        for kind in (False, True):
            if held[kind][0]:
                yield block(kind)

    return stored(rows.mapInPandas(run, BLOCKS), "lm-blocks", "zstd")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def counts(packed: DataFrame, ranges: int) -> DataFrame:
    """(block, kind, range, n_total, n_distinct, total, kept): totals of each block's n-grams, in the block's order. Stored.

    ``total`` has the counts in all training documents, ``kept`` those in the retained ones (deleted
    blocks only).
    """

    def send(batches):
        for batch in batches:
            for _, row in batch.iterrows():
                block, train = _unpacked(row), np.frombuffer(row["train"], dtype=bool)
                out = []
                for kind, keys, at, bits in block.kinds():
                    seen = np.bincount(at, train[block.text], len(keys)).astype(np.uint64)
                    edges = _edges(ranges, bits)
                    cut = np.append(np.searchsorted(keys, edges), len(keys))
                    # Only ranges that the block has n-grams of: at most as many rows as n-grams.
                    for r in np.flatnonzero(np.diff(cut)):
                        own = keys[cut[r] : cut[r + 1]]
                        out.append((row["block"], row["deleted"], kind, r, len(own), pack(np.diff(own, prepend=edges[r])), pack(seen[cut[r] : cut[r + 1]])))
                yield pd.DataFrame(out, columns=["block", "deleted", "kind", "range", "n", "keys", "seen"])

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        kind, r = int(batch["kind"].iloc[0]), int(batch["range"].iloc[0])
        edge = U(r * (1 << (64 if kind == 0 else GRAM_BITS)) // ranges)
        with np.errstate(over="ignore"):
            keys = [np.cumsum(unpack(k, n), dtype=np.uint64) + edge for k, n in zip(batch["keys"], batch["n"], strict=True)]
        seen = np.concatenate([unpack(s, n) for s, n in zip(batch["seen"], batch["n"], strict=True)]).astype(np.float64)
        of_kept = np.repeat(~batch["deleted"].to_numpy(dtype=bool), batch["n"])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, seen, len(distinct)).astype(np.uint64)[at]
        kept = np.bincount(at, seen * of_kept, len(distinct)).astype(np.uint64)[at]
        ends = np.cumsum(batch["n"].to_numpy())
        known = int(np.unique(at[total > 0]).size)
        return pd.DataFrame(
            [(int(b), kind, r, int(seen.sum()), known, pack(total[e - n : e]), pack(kept[e - n : e]) if d else b"") for b, d, n, e in zip(batch["block"], batch["deleted"], batch["n"], ends, strict=True)],
            columns=["block", "kind", "range", "n_total", "n_distinct", "total", "kept"],
        )

    sent = packed.mapInPandas(send, "block long, deleted boolean, kind int, range int, n long, keys binary, seen binary")
    # As many tasks as groups: what one task reads stays the same as the corpus grows.
    sent = sent.repartition(max(_partitions(packed), 3 * ranges), "kind", "range")
    return stored(sent.groupBy("kind", "range").applyInPandas(add, "block long, kind int, range int, n_total long, n_distinct long, total binary, kept binary"), "lm-counts", "zstd")


def _looked_up(block: Block, right: pd.DataFrame, column: str, ranges: int) -> list[np.ndarray]:
    """Counts of each token's word, pair and triple."""
    out = []
    for kind, keys, at, bits in block.kinds():
        cut = np.append(np.searchsorted(keys, _edges(ranges, bits)), len(keys))
        own = right[right["kind"] == kind].sort_values("range")
        parts = [unpack(data, int(cut[r + 1] - cut[r])) for r, data in zip(own["range"], own[column], strict=True)]
        out.append(np.concatenate(parts).astype(np.float64)[at])
    return out


def buckets(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """0 for unseen contexts; 1 to 31, one for each doubling of the word's frequency, where the pair is unseen; 32 to 63 by the pair's."""
    doubling = lambda c: np.minimum(np.floor(np.log2(np.maximum(c, 1))) + 1, 31)
    return np.where(two > 0, 31 + doubling(two), np.where(one > 0, doubling(one), 0)).astype(np.int64)


def _parts(block: Block, found: list[np.ndarray], tokens: float, texts: float) -> tuple[np.ndarray, np.ndarray]:
    """Each token's bucket, and its relative frequencies (unigram, bigram, trigram)."""
    word, pair, triple = found
    one, two = block.context(word, pair, texts)
    triple = np.where(two > 0, triple, 0)
    return buckets(one, two), np.stack([word / max(tokens, 1), pair / np.maximum(one, 1), triple / np.maximum(two, 1)], axis=1)


def learned_weights(packed: DataFrame, got: DataFrame, ranges: int, kept_tokens: float, kept_texts: float, vocabulary: int) -> tuple[dict[int, tuple[float, ...]], list[float]]:
    """Mixture weights (uniform, unigram, bigram, trigram) by bucket, and the log-likelihood of each round: EM on the deleted part's counts against the retained part's."""

    def collect(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"bucket": [], "f1": [], "f2": [], "f3": [], "n": []})
        block = _unpacked(left.iloc[0])
        bucket, f = _parts(block, _looked_up(block, right, "kept", ranges), kept_tokens, kept_texts)
        f = pd.DataFrame({"bucket": bucket, "f1": f[:, 0], "f2": f[:, 1], "f3": f[:, 2]})
        return f.groupby(["bucket", "f1", "f2", "f3"]).size().rename("n").reset_index()

    own = got.filter(F.length("kept") > 0).select("block", "kind", "range", "kept")
    tuples = packed.filter("deleted").groupBy("block").cogroup(own.groupBy("block")).applyInPandas(collect, "bucket long, f1 double, f2 double, f3 double, n long")
    tuples = stored(tuples.groupBy("bucket", "f1", "f2", "f3").agg(F.sum("n").alias("n")), "lm-deleted")
    weights: dict[int, tuple[float, ...]] = {}
    seen: list[float] = []
    f0 = F.lit(1.0 / (vocabulary + 1))
    for _ in range(EM_ROUNDS):
        now = [weights.get(b, _start(b)) for b in range(BUCKETS)]
        share = [F.element_at(F.array(*[F.lit(float(w[i])) for w in now]), (F.col("bucket") + 1).cast("int")) * f for i, f in enumerate((f0, F.col("f1"), F.col("f2"), F.col("f3")))]
        p = share[0] + share[1] + share[2] + share[3]
        sums = [F.sum(F.col("n") * x / p).alias(f"g{i}") for i, x in enumerate(share)]
        rows = tuples.groupBy("bucket").agg(F.sum(F.col("n") * F.log(p)).alias("ll"), *sums).collect()  # at most BUCKETS rows
        seen.append(sum(r["ll"] for r in rows))
        for r in rows:
            total = sum(r[f"g{i}"] for i in range(4))
            # A trace of the uniform and unigram parts stays, so that unseen tokens keep some probability.
            raw = np.maximum([r[f"g{i}"] / total for i in range(4)], [1e-6, 1e-6, 0.0, 0.0])
            weights[r["bucket"]] = tuple(float(x) for x in raw / raw.sum())
        if not rows or (len(seen) > 1 and seen[-1] - seen[-2] <= EM_GAIN * abs(seen[-2])):
            break
    return weights, seen


def _start(bucket: int) -> tuple[float, ...]:
    return START_WEIGHTS[0 if bucket == 0 else 1 if bucket < 32 else 2]


def filled(weights: dict[int, tuple[float, ...]]) -> np.ndarray:
    """A row of weights for each bucket; those without data take the next lower one's of their kind."""
    out = np.zeros((BUCKETS, 4))
    for b in range(BUCKETS):
        out[b] = weights.get(b, _start(b) if b in (0, 1, 32) else out[b - 1])
    return out


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    A null text is empty: its only token is the end. Rows with equal text and doc_id have equal
    scores; repeated rows each count. Without any training document, all probabilities are uniform.
    An empty table gives no rows; extra columns are left out.
    """
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    growth = min(GROWTH, max(1.0, math.sqrt(size / ROOT_AT)))
    ranges = max(1, math.ceil(size / (RANGE_BYTES * growth)))
    packed = blocks(docs, int(BLOCK_TOKENS * growth))
    got = counts(packed, ranges)
    sums = got.filter("kind = 0").groupBy("range").agg(F.max("n_total").alias("n"), F.max("n_distinct").alias("v")).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_all, vocabulary = int(sums["n"] or 0), int(sums["v"] or 0)
    parts = {r["deleted"]: r for r in packed.groupBy("deleted").agg(F.count(F.lit(1)).alias("blocks"), F.sum("train_texts").alias("texts"), F.sum("train_tokens").alias("tokens")).collect()}
    kept = parts.get(False, {"texts": 0, "tokens": 0})
    weight = filled(learned_weights(packed, got, ranges, float(kept["tokens"]), float(kept["texts"]), vocabulary)[0])
    train_texts = float(sum(r["texts"] for r in parts.values()))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def score(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({c: [] for c in names})
        row = left.iloc[0]
        block = _unpacked(row)
        found = _looked_up(block, right, "total", ranges)
        bucket, f = _parts(block, found, n_all, train_texts)
        w = weight[bucket]
        p = w[:, 0] / (vocabulary + 1) + (w[:, 1:] * f).sum(axis=1)
        n = len(row["doc_ids"])
        train = np.frombuffer(row["train"], dtype=bool)
        sums = [np.bincount(block.text, x, n) for x in (found[0] > 0, np.log10((found[0] + 1) / (n_all + vocabulary + 1)), np.log10(p))]
        return pd.DataFrame(dict(zip(names, [list(row["doc_ids"]), ~train, np.bincount(block.text, minlength=n), sums[0].astype(np.int64), sums[1], sums[2]], strict=True)))

    kind = docs.schema["doc_id"].dataType.simpleString()
    tasks = max(_partitions(packed), sum(r["blocks"] for r in parts.values()))
    sides = [df.repartition(tasks, "block").groupBy("block") for df in (packed, got.select("block", "kind", "range", "total"))]
    out = sides[0].cogroup(sides[1]).applyInPandas(score, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
