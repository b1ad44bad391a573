"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. For each bit, a binary n-gram classifier (log-odds of hashed 2- and
3-grams among the languages with a 1 against those with a 0, counted over all training documents)
gives a signed margin; the language whose codeword has the least weighted logistic loss wins. Two
languages that come close make the prediction ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled, stored

GRAMS, BUCKETS = (2, 3), 1 << 14
#: Buckets whose tables are summed in one call.
RANGE = 256
#: Documents, drawn by hash, from which the bits' error rates are taken, by tables counted without their part of the documents.
CALIBRATION_DOCS = 4_000
#: Texts that are decoded at once.
DECODED = 1_000
CHUNK_CHARS = 2_000_000
AMBIGUOUS_BELOW = 0.2
UNKNOWN = "und"


@dataclass
class Codes:
    langs: list[str]
    code: np.ndarray  # langs x bits, -1 or 1
    table: np.ndarray  # bits x buckets, log-odds
    bit_weight: np.ndarray


def codewords(n: int) -> np.ndarray:
    """n codewords: all splits for up to five languages, else spread-out random columns (fixed seed)."""
    if n < 2:
        return np.ones((n, 1), dtype=int)
    if n <= 5:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns).T
    bits, rng = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7)
    tried = [np.sign(rng.permuted(np.tile(np.where(np.arange(n) % 2, 1, -1), (bits, 1)), axis=1)).T for _ in range(50)]
    # Bits that differ between two codewords: half of what the bits lack to their inner product.
    apart = [((bits - x @ x.T) // 2 + bits * np.eye(n, dtype=int)).min() for x in tried]
    return tried[int(np.argmax(apart))]


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x3000)])


def grams(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram and, per text, whether it has a letter.

    Lower-cased; each run of non-letters is one blank; a blank stands at both ends.
    """
    low = [" " + (t or "").lower() + " " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "replace"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = letters[np.minimum(codes, len(letters) - 1)] | (codes >= len(letters)) & np.isin(codes, [c for c in np.unique(codes[codes >= len(letters)]) if chr(c).isalpha()])
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    keep[:1] = True
    has = np.zeros(len(texts), dtype=bool)
    has[owner[letter]] = True
    codes, owner = np.where(letter, codes, 32).astype(np.uint32)[keep], owner[keep]
    text, bucket = [], []
    for n in GRAMS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ codes[j : j + size]) * np.uint32(0x01000193)
        inside = owner[:size] == owner[n - 1 :]
        text.append(owner[:size][inside])
        bucket.append(((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))[inside])
    return np.concatenate(text), np.concatenate(bucket), has


def _chunks(texts: list[str | None]):
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > CHUNK_CHARS:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if len(texts) > at:
        yield at, len(texts)


def margins(table: np.ndarray, texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x bits) summed log-odds over the root of the number of n-grams; which texts have a letter."""
    out, has = np.zeros((len(texts), len(table))), np.zeros(len(texts), dtype=bool)
    for lo, hi in _chunks(texts):
        text, bucket, has[lo:hi] = grams(texts[lo:hi], letters)
        n = np.maximum(np.bincount(text, minlength=hi - lo), 1)
        for b in range(len(table)):
            out[lo:hi, b] = np.bincount(text, table[b][bucket], hi - lo) / np.sqrt(n)
    return out, has


def decode(codes: Codes, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, score, ambiguous): least weighted logistic loss; the score is its share among all languages."""
    ones = (codes.code > 0).T * codes.bit_weight[:, None]
    zeros = (codes.code < 0).T * codes.bit_weight[:, None]
    which, score, unsure = [], [], []
    for lo in range(0, len(margin), DECODED):
        m = margin[lo : lo + DECODED]
        # A bit's loss depends on its side alone: two products instead of a value for each text, language and bit.
        loss = np.logaddexp(0, -m) @ ones + np.logaddexp(0, m) @ zeros
        near = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share = near / near.sum(axis=1, keepdims=True)
        top = np.partition(share, -2, axis=1) if share.shape[1] > 1 else share
        which.append(share.argmax(axis=1))
        score.append(share.max(axis=1))
        unsure.append(top[:, -1] - (top[:, -2] if share.shape[1] > 1 else 0) < AMBIGUOUS_BELOW)
    return np.concatenate(which), np.concatenate(score), np.concatenate(unsure)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id, as text, leaves 2 when divided by 4; a null id is as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def log_odds(counted: DataFrame, langs: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits x buckets) of all rows of (lang, held, bucket, n) and of those not held: of each bit, log of the mean n-gram share
    of the languages with a 1 over that of those with a 0. Summed on the executors: bits and buckets reach the driver, not languages.
    """
    bits = code.shape[1]
    if len(langs) < 2:
        return np.zeros((bits, BUCKETS)), np.zeros((bits, BUCKETS))
    at = {x: i for i, x in enumerate(langs)}
    total = np.zeros((2, len(langs)))
    for r in counted.groupBy("lang").agg(F.sum("n").alias("all"), F.sum(F.when(~F.col("held"), F.col("n")).otherwise(0)).alias("tried")).collect():  # one row a language
        total[:, at[r["lang"]]] = r["all"], r["tried"]
    scale = 1 / (total + 0.5 * BUCKETS)
    sides = np.stack([code > 0, code < 0]).astype(float)  # side x langs x bits

    def add(g: pd.DataFrame) -> pd.DataFrame:
        own, row = np.unique(g["bucket"].to_numpy(dtype=int), return_inverse=True)
        lang, n = g["lang"].map(at).to_numpy(dtype=int), g["n"].to_numpy(dtype=float)
        out = np.zeros((len(own), 2, 2, bits))
        for k, w in enumerate((n, np.where(g["held"].to_numpy(dtype=bool), 0.0, n))):
            cells = np.zeros((len(own), len(langs)))
            np.add.at(cells, (row, lang), w)
            for s, side in enumerate(sides):
                out[:, k, s] = (cells * scale[k]) @ side
        return pd.DataFrame({"bucket": own, "sums": list(out.reshape(len(own), -1))})

    # Ranges of buckets, as one call a bucket would cost more than its sums; a range is at most RANGE x languages cells.
    ranged = counted.groupBy(F.floor(F.col("bucket") / RANGE).alias("range"))
    got = ranged.applyInPandas(add, "bucket long, sums array<double>").toPandas()  # at most BUCKETS rows
    sums = np.zeros((BUCKETS, 2, 2, bits))
    if len(got):
        sums[got["bucket"].to_numpy(dtype=int)] = np.stack(got["sums"].to_numpy()).reshape(-1, 2, 2, bits)
    # What the languages that lack an n-gram have of it.
    sums += 0.5 * np.einsum("kl,slb->ksb", scale, sides)
    mean = sums / sides.sum(axis=1)
    table = np.log(mean[:, :, 0]) - np.log(mean[:, :, 1])  # buckets x (all, tried) x bits
    return table[:, 0].T.copy(), table[:, 1].T.copy()


def train(docs: DataFrame, max_langs: int | None = None) -> Codes:
    """Learns from the text and the non-null ``lang`` of all rows of ``docs``; pass no held-out rows.

    The bits are weighed by their error rates on a quarter of the texts (at most about CALIBRATION_DOCS of it), under tables
    counted on the other three; the final tables have all counts. All languages are learned; ``max_langs`` keeps those with the
    most documents.
    """
    letters = _letters()
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64(F.lit("bits"), "text").alias("draw"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang")
    sizes = (sizes if max_langs is None else sizes.limit(max_langs)).collect()  # one row a language
    langs, n = sorted(r["lang"] for r in sizes), sum(r["n"] for r in sizes)
    labelled = (known if max_langs is None else known.filter(F.col("lang").isin(langs))).withColumn("held", F.pmod("draw", F.lit(4)) == 0)

    def count(batches):
        for batch in batches:
            total: dict[tuple, np.ndarray] = {}
            texts, lang, held = list(batch["text"]), batch["lang"].to_numpy(), batch["held"].to_numpy(dtype=bool)
            for lo, hi in _chunks(texts):
                text, bucket, _ = grams(texts[lo:hi], letters)
                for name in pd.unique(lang[lo:hi]):
                    for h in (False, True):
                        seen = np.bincount(bucket[((lang[lo:hi] == name) & (held[lo:hi] == h))[text]], minlength=BUCKETS)
                        total[name, h] = total.get((name, h), 0) + seen
            for (name, h), seen in total.items():
                at = np.flatnonzero(seen)
                yield pd.DataFrame({"lang": name, "held": h, "bucket": at, "n": seen[at]})

    # At most two rows for each language and bucket.
    counted = stored(labelled.select("lang", "text", "held").mapInPandas(count, "lang string, held boolean, bucket long, n long").groupBy("lang", "held", "bucket").agg(F.sum("n").alias("n")), "langid-counts")
    code = codewords(len(langs))
    table, tried = log_odds(counted, langs, code)
    codes = Codes(langs, code, table, np.ones(code.shape[1]))
    if len(langs) > 1:
        number = {x: i for i, x in enumerate(langs)}
        drawn = labelled.filter(F.col("held") & sampled(4 * CALIBRATION_DOCS / max(n, 1), F.lit("calibration"), "text"))

        def measure(batches):
            for batch in batches:
                margin, _ = margins(tried, list(batch["text"]), letters)
                for name in pd.unique(batch["lang"]):
                    own = (batch["lang"] == name).to_numpy()
                    wrong = (margin[own] * code[number[name]][None, :] <= 0).sum(axis=0)
                    yield pd.DataFrame({"bit": np.arange(code.shape[1]), "wrong": wrong, "n": int(own.sum())})

        # One row for each bit. None, where no text was drawn: then all bits weigh the same.
        got = drawn.select("lang", "text").mapInPandas(measure, "bit long, wrong long, n long").groupBy("bit").agg(F.sum("wrong").alias("wrong"), F.sum("n").alias("n")).toPandas()
        if len(got):
            wrong = np.zeros(code.shape[1])
            wrong[got["bit"].to_numpy(dtype=int)] = got["wrong"] / got["n"]
            wrong = np.clip(wrong, 1e-3, 0.49)
            codes.bit_weight = np.log((1 - wrong) / wrong)
            codes.bit_weight /= codes.bit_weight.mean()
    return codes


def identify(docs: DataFrame, codes: Codes) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row of ``docs``, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0; so is everything if nothing was
    learned. Repeated rows get equal values; extra columns are left out.
    """
    letters = _letters()

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(text: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in text]
        if not codes.langs or not texts:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "ambiguous": True})
        margin, has = margins(codes.table, texts, letters)
        which, score, unsure = decode(codes, margin)
        return pd.DataFrame({"lang_pred": np.where(has, np.array(codes.langs, dtype=object)[which], UNKNOWN), "score": np.where(has, score, 0.0), "ambiguous": unsure | ~has})

    return docs.select("doc_id", run("text").alias("p")).select("doc_id", "p.*")


def predicted(docs: DataFrame) -> DataFrame:
    """Trains on the rows that are not held out and identifies all: doc_id, held_out, lang_pred, score, ambiguous.

    Texts are used whole, however long. A null id is held out by an empty text's checksum. Languages whose losses tie go to the
    first by name. An empty table gives no rows; extra columns are left out. ``identify`` tells what has no language.
    """
    codes = train(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text"))
    got = identify(docs.select("doc_id", "text"), codes)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
