"""Toxicity by a classifier chain over word-presence features.

Categories are predicted one after the other by linear logistic models; each model also sees the
log-odds of the categories before it. In training these are out-of-fold predictions, so that a later
model learns from what an earlier one would say of texts it has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, sampled, stored, words

#: The chain, in order, with what makes a row of ``labels`` positive.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
#: The fit reads at most so many labelled document rows, drawn by a hash of their doc_id and text.
MAX_TRAIN = 12_000
MAX_FEATURES, MIN_DOCS, FOLDS, L2 = 4096, 3, 3, 0.2
CHUNK_TOKENS = 400_000


@dataclass
class Chain:
    names: list[str]
    vocab: np.ndarray  # sorted word hashes
    weights: list[np.ndarray]  # of category k: vocabulary, k earlier log-odds, constant
    threshold: float  # of the last category, from out-of-fold predictions


def token_hashes(text: str) -> Column:
    return F.transform(words(F.col(text)), lambda w: F.xxhash64(w))


def present(tokens: list[np.ndarray], vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature number) of the known words of each text, each once."""
    flat = np.concatenate([np.asarray(t, dtype=np.int64) for t in tokens]) if tokens else np.zeros(0, np.int64)
    if not len(flat) or not len(vocab):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    at = np.minimum(np.searchsorted(vocab, flat), len(vocab) - 1)
    known = vocab[at] == flat
    both = np.unique(text[known] * len(vocab) + at[known])
    return both // len(vocab), both % len(vocab)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class _Design:
    """Sparse presence features plus dense columns, as the two products a Newton step needs."""

    def __init__(self, row, col, n, d, dense):
        self.row, self.col, self.n, self.d, self.dense = row, col, n, d, dense

    def dot(self, w):
        return np.bincount(self.row, w[: self.d][self.col], self.n) + self.dense @ w[self.d :]

    def back(self, r):
        return np.concatenate([np.bincount(self.col, r[self.row], self.d), self.dense.T @ r])

    def take(self, keep):
        number = np.cumsum(keep) - 1
        inside = keep[self.row]
        return _Design(number[self.row[inside]], self.col[inside], int(keep.sum()), self.d, self.dense[keep])


def fit_logistic(x: _Design, y: np.ndarray, l2: float = L2, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression (the constant, last, is free) by Newton steps solved with conjugate gradients."""
    size = x.d + x.dense.shape[1]
    ridge = np.full(size, l2)
    ridge[-1] = 1e-6
    w = np.zeros(size)
    if not x.n:
        w[-1] = -35.0
        return w
    for _ in range(steps):
        p = _sigmoid(x.dot(w))
        g = x.back(p - y) + ridge * w
        h = np.maximum(p * (1 - p), 1e-6)
        step, r = np.zeros(size), -g
        q, rr = r.copy(), r @ r
        first = rr
        for _ in range(40):
            if rr <= 1e-4 * first or rr < 1e-12:
                break
            hq = x.back(h * x.dot(q)) + ridge * q
            a = rr / (q @ hq)
            step += a * q
            r -= a * hq
            rr, old = r @ r, rr
            q = r + rr / old * q
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on calling positive has the best F1; half way to the next lower prediction. 0.5 where nothing is positive."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    ends = np.append(p[order][1:] < p[order][:-1], True)  # ties go together
    at = int(np.argmax(np.where(ends, f1, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


def fit_chain(row, col, n: int, vocab: np.ndarray, y: dict[str, np.ndarray], fold: np.ndarray) -> Chain:
    """Trains each category on the features and the earlier categories' out-of-fold log-odds."""
    earlier, weights = [], []
    for name in y:
        x = _Design(row, col, n, len(vocab), np.stack([*earlier, np.ones(n)], axis=1))
        weights.append(fit_logistic(x, y[name]))
        out = np.zeros(n)
        for f in range(FOLDS):
            held = fold == f
            out[held] = x.take(held).dot(fit_logistic(x.take(~held), y[name][~held]))
        earlier.append(_logit(_sigmoid(out)))
    return Chain(list(y), vocab, weights, best_threshold(_sigmoid(out), y[name]))


def train(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN) -> Chain:
    """Fits the chain on a bounded sample of labelled documents; ``labels`` has doc_id and the label columns.

    Of repeated labels of a document, any positive one counts. Null labels are negative. Documents that repeat a doc_id
    with other texts are rows of their own; rows that repeat both count once.
    """
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(F.coalesce(F.expr(rule), F.lit(False)).cast("int")).alias(f"y_{k}") for k, rule in CATEGORIES.items()])
    n = marks.count()
    # Somewhat more than can be taken, so that the exact cut below sorts few rows.
    marks = F.broadcast(stored(marks.filter(sampled(1.2 * max_train / max(n, 1), F.lit("sample"), "doc_id")), "toxicity-marks"))  # about max_train rows of a few integers
    met = docs.select("doc_id", "text").join(marks, "doc_id").withColumn("row", row_key())
    chosen = stored(met.select("row").distinct().orderBy(F.xxhash64("row"), "row").limit(max_train), "toxicity-rows")
    sample = met.join(F.broadcast(chosen), "row", "left_semi").dropDuplicates(["row"])
    sample = stored(sample.select("row", *[f"y_{k}" for k in CATEGORIES], F.array_distinct(token_hashes("text")).alias("tokens")), "toxicity-sample")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{k}").alias(k) for k in CATEGORIES]).first()
    by_word = sample.select(F.explode("tokens").alias("word"), *[f"y_{k}" for k in CATEGORIES]).groupBy("word").agg(F.count(F.lit(1)).alias("df"), *[F.sum(f"y_{k}").alias(k) for k in CATEGORIES])
    # How far a category's share among the word's texts lies from its share among all, in standard errors.
    apart = [F.abs(F.col(k) - F.col("df") * ((totals[k] or 0) / max(totals["n"], 1))) / F.sqrt(F.col("df")) for k in CATEGORIES]
    chosen = by_word.filter(F.col("df") >= MIN_DOCS).orderBy(F.greatest(*apart).desc(), "word").limit(MAX_FEATURES)
    vocab = np.sort(np.array([r["word"] for r in chosen.select("word").collect()], dtype=np.int64))

    def features(batches):
        for batch in batches:
            row, col = present(list(batch["tokens"]), vocab)
            cut = np.searchsorted(row, np.arange(1, len(batch)))
            yield batch.drop(columns="tokens").assign(cols=np.split(col, cut) if len(batch) else [])

    # At most max_train rows.
    got = sample.mapInPandas(features, "row binary, " + "".join(f"y_{k} int, " for k in CATEGORIES) + "cols array<long>").toPandas() if totals["n"] else pd.DataFrame({"row": [], "cols": [], **{f"y_{k}": [] for k in CATEGORIES}})
    got = got.assign(row=got["row"].map(bytes)).sort_values("row", kind="stable").reset_index(drop=True)
    size = got["cols"].map(len).to_numpy(dtype=np.int64)
    row = np.repeat(np.arange(len(got)), size)
    col = np.concatenate(list(got["cols"])).astype(np.int64) if size.sum() else np.zeros(0, np.int64)
    fold = np.arange(len(got)) % FOLDS
    return fit_chain(row, col, len(got), vocab, {k: got[f"y_{k}"].to_numpy(dtype=float) for k in CATEGORIES}, fold)


def predict(chain: Chain, tokens: list[np.ndarray]) -> np.ndarray:
    """Probabilities (texts x categories), each category seeing those before it; 0 for texts without words."""
    n = len(tokens)
    row, col = present(tokens, chain.vocab)
    out, earlier = [], []
    for w in chain.weights:
        z = _Design(row, col, n, len(chain.vocab), np.stack([*earlier, np.ones(n)], axis=1)).dot(w)
        out.append(_sigmoid(z))
        earlier.append(_logit(out[-1]))
    return np.stack(out, axis=1) * (np.array([len(t) for t in tokens]) > 0)[:, None]


def probabilities(chain: Chain, text: str = "text") -> Column:
    """struct<category: double, ...> of a text column, in chunks of bounded size."""

    @F.pandas_udf(", ".join(f"{k} double" for k in chain.names))
    def run(tokens: pd.Series) -> pd.DataFrame:
        rows, out, at, size = list(tokens), [], 0, 0
        for i, r in enumerate(rows):
            if i > at and size + len(r) > CHUNK_TOKENS:
                out.append(predict(chain, rows[at:i]))
                at, size = i, 0
            size += len(r)
        out.append(predict(chain, rows[at:]) if rows[at:] else np.zeros((0, len(chain.names))))
        return pd.DataFrame(np.concatenate(out), columns=chain.names)

    return run(token_hashes(text))


def scored(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per document row: doc_id, p_<category> ..., is_toxic (last category at or above the threshold).

    Without a threshold, the one with the best F1 of the out-of-fold predictions is taken. Null and empty texts have
    probabilities 0. Unlabelled documents are scored like the others; with no labelled ones nothing is toxic.
    Repeated rows and ties get equal values. Extra columns are left out.
    """
    chain = train(docs, labels)
    got = docs.select("doc_id", probabilities(chain).alias("p"))
    return got.select("doc_id", *[F.col(f"p.{k}").alias(f"p_{k}") for k in chain.names], (F.col(f"p.{chain.names[-1]}") >= (chain.threshold if threshold is None else threshold)).alias("is_toxic"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that the chain does not reject.

    Null and empty texts stay; repeated rows go or stay together; columns of any name are carried through.
    """
    chain = train(docs, labels)
    (p,) = fresh(docs, "_p")
    return docs.withColumn(p, probabilities(chain)).filter(F.col(f"{p}.{chain.names[-1]}") < (chain.threshold if threshold is None else threshold)).drop(p)
