"""Merkle manifest, source divergence audit and near-duplicate vectors against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.llm import common, divergence, itq, merkle

LOW = str.maketrans(common.UPPER, common.LOWER)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, n long, key string, pos long, leaf string, node long, value long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "gamma", "der", "élan", "über", "rio", "THE", "of", "x1y", "日本"]
    out = []
    for i in range(90):
        text = " ".join(rng.choice(vocab) + rng.choice(["", "", "\n", ","]) for _ in range(rng.randrange(1, 40)))
        # A hot source, a null and an empty one, sparse, negative and very large ids.
        doc_id = i if i < 60 else rng.choice([-(10**12), 10**17, 70_000]) + i
        out.append((doc_id, text, ["en", "de", None, ""][i % 4 if i % 5 else 0], ["s0", "s0", "s1", None, "", "é"][i % 6], len(text)))
    out += [(None, "no id\n", "en", "s0", 6), (None, None, None, "s0", None), (None, "", "en", "lonely", 0), (None, "no id\n", "en", "s0", 6)]
    out += [out[0], out[0], (0, "same id\nother text", "en", "s0", 3), (12, None, None, "s0", None)]
    out.append((1000, "long text\n" * 20_000, "en", "s1", 200_000))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "k", 2, "l", 3, 4) for r in rows], SCHEMA)  # extra columns with names that operators use


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Levels of a list of nodes, up to one."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, leaves = {}, {}
    for s in order:
        leaves[s] = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = tree([leaf(*r) for r in leaves[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, r in enumerate(leaves[s]):
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf(r[0], r[1].replace("\n", "") if struck and r[1] is not None else r[1], *r[2:])
            seen = ""
            for levels, place in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    left, right = level[place - place % 3 : place], level[place + 1 : place - place % 3 + 3]
                    seen += "".join(left + right)
                    now = h(*left, now, *right)
                    place //= 3
            out.append((r[0], leaf(*r), trees[s][-1][0], top[-1][0], h(seen), now, now == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("step", [7, 2])
def test_manifest(rows, docs, monkeypatch, step):
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "SLOTS", 3**step)
    got = Counter(tuple(r) for r in merkle.tamper_check(docs).collect())
    want = plain_manifest(rows)
    assert got == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_proofs(rows, docs):
    """Each proof leads from its leaf to the root, and places in a source are 0 to its number of rows less one."""
    got = merkle.manifest(docs, ("key", "text")).withColumn("ok", merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).collect()
    assert len(got) == len(rows) and all(r["ok"] and r["key"] == "k" for r in got)
    assert Counter(r["text"] for r in got) == Counter(r[1] for r in rows)
    places = defaultdict(list)
    for r in got:
        places[r["source"]].append(r["leaf_index"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())


def test_manifest_small(spark, docs):
    assert merkle.tamper_check(docs.limit(0)).collect() == []
    one = merkle.tamper_check(spark.createDataFrame([(5, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["folded_root"] == leaf(5, None, None, None, None)
    assert one[0]["proof_sha256"] == h("")


def test_manifest_many_equal_ids(spark):
    """A third of all rows share one id, and dense ids fill bitmap containers."""
    df = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert Counter(tuple(r) for r in merkle.tamper_check(df).collect()) == plain_manifest(rows)


def test_containers():
    rng = np.random.default_rng(1)
    for n in (0, 1, 4095, 4096, 30_000, 65_536):
        lows = np.sort(rng.choice(65_536, n, replace=False))
        data = merkle.pack(lows)
        assert np.array_equal(merkle.unpack(data), lows) and len(data) <= 8192
        asked = rng.integers(0, 65_536, 500)
        assert np.array_equal(merkle.rank(data, asked), np.searchsorted(lows, asked))


def plain_audit(rows, least, top):
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    docs_of, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        docs_of[lang].update(set(words(text)))
        counts[lang, source].update(words(text))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs_of[lang].items() if n >= least]
        v = len(kept)
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (n[s] + 5 * v) for t in kept} for s in sources}
        big = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (big[t] + 5) // (sum(big.values()) + 5 * v) for t in kept}
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            out += [(lang, s, "pair", o.decode(), -x, i) for i, (x, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -x, i) for i, (x, t) in enumerate(terms[:top], 1)]
    return Counter(out)


@pytest.mark.parametrize(("least", "top", "tile", "block"), [(3, 50, 256, 4096), (3, 2, 2, 3), (1, 3, 1, 2), (10_000, 50, 256, 4096)])
def test_audit(rows, docs, monkeypatch, least, top, tile, block):
    monkeypatch.setattr(divergence, "SOURCE_TILE", tile)
    monkeypatch.setattr(divergence, "TERM_BLOCK", block)
    assert Counter(tuple(r) for r in divergence.audit(docs, least_docs=least, top=top).collect()) == plain_audit(rows, least, top)


def test_audit_equal_values(spark):
    """More terms of one value than ranks: the first in UTF-8 order are listed."""
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)]
    rows = [(1, " ".join(names), "en", "a", 1), (2, "zz " * 400, "en", "b", 1), (3, "", "en", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(tuple(r) for r in divergence.audit(df, least_docs=1).collect()) == plain_audit(rows, 1, 50)


def test_audit_empty(docs):
    assert divergence.audit(docs.limit(0)).collect() == []


def test_shares_are_exact(spark):
    df = spark.sql("SELECT 9000000000000L AS c, 70000000000001L AS n, 12345678L AS v").select(divergence.share("c", "n", "v").alias("p"))
    assert df.first()["p"] == 1 + 10**9 * (9000000000000 + 5) // (70000000000001 + 5 * 12345678)


def vectors(n_lone, groups, dims=32, seed=1):
    """(vec_id, vector, label): vectors alone, and groups around a centre with cosines about the threshold."""
    rng = np.random.default_rng(seed)
    out, at = [], 0
    for label, count, spread in [(0, n_lone, None), *groups]:
        centre = rng.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for _ in range(count):
            v = rng.standard_normal(dims)
            v = v / np.linalg.norm(v) if spread is None else centre + spread * v / np.linalg.norm(v)
            out.append((at, [float(np.float32(x)) for x in v], label if label is not None else int(rng.integers(0, 3))))
            at += 1
    return out


def plain_links(rows):
    usable = [i for i, r in enumerate(rows) if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links = defaultdict(set)
    by = defaultdict(list)
    for i in usable:
        by[rows[i][2], len(rows[i][1])].append(i)
    for own in by.values():
        x = np.array([rows[i][1] for i in own], dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= 0.98), strict=True):
            if a != b:
                links[own[a]].add(own[b])
    return links


def plain_components(rows, links):
    comp, seen = {}, set()
    for i in range(len(rows)):
        if i not in seen:
            todo, own = [i], []
            seen.add(i)
            while todo:
                k = todo.pop()
                own.append(k)
                for j in links[k] - seen:
                    seen.add(j)
                    todo.append(j)
            ids = [rows[k][0] for k in own if rows[k][0] is not None]
            for k in own:
                comp[k] = min(ids) if ids else None
    return comp


VECTORS = "vec_id long, embedding array<float>, label int, node long, n long, bucket string"


def test_vectors_find_links(spark):
    rows = vectors(600, [(1, 150, 0.1), (1, 40, 0.12), (2, 700, 0.09), (2, 30, 0.14)])
    got = {r["vec_id"]: r for r in itq.near_duplicates(spark.createDataFrame([(*r, 1, 2, "b") for r in rows], VECTORS)).collect()}
    links = plain_links(rows)
    found, true = sum(r["n_links"] for r in got.values()), sum(map(len, links.values()))
    assert len(got) == len(rows) and 0.97 * true <= found <= true
    assert all(got[i]["n_links"] <= len(links[i]) for i in range(len(rows)))
    comp = plain_components(rows, links)
    assert np.mean([got[i]["component_id"] == comp[i] for i in range(len(rows))]) >= 0.98
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_vectors_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 8)
    near = vectors(0, [(1, 30, 0.02)], dims=8)
    rows = near + [(i, near[0][1], 1) for i in range(100, 140)]  # copies
    rows += [(200, near[0][1], 2), (201, near[0][1], None), (202, None, 1), (203, [0.0] * 8, 1), (204, [], 1), (205, [1.0, None] + [0.0] * 6, 1), (206, [math.nan] * 8, 1), (207, [math.inf] * 8, 1)]
    rows += [(None, near[3][1], 1), (None, [-1.0] * 8, 1), (7, [-1.0] * 8, 1), (7, [-1.0] * 8, 1), (208, [1.0, 2.0], 1), (209, [2.0, 4.0], 1), (210, [5.0], 1), (211, [0.0, -0.0, 3.0], 5), (212, [-0.0, 0.0, 3.0], 5), (213, [1e-30] * 8, 9), (214, [1e30] * 8, 9)]
    got = Counter(tuple(r) for r in itq.near_duplicates(spark.createDataFrame([(*r, 1, 2, "b") for r in rows], VECTORS)).collect())
    links = plain_links(rows)
    comp = plain_components(rows, links)
    assert got == Counter((r[0], len(links[i]), comp[i], r[0] is not None and r[0] == comp[i]) for i, r in enumerate(rows))


def test_vectors_empty(spark):
    assert itq.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_index_scales(monkeypatch):
    """Substrings get longer with the number of vectors, and tables still find pairs at the threshold."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64)) @ np.diag(np.linspace(1, 0.3, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sizes = []
    for n in (1_000, 1_000_000):
        index = itq.fit(x, n)
        fresh = rng.standard_normal((1000, 64)) @ np.diag(np.linspace(1, 0.3, 64))
        fresh /= np.linalg.norm(fresh, axis=1, keepdims=True)
        (a, code), (b, other) = index.keys(fresh), index.keys(itq.neighbours(fresh, 0.98))
        assert (a == b).any(axis=1).mean() >= 0.95
        assert (np.bitwise_count(code ^ other).sum(axis=1) <= index.apart).mean() > 0.99
        assert 0.4 < np.unpackbits(code, axis=1).mean() < 0.6  # balanced
        sizes.append(index.bits)
    assert sizes[0] < sizes[1]
