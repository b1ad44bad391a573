"""Each training-data operator against a brute-force version or round trip, on a small awkward table."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelbook.llm import common, decontam, graph, langid, lm, media, mixing, neardup, secrets, substrings, toxicity, warc

LOW = str.maketrans(common.UPPER, common.LOWER)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = ["alpha", "Beta", "gamma", "der", "und", "élan", "über", "rio", "THE", "of", "x1", "und", "casa"]


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) + (rng.choice(["", "", ".", ","]) if i % 5 == 4 else "") for i in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage = sentence(rng, 14)
    out = []
    for i in range(60):
        text = sentence(rng, rng.randrange(1, 60))
        if i % 6 == 0:
            text += " Zz " + passage + " " + sentence(rng, 6)
        out.append([i, text, ["en", "de"][i % 2], ["s2", "s1", None, "s0"][i % 4], len(text)])
    base = sentence(rng, 80).split()
    for i in range(60, 72):  # near copies
        copy = list(base)
        for k in rng.sample(range(80), (i - 60) // 4):
            copy[k] = "q%d" % i
        out.append([i, " ".join(copy), "en", "s0", 1])
    out += [[72, None, None, None, None], [73, "", "en", "s1", 0], [74, "a b", "de", "s1", 3], [75, "A  b!", "de", "s1", 3], [76, "...  !", "en", None, 5], [None, "lonely row here", "en", "s1", 5]]
    out += [list(out[3]), list(out[61])]  # repeated rows
    out.append([77, "long " * 3000, "en", "s1", 15000])
    return [tuple(r) for r in out], passage


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, node long, size long, block long"
    return spark.createDataFrame([(*r, 7, "k", 1, 2, 3) for r in rows[0]], schema)  # extra columns with names that operators use


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_prefix_sums(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS v", "id % 3 AS g")
    got = {r["id"]: r["s"] for r in common.prefix_sums(df, [common.F.col("g"), common.F.col("id")], {"s": common.F.col("v")}, "t").collect()}
    total, want = 0, {}
    for i in sorted(range(100), key=lambda i: (i % 3, i)):
        want[i] = total
        total += i % 7
    assert got == want


def test_mix(rows, docs, empty):
    got = mixing.mix(docs).collect()
    size = lambda t: len(TOKEN.findall(t or ""))
    totals = Counter()
    for r in rows[0]:
        totals[r[3]] += size(r[1])
    order = sorted((s for s in totals if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, target = float(sum(totals.values())), set(order), {}
    while True:  # plain resharing
        shares = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if shares[s] > 3 * totals[s]]
        if not over:
            target |= shares
            break
        for s in over:
            target[s] = 3.0 * totals[s]
            left -= target[s]
            open_.discard(s)
    taken = Counter()
    for r in got:
        assert r["source_size"] == totals[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-12) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows[0]) and all(abs(taken[s] - target[s]) <= 0.5 for s in order)
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))
    assert mixing.mix(empty).count() == 0


def brute_hits(text, items, window=10):
    w = WORD.findall((text or "").translate(LOW))
    hit, found = set(), set()
    for name, item in items:
        iw = WORD.findall((item or "").translate(LOW))
        n = min(window, len(iw))
        for s in range(len(iw) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == iw[s : s + n]:
                    hit |= set(range(p, p + n))
                    found.add(name)
    return len(w), len(hit), len(found)


def test_decontamination(spark, rows, docs, empty):
    items = [(1, "nothing here " + rows[1] + " end"), (2, None), (3, ""), (4, "A b"), (4, "A b"), (5, "lonely row"), (6, rows[1][: len(rows[1]) // 2])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.contamination(docs, bench).collect())
    want = sorted((r[0] is None, r[0] or 0, *(h := brute_hits(r[1], items)), h[1] > 0) for r in rows[0])
    assert got == want
    kept = decontam.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert decontam.contamination(empty, bench).count() == 0 and decontam.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "apple x x pear x plum"), (2, "plum pear apple"), (3, "apple " + "x " * 30 + "pear plum")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "apple pear plum")], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.proximity_matches(docs, items, slop=8).collect()} == {1, 2}


def test_secrets(spark):
    rng = random.Random(1)
    text, true = [], set()
    for i in range(60):
        if i % 3 == 0:
            true.add(i)
            text.append(f'héllo {"x" * (i % 5)} token = "{rng.randbytes(20).hex()}" done')
        elif i % 3 == 1:
            text.append(f"card {rng.randrange(10**15, 10**16)} and mail abcdefgh12.xyz1234567890@host.org")
        else:
            text.append("plain words only")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)] + [(None, None), (99, "")], "doc_id long, text string")
    got = secrets.scan(docs).collect()
    assert {r["doc_id"] for r in got if r["is_secret"]} == true
    assert all(text[r["doc_id"]][r["start"] : r["end"]] == r["value"] for r in got)
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    assert len(clean) == 62 and clean[0] == 'héllo  token = "[REDACTED]" done' and clean[1] == text[1] and clean[None] is None
    assert secrets.findings(docs.limit(0)).count() == 0


def test_words_are_counted_before_they_meet_candidates(spark):
    """A frequent word meets the candidates' runs once, not once a place."""
    docs = spark.createDataFrame([(i, "token the lamp The x9 " * 50 + "lone") for i in range(2)], "doc_id long, text string")
    found = spark.createDataFrame([("theLamp9x",), ("the-lamp-1",), ("lone1234567",), ("the-lamp-1",)], "value string")
    got = secrets.dictionary_coverage(found, docs)
    assert {tuple(r) for r in got.collect()} == {("theLamp9x", 1, None), ("the-lamp-1", 2, 0.7), ("lone1234567", 1, None)}
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Generate explode(filter(split(" in line)
    above = [line.lstrip(" :+-") for line in reversed(plan[:at]) if line.lstrip(" :+-").startswith(("Aggregate", "Join"))]
    assert above[0].startswith("Aggregate")


def test_secrets_by_context(spark):
    hidden = ["Tr0ub4dor&3", "hunter2", "abcdefghijklmnopqrst", "correct zebra: battery staple", "it\\'s_s3cret", "pa.ss,wd", "S3cr3t(x)", "=q9Zx"]
    forms = ['password = "{}"', "pwd: {}, ok", 'api_key = "{}"', 'passwd="{}"', "'secret': '{}'", "password={}; next", "token := {}", "access-key: {}"]
    text = [f.format(v) + " and plain words" for f, v in zip(forms, hidden, strict=True)]
    rng = random.Random(2)
    text += [f"card {rng.randrange(10**15, 10**16)} or abcdefgh12.xyz1234567890@host.org" for _ in range(20)]
    text += ["the password: never"] * 3 + ["he said: nothing, author: unknown", "token:", 'secret = "" ']
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    got = secrets.scan(docs).collect()
    assert {(r["doc_id"], r["value"]) for r in got if r["is_secret"]} == set(enumerate(hidden))
    assert all(text[r["doc_id"]][r["start"] : r["end"]] == r["value"] for r in got)
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    want = [f.format("[REDACTED]") + " and plain words" for f in forms] + text[len(forms) :]
    assert [clean[i] for i in range(len(text))] == want


def planted(rng, n):
    """Texts of prose with secrets, or with what looks like one, and the true values."""
    import string

    prose = ["the report", "we saw", "then call", "for example", "it was", "see also", "please use", "all of", "remember that"]
    draw = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    letters = string.ascii_letters + string.digits
    texts, true = [], []
    for i in range(n):
        kind = i % 10
        value, form = None, ""
        if kind == 0:
            value, form = draw("0123456789abcdef", 40), 'token = "{}"'
        elif kind == 1:
            value, form = "AKIA" + draw(string.ascii_uppercase + string.digits, 16), "key {} used"
        elif kind == 2:
            value, form = "ghp_" + draw(letters, 36), "with {} in it"
        elif kind == 3:
            value, form = draw(letters + "!#$%", 14), "password: {}"
        elif kind == 4:
            value, form = draw(letters, 24), "the api_key='{}' is"
        elif kind == 5:
            form = f"{rng.choice(['anna', 'bob', 'carl'])}{rng.randrange(1900, 2030)}@{draw('abcdefgh', 6)}.org"
        elif kind == 6:
            form = f"https://www.{draw('abcdefgh', 7)}.com/{draw('xyz', 3)}/page{rng.randrange(1000)}"
        elif kind == 7:
            form = f"on 20{rng.randrange(10, 30)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)} number {rng.randrange(10**11, 10**12)}"
        elif kind == 8:
            form = rng.choice(["myLongVariable", "theOtherFunction", "readTheFileNow", "anotherClassName2"]) + " and /usr/share/doc/python3/readme"
        else:
            form = "the password: unknown"
        texts.append(f"{rng.choice(prose)} {form.replace('{}', value or '')} {rng.choice(prose)} {i}")
        true.append(value)
    return texts, true


def test_secrets_recall_and_precision(spark):
    """Planted secrets of five kinds among five kinds of others: at least 0.9 of both."""
    texts, true = planted(random.Random(8), 400)
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, row long, value string, _row string")
    got = secrets.scan(docs).filter("is_secret").collect()
    caught = {(r["doc_id"], r["value"]) for r in got}
    want = {(i, v) for i, v in enumerate(true) if v}
    assert len(caught & want) >= 0.9 * len(want) and len(caught & want) >= 0.9 * len(caught), (len(caught), len(want), len(caught & want))
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns and {(r["row"], r["value"], r["_row"]) for r in clean.collect()} == {(1, "x", "y")}


def test_secret_candidates(spark):
    """Spans and surroundings against a plain search with the same pattern; one very long text, repeated rows, nulls."""
    import regex

    texts = planted(random.Random(3), 60)[0]
    texts += [" ".join(texts) * 40, "", None, texts[0], 'token="a\\"b" pwd=\u00e9\u00e8 secret : x', "A1b2C3d4E5==", "endsWith12."]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    pattern = regex.compile(secrets.CANDIDATE, regex.ASCII)
    want = Counter()
    for i, t in [*enumerate(texts), (0, texts[0])]:
        spans = [m.span() for m in pattern.finditer(t or "")]
        for k, (a, b) in enumerate(spans):
            last, after = spans[k - 1][1] if k else 0, spans[k + 1][0] if k + 1 < len(spans) else len(t)
            want[i, a, b, t[a:b], t[last:a][-secrets.CONTEXT :], t[b:after][: secrets.CONTEXT]] += 1
    got = Counter((r["doc_id"], r["start"], r["end"], r["value"], r["before"], r["after"]) for r in secrets.candidates(docs).collect())
    assert got == want and sum(want.values()) > 1500


def test_lm(rows, docs, empty, monkeypatch):
    """All columns against a plain model: counts, buckets, EM and scores."""
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 250)
    monkeypatch.setattr(lm, "RANGE_BYTES", 3000)
    got = lm.scored(docs).collect()
    train = lambda k: zlib.crc32(str("" if k is None else k).encode()) % 7 != 2
    gone = {r[0] for r in docs.filter(lm.deleted(common.F.col("doc_id"))).select("doc_id").collect()}
    assert gone and all(train(k) for k in gone)
    texts = [(k, TOKEN.findall((t or "").translate(LOW)) + ["\n"]) for k, t, *_ in rows[0]]

    def model(keep):
        """Counts of words, pairs and triples; a text's start stands before its first word and has no triple."""
        c = [Counter(), Counter(), Counter()]
        n_texts = 0
        for k, ws in texts:
            if keep(k):
                n_texts += 1
                c[0].update(ws)
                c[1].update(zip([None, *ws], ws, strict=False))
                c[2].update(zip([None, *ws], ws, ws[1:], strict=False))
        return c, sum(c[0].values()), n_texts

    def parts(m, ws):
        c, n, n_texts = m
        for i, w in enumerate(ws):
            v = ws[i - 1] if i else None
            one = c[0][v] if i else n_texts
            two = c[1][(ws[i - 2] if i > 1 else None, v)] if i else 0
            bucket = 31 + min(31, int(math.log2(two)) + 1) if two else min(31, int(math.log2(one)) + 1) if one else 0
            three = c[2][(ws[i - 2] if i > 1 else None, v, w)] if two else 0
            yield bucket, (c[0][w] / n, c[1][(v, w)] / max(one, 1), three / max(two, 1))

    all_, kept = model(train), model(lambda k: train(k) and k not in gone)
    n, v = all_[1], len(all_[0][0])
    held = [x for k, ws in texts if k in gone for x in parts(kept, ws)]
    weights, before = {}, None
    for _ in range(lm.EM_ROUNDS):
        likelihood, sums = 0.0, defaultdict(lambda: np.zeros(4))
        for b, f in held:
            share = np.array(weights.get(b, lm._start(b))) * np.array([1 / (v + 1), *f])
            likelihood += math.log(share.sum())
            sums[b] += share / share.sum()
        for b, g in sums.items():
            g = np.maximum(g / g.sum(), [1e-6, 1e-6, 0, 0])
            weights[b] = g / g.sum()
        if before is not None and likelihood - before <= lm.EM_GAIN * abs(before):
            break
        before = likelihood
    table = lm.filled(weights)
    score = lambda ws: sum(math.log10(table[b] @ np.array([1 / (v + 1), *f])) for b, f in parts(all_, ws))
    base = lambda ws: sum(math.log10((all_[0][0][w] + 1) / (n + v + 1)) for w in ws)
    want = sorted((k is None, k or 0, len(ws), sum(all_[0][0][w] > 0 for w in ws), round(base(ws), 6), round(score(ws), 6)) for k, ws in texts)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(r["held_out"] != train(r["doc_id"]) for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm.scored(empty).count() == 0


def test_lm_pieces():
    values = np.array([0, 1, 255, 256, 2**40, 2**63], dtype=np.uint64)
    assert (lm.unpack(lm.pack(values), 6) == values).all() and len(lm.pack(np.zeros(5, np.uint64))) == 1
    assert lm.buckets(np.array([0, 1, 2, 3, 4, 1024, 9]), np.array([0, 0, 0, 0, 0, 0, 2])).tolist() == [0, 1, 2, 2, 3, 11, 33]


def brute_units(texts, unit):
    """{(doc_id, text): spans to cut}: of equal units (case and white space aside) the first by doc_id stays; null doc_ids come first."""
    first, out = {}, {}
    for k, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        at = 0
        for piece in re.split(r"(\n)" if unit == "line" else r"(\n(?:[ \t\r\x0b\f]*\n)+)", t or "")[0::2]:
            end = re.compile(r"\n" if unit == "line" else r"\n(?:[ \t\r\x0b\f]*\n)+").match(t or "", at + len(piece))
            span = (at, end.end() if end else at + len(piece))
            norm = " ".join(piece.lower().split())
            if norm and first.setdefault(norm, (k, at)) != (k, at):
                out.setdefault((k, t), []).append(span)
            at = span[1]
    return out


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_substrings(spark, rows, empty, unit):
    rng = random.Random(11)
    lines = [sentence(rng, n) for n in (1, 2, 4, 9, 30, 60)] + ["", "  ", "\t", "All rights reserved.", "\u4eca\u5929\u5929\u6c14"]
    table = [(r[0], r[1]) for r in rows[0]] + [(100 + i, "\n".join([f"own {i} line", *rng.choices([*lines, lines[3].upper() + "  "], k=rng.randrange(1, 9)), f"end {i}"])) for i in range(60)]
    table += [(2**60 + 1, "big id\n" + lines[4]), (2**60, "big id too\n\n" + lines[4]), (None, "none\n" + lines[4]), (200, "\n".join(f"l{i % 900}" for i in range(3000)))]
    docs = spark.createDataFrame([(k, t, 1, 2, 3, "x", "y") for k, t in table], "doc_id long, text string, row long, at long, n_removed long, _row string, _gone string")
    got = substrings.deduplicated(docs, unit).collect()
    want = brute_units(set(table), unit)
    assert len(got) == len(table) and sum(r["n_removed"] > 0 for r in got) > 5
    for r in got:
        spans = [(s["start"], s["end"]) for s in r["removed"]]
        t = r["text"]
        assert spans == want.get((r["doc_id"], t), []) and (r["_row"], r["_gone"], r["row"]) == ("x", "y", 1)
        cut = "".join(t[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(t)], strict=True)) if t is not None else None
        assert r["clean_text"] == cut
    assert substrings.repeats(empty, unit).count() == 0


def test_secret_features_count_words_once(spark):
    """The join with the coverage of candidates, which reads it three times, reads stored rows: no word is split off in its plan."""
    docs = spark.createDataFrame([(i, f"horse token = 'horse{i}Battery9' horse") for i in range(4)], "doc_id long, text string")
    features = secrets.with_features(common.stored(secrets.candidates(docs), "t"), docs)
    plan = features._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    assert [round(r["coverage"], 6) for r in features.orderBy("doc_id").collect()] == [round(5 / 14, 6)] * 4


def test_substrings_min_words(spark):
    docs = spark.createDataFrame([(1, "one two\nthree four five"), (2, "One  two\nthree four five\nsix")], "doc_id long, text string")
    for least, want in ((1, "six"), (3, "One  two\nsix")):
        assert {r["doc_id"]: r["clean_text"] for r in substrings.deduplicated(docs, min_words=least).collect()}[2] == want


def test_media(rows, docs, empty):
    for n in (0, 1, 64, 146, 147, 148, 162, 163, 346, 347, 16353, 16354, 16355, 16354 * 5 + 9):
        data = random.Random(n).randbytes(n)
        got = media.demux(media.mux(data))
        assert got["payload"] == data and got["continuity_errors"] == 0 and got["stamps"][0][1:] == (0, True)
        assert [s[0] for s in got["stamps"]] == [i * media.TICKS for i in range(max(1, -(-n // media.PES_DATA)))]
    broken = bytearray(media.mux(bytes(5000)))
    del broken[188 * 5 : 188 * 6]
    with pytest.raises(ValueError, match="PES"):
        media.demux(bytes(broken))
    broken = bytearray(media.mux(bytes(5000)))
    broken[188 * 6 + 3] ^= 5  # another counter: a break before it and one after it
    assert media.demux(bytes(broken))["continuity_errors"] == 2
    tables = bytearray(media.mux(bytes(5000)))
    tables[20] ^= 1  # a table whose CRC does not hold is none
    with pytest.raises(IndexError):
        media.demux(bytes(tables))
    got = media.read_back(media.media_table(docs)).collect()
    assert len(got) == len(rows[0])
    texts = {k: t for k, t, *_ in rows[0]}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["n_bytes"] == len(data) and r["payload_sha256"] == media.hashlib.sha256(media.padded(data)).hexdigest() and r["tail_crc32"] == zlib.crc32(media.padded(data)[-64:])
        counts = Counter(media.padded(data))
        n = sum(counts.values())
        assert f"entropy={-sum(c / n * math.log2(c / n) for c in counts.values()) + 0.0:.4f};zeros={counts[0] / n:.4f}" in r["feature"]
    assert media.read_back(media.media_table(empty)).count() == 0


def test_toxicity(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = [rng.choice(VOCAB) for _ in range(rng.randrange(8, 40))] + (["vile", "rotten"] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i < 300:
            labels.append((i, 1, int(bad)))
    labels += [(0, None, None), (None, 1, 1), (5000, 0, 1), labels[4]]
    docs = spark.createDataFrame([*rows, (None, None), (900, ""), rows[1]], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored(docs, marks).collect()}
    held = [i for i in range(300, 400)]
    assert sum(got[i]["is_toxic"] == (i % 4 == 0) for i in held) >= 97
    assert not got[None]["is_toxic"] and not got[900]["is_toxic"]
    kept = toxicity.without_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == 403 - sum(r["is_toxic"] for k, r in got.items() if k is not None and k != 900)
    assert not any(r["is_toxic"] for r in toxicity.scored(docs, marks.limit(0)).collect()) and toxicity.scored(docs.limit(0), marks).count() == 0


def test_toxicity_chain():
    """The chain's weights against plain gradient descent of the same loss on dense matrices; folds, log-odds and threshold as told."""
    rng = np.random.default_rng(6)
    n, d = 90, 7
    x = (rng.random((n, d)) < 0.4).astype(float)
    y = {"low": (x[:, 0] + rng.random(n) > 0.9).astype(float), "bad": (x[:, 1] + x[:, 0] + rng.random(n) > 1.4).astype(float)}
    row, col = np.nonzero(x)
    fold = np.arange(n) % toxicity.FOLDS
    chain = toxicity.fit_chain(row, col, n, np.arange(d), y, fold)

    def plain(a, b):
        w = np.zeros(a.shape[1])
        ridge = np.full(a.shape[1], toxicity.L2)
        ridge[-1] = 1e-6
        for _ in range(60):
            p = 1 / (1 + np.exp(-a @ w))
            w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (p - b) + ridge * w)
        return w

    earlier = []
    for k, name in enumerate(y):
        a = np.column_stack([x, *earlier, np.ones(n)])
        assert np.allclose(plain(a, y[name]), chain.weights[k], atol=2e-3)
        out = np.zeros(n)
        for f in range(toxicity.FOLDS):
            out[fold == f] = a[fold == f] @ plain(a[fold != f], y[name][fold != f])
        p = np.clip(1 / (1 + np.exp(-out)), 1e-4, 1 - 1e-4)
        earlier.append(np.log(p / (1 - p)))
    f1 = lambda t: 2 * y["bad"][p >= t].sum() / ((p >= t).sum() + y["bad"].sum())
    assert f1(chain.threshold) == max(f1(t) for t in p)
    tokens = [np.flatnonzero(r) for r in x] + [np.zeros(0, np.int64)]
    got = toxicity.predict(chain, tokens)
    first = 1 / (1 + np.exp(-np.column_stack([x, np.ones(n)]) @ chain.weights[0]))
    q = np.clip(first, 1e-4, 1 - 1e-4)
    second = 1 / (1 + np.exp(-np.column_stack([x, np.log(q / (1 - q)), np.ones(n)]) @ chain.weights[1]))
    assert np.allclose(got[:-1], np.stack([first, second], axis=1)) and (got[-1] == 0).all()


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    seen = []
    fit = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda row, col, n, *a: (seen.append(n), fit(row, col, n, *a))[1])
    docs = spark.createDataFrame([(i, f"word{i % 3} other text {i % 2}") for i in range(40)] + [(1, f"word variant {i}") for i in range(300)] + [(2, "the same")] * 300, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    toxicity.train(docs, marks, max_train=40)
    toxicity.train(docs, marks)
    assert seen == [40, 341]


def brute_classes(rows):
    bag = {}
    for i, r in enumerate(rows):
        w = WORD.findall((r[1] or "").translate(LOW))
        bag[i] = Counter(zip(*[w[j:] for j in range(5)])) if len(w) > 4 else Counter([tuple(w)] if w else [])
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both, all_ = sum((bag[a] & bag[b]).values()), sum((bag[a] | bag[b]).values())
        if both and both / all_ >= 0.8:
            up[find(b)] = find(a)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(i)
    return list(out.values())


def test_near_duplicates(rows, docs, empty):
    got = neardup.near_duplicates(docs).collect()
    want = Counter()
    for members in brute_classes(rows[0]):
        ids = [rows[0][i][0] for i in members]
        for k in ids:
            want[(k, min((x for x in ids if x is not None), default=None), len(ids))] += 1
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    assert sum(not r["is_duplicate"] for r in got) == len(brute_classes(rows[0]))  # one row of each class
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(brute_classes(rows[0])) and neardup.near_duplicates(empty).count() == 0


def test_one_row_of_a_class_is_no_duplicate(spark):
    """Repeated rows and null ids: the least id's first row is kept, null comes last."""
    text = "one two three four five six"
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (None, "all alone here with these words"), (None, "all alone here with these words"), (4, ""), (4, "")], "doc_id long, text string")
    got = neardup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["class_size"], r["is_duplicate"]) for r in got) == Counter({(3, 3, False): 1, (3, 3, True): 1, (None, 3, True): 1, (None, 2, False): 1, (None, 2, True): 1, (4, 1, False): 2})


def test_draws_never_vanish():
    """A sample's threshold is right for tables of any size: the expected number of drawn rows is the one asked for."""
    for n in (10**4, 10**11, 10**15):
        edge = common.below(12_000 / n)
        assert edge is None if n <= 12_000 else abs((edge + 2**63) / 2**64 * n - 12_000) < 1
    assert common.below(0.0) == -(2**63)


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(2)
    a = np.sort(rng.integers(1, 2**62, 60)).astype(np.uint64)
    one, two = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    text, both = np.repeat([0, 1], 60), np.concatenate([a, a])
    sig = neardup.bag_minhash(text, both, np.concatenate([one, two]), 2, 4096)
    true = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / 4096)


def test_leftover_blocks(spark, monkeypatch):
    """A chain of near copies whose ends differ: stars alone would leave it apart."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(9)
    now, out = [f"w{rng.randrange(10**6)}" for _ in range(120)], []
    for i in range(40):
        out.append((i, " ".join(now)))
        now = list(now)
        now[(i * 13) % 120] = f"n{i}"
        now[(i * 13 + 60) % 120] = f"m{i}"
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(out, "doc_id long, text string")).collect()}
    want = {k: min(out[i][0] for i in c) for c in brute_classes(out) for k in (out[i][0] for i in c)}
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 600)
    pages = [(i, f"http://www.Host{i % 5}.example.com:80/p{i % 13}?q={i}#f", ["<p>ä</p>", "same", "", f"own {i}"][i % 4]) for i in range(80)]
    pages += [(80, None, None), (81, "not a url\nat all", "same"), (82, "http://[bad", "x"), (None, "http://h/", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    first = {}
    for k, _, h in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(h or "", k)
    want = {k: (len((h or "").encode()), warc.digest((h or "").encode()), "response" if first[h or ""] == k else "revisit", None if first[h or ""] == k else first[h or ""]) for k, _, h in pages}
    assert {r["page_id"]: tuple(r)[1:] for r in warc.archived(df).collect()} == want
    archives = warc.write_archives(df)
    index = warc.capture_index(archives)
    keys = spark.createDataFrame([(warc.url_key(pages[i][1]),) for i in range(0, 80, 10)] + [("zz)missing",), ("",)], "key string")
    near = {tuple(r) for r in warc.lookup(index, keys).collect()}
    monkeypatch.setattr(warc, "MOST_DIRECTORY_ROWS", 0)
    assert {tuple(r) for r in warc.lookup(index, keys).collect()} == near and len(near) == 8
    assert {r["page_id"] for r in warc.read_ranges(archives, warc.lookup(index, keys)).collect()} == set(range(0, 80, 10))
    assert warc.archived(df.limit(0)).count() == 0
    twice = df.unionByName(df).withColumns({"archive": common.F.lit("x"), "sha": common.F.lit(1), "first": common.F.lit(2)})
    for most in (warc.MOST_BROADCAST_DIGESTS, 0):  # by broadcast, and by the way for more digests
        monkeypatch.setattr(warc, "MOST_BROADCAST_DIGESTS", most)
        got = Counter((r["page_id"], *tuple(r)[1:]) for r in warc.archived(twice).collect())
        assert got == {(k, *v): 2 for k, v in want.items()}


def scanned_rows(df):
    """Rows that the scans of a frame give out when it is run, by a column of theirs."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            out.append(("data" in node.output().mkString(","), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(n for data, n in out if data)


def test_warc_range_reads(spark, monkeypatch):
    """A look-up of one key reads one block and one segment, of many."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 600)
    df = spark.createDataFrame([(i, f"http://h{i % 9}.org/p{i}", f"own text {i}") for i in range(90)], "page_id long, url string, html string").coalesce(2)
    archives = warc.write_archives(df)
    index = warc.capture_index(archives)
    found = warc.lookup(index, spark.createDataFrame([(warc.url_key("http://h4.org/p40"),)], "key string"))
    assert index.count() > 15 and scanned_rows(found) == 1
    got = warc.read_ranges(archives, found)
    assert archives.count() > 30 and scanned_rows(got) == 1
    assert [(r["page_id"], bytes(r["payload"])) for r in got.collect()] == [(40, b"own text 40")]


def test_language(spark):
    rng = random.Random(4)
    words = {"aa": ["kala", "lama", "naka"], "bb": ["str", "grüß", "platz"], "cc": ["ción", "lleno", "que"], "dd": ["thing", "the", "wha"], "ee": ["ыва", "про", "олд"], "ff": ["zq", "xz", "qzx"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(12)), x) for i in range(300) for x in [list(words)[i % 6]]]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 !", "aa"), (902, "", None), (None, "the thing", None), rows[0]], "doc_id long, text string, lang string")
    docs = docs.select("*", F.lit("x").alias("held"), F.lit(1).alias("n"), F.lit(2).alias("bucket"), F.lit("y").alias("draw"))  # extra columns
    got = langid.predicted(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r["lang_pred"] == truth[r["doc_id"]] and 0 < r["score"] <= 1 for r in got if r["doc_id"] in truth)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (900, 901, 902))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert langid.predicted(docs.limit(0)).count() == 0
    code = langid.codewords(6)
    assert len({tuple(c) for c in code}) == 6 and langid.codewords(300).shape[0] == 300
    # Tables, weights and decoding against a plain version.
    known = [(t, x) for i, t, x in [*rows, rows[0]] if zlib.crc32(str(i).encode()) % 4 != 2]
    codes = langid.train(spark.createDataFrame(known, "text string, lang string"))

    def plain_grams(t):
        t = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
        t = re.sub(" +", " ", t)
        for size in langid.GRAMS:
            for i in range(len(t) - size + 1):
                h = size
                for c in t[i : i + size]:
                    h = (h ^ ord(c)) * 0x01000193 & 0xFFFFFFFF
                yield (h ^ h >> 15) & (langid.BUCKETS - 1)

    seen = np.full((6, langid.BUCKETS), 0.5)
    for t, x in known:
        for g in plain_grams(t):
            seen[codes.langs.index(x), g] += 1
    share = seen / seen.sum(axis=1, keepdims=True)
    table = np.stack([np.log(share[c > 0].mean(axis=0)) - np.log(share[c < 0].mean(axis=0)) for c in codes.code.T])
    assert np.allclose(table, codes.table)
    # Bit weights: error rates on the quarter of the texts that the tried tables were not counted on.
    held = {r["text"]: r["h"] for r in spark.createDataFrame(known, "text string, lang string").select("text", (F.pmod(F.xxhash64(F.lit("bits"), "text"), F.lit(4)) == 0).alias("h")).distinct().collect()}
    tried = np.full((6, langid.BUCKETS), 0.5)
    for t, x in known:
        if not held[t]:
            for g in plain_grams(t):
                tried[codes.langs.index(x), g] += 1
    part = tried / tried.sum(axis=1, keepdims=True)
    tried = np.stack([np.log(part[c > 0].mean(axis=0)) - np.log(part[c < 0].mean(axis=0)) for c in codes.code.T])
    wrong = np.mean([codes.code[codes.langs.index(x)] * tried[:, list(plain_grams(t))].sum(axis=1) <= 0 for t, x in known if held[t]], axis=0).clip(1e-3, 0.49)
    weight = np.log((1 - wrong) / wrong)
    assert np.allclose(codes.bit_weight, weight / weight.mean())
    assert langid.train(spark.createDataFrame(known, "text string, lang string"), max_langs=2).langs == sorted(x for x, _ in Counter(x for _, x in known).most_common(2))
    by_id = {r["doc_id"]: r for r in got}
    for i, t, _ in rows[:40]:
        g = list(plain_grams(t))
        margin = table[:, g].sum(axis=1) / math.sqrt(len(g))
        loss = np.array([sum(w * math.log(1 + math.exp(-c * m)) for w, c, m in zip(codes.bit_weight, word, margin, strict=True)) for word in codes.code])
        near = np.exp(loss.min() - loss)
        assert by_id[i]["lang_pred"] == codes.langs[int(loss.argmin())] and math.isclose(by_id[i]["score"], near.max() / near.sum(), rel_tol=1e-6)
