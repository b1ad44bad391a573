"""Each stage of the pipeline against a plain version, on the smallest tables."""

import math
from collections import Counter

import corpus_pipeline
from duelbook.llm import mixing, toxicity
from duelbook.llm.common import stored

from .test_operators import brute_classes, brute_hits

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, FOLDER), "test")
        after = docs.collect()
        ids = {r["doc_id"] for r in after}
        if name != "mixing":
            assert docs.columns == columns
        if name == "toxicity":
            judged = toxicity.scored(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{FOLDER}/labels.parquet"))
            assert ids == {r["doc_id"] for r in judged.collect() if not r["is_toxic"]} and 0 < len(ids) < len(before)
        if name == "mixing":
            taken = Counter()
            for r in after:
                taken[r["source"]] += r["taken"]
            assert all(abs(taken[r["source"]] - r["target"]) <= 0.5 for r in after) and math.isclose(sum(taken.values()), sum(r["size"] for r in after), abs_tol=len(taken))
        if name == "near_duplicates":
            assert ids == {min(before[i]["doc_id"] for i in c) for c in brute_classes([(r["doc_id"], r["text"]) for r in before])}
        if name == "decontamination":
            assert ids == {r["doc_id"] for r in before if not brute_hits(r["text"], bench)[1]}
        if name in ("secrets", "mixing"):
            assert len(after) == len(before)
        if name == "secrets":
            assert not any('token = "' in r["text"] and '[REDACTED]' not in r["text"] for r in after)
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, after))


def test_awkward_table(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns in every stage; then an empty table."""
    long = " ".join(f"w{i}" for i in range(9000))
    rows = [(1, None), (1, ""), (1, None), (None, "some words here"), (None, "some words here"), (2, long), (3, long + " x"), (4, "!!! ..."), (5, "password = 'Xk3!pq9Zt0vB'"), (6, "one two"), (6, "one two"), (6, "three four")]
    names = ["_row", "_p", "_spans", "_gone", "_cut", "_at", "_c", "row", "node", "comp", "key", "size", "src", "taken", "value", "start", "end", "block", "n", "k1", "sig"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{x} long" for x in names)
    docs = spark.createDataFrame([(k, t, "en", None, len(t or ""), *range(len(names))) for k, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES:
        before = Counter((r["doc_id"], r["text"]) for r in docs.collect())
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        got = stored(stage(spark, docs, FOLDER), "test-awkward")
        after = got.collect()
        if name == "mixing":
            assert Counter(r["doc_id"] for r in after) == Counter(k for k, _ in before.elements())
            break
        assert got.columns == docs.columns and all(tuple(r)[5:] == tuple(range(len(names))) for r in after)
        now = Counter((r["doc_id"], r["text"]) for r in after)
        if name == "near_duplicates":
            # Wordless rows stay, repeated ones too; of words the least doc_id's row, once.
            gone = Counter({(None, "some words here"): 1, (3, long + " x"): 1, (6, "one two"): 1})
            assert before - now == gone and not now - before
        elif name == "secrets":
            assert (5, "password = '[REDACTED]'") in now or now == before
        else:
            assert now == before
        docs = got
    assert mixing.mix(docs.limit(0)).count() == 0
