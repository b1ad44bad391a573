"""Secret scans with a random forest that removes false positives (DataFrame functions and Spark ML only).

Candidates are what stands after a key word with = or :, and key-like runs: ten characters or more with a digit or a change
from lower to upper case. The forest looks at their length, entropy, transitions between character classes, the share
covered by dictionary words of the corpus, path signs in and around them, and the words beside them. How far a
neighbouring word speaks for a secret is learned from the labelled findings, out of fold where those train the forest.

Labels are findings of which something else than the inputs tells what they are: the form that an issuer gives its tokens, an assignment to a
key word, the form of mail addresses, links, numbers and plain words.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, joined, maybe_broadcast, row_key, stored, words

CONTEXT = 60
#: Words that stand before credentials, and forms that issuers give to theirs. Fixed values.
KEY_WORDS = r"(?i)(token|password|passwd|pwd|secret|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential)"
KNOWN_FORM = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[sr]k_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)$"
#: A run of ten or more of these characters, with a digit or a capital after a small letter, that ends in a letter or digit or with base64's filling.
CHARS = r"A-Za-z0-9_+/\-.~!@#$%^&*"
RUN = rf"(?<![{CHARS}])(?=[{CHARS}]*?(?:[0-9]|[a-z][A-Z]))[{CHARS}]{{9,}}[A-Za-z0-9]={{0,2}}"
#: After a key word with = or :, all up to the closing quote, or up to a blank and the marks before it. The first
#: test of each is cheap, and fails nearly everywhere.
ASSIGNED = r"[\"']?\s{0,3}[=:]{1,2}>?\s{0,3}"
_AFTER = rf"(?<={KEY_WORDS}{ASSIGNED}%s)"
_QUOTED = rf"(?<=%s){_AFTER}(?=[^%s\n]*[^%s\s])[^%s\\\n]*+(?:\\.[^%s\\\n]*+)*+(?=%s)"
_BARE = r"""(?<=[=:>\s"'])(?<=[=:]>?\s{0,3}["']?)""" + _AFTER % "[\"']?" + r"""(?![=:>]+\s)[^\s"']\S*?(?=[.,;"']*(?:\s|$))"""
CANDIDATE = "|".join([*(_QUOTED % ((q,) * 7) for q in "\"'"), _BARE, RUN])
#: The forest reads at most so many labelled findings, drawn by a hash, half of each kind where there are enough.
MAX_TRAIN, TREES, DEPTH, SEED, FOLDS = 20_000, 40, 8, 17, 5
DICTIONARY_MIN = 3
MOST_BROADCAST_TERMS, MOST_BROADCAST_ROWS = 500_000, 500_000
#: Character classes (a lower, A upper, 9 digit, - other) that follow each other.
PAIRS = ("a9", "9a", "A9", "9A", "aA", "Aa", "aa", "AA", "99", "a-", "-a", "9-", "-9")
MOVES = [f"move_{i}" for i in range(len(PAIRS))]
#: What the forest gets; the last two are learned.
FEATURES = ["length", "entropy", "digits", *MOVES, "classes", "coverage", "slashes", "dots", "path_around", "word_before", "word_after"]
REDACTED = "[REDACTED]"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, row, start, end, value, before, after: every candidate with its character offsets and surroundings."""
    has = docs.select("doc_id", "text", row_key().alias("row")).filter(F.col("text").rlike(CANDIDATE))
    parts = has.select("doc_id", "row", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    # One pass over the gaps and candidates adds up where each begins.
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    step = lambda acc, i: F.struct(
        (acc["at"] + F.length(F.get("gaps", i)) + F.length(F.get("found", i))).alias("at"), F.array_append(acc["starts"], acc["at"] + F.length(F.get("gaps", i))).alias("starts")
    )
    starts = F.aggregate(F.sequence(F.lit(0), F.size("found") - 1), begin, step, lambda acc: acc["starts"])
    each = F.transform(
        "found",
        lambda v, i: F.struct(F.get("starts", i).alias("start"), v.alias("value"), F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after")),
    )
    out = parts.withColumn("starts", starts).select("doc_id", "row", F.explode(each).alias("c"))
    return out.select("doc_id", "row", "c.start", (F.col("c.start") + F.length("c.value")).alias("end"), "c.value", "c.before", "c.after")


def dictionary_coverage(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(value, n: rows of ``found`` with it, coverage): share of a candidate's characters in letter runs that the corpus uses as words.

    Words are counted over all documents before they meet the candidates' runs, so that meeting makes a row a word and not one a place of it.
    Stored: ``joined`` reads it three times, and each would be a plan of its own over all documents.
    """
    values = stored(found.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "secret-values")
    runs = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("term"))
    terms = stored(runs.select("term").distinct(), "secret-terms")
    # No run has other characters, or fewer.
    each = docs.select(F.explode(words(F.col("text"))).alias("term")).filter(F.col("term").rlike("^[a-z]{3,}$"))
    often = each.groupBy("term").count().filter(F.col("count") >= DICTIONARY_MIN)
    # An inner join with distinct terms: Spark would push a semi-join below the count.
    known = often.join(maybe_broadcast(terms, MOST_BROADCAST_TERMS), "term")
    share = runs.join(known.select("term"), "term").groupBy("value").agg((F.sum(F.length("term")) / F.max(F.length("value"))).alias("coverage"))
    return stored(values.join(share, "value", "left"), "secret-coverage")


def with_features(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the columns of FEATURES but for the learned two, left and right (neighbouring words, for these), and what labels are told by."""
    v = F.col("value")
    n = F.length(v).cast("double")
    chars = F.split(v, "")
    share = lambda c: (n - F.length(F.replace(v, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(F.array_distinct(chars), lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"), "[^aA9]", "-")
    moves = [(F.regexp_count("shape", F.lit(f"{p[0]}(?={p[1]})")) / n).alias(k) for k, p in zip(MOVES, PAIRS, strict=True)]
    tail = F.coalesce(F.regexp_substr("before", F.lit(r"\S*$")), F.lit(""))
    rest = F.coalesce(F.regexp_substr("after", F.lit(r"^\S*")), F.lit(""))
    word = lambda text, pattern: F.substring(F.lower(F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit("-"))), 1, 30)
    total = found.count()
    out = joined(found, dictionary_coverage(found, docs), ["value"], "n", total, "left").withColumn("shape", shape)
    return out.select(
        *found.columns,
        n.alias("length"),
        entropy.alias("entropy"),
        (F.regexp_count("value", F.lit("[0-9]")) / n).alias("digits"),
        *moves,
        (F.length(F.regexp_replace("shape", r"(.)\1+", "$1")) / n).alias("classes"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        share(F.lit("/")).alias("slashes"),
        share(F.lit(".")).alias("dots"),
        (tail.rlike(r"[./]") | rest.rlike(r"^[./]")).cast("double").alias("path_around"),
        word(F.col("before"), r"(\p{L}+)\P{L}*$").alias("left"),
        word(F.col("after"), r"^\P{L}*(\p{L}+)").alias("right"),
        v.rlike(KNOWN_FORM).alias("is_issued"),
        (F.col("before").rlike(KEY_WORDS + ASSIGNED + "[\"']?$")).alias("is_assigned"),
        (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("is_quoted"),
        v.rlike(r"^[a-z]+$").alias("is_plain"),
        v.rlike(r"^[0-9.,:/_+\-]+$").alias("is_number"),
        (v.rlike(r"@[A-Za-z0-9-]+\.[A-Za-z]") | rest.startswith("@") | tail.contains("@")).alias("is_mail"),
        (F.concat(tail, v).rlike(r"(?i)(https?:|www\.|^/|\.(com|org|net|html?)\b)")).alias("is_link"),
        (v.rlike(r"^[A-Za-z]+([._/-][A-Za-z]+)+$") | v.rlike(r"^[A-Za-z]+[0-9]{0,2}$")).alias("is_name"),
    )


def rule_labels(features: DataFrame) -> DataFrame:
    """Findings labelled by what a reviewer can tell at sight: 1, 0, or null where that takes judgement."""
    issued, assigned, quoted = F.col("is_issued"), F.col("is_assigned"), F.col("is_quoted")
    # An unquoted plain word after a key word is prose; a number after one may be either.
    prose = assigned & ~quoted & F.col("is_plain")
    no = ~issued & (prose | (~assigned & (F.col("is_number") | F.col("is_mail") | F.col("is_link") | F.col("is_name"))))
    yes = issued | (assigned & ~F.col("is_number") & ~prose)
    return features.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def sampled(labelled: DataFrame) -> DataFrame:
    """At most MAX_TRAIN labelled findings, as even as can be by label, drawn by a hash of where they are; with ``fold``. Stored."""
    usable = labelled.filter("label IS NOT NULL")
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    place = F.xxhash64("row", "start", "value")
    parts = []
    for label, other in ((1.0, 0.0), (0.0, 1.0)):
        most = max(MAX_TRAIN // 2, MAX_TRAIN - sizes.get(other, 0))
        # Somewhat more than can be taken, so that the exact cut sorts few rows.
        share = min(1.0, 1.2 * most / max(sizes.get(label, 0), 1))
        drawn = usable.filter((F.col("label") == label) & (F.pmod(place, F.lit(1_000_000)) < int(1_000_000 * share) + 1))
        parts.append(drawn.orderBy(F.xxhash64(F.lit("cut"), "row", "start"), "row", "start").limit(most))
    return stored(parts[0].unionByName(parts[1]).withColumn("fold", F.pmod(F.xxhash64("value"), F.lit(FOLDS))), "secret-sample")


def neighbours(sample: DataFrame) -> DataFrame:
    """(side, word, fold, yes, n): labelled findings beside each word, by fold: at most two rows for each of the sample's. Stored."""
    each = sample.select("fold", "label", F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("left").alias("word")), F.struct(F.lit("right").alias("side"), F.col("right").alias("word")))).alias("w"))
    return stored(each.groupBy("w.side", "w.word", "fold").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")), "secret-neighbours")


def with_neighbours(rows: DataFrame, counts: DataFrame, own_fold: bool) -> DataFrame:
    """Adds word_before and word_after: log-odds of the words beside a candidate; without the row's own fold where that is asked."""
    odds = lambda yes, n: F.log((yes + 0.5) / (n - yes + 0.5))
    total = counts.groupBy("side", "word").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n"))
    for side, name in (("left", "word_before"), ("right", "word_after")):
        # Bounded by the sample: at most MAX_TRAIN words of 30 letters.
        table = F.broadcast(total.filter(F.col("side") == side).select(F.col("word").alias(side), F.col("yes").alias("_yes"), F.col("n").alias("_n")))
        rows = rows.join(table, side, "left")
        yes, n = F.coalesce("_yes", F.lit(0.0)), F.coalesce("_n", F.lit(0))
        if own_fold:
            part = F.broadcast(counts.filter(F.col("side") == side).select(F.col("word").alias(side), "fold", F.col("yes").alias("_own"), F.col("n").alias("_own_n")))
            rows = rows.join(part, [side, "fold"], "left")
            yes, n = yes - F.coalesce("_own", F.lit(0.0)), n - F.coalesce("_own_n", F.lit(0))
        rows = rows.withColumn(name, odds(yes, n)).drop("_yes", "_n", "_own", "_own_n")
    return rows


def judged(features: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds probability: the forest's, trained on ``labelled`` (the columns of ``with_features`` and label).

    With labels of one kind only there is nothing to tell apart: that kind's value is the probability; with
    none it is 0.
    """
    sample = sampled(labelled)
    kinds = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(kinds) < 2:
        return features.withColumn("probability", F.lit(float(kinds[0] if kinds else 0.0)))
    counts = neighbours(sample)
    gather = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    # One sorted partition of the bounded sample: the forest draws by row order, and so the same each time.
    rows = with_neighbours(sample, counts, True).select(*FEATURES, "label").repartition(1).sortWithinPartitions(*FEATURES, "label")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_y")
    model = forest.fit(gather.transform(rows))
    return model.transform(gather.transform(with_neighbours(features, counts, False))).withColumn("probability", vector_to_array("_p")[1]).drop("_features", "_p", "_r", "_y")


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, row, start, end, value, probability, is_secret for every candidate.

    ``labelled`` has the columns of ``with_features`` and label (0 or 1); without it, ``rule_labels`` of these findings are used.
    Null and empty texts have no candidates; repeated rows give repeated findings; an empty table
    gives no rows; extra columns are left out. Whole texts are searched, however long.
    """
    found = stored(candidates(docs), "secret-candidates")
    features = stored(with_features(found, docs), "secret-features")
    got = judged(features, rule_labels(features) if labelled is None else labelled)
    return got.select("doc_id", "row", "start", "end", "value", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def findings(docs: DataFrame) -> DataFrame:
    """What a report shows: doc_id, start, end, value_sha256, probability, is_secret. The value itself is left out."""
    return scan(docs).select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` are replaced, and ``n_chars`` (if there) set anew where they were.

    Null and empty texts stay as they are; repeated rows are treated alike; an empty table gives no rows; columns of any
    name are carried through.
    """
    key, spans_, at = fresh(docs, "_row", "_spans", "_at")
    spans = scan(docs).filter("is_secret").select("row", F.struct("start", "end").alias("s")).distinct()
    # As many as a document has secrets.
    spans = stored(spans.groupBy(F.col("row").alias(key)).agg(F.sort_array(F.collect_list("s")).alias(spans_)), "secret-spans")
    keyed = docs.withColumn(key, row_key())
    keys = maybe_broadcast(spans.select(key), MOST_BROADCAST_ROWS)
    hit = keyed.join(keys, key, "left_semi").join(spans, key)
    cut = F.aggregate(
        spans_,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(REDACTED)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    hit = hit.withColumn("text", cut)
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return hit.select(*docs.columns).unionByName(keyed.join(keys, key, "left_anti").select(*docs.columns))
