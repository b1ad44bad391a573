"""The registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, itq, langid, lm, media, merkle, mixing, neardup, secrets, substrings, toxicity, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 16) AS k
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
levels AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE)
           / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS lev
  FROM ranked
  WINDOW w AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT min(lev) FILTER (WHERE ratio >= lev) AS any_lev, arg_min(lev, ratio) FILTER (WHERE ratio >= lev) AS lev FROM levels),
tgt AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), coalesce(lev.lev, 0.0) * weight) AS target FROM ranked, lev),
run AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM run
"""


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


OP2_SQL = r"""
WITH low AS (SELECT translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, doc_id FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM low),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS iw FROM benchmark),
win AS (
  SELECT item_id, least(len(iw), 10) AS l, unnest(range(1, len(iw) - least(len(iw), 10) + 2)) AS s, iw FROM b WHERE len(iw) > 0),
keys AS (SELECT DISTINCT item_id, l, array_to_string(iw[s : s + l - 1], ' ') AS k FROM win),
lens AS (SELECT DISTINCT l FROM keys),
spots AS (SELECT r, l, ws, unnest(range(1, len(ws) - l + 2)) AS p FROM d, lens WHERE len(ws) >= l),
hits AS (SELECT s.r, s.p, s.l, k.item_id FROM (SELECT r, l, p, array_to_string(ws[p : p + l - 1], ' ') AS k FROM spots) s JOIN keys k ON s.l = k.l AND s.k = k.k),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + l)) AS q FROM hits) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r),
df AS (SELECT term, count(*) AS n FROM (SELECT unnest(ws) AS term FROM d) GROUP BY term),
it AS (SELECT DISTINCT item_id, iw FROM b WHERE len(iw) > 0),
rare AS (
  SELECT item_id, iw, term, count(*) OVER (PARTITION BY item_id, iw) AS need FROM (
    SELECT item_id, iw, t.term FROM (SELECT item_id, iw, unnest(list_distinct(iw)) AS term FROM it) t LEFT JOIN df USING (term)
    QUALIFY row_number() OVER (PARTITION BY item_id, iw ORDER BY coalesce(n, 0), t.term) <= 3)),
occ AS (SELECT r, p, ws[p] AS term FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
spot AS (SELECT occ.r, occ.p, item_id, iw, rare.term, need FROM occ JOIN rare USING (term)),
near AS (
  SELECT r, count(DISTINCT item_id) AS n_near FROM (
    SELECT a.r, a.p, a.item_id FROM (SELECT DISTINCT r, p, item_id, iw, need FROM spot) a
    JOIN spot z ON z.r = a.r AND z.item_id = a.item_id AND z.iw = a.iw AND z.p BETWEEN a.p AND a.p + 20
    GROUP BY a.r, a.p, a.item_id, a.iw, a.need HAVING count(DISTINCT z.term) = a.need) GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r) LEFT JOIN near USING (r)
"""


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def op6_media_columns(spark: SparkSession, folder: str) -> DataFrame:
    return media.read_back(media.media_table(_table(spark, folder, "documents")))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predicted(_table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(_table(spark, folder, "pages"))


OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY sha1(h)) AS least FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: translate(lpad(to_base(CAST('0x' || substr(x, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT), 32), 4, '0'),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM d
"""


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(_table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    got = substrings.repeats(_table(spark, folder, "documents"))
    return got.withColumn("removed", F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ","))


#: Rows are told apart by number, and rows that repeat doc_id and text (one ``row``) have the same places, as in the operator. Units are compared whole.
OP5_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, text, md5(coalesce('s' || CAST(doc_id AS VARCHAR), 'n') || chr(10) || coalesce('s' || text, 'n')) AS row FROM documents),
cut AS (SELECT r, doc_id, row, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS u, len(string_split(text, chr(10))) AS n FROM rows WHERE text IS NOT NULL),
units AS (
  SELECT *, raw || CASE WHEN u < n THEN chr(10) ELSE '' END AS whole, trim(regexp_replace(lower(raw), '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g')) AS unit FROM cut),
placed AS (SELECT *, coalesce(sum(length(whole)) OVER (PARTITION BY r ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM units),
first AS (SELECT unit, min({'a': doc_id IS NOT NULL, 'b': doc_id, 'c': row, 'd': u}) AS f FROM units WHERE unit <> '' GROUP BY unit),
told AS (SELECT p.*, coalesce(f.f <> {'a': doc_id IS NOT NULL, 'b': doc_id, 'c': row, 'd': u}, false) AS gone FROM placed p LEFT JOIN first f ON f.unit = p.unit),
each AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(CAST(begins AS VARCHAR) || '-' || CAST(begins + length(whole) AS VARCHAR), ',' ORDER BY u) FILTER (gone) AS removed,
    sum(length(whole)) FILTER (gone) AS chars_removed, string_agg(whole, '' ORDER BY u) FILTER (NOT gone) AS clean FROM told GROUP BY r)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, CAST(coalesce(chars_removed, 0) AS BIGINT) AS chars_removed,
  sha256(coalesce(clean, '')) AS clean_sha256, coalesce(n_removed, 0) > 0 AS has_repeats
FROM rows LEFT JOIN each USING (r)
"""


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.findings(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tamper_check(_table(spark, folder, "documents"))


_FIELDS = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}"))
OP11_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)) AS bs FROM documents),
marked AS (
  SELECT *, coalesce(xor(list_reduce(bs, lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295) & 1 = 0, false) AS struck FROM crc),
d AS (
  SELECT row_number() OVER () AS r, doc_id, source IS NOT NULL AS named, source, sha256({_FIELDS.format(text="text")}) AS leaf,
         CASE WHEN struck THEN sha256({_FIELDS.format(text="replace(text, chr(10), '')")}) ELSE sha256({_FIELDS.format(text="text")}) END AS tampered FROM marked),
groups AS (SELECT named, source, row_number() OVER (ORDER BY named, source) - 1 AS g, count(*) OVER () AS n FROM (SELECT DISTINCT named, source FROM d)),
leaves AS (
  SELECT d.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d JOIN groups ON d.source IS NOT DISTINCT FROM groups.source),
t AS (
  SELECT g, 0 AS lvl, pos, leaf AS h, n FROM leaves
  UNION ALL SELECT g, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3) FROM t WHERE n > 1 GROUP BY g, lvl, pos // 3),
u AS (
  SELECT 0 AS lvl, g AS pos, h, groups.n FROM t JOIN groups USING (g) WHERE t.n = 1
  UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3) FROM u WHERE n > 1 GROUP BY lvl, pos // 3),
nodes AS (SELECT g, lvl, pos, h, n FROM t UNION ALL SELECT -1, lvl, pos, h, n FROM u),
sib AS (
  SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS x, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS y
  FROM nodes a JOIN nodes b ON a.g = b.g AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.g, a.lvl, a.pos),
f AS (
  SELECT r, g, 0 AS lvl, pos, tampered AS cur, '' AS proof FROM leaves
  UNION ALL SELECT r, f.g, f.lvl + 1, f.pos // 3, sha256(x || cur || y), proof || x || y FROM f JOIN sib ON sib.g = f.g AND sib.lvl = f.lvl AND sib.pos = f.pos),
f2 AS (
  SELECT r, 0 AS lvl, f.g AS pos, cur, proof FROM f JOIN t ON t.g = f.g AND t.lvl = f.lvl WHERE t.n = 1
  UNION ALL SELECT r, f2.lvl + 1, f2.pos // 3, sha256(x || cur || y), proof || x || y FROM f2 JOIN sib ON sib.g = -1 AND sib.lvl = f2.lvl AND sib.pos = f2.pos)
SELECT doc_id, leaf, t.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = u.h AS verified
FROM leaves JOIN t ON t.g = leaves.g AND t.n = 1 JOIN u ON u.n = 1 JOIN f2 ON f2.r = leaves.r AND f2.lvl = u.lvl
"""


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, count(*) AS big FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(big) AS nl FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * v.v) AS p, 1 + (1000000000::HUGEINT * (k.big + 5)) // (v.nl + 5 * v.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value FROM f x JOIN f y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', term, CAST(p - q AS BIGINT), CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INT) AS rank FROM f WHERE c > 0 AND p > q QUALIFY rank <= 50
"""


def op13_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return itq.near_duplicates(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_decontaminate": op2_decontaminate,
        "op3_secret_scan": op3_secret_scan,
        "op4_lm_scores": op4_lm_scores,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_media_columns": op6_media_columns,
        "op7_toxicity": op7_toxicity,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_warc": op9_warc,
        "op10_language_id": op10_language_id,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_source_divergence": op12_source_divergence,
        "op13_embedding_near_duplicates": op13_embedding_near_duplicates,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1_SQL, "op2_decontaminate": OP2_SQL, "op5_substring_dedup": OP5_SQL, "op9_warc": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op12_source_divergence": OP12_SQL}
