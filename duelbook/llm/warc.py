"""WARC archives with a two-level capture index.

Records are written as gzip members into archive segments of a few MB, one row each, through Spark's
own writer, so that any shared store will do, and one a Parquet page, so that a page is read by its name. The capture index sorts lines of (reversed-host URL key,
page, archive, offset, length) into compressed blocks; a sparse directory holds the first and last
key of each block. A lookup binary-searches the directory, opens only the blocks that may
hold the key, searches those, and reads just the byte ranges found: of the files, the pages with those blocks and segments.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined, prefix_sums, small, stored

SEGMENT_BYTES = 2_000_000
BLOCK_LINES = 1_000
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Repeated payload digests that a broadcast may carry (60 bytes each), and directory rows that a task may hold.
MOST_BROADCAST_DIGESTS = 500_000
MOST_DIRECTORY_ROWS, MOST_DIRECTORY_BYTES = 200_000, 8_000_000
#: Blocks or segments that a look-up asks for by name.
MOST_NAMES = 1_000


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, then path and query; scheme, ``www.``, port and fragment left out."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").lower().removeprefix("www.")
    except ValueError:
        return (url or "").strip()
    return ",".join(reversed(host.split("."))) + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One WARC record: a response, or, with ``first``, a revisit of that page's response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if first is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([] if first is None else [f"WARC-Refers-To: <urn:x-page:{first}>", f"WARC-Profile: {PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers, HTTP headers and payload of one record; a response whose digest does not hold raises an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sent = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (digest(payload) != said or len(payload) != int(sent["Content-Length"])):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")

    def number(name):
        text = fields.get(name, "<urn:x-page:>")[len("<urn:x-page:") : -1]
        return int(text) if text else None

    return {"page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": int(sent["Content-Length"]), "payload_digest": said, "record_type": kind, "refers_to": number("WARC-Refers-To"), "payload": payload}


def with_first(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, first: the page to revisit, null for responses.

    Where repeated digests are too many to broadcast, they meet page numbers and digests alone; payloads are then joined
    by page and digest, which no frequent payload can load onto one task.
    """
    text = F.coalesce("html", F.lit(""))
    sha = F.when(F.octet_length(text) >= min_bytes, F.sha1(text.cast("binary"))).alias("sha")
    rows = pages.select("page_id", "url", text.alias("html"), sha)
    keys = pages.select("page_id", sha).filter("sha IS NOT NULL")
    twice = stored(keys.groupBy("sha").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "warc-twice")
    first = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("least")), F.col("least"))
    if small(twice, MOST_BROADCAST_DIGESTS):
        met = rows.join(F.broadcast(twice.select("sha", "least")), "sha", "left")
        return met.select("page_id", "url", "html", first.alias("first"))
    revisits = joined(keys.distinct(), twice, ["sha"], "n", keys.count()).select("page_id", "sha", first.alias("first")).filter("first IS NOT NULL")
    revisits = revisits.withColumnsRenamed({"page_id": "_page", "sha": "_sha"})
    met = rows.join(revisits, rows["page_id"].eqNullSafe(F.col("_page")) & (rows["sha"] == F.col("_sha")), "left")
    return met.select("page_id", "url", "html", "first")


#: One segment or block a Parquet page, found by the page's least and greatest name: a read by name touches that page only.
ONE_A_PAGE = {"parquet.page.row.count.limit": "1", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, data, entries): archive segments with the index entries of their records, stored.

    A segment's name is its task's number, its order in that and a digest of its bytes: unique, and in order within a file.
    """

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        parts, entries, size = [], [], 0

        def segment():
            data = b"".join(parts)
            return pd.DataFrame({"archive": [f"{part:08d}-{made:08d}-{hashlib.sha1(data).hexdigest()[:12]}"], "data": [data], "entries": [list(entries)]})

        for batch in batches:
            for page_id, url, html, first in zip(batch["page_id"], batch["url"], batch["html"], batch["first"], strict=True):
                page = None if page_id is None else int(page_id)
                member = gzip.compress(record(page, url, html.encode("utf-8", "replace"), None if first is None else int(first)), 6, mtime=0)
                entries.append({"key": url_key(url), "page_id": page, "offset": size, "length": len(member)})
                parts.append(member)
                size += len(member)
                if size >= SEGMENT_BYTES:
                    yield segment()
                    parts, entries, size = [], [], 0
                    made += 1
        if parts:
            yield segment()

    rows = with_first(pages, min_bytes).select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.col("first").cast("string").alias("first"))
    return stored(rows.mapInPandas(run, "archive string, data binary, entries array<struct<key:string,page_id:long,offset:long,length:long>>"), "warc-archives", "uncompressed", **ONE_A_PAGE)


def capture_index(archives: DataFrame) -> DataFrame:
    """(block, first_key, last_key, n, data): sorted index lines in compressed blocks, stored."""
    lines = archives.select("archive", F.explode("entries").alias("e")).select("e.key", "e.page_id", "archive", "e.offset", "e.length")
    order = ["key", "page_id", "archive", "offset"]

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple[str, str]] = []

        def block(rows):
            nonlocal made
            made += 1
            data = zlib.compress("\n".join(x[1] for x in rows).encode(), 6)
            return {"block": f"{part:08d}-{made:08d}", "first_key": rows[0][0], "last_key": rows[-1][0], "n": len(rows), "data": data}

        for batch in batches:
            held += [(k, json.dumps([k, a, o, n])) for k, a, o, n in zip(batch["key"], batch["archive"], batch["offset"].tolist(), batch["length"].tolist(), strict=True)]
            full = len(held) // BLOCK_LINES * BLOCK_LINES
            if full:
                yield pd.DataFrame([block(held[i : i + BLOCK_LINES]) for i in range(0, full, BLOCK_LINES)])
                held = held[full:]
        if held:
            yield pd.DataFrame([block(held)])

    return stored(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(run, "block string, first_key string, last_key string, n long, data binary"), "warc-index", "uncompressed", **ONE_A_PAGE)


def blocks_of(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, block): the blocks that may hold each key, by binary search in the sparse directory."""
    directory = index.select("first_key", "last_key", "block")
    if small(directory, MOST_DIRECTORY_ROWS, MOST_DIRECTORY_BYTES):
        rows = sorted(tuple(r) for r in directory.collect())
        firsts, blocks = [r[0] for r in rows], [r[2] for r in rows]
        lasts = [r[1] for r in rows]

        def run(batches):
            for batch in batches:
                found = [(k, blocks[i]) for k in batch["key"] for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
                yield pd.DataFrame(found, columns=["key", "block"])

        return keys.mapInPandas(run, "key string, block string")
    # A larger directory stays distributed: the search becomes counting the blocks that begin before a key.
    ranked = stored(prefix_sums(directory, [F.col("first_key"), F.col("last_key"), F.col("block")], {"rank": F.lit(1)}, "warc-directory"), "warc-ranked")
    asked = keys.select(F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"), "key", F.lit("").alias("block"), F.lit(0).alias("one"))
    begun = directory.select(F.lit(1).alias("kind"), F.col("first_key").alias("key"), "block", F.lit(1).alias("one"))
    counted = prefix_sums(asked.unionByName(begun), [F.col("key"), F.col("kind"), F.col("block")], {"before": F.col("one")}, "warc-search").filter("kind <> 1")
    span = counted.groupBy("key").agg(F.greatest(F.min("before") - 1, F.lit(0)).alias("lo"), (F.max("before") - 1).alias("hi")).filter("hi >= lo")
    met = span.select("key", F.explode(F.sequence("lo", "hi")).alias("rank")).join(ranked, "rank")
    return met.filter((F.col("first_key") <= F.col("key")) & (F.col("last_key") >= F.col("key"))).select("key", "block")


def _named(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``column`` is in ``wanted``: of few names as a filter that the scan uses to skip files and pages, else by the join alone."""
    names = [r[0] for r in wanted.select(column).distinct().limit(MOST_NAMES + 1).collect()]
    return table.filter(F.col(column).isin(names)) if len(names) <= MOST_NAMES else table


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, archive, offset, length) of every capture of the given distinct keys. Few keys read no more than their blocks."""
    # At most as many keys as a block has lines, or that lie between its ends.
    wanted = stored(blocks_of(index, keys.select("key").distinct()).groupBy("block").agg(F.collect_set("key").alias("wanted")), "warc-wanted")

    def run(batches):
        for batch in batches:
            for data, wanted in zip(batch["data"], batch["wanted"], strict=True):
                lines = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
                keys = [x[0] for x in lines]
                yield pd.DataFrame([lines[i] for k in wanted for i in range(bisect_left(keys, k), bisect_right(keys, k))], columns=["key", "archive", "offset", "length"])

    return _named(index, "block", wanted).select("block", "data").join(wanted, "block").select("data", "wanted").mapInPandas(run, "key string, archive string, offset long, length long")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_ranges(archives: DataFrame, found: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at the given (archive, offset, length), parsed and checked. Few ranges read no more than their segments."""
    # At most as many ranges as a segment has records.
    ranges = stored(found.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("ranges")), "warc-ranges")

    def run(batches):
        for batch in batches:
            for data, ranges in zip(batch["data"], batch["ranges"], strict=True):
                rows = [parse(gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])) for r in ranges]
                out = pd.DataFrame(rows)
                if not with_payload:
                    out["payload"] = None
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return _named(archives, "archive", ranges).select("archive", "data").join(ranges, "archive").select("data", "ranges").mapInPandas(run, READ)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes all pages, indexes them and reads every capture back through the index.

    page_id, payload_bytes, payload_digest, record_type, refers_to for each row. Null html is an
    empty payload, a null url the key of an empty host, a null page_id has no number (and revisits
    if its payload has a numbered page). Rows that repeat both the least page_id and its payload are
    all responses. Empty tables give no rows; extra columns are left out.
    """
    archives = write_archives(pages, min_bytes)
    index = capture_index(archives)
    keys = archives.select(F.explode("entries").alias("e")).select(F.col("e.key").alias("key"))
    got = read_ranges(archives, lookup(index, keys), with_payload=False)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
