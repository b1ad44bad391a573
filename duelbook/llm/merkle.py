"""Merkle manifest of a dataset: leaf places by ranks in bitmaps, levels reduced in keyed slot arrays.

The ids of each group (a source) are packed where they lie into containers of 65,536 ids: a sorted array of 16-bit values
while they are few, else a bitmap. Containers of one group and range are merged, and their numbers of rows summed into a
directory; a rank query adds the directory's sum, the popcounts of a container's earlier words and those of the id's own
word. So each leaf finds its place in its group without a sort of the leaves. Rows that share an id are told apart by
their leaves, in a range sort of those rows alone.

Leaves then meet in slot arrays of 3^7 places, keyed by group and place; an array gives one node seven levels up. On the
way down each array adds the siblings of its levels to the path that it is given from above.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped, joined, prefix_sums, stored, tasks_for

#: Children of a node, and levels that one slot array reduces.
FAN, STEP = 3, 7
SLOTS = FAN**STEP
#: Bits of an id inside a container; from so many ids on a container is a bitmap (of 8,192 bytes, as the array would be).
LOW_BITS, DENSE = 16, 4096
#: Leaves and containers that one task sees.
LEAVES_PER_TASK = 300_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Stands in a proof's entry where the node itself goes, between its left and right siblings.
SELF = "."


def leaf_of(values: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS) -> Column:
    """SHA-256 (hex) of a row: each value as its UTF-8 byte count, a colon and itself, `-` if null; ``values`` replace columns."""
    parts = []
    for c in columns:
        v = (values or {}).get(c, F.col(f"`{c}`")).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.replace(F.array_join(proof, ""), F.lit(SELF), F.lit("")), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda at, entry: F.sha2(F.replace(entry, F.lit(SELF), at), 256))


def pack(lows: np.ndarray) -> bytes:
    """A container of distinct, sorted 16-bit values."""
    if len(lows) < DENSE:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(1 << LOW_BITS, dtype=np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if len(data) < 2 * DENSE:
        return np.frombuffer(data, dtype="<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little"))


def rank(data: bytes, lows: np.ndarray) -> np.ndarray:
    """How many values of a container are less than each of ``lows``: its word's place in the popcount directory, and the word's lower bits."""
    if len(data) < 2 * DENSE:
        return np.searchsorted(np.frombuffer(data, dtype="<u2"), lows.astype(np.uint16)).astype(np.int64)
    words = np.frombuffer(data, dtype="<u8")
    directory = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
    at, bit = lows >> 6, (lows & 63).astype(np.uint64)
    return directory[at] + np.bitwise_count(words[at] & ((np.uint64(1) << bit) - np.uint64(1)))


PARTS = "g string, chunk long, n_rows long, bits binary, dup_low binary, dup_more binary"


def _part(lows: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(number of rows, container, values that repeat, how often more than once)."""
    many = counts > 1
    return int(counts.sum()), pack(lows), lows[many].astype("<u2").tobytes(), (counts[many] - 1).astype("<i8").tobytes()


def containers(ids: DataFrame, tasks: int) -> DataFrame:
    """(g, id) -> one container for each group and range of ids, with how often ids repeat (PARTS)."""

    def collect(batches):
        for batch in batches:
            seen = batch.groupby(["g", "chunk", "low"], sort=True).size().reset_index(name="n")
            parts = [(g, c, *_part(own["low"].to_numpy(), own["n"].to_numpy())) for (g, c), own in seen.groupby(["g", "chunk"], sort=False)]
            yield pd.DataFrame(parts, columns=[x.split()[0] for x in PARTS.split(", ")])

    def merge(rows: dict[str, np.ndarray]) -> dict:
        lows = [unpack(b) for b in rows["bits"]]
        more = [np.frombuffer(b, dtype="<u2").astype(np.int64) for b in rows["dup_low"]]
        times = [np.frombuffer(b, dtype="<i8") for b in rows["dup_more"]]
        distinct, at = np.unique(np.concatenate(lows + more), return_inverse=True)
        weight = np.concatenate([np.ones(sum(map(len, lows)), dtype=np.int64), *times])
        counts = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(counts, at, weight)
        part = _part(distinct, counts)
        return {"g": [rows["g"][0]], "chunk": [rows["chunk"][0]], **{k: [v] for k, v in zip(("n_rows", "bits", "dup_low", "dup_more"), part, strict=True)}}

    cut = ids.select("g", F.shiftright("id", LOW_BITS).alias("chunk"), F.col("id").bitwiseAND((1 << LOW_BITS) - 1).alias("low"))
    return grouped(cut.mapInPandas(collect, PARTS), ["g", "chunk"], merge, PARTS, tasks=tasks)


def directory(rows: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Containers with ``base``, the number of rows of their group before them (null ids come first), and ``n``, those of the group. Stored."""
    found = containers(rows.filter("id IS NOT NULL").select("g", "id"), tasks_for(rows.sparkSession, total, 50 * LEAVES_PER_TASK))
    run = prefix_sums(found, [F.col("g"), F.col("chunk")], {"before": F.col("n_rows")}, "merkle-directory")
    starts = run.groupBy("g").agg(F.min("before").alias("start"))
    of_group = stored(sizes.join(starts, "g"), "merkle-groups")
    return stored(run.join(of_group, "g").select("g", "chunk", "bits", "dup_low", "dup_more", "n", (F.col("before") - F.col("start") + F.col("nulls")).alias("base")), "merkle-containers")


def shared_ids(containers_: DataFrame, sizes: DataFrame) -> DataFrame:
    """(g, key, times, n, first): ids that several rows of a group share, with the place of the first; null ids (key '') always."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples():
                low = np.frombuffer(r.dup_low, dtype="<u2").astype(np.int64)
                more = np.frombuffer(r.dup_more, dtype="<i8")
                at = r.base + rank(r.bits, low) + np.cumsum(more) - more
                out += [(r.g, str((r.chunk << LOW_BITS) + int(x)), int(m) + 1, r.n, int(a)) for x, m, a in zip(low, more, at, strict=True)]
            yield pd.DataFrame(out, columns=["g", "key", "times", "n", "first"])

    several = containers_.filter(F.octet_length("dup_low") > 0).mapInPandas(run, "g string, key string, times long, n long, first long")
    nulls = sizes.filter("nulls > 0").select("g", F.lit("").alias("key"), F.col("nulls").alias("times"), "n", F.lit(0).cast("long").alias("first"))
    return stored(several.unionByName(nulls), "merkle-shared")


def placed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(g, n, pos, key, leaf, keep ...): each leaf's place among the n of its group, by id, nulls first. Stored."""
    spark = rows.sparkSession
    sizes = stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").isNull().cast("long")).alias("nulls")), "merkle-sizes")
    total = int(sizes.agg(F.sum("n")).first()[0] or 0)
    own = directory(rows, sizes, total)
    shared = shared_ids(own, sizes)
    keyed = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("")))
    has_shared = not shared.isEmpty()
    alone = keyed.join(shared.select("g", "key"), ["g", "key"], "left_anti") if has_shared else keyed
    nothing = F.lit(None)
    asked = alone.select("g", F.shiftright("id", LOW_BITS).alias("chunk"), F.lit(1).alias("role"), F.col("id").bitwiseAND((1 << LOW_BITS) - 1).alias("low"), "key", "leaf", *keep, *[nothing.cast(t).alias(c) for c, t in (("bits", "binary"), ("dup_low", "binary"), ("dup_more", "binary"))], *[F.lit(0).cast("long").alias(c) for c in ("n", "base")])
    given = own.select("g", "chunk", F.lit(0).alias("role"), F.lit(0).cast("long").alias("low"), nothing.cast("string").alias("key"), nothing.cast("binary").alias("leaf"), *[nothing.cast("string").alias(c) for c in keep], "bits", "dup_low", "dup_more", "n", "base")

    def query(r: dict[str, np.ndarray]) -> dict:
        low, more = r["low"][1:], np.frombuffer(r["dup_more"][0], dtype="<i8")
        repeats = np.concatenate(([0], np.cumsum(more)))[np.searchsorted(np.frombuffer(r["dup_low"][0], dtype="<u2"), low)]
        pos = r["base"][0] + rank(r["bits"][0], low) + repeats
        return {"g": r["g"][1:], "n": np.repeat(r["n"][0], len(low)), "pos": pos, **{c: r[c][1:] for c in ("key", "leaf", *keep)}}

    # Ids that rows do not share: at most 65,536 rows a group.
    schema = "g string, n long, pos long, key string, leaf binary" + "".join(f", {c} string" for c in keep)
    out = grouped(asked.unionByName(given), ["g", "chunk"], query, schema, ["role"], tasks_for(spark, total, LEAVES_PER_TASK))
    if has_shared:
        met = joined(keyed.select("g", "key", "leaf", *keep), shared, ["g", "key"], "times", total)
        numbered = stored(prefix_sums(met, [F.col("g"), F.col("key"), F.col("leaf")], {"seq": F.lit(1).cast("long")}, "merkle-ties"), "merkle-numbered")
        begin = stored(numbered.groupBy("g", "key").agg(F.min("seq").alias("begin"), F.count(F.lit(1)).alias("rows")), "merkle-begin")
        ties = joined(numbered, begin, ["g", "key"], "rows", total)
        out = out.unionByName(ties.select("g", "n", (F.col("first") + F.col("seq") - F.col("begin")).alias("pos"), "key", "leaf", *keep))
    return stored(out, "merkle-leaves")


def _digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _levels(nodes: list[str], n: int) -> list[list[str]]:
    """Nodes of a slot array level by level, up to one node; a group with more nodes than slots goes up all STEP levels."""
    out = [nodes]
    while len(out) <= STEP if n > SLOTS else len(out[-1]) > 1:
        out.append([_digest(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def _slots(nodes: DataFrame) -> DataFrame:
    return nodes.select("g", "n", F.floor(F.col("pos") / SLOTS).alias("block"), F.pmod("pos", F.lit(SLOTS)).alias("slot"), "node")


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """(g, n, pos, node: binary) and the same seven levels up, and so on, until each group has one node; all stored."""

    def up(r: dict[str, np.ndarray]) -> dict:
        n = int(r["n"][0])
        top = _levels([x.hex() for x in r["node"]], n)[-1][0]
        return {"g": r["g"][:1], "n": [-(-n // SLOTS)], "pos": r["block"][:1], "node": [bytes.fromhex(top)]}

    out = [nodes]
    most = int(nodes.agg(F.max("n")).first()[0] or 0)
    first = True
    while most > 1 or (first and most):
        total = out[-1].count()
        out.append(stored(grouped(_slots(out[-1]), ["g", "block"], up, "g string, n long, pos long, node binary", ["slot"], tasks_for(nodes.sparkSession, total, LEAVES_PER_TASK)), "merkle-level"))
        most, first = -(-most // SLOTS), False
    return out


def paths(nodes: DataFrame, above: DataFrame, keep: list[str], total: int) -> DataFrame:
    """(g, pos, keep ..., subroot, proof): the path of each node, from those of the nodes seven levels up (g, pos, subroot, proof)."""
    nothing = F.lit(None)
    own = nodes.select("g", "n", F.floor(F.col("pos") / SLOTS).alias("block"), F.pmod("pos", F.lit(SLOTS)).alias("slot"), "node", *keep, nothing.cast("string").alias("subroot"), nothing.cast("array<string>").alias("proof"))
    given = above.select("g", F.lit(0).cast("long").alias("n"), F.col("pos").alias("block"), F.lit(-1).cast("long").alias("slot"), nothing.cast("binary").alias("node"), *[nothing.cast("string").alias(c) for c in keep], "subroot", "proof")

    def down(r: dict[str, np.ndarray]) -> dict:
        levels = _levels([x.hex() for x in r["node"][1:]], int(r["n"][-1]))
        path = [list(r["proof"][0])]
        for nodes_ in reversed(levels[:-1]):
            entry = [("".join(nodes_[i - i % FAN : i]) + SELF + "".join(nodes_[i + 1 : i - i % FAN + FAN])) for i in range(len(nodes_))]
            path = [[e, *path[i // FAN]] for i, e in enumerate(entry)]
        pos = r["block"][0] * SLOTS + r["slot"][1:]
        return {"g": r["g"][1:], "pos": pos, **{c: r[c][1:] for c in keep}, "subroot": [r["subroot"][0]] * len(pos), "proof": path}

    schema = "g string, pos long, " + "".join(f"{c} string, " for c in keep) + "subroot string, proof array<string>"
    return grouped(own.unionByName(given), ["g", "block"], down, schema, ["slot"], tasks_for(nodes.sparkSession, total, LEAVES_PER_TASK))


def _all_paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the second lowest of ``levels``, from those of the highest."""
    for nodes in reversed(levels[1:-1]):
        top = stored(paths(nodes, top, [], nodes.count()), "merkle-paths")
    return top


def manifest(docs: DataFrame, keep: tuple[str, ...] = (), *, group: str = "source", key: str = "doc_id", columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """One row per row of ``docs``: key, group, leaf_index, leaf, subroot, root, proof, and the (string) columns ``keep``.

    Leaves ascend in their group by the integer ``key``; every FAN nodes in turn become one, up to the group's subroot, and the
    subroots, ordered by group bytewise, up to the root. A proof has an entry for each level: the siblings to the left, ``.``,
    and those to the right. Null keys come first, a null group is one of its own and the first; an empty group name is another.
    Rows that share a key stand in the order of their leaves; repeated rows each have a place. Very long texts are hashed where
    they lie. An empty table gives no rows; columns that are not named are left out, and may have any name.
    """
    kept = [f"keep_{i}" for i in range(len(keep))]
    g = F.coalesce(F.concat(F.lit("s"), F.col(f"`{group}`").cast("string")), F.lit("n"))
    rows = docs.select(g.alias("g"), F.col(f"`{key}`").cast("long").alias("id"), F.unhex(leaf_of(columns=columns)).alias("leaf"), *[F.col(f"`{c}`").cast("string").alias(k) for c, k in zip(keep, kept, strict=True)])
    leaves = placed(rows, kept)
    levels = reduced(leaves.select("g", "n", "pos", F.col("leaf").alias("node")))
    subroots = levels[-1].select("g", "node")
    numbered = stored(prefix_sums(subroots, [F.col("g")], {"pos": F.lit(1).cast("long")}, "merkle-subroots"), "merkle-numbered-subroots")
    n_groups = numbered.count()
    upper = reduced(numbered.select(F.lit("").alias("g"), F.lit(n_groups).cast("long").alias("n"), "pos", "node"))
    root = upper[-1].select(F.lower(F.hex("node")).alias("root")).first()  # one row
    top = upper[-1].select("g", "pos", F.lit("").alias("subroot"), F.array().cast("array<string>").alias("proof"))
    of_group = numbered.select(F.lit("").alias("g"), F.lit(n_groups).cast("long").alias("n"), "pos", "node", F.col("g").alias("name"))
    of_group = stored(paths(of_group, _all_paths(upper, top), ["name"], n_groups).join(numbered.select("pos", F.lower(F.hex("node")).alias("own")), "pos"), "merkle-group-paths")
    top = _all_paths(levels, of_group.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), F.col("own").alias("subroot"), "proof"))
    carried = ["key", "leaf_hex", *kept]
    leaves = leaves.select("g", "n", "pos", F.col("leaf").alias("node"), "key", F.lower(F.hex("leaf")).alias("leaf_hex"), *kept)
    out = paths(leaves, top, carried, leaves.count())
    return out.select(
        F.nullif("key", F.lit("")).cast(docs.schema[key].dataType).alias(key),
        F.when(F.col("g") != "n", F.substring("g", 2, 1 << 30)).alias(group),
        F.col("pos").alias("leaf_index"),
        F.col("leaf_hex").alias("leaf"),
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        "proof",
        *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)],
    )


def tamper_check(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: what each row's proof says after some rows were tampered with.

    Where 2 divides the crc32 of the id (as text), line feeds are deleted from the text; rows without any, with a null
    text or a null id stay as they are. ``manifest`` tells what other odd rows give.
    """
    struck = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = leaf_of({"text": F.when(struck, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})
    met = manifest(docs.select(*COLUMNS, changed.alias("tampered")), ("tampered",))
    out = met.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded(F.col("tampered"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
