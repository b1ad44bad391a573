"""Pieces that several training-data operators share."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

#: White space of the word rules: space and the controls from tab to carriage return.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Letters, digits and everything outside ASCII.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A character of such a word, before A-Z are lower-cased.
WORD_CHAR = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is hot if it has over 1 / MOST_HOT of all rows, so that there are at most so many; fewer rows than LEAST_HOT are never hot.
MOST_HOT, LEAST_HOT = 100_000, 64
#: Bytes of values that a broadcast may carry.
MOST_BROADCAST_BYTES = 48_000_000


#: Bytes of one batch of rows on its way to a Python worker or back.
BATCH_BYTES = 1_000_000


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES):
    """What is run inside sends batches of at most so many bytes (or one row) to Python workers; the session's own setting comes back after it.

    An executor holds each batch outside its heap and a worker holds it again, so without a bound both go with rows times
    their length. A smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key)
    spark.conf.set(key, min(int(own.lower().removesuffix("b")), most_bytes) if own.lower().removesuffix("b").isdigit() else most_bytes)
    try:
        yield
    finally:
        spark.conf.set(key, own)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset, a local master (one machine, as in tests) takes a temporary folder; a cluster raises an error.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "duelbook-shared")
    return f"{found.rstrip('/')}/duelbook-{context.applicationId}"


def stored(df: DataFrame, name: str, compression: str = "snappy", **options: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: cuts lineage, survives lost executors.

    Results are lazy, so what they read stays until ``clear``; ``forget`` removes what nothing reads any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(compression=compression, **options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._duelbook_path = path
    return back


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Removes the files of a ``stored`` frame that is not needed any more."""
    if path := getattr(df, "_duelbook_path", None):
        _remove(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Removes everything that this application stored; call it when all results have been written."""
    _remove(spark, shared_dir(spark))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _bytes(df: DataFrame) -> Column:
    """About how many bytes the values of a row take."""
    out = F.lit(16)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            out = out + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            out = out + F.coalesce(F.octet_length(F.array_join(c, " ")), F.lit(0)) + 24 * F.coalesce(F.size(c), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            out = out + 32 * F.coalesce(F.size(c), F.lit(0))
        else:
            out = out + 8
    return out


def small(df: DataFrame, most_rows: int, most_bytes: int = MOST_BROADCAST_BYTES) -> bool:
    """True if the frame has at most so many rows and bytes; reads no more rows than that."""
    got = df.select(_bytes(df).alias("b")).limit(most_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return got["n"] <= most_rows and (got["b"] or 0) <= most_bytes


def maybe_broadcast(df: DataFrame, most_rows: int, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """Hints a broadcast only behind a count of rows and bytes; beyond it, the join shuffles and AQE splits hot keys."""
    return F.broadcast(df) if small(df, most_rows, most_bytes) else df


def joined(many: DataFrame, one: DataFrame, keys: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """``many`` with the row of ``one`` for its keys; ``n`` is a column of ``one``: the number of rows that ``many`` has for the keys.

    Rows of hot keys (at most MOST_HOT keys) meet them by broadcast where they lie; the others are shuffled, and no key
    of those has more than 1 / MOST_HOT of ``total``, the rows of ``many``.
    """
    edge = max(LEAST_HOT, total // MOST_HOT)
    hot = F.broadcast(one.filter(F.col(n) > edge))
    rest = many.join(F.broadcast(one.filter(F.col(n) > edge).select(*keys)), keys, "left_anti").join(one.filter(F.col(n) <= edge), keys, how)
    return many.join(hot, keys).unionByName(rest)


def below(share: float) -> int | None:
    """The signed 64-bit value that a share of all hash values lies below; None for all of them."""
    return None if share >= 1 else int(max(share, 0.0) * 2.0**64) - (1 << 63)


def sampled(share: float, *keys: Column | str) -> Column:
    """Whether a row is in a share of all rows, drawn by a hash of ``keys``; right to one part in 2^53, however small the share is."""
    edge = below(share)
    return F.lit(True) if edge is None else F.xxhash64(*keys) < F.lit(edge)


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """128-bit key of a document row (binary); null and empty are told apart."""
    part = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat(part(doc_id), F.lit("\n"), part(text))))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else. Pure ASCII strings take the quicker way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(c: Column) -> Column:
    """Words of a text, A-Z lower-cased: runs of letters, digits and non-ASCII. Null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(c, F.lit(""))), WORD_GAP), lambda w: w != "")


def prefix_sums(df: DataFrame, order: list[Column], values: dict[str, Column], name: str) -> DataFrame:
    """Exclusive running sums in a total order, without one task seeing all rows.

    Range-sorts the rows, stores them with their partition's number, sums each partition, runs
    over those few sums, and adds a running sum inside each partition. ``order`` should tell rows
    apart; rows that tie in all of it may come in any order.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    per_part = ranged.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_part", *[F.coalesce(F.sum(f"_sum_{k}").over(earlier), F.lit(0)).alias(f"_from_{k}") for k in values])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{k}") for k, v in values.items()])
    both = run.join(F.broadcast(starts), "_part")  # one row for each partition of the sort
    return both.select(*df.columns, *[(F.col(f"_from_{k}") + F.col(f"_in_{k}")).alias(k) for k in values])


def tasks_for(spark: SparkSession, n_rows: int, per_task: int) -> int:
    """Number of tasks, so that one sees about ``per_task`` rows however large the table is; at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / per_task))


def grouped(df: DataFrame, keys: list[str], run: Callable[[dict[str, np.ndarray]], dict], schema: str, order: list[str] | None = None, tasks: int = 0) -> DataFrame:
    """Calls ``run`` with the rows of each key as arrays by column, sorted by ``order``; it returns columns of equal length.

    Many small groups share one batch in and out; a group that goes on in the next batch is held back, so a group
    must fit in memory. Keys must not be null.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def over(batches):
        held = None
        for batch in chain(batches, [None]):
            if batch is not None and not len(batch):
                continue
            if held is not None and batch is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            last = batch is None
            batch = held if last else batch
            if batch is None:
                return
            cols = {c: batch[c].to_numpy() for c in batch.columns}
            change = np.zeros(len(batch) - 1, dtype=bool)
            for k in keys:
                change |= cols[k][1:] != cols[k][:-1]
            cut = np.flatnonzero(change) + 1
            ends = [*cut, len(batch)] if last else list(cut)
            if ends:
                out = [run({c: v[x:y] for c, v in cols.items()}) for x, y in zip([0, *ends[:-1]], ends, strict=True)]
                yield pd.DataFrame({c: list(chain.from_iterable(o[c] for o in out)) for c in names})
            held = None if last else batch.iloc[ends[-1] if ends else 0 :]

    dealt = df.repartition(tasks, *keys) if tasks else df.repartition(*keys)
    return dealt.sortWithinPartitions(*keys, *(order or [])).mapInPandas(over, schema)
