"""Reading flat and nested files, and write modes: merge, append, replace, partition replace, daily snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.frames import numbered


def scan_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A3: nested records with an explicit schema; children stay arrays of structs."""
    return spark.read.schema(schema).json(path)


def scan_flat(spark: SparkSession, path: str, required: list[str], kind: str = "csv", key: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A4: (rows with a key, one-row frame with the number dropped). A missing required column raises an error."""
    df = spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.parquet(path)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    has = F.lit(True)
    for c in key:
        has = has & F.col(c).isNotNull()
    return df.filter(has), df.agg(F.count_if(~has).alias("dropped"))


def wide_matrix_to_long(df: DataFrame, fixed: list[str], values: list[str]) -> DataFrame:
    """One row for each filled cell of a ranking matrix, with the number of filled systems of its row."""
    cells = F.array(*[F.struct(F.lit(v).alias("system"), F.col(v).cast("string").alias("rank")) for v in values])
    filled = F.filter(cells, lambda c: c["rank"].isNotNull() & (F.trim(c["rank"]) != ""))
    return df.select(*fixed, filled.alias("f")).select(*fixed, F.size("f").alias("n_systems"), F.explode("f").alias("c")).select(*fixed, "n_systems", "c.system", F.col("c.rank").cast("long").alias("rank"))


def pair_consecutive_rows(df: DataFrame, group: list[str], order: list[str], kind: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejects): rows 1-2, 3-4, ... of a group as visitor and home (kinds V H or N N); other pairs are rejects."""
    rows = numbered(df, group, order, "_r").withColumns({"_pair": F.expr("_r div 2"), "_second": F.expr("_r % 2")})
    pick = lambda c, k: F.max(F.when(F.col("_second") == k, F.col(c)))
    pairs = rows.groupBy(*group, "_pair").agg(F.concat(pick(kind, 0), pick(kind, 1)).alias("_kinds"), *[pick(v, 0).alias(f"visitor_{v}") for v in values], *[pick(v, 1).alias(f"home_{v}") for v in values])
    good = F.coalesce(F.col("_kinds").isin("VH", "NN"), F.lit(False))
    return pairs.filter(good).drop("_kinds"), pairs.filter(~good)


def split_spread_total(visitor: Column, home: Column) -> tuple[Column, Column]:
    """Of two numbers beside a contest the larger is the total, the smaller the spread; its sign says which side gives points."""
    both = visitor.isNotNull() & home.isNotNull()
    total, line = F.greatest(visitor, home), F.least(visitor, home)
    return F.when(both, F.when(home < visitor, -line).otherwise(line)), F.when(both, total)


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, the new one where a key is in both; repeated new keys: the last by all columns."""
    tagged = new.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    rest = [F.col(c).desc_nulls_last() for c in tagged.columns if c not in keys and c != "_new"]
    return tagged.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_new").desc(), *rest))).filter("_rn = 1").drop("_rn", "_new")


def files_of(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path's maker."""
    maker = spark._jvm.org.apache.hadoop.fs.Path
    return maker(path).getFileSystem(spark._jsc.hadoopConfiguration()), maker


def write_merge(df: DataFrame, path: str, keys: list[str], partition: str | None = None) -> None:
    """A9 on disk. The merged table goes to a fresh folder beside the target and takes its place by renaming; a run that was cut
    off between the two renames is mended by the next one.

    With ``partition`` (a column whose value a key never changes), only partitions that have new rows are read and replaced.
    """
    spark = df.sparkSession
    files, maker = files_of(spark, path)
    target, fresh, old = maker(path), maker(path + ".next"), maker(path + ".old")
    if not files.exists(target) and files.exists(old):
        files.rename(old, target)
    if not files.exists(target):
        merged(df.limit(0), df, keys).write.mode("overwrite").partitionBy(*([partition] if partition else [])).parquet(path)
        return
    now = spark.read.parquet(path)
    if partition:
        touched = df.select(partition).distinct()
        out = merged(now.join(touched, partition, "left_semi"), df, keys)
        out.write.mode("overwrite").parquet(path + ".next")
        write_partition_replace(spark.read.parquet(path + ".next"), path, partition)
        files.delete(fresh, True)
        return
    merged(now, df, keys).write.mode("overwrite").parquet(path + ".next")
    files.delete(old, True)
    files.rename(target, old)
    files.rename(fresh, target)
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_append(df: DataFrame, path: str) -> None:
    """A10."""
    df.write.mode("append").parquet(path)


def write_replace(batches: list[DataFrame], path: str) -> None:
    """The first batch replaces, the others are appended."""
    for i, df in enumerate(batches):
        df.write.mode("append" if i else "overwrite").parquet(path)


def write_partition_replace(df: DataFrame, path: str, partition: str) -> None:
    """Replaces only the partitions that have new rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_daily_snapshot(df: DataFrame, path: str, keys: list[str], day: str) -> None:
    """Idempotent within a day, immutable across days."""
    write_partition_replace(df.withColumn("snapshot_date", F.lit(day)).dropDuplicates(keys), path, "snapshot_date")


def incremental_antijoin(candidates: DataFrame, loaded: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """(up to ``most`` keys not loaded yet, in order; one-row frame with the whole backlog)."""
    new = candidates.select(*keys).distinct().join(loaded.select(*keys).distinct(), keys, "left_anti")
    return new.orderBy(*keys).limit(most), new.agg(F.count(F.lit(1)).alias("backlog"))


def orphan_filter(children: DataFrame, parents: DataFrame, keys: list[str], max_drop: float = 0.25) -> DataFrame:
    """Children with a parent; raises an error if more than ``max_drop`` of them have none."""
    kept = children.join(parents.select(*keys).distinct(), keys, "left_semi")
    n, k = children.count(), kept.count()
    if n and (n - k) / n > max_drop:
        raise ValueError(f"{n - k} of {n} rows have no parent")
    return kept


def hash_skip(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files (path, content) whose content is not in the ledger (file_sha256) yet."""
    return files.withColumn("file_sha256", F.sha2("content", 256)).join(ledger.select("file_sha256"), "file_sha256", "left_anti")


def target_seasons(games: DataFrame) -> DataFrame:
    """The latest season with a finished contest, and all later ones with a schedule."""
    last = games.agg(F.max(F.when(F.col("completed"), F.col("season"))).alias("_last"))
    return games.select("season").distinct().crossJoin(F.broadcast(last)).filter(F.col("season") >= F.col("_last")).select("season")  # one row


def scheduled_entities(games: DataFrame, seasons: list[int]) -> DataFrame:
    """The sides of any contest in the seasons."""
    return games.filter(F.col("season").isin(seasons)).select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()
