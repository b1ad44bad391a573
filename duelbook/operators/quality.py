"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio


def assert_not_empty(df: DataFrame, name: str) -> DataFrame:
    """N1."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def grade(share: Column, warn: float, fail: float) -> Column:
    """PASS, WARN or FAIL of a share of bad rows."""
    return F.when(share > fail, "FAIL").when(share > warn, "WARN").otherwise("PASS")


def parents_without_children(parents: DataFrame, children: DataFrame, keys: list[str], warn: float = 0.0, fail: float = 0.02) -> DataFrame:
    """Number and share of parents that no child refers to, with a grade."""
    met = parents.join(children.select(*keys).distinct().withColumn("_has", F.lit(1)), keys, "left")
    bad = F.count_if(F.col("_has").isNull())
    return met.agg(F.count(F.lit(1)).alias("parents"), bad.alias("missing"), ratio(bad, F.count(F.lit(1))).alias("share")).withColumn("status", grade(F.coalesce("share", F.lit(0.0)), warn, fail))


def reconcile_counts(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """N3."""
    a, b = source.agg(F.count(F.lit(1)).alias("source_rows")), loaded.agg(F.count(F.lit(1)).alias("loaded_rows"))
    return a.crossJoin(b).withColumn("status", F.when(F.col("source_rows") == F.col("loaded_rows"), "PASS").otherwise("FAIL"))


def staleness(freshness: DataFrame) -> DataFrame:
    """Grades of a freshness table (is_stale, row_count)."""
    return freshness.withColumn("status", F.when(F.col("row_count") == 0, "FAIL").when(F.col("is_stale"), "WARN").otherwise("PASS"))


def snapshot_coverage(df: DataFrame, day: str, least: int) -> DataFrame:
    """Rows of the latest snapshot against what it should have."""
    last = df.agg(F.max(day).alias(day))
    return df.join(F.broadcast(last), day).agg(F.count(F.lit(1)).alias("rows")).withColumn("status", F.when(F.col("rows") >= least, "PASS").otherwise("FAIL"))


def scored_coverage(pending: DataFrame, scored: DataFrame, keys: list[str], least: float = 0.9) -> DataFrame:
    """Share of pending rows that have a score."""
    met = pending.join(scored.select(*keys).distinct().withColumn("_has", F.lit(1)), keys, "left")
    return met.agg(F.count(F.lit(1)).alias("pending"), F.count("_has").alias("scored"), ratio(F.count("_has"), F.count(F.lit(1))).alias("share")).withColumn("status", F.when(F.col("share") >= least, "PASS").otherwise("FAIL"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def identity_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows break each rule."""
    return df.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()])


def missing_grid(df: DataFrame, entities: DataFrame, entity: str, year: str, first: int, last: int) -> DataFrame:
    """(entity, year) pairs of the full grid that have no row."""
    grid = entities.select(entity).distinct().withColumn(year, F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
    return grid.join(df.select(entity, year), [entity, year], "left_anti")


def imputation_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows a default would make up, column by column."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def key_overlap(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the first table that the second has."""
    a = one.select(key).filter(F.col(key).isNotNull()).distinct()
    met = a.join(two.select(key).distinct().withColumn("_has", F.lit(1)), key, "left")
    return met.agg(F.count(F.lit(1)).alias("keys"), F.count("_has").alias("matched"), ratio(F.count("_has"), F.count(F.lit(1))).alias("share"))
