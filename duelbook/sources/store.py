"""Store of marts: written layer by layer, in the order of what reads what, and served from there.

``refresh`` writes the views of contests, plays and drives by season (layer 0), then the marts: those that read no other mart, those
that read these, and so on. Each plan runs over what the layers before it have written, so plays are derived once, not once a
mart. A ledger row a table says where its rows lie, how many they are and from which input files they were made: a run makes only
what is missing or was made from other files, and a run that was cut off goes on with the next table. Readers follow the
ledger, so a table that failed half-way is never read. ``Stored`` takes the place of ``Tables`` for every plan and lookup.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .adapter import BASE, Tables
from .io import files_of

#: Views that are written by season before any mart.
BY_SEASON = ("games", "plays", "drives")
#: Tables of a layer whose jobs are handed to Spark at once; their tasks share the same cores.
AT_ONCE = 6
LEDGER = "name string, layer long, path string, columns string, schema string, n_rows long, made_from string, written_at timestamp, seconds double"


@dataclass(frozen=True)
class Mart:
    """``reads``: the marts its plan reads. ``by``: 'season' if its rows of a season come from that season alone ('game': the same, by game_id), else None."""

    plan: Callable[[Tables], DataFrame]
    reads: tuple[str, ...]
    by: str | None
    may_be_empty: bool


MARTS: dict[str, Mart] = {}


def mart(*reads: str, by: str | None = None, may_be_empty: bool = False):
    """Registers a plan as a mart: called with tables that have it stored, and with no other argument, it gives the stored rows."""

    def register(plan):
        MARTS[plan.__name__] = Mart(plan, reads, by, may_be_empty)

        @functools.wraps(plan)
        def served(t, *args, **kwargs):
            kept = t.mart(plan.__name__) if isinstance(t, Tables) and not (args or kwargs) else None
            return plan(t, *args, **kwargs) if kept is None else kept

        return served

    return register


def layers(only: Iterable[str] | None = None) -> list[list[str]]:
    """The marts (``only`` these and what they read) in layers; each reads earlier layers alone."""
    asked, open_ = set(), list(MARTS if only is None else only)
    while open_:
        name = open_.pop()
        if name not in asked:
            asked.add(name)
            open_ += MARTS[name].reads
    order = TopologicalSorter({name: MARTS[name].reads for name in asked})
    order.prepare()
    out = []
    while order.is_active():
        ready = sorted(order.get_ready())
        order.done(*ready)
        out.append(ready)
    return out


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Of the input files: their names, sizes and times of change, as the file system lists them. A table that is missing has none."""
    found = []
    for name in BASE:
        files, maker = files_of(spark, f"{folder}/{name}.parquet")
        at = maker(f"{folder}/{name}.parquet")
        if files.exists(at):
            every = files.listFiles(at, True)
            while every.hasNext():
                one = every.next()
                found.append(f"{one.getPath()} {one.getLen()} {one.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """The last entry of each table of the store; no rows where there is no store."""
    path = f"{target}/_ledger"
    files, maker = files_of(spark, path)
    if not files.exists(maker(path)):
        return spark.createDataFrame([], LEDGER)
    every = spark.read.schema(LEDGER).parquet(path)
    return every.groupBy("name").agg(F.max_by(F.struct(*every.columns), F.struct("written_at", "path")).alias("last")).select("last.*")


def entries(spark: SparkSession, target: str) -> dict[str, Row]:
    """The store's ledger by table: a row for each of a fixed number of tables."""
    return {e["name"]: e for e in ledger(spark, target).collect()}


class Stored(Tables):
    """Tables whose views of contests, plays and drives, and whose marts, are read from a store when asked for; what it lacks is planned as ever."""

    def __init__(self, spark: SparkSession, folder: str, known: dict[str, Row], seasons: Iterable[int] | None = None, team: str | None = None):
        super().__init__(spark, folder)
        self._known, self._seasons, self._team, self._marts = known, None if seasons is None else list(seasons), team, {}

    def _rows(self, name: str) -> DataFrame:
        e = self._known[name]
        rows = self.spark.read.schema(StructType.fromJson(json.loads(e["schema"]))).parquet(e["path"])
        if self._seasons is not None and (name in BY_SEASON or MARTS[name].by):
            rows = rows.filter(F.col("season").isin(*self._seasons))
        if self._team is not None and name == "games":
            rows = rows.filter((F.col("home_team") == self._team) | (F.col("away_team") == self._team))
        elif self._team is not None and name in ("plays", "drives", "play_epa"):
            rows = rows.filter((F.col("offense") == self._team) | (F.col("defense") == self._team))
        return rows.select(*json.loads(e["columns"]))

    def _view(self, name: str) -> DataFrame:
        return self._rows(name) if name in BY_SEASON and name in self._known else super()._view(name)

    def mart(self, name: str) -> DataFrame | None:
        if name in self._known and name not in self._marts:
            self._marts[name] = self._rows(name)
        return self._marts.get(name)

    def of_team(self, team: str | None, season: int | None) -> Tables:
        return Stored(self.spark, self.folder, self._known, None if season is None else [season], team)

    def of_seasons(self, seasons: Iterable[int]) -> Tables:
        return Stored(self.spark, self.folder, self._known, seasons)


def _swap(spark: SparkSession, fresh: str, path: str, seasons: list[int]) -> None:
    """Puts the seasons' partitions of ``fresh`` in the place of those of ``path``; a season without new rows goes."""
    files, maker = files_of(spark, path)
    for season in seasons:
        old, new = maker(f"{path}/season={season}"), maker(f"{fresh}/season={season}")
        files.delete(old, True)
        if files.exists(new):
            files.rename(new, old)
    files.delete(maker(fresh), True)
    spark.catalog.refreshByPath(path)


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a job's shuffle files are removed when it ends, not when the driver collects its garbage: else those of all tables lie on the disks together."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, own)


def refresh(spark: SparkSession, folder: str, target: str, only: Iterable[str] | None = None, seasons: Iterable[int] | None = None, force: bool = False, views: Iterable[str] = BY_SEASON) -> DataFrame:
    """Brings the store at ``target`` up to date with the tables of ``folder``; returns the ledger (a row a table).

    ``only``: these marts and what they read. ``views``: the views to write; others are planned, unless they are stored from these files. ``seasons``: the only seasons whose rows have changed (the caller's word): tables by season
    get new partitions for them, made from these seasons alone; the others are made anew from the stored layers. Without it a
    table that was made from other files is made anew in a folder of its own. ``force`` makes everything anew, as after a
    change of plans. A mart without rows raises an error, unless it may be empty, and its last rows stay the ones that are
    served. Every task writes the rows that it has of each season, so that no table is moved once more to be written, and a season
    that holds most rows is many files, not one task's. A table's shuffle files go as soon as it is written.
    Tables of a layer are made AT_ONCE at a time, as most of their stages are too short or narrow to fill a cluster; where one fails, the others of its layer are still written.
    A run that was cut off between two partitions leaves the ledger's entry out of date: the next run mends it.
    """
    mark, seasons = fingerprint(spark, folder), None if seasons is None else sorted(set(seasons))
    views = [n for n in BY_SEASON if n in set(views)]
    known = {n: e for n, e in entries(spark, target).items() if n not in BY_SEASON or n in views or e["made_from"] == mark}

    def make(name: str, layer: int) -> Row:
        """Writes one table, which reads earlier layers alone, and returns its entry."""
        last, began = known.get(name), time.time()
        part = seasons is not None and last is not None and not force and (name in BY_SEASON or MARTS[name].by is not None)
        if name in BY_SEASON:
            t = Tables(spark, folder, {n: Stored(spark, folder, known)[n] for n in BY_SEASON[: BY_SEASON.index(name)]})
            rows, by = (t.of_seasons(seasons) if part else t)[name], "season"
        else:
            t = Stored(spark, folder, known, seasons if part else None)
            rows, by = MARTS[name].plan(t), MARTS[name].by
        columns = rows.columns
        if by == "game":
            rows = rows.join(t["games"].select(F.col("id").alias("game_id"), "season"), "game_id", "left")
        path = last["path"] if part else f"{target}/{name}-{uuid.uuid4().hex}"
        to = f"{path}.next-{uuid.uuid4().hex}" if part else path
        rows.write.option("compression", "zstd").partitionBy(*(["season"] if by else [])).parquet(to)
        if part:
            _swap(spark, to, path, seasons)
        n = spark.read.schema(rows.schema).parquet(path).count()
        if not n and name in MARTS and not MARTS[name].may_be_empty:
            raise ValueError(f"{name} has no rows")
        return Row(name=name, layer=layer, path=path, columns=json.dumps(columns), schema=rows.schema.json(), n_rows=n, made_from=mark, written_at=None, seconds=time.time() - began)

    with _shuffles_removed(spark):
        # Contests come before plays, and plays before drives; the marts of a layer do not read each other.
        for layer, names in [*((0, [n]) for n in views), *enumerate(layers(only), 1)]:
            due = [n for n in names if force or n not in known or known[n]["made_from"] != mark]
            made, failed = {}, []
            with ThreadPoolExecutor(AT_ONCE) as pool:
                for done in as_completed([pool.submit(inheritable_thread_target(spark)(make), n, layer) for n in due]):
                    if done.exception() is not None:
                        failed.append(done.exception())
                        continue
                    e = done.result()
                    made[e["name"]] = e
                    # Entries are appended here alone, one after another: two writers of a folder would clear each other's files.
                    spark.createDataFrame([e], LEDGER).withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{target}/_ledger")
            known |= made
            if failed:
                raise failed[0]
    return ledger(spark, target)


def store_of(spark: SparkSession, folder: str) -> str:
    """Where this application keeps the marts of a folder: in ``spark.checkpoint.dir``. A local master without it takes a temporary folder; a cluster raises an error."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = os.path.join(tempfile.gettempdir(), "duelbook-shared")
    return f"{shared.rstrip('/')}/duelbook-{spark.sparkContext.applicationId}/marts-{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def over_store(plan: Callable[[Tables], DataFrame], *only: str, views: Iterable[str] = BY_SEASON) -> Callable[[Tables], DataFrame]:
    """A plan or lookup over this application's store, brought up to date first: these marts and views; what is stored from other files is not read."""

    def run(t: Tables) -> DataFrame:
        target = store_of(t.spark, t.folder)
        refresh(t.spark, t.folder, target, only, views=views)
        mark = fingerprint(t.spark, t.folder)
        return plan(Stored(t.spark, t.folder, {n: e for n, e in entries(t.spark, target).items() if e["made_from"] == mark}))

    return run


def refreshed(t: Tables) -> DataFrame:
    """Every mart of this application's store with its layer and number of rows."""
    rows = refresh(t.spark, t.folder, store_of(t.spark, t.folder))
    return rows.filter(~F.col("name").isin(*BY_SEASON)).select("name", "layer", "n_rows")
