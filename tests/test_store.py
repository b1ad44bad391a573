"""The store of marts: served rows equal planned ones, layers hold, runs make only what changed, seasons are replaced alone."""

import dataclasses
import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from duelbook import catalog
from duelbook.plans import marts_base as mb
from duelbook.plans import serve as sv
from duelbook.sources import store
from duelbook.sources.adapter import BASE, Tables

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    """Tables that a test may change."""
    to = tmp_path_factory.mktemp("tables")
    for name in BASE:
        if os.path.exists(f"{FOLDER}/{name}.parquet"):
            shutil.copyfile(f"{FOLDER}/{name}.parquet", to / f"{name}.parquet")
    return str(to)


def test_layers_follow_what_plans_read(spark):
    """A plan asks for the marts that it says it reads, and for no others."""

    class Asking(Tables):
        def mart(self, name):
            asked.add(name)

    for name, one in store.MARTS.items():
        asked = set()
        one.plan(Asking(spark, FOLDER))
        direct = set(one.reads)
        reached = set(direct)
        while more := {r for m in reached for r in store.MARTS[m].reads} - reached:
            reached |= more
        assert direct <= asked <= reached, name
    at = {name: i for i, names in enumerate(store.layers()) for name in names}
    assert set(at) == set(store.MARTS) and all(at[r] < at[m] for m in at for r in store.MARTS[m].reads)
    assert sum(store.layers(["coaching_tenure"]), []) == ["recruiting_class", "team_season_summary", "coaching_tenure"]


def test_runs_and_seasons(spark, copy, tmp_path):
    target, only = str(tmp_path / "store"), ["team_season_trajectory", "team_style_profile", "recruiting_class"]
    first = {e["name"]: e for e in store.refresh(spark, copy, target, only).collect()}
    assert set(first) == {*store.BY_SEASON, "team_season_summary", "game_epa", "team_epa_season", "defensive_havoc", "play_epa", *only}
    served, planned = store.Stored(spark, copy, first), Tables(spark, copy)
    assert rows(sv.down_distance_splits(served, catalog.TEAM, catalog.SEASON)) == rows(sv.down_distance_splits(planned, catalog.TEAM, catalog.SEASON))
    assert rows(mb.game_epa(served).select("game_id", "team", "plays_total")) == rows(mb.game_epa(planned).select("game_id", "team", "plays_total"))
    plan = mb.play_epa(served.of_team(catalog.TEAM, 2017))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [season" in plan.replace("isnotnull(season#", "season#") and "PushedFilters: [Or(" in plan
    assert mb.matchup_history(served, 2016).count() == mb.matchup_history(planned, 2016).count()

    # The same files: nothing is made again.
    again = {e["name"]: e for e in store.refresh(spark, copy, target, only).collect()}
    assert again == first

    # One season loses most of its contests; only its partitions are made anew.
    orders = spark.read.parquet(f"{copy}/orders.parquet")
    season = F.year("o_orderdate") + 20
    orders.filter((season != 2017) | (F.col("o_orderkey") % 4 == 0)).toPandas().to_parquet(f"{copy}/orders.parquet", coerce_timestamps="us")
    untouched = os.path.join(first["play_epa"]["path"].removeprefix("file:"), "season=2016")
    before = sorted(os.listdir(untouched))
    last = {e["name"]: e for e in store.refresh(spark, copy, target, only, seasons=[2017]).collect()}
    assert sorted(os.listdir(untouched)) == before and last["play_epa"]["path"] == first["play_epa"]["path"]
    assert last["team_season_trajectory"]["path"] != first["team_season_trajectory"]["path"] and last["play_epa"]["n_rows"] < first["play_epa"]["n_rows"]
    served, planned = store.Stored(spark, copy, last), Tables(spark, copy)
    for plan in (mb.play_epa, mb.team_season_summary, mb.team_style_profile):
        columns = [c for c, t in plan(planned).dtypes if t != "double"]
        assert rows(plan(served).select(*columns)) == rows(plan(planned).select(*columns))

    # A season without contests goes, partition and rows.
    orders.filter(season != 2017).toPandas().to_parquet(f"{copy}/orders.parquet", coerce_timestamps="us")
    last = {e["name"]: e for e in store.refresh(spark, copy, target, only, seasons=[2017]).collect()}
    assert not mb.play_epa(store.Stored(spark, copy, last)).filter("season = 2017").count()


def test_a_mart_without_rows_keeps_its_last_ones(spark, copy, tmp_path):
    target = str(tmp_path / "store")
    good = {e["name"]: e for e in store.refresh(spark, copy, target, ["recruiting_class"]).collect()}
    customers = spark.read.parquet(f"{copy}/customer.parquet").toPandas()
    customers.iloc[:0].astype(customers.dtypes).to_parquet(f"{copy}/customer.parquet")
    with pytest.raises(ValueError, match="no rows"):
        store.refresh(spark, copy, target, ["recruiting_class"])
    assert store.entries(spark, target)["recruiting_class"] == good["recruiting_class"]


def test_marts_of_a_layer_are_made_at_once(spark, tmp_path, monkeypatch):
    """Two plans that wait for each other: one after another, the first would wait in vain."""
    both, own = threading.Barrier(2, timeout=60), {}

    def waiting(name):
        def plan(t):
            both.wait()
            return own[name].plan(t)

        return plan

    for name in ("recruiting_class", "coach_record"):
        own[name] = store.MARTS[name]
        monkeypatch.setitem(store.MARTS, name, dataclasses.replace(own[name], plan=waiting(name)))
    got = {e["name"]: e for e in store.refresh(spark, FOLDER, str(tmp_path / "store"), list(own), views=[]).collect()}
    served, planned = store.Stored(spark, FOLDER, got), Tables(spark, FOLDER)
    assert set(got) == set(own)
    for name, one in own.items():
        assert rows(served.mart(name)) == rows(one.plan(planned))


def test_a_refresh_leaves_no_shuffle_files(spark, tmp_path):
    """shuffle files go with the job that made them, tables are packed closer, and the session's setting is as before."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    dirs = [str(d) for d in env.blockManager().diskBlockManager().localDirsString()]
    lying = lambda: {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = lying(), spark.conf.get(key)
    made = store.refresh(spark, FOLDER, str(tmp_path / "store"), ["game_epa", "play_epa"])
    last = time.time() + 60
    while lying() - before and time.time() < last:  # files are removed behind the job
        time.sleep(0.2)
    assert not lying() - before and spark.conf.get(key) == own
    got = {e["name"]: e for e in made.collect()}
    files = os.listdir(os.path.join(got["plays"]["path"].removeprefix("file:"), "season=2017"))
    assert all(f.endswith(".zstd.parquet") for f in files if f.endswith(".parquet"))
