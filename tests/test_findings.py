"""What larger tables and odd inputs have shown."""

import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duelbook import catalog
from duelbook.llm import common, neardup
from duelbook.operators import frames
from duelbook.plans import marts_more as mm
from duelbook.sources import store
from duelbook.sources.adapter import Tables
from duelbook.stats import chain
from duelbook.stats import features as ft
from duelbook.stats import fitted as fi
from duelbook.stats import jobs
from duelbook.stats import preseason as ps
from duelbook.stats import weekly as wk


def test_newton_with_an_empty_partition(spark):
    rng = np.random.default_rng(5)
    data = [(float(x), float(rng.random() < 1 / (1 + np.exp(-x)))) for x in rng.normal(size=300)]
    rows = spark.createDataFrame(data, "x double, y double")
    designs = lambda b: {1: (np.column_stack([np.ones(len(b)), b["x"]]), b["y"].to_numpy())}
    apart = rows.withColumn("k", F.lit(1)).repartition(7, "k").drop("k")  # six of seven are empty
    want, got = (fi.newton(df, designs, {1: 2}, 1e-3)[1] for df in (rows.coalesce(1), apart))
    assert got == pytest.approx(want)


def test_islands_of_points_with_several_rows(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("a", 2, 1), ("a", 5, 0), ("a", 5, 1), ("a", 5, 2), ("b", 7, 0)], "k string, at long, n int")
    got = sorted(tuple(r) for r in frames.islands_of_rows(df, ["k"], "at").collect())
    # As the SQL has it: the distance is taken before rows are made distinct, so 2 stands twice (1 and 0), and 5 twice (3 and 0).
    assert got == [("a", 1, 1), ("a", 2, 1), ("a", 2, 1), ("a", 5, 2), ("a", 5, 2), ("b", 7, 1)]


def test_win_distribution_of_many_contests(spark):
    """60,000 chances: 1.8 billion steps one by one."""
    probs = np.random.default_rng(3).random(60_000)
    df = spark.createDataFrame([(probs.tolist(),)], "p array<double>")
    began = time.time()
    d = np.array(df.select(ps.win_distribution(F.col("p")).alias("d")).first()["d"])
    assert time.time() - began < 60
    at = np.arange(len(probs) + 1)
    assert len(d) == len(at) and d.min() >= 0 and d.sum() == pytest.approx(1)
    assert (d * at).sum() == pytest.approx(probs.sum()) and (d * (at - probs.sum()) ** 2).sum() == pytest.approx((probs * (1 - probs)).sum())


def test_names_that_share_all_but_a_digit(spark):
    """Every name is settled one edit away: no name is compared with those that share its trigrams."""
    c = spark.range(2000).select(F.format_string("Customer#%09d", "id").alias("name"))
    df = jobs.match_entities(c.select(F.concat("name", F.lit("s")).alias("name")), c)
    near, close = jobs.one_edit_pairs(c.select(F.concat("name", F.lit("s")).alias("name")), c.withColumnRenamed("name", "canonical")), 40_000
    assert near.count() < close  # four million pairs share their trigrams
    got = df.collect()
    assert len(got) == 2000 and all(r["canonical"] + "s" == r["name"] and r["tier"] == "fuzzy" and r["confidence"] == pytest.approx(1 - 1 / 19) for r in got)


def test_names_two_edits_away_or_tied(spark):
    names = ["kent state", "kent xx statee", "aubrn", "", "zz"]
    canonical = ["kent state x", "kent state y", "kent statee", "kent x state", "auburn", "aubern", "z"]
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    got = {r["name"]: r["canonical"] for r in jobs.match_entities(frame(names), frame(canonical), 0.8).collect()}
    assert got == {"kent state": "kent statee", "kent xx statee": "kent x state", "aubrn": "aubern"}


def test_careers_are_sorted_where_players_meet(spark):
    """The sort that takes the latest row stands behind the deal of rows by player, not in the few tasks that read them."""
    plan = mm.player_career_stats(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(player_id" in line]
    assert dealt and max(i for i, line in enumerate(plan) if "SortAggregate" in line) < dealt[-1]


def test_store_writes_the_views_asked_for(spark, tmp_path):
    """A lookup over one mart of plays writes that mart and contests, not plays and drives; a view left out is never read from other files' rows."""
    folder, target = "/root/testdata/sf0.001", str(tmp_path / "store")
    first = {r["name"] for r in store.refresh(spark, folder, target, ["play_epa"], views=["games"]).collect()}
    assert first == {"games", "play_epa"}
    assert {r["name"] for r in store.refresh(spark, folder, target, [], views=["games", "drives"]).collect()} == {"games", "play_epa", "drives"}
    want, kept = Tables(spark, folder), store.Stored(spark, folder, store.entries(spark, target))
    assert kept["drives"].exceptAll(want["drives"]).isEmpty() and kept["drives"].count() == want["drives"].count()


def test_replicates_are_summed_where_transitions_lie(spark):
    """Draws of the stated hash, against sums by replicate one by one; a contest's rows are repeated once a block, not once a replicate."""
    state = "d1|standard|z3"
    rows = [("2021+", g, state, "TD" if g % 3 else "PUNT", True, "x") for g in range(300)]
    df = spark.createDataFrame(rows, "era string, game_id long, from_state string, to_state string, first boolean, end string")
    got = chain.cluster_bootstrap_se(df, 60, alpha=0.0)
    draws = df.select("game_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(59).cast("long"))).alias("r")).withColumn("u", F.pmod(F.xxhash64("game_id", "r"), F.lit(1_000_000_000)) / 1e9).collect()
    yes, n = np.zeros(60), np.zeros(60)
    for d in draws:
        k = sum(d["u"] >= p for p in chain.POISSON)
        n[d["r"]] += k
        yes[d["r"]] += k * (d["game_id"] % 3 > 0)
    assert [tuple(r) for r in got.collect()] == [("2021+", state, pytest.approx(np.std(6.97 * yes / n, ddof=1)), 60)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "replicate#" not in plan


def test_packed_contests_give_the_same_designs(spark):
    """Newton steps read a contest as bytes; unpacked, a window's rows are those of its lists, with nulls as before."""
    rng = np.random.default_rng(2)
    side = lambda: [None if x < -1 else float(x) for x in rng.normal(size=3)]
    rows = [(2015 + int(rng.integers(4)), float(i % 2), float(i % 3 > 0), side(), side()) for i in range(50)]
    df = spark.createDataFrame(rows, "season long, neutral double, won double, home array<double>, away array<double>")
    packed = df.mapInPandas(fi._packed_rows, "row binary")
    got = fi._unpacked_rows(packed.toPandas()["row"], 3)
    batch = df.toPandas()
    d, k, _, _ = fi._arrays(batch)
    order = np.argsort(batch["season"].to_numpy(), kind="stable")
    assert (got["d"] == d[order]).all() and (got["k"] == k[order]).all() and (got["season"] == batch["season"].to_numpy()[order]).all()
    assert (got["won"] == batch["won"].to_numpy()[order]).all() and (got["neutral"] == batch["neutral"].to_numpy()[order]).all()


def test_weekly_candidates_are_folded_by_week(spark):
    """The window that folds events reads a row a week: no contest's id is among its columns."""
    t = Tables(spark, "/root/testdata/sf0.001")
    games = wk.screened_contests(t["games"])
    df = wk.as_of_candidates(games, t["drive_scores"], ft.play_events({"games": games, "plays": t["plays"]}))
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Window") and "collect_list(net" in line)
    below = next(line for line in lines[at + 1 :] if line.lstrip(" :+-").startswith(("Aggregate", "Union")))
    assert below.lstrip(" :+-").startswith("Aggregate [team") and "game_id" not in below


def test_weekly_screen_makes_vectors_once(monkeypatch, spark):
    made = []
    monkeypatch.setattr(ft, "fitted_features", lambda t: made.append(1) or spark.range(1))
    monkeypatch.setattr(wk, "week_frame", lambda t, vectors: vectors)
    monkeypatch.setattr(fi, "scores", lambda t, vectors=None: ft.fitted_features(t) if vectors is None else vectors)
    monkeypatch.setattr(wk, "frozen_margins", lambda scored: scored)
    monkeypatch.setattr(wk, "week_screen", lambda frame, margins: frame)
    wk.screen_of_contests(None)
    assert made == [1]


def test_first_label_makes_its_text_once(spark):
    """a filter on the label writes the text's expression out once, not once a pattern, and labels follow the order of patterns."""
    rows = [(1, "PENALTY Holding, pass interference"), (2, "Roughing\nthe Passer"), (3, "Play by FRANCE"), (4, None), (5, "12 MEN on field"), (6, ""), (7, "holding, then offside")]
    df = spark.createDataFrame(rows, "id long, play_text string").withColumn("play_text", F.concat("play_text", F.lit("")))
    got = df.select("id", mm.first_label(F.col("play_text"), mm.INFRACTIONS).alias("label")).filter("label IS NOT NULL")
    assert {r["id"]: r["label"] for r in got.collect()} == {1: "Pass Interference", 2: "Roughing the Passer", 5: "Too Many Men", 7: "Offside"}
    plan = catalog.PLANS["C12"](Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("lower(") <= 2


def test_signatures_hold_few_words_at_once():
    """A batch of 800,000 words: a worker's memory goes with the words that it takes apart at once, not with the batch."""
    rng = np.random.default_rng(1)
    batch = pd.DataFrame({"doc_id": [str(i) for i in range(400)], "row": [b""] * 400, "tokens": list(rng.integers(0, 1 << 60, (400, 2000)))})
    tracemalloc.start()
    try:
        got = sum(len(x) for x in neardup._signed([batch]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == 400 and most < 40_000_000


def test_near_duplicates_send_small_batches(spark, monkeypatch):
    key, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], neardup.stored
    own = spark.conf.get(key)
    monkeypatch.setattr(neardup, "stored", lambda *args, **options: seen.append(spark.conf.get(key)) or write(*args, **options))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z")], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert seen and all(int(x) <= common.BATCH_BYTES for x in seen) and spark.conf.get(key) == own
