"""Snapshot feeds as Structured Streaming jobs, each with a batch twin."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RELEVANT = ["view", "click", "purchase"]
CAPTURE = "game_id long, captured_at timestamp_ntz, event_id long, status string, points long, state_hash string"


def changes(captures: DataFrame) -> DataFrame:
    """I1, batch: captures whose state differs from the one stored before; A B A gives three rows."""
    w = Window.partitionBy("game_id").orderBy("captured_at", "event_id")
    return captures.withColumn("_p", F.lag("state_hash").over(w)).filter("_p IS NULL OR _p <> state_hash").drop("_p")


def _timed(captures: DataFrame, names: list[str], ttl_ms: int):
    """Captures by contest, with a watermark on the capture time."""
    return captures.select(*names, F.col("captured_at").cast("timestamp").alias("_at")).withWatermark("_at", f"{ttl_ms} milliseconds").groupBy("game_id")


def _keep_until(state: GroupState, rows: pd.DataFrame, ttl_ms: int) -> None:
    last = int(rows["_at"].max().timestamp() * 1000)
    state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + ttl_ms)


def changes_stream(captures: DataFrame, columns: str = CAPTURE, ttl_ms: int = 7 * 86_400_000) -> DataFrame:
    """I1, stream: the state of a contest is its last stored hash; it goes when event time is a week past its last capture.

    Captures of over a week behind the watermark are late and left out.
    """
    names = [c.split()[0] for c in columns.split(", ")]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["captured_at", "event_id"])
        before = rows["state_hash"].shift(1)
        before.iloc[0] = state.get[0] if state.exists else None
        state.update((rows["state_hash"].iloc[-1],))
        _keep_until(state, rows, ttl_ms)
        yield rows.loc[(before.isna() | (before != rows["state_hash"])).to_numpy(), names]

    return _timed(captures, names, ttl_ms).applyInPandasWithState(step, columns, "last string", "append", GroupStateTimeout.EventTimeTimeout)


def capture(stream: DataFrame, path: str, checkpoint: str):
    """Append-only capture; each micro-batch has one run timestamp."""

    def save(batch: DataFrame, epoch: int) -> None:
        run = batch.sparkSession.range(1).select(F.current_timestamp().alias("run_at"))
        batch.crossJoin(F.broadcast(run)).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_in_horizon(stream: DataFrame, hours: int = 24) -> DataFrame:
    """I3, stream (update mode): the last capture of each contest whenever it moves on; state goes after the horizon.

    ``live_now`` of what was emitted is the batch twin's result.
    """
    names = [c.split()[0] for c in CAPTURE.split(", ")]
    ttl_ms = hours * 3_600_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches))
        newest = rows.sort_values(["captured_at", "event_id"]).iloc[[-1]]
        at = (int(newest["_at"].iloc[0].value), int(newest["event_id"].iloc[0]))
        if not state.exists or at > tuple(state.get):
            state.update(at)
            yield newest[names]
        _keep_until(state, rows, ttl_ms)

    return _timed(stream, names, ttl_ms).applyInPandasWithState(step, CAPTURE, "at long, event_id long", "update", GroupStateTimeout.EventTimeTimeout)


def live_now(emitted: DataFrame, hours: int = 24) -> DataFrame:
    """The last capture of each contest, of those inside the horizon before the newest one."""
    last = emitted.groupBy("game_id").agg(F.max_by(F.struct("captured_at", "event_id", "status", "points", "state_hash"), F.struct("captured_at", "event_id")).alias("s")).select("game_id", "s.*")
    newest = emitted.agg(F.max("captured_at").alias("_newest"))
    return last.crossJoin(F.broadcast(newest)).filter(F.col("captured_at") > F.col("_newest") - F.expr(f"INTERVAL {hours} HOURS")).drop("_newest")  # one row


def normal_status(df: DataFrame, column: str = "status") -> DataFrame:
    """Statuses in lower case with underscores; only those that matter."""
    return df.withColumn(column, F.replace(F.lower(F.trim(column)), F.lit(" "), F.lit("_"))).filter(F.col(column).isin(RELEVANT))


def enriched(df: DataFrame, ratings: DataFrame) -> DataFrame:
    """Stream or batch rows with a rating dimension and a closed-form probability."""
    from ..functions.exprs import live_win_probability

    return df.join(ratings, "game_id", "left").withColumn("win_prob", live_win_probability(F.col("points").cast("double"), F.coalesce("expected", F.lit(0.0)), F.lit(1800)))
