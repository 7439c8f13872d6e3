"""Run ledgers as streams: latest states, stalled runs, rates.  The batch operators hold for a bounded
table; these keep the same answers up to date."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tilewright.shipping import ship

EVENTS = "slide long, ts timestamp, state string, seconds double, fingerprint string"


def events(spark: SparkSession, path: str, schema: str = EVENTS, per_trigger: int = 100) -> DataFrame:
    """Status events from a folder to which files are added."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def latest_state(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """(slide, ts, state) of each slide's latest event; a late event never replaces a newer one.  With a
    watermark, to be written in update mode, slides are still kept: they are the key."""
    rows = stream.withWatermark("ts", watermark) if watermark else stream
    best = rows.groupBy("slide").agg(F.max(F.struct("ts", "state")).alias("b"))
    return best.select("slide", "b.ts", "b.state")


def rates(stream: DataFrame, window: str = "10 minutes", slide: str | None = None, watermark: str = "1 hour") -> DataFrame:
    """(start, state, n, seconds): events of each state in tumbling or sliding windows."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    got = stream.withWatermark("ts", watermark).groupBy(w.alias("w"), "state").agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds"))
    return got.select(F.col("w.start").alias("start"), "state", "n", "seconds")


def stalls(stream: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """(slide, start, end, n): sessions of a slide's events, closed by a gap without any."""
    got = stream.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("w"), "slide").agg(F.count(F.lit(1)).alias("n"))
    return got.select("slide", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def new_work(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Events whose slide and fingerprint were not seen before, within the watermark."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["slide", "fingerprint"])


def reconciled(stream: DataFrame, timeout: timedelta = timedelta(hours=1), watermark: str = "1 minute") -> DataFrame:
    """(slide, state, ts, reason): what becomes of each run.  A slide that says running and then nothing for the
    timeout (in event time) has failed; every other change of state passes through."""
    ship(stream.sparkSession)
    wait = int(timedelta(seconds=timeout.total_seconds()).total_seconds() * 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (since,) = state.get
            state.remove()
            yield pd.DataFrame({"slide": [key[0]], "state": ["failed"], "ts": [pd.Timestamp(since, unit="ms")], "reason": ["no event before the timeout"]})
            return
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        last = rows.iloc[-1]
        at = int(last["ts"].value // 1_000_000)
        if state.exists and at < state.get[0]:
            return  # late: something newer is known
        if last["state"] == "running":
            state.update((at,))
            state.setTimeoutTimestamp(max(at + wait, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"slide": [key[0]], "state": [last["state"]], "ts": [last["ts"]], "reason": [None]})

    rows = stream.withWatermark("ts", watermark).select("slide", "ts", "state")
    return rows.groupBy("slide").applyInPandasWithState(step, "slide long, state string, ts timestamp, reason string", "since long", "append", GroupStateTimeout.EventTimeTimeout)


def run_once(frame: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Processes what is there now into a table in memory, and ends; the next call goes on from there."""
    query = frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return frame.sparkSession.table(name)
