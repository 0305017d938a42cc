"""Structured Streaming twins of the sliding counts and monitors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loanloom.operators.binning import left_closed_bin
from loanloom.sources.sinks import run_folder

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Event files as a stream, with the device taken from the payload."""
    options = {"pathGlobFilter": pattern} | ({"maxFilesPerTrigger": files_per_batch} if files_per_batch else {})
    raw = spark.readStream.schema(EVENT_SCHEMA).options(**options).parquet(folder)
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("long").alias("device_id"))


def hopping_counts(events: DataFrame, entity: str, at: str = "ts", window: str = "1 hour", slide: str = "5 minutes", late: str = "10 minutes"):
    """Distinct active seconds per entity and hopping window.

    A second of an entity counts once: repeats are dropped first, and both states are bounded by the
    watermark.
    """
    seconds = events.select(entity, F.date_trunc("second", at).alias("second")).withWatermark("second", late)
    once = seconds.dropDuplicates([entity, "second"])
    return once.groupBy(F.window("second", window, slide), entity).agg(F.count("*").alias("n_seconds"))


def rolling_bad_rate(events: DataFrame, bad, at: str = "ts", window: str = "7 days", slide: str = "1 day", late: str = "10 minutes"):
    """Mean of a 0/1 expression over hopping windows: first-payment default of the last days."""
    flagged = events.withWatermark(at, late).select(at, bad.cast("double").alias("_bad"))
    return flagged.groupBy(F.window(at, window, slide)).agg(F.avg("_bad").alias("rate"), F.count("*").alias("n"))


def daily_bins(events: DataFrame, column: str, edges, at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Counts per day and baseline bin; the PSI of a day follows from these few rows."""
    return events.withWatermark(at, late).groupBy(
        F.window(at, "1 day"), left_closed_bin(column, edges, open_ends=True).alias("bin")).agg(F.count("*").alias("n"))


TRAIL_SCHEMA = "entity long, second long, n_recent long"
#: a bucket is this many windows long; its last window is also the context of the next bucket
BUCKET_WINDOWS = 4


class TrailingCounts(StatefulProcessor):
    """State of one (entity, time bucket): its distinct seconds, those of the window before it included.

    A second is emitted once, when the watermark has passed it: earlier rows cannot come any more, so the count is final, and
    the seconds of an entity go out in order whatever batches they came in. One timer stands at the next second to close; a call
    works on one bucket, at most (1 + BUCKET_WINDOWS) x window seconds, however active or long-lived the entity is. The state
    goes when the bucket's last second has gone out; later rows of the bucket are behind the watermark and dropped by Spark.
    """

    def __init__(self, window_seconds: int):
        self.window, self.length = window_seconds, BUCKET_WINDOWS * window_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getValueState("seconds", "packed binary")  # sorted, eight bytes each: one value, one call to read or write
        self.emitted = handle.getValueState("emitted", "upto long")  # own seconds up to here have gone out

    def _seen(self) -> np.ndarray:
        return np.frombuffer(bytes(self.seconds.get()[0]), "<i8") if self.seconds.exists() else np.zeros(0, "<i8")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = np.unique(np.concatenate([r["second"].to_numpy() for r in rows]))
        self.seconds.update((np.union1d(self._seen(), fresh).astype("<i8").tobytes(),))
        own = fresh[fresh >= key[1] * self.length]
        if len(own):
            self._wake_at(int(own[0]))
        elif next(self.handle.listTimers(), None) is None:  # context alone: kept until its bucket is over
            self._wake_at((key[1] + 1) * self.length - 1)
        yield pd.DataFrame({"entity": [], "second": [], "n_recent": []}, dtype="int64")

    def _wake_at(self, second: int) -> None:
        """The one timer of the key is at the earliest second asked for."""
        wanted, standing = (second + 1) * 1000, list(self.handle.listTimers())
        if standing and min(standing) <= wanted:
            return
        for t in standing:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(wanted)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() // 1000 - 1  # the last second that is over
        seconds = self._seen()
        upto = self.emitted.get()[0] if self.emitted.exists() else key[1] * self.length - 1
        due = seconds[(seconds > upto) & (seconds <= closed)]
        n = np.searchsorted(seconds, due, side="right") - np.searchsorted(seconds, due - self.window, side="right")
        left = seconds[seconds > max(closed, upto)]
        end = (key[1] + 1) * self.length - 1
        if closed >= end:
            self.seconds.clear()
            self.emitted.clear()
        else:
            self.emitted.update((int(max(closed, upto)),))
            self.handle.registerTimer((int(left[0] if len(left) else end) + 1) * 1000)  # the expired one goes by itself
        yield pd.DataFrame({"entity": np.full(len(due), key[0], "int64"), "second": due, "n_recent": n.astype("int64")})

    def close(self) -> None:
        pass


def exact_trailing_counts(events: DataFrame, entity: str, at: str = "ts", window_seconds: int = 3600, late: str = "10 minutes") -> DataFrame:
    """(entity, second, n_recent): distinct active seconds in (second - window, second], exact over any batches.

    A second appears when the watermark (``late`` behind the newest event) has passed it, and never again; events later than
    that are dropped. Rows without an entity are left out. Run it with ``store=ROCKS``.
    """
    length = BUCKET_WINDOWS * window_seconds
    second = F.unix_seconds(at)
    bucket = F.floor(second / length)
    # rows without an entity still move the watermark: they leave behind it, through a condition that a filter below could not have
    keyed = events.withWatermark(at, late).select(F.col(entity).cast("long").alias("entity"), at, second.alias("second"), bucket.alias("own"))
    # the last window of a bucket is handed on as context
    both = F.when(F.col("entity").isNull(), F.array().cast("array<bigint>")).when(
        F.col("second") % length >= length - window_seconds, F.array(F.col("own"), F.col("own") + 1)).otherwise(F.array("own"))
    spread = keyed.select("entity", at, "second", F.explode(both).alias("bucket"))
    return spread.groupBy("entity", "bucket").transformWithStateInPandas(
        TrailingCounts(window_seconds), outputStructType=TRAIL_SCHEMA, outputMode="append", timeMode="EventTime")


def replay(events: DataFrame, at: str, name: str, slices: int, jitter_seconds: int, quiet: str) -> str:
    """A folder with the events as a file source would find them: written in slices of time, one after another.

    Events move between slices by up to ``jitter_seconds`` (hash of the row), so that files are out of order and overlap. The last
    file holds one event without content, ``quiet`` behind the newest one: it stands for the time that goes on after the end.
    """
    path = run_folder(events.sparkSession, name)
    span = events.agg(F.min(F.unix_seconds(F.col(at).cast("timestamp"))).alias("a"), F.max(F.unix_seconds(F.col(at).cast("timestamp"))).alias("b"),
                      F.max(at).alias("newest")).first()
    moved = F.unix_seconds(F.col(at).cast("timestamp")) + F.pmod(F.xxhash64(*events.columns), F.lit(jitter_seconds)) - F.lit(span["a"])
    slot = F.floor(moved * slices / F.lit(span["b"] - span["a"] + jitter_seconds + 1))
    for i in range(slices):
        events.where(slot == i).write.mode("append").parquet(path)
    last = events.sparkSession.range(1).select(*[
        (F.lit(span["newest"]) + F.expr(f"INTERVAL {quiet}") if c == at else F.lit(None)).cast(events.schema[c].dataType).alias(c) for c in events.columns])
    last.write.mode("append").parquet(path)
    return path


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(df: DataFrame, name: str, store: str | None = None) -> DataFrame:
    """Drain what is there into parquet below the shared folder and read it back; ``store`` is the state store of this query."""
    spark = df.sparkSession
    base = run_folder(spark, name)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    if store:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    try:  # a query keeps the setting it started with
        started = (
            df.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
            .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    started.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def watch_daily(events: DataFrame, column: str, baseline: DataFrame, edges, name: str, alert: float = 0.1) -> DataFrame:
    """Each closed day against the baseline shares (bin, share). A micro-batch writes a folder of its own, so that one that runs
    again after a failure replaces its rows."""
    spark = events.sparkSession
    base = run_folder(spark, name)
    spine = baseline.select("bin", "share")

    def add(batch: DataFrame, number: int) -> None:
        day = batch.select(F.col("window.start").alias("day"), "bin", "n")
        total = day.groupBy("day").agg(F.sum("n").alias("t"))
        grid = total.withColumn("_s", F.lit(1)).join(F.broadcast(spine.withColumn("_s", F.lit(1))), "_s").drop("_s")  # one row per bin
        now = F.coalesce(F.col("n") / F.col("t"), F.lit(0.0)) + 1e-6
        was = F.col("share") + 1e-6
        psi = grid.join(day, ["day", "bin"], "left").groupBy("day").agg(F.sum((now - was) * F.log(now / was)).alias("psi"))
        psi.withColumn("status", F.when(F.col("psi") > alert, "ALERT").otherwise("OK")).write.mode("overwrite").parquet(
            f"{base}/out/batch={number}")

    q = (
        daily_bins(events, column, edges).writeStream.outputMode("append").foreachBatch(add)
        .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("day timestamp, psi double, status string, batch long").parquet(f"{base}/out").drop("batch")
