"""Checkpoints of decisions on a stream: captured at the last completed bar before them, or missed for good.

The batch rule looks back from each checkpoint once its bars can no longer come; the stream gives the same result by event time. Rows may be
late by the watermark's delay. Both kinds of rows are dealt by (symbol, time bucket), a bar also to the next bucket if checkpoints there
reach back to it, so no symbol is one task's and a key's state is bounded by a bucket's rows. A key's timer fires when the watermark
has passed its bucket: every bar that may still arrive has arrived, the checkpoints are given out, and the state is cleared.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: How far back the last bar may lie, and how late a row may come before a checkpoint is missed (fixed values).
REACH_SECONDS, RETRY = 30 * 60, "2 hours"
#: How much time of a symbol is one key's.
BUCKET_SECONDS = 2 * 3600
#: The bucket of rows that only tell the time.
NO_BUCKET = -(2**40)
COLUMNS = ["symbol", "id", "scheduled_at", "status", "bar_ts", "price", "return_pct"]
RESULT = "symbol string, id long, scheduled_at timestamp, status string, bar_ts timestamp, price double, return_pct double"


def _bucket(micros: Column) -> Column:
    return F.floor(micros / 1_000_000 / BUCKET_SECONDS).cast("long")


def feed(checkpoints: DataFrame, bars: DataFrame) -> DataFrame:
    """Both kinds of rows in one form: symbol, ts (event time), kind, id, at (scheduled, or the bar's start), value (baseline price, or close).

    checkpoints: symbol, id, selected_at, scheduled_at, selected_price; bars: symbol, bar_ts, close. All times are timestamps.
    """
    c = checkpoints.select("symbol", F.col("selected_at").alias("ts"), F.lit("checkpoint").alias("kind"), "id", F.col("scheduled_at").alias("at"), F.col("selected_price").alias("value"))
    return c.unionByName(bars.select("symbol", F.col("bar_ts").alias("ts"), F.lit("bar").alias("kind"), F.lit(None).cast("long").alias("id"), F.col("bar_ts").alias("at"), F.col("close").alias("value")))


class Tracker(StatefulProcessor):
    """State of one (symbol, bucket): its rows, until the watermark has passed the bucket; times in microseconds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "bar boolean, id long, at long, value double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = [(r.kind == "bar", -1 if r.kind == "bar" else int(r.id), int(r.micros), float(r.value)) for frame in rows for r in frame.itertuples(index=False) if r.kind in ("bar", "checkpoint")]
        if new:
            self.rows.appendList(new)
            self.handle.registerTimer(max((key[1] + 1) * BUCKET_SECONDS * 1000, timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame(columns=COLUMNS)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        rows = list(self.rows.get())
        bars = sorted((at, value) for bar, _, at, value in rows if bar)
        starts, out = [at for at, _ in bars], []
        for bar, own, at, price in rows:
            if not bar:
                before = bisect_left(starts, at) - 1
                found = before >= 0 and starts[before] >= at - REACH_SECONDS * 1_000_000
                start, close = bars[before] if found else (None, None)
                change = (close / price - 1) * 100 if found and price else None
                out.append((key[0], own, pd.Timestamp(at, unit="us"), "captured" if found else "missed", pd.Timestamp(start, unit="us") if found else pd.NaT, close, change))
        self.rows.clear()
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def tracked(stream: DataFrame, retry: str = RETRY) -> DataFrame:
    """Checkpoints of a stream in the form of feed, each given out once, when its bucket and the retry have passed."""
    at = F.unix_micros("at")
    own, next_one = _bucket(at), _bucket(at + REACH_SECONDS * 1_000_000)
    buckets = F.when(F.col("kind") == "bar", F.array_distinct(F.array(own, next_one))).when(F.col("kind") == "checkpoint", F.array(own)).otherwise(F.array(F.lit(NO_BUCKET)))
    rows = stream.withWatermark("ts", retry).select("symbol", "ts", "kind", "id", at.alias("micros"), "value", F.explode(buckets).alias("bucket"))
    return rows.groupBy("symbol", "bucket").transformWithStateInPandas(Tracker(), outputStructType=RESULT, outputMode="append", timeMode="eventTime")


def tracked_batch(checkpoints: DataFrame, bars: DataFrame) -> DataFrame:
    """The batch rule over rows that are all there: the last bar that starts before the checkpoint, at most REACH_SECONDS before."""
    from ..operators.asof import asof

    left = checkpoints.withColumn("left_id", F.struct("symbol", "id"))
    found = asof(left, bars.select("symbol", "bar_ts", F.col("close").alias("price")), "symbol", "scheduled_at", "bar_ts", REACH_SECONDS)
    change = (F.col("price") / F.nullif(F.col("selected_price"), F.lit(0.0)) - 1) * 100
    return found.select("symbol", "id", "scheduled_at", F.when(F.col("bar_ts").isNull(), "missed").otherwise("captured").alias("status"), "bar_ts", "price", change.alias("return_pct"))


def run_step(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all that has landed since the last step, append what has settled, and stop."""
    spark, setting = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(setting, before)
    return query


def replay(rows: DataFrame, arrival: Column, ts: str, transform: Callable[[DataFrame], DataFrame], steps: int, folder: str) -> DataFrame:
    """Land the rows in steps of equal time by arrival, run the stream after each, and last a clock row a day later (all else null) that lets everything settle."""
    spark = rows.sparkSession
    dealt = rows.withColumn("arrived", F.unix_micros(arrival))
    low, high, last = dealt.agg(F.min("arrived"), F.max("arrived"), F.max(ts)).first()
    if low is None:
        return transform(rows)
    step = F.least(F.floor((F.col("arrived") - low) * steps / (high - low + 1)), F.lit(steps - 1))
    clock = spark.createDataFrame([(last,)], "t timestamp").select(*[(F.col("t") + F.expr("interval 1 day") if f.name == ts else F.lit("" if f.dataType.simpleString() == "string" else None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    rows.limit(0).write.parquet(f"{folder}/landed")
    stream = transform(spark.readStream.schema(rows.schema).parquet(f"{folder}/landed"))
    for part in [*(dealt.filter(step == k).drop("arrived") for k in range(steps)), clock]:
        part.write.mode("append").parquet(f"{folder}/landed")
        run_step(stream, f"{folder}/settled", f"{folder}/progress")
    return spark.read.schema(stream.schema).parquet(f"{folder}/settled")
