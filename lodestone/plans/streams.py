"""Streams replayed in steps over landed files: each gives what the batch rule gives, with its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.tables import ticks
from ..streaming.ingest import append_new, completed_minutes, fresh_bars
from ..streaming.tracking import feed, replay, tracked, tracked_batch
from .market import TICKS, R


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).filter("price > 0").withColumn("bar_ts", F.date_trunc("minute", "ts").cast("timestamp"))
    return t.groupBy("symbol", "bar_ts").agg(F.max_by("price", F.struct("ts", "tick_id")).alias("close"))


def _checkpoints(bars: DataFrame) -> DataFrame:
    """A checkpoint 90 minutes into each hour in which a symbol trades, on the price of the hour's first bar."""
    hour = F.date_trunc("hour", "bar_ts")
    c = bars.groupBy("symbol", hour.alias("hour")).agg(F.min("bar_ts").alias("selected_at"), F.min_by("close", "bar_ts").alias("selected_price"))
    return c.select("symbol", (F.unix_micros("hour") / 3_600_000_000).cast("long").alias("id"), "selected_at", (F.col("hour") + F.expr("interval 90 minutes")).alias("scheduled_at"), "selected_price")


def _told(df: DataFrame) -> DataFrame:
    return df.select("symbol", "id", F.col("scheduled_at").cast("timestamp_ntz"), "status", F.col("bar_ts").cast("timestamp_ntz"), "price", R(F.col("return_pct")).alias("return_pct"))


def q41_tracked_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints captured or missed by the stream; every tenth row arrives 90 minutes late."""
    bars = _minutes(spark, sf_dir)
    rows = feed(_checkpoints(bars), bars)
    late = F.when(F.crc32(F.concat_ws("|", "symbol", F.col("ts").cast("string"))) % 10 == 0, F.expr("interval 90 minutes")).otherwise(F.expr("interval 0 minutes"))
    return _told(replay(rows, F.col("ts") + late, "ts", tracked, 3, _folder(spark, "tracked")))


def q41_tracked_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the batch rule."""
    bars = _minutes(spark, sf_dir)
    return _told(tracked_batch(_checkpoints(bars), bars))


def q39_completed_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes built from a stream of ticks, each given out once it has settled; rows of a minute before the watermark would be lost."""
    t = ticks(spark, sf_dir).select("symbol", F.col("ts").cast("timestamp").alias("ts"), "price", "size", "tick_id")
    out = replay(t, F.col("ts"), "ts", completed_minutes, 3, _folder(spark, "minutes"))
    return out.select("symbol", F.col("bar_ts").cast("timestamp_ntz").alias("bar_ts"), *[R(F.col(c)).alias(c) for c in ("open", "high", "low", "close")], "volume", "trade_count")


def d4_appended_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that arrive twice, the second time an hour later, kept once a key, in a table by month that is read back."""
    folder = _folder(spark, "appended")
    bars = _minutes(spark, sf_dir)
    for k in (0, 1):
        bars.filter(F.lit(k == 0) | (F.crc32("symbol") % 2 == 0)).write.mode("append").parquet(f"{folder}/landed")
        stream = fresh_bars(spark.readStream.schema(bars.schema).parquet(f"{folder}/landed"), "100 days")
        append_new(stream, f"{folder}/table", f"{folder}/progress", ["symbol", "bar_ts"]).awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("symbol", F.col("bar_ts").cast("timestamp_ntz").alias("bar_ts"), "close", F.col("yyyymm").cast("string").alias("yyyymm"))


MINUTES = f"""{TICKS}, bars AS (SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS bar_ts, arg_max(price, {{'t': ts, 'k': tick_id}}) AS close FROM ticks WHERE price > 0 GROUP BY ALL)"""
TRACKED = f"""WITH {MINUTES}, c AS (SELECT symbol, epoch_us(date_trunc('hour', bar_ts)::TIMESTAMP) // 3600000000 AS id, date_trunc('hour', bar_ts)::TIMESTAMP + INTERVAL 90 MINUTE AS scheduled_at, arg_min(close, bar_ts) AS base FROM bars GROUP BY symbol, date_trunc('hour', bar_ts)),
m AS (SELECT c.symbol, c.id, max(b.bar_ts) AS bar_ts, arg_max(b.close, b.bar_ts) AS price FROM c JOIN bars b ON b.symbol = c.symbol AND b.bar_ts < c.scheduled_at AND b.bar_ts >= c.scheduled_at - INTERVAL 30 MINUTE GROUP BY 1, 2)
SELECT c.symbol, c.id, c.scheduled_at, CASE WHEN m.bar_ts IS NULL THEN 'missed' ELSE 'captured' END AS status, m.bar_ts, m.price, round((m.price / base - 1) * 100, 6) AS return_pct FROM c LEFT JOIN m ON m.symbol = c.symbol AND m.id = c.id"""
_SQL = {
    "q41_tracked_stream": TRACKED,
    "q41_tracked_batch": TRACKED,
    "q39_completed_minutes": f"""WITH {TICKS} SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS bar_ts, round(arg_min(price, {{'t': ts, 'k': tick_id}}), 6) AS open, round(max(price), 6) AS high, round(min(price), 6) AS low,
  round(arg_max(price, {{'t': ts, 'k': tick_id}}), 6) AS close, sum(size)::BIGINT AS volume, count(*) AS trade_count FROM ticks GROUP BY symbol, date_trunc('minute', ts)""",
    "d4_appended_bars": f"WITH {MINUTES} SELECT symbol, bar_ts, close, strftime(bar_ts, '%Y%m') AS yyyymm FROM bars",
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
