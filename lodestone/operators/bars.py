"""Bars, their daily features, and outcomes along a path of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import local_time, session_label, trade_date
from .asof import within_interval

BAR_KEY = ["symbol", "timeframe", "feed", "adjustment", "bar_ts"]


def first_by(value: str, *order: str) -> Column:
    return F.min_by(value, F.struct(*order))


def last_by(value: str, *order: str) -> Column:
    return F.max_by(value, F.struct(*order))


def bars_from_ticks(ticks: DataFrame, minutes: int, timeframe: str, feed: str = "sip", adjustment: str = "raw") -> DataFrame:
    """OHLCV bars from (symbol, ts, price, size, tick_id); ties in time go by tick_id."""
    start = F.window("ts", f"{minutes} minutes")["start"].cast("timestamp_ntz")
    bars = ticks.groupBy("symbol", start.alias("bar_ts")).agg(
        first_by("price", "ts", "tick_id").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), last_by("price", "ts", "tick_id").alias("close"),
        F.sum("size").cast("long").alias("volume"), F.count("*").alias("trade_count"), (F.sum(F.col("price") * F.col("size")) / F.nullif(F.sum("size"), F.lit(0))).alias("vwap"),
    )
    return bars.select("symbol", "bar_ts", F.lit(timeframe).alias("timeframe"), F.lit(feed).alias("feed"), F.lit(adjustment).alias("adjustment"), session_label(F.col("bar_ts")).alias("session_label"), "open", "high", "low", "close", "volume", "trade_count", "vwap")


def daily_features(bars: DataFrame, session: str = "all") -> DataFrame:
    """One row per symbol and New York date: OHLC, volume, VWAP, return, range and realised volatility.

    Returns never cross a session or a date. Give whole New York dates: a date cut short makes a partial row.
    """
    base = bars if session == "all" else bars.filter(F.col("session_label") == session)
    base = base.withColumn("trade_date", trade_date(F.col("bar_ts")))
    series = ["symbol", "timeframe", "feed", "adjustment"]
    before = F.lag("close").over(Window.partitionBy(*series, "session_label", "trade_date").orderBy("bar_ts"))
    base = base.withColumn("log_return", F.ln(F.col("close") / F.nullif(before, F.lit(0.0))))
    day = base.groupBy(*series, "trade_date").agg(
        F.min("bar_ts").alias("first_bar_ts"), F.max("bar_ts").alias("last_bar_ts"),
        F.min_by("open", "bar_ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_ts").alias("close"),
        F.sum("volume").alias("volume"), F.sum(F.coalesce("trade_count", F.lit(0))).alias("trade_count"), F.count("*").alias("bar_count"),
        (F.sum(F.coalesce("vwap", "close") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0))).alias("vwap"),
        F.stddev_samp("log_return").alias("realised_volatility"),
    )
    label = F.lit(session).alias("session_label")
    ratio = lambda a: F.when(F.col("open") != 0, a)
    return day.select("*", label, ratio((F.col("close") / F.col("open") - 1) * 100).alias("return_pct"), ratio((F.col("high") - F.col("low")) / F.col("open") * 100).alias("range_pct"))


def snapshot_grid(bars: DataFrame, grid: DataFrame) -> DataFrame:
    """Bars that start at a clock point of the grid (trade_date, minute, clock_ts)."""
    return grid.join(bars, F.col("clock_ts") == F.col("bar_ts"))


def path_outcome(signals: DataFrame, bars: DataFrame, horizon_minutes: int, side: int = 1) -> DataFrame:
    """Per signal (signal_id, symbol, signal_ts): entry, best and worst excursion and the close along the bars in (signal_ts, deadline].

    The first bar after the signal is the entry; equal extremes go to the earlier bar; side -1 is short. Signals and bars
    meet by symbol and time bucket of the horizon.
    """
    deadline = F.col("signal_ts") + F.expr(f"INTERVAL '{horizon_minutes}' MINUTE")
    met = within_interval(signals.withColumn("_deadline", deadline), bars, "symbol", "signal_ts", "_deadline", "bar_ts", horizon_minutes * 60)
    out = met.groupBy("signal_id", "symbol", "signal_ts").agg(
        F.min_by("open", "bar_ts").alias("entry"), F.max("high").alias("top"), F.min("low").alias("bottom"), F.max_by("close", "bar_ts").alias("exit"), F.count("*").alias("bars"),
        F.min(F.struct((-F.col("high")).alias("v"), F.col("bar_ts").alias("t")))["t"].alias("top_ts"),
    )
    pct = lambda c: (F.col(c) / F.nullif(F.col("entry"), F.lit(0.0)) - 1) * 100 * side
    mfe, mae = (pct("top"), pct("bottom")) if side > 0 else (pct("bottom"), pct("top"))
    return out.select("signal_id", "symbol", "signal_ts", "entry", "bars", "top_ts", mfe.alias("mfe_pct"), mae.alias("mae_pct"), pct("exit").alias("close_pct"))


def local_day(ts: Column) -> Column:
    return F.date_trunc("day", local_time(ts))
