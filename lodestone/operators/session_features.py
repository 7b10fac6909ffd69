"""The 26 features of a session's bars that the cross-sectional model is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names in their registered order, and the session's length in minutes (fixed values).
FEATURES = (
    "ret_oc", "range_pct", "rv_1m", "close_location", "close_vs_vwap", "first30_ret", "first60_ret", "midday_ret", "last60_ret", "last30_ret", "first60_range", "last60_range", "first60_volume_share", "last60_volume_share",
    "first60_trade_share", "last60_trade_share", "pos_minute_fraction", "max_minute_ret", "min_minute_ret", "minute_ret_abs_sum", "efficiency_ratio", "minute_ret_lag1_corr", "high_time_fraction", "low_time_fraction",
    "max_runup_from_open", "max_drawdown_from_open",
)
MINUTES = 390


def session_features(bars: DataFrame) -> DataFrame:
    """One row per (symbol, day) with the features, open_price and close_price; bars: symbol, day, at (comparable order), minute (0 to 389), open, high, low, close, volume, trades.

    A feature without the bars that it needs is null. Prices of zero or below, and null ones, are no bars.
    """
    w = Window.partitionBy("symbol", "day").orderBy("at")
    b = bars.filter("open > 0 and high > 0 and low > 0 and close > 0").withColumn("r", F.ln(F.col("close") / F.lag("close").over(w)))
    b = b.withColumn("before", F.lag("r").over(w))
    m, order = F.col("minute"), F.col("at")
    first, last = (lambda c: F.min_by(c, order)), (lambda c, fit: F.max_by(c, F.when(fit, order)))
    until = lambda minute: last("close", m < minute)
    early, late = m < 60, m >= MINUTES - 60
    within = lambda fit: F.max(F.when(fit, F.col("high"))) - F.min(F.when(fit, F.col("low")))
    part = lambda c, fit: F.sum(F.when(fit, F.col(c)).otherwise(0)) / F.nullif(F.sum(c), F.lit(0))
    a = b.groupBy("symbol", "day").agg(
        first("open").alias("open_price"), last("close", m.isNotNull()).alias("close_price"), first("close").alias("first_close"), F.max("high").alias("top"), F.min("low").alias("bottom"),
        (F.sum(F.col("close") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0))).alias("average"), F.stddev_samp("r").alias("rv_1m"),
        *[until(x).alias(f"until{x}") for x in (30, 60, 120, 270, MINUTES - 60, MINUTES - 30)],
        within(early).alias("early_range"), within(late).alias("late_range"), part("volume", early).alias("first60_volume_share"), part("volume", late).alias("last60_volume_share"),
        part("trades", early).alias("first60_trade_share"), part("trades", late).alias("last60_trade_share"), F.avg((F.col("r") > 0).cast("int")).alias("pos_minute_fraction"),
        F.max("r").alias("max_minute_ret"), F.min("r").alias("min_minute_ret"), F.sum(F.abs("r")).alias("minute_ret_abs_sum"), F.corr("r", "before").alias("minute_ret_lag1_corr"),
        (F.min_by("minute", F.struct(-F.col("high"), order)) / (MINUTES - 1)).alias("high_time_fraction"), (F.min_by("minute", F.struct("low", order)) / (MINUTES - 1)).alias("low_time_fraction"),
    )
    o, c = F.col("open_price"), F.col("close_price")
    rest: dict[str, Column] = {
        "ret_oc": c / o - 1, "range_pct": (F.col("top") - F.col("bottom")) / o, "close_location": (c - F.col("bottom")) / F.nullif(F.col("top") - F.col("bottom"), F.lit(0.0)), "close_vs_vwap": c / F.nullif(F.col("average"), F.lit(0.0)) - 1,
        "first30_ret": F.col("until30") / o - 1, "first60_ret": F.col("until60") / o - 1, "midday_ret": F.col("until270") / F.col("until120") - 1, "last60_ret": c / F.col(f"until{MINUTES - 60}") - 1, "last30_ret": c / F.col(f"until{MINUTES - 30}") - 1,
        "first60_range": F.col("early_range") / o, "last60_range": F.col("late_range") / o, "efficiency_ratio": F.abs(F.ln(c / F.col("first_close"))) / F.nullif(F.col("minute_ret_abs_sum"), F.lit(0.0)),
        "max_runup_from_open": F.col("top") / o - 1, "max_drawdown_from_open": F.col("bottom") / o - 1,
    }
    a = a.withColumns(rest)
    return a.select("symbol", "day", "open_price", "close_price", *[F.when(~F.isnan(f), F.round(f, 9) + F.lit(0.0)).alias(f) for f in FEATURES])
