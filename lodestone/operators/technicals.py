"""Technical features of a price series at every bar, from the bars before it and the bar itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digits to which results are rounded.
DIGITS = {
    "current_return_pct": 4, "mean20_return_pct": 4, "vol20_pct": 4, "shock_z": 3, "atr20": 4, "atr_move_multiple": 3, "rsi14": 2, "sma20": 4, "sma50": 4, "sma20_distance_pct": 3, "sma50_distance_pct": 3,
    "recent_high_60d": 4, "drawdown_from_60d_high_pct": 3, "current_volume": 2, "volume_mean20": 2, "relative_volume20": 3, "volume_z20": 3, "gap_pct": 3, "session_range_position": 2, "return_from_open_pct": 3,
    "gap_reclaim_pct": 2, "low_reclaim_pct": 2, "vwap": 4, "vwap_distance_pct": 3, "market_return_pct": 3, "market_relative_move_pct": 3, "sector_return_pct": 3, "sector_relative_move_pct": 3,
}
#: What counts for completeness: the flag's name, and the result that has to be there.
AVAILABLE = {
    "shock_z": "shock_z", "rsi14": "rsi14", "sma20": "sma20_distance_pct", "sma50": "sma50_distance_pct", "drawdown_60d": "drawdown_from_60d_high_pct", "volume_anomaly": "relative_volume20", "atr20": "atr_move_multiple",
    "market_relative": "market_relative_move_pct", "sector_relative": "sector_relative_move_pct", "range_position": "session_range_position", "gap_reclaim": "gap_reclaim_pct", "vwap": "vwap_distance_pct",
}
#: Volatility is taken as at least this much when a shock is measured (a fixed value).
LEAST_DEVIATION = 0.0075


def pct(a: Column, b: Column) -> Column:
    """Change from b to a in percent; null without a positive b."""
    return F.when(b > 0, (a / b - 1) * 100)


def technical_features(bars: DataFrame, market: str | None = None, sectors: dict[str, str] | None = None) -> DataFrame:
    """33 results for every bar (symbol, ts, open, high, low, close, volume, vwap): symbol, ts and the features by name.

    History is the at most 80 earlier bars of the symbol; bars without a positive close are left out. market is the symbol
    whose move is taken off, sectors the benchmark of a symbol. A feature without enough history is null;
    feature_availability maps 14 names to whether there is one, and technical_history_completeness is their share.
    """
    w = Window.partitionBy("symbol").orderBy("ts")
    back = lambda n: w.rowsBetween(-n, -1)
    x = bars.filter("close > 0").select("symbol", "ts", "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"), "vwap").withColumn("prev", F.lag("close").over(w))
    swing = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev")), F.abs(F.col("low") - F.col("prev")))
    x = x.withColumns({"r": F.col("close") / F.col("prev") - 1, "move": F.col("close") - F.col("prev"), "true_range": F.when(F.col("prev").isNull(), F.col("high") - F.col("low")).otherwise(swing)})
    x = x.withColumns(
        {
            "history_count": F.count("*").over(back(80)), "mean20": F.avg("r").over(back(20)), "std20": F.stddev_samp("r").over(back(20)), "average20": F.avg("close").over(back(20)), "average50": F.avg("close").over(back(50)),
            "rise": F.avg(F.greatest("move", F.lit(0.0))).over(w.rowsBetween(-13, 0)), "fall": F.avg(F.greatest(-F.col("move"), F.lit(0.0))).over(w.rowsBetween(-13, 0)), "range20": F.avg("true_range").over(back(20)),
            "top60": F.max(F.when(F.col("high") > 0, F.col("high"))).over(back(60)), "volume20": F.avg("volume").over(back(20)), "volume_sd20": F.stddev_samp("volume").over(back(20)),
        }
    )
    c, prev, history = F.col("close"), F.col("prev"), F.col("history_count")
    change = pct(c, prev)
    own = {
        "current_return_pct": change,
        "mean20_return_pct": F.col("mean20") * 100,
        "vol20_pct": F.col("std20") * 100,
        "shock_z": F.when(F.col("std20") > 0, F.greatest(F.lit(0.0), -(change / 100 - F.col("mean20")) / F.greatest(F.col("std20"), F.lit(LEAST_DEVIATION)))),
        "atr20": F.when(history >= 2, F.col("range20")),
        "atr_move_multiple": F.when((history >= 2) & (F.col("range20") > 0), F.abs(c - prev) / F.col("range20")),
        "rsi14": F.when(history >= 14, F.when(F.col("fall") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("rise") / F.col("fall")))),
        "sma20": F.when(history >= 20, F.col("average20")),
        "sma50": F.when(history >= 50, F.col("average50")),
        "sma20_distance_pct": F.when(history >= 20, pct(c, F.col("average20"))),
        "sma50_distance_pct": F.when(history >= 50, pct(c, F.col("average50"))),
        "recent_high_60d": F.col("top60"),
        "drawdown_from_60d_high_pct": pct(c, F.col("top60")),
        "current_volume": F.col("volume"),
        "volume_mean20": F.col("volume20"),
        "relative_volume20": F.when(F.col("volume20") > 0, F.col("volume") / F.col("volume20")),
        "volume_z20": F.when(F.col("volume_sd20") > 0, (F.col("volume") - F.col("volume20")) / F.col("volume_sd20")),
        "gap_pct": F.when(F.col("open") > 0, pct(F.col("open"), prev)),
        "session_range_position": F.when(F.col("high") > F.col("low"), (c - F.col("low")) / (F.col("high") - F.col("low")) * 100),
        "return_from_open_pct": pct(c, F.col("open")),
        "gap_reclaim_pct": F.when(F.col("open") < prev, (c - F.col("open")) / (prev - F.col("open")) * 100),
        "low_reclaim_pct": F.when(F.col("low") < prev, (c - F.col("low")) / (prev - F.col("low")) * 100),
        "vwap": F.col("vwap"),
        "vwap_distance_pct": pct(c, F.col("vwap")),
    }
    sector = F.try_element_at(F.create_map(*[F.lit(v) for kv in (sectors or {"": ""}).items() for v in kv]), F.col("symbol")) if sectors else F.lit(None).cast("string")
    x = x.select("symbol", "ts", "history_count", *[v.alias(k) for k, v in own.items()], F.lit(market).cast("string").alias("market_benchmark"), sector.alias("sector_benchmark"))
    moves = x.select(F.col("symbol").alias("_b"), F.col("ts").alias("_t"), F.col("current_return_pct").alias("_r"))
    for kind in ("market", "sector"):
        of = moves.select("_b", "_t", F.col("_r").alias(f"{kind}_return_pct"))
        x = x.join(of, (F.col(f"{kind}_benchmark") == F.col("_b")) & (F.col("ts") == F.col("_t")), "left").drop("_b", "_t")
        x = x.withColumn(f"{kind}_relative_move_pct", F.col("current_return_pct") - F.col(f"{kind}_return_pct"))
    flags = {"history_20": history >= 20, "history_50": history >= 50, **{k: F.col(v).isNotNull() for k, v in AVAILABLE.items()}}
    x = x.withColumn("feature_availability", F.create_map(*[e for k, v in flags.items() for e in (F.lit(k), v)]))
    have = F.aggregate(F.map_values("feature_availability"), F.lit(0.0), lambda a, v: a + v.cast("double"))
    x = x.withColumn("technical_history_completeness", F.round(have / len(flags) * 100, 1))
    return x.withColumns({k: F.round(k, d) + F.lit(0.0) for k, d in DIGITS.items()})
