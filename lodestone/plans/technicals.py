"""Technical features of hourly bars and the setup and confirmation scores made of them, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scores import CONFIRMATION_WEIGHTS, SETUP_WEIGHTS, setup_and_confirmation
from ..operators.technicals import AVAILABLE, DIGITS, LEAST_DEVIATION, technical_features
from ..sources.tables import bars
from .market import BARS

MARKET, SECTORS = "click", {"view": "error", "purchase": "error", "signup": "view"}


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return technical_features(bars(spark, sf_dir, 60).withColumnRenamed("bar_ts", "ts"), MARKET, SECTORS)


def q28_technical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 33 features of each hour; the map of what is available as a list of names."""
    x = _features(spark, sf_dir)
    names = F.array_join(F.array_sort(F.map_keys(F.map_filter("feature_availability", lambda _, v: v))), ",")
    return x.select("symbol", "ts", "history_count", *DIGITS, "market_benchmark", "sector_benchmark", names.alias("available"), "technical_history_completeness")


def _p(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN ({a} / {b} - 1) * 100 END"


_OWN = {
    "current_return_pct": _p("close", "prev"), "mean20_return_pct": "mean20 * 100", "vol20_pct": "std20 * 100",
    "shock_z": f"CASE WHEN std20 > 0 THEN greatest(0.0, -(({_p('close', 'prev')}) / 100 - mean20) / greatest(std20, {LEAST_DEVIATION})) END",
    "atr20": "CASE WHEN history_count >= 2 THEN range20 END", "atr_move_multiple": "CASE WHEN history_count >= 2 AND range20 > 0 THEN abs(close - prev) / range20 END",
    "rsi14": "CASE WHEN history_count >= 14 THEN CASE WHEN fall = 0 THEN 100.0 ELSE 100 - 100 / (1 + rise / fall) END END",
    "sma20": "CASE WHEN history_count >= 20 THEN average20 END", "sma50": "CASE WHEN history_count >= 50 THEN average50 END",
    "sma20_distance_pct": f"CASE WHEN history_count >= 20 THEN {_p('close', 'average20')} END", "sma50_distance_pct": f"CASE WHEN history_count >= 50 THEN {_p('close', 'average50')} END",
    "recent_high_60d": "top60", "drawdown_from_60d_high_pct": _p("close", "top60"), "current_volume": "volume", "volume_mean20": "volume20", "relative_volume20": "CASE WHEN volume20 > 0 THEN volume / volume20 END",
    "volume_z20": "CASE WHEN volume_sd20 > 0 THEN (volume - volume20) / volume_sd20 END", "gap_pct": f"CASE WHEN open > 0 THEN {_p('open', 'prev')} END",
    "session_range_position": "CASE WHEN high > low THEN (close - low) / (high - low) * 100 END", "return_from_open_pct": _p("close", "open"),
    "gap_reclaim_pct": "CASE WHEN open < prev THEN (close - open) / (prev - open) * 100 END", "low_reclaim_pct": "CASE WHEN low < prev THEN (close - low) / (prev - low) * 100 END",
    "vwap": "vwap", "vwap_distance_pct": _p("close", "vwap"),
}
_FLAGS = {"history_20": "history_count >= 20", "history_50": "history_count >= 50", **{k: f"{v} IS NOT NULL" for k, v in AVAILABLE.items()}}
_SECTOR = "CASE symbol " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SECTORS.items()) + " END"
FEATURES = f"""{BARS.replace("'15 minutes'", "'60 minutes'")},
h AS (SELECT symbol, bar_ts AS ts, open, high, low, close, volume::DOUBLE AS volume, vwap, lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts) AS prev FROM bars WHERE close > 0),
hr AS (SELECT *, close / prev - 1 AS r, close - prev AS move, CASE WHEN prev IS NULL THEN high - low ELSE greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr FROM h),
hw AS (SELECT *, count(*) OVER b80 AS history_count, avg(r) OVER b20 AS mean20, stddev_samp(r) OVER b20 AS std20, avg(close) OVER b20 AS average20, avg(close) OVER b50 AS average50,
  avg(greatest(move, CASE WHEN move IS NULL THEN NULL ELSE 0.0 END)) OVER b14 AS rise, avg(greatest(-move, CASE WHEN move IS NULL THEN NULL ELSE 0.0 END)) OVER b14 AS fall, avg(tr) OVER b20 AS range20,
  max(CASE WHEN high > 0 THEN high END) OVER b60 AS top60, avg(volume) OVER b20 AS volume20, stddev_samp(volume) OVER b20 AS volume_sd20 FROM hr
  WINDOW b80 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 80 PRECEDING AND 1 PRECEDING), b60 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING), b50 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING),
  b20 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), b14 AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
own AS (SELECT symbol, ts, history_count, {', '.join(f'{v} AS {k}' for k, v in _OWN.items())}, '{MARKET}' AS market_benchmark, {_SECTOR} AS sector_benchmark FROM hw),
both_ AS (SELECT o.*, m.current_return_pct AS market_return_pct, o.current_return_pct - m.current_return_pct AS market_relative_move_pct, s.current_return_pct AS sector_return_pct, o.current_return_pct - s.current_return_pct AS sector_relative_move_pct
  FROM own o LEFT JOIN own m ON m.symbol = o.market_benchmark AND m.ts = o.ts LEFT JOIN own s ON s.symbol = o.sector_benchmark AND s.ts = o.ts),
flagged AS (SELECT *, {' || '.join(f"CASE WHEN {v} THEN '{k},' ELSE '' END" for k, v in sorted(_FLAGS.items()))} AS names, round(({' + '.join(f'({v})::INT' for v in _FLAGS.values())})::DOUBLE / {len(_FLAGS)} * 100, 1) AS technical_history_completeness FROM both_),
tech AS (SELECT symbol, ts, history_count, market_benchmark, sector_benchmark, rtrim(names, ',') AS available, technical_history_completeness, {', '.join(f'round({k}, {d}) + 0.0 AS {k}' for k, d in DIGITS.items())} FROM flagged)"""
Q28 = f"WITH {FEATURES} SELECT * FROM tech"


def q29_setup_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Setup, confirmation and dislocation of each hour that fell; spread and turnover come from the bar itself."""
    x = _features(spark, sf_dir).filter("current_return_pct < 0")
    x = x.withColumn("spread_pct", F.round(F.pmod("current_volume", F.lit(70.0)) / 10, 6)).withColumn("prev_dollar_volume", F.when(F.col("volume_mean20") > 0, F.round(F.col("volume_mean20") * 20000, 2)))
    return setup_and_confirmation(x).select("symbol", "ts", "setup", "confirmation", "dislocation", "setup_cap")


def _lin(x: str, low: float, high: float, a: float, b: float, other: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN {other} ELSE least(100.0, greatest(0.0, {a} + least(1.0, greatest(0.0, (({x}) - {low}) / ({high} - {low}))) * ({b} - {a}))) END"


_SETUP = {
    "raw_decline": "decline", "volatility_shock": "shock", "recent_high_drawdown": _lin("abs(least(coalesce(drawdown_from_60d_high_pct, -fall), 0.0))", 15.0, 60.0, 45.0, 92.0, "decline"),
    "moving_average_dislocation": _lin("coalesce((coalesce(abs(least(sma20_distance_pct, 0.0)), 0) + coalesce(abs(least(sma50_distance_pct, 0.0)), 0)) / nullif((sma20_distance_pct IS NOT NULL)::INT + (sma50_distance_pct IS NOT NULL)::INT, 0), fall)", 10.0, 40.0, 40.0, 95.0, "decline"),
    "rsi": "CASE WHEN rsi14 IS NULL THEN least(80.0, decline) WHEN rsi14 <= 15 THEN 95 WHEN rsi14 <= 25 THEN 86 WHEN rsi14 <= 35 THEN 68 WHEN rsi14 <= 45 THEN 40 ELSE 18 END",
    "volume_anomaly": _lin("relative_volume20", 0.8, 4.0, 32.0, 94.0, "45.0"),
    "relative_move": _lin("CASE WHEN market_relative_move_pct IS NULL AND sector_relative_move_pct IS NULL THEN NULL ELSE greatest(abs(least(coalesce(market_relative_move_pct, 0.0), 0.0)), abs(least(coalesce(sector_relative_move_pct, 0.0), 0.0))) END", 3.0, 25.0, 35.0, 95.0, "50.0"),
    "tradability": "0.6 * CASE WHEN prev_dollar_volume IS NULL THEN 35 WHEN prev_dollar_volume >= 50000000 THEN 95 WHEN prev_dollar_volume >= 10000000 THEN 84 WHEN prev_dollar_volume >= 2000000 THEN 67 WHEN prev_dollar_volume >= 500000 THEN 45 ELSE 15 END + 0.4 * CASE WHEN spread_pct IS NULL THEN 35 WHEN spread_pct <= 0.5 THEN 95 WHEN spread_pct <= 1 THEN 85 WHEN spread_pct <= 2 THEN 68 WHEN spread_pct <= 5 THEN 38 ELSE 12 END",
}
_CONFIRM = {
    "range_position": "place", "intraday_reversal": "CASE WHEN return_from_open_pct IS NULL THEN 35 ELSE least(100.0, greatest(0.0, 50 + return_from_open_pct * 7)) END", "gap_reclaim": "CASE WHEN gap_reclaim_pct IS NULL THEN 40 ELSE least(100.0, greatest(0.0, 35 + gap_reclaim_pct * 0.75)) END",
    "vwap_reclaim": "CASE WHEN vwap_distance_pct IS NULL THEN 35 WHEN vwap_distance_pct >= 1 THEN 88 WHEN vwap_distance_pct >= 0 THEN 72 WHEN vwap_distance_pct >= -1 THEN 50 ELSE 25 END",
    "volume_stabilisation": "CASE WHEN relative_volume20 IS NULL THEN 35 WHEN relative_volume20 >= 2 AND place >= 55 THEN 88 WHEN relative_volume20 >= 1.25 AND place >= 45 THEN 70 WHEN place < 25 THEN 20 ELSE 46 END",
    "spread_quality": "CASE WHEN spread_pct IS NULL THEN 35 WHEN spread_pct <= 0.5 THEN 92 WHEN spread_pct <= 1 THEN 80 WHEN spread_pct <= 2 THEN 62 WHEN spread_pct <= 5 THEN 30 ELSE 10 END",
}
_CUT = "least(100.0, greatest(0.0, {}))"
Q29 = f"""WITH {FEATURES}, f AS (SELECT *, round((current_volume % 70) / 10, 6) AS spread_pct, CASE WHEN volume_mean20 > 0 THEN round(volume_mean20 * 20000, 2) END AS prev_dollar_volume, abs(current_return_pct) AS fall, coalesce(session_range_position, 30.0) AS place FROM tech WHERE current_return_pct < 0),
g AS (SELECT *, {_lin('fall', 15.0, 45.0, 55.0, 95.0, '45.0')} AS decline, CASE WHEN sma20_distance_pct IS NULL THEN sma50_distance_pct WHEN sma50_distance_pct IS NULL THEN sma20_distance_pct ELSE greatest(sma20_distance_pct, sma50_distance_pct) END AS above FROM f),
h2 AS (SELECT *, {_lin('shock_z', 1.5, 5.0, 40.0, 98.0, 'decline')} AS shock, CASE WHEN above >= 100 THEN 30 WHEN above >= 50 THEN 40 WHEN above >= 20 AND coalesce(shock_z < 2, TRUE) THEN 50 WHEN above >= 10 AND coalesce(shock_z < 1.5, TRUE) THEN 55 ELSE 100 END::DOUBLE AS setup_cap FROM g)
SELECT symbol, ts, round(round({_CUT.format('least(' + ' + '.join(f'{w} * ({_SETUP[k]})' for k, w in SETUP_WEIGHTS.items()) + ', setup_cap)')}::DOUBLE, 9), 1) AS setup, round(round({_CUT.format(' + '.join(f'{w} * ({_CONFIRM[k]})' for k, w in CONFIRMATION_WEIGHTS.items()))}::DOUBLE, 9), 1) AS confirmation,
 round(round({_CUT.format('0.45 * decline + 0.35 * shock + 0.2 * ' + _lin('atr_move_multiple', 1.5, 5.0, 40.0, 98.0, 'shock'))}::DOUBLE, 9), 1) AS dislocation, setup_cap FROM h2"""

QUERIES = {"q28_technical_features": q28_technical_features, "q29_setup_scores": q29_setup_scores}
ORACLES = {"q28_technical_features": Q28, "q29_setup_scores": Q29}
