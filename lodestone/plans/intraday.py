"""The intraday scan from gate to ranked, policed candidates, with its DuckDB SQL.

Stand-in: a scan is a day at 20:00 UTC; its bars are half hours, its snapshots the last tick of each symbol, whose size gives
spread, minutes elapsed and what is known of borrowing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.intraday import AUDIT, LIQUIDITY, RAW, STRUCTURE, best_hypothesis, hypotheses, liquidity_gate, market_features, market_scores, reliability_policy, session_arrays
from ..sources.tables import bars, ticks
from .market import BARS, R

BENCHMARK, MINUTES, MIN_BARS, MAX_GAP = "click", 30, 20, 0.45
GATE = {"min_price": 5.0, "min_prev_turnover": 100.0, "min_turnover": 100.0, "max_spread_bps": 45.0, "max_quote_age": 3600.0}
FEATURES = (
    "return_5", "return_15", "return_30", "return_60", "relative_5", "relative_15", "relative_30", "relative_60", "session_vwap", "vwap_distance", "move_capacity", "realized_vol", "median_range", "efficiency_30", "efficiency_60",
    "consistency_30", "volume_acceleration", "trade_acceleration", "range_position_30", "gap_ratio", "data_quality",
)


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("scan", F.col("ts").cast("date"))
    t = t.withColumn("cutoff", F.col("scan").cast("timestamp_ntz") + F.expr("INTERVAL '20' HOUR")).filter("ts <= cutoff")
    last = F.struct("ts", "tick_id")
    s = t.groupBy("scan", "symbol", "cutoff").agg(F.max("ts").alias("trade_ts"), F.max_by("price", last).alias("trade_price"), F.sum("size").alias("volume"), F.max_by("size", last).alias("k"))
    w, k = Window.partitionBy("symbol").orderBy("scan"), F.col("k")
    return s.select(
        "scan", "symbol", "cutoff", "trade_ts", F.col("trade_ts").alias("quote_ts"), "trade_price", F.lit(None).cast("double").alias("minute_close"), F.lit(None).cast("double").alias("day_close"), "volume",
        F.lag("trade_price").over(w).alias("prev_close"), F.lag("volume").over(w).alias("prev_volume"), (F.col("trade_price") * (1 - k / 40000)).alias("bid"), (F.col("trade_price") * (1 + k / 40000)).alias("ask"),
        (k * 5).alias("elapsed_minutes"), F.when(k % 3 > 0, True).alias("shortable"), F.when(k % 4 > 0, k % 4 > 1).alias("easy_to_borrow"),
    )


def _session_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir, MINUTES).withColumn("scan", F.col("bar_ts").cast("date")).filter(F.hour("bar_ts") < 20)
    arrays = session_arrays(b.withColumnRenamed("trade_count", "trades"), MINUTES)
    return market_features(arrays, BENCHMARK)


def q46_session_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """22 features of each session with robust volatility."""
    return _session_features(spark, sf_dir).select("scan", "symbol", F.col("bars_used").cast("long").alias("bars_used"), *[R(F.col(c)).alias(c) for c in FEATURES])


def f7_snapshot_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot with spread, ages, pace and the first gate that it fails."""
    x = liquidity_gate(_snapshots(spark, sf_dir), **GATE)
    return x.select("scan", "symbol", *[R(F.col(c)).alias(c) for c in ("spread_bps", "quote_age", "trade_age", "prev_turnover", "turnover", "pace")], "failed")


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = liquidity_gate(_snapshots(spark, sf_dir), **GATE).filter("failed is null").drop("volume")
    usable = _session_features(spark, sf_dir).filter((F.col("bars_used") >= MIN_BARS) & (F.col("gap_ratio") <= MAX_GAP))
    return best_hypothesis(hypotheses(market_scores(passed.join(usable, ["scan", "symbol"]))), ["scan", "symbol"])


def q48_intraday_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of each scan in order of score, execution and turnover: the best of four hypotheses a name."""
    rank = F.row_number().over(Window.partitionBy("scan").orderBy(F.round("score", 6).desc(), F.round("execution", 6).desc(), F.col("prev_turnover").desc(), "symbol"))
    x = _ranked(spark, sf_dir).withColumn("rank", rank)
    return x.select("scan", "rank", "symbol", "direction", "setup", *[R(F.col(c)).alias(c) for c in ("liquidity", "cost_bps", "edge_to_cost", "opportunity", "execution", "directional", "confirmation", "penalty", "raw", "margin", "score")], "view")


def q47_reliability_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority of each candidate less its audited penalty, capped, with a view for analysis alone."""
    return reliability_policy(_ranked(spark, sf_dir)).select("scan", "symbol", "direction", "setup", "status", R(F.col("priority")).alias("priority"), "analysis_view")


def _cut(x: str, low: float = 0.0, high: float = 100.0) -> str:
    return f"least({high}::DOUBLE, greatest({low}::DOUBLE, {x}))"


def _ret(n: int) -> str:
    return f"CASE WHEN len(c) > {n} AND c[len(c) - {n}] > 0 THEN (c[len(c)] / c[len(c) - {n}] - 1) * 100 ELSE 0 END"


def _eff(n: int) -> str:
    path = f"list_sum(list_transform(range(len(c) - {n - 1}, len(c) + 1), lambda i: abs(c[i] - c[i - 1])))"
    return f"CASE WHEN len(c) > {n} AND {path} > 0 THEN abs(c[len(c)] - c[len(c) - {n}]) / {path} ELSE 0 END"


def _acc(a: str) -> str:
    old = f"list_avg({a}[greatest(len({a}) - 29, 1):len({a}) - 10])"
    return _cut(f"CASE WHEN len({a}) >= 20 AND {old} > 0 THEN list_avg({a}[len({a}) - 9:len({a})]) / {old} ELSE 1 END", 0, 10)


_W = (5, 15, 30, 60)
_LAST = "range(greatest(2, len(c) - 29), len(c) + 1)"
_SESSION = f"""{BARS.replace("'15 minutes'", f"'{MINUTES} minutes'")},
cl AS (SELECT CAST(bar_ts AS DATE) AS scan, * FROM bars WHERE hour(bar_ts) < 20 AND close > 0 AND low > 0 AND high >= low),
ar AS (SELECT scan, symbol, list(close ORDER BY bar_ts) AS c, list(high ORDER BY bar_ts) AS h, list(low ORDER BY bar_ts) AS l, list(volume::DOUBLE ORDER BY bar_ts) AS v, list(trade_count::DOUBLE ORDER BY bar_ts) AS n,
  list(CASE WHEN vwap > 0 THEN vwap ELSE close END * volume ORDER BY bar_ts) AS wv, min(bar_ts) AS t0, max(bar_ts) AS t1, count(*) AS bars_used FROM cl GROUP BY scan, symbol),
a1 AS (SELECT *, CASE WHEN bars_used < 2 THEN 1.0 ELSE {_cut(f'1 - bars_used / greatest(1, round(epoch(t1 - t0) / {60 * MINUTES}) + 1)', 0, 1)} END AS gap_ratio, {', '.join(f'{_ret(k)} AS return_{k}' for k in _W)},
  list_transform(range(greatest(2, len(c) - 59), len(c) + 1), lambda i: ln(c[i]) - ln(c[i - 1])) AS mv, list_median(list_transform(range(greatest(1, len(c) - 29), len(c) + 1), lambda i: (h[i] - l[i]) / c[i] * 100)) AS median_range FROM ar),
a2 AS (SELECT *, list_median(mv) AS mid FROM a1), a3 AS (SELECT *, 4 * 1.4826 * list_median(list_transform(mv, lambda x: abs(x - mid))) AS reach FROM a2),
a4 AS (SELECT *, coalesce(CASE WHEN len(mv) >= 3 AND reach > 0 THEN list_stddev_samp(list_transform(mv, lambda x: least(mid + reach, greatest(mid - reach, x)))) ELSE list_stddev_samp(mv) END, 0) AS vol,
  len(list_filter({_LAST}, lambda i: c[i] > c[i - 1])) AS up, len(list_filter({_LAST}, lambda i: c[i] < c[i - 1])) AS down, list_max(h[greatest(1, len(h) - 29):len(h)]) AS top, list_min(l[greatest(1, len(l) - 29):len(l)]) AS bottom FROM a3),
a5 AS (SELECT scan, symbol, bars_used, gap_ratio, {', '.join(f'return_{k}' for k in _W)}, median_range, vol * 100 AS realized_vol, {_cut('greatest(0.08, vol * sqrt(120) * 100, median_range * sqrt(120 / 1.8))', 0.08, 12)} AS move_capacity,
  CASE WHEN list_sum(v) > 0 THEN list_sum(wv) / list_sum(v) ELSE c[len(c)] END AS session_vwap, {_eff(30)} AS efficiency_30, {_eff(60)} AS efficiency_60, CASE WHEN len(c) > 2 AND up + down > 0 THEN up / (up + down) ELSE 0.5 END AS consistency_30,
  {_acc('v')} AS volume_acceleration, {_acc('n')} AS trade_acceleration, CASE WHEN top > bottom THEN (c[len(c)] - bottom) / (top - bottom) ELSE 0.5 END AS range_position_30,
  {_cut('100 - gap_ratio * 180 - greatest(0, 60 - bars_used) * 0.35::DOUBLE - CASE WHEN list_sum(v) <= 0 THEN 8 ELSE 0 END - CASE WHEN list_sum(n) <= 0 THEN 5 ELSE 0 END')} AS data_quality, c[len(c)] AS last FROM a4),
sess AS (SELECT a.* EXCLUDE (last), CASE WHEN a.session_vwap > 0 THEN (a.last / a.session_vwap - 1) * 100 ELSE 0 END AS vwap_distance, {', '.join(f'a.return_{k} - coalesce(b.return_{k}, 0) AS relative_{k}' for k in _W)} FROM a5 a LEFT JOIN a5 b ON b.symbol = '{BENCHMARK}' AND b.scan = a.scan)"""
Q46S = f"WITH {_SESSION} SELECT scan, symbol, bars_used, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURES)} FROM sess"

_SNAP = f"""s0 AS (SELECT CAST(ts AS DATE) AS scan, symbol, max(ts) AS trade_ts, last(price ORDER BY ts, tick_id) AS price, sum(size)::BIGINT AS volume, last(size ORDER BY ts, tick_id) AS k FROM ticks WHERE ts <= CAST(ts AS DATE) + INTERVAL 20 HOUR GROUP BY ALL),
s1 AS (SELECT *, lag(price) OVER w AS prev_close, lag(volume) OVER w AS prev_volume, price * (1 - k / 40000) AS bid, price * (1 + k / 40000) AS ask, epoch_us(scan + INTERVAL 20 HOUR - trade_ts) / 1e6 AS age FROM s0 WINDOW w AS (PARTITION BY symbol ORDER BY scan)),
s2 AS (SELECT *, CASE WHEN bid > 0 AND ask > bid THEN (bid + ask) / 2 END AS midpoint, coalesce(prev_volume, 0) * prev_close AS prev_turnover, coalesce(volume, 0) * price AS turnover, coalesce(prev_volume, 0) * {_cut('k * 5', 1, 390)} / 390 AS expected FROM s1),
s3 AS (SELECT *, (ask - bid) / midpoint * 10000 AS spread_bps, coalesce(CASE WHEN expected > 0 THEN volume / expected END, 0) AS pace FROM s2),
snap AS (SELECT *, CASE WHEN NOT coalesce(price >= 5 AND prev_close > 0, FALSE) THEN 'PRICE' WHEN midpoint IS NULL THEN 'QUOTE' WHEN NOT coalesce(spread_bps > 0 AND spread_bps <= 45, FALSE) THEN 'SPREAD' WHEN NOT coalesce(age <= 3600, FALSE) THEN 'QUOTE_AGE'
  WHEN NOT coalesce(age <= 5400, FALSE) THEN 'TRADE_AGE' WHEN abs(price - midpoint) / midpoint > greatest(0.03, spread_bps / 10000 * 20) THEN 'DISLOCATION' WHEN NOT coalesce(prev_turnover >= 100 AND turnover >= 100, FALSE) THEN 'TURNOVER' END AS failed FROM s3)"""
F7S = f"WITH {BARS}, {_SNAP} SELECT scan, symbol, {', '.join(f'round({c}, 6) AS {n}' for n, c in (('spread_bps', 'spread_bps'), ('quote_age', 'age'), ('trade_age', 'age'), ('prev_turnover', 'prev_turnover'), ('turnover', 'turnover'), ('pace', 'pace')))}, failed FROM snap"

_LIQ = {"prev_turnover": _cut("(log10(greatest(1.0, prev_turnover)) - 7) / 2.3", 0, 1), "turnover": _cut("(log10(greatest(1.0, turnover)) - 6) / 2.5", 0, 1), "spread": _cut("1 - spread_bps / 30", 0, 1), "pace": _cut("ln(1 + pace) / ln(4.0)", 0, 1)}
_T = "tanh({v} / greatest({a}::DOUBLE, cap * {b}))".format
_GO = f"50 + 18 * {_T(v='r15', a=0.12, b=0.3)} + 14 * {_T(v='r30', a=0.18, b=0.5)} + 8 * {_T(v='r60', a=0.25, b=0.75)} + 7 * {_T(v='rel15', a=0.1, b=0.25)}"
_GO_SURE = f"28 + 30 * steady + 23 * trend + 12 * spot + 5 * {_T(v='vw', a=0.08, b=0.2)} + 4 * tanh((volume_acceleration - 1) / 0.8) + 3 * tanh((trade_acceleration - 1) / 0.8) - CASE WHEN r5 < -0.1 THEN 12 ELSE 0 END - CASE WHEN r30 <= 0 OR r15 <= 0 THEN 18 ELSE 0 END"
_BACK = f"34 + 29 * {_T(v='before', a=0.2, b=0.55)} + 25 * {_T(v='r5', a=0.08, b=0.18)} + 8 * {_T(v='-vw', a=0.1, b=0.3)} - CASE WHEN before <= 0.2 OR r5 <= 0 THEN 35 ELSE 0 END"
_BACK_SURE = "35 + 20 * (1 - trend) + 14 * (1 - spot) + 16 * tanh((volume_acceleration - 1) / 0.9) - CASE WHEN before <= 0.2 OR r5 <= 0 THEN 30 ELSE 0 END - CASE WHEN r15 > greatest(0.35, cap * 0.35) THEN 10 ELSE 0 END"
_RANKED = f"""{_SESSION}, {_SNAP},
j AS (SELECT s.*, p.prev_turnover, p.turnover, p.spread_bps, p.pace, p.k AS tick_size FROM sess s JOIN snap p USING (scan, symbol) WHERE p.failed IS NULL AND s.bars_used >= {MIN_BARS} AND s.gap_ratio <= {MAX_GAP}),
m1 AS (SELECT *, {_cut('100 * (' + ' + '.join(f'{LIQUIDITY[k]} * {v}' for k, v in _LIQ.items()) + ')')} AS liquidity, greatest(0.1, spread_bps) + greatest(1.0, greatest(0.1, spread_bps) * (0.22 - {_cut('ln(1 + greatest(0.1, pace)) / 5', 0, 0.22)}) + realized_vol * 8) AS cost_bps FROM j),
m2 AS (SELECT *, move_capacity / (cost_bps / 100) AS edge_to_cost FROM m1),
m3 AS (SELECT *, {_cut('28 + 29 * tanh(move_capacity / 1.15) + 24 * tanh((edge_to_cost - 3) / 6) + 10 * tanh((pace - 1) / 1.5) + 9 * (data_quality / 100)')} AS opportunity, {_cut('0.48 * liquidity + 0.32 * data_quality + 20 * ' + _cut('(edge_to_cost - 2) / 10', 0, 1))} AS execution FROM m2),
h0 AS (SELECT *, side * return_5 AS r5, side * return_15 AS r15, side * return_30 AS r30, side * return_60 AS r60, side * relative_15 AS rel15, side * vwap_distance AS vw, greatest(0.1, move_capacity) AS cap, 0.6 * efficiency_30 + 0.4 * efficiency_60 AS trend,
  CASE WHEN side > 0 THEN consistency_30 ELSE 1 - consistency_30 END AS steady, CASE WHEN side > 0 THEN range_position_30 ELSE 1 - range_position_30 END AS spot, side * return_30 - side * relative_30 AS broad,
  abs(return_5) / greatest(0.08, move_capacity) AS chase, abs(vwap_distance) / greatest(0.08, move_capacity / sqrt(2)) AS stretch FROM m3 CROSS JOIN (VALUES (0, 1, 'CONTINUATION'), (1, 1, 'REVERSION'), (2, -1, 'CONTINUATION'), (3, -1, 'REVERSION')) t(kk, side, setup)),
h1 AS (SELECT *, greatest(-r30, -r60 * 0.8) AS before FROM h0),
h2 AS (SELECT *, {_cut(f"CASE WHEN setup = 'CONTINUATION' THEN {_GO} ELSE {_BACK} END")} AS directional, {_cut(f"CASE WHEN setup = 'CONTINUATION' THEN {_GO_SURE} ELSE {_BACK_SURE} END")} AS confirmation,
  CASE WHEN edge_to_cost < 4 THEN (4 - edge_to_cost) * 4 ELSE 0 END + CASE WHEN data_quality < 88 THEN (88 - data_quality) * 0.3 ELSE 0 END + CASE WHEN chase > 0.65 THEN (chase - 0.65) * 26 ELSE 0 END
  + CASE WHEN setup = 'CONTINUATION' AND stretch > 2.4 THEN (stretch - 2.4) * 5 ELSE 0 END + CASE WHEN setup = 'CONTINUATION' AND broad < -0.2 THEN least(10.0, abs(broad) * 5) ELSE 0 END AS penalty FROM h1),
h3 AS (SELECT *, round({_cut(' + '.join(f'{w} * {k}' for k, w in RAW.items()) + ' - penalty')}, 9) AS raw FROM h2),
h4 AS (SELECT *, row_number() OVER w AS place, lead(raw) OVER w AS nxt FROM h3 WINDOW w AS (PARTITION BY scan, symbol ORDER BY raw DESC, kk)),
h5 AS (SELECT *, raw - coalesce(nxt, 0) AS margin, CASE WHEN side > 0 THEN 'LONG' ELSE 'SHORT' END AS direction FROM h4 WHERE place = 1),
ranked AS (SELECT *, {_cut('raw - greatest(0.0, 4 - margin) * 1.5')} AS score FROM h5)"""
_SHOWN = ("liquidity", "cost_bps", "edge_to_cost", "opportunity", "execution", "directional", "confirmation", "penalty", "raw", "margin", "score")
Q48 = f"""WITH {_RANKED} SELECT scan, row_number() OVER (PARTITION BY scan ORDER BY round(score, 6) DESC, round(execution, 6) DESC, prev_turnover DESC, symbol) AS rank, symbol, direction, setup, {', '.join(f'round({c}, 6) AS {c}' for c in _SHOWN)},
 CASE WHEN score >= 76 AND data_quality >= 90 AND edge_to_cost >= 5 AND margin >= 2 THEN 'INVESTIGATE' WHEN score >= 62 THEN 'WATCH' ELSE 'PASS' END AS view FROM ranked"""
_PARTS = {"direction_floor": "least(directional, confirmation)", "opportunity": "opportunity", "execution_floor": "least(liquidity, execution)", "data_quality": "data_quality"}
_PENALTY = "CASE direction || '|' || setup " + " ".join(f"WHEN '{d}|{s}' THEN {p}" for (d, s), (p, _) in AUDIT.items()) + " END"
_STATUS = "CASE direction || '|' || setup " + " ".join(f"WHEN '{d}|{s}' THEN '{x}'" for (d, s), (_, x) in AUDIT.items()) + " END"
_TRADING = "CASE WHEN tick_size * 5 < 15 THEN 12 WHEN tick_size * 5 < 30 THEN 6 ELSE 0 END + CASE WHEN side < 0 AND tick_size % 3 = 0 THEN 8 ELSE 0 END + CASE WHEN side < 0 THEN CASE tick_size % 4 WHEN 1 THEN 12 WHEN 0 THEN 4 ELSE 0 END ELSE 0 END"
Q47 = f"""WITH {_RANKED}, p AS (SELECT *, {_STATUS} AS status, {_cut(_cut(' + '.join(f'{STRUCTURE[k]} * {v}' for k, v in _PARTS.items())) + f' - ({_TRADING}) - {_PENALTY} - greatest(0.0, 6 - margin) * 1.25', 0, 74)} AS priority FROM ranked)
SELECT scan, symbol, direction, setup, status, round(priority, 6) AS priority, CASE WHEN priority >= 55 AND data_quality >= 90 AND least(liquidity, execution) >= 75 AND margin >= 4 THEN 'ANALYSE ONLY' WHEN priority >= 38 THEN 'LOW PRIORITY' ELSE 'PASS' END AS analysis_view FROM p"""

QUERIES = {"q46_session_features": q46_session_features, "f7_snapshot_gate": f7_snapshot_gate, "q48_intraday_scan": q48_intraday_scan, "q47_reliability_policy": q47_reliability_policy}
ORACLES = {"q46_session_features": Q46S, "f7_snapshot_gate": F7S, "q48_intraday_scan": Q48, "q47_reliability_policy": Q47}
