"""The daily scan's discovery: candidates from snapshots, session context, prefilter and priority, with DuckDB SQL.

Stand-in: a user is a name, its ticks of a day the snapshot (last tick: latest trade, its size the spread), documents of the same
number its news.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import minute_of_day
from ..operators.scan import CLASS_POINTS, FLAG_PENALTIES, NOT_OPERATING, drop_candidates, listed_companies, pools, prefilter, priority, session_context, two_stage
from ..session import load
from ..sources.tables import ticks
from .events import CLASS_SQL, FLAG_SQL, risk_flags, text_class
from .market import TICKS, R

MIN_DROP, MIN_PRICE, MIN_TURNOVER, UNIT, LIMIT = 15.0, 1.0, 100.0, 100.0, 25


def f4_listed_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as assets: the brand is the ticker, size the venue."""
    p = load(spark, sf_dir, "part")
    a = p.select("p_partkey", F.regexp_replace("p_brand", "#", ".").alias("symbol"), F.concat("p_name", F.when(F.col("p_size") % 7 == 0, F.lit(" Units")).when(F.col("p_size") % 5 == 0, F.lit(" united")).otherwise(F.lit(""))).alias("name"),
                 F.when(F.col("p_size") % 11 == 0, "OTCX").otherwise("NYSE").alias("exchange"), F.lit("us_equity").alias("asset_class"), F.when(F.col("p_size") % 13 > 0, F.col("p_size") % 13 > 1).alias("tradable"))
    return listed_companies(a).select("p_partkey", "symbol", "name")


_WORDS = NOT_OPERATING
F4 = f"""SELECT p_partkey, replace(p_brand, '#', '.') AS symbol, p_name || CASE WHEN p_size % 7 = 0 THEN ' Units' WHEN p_size % 5 = 0 THEN ' united' ELSE '' END AS name FROM part
WHERE p_size % 13 > 1 AND p_size % 11 <> 0 AND regexp_full_match(upper(replace(p_brand, '#', '.')), '[A-Z][A-Z0-9.\\-]{{0,9}}') AND NOT regexp_matches(lower(p_name || CASE WHEN p_size % 7 = 0 THEN ' Units' WHEN p_size % 5 = 0 THEN ' united' ELSE '' END), '{_WORDS}')"""


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("day", F.col("ts").cast("date")).withColumn("symbol", F.concat(F.lit("U"), F.col("user_id")))
    order, regular = F.struct("ts", "tick_id"), minute_of_day(F.col("ts")) < 960
    d = t.groupBy("symbol", "user_id", "day").agg(
        F.max_by("price", order).alias("trade_price"), F.min_by("price", order).alias("minute_close"), F.max_by(F.when(regular, F.col("price")), F.when(regular, order)).alias("day_close"),
        F.sum("size").alias("day_volume"), F.max_by("size", order).alias("k"), F.max("ts").alias("trade_ts"),
    )
    w = Window.partitionBy("symbol").orderBy("day")
    prices = {"bid": F.col("trade_price") * (1 - F.col("k") / 2000), "ask": F.col("trade_price") * (1 + F.col("k") / 2000)}
    return d.withColumns({"prev_close": F.lag("trade_price").over(w), "prev_volume": F.lag("day_volume").over(w), **prices})


_SNAP = f"""{TICKS}, t AS (SELECT *, hour(((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')) * 60 + minute(((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')) AS m FROM ticks),
d AS (SELECT 'U' || user_id AS symbol, user_id, CAST(ts AS DATE) AS day, last(price ORDER BY ts, tick_id) AS trade_price, first(price ORDER BY ts, tick_id) AS minute_close, last(price ORDER BY ts, tick_id) FILTER (WHERE m < 960) AS day_close,
  sum(size)::BIGINT AS day_volume, last(size ORDER BY ts, tick_id) AS k, max(ts) AS trade_ts FROM t GROUP BY ALL),
snap AS (SELECT *, lag(trade_price) OVER w AS prev_close, lag(day_volume) OVER w AS prev_volume, trade_price * (1 - k / 2000) AS bid, trade_price * (1 + k / 2000) AS ask FROM d WINDOW w AS (PARTITION BY symbol ORDER BY day)),
c0 AS (SELECT *, coalesce(nullif(trade_price, 0), nullif(minute_close, 0), nullif(day_close, 0)) AS last_price FROM snap),
c1 AS (SELECT *, (last_price / nullif(prev_close, 0) - 1) * 100 AS drop_pct, prev_close * prev_volume AS prev_turnover, CASE WHEN bid > 0 AND ask >= bid THEN (ask - bid) / ((ask + bid) / 2) * 100 END AS spread_pct FROM c0),
cand AS (SELECT * FROM c1 WHERE prev_close > 0 AND last_price >= {MIN_PRICE} AND drop_pct <= -{MIN_DROP} AND coalesce(prev_turnover >= {MIN_TURNOVER}, TRUE))"""
_LOCAL = "((trade_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"
_CONTEXT = f"""{_SNAP}, x1 AS (SELECT *, hour({_LOCAL}) * 60 + minute({_LOCAL}) AS lm, isodow({_LOCAL}) AS dow FROM cand),
x2 AS (SELECT *, CASE WHEN dow >= 6 THEN 'closed' WHEN lm < 570 THEN 'pre_market' WHEN lm < 960 THEN 'regular' WHEN lm < 1200 THEN 'after_hours' ELSE 'closed' END AS price_session FROM x1),
x3 AS (SELECT *, CASE WHEN price_session = 'regular' THEN last_price ELSE day_close END AS regular_price FROM x2),
x4 AS (SELECT *, (regular_price / prev_close - 1) * 100 AS regular_move_pct, CASE WHEN regular_price > 0 AND price_session <> 'regular' THEN (last_price / regular_price - 1) * 100 END AS extended_move_pct FROM x3),
ctx AS (SELECT *, price_session IN ('pre_market', 'after_hours', 'closed') AND coalesce(regular_move_pct > -{MIN_DROP}, TRUE) AS extended_hours_only FROM x4)"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_context(drop_candidates(_snapshots(spark, sf_dir), MIN_DROP, MIN_PRICE, MIN_TURNOVER), MIN_DROP)


def f5_drop_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = drop_candidates(_snapshots(spark, sf_dir), MIN_DROP, MIN_PRICE, MIN_TURNOVER)
    return x.select("symbol", "day", "last_price", "prev_close", *[R(F.col(c)).alias(c) for c in ("drop_pct", "prev_turnover", "spread_pct")])


F5 = f"WITH {_SNAP} SELECT symbol, day, last_price, prev_close, round(drop_pct, 6) AS drop_pct, round(prev_turnover, 6) AS prev_turnover, round(spread_pct, 6) AS spread_pct FROM cand"


def f6_session_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("symbol", "day", "price_session", "regular_price", R(F.col("regular_move_pct")).alias("regular_move_pct"), R(F.col("extended_move_pct")).alias("extended_move_pct"), "extended_hours_only")


F6 = f"WITH {_CONTEXT} SELECT symbol, day, price_session, regular_price, round(regular_move_pct, 6) AS regular_move_pct, round(extended_move_pct, 6) AS extended_move_pct, extended_hours_only FROM ctx"


def q35_discovery_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of each day that both pools keep (a top-k report), in order of priority."""
    low = F.lower("text")
    news = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("user_id"), text_class(low).alias("event_class"), F.coalesce(risk_flags(low), F.array().cast("array<string>")).alias("risk_flags"))
    x = _candidates(spark, sf_dir).join(news, "user_id", "left").withColumns({"event_class": F.coalesce("event_class", F.lit("U")), "risk_flags": F.coalesce("risk_flags", F.array().cast("array<string>"))})
    x = x.withColumn("headlines", F.size("risk_flags"))
    return two_stage(x, "day", LIMIT, prefilter(UNIT), priority(F.col("points"))).select("day", "place", "symbol", "event_class", R(F.col("points")).alias("points"), R(F.col("priority"), 2).alias("priority"))


Q35 = f"""WITH {_CONTEXT}, news AS (SELECT doc_id AS user_id, {CLASS_SQL} AS event_class, coalesce({FLAG_SQL}, []) AS risk_flags FROM documents),
p AS (SELECT c.*, coalesce(event_class, 'U') AS event_class, coalesce(risk_flags, []) AS risk_flags, round(least(45.0::DOUBLE, greatest(0.0::DOUBLE, log10(greatest(1.0::DOUBLE, coalesce(prev_turnover, 0) / {UNIT})) * 12)) + CASE WHEN spread_pct <= 0.5 THEN 25 WHEN spread_pct <= 1 THEN 20 WHEN spread_pct <= 2 THEN 13 WHEN spread_pct <= 5 THEN 5 ELSE 0 END
  + least(18.0::DOUBLE, greatest(0.0::DOUBLE, (abs(least(drop_pct, 0.0)) - 12) * 0.65)) + CASE WHEN prev_volume <> 0 THEN least(12.0::DOUBLE, day_volume / prev_volume * 4) ELSE 0 END - CASE WHEN extended_hours_only THEN 10 ELSE 0 END, 6) AS points FROM ctx c LEFT JOIN news USING (user_id)),
first_pool AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY day ORDER BY points DESC, drop_pct, symbol) <= {pools(LIMIT)[0]}),
q AS (SELECT *, round(points + CASE event_class {' '.join(f"WHEN '{k}' THEN {v}" for k, v in CLASS_POINTS.items())} ELSE 0 END + least(8.0::DOUBLE, len(risk_flags) * 1.5) - coalesce(list_sum(list_transform(risk_flags, lambda f: CASE f {' '.join(f"WHEN '{k}' THEN {v}" for k, v in FLAG_PENALTIES.items())} ELSE 0 END)), 0), 2) AS priority FROM first_pool),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY priority DESC, drop_pct, symbol) AS place FROM q)
SELECT day, place, symbol, event_class, points, priority FROM r WHERE place <= {pools(LIMIT)[1]}"""

_SQL = {"f4_listed_companies": F4, "f5_drop_candidates": F5, "f6_session_context": F6, "q35_discovery_priority": Q35}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
