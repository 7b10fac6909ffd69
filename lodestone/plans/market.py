"""Queries on bars, snapshots, upserts and as-of look-ups, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import clock_grid, in_session, minute_of_day, session_label, trade_date
from ..operators.asof import asof, within_interval
from ..operators.bars import daily_features, path_outcome, snapshot_grid
from ..operators.keyed import insert_new, latest_per_key, merge_inventory, newest_active, upsert
from ..session import load
from ..sources.tables import bars, ticks

NY = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"
NYB = NY.replace("ts AT", "bar_ts AT")
TICKS = "ticks AS (SELECT event_type AS symbol, ts, value AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS size, event_id AS tick_id, user_id FROM events)"
LABEL = "CASE WHEN m >= 240 AND m < 570 THEN 'premarket' WHEN m >= 570 AND m < 960 THEN 'regular' WHEN m >= 960 AND m < 1200 THEN 'postmarket' ELSE 'overnight' END"
BARS = f"""{TICKS}, raw_bars AS (
  SELECT symbol, time_bucket(INTERVAL '15 minutes', ts) AS bar_ts, first(price ORDER BY ts, tick_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ts, tick_id) AS close, sum(size)::BIGINT AS volume, count(*) AS trade_count, sum(price * size) / nullif(sum(size), 0) AS vwap
  FROM ticks GROUP BY ALL), bars AS (
  SELECT *, {LABEL} AS session_label FROM (SELECT *, hour({NYB}) * 60 + minute({NYB}) AS m FROM raw_bars))"""

R = lambda c, n=6: F.round(c, n)


def q4_daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily_features(bars(spark, sf_dir))
    return d.select("symbol", "trade_date", "first_bar_ts", "last_bar_ts", "open", "high", "low", "close", "volume", "trade_count", "bar_count", *[R(c).alias(c) for c in ("vwap", "return_pct", "range_pct", "realised_volatility")])


DAILY = f"""day AS (
  SELECT symbol, CAST({NYB} AS DATE) AS trade_date, min(bar_ts) AS first_bar_ts, max(bar_ts) AS last_bar_ts, arg_min(open, bar_ts) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, bar_ts) AS close, sum(volume)::BIGINT AS volume, sum(trade_count)::BIGINT AS trade_count, count(*) AS bar_count,
         sum(vwap * volume) / nullif(sum(volume), 0) AS vwap, stddev_samp(ln(nullif(close, 0) / nullif(prev, 0))) AS realised_volatility
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol, session_label, CAST({NYB} AS DATE) ORDER BY bar_ts) AS prev FROM SRC) GROUP BY ALL)"""
DAILY_OUT = """SELECT symbol, trade_date, first_bar_ts, last_bar_ts, open, high, low, close, volume, trade_count, bar_count, round(vwap, 6) AS vwap,
  round(CASE WHEN open <> 0 THEN (close / open - 1) * 100 END, 6) AS return_pct, round(CASE WHEN open <> 0 THEN (high - low) / open * 100 END, 6) AS range_pct,
  round(realised_volatility, 6) AS realised_volatility FROM day"""
Q4 = f"WITH {BARS}, {DAILY.replace('SRC', 'bars')} {DAILY_OUT}"


def q4_regular_session_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily_features(bars(spark, sf_dir), "regular")
    return d.select("symbol", "trade_date", "first_bar_ts", "last_bar_ts", "open", "high", "low", "close", "volume", "trade_count", "bar_count", *[R(c).alias(c) for c in ("vwap", "return_pct", "range_pct", "realised_volatility")])


Q4R = f"WITH {BARS}, {DAILY.replace('SRC', 'bars').replace('FROM bars)', 'FROM bars WHERE session_label = ' + chr(39) + 'regular' + chr(39) + ')')} {DAILY_OUT}"


def f1_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).select("symbol", session_label(F.col("ts")).alias("session"), "size")
    return t.groupBy("symbol", "session").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))


F1 = f"WITH {TICKS} SELECT symbol, {LABEL} AS session, count(*) AS n, sum(size)::BIGINT AS volume FROM (SELECT *, hour({NY}) * 60 + minute({NY}) AS m FROM ticks) GROUP BY ALL"


def f2_session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, ts = ticks(spark, sf_dir), F.col("ts")
    modes = {"regular": in_session(ts, "regular"), "extended_weekdays": in_session(ts, "extended", weekdays_only=True), "night": in_session(ts, "custom", 20 * 60, 4 * 60), "always": in_session(ts, "custom", 60, 60)}
    return t.groupBy("symbol").agg(*[F.count_if(v).alias(k) for k, v in modes.items()])


F2 = f"""WITH {TICKS} SELECT symbol, count(*) FILTER (WHERE m >= 570 AND m < 960) AS regular, count(*) FILTER (WHERE m >= 240 AND m < 1200 AND isodow(l) <= 5) AS extended_weekdays,
  count(*) FILTER (WHERE m >= 1200 OR m < 240) AS night, count(*) AS always FROM (SELECT *, hour({NY}) * 60 + minute({NY}) AS m, {NY} AS l FROM ticks) GROUP BY ALL"""


def q5_snapshot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars at 09:30 and each half hour to 16:00, New York: the clock points become UTC and meet bars by equality."""
    b = bars(spark, sf_dir, 30)
    dates = b.select(trade_date(F.col("bar_ts")).alias("trade_date")).distinct()
    return snapshot_grid(b, clock_grid(dates, list(range(570, 961, 30)))).select("symbol", "trade_date", "minute", "bar_ts", "close", "volume")


Q5 = f"""WITH {BARS.replace("'15 minutes'", "'30 minutes'")} SELECT symbol, CAST({NYB} AS DATE) AS trade_date, m::INTEGER AS minute, bar_ts, close, volume FROM bars WHERE m BETWEEN 570 AND 960"""


def _slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, sf_dir, "orders")
    old = o.filter(F.year("o_orderdate") <= 1997).select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("price"), "o_orderkey")
    new = o.filter(F.year("o_orderdate") >= 1996).select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") * 2).alias("price"), "o_orderkey")
    first = [F.col("o_orderkey").asc()]
    return latest_per_key(old, ["o_custkey", "day"], *first), new


SLICES = """old AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderkey FROM orders WHERE year(o_orderdate) <= 1997
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1),
new AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice * 2 AS price, o_orderkey FROM orders WHERE year(o_orderdate) >= 1996
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1)"""


def d1_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _slices(spark, sf_dir)
    return insert_new(old, new, ["o_custkey", "day"], F.col("o_orderkey").asc())


D1 = f"WITH {SLICES} SELECT * FROM old UNION ALL SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.o_custkey = n.o_custkey AND o.day = n.day)"


def d2_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _slices(spark, sf_dir)
    return upsert(old, new, ["o_custkey", "day"], F.col("o_orderkey").asc())


D2 = f"WITH {SLICES} SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE o.o_custkey = n.o_custkey AND o.day = n.day)"


def d3_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _slices(spark, sf_dir)
    ledger = lambda d: d.groupBy("o_custkey").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n"))
    return merge_inventory(ledger(old), ledger(new), ["o_custkey"], "first_day", "last_day", "n")


D3 = """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, year(o_orderdate) AS y FROM orders), rows AS (
  SELECT DISTINCT o_custkey, day, 0 AS src, NULL::BIGINT AS k FROM o WHERE y <= 1997 UNION ALL SELECT o_custkey, day, 1, o_orderkey FROM o WHERE y >= 1996)
SELECT o_custkey, min(day) AS first_day, max(day) AS last_day, count(*) AS n FROM rows GROUP BY 1"""


def d6_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order of each customer before a cut-off date: point in time, ties by key."""
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return latest_per_key(o, ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


D6 = "SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"


def d7_preferred_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current run of each customer: finished orders before all others, then the newest."""
    kind = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return latest_per_key(load(spark, sf_dir, "orders"), ["o_custkey"], kind, F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "o_orderstatus")


D7 = "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) = 1"


def d9_newest_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_active(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select("o_orderkey", "active")


D9 = "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS active FROM orders"


def d12_ordered_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen items of each source by their whole normalised text, at most ten; empty keys (null texts too) are not deduplicated."""
    text = F.coalesce(F.lower(F.trim("text")), F.lit(""))
    d = load(spark, sf_dir, "documents").select("source", "doc_id", F.when(text == "", "").otherwise(F.sha2(text, 256)).alias("key"))
    seen = F.row_number().over(Window.partitionBy("source", "key").orderBy("doc_id"))
    once = d.withColumn("seen", seen).filter((F.col("seen") == 1) | (F.col("key") == ""))
    return latest_per_key(once, ["source"], F.col("doc_id").asc(), keep=10).select("source", "doc_id")


D12 = """WITH d AS (SELECT source, doc_id, lower(trim(coalesce(text, ''))) AS key FROM documents), once AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY source, key ORDER BY doc_id) = 1 OR key = '')
SELECT source, doc_id FROM once QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10"""


def d13_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("minute", F.date_trunc("minute", "ts"))
    return latest_per_key(t, ["symbol", "minute"], F.col("ts").desc(), F.col("tick_id").desc()).groupBy("symbol").agg(F.count("*").alias("minutes"), R(F.sum("price"), 4).alias("price_sum"))


D13 = f"""WITH {TICKS}, l AS (SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts) ORDER BY ts DESC, tick_id DESC) = 1)
SELECT symbol, count(*) AS minutes, round(sum(price), 4) AS price_sum FROM l GROUP BY 1"""


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).filter("symbol = 'purchase'")
    return t.select(F.col("tick_id").alias("left_id"), F.col("user_id").alias("user"), F.col("ts").alias("at"))


def j13_asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last view strictly before each purchase of the user, within a day."""
    views = ticks(spark, sf_dir).filter("symbol = 'view'").select(F.col("user_id").alias("user"), F.col("ts").alias("seen"), F.col("tick_id").alias("view_id"), "price")
    out = asof(_clicks(spark, sf_dir), views, "user", "at", "seen", 86_400, tie=[-F.col("view_id")])
    return out.select("left_id", "view_id", "price")


J13 = f"""WITH {TICKS}, p AS (SELECT * FROM ticks WHERE symbol = 'purchase'), v AS (SELECT * FROM ticks WHERE symbol = 'view'), m AS (
  SELECT p.tick_id AS left_id, v.tick_id AS view_id, v.price FROM p JOIN v ON p.user_id = v.user_id AND v.ts < p.ts AND v.ts >= p.ts - INTERVAL 1 DAY
  QUALIFY row_number() OVER (PARTITION BY p.tick_id ORDER BY v.ts DESC, v.tick_id DESC) = 1)
SELECT p.tick_id AS left_id, m.view_id, m.price FROM p LEFT JOIN m ON m.left_id = p.tick_id"""


def j14_asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first click at or after each purchase of the user, within six hours."""
    clicks = ticks(spark, sf_dir).filter("symbol = 'click'").select(F.col("user_id").alias("user"), F.col("ts").alias("next_at"), F.col("tick_id").alias("click_id"))
    return asof(_clicks(spark, sf_dir), clicks, "user", "at", "next_at", 21_600, forward=True, strict=False, tie=[F.col("click_id")]).select("left_id", "click_id", "next_at")


J14 = f"""WITH {TICKS}, p AS (SELECT * FROM ticks WHERE symbol = 'purchase'), c AS (SELECT * FROM ticks WHERE symbol = 'click'), m AS (
  SELECT p.tick_id AS left_id, c.tick_id AS click_id, c.ts AS next_at FROM p JOIN c ON p.user_id = c.user_id AND c.ts >= p.ts AND c.ts <= p.ts + INTERVAL 6 HOUR
  QUALIFY row_number() OVER (PARTITION BY p.tick_id ORDER BY c.ts, c.tick_id) = 1)
SELECT p.tick_id AS left_id, m.click_id, m.next_at FROM p LEFT JOIN m ON m.left_id = p.tick_id"""


def j16_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of an order in the 30 days after it."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias("stop"))
    line = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("shipped"), "l_extendedprice")
    return within_interval(o, line, "k", "start", "stop", "shipped", 30 * 86_400).groupBy("k").agg(F.count("*").alias("n"), R(F.sum("l_extendedprice"), 2).alias("value"))


J16 = "SELECT o_orderkey AS k, count(*) AS n, round(sum(l_extendedprice), 2) AS value FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY GROUP BY 1"


def j12_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    with_orders = c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", F.lit("active").alias("state"))
    return with_orders.unionByName(c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", F.lit("idle").alias("state")))


J12 = "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'active' ELSE 'idle' END AS state FROM customer"


def j17_next_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol's close and its close on the next date of the common calendar (which has few rows)."""
    d = daily_features(bars(spark, sf_dir)).select("symbol", "trade_date", "close")
    calendar = d.select("trade_date").distinct().withColumn("next_date", F.lead("trade_date").over(Window.orderBy("trade_date")))
    nxt = d.select("symbol", F.col("trade_date").alias("next_date"), F.col("close").alias("next_close"))
    return d.join(calendar, "trade_date").join(nxt, ["symbol", "next_date"], "left").select("symbol", "trade_date", "next_date", "close", "next_close")


J17 = f"""WITH {BARS}, {DAILY.replace('SRC', 'bars')}, cal AS (SELECT trade_date, lead(trade_date) OVER (ORDER BY trade_date) AS next_date FROM (SELECT DISTINCT trade_date FROM day))
SELECT d.symbol, d.trade_date, c.next_date, d.close, n.close AS next_close FROM day d JOIN cal c USING (trade_date) LEFT JOIN day n ON n.symbol = d.symbol AND n.trade_date = c.next_date"""


def q49_path_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excursions in the four hours after each bar of 14:00 New York."""
    b = bars(spark, sf_dir)
    signals = b.filter(minute_of_day(F.col("bar_ts")) == 840).select(F.concat_ws("|", "symbol", F.col("bar_ts").cast("string")).alias("signal_id"), "symbol", F.col("bar_ts").alias("signal_ts"))
    out = path_outcome(signals, b, 240)
    return out.select("symbol", "signal_ts", "entry", "bars", "top_ts", *[R(c).alias(c) for c in ("mfe_pct", "mae_pct", "close_pct")])


Q49 = f"""WITH {BARS}, s AS (SELECT symbol, bar_ts AS signal_ts FROM bars WHERE m = 840), a AS (
  SELECT s.symbol, signal_ts, arg_min(open, bar_ts) AS entry, max(high) AS top, min(low) AS bottom, arg_max(close, bar_ts) AS exit, count(*) AS bars,
         first(bar_ts ORDER BY high DESC, bar_ts) AS top_ts
  FROM s JOIN bars b ON b.symbol = s.symbol AND bar_ts > signal_ts AND bar_ts <= signal_ts + INTERVAL 240 MINUTE GROUP BY ALL)
SELECT symbol, signal_ts, entry, bars, top_ts, round((top / nullif(entry, 0) - 1) * 100, 6) AS mfe_pct, round((bottom / nullif(entry, 0) - 1) * 100, 6) AS mae_pct, round((exit / nullif(entry, 0) - 1) * 100, 6) AS close_pct FROM a"""


def q46_bar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns over 1, 4 and 12 bars, moving averages, RSI 14 (simple means), ATR 14 and volume z-score by bar ordinal."""
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    back = lambda n: w.rowsBetween(-(n - 1), 0)
    b = bars(spark, sf_dir).withColumn("prev", F.lag("close").over(w)).withColumn("move", F.col("close") - F.col("prev"))
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev")), F.abs(F.col("low") - F.col("prev")))
    b = b.withColumn("up", F.greatest("move", F.lit(0.0))).withColumn("down", F.greatest(-F.col("move"), F.lit(0.0))).withColumn("tr", true_range)
    ret = lambda n: (F.col("close") / F.nullif(F.lag("close", n).over(w), F.lit(0.0)) - 1) * 100
    gain, loss = F.avg("up").over(back(14)), F.avg("down").over(back(14))
    z = (F.col("volume") - F.avg("volume").over(back(20))) / F.nullif(F.stddev_samp("volume").over(back(20)), F.lit(0.0))
    full = lambda c, n: F.when(F.count("move").over(back(n)) == n, c)
    return b.select("symbol", "bar_ts", R(ret(1)).alias("ret1"), R(ret(4)).alias("ret4"), R(ret(12)).alias("ret12"), R(F.avg("close").over(back(20))).alias("sma20"),
        R(full(100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0))), 14)).alias("rsi14"), R(full(F.avg("tr").over(back(14)), 14)).alias("atr14"), R(z).alias("volume_z"))


Q46 = f"""WITH {BARS}, p AS (SELECT *, lag(close) OVER w AS prev FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)), q AS (
  SELECT *, close - prev AS move, CASE WHEN prev IS NULL THEN NULL ELSE greatest(close - prev, 0) END AS up, CASE WHEN prev IS NULL THEN NULL ELSE greatest(prev - close, 0) END AS down, greatest(high - low, abs(high - prev), abs(low - prev)) AS tr FROM p)
SELECT symbol, bar_ts, round((close / nullif(lag(close, 1) OVER w, 0) - 1) * 100, 6) AS ret1, round((close / nullif(lag(close, 4) OVER w, 0) - 1) * 100, 6) AS ret4,
  round((close / nullif(lag(close, 12) OVER w, 0) - 1) * 100, 6) AS ret12, round(avg(close) OVER w20, 6) AS sma20,
  round(CASE WHEN count(move) OVER w14 = 14 THEN 100 - 100 / (1 + avg(up) OVER w14 / nullif(avg(down) OVER w14, 0)) END, 6) AS rsi14,
  round(CASE WHEN count(move) OVER w14 = 14 THEN avg(tr) OVER w14 END, 6) AS atr14, round((volume - avg(volume) OVER w20) / nullif(stddev_samp(volume) OVER w20, 0), 6) AS volume_z
FROM q WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts), w14 AS (PARTITION BY symbol ORDER BY bar_ts ROWS 13 PRECEDING), w20 AS (PARTITION BY symbol ORDER BY bar_ts ROWS 19 PRECEDING)"""


def q51_quote_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol and hour in which it trades with its first valid tick at least a second after the hour and within ten minutes, or nulls."""
    t = ticks(spark, sf_dir)
    hour = F.date_trunc("hour", "ts")
    late = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(hour.cast("timestamp"))) / 1000
    t = t.withColumn("target", hour.cast("timestamp_ntz")).withColumn("latency_ms", late)
    valid = F.expr("price > 0 and size > 0 and latency_ms >= 1000 and latency_ms <= 600000")
    first = F.min(F.when(valid, F.struct("latency_ms", "tick_id")))
    return t.groupBy("symbol", "target").agg(first.alias("f")).select("symbol", "target", "f.tick_id", R(F.col("f.latency_ms"), 3).alias("latency_ms"))


Q51 = f"""WITH {TICKS}, n AS (SELECT *, date_trunc('hour', ts)::TIMESTAMP AS target, (epoch_us(ts) - epoch_us(date_trunc('hour', ts)::TIMESTAMP)) / 1000 AS latency_ms FROM ticks),
v AS (SELECT * FROM n WHERE price > 0 AND size > 0 AND latency_ms >= 1000 AND latency_ms <= 600000 QUALIFY row_number() OVER (PARTITION BY symbol, target ORDER BY latency_ms, tick_id) = 1)
SELECT t.symbol, t.target, v.tick_id, round(v.latency_ms, 3) AS latency_ms FROM (SELECT DISTINCT symbol, target FROM n) t LEFT JOIN v ON v.symbol = t.symbol AND v.target = t.target"""


def a14_pivot_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["click", "error", "purchase", "signup", "view"]
    t = ticks(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    return t.groupBy("day").pivot("symbol", names).agg(R(F.max("price"), 6)).select("day", *[F.col(n).alias(f"{n}_max") for n in names])


A14 = f"WITH {TICKS} SELECT CAST(ts AS DATE) AS day, {', '.join(f'round(max(price) FILTER (WHERE symbol = {chr(39)}{n}{chr(39)}), 6) AS {n}_max' for n in ('click', 'error', 'purchase', 'signup', 'view'))} FROM ticks GROUP BY 1"


def q55_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays up to 14 days after each user's last active day (to 15 January) on which the user has no tick."""
    t = ticks(spark, sf_dir).select("user_id", F.col("ts").cast("date").alias("day")).distinct()
    last = t.filter("day <= date '2024-01-15'").groupBy("user_id").agg(F.max("day").alias("last"))
    wanted = last.select("user_id", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 14))).alias("day")).filter(F.weekday("day") < 5)
    return wanted.join(t, ["user_id", "day"], "left_anti")


Q55 = f"""WITH {TICKS}, t AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM ticks), l AS (SELECT user_id, max(day) AS last FROM t WHERE day <= DATE '2024-01-15' GROUP BY 1),
w AS (SELECT user_id, CAST(unnest(generate_series(last + 1, last + 14, INTERVAL 1 DAY)) AS DATE) AS day FROM l)
SELECT user_id, day FROM w WHERE isodow(day) <= 5 AND NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = w.user_id AND t.day = w.day)"""


def f3_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe of parts: set of types, size limit, include and exclude pattern."""
    p = load(spark, sf_dir, "part")
    ok = F.col("p_type").isin("ECONOMY", "STANDARD") & (F.col("p_size") <= 25) & F.col("p_name").rlike("^[a-m]") & ~F.col("p_name").rlike("ring")
    return p.filter(ok).select("p_partkey", "p_name", "p_brand")


F3 = "SELECT p_partkey, p_name, p_brand FROM part WHERE p_type IN ('ECONOMY', 'STANDARD') AND p_size <= 25 AND regexp_matches(p_name, '^[a-m]') AND NOT regexp_matches(p_name, 'ring')"


def q2_task_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load tasks: batches of 20 symbols (by number) times windows of 7 days, with a stable id."""
    users = ticks(spark, sf_dir).select(F.col("user_id").alias("symbol")).distinct().withColumn("batch", F.floor(F.col("symbol") / 20))
    batches = users.groupBy("batch").agg(F.sort_array(F.collect_list("symbol")).alias("symbols"))
    starts = F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-29").cast("date"), F.expr("interval 7 days")))
    out = batches.select("batch", F.array_join(F.col("symbols").cast("array<string>"), ",").alias("symbols"), starts.alias("window_start"))
    return out.withColumn("task_id", F.substring(F.sha2(F.concat_ws("|", "symbols", F.col("window_start").cast("string")), 256), 1, 16))


Q2 = f"""WITH {TICKS}, b AS (SELECT user_id // 20 AS batch, string_agg(user_id::VARCHAR, ',' ORDER BY user_id) AS symbols FROM (SELECT DISTINCT user_id FROM ticks) GROUP BY 1), w AS (
  SELECT *, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-29', INTERVAL 7 DAY)) AS DATE) AS window_start FROM b)
SELECT batch, symbols, window_start, substr(sha256(symbols || '|' || window_start::VARCHAR), 1, 16) AS task_id FROM w"""

QUERIES = {f.__name__: f for f in (q4_daily_features, q4_regular_session_features, f1_session_counts, f2_session_filter, q5_snapshot_grid, d1_insert_new, d2_upsert, d3_inventory, d6_latest_per_key, d7_preferred_kind, d9_newest_active, d12_ordered_dedup, d13_last_wins, j13_asof_backward, j14_asof_forward, j16_interval_join, j12_semi_anti, j17_next_session, q49_path_outcome, q46_bar_features, q51_quote_audit, a14_pivot_hours, q55_missing_days, f3_universe, q2_task_plan)}
ORACLES = dict(zip(QUERIES, (Q4, Q4R, F1, F2, Q5, D1, D2, D3, D6, D7, D9, D12, D13, J13, J14, J16, J12, J17, Q49, Q46, Q51, A14, Q55, F3, Q2), strict=True))
