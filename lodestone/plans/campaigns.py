"""Research campaigns: ranks, baskets, rolling forecasts, pair ledgers, gates and inference, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import benjamini_hochberg, equity, summarise, trade_metrics
from ..operators.ranks import normalised_ranks, ordered_names, rank_where, tail_state
from ..session import load
from ..sources.tables import panel, ticks
from .market import TICKS, R

PANEL = f"""{TICKS}, panel0 AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS signal_date, first(price ORDER BY ts, tick_id) AS open, last(price ORDER BY ts, tick_id) AS close, max(price) AS high,
         min(price) AS low, sum(size)::BIGINT AS volume, count(*) AS n_ticks FROM ticks GROUP BY ALL),
panel AS (SELECT *, lead(open) OVER w AS next_open, lead(close) OVER w AS next_close FROM panel0 WINDOW w AS (PARTITION BY symbol ORDER BY signal_date))"""
MET = {
    "avg_net": "avg({n})", "median_net": "median({n})", "win_rate": "avg(({n} > 0)::INT)", "avg_win": "avg({n}) FILTER (WHERE {n} > 0)", "avg_loss": "avg({n}) FILTER (WHERE {n} < 0)",
    "worst": "min({n})", "best": "max({n})", "profit_factor": "sum({n}) FILTER (WHERE {n} > 0) / nullif(abs(sum({n}) FILTER (WHERE {n} < 0)), 0)",
    "t_stat": "avg({n}) / nullif(stddev_samp({n}) / sqrt(count({n})), 0)", "concentration": "max({n}) FILTER (WHERE {n} > 0) / nullif(sum({n}) FILTER (WHERE {n} > 0), 0)",
}


def metrics_sql(net: str) -> str:
    return f"count({net}) AS trades, " + ", ".join(f"round({v.format(n=net)}, 6) + 0.0 AS {k}" for k, v in MET.items())


def _network(spark: SparkSession, sf_dir: str, lookback: int) -> DataFrame:
    """Gap states of sources against the next returns of targets, with rolling experts of the same state; self pairs count too.

    The score window is cut after the rolling window, so history stays whole.
    """
    d = ticks(spark, sf_dir).withColumn("h", F.date_trunc("hour", "ts")).groupBy("symbol", "h").agg(F.avg("price").alias("p"))
    w = Window.partitionBy("symbol").orderBy("h")
    d = d.withColumn("gap", F.round((F.try_divide("p", F.lag("p").over(w)) - 1) * 100, 8)).withColumn("nxt", F.round((F.try_divide(F.lead("p").over(w), "p") - 1) * 100, 5)).filter("gap is not null and nxt is not null")
    state = F.when(F.col("gap") < -20, "G1").when(F.col("gap") < -5, "G2").when(F.col("gap") < 0, "G3").when(F.col("gap") < 5, "G4").when(F.col("gap") < 20, "G5").otherwise("G6")
    g = d.withColumn("state", state)
    source = g.filter(F.col("symbol").isin("click", "view", "purchase", "error")).select(F.col("symbol").alias("source"), "h", "state")
    pairs = source.join(g.select(F.col("symbol").alias("target"), "h", "nxt"), "h")
    back = Window.partitionBy("source", "target", "state").orderBy("h").rowsBetween(-lookback, -1)
    rolled = pairs.select("*", F.count("nxt").over(back).alias("n"), F.avg("nxt").over(back).alias("mean"), F.stddev_samp("nxt").over(back).alias("sd"))
    live = rolled.filter((F.col("n") == lookback) & F.col("sd").isNotNull() & (F.col("h") >= F.lit("2024-01-10").cast("timestamp_ntz")))
    live = live.withColumn("weight", 1 / (F.col("sd") * F.col("sd") + 0.0625))
    out = live.groupBy("h", "target").agg(F.count("*").alias("experts"), F.round(F.sum(F.col("mean") * F.col("weight")) / F.sum("weight"), 7).alias("forecast"), F.max("nxt").alias("realised"), F.round(F.max("weight") / F.sum("weight"), 7).alias("max_share"))
    return out.filter("experts >= 3")


def q17_network_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books of the best and worst forecast target per hour, reversed, where forecasts span zero; after costs of 5 to 20 bp."""
    f = _network(spark, sf_dir, 10)
    day = Window.partitionBy("h")
    ranked = f.select("*", F.row_number().over(day.orderBy(F.col("forecast").desc(), "target")).alias("top"), F.row_number().over(day.orderBy("forecast", "target")).alias("bottom"))
    at = lambda c, r: F.max(F.when(F.col(r) == 1, F.col(c)))
    books = ranked.groupBy("h").agg(
        F.count("*").alias("targets"), F.min("forecast").alias("low"), F.max("forecast").alias("high"), at("target", "top").alias("top_symbol"), at("target", "bottom").alias("bottom_symbol"),
        at("realised", "top").alias("top_return"), at("realised", "bottom").alias("bottom_return"), F.greatest(at("max_share", "top"), at("max_share", "bottom")).alias("max_share"),
    )
    gross = 0.5 * F.col("bottom_return") - 0.5 * F.col("top_return")
    return books.filter("targets = 5 and low < 0 and high > 0").select("h", "top_symbol", "bottom_symbol", "max_share", R(gross).alias("gross"), *[R(gross - bp / 100).alias(f"net{bp}") for bp in (5, 10, 15, 20)])


Q17 = f"""WITH {TICKS}, d0 AS (SELECT symbol, date_trunc('hour', ts)::TIMESTAMP AS h, avg(price) AS p FROM ticks GROUP BY ALL),
d AS (SELECT symbol, h, round((p / nullif(lag(p) OVER w, 0) - 1) * 100, 8) AS gap, round((lead(p) OVER w / nullif(p, 0) - 1) * 100, 5) AS nxt FROM d0 WINDOW w AS (PARTITION BY symbol ORDER BY h)),
g AS (SELECT *, CASE WHEN gap < -20 THEN 'G1' WHEN gap < -5 THEN 'G2' WHEN gap < 0 THEN 'G3' WHEN gap < 5 THEN 'G4' WHEN gap < 20 THEN 'G5' ELSE 'G6' END AS state FROM d WHERE gap IS NOT NULL AND nxt IS NOT NULL),
pairs AS (SELECT s.symbol AS source, t.symbol AS target, h, s.state, t.nxt FROM g s JOIN g t USING (h) WHERE s.symbol IN ('click', 'view', 'purchase', 'error')),
rolled AS (SELECT *, count(nxt) OVER b AS n, avg(nxt) OVER b AS mean, stddev_samp(nxt) OVER b AS sd FROM pairs WINDOW b AS (PARTITION BY source, target, state ORDER BY h ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
live AS (SELECT *, 1 / (sd * sd + 0.0625) AS weight FROM rolled WHERE n = 10 AND sd IS NOT NULL AND h >= TIMESTAMP '2024-01-10'),
f AS (SELECT h, target, round(sum(mean * weight) / sum(weight), 7) AS forecast, max(nxt) AS realised, round(max(weight) / sum(weight), 7) AS max_share FROM live GROUP BY h, target HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY forecast DESC, target) AS tp, row_number() OVER (PARTITION BY h ORDER BY forecast, target) AS bt FROM f),
b AS (SELECT h, count(*) AS targets, min(forecast) AS low, max(forecast) AS high, max(target) FILTER (WHERE tp = 1) AS top_symbol, max(target) FILTER (WHERE bt = 1) AS bottom_symbol,
  0.5 * max(realised) FILTER (WHERE bt = 1) - 0.5 * max(realised) FILTER (WHERE tp = 1) AS gross, greatest(max(max_share) FILTER (WHERE tp = 1), max(max_share) FILTER (WHERE bt = 1)) AS max_share FROM r GROUP BY h)
SELECT h, top_symbol, bottom_symbol, max_share, round(gross, 6) AS gross, round(gross - 0.05, 6) AS net5, round(gross - 0.10, 6) AS net10, round(gross - 0.15, 6) AS net15, round(gross - 0.20, 6) AS net20
FROM b WHERE targets = 5 AND low < 0 AND high > 0"""

FEATURES = ["day_return", "location", "drawdown", "activity"]


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily signals of days with a range and a price; an opening price of zero is none."""
    p = panel(spark, sf_dir).filter("high > low and open > 0")
    return p.select("symbol", "signal_date", "next_open", "next_close", (F.try_divide("close", "open") - 1).alias("day_return"), ((F.col("close") - F.col("low")) / (F.col("high") - F.col("low"))).alias("location"), (F.try_divide("low", "open") - 1).alias("drawdown"), F.col("n_ticks").cast("double").alias("activity"))


SIGNALS = f"""{PANEL}, sig AS (SELECT symbol, signal_date, next_open, next_close, close / open - 1 AS day_return, (close - low) / (high - low) AS location, low / open - 1 AS drawdown, n_ticks::DOUBLE AS activity FROM panel WHERE high > low AND open > 0)"""


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = normalised_ranks(_signals(spark, sf_dir), ["signal_date"], "symbol", FEATURES)
    score = sum((F.col(f"{f}_rank") for f in FEATURES), F.lit(0.0)) / len(FEATURES)
    scored = ranked.filter("n >= 20").withColumn("score", F.round(score, 9))
    ok = F.col("next_open").isNotNull() & (F.col("next_open") >= 5)
    return scored.withColumn("eligible", ok).withColumn("weak", rank_where(ok, ["signal_date"], F.col("score"), F.col("symbol"))).withColumn("strong", rank_where(ok, ["signal_date"], F.col("score").desc(), F.col("symbol")))


BASKETS = SIGNALS + ", ranked AS (SELECT *, count(*) OVER (PARTITION BY signal_date) AS n, " + ", ".join(f"row_number() OVER (PARTITION BY signal_date ORDER BY {f}, symbol) AS r_{f}" for f in FEATURES) + " FROM sig), scored AS (SELECT *, round((" + " + ".join(f"(r_{f} - 1)::DOUBLE / nullif(n - 1, 0)" for f in FEATURES) + f") / {len(FEATURES)}, 9) AS score, next_open IS NOT NULL AND next_open >= 5 AS eligible FROM ranked WHERE n >= 20), placed AS (SELECT *, CASE WHEN eligible THEN row_number() OVER (PARTITION BY signal_date, eligible ORDER BY score, symbol) END AS weak, CASE WHEN eligible THEN row_number() OVER (PARTITION BY signal_date, eligible ORDER BY score DESC, symbol) END AS strong FROM scored)"


def q13_composite_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _baskets(spark, sf_dir).select("signal_date", "symbol", F.col("n").alias("universe"), "score", "eligible", "weak", "strong")


Q13R = f"WITH {BASKETS} SELECT signal_date, symbol, n AS universe, score, eligible, weak, strong FROM placed"


def _daily_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per date, basket size and construction, with the first reason for which a trade is excluded."""
    tops = F.explode(F.array(F.lit(1), F.lit(3)))
    b = _baskets(spark, sf_dir).withColumn("top_n", tops)
    ret = F.col("next_close") / F.nullif(F.col("next_open"), F.lit(0.0)) - 1
    mean = lambda side: F.avg(F.when((F.col(side) <= F.col("top_n")) & F.col("next_close").isNotNull(), ret))
    names = lambda side: F.count_if(F.col(side) <= F.col("top_n"))
    listed = lambda side: F.transform(F.array_sort(F.collect_list(F.when(F.col(side) <= F.col("top_n"), F.struct(F.col(side).alias("r"), F.col("symbol").alias("s"))))), lambda x: x["s"])
    day = b.groupBy("signal_date", "top_n").agg(F.max("n").alias("universe"), names("weak").alias("weak_names"), names("strong").alias("strong_names"), mean("weak").alias("weak_return"), mean("strong").alias("strong_return"), listed("weak").alias("weak_symbols"), listed("strong").alias("strong_symbols"))
    day = day.withColumn("overlap", F.arrays_overlap("weak_symbols", "strong_symbols")).withColumn("construction", F.explode(F.array(F.lit("SHORT_WEAK"), F.lit("STRONG_MINUS_WEAK"))))
    both = F.col("construction") == "STRONG_MINUS_WEAK"
    reason = F.when(F.col("universe") < 30, "UNIVERSE").when(F.col("weak_names") < F.col("top_n"), "WEAK_NAMES").when(both & (F.col("strong_names") < F.col("top_n")), "STRONG_NAMES").when(both & F.col("overlap"), "OVERLAP")
    gross = F.when(both, 0.5 * (F.col("strong_return") - F.col("weak_return"))).otherwise(-F.col("weak_return"))
    return day.withColumn("gross", gross).withColumn("excluded", reason).withColumn("net", F.when(F.col("excluded").isNull(), F.col("gross") - 0.001))


BOOK = BASKETS + """, day AS (SELECT signal_date, top_n, max(n) AS universe, count(*) FILTER (WHERE weak <= top_n) AS weak_names, count(*) FILTER (WHERE strong <= top_n) AS strong_names,
  avg(next_close / nullif(next_open, 0) - 1) FILTER (WHERE weak <= top_n AND next_close IS NOT NULL) AS weak_return, avg(next_close / nullif(next_open, 0) - 1) FILTER (WHERE strong <= top_n AND next_close IS NOT NULL) AS strong_return,
  coalesce(array_agg(symbol ORDER BY weak) FILTER (WHERE weak <= top_n), []) AS weak_symbols, coalesce(array_agg(symbol ORDER BY strong) FILTER (WHERE strong <= top_n), []) AS strong_symbols
  FROM placed CROSS JOIN (VALUES (1), (3)) t(top_n) GROUP BY ALL),
book AS (SELECT *, CASE WHEN construction = 'SHORT_WEAK' THEN -weak_return ELSE 0.5 * (strong_return - weak_return) END AS gross,
  CASE WHEN universe < 30 THEN 'UNIVERSE' WHEN weak_names < top_n THEN 'WEAK_NAMES' WHEN construction <> 'SHORT_WEAK' AND strong_names < top_n THEN 'STRONG_NAMES' WHEN construction <> 'SHORT_WEAK' AND list_has_any(weak_symbols, strong_symbols) THEN 'OVERLAP' END AS excluded
  FROM day CROSS JOIN (VALUES ('SHORT_WEAK'), ('STRONG_MINUS_WEAK')) c(construction)),
ledger AS (SELECT *, CASE WHEN excluded IS NULL THEN gross - 0.001 END AS net FROM book)"""


def q13_daily_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _daily_book(spark, sf_dir)
    return d.select("signal_date", "top_n", "construction", "universe", F.array_join("weak_symbols", ",").alias("weak"), F.array_join("strong_symbols", ",").alias("strong"), (R(F.col("gross")) + 0.0).alias("gross"), (R(F.col("net")) + 0.0).alias("net"), "excluded")


Q13D = f"WITH {BOOK} SELECT signal_date, top_n, construction, universe, array_to_string(weak_symbols, ',') AS weak, array_to_string(strong_symbols, ',') AS strong, round(gross, 6) + 0.0 AS gross, round(net, 6) + 0.0 AS net, excluded FROM ledger"

SCOPES = [("DISCOVERY", "2024-01-01", "2024-01-14"), ("INNER", "2024-01-15", "2024-01-22"), ("OUTER", "2024-01-23", "2024-01-31"), ("COMBINED", "2024-01-15", "2024-01-31")]


def _scopes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCOPES, "scope string, a string, b string").select("scope", F.col("a").cast("date").alias("scope_start"), F.col("b").cast("date").alias("scope_end"))


SCOPES_SQL = "scopes(scope, scope_start, scope_end) AS (VALUES " + ", ".join(f"('{s}', DATE '{a}', DATE '{b}')" for s, a, b in SCOPES) + ")"


def q13_scope_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by overlapping date scopes (a broadcast range join: four scope rows)."""
    d = _daily_book(spark, sf_dir)
    met = d.join(F.broadcast(_scopes(spark)), F.col("signal_date").between(F.col("scope_start"), F.col("scope_end")))
    return summarise(met, ["scope", "construction", "top_n"], "net")


Q13M = f"WITH {BOOK}, {SCOPES_SQL} SELECT scope, construction, top_n, {metrics_sql('net')} FROM ledger JOIN scopes ON signal_date BETWEEN scope_start AND scope_end GROUP BY ALL"


def q22_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner, outer and combined gates side by side, from one pivoted pass over the metrics."""
    m = q13_scope_metrics(spark, sf_dir)
    wide = m.groupBy("construction", "top_n").pivot("scope", ["INNER", "OUTER", "COMBINED"]).agg(F.max("trades").alias("trades"), F.max("avg_net").alias("avg"), F.max("median_net").alias("median"), F.max("win_rate").alias("win"), F.max("profit_factor").alias("pf"))
    gate = lambda s, n, win, pf: (F.col(f"{s}_trades") >= n) & (F.col(f"{s}_avg") > 0) & (F.col(f"{s}_median") > 0) & (F.col(f"{s}_win") > win) & (F.col(f"{s}_pf") > pf)
    return wide.select("construction", "top_n", gate("INNER", 5, 0.5, 1.1).alias("inner_pass"), gate("OUTER", 5, 0.5, 1.0).alias("outer_pass"), gate("COMBINED", 10, 0.5, 1.05).alias("combined_pass"))


Q22 = f"""WITH {BOOK}, {SCOPES_SQL}, m AS (SELECT scope, construction, top_n, {metrics_sql('net')} FROM ledger JOIN scopes ON signal_date BETWEEN scope_start AND scope_end GROUP BY ALL)
SELECT i.construction, i.top_n, i.trades >= 5 AND i.avg_net > 0 AND i.median_net > 0 AND i.win_rate > 0.5 AND i.profit_factor > 1.1 AS inner_pass,
 o.trades >= 5 AND o.avg_net > 0 AND o.median_net > 0 AND o.win_rate > 0.5 AND o.profit_factor > 1.0 AS outer_pass, c.trades >= 10 AND c.avg_net > 0 AND c.median_net > 0 AND c.win_rate > 0.5 AND c.profit_factor > 1.05 AS combined_pass
FROM m i JOIN m o USING (construction, top_n) JOIN m c USING (construction, top_n) WHERE i.scope = 'INNER' AND o.scope = 'OUTER' AND c.scope = 'COMBINED'"""


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = load(spark, sf_dir, "lineitem")
    return line.select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"), (F.col("l_discount") - F.col("l_tax")).alias("gross"), "l_orderkey", "l_quantity")


LEDGER = "led AS (SELECT l_returnflag, l_linestatus, l_linenumber, CAST(l_shipdate AS DATE) AS day, l_discount - l_tax AS gross, l_orderkey, l_quantity FROM lineitem)"


def q11_tail_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _ledger(spark, sf_dir).withColumn("net", F.col("gross") - 0.01)
    return summarise(d, ["l_returnflag", "l_linestatus", "l_linenumber"], "net").withColumn("candidate_id", F.md5(F.concat_ws("|", "l_returnflag", "l_linestatus", "l_linenumber")))


Q11 = f"WITH {LEDGER}, n AS (SELECT *, gross - 0.01 AS net FROM led) SELECT l_returnflag, l_linestatus, l_linenumber, md5(concat_ws('|', l_returnflag, l_linestatus, l_linenumber)) AS candidate_id, {metrics_sql('net')} FROM n GROUP BY l_returnflag, l_linestatus, l_linenumber"

def q16_drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compounded return and largest drawdown of each definition's daily mean return."""
    d = _ledger(spark, sf_dir).groupBy("l_returnflag", "day").agg(F.round(F.avg("gross"), 9).alias("net"))
    e = equity(d, ["l_returnflag"], ["day"], "net")
    return e.groupBy("l_returnflag").agg(F.count("*").alias("days"), R(F.exp(F.sum(F.ln(1 + F.col("net")))) - 1, 4).alias("compound"), R(F.abs(F.min(F.col("equity") / F.nullif(F.col("peak"), F.lit(0.0)) - 1))).alias("max_drawdown"))


Q16D = f"""WITH {LEDGER}, d AS (SELECT l_returnflag, day, round(avg(gross), 9) AS net FROM led GROUP BY ALL), e AS (SELECT *, exp(sum(ln(1 + net)) OVER w) AS equity FROM d WINDOW w AS (PARTITION BY l_returnflag ORDER BY day ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, max(equity) OVER (PARTITION BY l_returnflag ORDER BY day ROWS UNBOUNDED PRECEDING) AS peak FROM e)
SELECT l_returnflag, count(*) AS days, round(exp(sum(ln(1 + net))) - 1, 4) AS compound, round(abs(min(equity / nullif(peak, 0) - 1)), 6) AS max_drawdown FROM p GROUP BY 1"""


def q16_pair_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily pair ledger: pivot of two legs and a context symbol, divergence, context bin, direction and net by cost."""
    t = ticks(spark, sf_dir).withColumn("day", F.col("ts").cast("date")).withColumn("half", F.when(F.hour("ts") < 12, "am").otherwise("pm"))
    mean = lambda s, h: F.avg(F.when((F.col("symbol") == s) & (F.col("half") == h), F.col("price")))
    p = t.groupBy("day").agg(*[mean(s, h).alias(f"{s}_{h}") for s in ("click", "view", "error") for h in ("am", "pm")])
    change = lambda s: F.round((F.col(f"{s}_pm") / F.nullif(F.col(f"{s}_am"), F.lit(0.0)) - 1) * 100, 5)
    x = p.select("day", change("click").alias("a"), change("view").alias("b"), change("error").alias("ctx")).withColumn("div", F.col("a") - F.col("b"))
    context = F.when(F.col("ctx") < -2.5, "strong_down").when(F.col("ctx") < -1, "down").when(F.col("ctx") <= 1, "flat").when(F.col("ctx") <= 2.5, "up").otherwise("strong_up")
    nxt = F.lead("div").over(Window.orderBy("day"))
    x = x.withColumn("context", context).withColumn("spread", 0.5 * nxt).withColumn("triggered", F.abs("div") >= 0.5)
    gross = F.when(F.col("triggered"), -F.signum("div") * F.col("spread"))
    reason = F.when(F.col("div").isNull(), "MISSING_SIGNAL").when(F.col("triggered") & F.col("spread").isNull(), "MISSING_EXIT")
    return x.select("day", "context", "triggered", R(F.col("div")).alias("div"), reason.alias("excluded"), R(gross).alias("gross"), *[R(gross - c / 100).alias(f"net_{n}") for n, c in (("5", 5), ("7_5", 7.5), ("10", 10))])


Q16P = f"""WITH {TICKS}, t AS (SELECT *, CAST(ts AS DATE) AS day, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS half FROM ticks), p AS (SELECT day, {', '.join(f"avg(price) FILTER (WHERE symbol = '{s}' AND half = '{h}') AS {s}_{h}" for s in ('click', 'view', 'error') for h in ('am', 'pm'))} FROM t GROUP BY 1),
x AS (SELECT day, {', '.join(f'round(({s}_pm / nullif({s}_am, 0) - 1) * 100, 5) AS {n}' for s, n in (('click', 'a'), ('view', 'b'), ('error', 'ctx')))} FROM p), y AS (SELECT *, a - b AS div, 0.5 * lead(a - b) OVER (ORDER BY day) AS spread, abs(a - b) >= 0.5 AS triggered FROM x),
z AS (SELECT *, CASE WHEN triggered THEN -sign(div) * spread END AS gross FROM y)
SELECT day, CASE WHEN ctx < -2.5 THEN 'strong_down' WHEN ctx < -1 THEN 'down' WHEN ctx <= 1 THEN 'flat' WHEN ctx <= 2.5 THEN 'up' ELSE 'strong_up' END AS context, triggered, round(div, 6) AS div,
 CASE WHEN div IS NULL THEN 'MISSING_SIGNAL' WHEN triggered AND spread IS NULL THEN 'MISSING_EXIT' END AS excluded, round(gross, 6) AS gross, round(gross - 0.05, 6) AS net_5, round(gross - 0.075, 6) AS net_7_5, round(gross - 0.1, 6) AS net_10 FROM z"""


def q20_tail_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tail states against quantiles frozen on the first half of the month, ties included; next-day returns by state."""
    s = _signals(spark, sf_dir).withColumn("ret", F.col("next_close") / F.nullif(F.col("next_open"), F.lit(0.0)) - 1)
    cuts = s.filter("signal_date < date '2024-01-15'").agg(F.percentile("day_return", F.lit(0.1)).alias("lo"), F.percentile("day_return", F.lit(0.9)).alias("hi"))
    out = s.crossJoin(F.broadcast(cuts)).withColumn("state", tail_state(F.col("day_return"), F.col("lo"), F.col("hi")))
    return summarise(out.filter("signal_date >= date '2024-01-15'"), ["state"], "ret")


Q20 = f"""WITH {SIGNALS}, c AS (SELECT quantile_cont(day_return, 0.1) AS lo, quantile_cont(day_return, 0.9) AS hi FROM sig WHERE signal_date < DATE '2024-01-15'),
x AS (SELECT CASE WHEN day_return <= lo THEN 'LOW' WHEN day_return >= hi THEN 'HIGH' ELSE 'MID' END AS state, next_close / nullif(next_open, 0) - 1 AS ret FROM sig, c WHERE signal_date >= DATE '2024-01-15') SELECT state, {metrics_sql('ret')} FROM x GROUP BY 1"""


def q12_spread_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-tail against high-tail basket of each date and size, only where they share no name."""
    r = normalised_ranks(_signals(spark, sf_dir).filter("next_open > 0 and next_close is not null"), ["signal_date"], "symbol", ["day_return"])
    r = r.withColumn("ret", F.col("next_close") / F.col("next_open") - 1).withColumn("k", F.explode(F.array(F.lit(5), F.lit(10))))
    low = F.row_number().over(Window.partitionBy("signal_date", "k").orderBy("day_return", "symbol"))
    high = F.row_number().over(Window.partitionBy("signal_date", "k").orderBy(F.col("day_return").desc(), "symbol"))
    r = r.withColumn("low", low).withColumn("high", high)
    side = lambda c: r.filter(F.col(c) <= F.col("k")).groupBy("signal_date", "k").agg(F.sort_array(F.collect_set("symbol")).alias(f"{c}_symbols"), F.avg("ret").alias(f"{c}_return"))
    both = side("low").join(side("high"), ["signal_date", "k"]).filter(~F.arrays_overlap("low_symbols", "high_symbols"))
    return both.select("signal_date", "k", R(0.5 * (F.col("low_return") - F.col("high_return"))).alias("spread"), F.array_join("low_symbols", ",").alias("low"), F.array_join("high_symbols", ",").alias("high"))


Q12 = f"""WITH {SIGNALS}, r AS (SELECT signal_date, symbol, k, next_close / next_open - 1 AS ret, row_number() OVER (PARTITION BY signal_date, k ORDER BY day_return, symbol) AS low, row_number() OVER (PARTITION BY signal_date, k ORDER BY day_return DESC, symbol) AS high
  FROM sig CROSS JOIN (VALUES (5), (10)) t(k) WHERE next_open > 0 AND next_close IS NOT NULL),
l AS (SELECT signal_date, k, array_agg(symbol ORDER BY symbol) AS s, avg(ret) AS a FROM r WHERE low <= k GROUP BY ALL), h AS (SELECT signal_date, k, array_agg(symbol ORDER BY symbol) AS s, avg(ret) AS a FROM r WHERE high <= k GROUP BY ALL)
SELECT signal_date, k, round(0.5 * (l.a - h.a), 6) AS spread, array_to_string(l.s, ',') AS low, array_to_string(h.s, ',') AS high FROM l JOIN h USING (signal_date, k) WHERE NOT list_has_any(l.s, h.s)"""


def q23_fdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benjamini-Hochberg q-values of one-sided p-values (normal tail of the t statistic, logistic form) over all definitions."""
    m = q11_tail_metrics(spark, sf_dir).select("candidate_id", F.round(1 / (1 + F.exp(1.702 * F.col("t_stat"))), 12).alias("p"))
    return benjamini_hochberg(m.filter("p is not null").withColumn("family", F.lit(1)), "p", ["family"]).select("candidate_id", R(F.col("p"), 9).alias("p"), R(F.col("q"), 9).alias("q"))


Q23 = f"""WITH {LEDGER}, n AS (SELECT *, gross - 0.01 AS net FROM led), m AS (SELECT md5(concat_ws('|', l_returnflag, l_linestatus, l_linenumber)) AS candidate_id, round(1 / (1 + exp(1.702 * round({MET['t_stat'].format(n='net')}, 6))), 12) AS p FROM n GROUP BY l_returnflag, l_linestatus, l_linenumber),
r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS n FROM m WHERE p IS NOT NULL) SELECT candidate_id, round(p, 9) AS p, round(least(1.0, min(p * n / k) OVER (ORDER BY k DESC ROWS UNBOUNDED PRECEDING)), 9) AS q FROM r"""


def q24_newey_west(spark: SparkSession, sf_dir: str, lags: int = 5) -> DataFrame:
    """t statistic of the mean daily return with Newey-West variance of five lags."""
    d = _ledger(spark, sf_dir).groupBy("l_returnflag", "day").agg(F.round(F.avg("gross"), 9).alias("x"))
    mean = d.groupBy("l_returnflag").agg(F.avg("x").alias("m"), F.count("*").alias("n"))
    e = d.join(mean, "l_returnflag").withColumn("e", F.col("x") - F.col("m"))
    w = Window.partitionBy("l_returnflag").orderBy("day")
    parts = [F.sum(F.col("e") * F.col("e"))] + [2 * (1 - k / (lags + 1)) * F.sum(F.col(f"e{k}")) for k in range(1, lags + 1)]
    e = e.select("*", *[(F.col("e") * F.lag("e", k).over(w)).alias(f"e{k}") for k in range(1, lags + 1)])
    out = e.groupBy("l_returnflag").agg(F.first("m").alias("m"), F.first("n").alias("n"), sum(parts[1:], parts[0]).alias("s"))
    return out.select("l_returnflag", F.col("n").alias("days"), R(F.col("m"), 6).alias("mean"), R(F.try_divide("m", F.sqrt(F.col("s") / F.col("n") / F.col("n"))), 4).alias("t_nw"))


Q24 = f"""WITH {LEDGER}, d AS (SELECT l_returnflag, day, round(avg(gross), 9) AS x FROM led GROUP BY ALL), e AS (SELECT *, x - avg(x) OVER (PARTITION BY l_returnflag) AS e, avg(x) OVER (PARTITION BY l_returnflag) AS m, count(*) OVER (PARTITION BY l_returnflag) AS n FROM d),
l AS (SELECT *, {', '.join(f'e * lag(e, {k}) OVER w AS e{k}' for k in range(1, 6))} FROM e WINDOW w AS (PARTITION BY l_returnflag ORDER BY day))
SELECT l_returnflag, any_value(n) AS days, round(any_value(m), 6) AS mean, round(any_value(m) / nullif(sqrt((sum(e * e) {' '.join(f'+ 2 * (1 - {k} / 6.0::DOUBLE) * sum(e{k})' for k in range(1, 6))}) / any_value(n) / any_value(n)), 0), 4) AS t_nw FROM l GROUP BY 1"""


def w17_rolling_and_octiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worst rolling 50-day mean and mean by chronological eighth."""
    d = _ledger(spark, sf_dir).groupBy("l_returnflag", "day").agg(F.round(F.avg("gross"), 9).alias("x"))
    w = Window.partitionBy("l_returnflag").orderBy("day")
    d = d.withColumn("roll", F.avg("x").over(w.rowsBetween(-49, 0))).withColumn("n", F.count("x").over(w.rowsBetween(-49, 0))).withColumn("eighth", F.ntile(8).over(w))
    return d.groupBy("l_returnflag", "eighth").agg(F.count("*").alias("days"), R(F.avg("x")).alias("mean"), R(F.min(F.when(F.col("n") == 50, F.col("roll")))).alias("worst_roll"))


W17 = f"""WITH {LEDGER}, d AS (SELECT l_returnflag, day, round(avg(gross), 9) AS x FROM led GROUP BY ALL), r AS (SELECT *, avg(x) OVER b AS roll, count(x) OVER b AS n, ntile(8) OVER w AS eighth FROM d WINDOW w AS (PARTITION BY l_returnflag ORDER BY day), b AS (PARTITION BY l_returnflag ORDER BY day ROWS 49 PRECEDING))
SELECT l_returnflag, eighth, count(*) AS days, round(avg(x), 6) AS mean, round(min(CASE WHEN n = 50 THEN roll END), 6) AS worst_roll FROM r GROUP BY ALL"""


def q19_basket_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family of rank baskets: feature x names per side x orientation, half the weight a side, ties by name."""
    s = _signals(spark, sf_dir).filter("next_open > 0 and next_close is not null").withColumn("ret", F.col("next_close") / F.col("next_open") - 1)
    x = s.select("signal_date", "symbol", "ret", F.expr("stack(3, 'day_return', day_return, 'location', location, 'drawdown', drawdown) as (feature, v)"))
    day = Window.partitionBy("signal_date", "feature")
    x = x.withColumn("lo", F.row_number().over(day.orderBy("v", "symbol"))).withColumn("hi", F.row_number().over(day.orderBy(F.col("v").desc(), "symbol"))).withColumn("n", F.count("*").over(day))
    x = x.withColumn("k", F.explode(F.array(F.lit(1), F.lit(3), F.lit(5)))).filter(F.col("n") >= 2 * F.col("k"))
    books = x.groupBy("signal_date", "feature", "k").agg((0.5 * F.avg(F.when(F.col("lo") <= F.col("k"), F.col("ret"))) - 0.5 * F.avg(F.when(F.col("hi") <= F.col("k"), F.col("ret")))).alias("reversal"))
    both = books.select("feature", "k", F.expr("stack(2, 'REVERSAL', reversal - 0.001, 'CONTINUATION', -reversal - 0.001) as (style, net)"))
    return summarise(both, ["feature", "k", "style"], "net")


Q19 = f"""WITH {SIGNALS}, x AS (SELECT signal_date, symbol, next_close / next_open - 1 AS ret, feature, CASE feature WHEN 'day_return' THEN day_return WHEN 'location' THEN location ELSE drawdown END AS v FROM sig CROSS JOIN (VALUES ('day_return'), ('location'), ('drawdown')) f(feature) WHERE next_open > 0 AND next_close IS NOT NULL),
y AS (SELECT *, row_number() OVER (PARTITION BY signal_date, feature ORDER BY v, symbol) AS lo, row_number() OVER (PARTITION BY signal_date, feature ORDER BY v DESC, symbol) AS hi, count(*) OVER (PARTITION BY signal_date, feature) AS n FROM x),
b AS (SELECT signal_date, feature, k, 0.5 * avg(ret) FILTER (WHERE lo <= k) - 0.5 * avg(ret) FILTER (WHERE hi <= k) AS rev FROM y CROSS JOIN (VALUES (1), (3), (5)) t(k) WHERE n >= 2 * k GROUP BY ALL),
z AS (SELECT feature, k, style, CASE style WHEN 'REVERSAL' THEN rev - 0.001 ELSE -rev - 0.001 END AS net FROM b CROSS JOIN (VALUES ('REVERSAL'), ('CONTINUATION')) s(style)) SELECT feature, k, style, {metrics_sql('net')} FROM z GROUP BY ALL"""

_FUNCTIONS = (q17_network_forecast, q13_composite_ranks, q13_daily_baskets, q13_scope_metrics, q22_gates, q11_tail_metrics, q16_drawdown, q16_pair_holdout, q20_tail_states, q12_spread_books, q23_fdr, q24_newey_west, w17_rolling_and_octiles, q19_basket_family)
QUERIES = {f.__name__: f for f in _FUNCTIONS}
ORACLES = dict(zip(QUERIES, (Q17, Q13R, Q13D, Q13M, Q22, Q11, Q16D, Q16P, Q20, Q12, Q23, Q24, W17, Q19), strict=True))
