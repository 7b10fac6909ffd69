"""Look-ups, comparisons and projections: lateral first rows, run comparison, calendar rules, load estimates, audits; with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import capture_due, complete_date, scan_due
from ..operators.keyed import upsert
from ..session import load
from ..sources.tables import ticks
from .market import TICKS, R


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily open, close and volume by symbol."""
    order = F.struct("ts", "tick_id")
    t = ticks(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    return t.groupBy("symbol", "day").agg(F.min_by("price", order).alias("open"), F.max_by("price", order).alias("close"), F.sum("size").alias("volume"))


DAYS = f"{TICKS}, days AS (SELECT symbol, CAST(ts AS DATE) AS day, first(price ORDER BY ts, tick_id) AS open, last(price ORDER BY ts, tick_id) AS close, sum(size)::BIGINT AS volume FROM ticks GROUP BY ALL)"


def j2_cross_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date with every name of the universe (a handful of rows, broadcast), its own day if there is one, and the next date's open."""
    d = _days(spark, sf_dir).filter("volume > 0 and close >= 10")
    universe = d.select("symbol").distinct().orderBy("symbol").limit(1000)
    base = d.select("day").distinct().join(F.broadcast(universe))
    nxt = d.select("symbol", F.date_sub("day", 1).alias("day"), F.col("open").alias("next_open"))
    return base.join(d.select("symbol", "day", "close"), ["symbol", "day"], "left").join(nxt, ["symbol", "day"], "left").select("symbol", "day", "close", "next_open")


J2 = f"""WITH {DAYS}, d AS (SELECT * FROM days WHERE volume > 0 AND close >= 10), u AS (SELECT DISTINCT symbol FROM d), b AS (SELECT DISTINCT day FROM d)
SELECT u.symbol, b.day, d.close, n.open AS next_open FROM b CROSS JOIN u LEFT JOIN d ON d.symbol = u.symbol AND d.day = b.day LEFT JOIN d n ON n.symbol = u.symbol AND n.day = b.day + 1"""


def j10_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with its first urgent order (time, then key), or nulls: the lateral look-up as an aggregate with partial results."""
    o = load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    first = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("f"))
    return load(spark, sf_dir, "customer").select("c_custkey").join(first, "c_custkey", "left").select("c_custkey", "f.o_orderkey", "f.o_totalprice")


J10 = """SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate, o_orderkey LIMIT 1) ON TRUE"""


def latest_covered(jobs: DataFrame, dates: DataFrame, active: DataFrame) -> DataFrame:
    """(job, day): the last date inside each job's span (start_day to end_day) that no active job covers, or null.

    Spans are exploded into days, so all joins are on equality: a span has as many rows as days, whatever the number of jobs.
    """
    spread = lambda j: j.withColumn("day", F.explode(F.sequence("start_day", "end_day")))
    free = dates.select("day").distinct().join(spread(active).select("day").distinct(), "day", "left_anti")
    found = spread(jobs).join(free, "day").groupBy("job").agg(F.max("day").alias("day"))
    return jobs.select("job").join(found, "job", "left")


def j11_latest_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as load jobs of a week; those of region 4 are still active."""
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey").cast("int"))
    jobs = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("job"), "n_regionkey", start.alias("start_day"), F.date_add(start, F.col("n_nationkey") % 3).alias("end_day"))
    return latest_covered(jobs.filter("n_regionkey <> 4"), _days(spark, sf_dir), jobs.filter("n_regionkey = 4"))


J11 = f"""WITH {DAYS}, j AS (SELECT n_nationkey AS job, n_regionkey, DATE '2024-01-01' + n_nationkey AS start_day, DATE '2024-01-01' + n_nationkey + n_nationkey % 3 AS end_day FROM nation)
SELECT j.job, f.day FROM j LEFT JOIN LATERAL (SELECT max(d.day) AS day FROM days d WHERE d.day BETWEEN j.start_day AND j.end_day AND NOT EXISTS (SELECT 1 FROM j a WHERE a.n_regionkey = 4 AND a.start_day <= d.day AND a.end_day >= d.day)) f ON TRUE WHERE j.n_regionkey <> 4"""


def j18_run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new run of the same item side by side: an order's first and second line, with the change of score and verdict."""
    line = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(R(F.sum("l_extendedprice"), 2).alias("score"))
    verdict = F.when(F.col("score") >= 60000, "INVESTIGATE").when(F.col("score") >= 30000, "WATCH").otherwise("PASS")
    run = lambda n, name: line.withColumn("verdict", verdict).filter(F.col("l_linenumber") == n).select("l_orderkey", F.col("score").alias(f"{name}_score"), F.col("verdict").alias(f"{name}_verdict"))
    both = run(1, "old").join(run(2, "new"), "l_orderkey")
    return both.withColumn("change", R(F.col("new_score") - F.col("old_score"), 2)).withColumn("verdict_changed", F.col("old_verdict") != F.col("new_verdict"))


J18 = """WITH l AS (SELECT l_orderkey, l_linenumber, round(sum(l_extendedprice), 2) AS score FROM lineitem GROUP BY ALL), v AS (SELECT *, CASE WHEN score >= 60000 THEN 'INVESTIGATE' WHEN score >= 30000 THEN 'WATCH' ELSE 'PASS' END AS verdict FROM l)
SELECT o.l_orderkey, o.score AS old_score, o.verdict AS old_verdict, n.score AS new_score, n.verdict AS new_verdict, round(n.score - o.score, 2) AS change, o.verdict <> n.verdict AS verdict_changed FROM v o JOIN v n ON n.l_orderkey = o.l_orderkey AND n.l_linenumber = 2 WHERE o.l_linenumber = 1"""


def f14_distinct_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose two labels differ, a missing label being different from any value but not from a missing one."""
    d = load(spark, sf_dir, "documents").select("doc_id").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    toxic = F.when(F.col("doc_id") % 7 > 0, F.col("toxic"))
    return d.filter(~F.col("quality").eqNullSafe(toxic)).select("doc_id", "quality", toxic.alias("toxic"))


F14 = "SELECT d.doc_id, quality, CASE WHEN d.doc_id % 7 > 0 THEN toxic END AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS DISTINCT FROM CASE WHEN d.doc_id % 7 > 0 THEN toxic END"


def f15_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by any of several patterns without regard to case, and by one with it (the underscore is any character)."""
    p = load(spark, sf_dir, "pages")
    any_of = F.col("url").ilike("%/EN/%") | F.col("url").ilike("%.Example.com/fr%") | F.col("url").ilike("%PAGE=2%")
    return p.filter(any_of | F.col("url").like("http___%.net/de/%")).select("page_id", any_of.alias("any_case"))


F15 = "SELECT page_id, url ILIKE '%/EN/%' OR url ILIKE '%.Example.com/fr%' OR url ILIKE '%PAGE=2%' AS any_case FROM pages WHERE url ILIKE '%/EN/%' OR url ILIKE '%.Example.com/fr%' OR url ILIKE '%PAGE=2%' OR url LIKE 'http___%.net/de/%'"


def f17_calendar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rules at the time of every tick, by day: the complete date and how many times scan and capture were due (the last run being known for even users)."""
    t = ticks(spark, sf_dir)
    last = F.when(F.col("user_id") % 2 == 0, F.col("ts").cast("date"))
    x = t.select(complete_date(F.col("ts")).alias("complete_date"), scan_due(F.col("ts"), last).alias("scan"), capture_due(F.col("ts"), last).alias("capture"))
    return x.groupBy("complete_date").agg(F.count("*").alias("n"), F.count_if("scan").alias("scans"), F.count_if("capture").alias("captures"))


_IN = "((ts AT TIME ZONE 'UTC') AT TIME ZONE '{}')".format
F17 = f"""WITH {TICKS}, x AS (SELECT *, {_IN('America/New_York')} AS ny, {_IN('Europe/London')} AS ldn, CASE WHEN user_id % 2 = 0 THEN CAST(ts AS DATE) END AS done FROM ticks),
y AS (SELECT CAST(ny AS DATE) - CASE WHEN CAST(ny AS TIME) >= TIME '20:15:00' THEN 0 ELSE 1 END AS complete_date, isodow(ldn) < 6 AND CAST(ldn AS TIME) BETWEEN TIME '22:45:00' AND TIME '23:05:00' AND done IS DISTINCT FROM CAST(ldn AS DATE) AS scan,
 isodow(ny) < 6 AND CAST(ny AS TIME) >= TIME '18:30:00' AND done IS DISTINCT FROM CAST(ny AS DATE) AS capture FROM x)
SELECT complete_date, count(*) AS n, count(*) FILTER (WHERE scan) AS scans, count(*) FILTER (WHERE capture) AS captures FROM y GROUP BY 1"""

#: Fixed values of the load estimate: bytes of a bar, and what of it is left in staging.
BAR_BYTES, STAGED_SHARE = 110, 0.24


def load_estimate(configs: DataFrame) -> DataFrame:
    """Adds active_days, estimated rows, GB and tasks to load configurations.

    configs: mode (regular, extended, all, custom), start_minute and end_minute of a custom session, timeframes (minutes), start_date,
    end_date, weekdays_only, symbols, symbol_batch, date_chunk. Weekdays are counted by whole weeks and the days left over.
    """
    c = F.col
    session = F.when(c("mode") == "regular", 390).when(c("mode") == "extended", 960).when(c("mode") == "all", 1440).otherwise(F.coalesce(F.nullif(F.pmod(c("end_minute") - c("start_minute"), F.lit(1440)), F.lit(0)), F.lit(1440)))
    days = F.datediff("end_date", "start_date") + 1
    rest, first = days % 7, F.weekday("start_date")
    weekend = F.aggregate(F.sequence(F.lit(0), F.lit(6)), F.lit(0), lambda a, i: a + F.when((i < rest) & ((first + i) % 7 >= 5), 1).otherwise(0))
    weekdays = F.floor(days / 7) * 5 + rest - weekend
    active = F.when(c("weekdays_only"), weekdays).otherwise(days).cast("long")
    bars = F.aggregate("timeframes", F.lit(0).cast("long"), lambda a, t: a + F.ceil(session / t))
    x = configs.withColumn("active_days", active).withColumn("rows", c("symbols") * bars * active)
    batches, windows = F.ceil(c("symbols") / c("symbol_batch")), F.ceil(days / c("date_chunk"))
    gb = c("rows") * BAR_BYTES / 1e9
    return x.withColumns({"gb": F.round(gb, 2), "staged_gb": F.round(gb * STAGED_SHARE, 2), "tasks": (batches * windows * F.size("timeframes")).cast("long")})


def q1_load_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estimate for each nation taken as a configuration, over as many symbols as it has customers."""
    n = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("symbols")), "n_nationkey", "left")
    k = F.col("n_nationkey")
    mode = F.element_at(F.array(*map(F.lit, ("regular", "extended", "all", "custom"))), (k % 4 + 1).cast("int"))
    configs = n.select(
        k.alias("job"), F.coalesce("symbols", F.lit(0)).alias("symbols"), mode.alias("mode"), (k * 60).alias("start_minute"), (F.lit(1500) - k * 60).alias("end_minute"), F.when(k % 2 == 0, F.array(F.lit(1), F.lit(5))).otherwise(F.array(F.lit(60), F.lit(1440))).alias("timeframes"),
        F.date_add(F.lit("2024-01-01").cast("date"), k.cast("int")).alias("start_date"), F.date_add(F.lit("2024-06-30").cast("date"), (k * 3).cast("int")).alias("end_date"), (k % 3 > 0).alias("weekdays_only"), F.lit(20).alias("symbol_batch"), F.lit(10).alias("date_chunk"),
    )
    return load_estimate(configs).select("job", "symbols", "active_days", "rows", "gb", "staged_gb", "tasks")


Q1 = f"""WITH s AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), c AS (SELECT n_nationkey AS job, coalesce(n, 0) AS symbols, n_nationkey % 4 AS mode, n_nationkey * 60 AS a, 1500 - n_nationkey * 60 AS b,
 CASE WHEN n_nationkey % 2 = 0 THEN [1, 5] ELSE [60, 1440] END AS tf, DATE '2024-01-01' + n_nationkey AS d1, DATE '2024-06-30' + n_nationkey * 3 AS d2, n_nationkey % 3 > 0 AS wd FROM nation LEFT JOIN s ON c_nationkey = n_nationkey),
e AS (SELECT *, CASE mode WHEN 0 THEN 390 WHEN 1 THEN 960 WHEN 2 THEN 1440 ELSE coalesce(nullif((b - a + 14400) % 1440, 0), 1440) END AS session, d2 - d1 + 1 AS days, len(list_filter(range(0, d2 - d1 + 1), lambda i: isodow(d1 + i::INT) < 6)) AS weekdays FROM c),
f AS (SELECT *, CASE WHEN wd THEN weekdays ELSE days END AS active_days, list_sum(list_transform(tf, lambda t: ceil(session / t)))::BIGINT AS bars FROM e)
SELECT job, symbols, active_days, (symbols * bars * active_days)::BIGINT AS rows, round(symbols * bars * active_days * {BAR_BYTES} / 1e9, 2) AS gb, round(symbols * bars * active_days * {BAR_BYTES} / 1e9 * {STAGED_SHARE}, 2) AS staged_gb, (ceil(symbols / 20) * ceil(days / 10) * 2)::BIGINT AS tasks FROM f"""


def q56_adjusted_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted daily bars against raw ones: a table of both keyed by (symbol, day, adjustment), a second fetch upserted, and the days on which the returns of the two disagree."""
    d = _days(spark, sf_dir)
    cut = F.lit("2024-01-15").cast("date")
    adjusted = lambda factor: d.withColumn("adjustment", F.lit("all")).withColumn("close", F.when(F.col("day") < cut, F.col("close") * factor).otherwise(F.col("close")))
    fetched = lambda df, n: df.withColumn("fetch", F.lit(n))
    table = fetched(d.withColumn("adjustment", F.lit("raw")).unionByName(adjusted(0.5)), 1)
    table = upsert(table, fetched(adjusted(0.25).filter("symbol <> 'click'"), 2), ["symbol", "day", "adjustment"], F.col("fetch").desc())
    w = Window.partitionBy("symbol", "adjustment").orderBy("day")
    r = table.withColumn("ret", F.round((F.try_divide("close", F.lag("close").over(w)) - 1) * 100, 6))
    pair = r.groupBy("symbol", "day").agg(*[F.max(F.when(F.col("adjustment") == a, F.col(c))).alias(f"{a}_{c}") for a in ("raw", "all") for c in ("close", "ret", "fetch")])
    return pair.filter(F.abs(F.col("raw_ret") - F.col("all_ret")) > 0.01).select("symbol", "day", "raw_ret", "all_ret", R(F.try_divide("all_close", "raw_close")).alias("factor"), "all_fetch")


Q56 = f"""WITH {DAYS}, a AS (SELECT symbol, day, close, CASE WHEN day >= DATE '2024-01-15' THEN close WHEN symbol = 'click' THEN close * 0.5 ELSE close * 0.25 END AS adj, CASE WHEN symbol = 'click' THEN 1 ELSE 2 END AS all_fetch FROM days),
r AS (SELECT *, round((close / nullif(lag(close) OVER w, 0) - 1) * 100, 6) AS raw_ret, round((adj / nullif(lag(adj) OVER w, 0) - 1) * 100, 6) AS all_ret FROM a WINDOW w AS (PARTITION BY symbol ORDER BY day))
SELECT symbol, day, raw_ret, all_ret, round(adj / nullif(close, 0), 6) AS factor, all_fetch FROM r WHERE abs(raw_ret - all_ret) > 0.01"""


def project(table: DataFrame, columns: list[str], equal: dict[str, object] | None = None, among: dict[str, list] | None = None, order: list[tuple[str, bool]] | None = None, limit: int | None = None) -> DataFrame:
    """What a table interface offers: columns, filters on equality and membership, order (name, descending; nulls last either way) and a limit."""
    for name, value in (equal or {}).items():
        table = table.filter(F.col(name) == value)
    for name, values in (among or {}).items():
        table = table.filter(F.col(name).isin(values))
    if order:
        table = table.orderBy(*[F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, down in order])
    table = table.select(*columns)
    return table.limit(limit) if limit is not None else table


def s15_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 largest finished urgent or high orders, those of unknown value last (a top-k report)."""
    o = load(spark, sf_dir, "orders").withColumn("value", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice")))
    return project(o, ["o_orderkey", "o_custkey", "value"], {"o_orderstatus": "F"}, {"o_orderpriority": ["1-URGENT", "2-HIGH"]}, [("value", True), ("o_orderkey", False)], 50)


S15 = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 > 0 THEN o_totalprice END AS value FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY value DESC NULLS LAST, o_orderkey LIMIT 50"

_SQL = {
    "j2_cross_base": J2, "j10_first_run": J10, "j11_latest_covered": J11, "j18_run_comparison": J18, "f14_distinct_from": F14, "f15_patterns": F15, "f17_calendar_rules": F17, "q1_load_estimate": Q1,
    "q56_adjusted_audit": Q56, "s15_projection": S15,
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
