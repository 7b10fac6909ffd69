"""Scanner steps: candidates, gates, evidence clusters, filings, ratings and enrolment, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import linear_score
from ..operators.keyed import latest_per_key
from ..session import load
from ..sources.tables import panel, ticks
from .campaigns import PANEL
from .market import TICKS, R


def q6_signal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose close rose by a log change over 0.3 from the day before on rising volume, on complete days alone (20 names or more)."""
    p = panel(spark, sf_dir).select("symbol", "signal_date", "close", "volume")
    before = p.select("symbol", F.date_add("signal_date", 1).alias("signal_date"), F.col("close").alias("prev_close"), F.col("volume").alias("prev_volume"))
    full = p.groupBy("signal_date").agg(F.count("*").alias("names")).filter("names >= 20")
    x = p.join(before, ["symbol", "signal_date"]).join(full, "signal_date", "left_semi").filter("close > 0 and prev_close > 0 and prev_volume > 0 and volume > 0")
    x = x.withColumn("change", R(F.ln(F.col("close") / F.col("prev_close")))).withColumn("volume_change", R(F.ln(F.col("volume") / F.col("prev_volume"))))
    return x.filter("change >= 0.3 and volume_change >= 0.2").select("symbol", "signal_date", "change", "volume_change")


Q6 = f"""WITH {PANEL}, f AS (SELECT signal_date FROM panel GROUP BY 1 HAVING count(*) >= 20), x AS (SELECT a.symbol, a.signal_date, round(ln(a.close / b.close), 6) AS change, round(ln(a.volume / b.volume), 6) AS volume_change
 FROM panel a JOIN panel b ON b.symbol = a.symbol AND b.signal_date + 1 = a.signal_date WHERE a.close > 0 AND b.close > 0 AND a.volume > 0 AND b.volume > 0 AND a.signal_date IN (SELECT signal_date FROM f)) SELECT * FROM x WHERE change >= 0.3 AND volume_change >= 0.2"""


#: Fewer names make no basket (the reference's constant).
MIN_BASKET_NAMES = 6


def q7_basket_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short baskets of the candidates per day: at least six names, mean short return from next open to next close, less a spread."""
    c = q6_signal_candidates(spark, sf_dir).join(panel(spark, sf_dir).select("symbol", "signal_date", "next_open", "next_close"), ["symbol", "signal_date"])
    ok = F.col("next_open").isNotNull() & (F.col("next_open") > 0) & F.col("next_close").isNotNull()
    b = c.groupBy("signal_date").agg(F.count("*").alias("names"), F.count_if(ok).alias("priced"), F.avg(F.when(ok, 1 - F.col("next_close") / F.col("next_open"))).alias("short"))
    return b.select("signal_date", "names", "priced", F.when(F.col("priced") >= MIN_BASKET_NAMES, R(F.col("short") - 0.0012)).alias("net"), F.when(F.col("names") < MIN_BASKET_NAMES, "TOO_FEW_NAMES").when(F.col("priced") < MIN_BASKET_NAMES, "MISSING_PRICE").alias("excluded"))


Q7 = f"""WITH {PANEL}, f AS (SELECT signal_date FROM panel GROUP BY 1 HAVING count(*) >= 20), x AS (SELECT a.symbol, a.signal_date, a.next_open, a.next_close, round(ln(a.close / b.close), 6) AS change, round(ln(a.volume / b.volume), 6) AS volume_change
 FROM panel a JOIN panel b ON b.symbol = a.symbol AND b.signal_date + 1 = a.signal_date WHERE a.close > 0 AND b.close > 0 AND a.volume > 0 AND b.volume > 0 AND a.signal_date IN (SELECT signal_date FROM f)),
b AS (SELECT signal_date, count(*) AS names, count(*) FILTER (WHERE next_open > 0 AND next_close IS NOT NULL) AS priced, avg(1 - next_close / nullif(next_open, 0)) FILTER (WHERE next_open > 0 AND next_close IS NOT NULL) AS short FROM x WHERE change >= 0.3 AND volume_change >= 0.2 GROUP BY 1)
SELECT signal_date, names, priced, CASE WHEN priced >= {MIN_BASKET_NAMES} THEN round(short - 0.0012, 6) END AS net, CASE WHEN names < {MIN_BASKET_NAMES} THEN 'TOO_FEW_NAMES' WHEN priced < {MIN_BASKET_NAMES} THEN 'MISSING_PRICE' END AS excluded FROM b"""


def f7_liquidity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols by day that pass price, range and activity limits, with the first gate that fails for the others."""
    p = panel(spark, sf_dir)
    spread = R((F.col("high") - F.col("low")) / F.nullif((F.col("high") + F.col("low")) / 2, F.lit(0.0)) * 100)
    reason = F.when(F.col("close") < 5, "PRICE").when(F.col("n_ticks") < 2, "ACTIVITY").when(spread.isNull() | (spread > 150), "SPREAD").when(F.col("volume") < 60, "VOLUME")
    return p.select("symbol", "signal_date", spread.alias("spread_pct"), reason.alias("failed"), reason.isNull().alias("passed"))


F7 = f"""WITH {PANEL}, s AS (SELECT *, round((high - low) / nullif((high + low) / 2, 0) * 100, 6) AS spread_pct FROM panel), f AS (SELECT *, CASE WHEN close < 5 THEN 'PRICE' WHEN n_ticks < 2 THEN 'ACTIVITY' WHEN spread_pct IS NULL OR spread_pct > 150 THEN 'SPREAD' WHEN volume < 60 THEN 'VOLUME' END AS failed FROM s)
SELECT symbol, signal_date, spread_pct, failed, failed IS NULL AS passed FROM f"""


def d8_latest_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest tick of each user with the typed merge of its payload: later fields win."""
    t = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", F.from_json("props", "k long").alias("meta"))
    merged = t.withColumn("meta", F.col("meta").withField("source", F.col("event_type")).withField("k", F.coalesce(F.col("meta.k"), F.lit(0))))
    out = latest_per_key(merged, ["user_id"], F.col("ts").desc(), F.col("event_id").desc())
    return out.select("user_id", "event_id", F.col("meta.k").alias("k"), F.col("meta.source").alias("source"))


D8 = "SELECT user_id, event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k, event_type AS source FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


def d10_update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job status from its tasks: finished counts, and the status ladder."""
    line = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("tasks"), F.count_if(F.col("l_linestatus") == "F").alias("done"), F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    o = load(spark, sf_dir, "orders").select("o_orderkey").join(line, "o_orderkey", "left")
    tasks = F.coalesce("tasks", F.lit(0))
    status = F.when(tasks == 0, "empty").when(F.col("done") == tasks, F.when(F.col("bad") > 0, "completed_with_errors").otherwise("completed")).when(F.col("done") > 0, "running").otherwise("queued")
    return o.select("o_orderkey", tasks.alias("tasks"), F.coalesce("done", F.lit(0)).alias("done"), status.alias("status"))


D10 = """WITH l AS (SELECT l_orderkey, count(*) AS tasks, count(*) FILTER (WHERE l_linestatus = 'F') AS done, count(*) FILTER (WHERE l_returnflag = 'R') AS bad FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(tasks, 0) AS tasks, coalesce(done, 0) AS done, CASE WHEN tasks IS NULL THEN 'empty' WHEN done = tasks THEN CASE WHEN bad > 0 THEN 'completed_with_errors' ELSE 'completed' END WHEN done > 0 THEN 'running' ELSE 'queued' END AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey"""


def q37_fundamental_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-confidence risk flags of suppliers: several conditions together, none for missing data."""
    rows = load(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    line = rows.groupBy("s_suppkey").agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"), F.stddev_samp("l_quantity").alias("sd"))
    # A sum of doubles depends on its order, so averages next to a limit are formed anew, line by line in the table's order.
    edge = line.filter("abs(d - 0.0505) < 1e-9 or abs(t - 0.0395) < 1e-9").select("s_suppkey")
    place = F.struct("l_orderkey", "l_linenumber")
    w = Window.partitionBy("s_suppkey").orderBy("l_orderkey", "l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.join(edge, "s_suppkey").select("s_suppkey", place.alias("place"), *[(F.sum(c).over(w) / F.count(c).over(w)).alias(n) for c, n in (("l_discount", "d"), ("l_tax", "t"))])
    anew = run.groupBy("s_suppkey").agg(F.max_by(F.struct("d", "t"), "place").alias("anew"))
    line = line.join(anew, "s_suppkey", "left").select("s_suppkey", F.coalesce("anew.d", "d").alias("d"), F.coalesce("anew.t", "t").alias("t"), "sd")
    s = load(spark, sf_dir, "supplier").join(line, "s_suppkey", "left")
    flags = F.array_compact(F.array(F.when(F.col("d") >= 0.0505, "dilution"), F.when((F.col("s_acctbal") < 1000) & (F.col("t") >= 0.0395), "solvency"), F.when(F.col("sd") > 14.5, "volatile")))
    return s.select("s_suppkey", F.array_join(flags, ",").alias("flags"))


Q37 = """WITH l AS (SELECT l_suppkey, avg(l_discount) AS d, avg(l_tax) AS t, stddev_samp(l_quantity) AS sd FROM lineitem GROUP BY 1)
SELECT s_suppkey, concat_ws(',', CASE WHEN d >= 0.0505 THEN 'dilution' END, CASE WHEN s_acctbal < 1000 AND t >= 0.0395 THEN 'solvency' END, CASE WHEN sd > 14.5 THEN 'volatile' END) AS flags FROM supplier LEFT JOIN l ON l_suppkey = s_suppkey"""


def q50_enrolment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking summary: candidates enrolled once, pending, matured and missed by segment."""
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    state = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count("*").alias("n"))
    x = c.join(state, "c_custkey", "left")
    return x.groupBy("c_mktsegment").agg(F.count("*").alias("candidates"), F.count("n").alias("enrolled"), F.count_if(F.col("f") == F.col("n")).alias("matured"), F.count_if(F.col("f") < F.col("n")).alias("pending"), F.count_if(F.col("n").isNull()).alias("missed"))


Q50 = """WITH s AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) AS n FROM orders GROUP BY 1)
SELECT c_mktsegment, count(*) AS candidates, count(n) AS enrolled, count(*) FILTER (WHERE f = n) AS matured, count(*) FILTER (WHERE f < n) AS pending, count(*) FILTER (WHERE n IS NULL) AS missed FROM customer LEFT JOIN s ON o_custkey = c_custkey GROUP BY 1"""


def q52_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating of parts from a clamped score and a source check, ranked anew within each brand."""
    p = load(spark, sf_dir, "part").withColumn("score", R(0.5 * linear_score(F.col("p_retailprice"), 900, 1100) + 0.5 * linear_score(F.col("p_size").cast("double"), 0, 50), 4))
    verified = F.col("p_type").isin("STANDARD", "PROMO")
    band = F.when(F.col("score") >= 65, "Strong").when(F.col("score") >= 40, "Moderate").otherwise("Weak")
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(verified.desc(), F.col("score").desc(), "p_partkey"))
    return p.select("p_partkey", "score", F.concat_ws(" / ", F.when(verified, "Verified").otherwise("Unverified"), band).alias("rating"), rank.alias("brand_rank"))


Q52 = """WITH s AS (SELECT p_partkey, p_brand, p_type IN ('STANDARD', 'PROMO') AS v, round(0.5 * least(100.0, greatest(0.0, (p_retailprice - 900) / 200 * 100)) + 0.5 * least(100.0, greatest(0.0, p_size / 50.0::DOUBLE * 100)), 4) AS score FROM part)
SELECT p_partkey, score, CASE WHEN v THEN 'Verified' ELSE 'Unverified' END || ' / ' || CASE WHEN score >= 65 THEN 'Strong' WHEN score >= 40 THEN 'Moderate' ELSE 'Weak' END AS rating, row_number() OVER (PARTITION BY p_brand ORDER BY v DESC, score DESC, p_partkey) AS brand_rank FROM s"""


def s9_page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document selection from HTML: links of each page in order, the first that is no navigation word of two letters, and plain text length."""
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]+>", " "), r"\s+", " "))
    p = load(spark, sf_dir, "pages").select("page_id", links.alias("links"), plain.alias("plain"))
    chosen = F.try_element_at(F.filter("links", lambda x: F.length(x) > 3), F.lit(1))
    return p.select("page_id", F.size("links").alias("n_links"), chosen.alias("document"), F.length("plain").alias("plain_chars"))


S9 = r"""WITH p AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages)
SELECT page_id, len(links) AS n_links, list_filter(links, lambda x: length(x) > 3)[1] AS document, length(plain) AS plain_chars FROM p"""


def l6_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active users per day in batches of 20 by order of user."""
    t = ticks(spark, sf_dir).select(F.col("ts").cast("date").alias("day"), "user_id").distinct()
    k = F.row_number().over(Window.partitionBy("day").orderBy("user_id"))
    return t.withColumn("chunk", F.floor((k - 1) / 20)).groupBy("day", "chunk").agg(F.count("*").alias("n"), F.min("user_id").alias("first_user"), F.max("user_id").alias("last_user"))


L6 = f"""WITH {TICKS}, t AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM ticks), k AS (SELECT *, (row_number() OVER (PARTITION BY day ORDER BY user_id) - 1) // 20 AS chunk FROM t)
SELECT day, chunk, count(*) AS n, min(user_id) AS first_user, max(user_id) AS last_user FROM k GROUP BY ALL"""

_SQL = {
    "q6_signal_candidates": Q6, "q7_basket_eligibility": Q7, "f7_liquidity_gate": F7, "d8_latest_decision": D8, "d10_update_from": D10, "q37_fundamental_flags": Q37, "q50_enrolment": Q50, "q52_rating": Q52,
    "s9_page_documents": S9, "l6_chunks": L6,
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
