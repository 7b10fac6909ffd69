"""Event text, scoring, outcomes, calibration and diagnostics, with their DuckDB SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import clamp, geometric_mean, jaccard, linear_score, sigmoid
from ..session import load
from ..sources.tables import bars, panel, ticks
from .campaigns import PANEL
from .market import BARS, TICKS, R

#: Words that place a text, worst class first; the first class that fits wins (stand-ins for the event vocabulary).
CLASSES = (
    ("E", ("worthless", "scum", "trash")),
    ("D", ("disgusting", "pathetic")),
    ("C", ("license", "licensed", "token")),
    ("B", ("copyright", "rights reserved")),
    ("A", ("idiot", "clown")),
)
FLAGS = (("legal", ("license", "copyright", "rights reserved")), ("solvency", ("worthless", "trash")), ("dilution", ("token",)))


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def text_class(text: Column) -> Column:
    """First class whose words a lower-cased text has; U for none or no text."""
    out = F.when(text.isNull() | (F.trim(text) == ""), "U")
    for name, words in CLASSES:
        out = out.when(any_of(text, words), name)
    return out.otherwise("U")


def risk_flags(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(any_of(text, words), name) for name, words in FLAGS]))


CLASS_SQL = "CASE WHEN text IS NULL OR trim(text) = '' THEN 'U' " + " ".join(f"WHEN regexp_matches(lower(text), '{'|'.join(w)}') THEN '{n}'" for n, w in CLASSES) + " ELSE 'U' END"
FLAG_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{'|'.join(w)}') THEN '{n}' END" for n, w in FLAGS) + "], lambda x: x IS NOT NULL)"


def q25_text_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").withColumn("low", F.lower("text"))
    return d.select("doc_id", text_class(F.col("low")).alias("event_class"), F.array_join(risk_flags(F.col("low")), ",").alias("flags"))


Q25 = f"SELECT doc_id, {CLASS_SQL} AS event_class, coalesce(array_to_string({FLAG_SQL}, ','), '') AS flags FROM documents"


def q33_token_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard similarity of the word sets of each conversation turn and the turn before it."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]{3,}"), F.lit(0)))
    c = load(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w"))
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("w").alias("v"))
    return c.join(before, ["conv_id", "turn"]).select("conv_id", "turn", R(jaccard(F.col("w"), F.col("v"))).alias("similarity"))


Q33 = """WITH c AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{3,}')) AS w FROM conversations)
SELECT c.conv_id, c.turn, round(coalesce(len(list_intersect(c.w, b.w))::DOUBLE / nullif(len(list_distinct(list_concat(c.w, b.w))), 0), 0), 6) AS similarity FROM c JOIN c b ON b.conv_id = c.conv_id AND b.turn + 1 = c.turn"""


def q26_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance of a page to the name in its host: name in the title, in the text, language tag; direct, context or ambient."""
    p = load(spark, sf_dir, "pages")
    name = F.regexp_extract("url", r"([a-z]+)\.example\.", 1)
    title = F.lower(F.regexp_extract("html", "<title>([^<]*)", 1))
    lang = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    score = F.lit(20.0) + F.when((name != "") & title.contains(name), 34.0).otherwise(0.0) + F.when(F.length("html") > 4000, 24.0).otherwise(0.0) + F.when(F.col("url").contains(F.concat(F.lit("/"), lang, F.lit("/"))), 18.0).otherwise(-10.0)
    s = clamp(score, 0.0, 100.0)
    return p.select("page_id", s.alias("relevance"), F.when(s >= 70, "direct_event").when(s >= 48, "direct_context").otherwise("ambient").alias("kind"))


Q26 = """WITH p AS (SELECT page_id, url, html, regexp_extract(url, '([a-z]+)\\.example\\.', 1) AS name, lower(regexp_extract(html, '<title>([^<]*)', 1)) AS title, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang FROM pages),
s AS (SELECT page_id, least(100.0, greatest(0.0, 20.0 + CASE WHEN name <> '' AND contains(title, name) THEN 34 ELSE 0 END + CASE WHEN length(html) > 4000 THEN 24 ELSE 0 END + CASE WHEN contains(url, '/' || lang || '/') THEN 18 ELSE -10 END))::DOUBLE AS relevance FROM p)
SELECT page_id, relevance, CASE WHEN relevance >= 70 THEN 'direct_event' WHEN relevance >= 48 THEN 'direct_context' ELSE 'ambient' END AS kind FROM s"""


def q27_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with decimals in texts: how many, smallest and largest."""
    found = F.transform(F.regexp_extract_all("text", F.lit(r"(\d{1,6}\.\d{1,4})"), F.lit(1)), lambda x: x.cast("double"))
    d = load(spark, sf_dir, "documents").select("doc_id", found.alias("v")).filter(F.size("v") > 0)
    return d.select("doc_id", F.size("v").alias("n"), F.array_min("v").alias("low"), F.array_max("v").alias("high"))


Q27 = r"WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(\d{1,6}\.\d{1,4})', 1), lambda x: x::DOUBLE) AS v FROM documents) SELECT doc_id, len(v) AS n, list_min(v) AS low, list_max(v) AS high FROM d WHERE len(v) > 0"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores (document size scaled to 0-100) with targets (quality label)."""
    d, lab = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    score = F.round(F.least(F.lit(100.0), F.col("n_chars") / 60.0), 4)
    return d.join(lab, "doc_id").select("doc_id", "source", "lang", score.alias("score"), (F.col("quality") == 1).alias("target"))


SAMPLES = "s AS (SELECT doc_id, source, lang, round(least(100.0, n_chars / 60.0::DOUBLE), 4) AS score, quality = 1 AS target FROM documents JOIN labels USING (doc_id))"


def fit_calibration(data: DataFrame, prior: float = 1.0, steps: int = 40) -> tuple[float, float]:
    """Intercept and slope of P(target) = sigmoid(a + b (score - 50) / 10), the slope under a normal prior of this precision.

    Newton's method on the posterior: Spark counts rows and hits per distinct score once, and sums gradient and curvature over
    these counts in every step; the 2 x 2 system is solved here. Without rows both are 0.
    """
    counts = data.groupBy("score").agg(F.count("*").cast("double").alias("n"), F.sum(F.col("target").cast("double")).alias("hits"))
    counts = counts.select("n", "hits", ((F.col("score") - 50.0) / 10.0).alias("x")).cache()  # as many rows as there are distinct scores
    n, hits = counts.agg(F.sum("n"), F.sum("hits")).first()
    if not n:
        return 0.0, 0.0
    rate = np.clip(hits / n, 1e-6, 1 - 1e-6)
    theta, penalty = np.array([np.log(rate / (1 - rate)), 0.0]), np.diag([0.0, prior])
    for _ in range(steps):
        p = sigmoid(F.lit(float(theta[0])) + F.lit(float(theta[1])) * F.col("x"))
        excess, weight = F.col("n") * p - F.col("hits"), F.col("n") * p * (1 - p)
        sums = counts.agg(*[F.sum(v * m) for v in (excess, weight) for m in (F.lit(1.0), F.col("x"), F.col("x") ** 2)]).first()
        move = np.linalg.solve(np.array([[sums[3], sums[4]], [sums[4], sums[5]]]) + penalty + 1e-12 * np.eye(2), np.array(sums[:2]) + penalty @ theta)
        theta -= move
        if np.abs(move).max() < 1e-10:
            break
    counts.unpersist()
    return float(theta[0]), float(theta[1])


def q42_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = fit_calibration(samples(spark, sf_dir))
    return spark.createDataFrame([(round(a, 6), round(b, 6))], "intercept double, slope double")


Q42 = f"""WITH RECURSIVE {SAMPLES}, z AS (SELECT (score - 50) / 10 AS x, count(*)::DOUBLE AS n, sum(target::INT)::DOUBLE AS k FROM s GROUP BY score),
newton(i, a, b) AS (SELECT 0, ln(sum(k) / (sum(n) - sum(k))), 0.0::DOUBLE FROM z UNION ALL
 SELECT i + 1, a - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) FROM (
  SELECT i, a, b, sum(n * p - k) AS g0, sum((n * p - k) * x) + b AS g1, sum(n * p * (1 - p)) AS h00, sum(n * p * (1 - p) * x) AS h01, sum(n * p * (1 - p) * x * x) + 1 AS h11
  FROM (SELECT i, a, b, x, n, k, 1 / (1 + exp(-(a + b * x))) AS p FROM newton CROSS JOIN z WHERE i < 20) GROUP BY i, a, b))
SELECT round(a, 6) AS intercept, round(b, 6) AS slope FROM newton WHERE i = 20"""


def q43_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability by tenths of a fixed mapping: count, mean probability, actual rate, Brier."""
    s = samples(spark, sf_dir).withColumn("p", F.round(sigmoid(F.lit(0.5) + 0.2 * (F.col("score") - 50) / 10), 9)).withColumn("y", F.col("target").cast("double"))
    s = s.withColumn("bucket", F.least(F.lit(9), F.floor(F.col("p") * 10)).cast("int"))
    return s.groupBy("bucket").agg(F.count("*").alias("n"), R(F.avg("p")).alias("mean_p"), R(F.avg("y")).alias("actual"), R(F.abs(F.avg("p") - F.avg("y"))).alias("error"), R(F.avg((F.col("p") - F.col("y")) ** 2)).alias("brier"))


Q43 = f"WITH {SAMPLES}, p AS (SELECT round(1 / (1 + exp(-(0.5 + 0.2 * (score - 50) / 10))), 9) AS p, target::INT::DOUBLE AS y FROM s) SELECT least(9, floor(p * 10))::INT AS bucket, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS actual, round(abs(avg(p) - avg(y)), 6) AS error, round(avg((p - y) ** 2), 6) AS brier FROM p GROUP BY 1"


def q43_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC with average ranks for ties, per language: scores are counted first, so windows see distinct scores only."""
    by = samples(spark, sf_dir).groupBy("lang", "score").agg(F.count_if("target").alias("pos"), F.count("*").alias("n"))
    w = Window.partitionBy("lang").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    ranked = by.withColumn("rank", F.sum("n").over(w) - (F.col("n") - 1) / 2)
    a = ranked.groupBy("lang").agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"))
    return a.select("lang", F.col("p").alias("positives"), F.col("q").alias("negatives"), R((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(F.col("p") * F.col("q"), F.lit(0))).alias("auc"))


Q43A = f"""WITH {SAMPLES}, r AS (SELECT lang, target, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS k FROM s),
a AS (SELECT lang, count(*) FILTER (WHERE target) AS p, count(*) FILTER (WHERE NOT target) AS q, sum(k) FILTER (WHERE target)::DOUBLE AS r FROM r GROUP BY 1) SELECT lang, p AS positives, q AS negatives, round((r - p * (p + 1) / 2) / nullif(p * q, 0), 6) AS auc FROM a"""


def q45_score_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rates by decile of score (at most 9) and source, unknown for missing."""
    s = samples(spark, sf_dir).withColumn("decile", F.least(F.lit(9), F.floor(F.col("score") / 10)).cast("int"))
    return s.groupBy(F.coalesce("source", F.lit("unknown")).alias("source"), "decile").agg(F.count("*").alias("n"), R(F.avg(F.col("target").cast("double"))).alias("hit_rate"), R(F.avg("score")).alias("mean_score"))


Q45 = f"WITH {SAMPLES} SELECT coalesce(source, 'unknown') AS source, least(9, floor(score / 10))::INT AS decile, count(*) AS n, round(avg(target::INT), 6) AS hit_rate, round(avg(score), 6) AS mean_score FROM s GROUP BY ALL"


def q40_three_session_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and worst move over the three sessions after each user's first day, with their session; equal extremes go to the earlier one."""
    p = panel(spark, sf_dir)
    w = Window.partitionBy("symbol").orderBy("signal_date")
    p = p.withColumn("k", F.row_number().over(w) - 1).withColumn("price", F.first("close").over(w))
    x = p.filter("k between 1 and 3").withColumn("up", F.round((F.try_divide("high", "price") - 1) * 100, 6)).withColumn("down", F.round((F.try_divide("low", "price") - 1) * 100, 6))
    out = x.groupBy("symbol").agg(F.count("*").alias("sessions"), F.max(F.struct("up", (-F.col("k")).alias("k"))).alias("b"), F.min(F.struct("down", "k")).alias("w"))
    return out.select("symbol", "sessions", F.col("b.up").alias("mfe"), (-F.col("b.k")).alias("mfe_session"), F.col("w.down").alias("mae"), F.col("w.k").alias("mae_session"), (F.col("b.up") >= 5).alias("hit"))


Q40 = f"""WITH {PANEL}, k AS (SELECT *, row_number() OVER w - 1 AS k, first_value(close) OVER w AS price FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY signal_date)),
x AS (SELECT symbol, k, round((high / nullif(price, 0) - 1) * 100, 6) AS up, round((low / nullif(price, 0) - 1) * 100, 6) AS down FROM k WHERE k BETWEEN 1 AND 3)
SELECT symbol, count(*) AS sessions, max(up) AS mfe, first(k ORDER BY up DESC, k) AS mfe_session, min(down) AS mae, first(k ORDER BY down, k) AS mae_session, max(up) >= 5 AS hit FROM x GROUP BY 1"""


def q39_horizon_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome after each user's first day: n-th closes, extremes, first touch of +50 %, and whether -50 % came before it (null if the same day)."""
    p = panel(spark, sf_dir)
    w = Window.partitionBy("symbol").orderBy("signal_date")
    p = p.withColumn("k", F.row_number().over(w) - 1).withColumn("price", F.first("close").over(w)).filter("k >= 1")
    ret = lambda c: F.round((F.try_divide(c, "price") - 1) * 100, 6)
    p = p.withColumn("r", ret("close")).withColumn("up", ret("high")).withColumn("down", ret("low"))
    nth = lambda n: F.max(F.when(F.col("k") == n, F.col("r")))
    out = p.groupBy("symbol").agg(nth(1).alias("return_1d"), nth(3).alias("return_3d"), nth(5).alias("return_1w"), F.max("up").alias("mfe"), F.min("down").alias("mae"), F.min(F.when(F.col("up") >= 50, F.col("k"))).alias("hit_day"), F.min(F.when(F.col("down") <= -50, F.col("k"))).alias("fall_day"))
    before = F.when(F.col("hit_day").isNull(), F.col("fall_day").isNotNull()).when(F.col("fall_day").isNull() | (F.col("fall_day") > F.col("hit_day")), False).when(F.col("fall_day") < F.col("hit_day"), True)
    return out.withColumn("fell_before_hit", before)


Q39 = f"""WITH {PANEL}, k AS (SELECT *, row_number() OVER w - 1 AS k, first_value(close) OVER w AS price FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY signal_date)),
x AS (SELECT symbol, k, round((close / nullif(price, 0) - 1) * 100, 6) AS r, round((high / nullif(price, 0) - 1) * 100, 6) AS up, round((low / nullif(price, 0) - 1) * 100, 6) AS down FROM k WHERE k >= 1),
a AS (SELECT symbol, max(r) FILTER (WHERE k = 1) AS return_1d, max(r) FILTER (WHERE k = 3) AS return_3d, max(r) FILTER (WHERE k = 5) AS return_1w, max(up) AS mfe, min(down) AS mae, min(k) FILTER (WHERE up >= 50) AS hit_day, min(k) FILTER (WHERE down <= -50) AS fall_day FROM x GROUP BY 1)
SELECT *, CASE WHEN hit_day IS NULL THEN fall_day IS NOT NULL WHEN fall_day IS NULL OR fall_day > hit_day THEN FALSE WHEN fall_day < hit_day THEN TRUE END AS fell_before_hit FROM a"""


def q38_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a material shipment (over 60,000 or a large share of the order) in the six weeks after them."""
    o, line = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    met = o.join(line, o.o_orderkey == line.l_orderkey, "left")
    inside = (F.col("l_shipdate") > F.col("o_orderdate")) & (F.col("l_shipdate") <= F.col("o_orderdate") + F.expr("INTERVAL '42' DAY"))
    material = (F.col("l_extendedprice") >= 60000) | (F.col("l_extendedprice") >= 0.5 * F.col("o_totalprice"))
    return met.groupBy("o_orderkey").agg(F.coalesce(F.max(inside & material), F.lit(False)).alias("affected"), F.count_if(inside).alias("events"))


Q38 = """SELECT o_orderkey, coalesce(bool_or(inside AND (l_extendedprice >= 60000 OR l_extendedprice >= 0.5 * o_totalprice)), FALSE) AS affected, count(*) FILTER (WHERE inside) AS events
FROM (SELECT *, l_shipdate > o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 42 DAY AS inside FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1"""


def q31_geometric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layered score of customers: linear parts, weighted geometric mean, cap by a hard flag, verdict ladder."""
    o = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("done"))
    c = load(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"))
    parts = [(linear_score(F.col("n").cast("double"), 0, 20), 0.3), (linear_score(F.col("mean"), 0, 300000), 0.4), (linear_score(F.col("done"), 0, 1), 0.2), (linear_score(F.col("c_acctbal"), -1000, 10000), 0.1)]
    raw = geometric_mean(parts)
    capped = F.when(F.col("c_acctbal") < 0, F.least(raw, F.lit(30.0))).otherwise(raw)
    s = c.select("c_custkey", R(capped, 4).alias("score"))
    return s.withColumn("verdict", F.when(F.col("score") >= 60, "STRONG").when(F.col("score") >= 45, "WATCH").when(F.col("score") >= 25, "WEAK").otherwise("AVOID"))


_LIN = "least(100.0, greatest(0.0, ({x} - ({a})) / (({b}) - ({a}))::DOUBLE * 100.0))"
Q31 = f"""WITH o AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean, avg((o_orderstatus = 'F')::INT) AS done FROM orders GROUP BY 1),
x AS (SELECT c_custkey, c_acctbal, exp(0.3 * ln(greatest(1.0, {_LIN.format(x='n', a=0, b=20)})) + 0.4 * ln(greatest(1.0, {_LIN.format(x='mean', a=0, b=300000)})) + 0.2 * ln(greatest(1.0, {_LIN.format(x='done', a=0, b=1)})) + 0.1 * ln(greatest(1.0, {_LIN.format(x='c_acctbal', a=-1000, b=10000)}))) AS raw FROM customer JOIN o ON o_custkey = c_custkey),
s AS (SELECT c_custkey, round(CASE WHEN c_acctbal < 0 THEN least(raw, 30.0) ELSE raw END, 4) AS score FROM x) SELECT c_custkey, score, CASE WHEN score >= 60 THEN 'STRONG' WHEN score >= 45 THEN 'WATCH' WHEN score >= 25 THEN 'WEAK' ELSE 'AVOID' END AS verdict FROM s"""


def q33_ensemble_quartile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower quartile of 15 weightings of three parts per part row: the members are exploded, the quartile is exact."""
    p = load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 2.0).alias("a"), ((F.col("p_retailprice") - 900) / 2).alias("b"), (F.length("p_name") * 5.0).alias("c"))
    tilt = F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("tilt")
    m = p.select("*", tilt).withColumn("lead", F.explode(F.sequence(F.lit(0), F.lit(2))))
    weight = lambda i: 1 + F.when(F.col("lead") == i, F.col("tilt") * 0.2).otherwise(0.0)
    score = (weight(0) * F.col("a") + weight(1) * F.col("b") + weight(2) * F.col("c")) / (weight(0) + weight(1) + weight(2))
    m = m.withColumn("score", F.round(score, 8))
    return m.groupBy("p_partkey").agg(R(F.percentile("score", F.lit(0.25))).alias("quartile"), R(F.min("score")).alias("low"), R(F.max("score") - F.min("score")).alias("spread"))


Q33E = """WITH m AS (SELECT p_partkey, p_size * 2.0::DOUBLE AS a, (p_retailprice - 900) / 2 AS b, length(p_name) * 5.0::DOUBLE AS c, tilt, lead FROM part CROSS JOIN range(-2, 3) t(tilt) CROSS JOIN range(0, 3) l(lead)),
w AS (SELECT *, 1 + CASE WHEN lead = 0 THEN tilt * 0.2::DOUBLE ELSE 0 END AS wa, 1 + CASE WHEN lead = 1 THEN tilt * 0.2::DOUBLE ELSE 0 END AS wb, 1 + CASE WHEN lead = 2 THEN tilt * 0.2::DOUBLE ELSE 0 END AS wc FROM m),
s AS (SELECT p_partkey, round((wa * a + wb * b + wc * c) / (wa + wb + wc), 8) AS score FROM w) SELECT p_partkey, round(quantile_cont(score, 0.25), 6) AS quartile, round(min(score), 6) AS low, round(max(score) - min(score), 6) AS spread FROM s GROUP BY 1"""


def q46_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best of four hypotheses (side x style) per symbol and hour, with penalties and a tie-break order."""
    b = bars(spark, sf_dir, 60)
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    ret = lambda n: F.round((F.try_divide("close", F.lag("close", n).over(w)) - 1) * 100, 6)
    b = b.select("symbol", "bar_ts", ret(1).alias("r1"), ret(4).alias("r4"), "trade_count").filter("r1 is not null and r4 is not null")
    h = b.select("*", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("side"), F.lit(t).alias("style")) for k, (s, t) in enumerate((s, t) for s in (1, -1) for t in ("CONTINUATION", "REVERSION"))])).alias("h"))
    move = F.col("h.side") * F.when(F.col("h.style") == "CONTINUATION", F.col("r4")).otherwise(-F.col("r4"))
    turn = F.col("h.side") * F.col("r1")
    fine = F.when(turn < 0, 12.0).otherwise(0.0) + F.when(F.col("trade_count") < 3, 8.0).otherwise(0.0)
    score = F.round(clamp(50.0 + 30.0 * F.tanh(move / 40.0) + 15.0 * F.tanh(turn / 30.0) - fine, 0.0, 100.0), 6)
    best = Window.partitionBy("symbol", "bar_ts").orderBy(F.col("score").desc(), "h.k")
    top = h.withColumn("score", score).withColumn("place", F.row_number().over(best)).filter("place <= 2")
    out = top.groupBy("symbol", "bar_ts").agg(F.max(F.when(F.col("place") == 1, F.col("h"))).alias("h"), F.max("score").alias("score"), F.round(F.max("score") - F.min("score"), 6).alias("margin"))
    return out.select("symbol", "bar_ts", F.when(F.col("h.side") > 0, "LONG").otherwise("SHORT").alias("direction"), F.col("h.style").alias("style"), "score", "margin", (F.col("margin") < 3).alias("ambiguous"))


Q46H = f"""WITH {BARS.replace("'15 minutes'", "'60 minutes'")}, r AS (SELECT symbol, bar_ts, trade_count, round((close / nullif(lag(close, 1) OVER w, 0) - 1) * 100, 6) AS r1, round((close / nullif(lag(close, 4) OVER w, 0) - 1) * 100, 6) AS r4 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
h AS (SELECT *, side * CASE WHEN style = 'CONTINUATION' THEN r4 ELSE -r4 END AS move, side * r1 AS turn FROM r CROSS JOIN (VALUES (0, 1, 'CONTINUATION'), (1, 1, 'REVERSION'), (2, -1, 'CONTINUATION'), (3, -1, 'REVERSION')) t(k, side, style) WHERE r1 IS NOT NULL AND r4 IS NOT NULL),
s AS (SELECT *, round(least(100.0, greatest(0.0, 50.0 + 30.0 * tanh(move / 40.0) + 15.0 * tanh(turn / 30.0) - CASE WHEN turn < 0 THEN 12 ELSE 0 END - CASE WHEN trade_count < 3 THEN 8 ELSE 0 END))::DOUBLE, 6) AS score FROM h),
p AS (SELECT *, row_number() OVER (PARTITION BY symbol, bar_ts ORDER BY score DESC, k) AS place FROM s)
SELECT symbol, bar_ts, CASE WHEN max(side) FILTER (WHERE place = 1) > 0 THEN 'LONG' ELSE 'SHORT' END AS direction, max(style) FILTER (WHERE place = 1) AS style, max(score) AS score, round(max(score) - min(score), 6) AS margin, round(max(score) - min(score), 6) < 3 AS ambiguous FROM p WHERE place <= 2 GROUP BY symbol, bar_ts"""


def q36_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order value known strictly before a cut-off, the comparable one 330 to 400 days before it, and their change."""
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy(F.col("day").desc(), F.col("o_orderkey").desc())
    last = o.withColumn("k", F.row_number().over(w)).filter("k = 1").select("o_custkey", F.col("day").alias("last_day"), F.col("o_totalprice").alias("latest"))
    met = o.join(last, "o_custkey").filter(F.datediff("last_day", "day").between(330, 400))
    prior = met.withColumn("k", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.abs(F.datediff("last_day", "day") - 365), "o_orderkey"))).filter("k = 1").select("o_custkey", F.col("o_totalprice").alias("prior"))
    return last.join(prior, "o_custkey", "left").select("o_custkey", "last_day", "latest", "prior", R(2 * (F.col("latest") - F.col("prior")) / F.nullif(F.abs("latest") + F.abs("prior"), F.lit(0.0))).alias("symmetric_change"))


Q36 = """WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
l AS (SELECT o_custkey, day AS last_day, o_totalprice AS latest FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) = 1),
p AS (SELECT o.o_custkey, o_totalprice AS prior FROM o JOIN l USING (o_custkey) WHERE last_day - day BETWEEN 330 AND 400 QUALIFY row_number() OVER (PARTITION BY o.o_custkey ORDER BY abs(last_day - day - 365), o_orderkey) = 1)
SELECT o_custkey, last_day, latest, prior, round(2 * (latest - prior) / nullif(abs(latest) + abs(prior), 0), 6) AS symmetric_change FROM l LEFT JOIN p USING (o_custkey)"""


#: Equal intervals and p-values need the same generator, seed, block length, number of replications and shape of draws.
BOOTSTRAP = {"block": 5, "replications": 20_000, "seed": 20260813}


def q23_bootstrap(spark: SparkSession, sf_dir: str, block: int = BOOTSTRAP["block"], replications: int = BOOTSTRAP["replications"], seed: int = BOOTSTRAP["seed"]) -> DataFrame:
    """Circular block bootstrap of each definition's ordered monthly means: interval and one-sided p. One small series per group; replications are drawn in slices, in the seed's order."""
    line = load(spark, sf_dir, "lineitem").select(F.concat_ws("|", "l_returnflag", "l_linestatus").alias("candidate"), F.date_format("l_shipdate", "yyyyMM").alias("month"), (F.col("l_discount") - F.col("l_tax") - 0.01).alias("net"))
    months = line.groupBy("candidate", "month").agg(F.round(F.avg("net"), 9).alias("net"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("month")["net"].to_numpy()
        rng, means, null = np.random.Generator(np.random.PCG64(seed)), np.empty(replications), np.empty(replications)
        for i in range(0, replications, 2000):
            n = min(2000, replications - i)
            draws = rng.integers(0, len(x), size=(n, -(-len(x) // block)))
            at = (draws[:, :, None] + np.arange(block)).reshape(n, -1)[:, : len(x)] % len(x)
            means[i : i + n], null[i : i + n] = x[at].mean(axis=1), (x - x.mean())[at].mean(axis=1)
        low, high = np.quantile(means, [0.025, 0.975])
        return pd.DataFrame({"candidate": [pdf["candidate"].iloc[0]], "n": [len(x)], "mean": [round(float(x.mean()), 9)], "low": [round(float(low), 9)], "high": [round(float(high), 9)], "p": [(1 + int((null >= x.mean()).sum())) / (replications + 1)]})

    return months.groupBy("candidate").applyInPandas(run, "candidate string, n long, mean double, low double, high double, p double")


def q24_placebo_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of each symbol's hourly price with its own series shifted in a circle by 0 to 5 hours."""
    h = ticks(spark, sf_dir).groupBy("symbol", F.date_trunc("hour", "ts").alias("h")).agg(F.round(F.avg("price"), 6).alias("x"))
    w = Window.partitionBy("symbol")
    h = h.withColumn("i", F.row_number().over(w.orderBy("h")) - 1).withColumn("n", F.count("*").over(w))
    moved = h.select("symbol", "n", "i", "x", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("shift")).withColumn("j", (F.col("i") + F.col("shift")) % F.col("n"))
    return moved.join(h.select("symbol", F.col("i").alias("j"), F.col("x").alias("y")), ["symbol", "j"]).groupBy("symbol", "shift").agg(R(F.corr("x", "y")).alias("correlation"))


Q24P = f"""WITH {TICKS}, g AS (SELECT symbol, date_trunc('hour', ts) AS h, round(avg(price), 6) AS x FROM ticks GROUP BY ALL), h AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY h) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM g)
SELECT a.symbol, shift::INT AS shift, round(corr(a.x, b.x), 6) AS correlation FROM h a CROSS JOIN range(0, 6) s(shift) JOIN h b ON b.symbol = a.symbol AND b.i = (a.i + shift) % a.n GROUP BY ALL"""


def q57_missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label: what a rescoring has to do."""
    return load(spark, sf_dir, "documents").select("doc_id", "source").join(load(spark, sf_dir, "labels"), "doc_id", "left_anti")


Q57 = "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


def q54_sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each source's sample, whatever the order of rows: count and order-free sum of row hashes in text form."""
    s = samples(spark, sf_dir).select("source", F.md5(F.concat_ws("|", "doc_id", F.col("target").cast("string"))).alias("m"))
    part = F.conv(F.substring("m", 1, 8), 16, 10).cast("long")
    return s.groupBy("source").agg(F.count("*").alias("n"), F.sum(part).alias("fingerprint"))


Q54 = f"WITH {SAMPLES} SELECT source, count(*) AS n, sum(('0x' || substr(md5(concat_ws('|', doc_id, target)), 1, 8))::BIGINT)::BIGINT AS fingerprint FROM s GROUP BY 1"

_SQL = {
    "q25_text_classes": Q25, "q42_calibration": Q42, "q33_token_similarity": Q33, "q26_relevance": Q26, "q27_quantities": Q27, "q43_reliability": Q43, "q43_auc": Q43A, "q45_score_deciles": Q45,
    "q40_three_session_path": Q40, "q39_horizon_outcome": Q39, "q38_contamination": Q38, "q31_geometric_score": Q31, "q33_ensemble_quartile": Q33E, "q46_hypotheses": Q46H, "q36_point_in_time": Q36,
    "q24_placebo_shift": Q24P, "q57_missing_runs": Q57, "q54_sample_hash": Q54,
}
QUERIES = {name: globals()[name] for name in (*_SQL, "q23_bootstrap")}
ORACLES = _SQL
