"""Freezes, holdouts, books, folds, checkpoints, ladders and rollups, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import summarise
from ..functions.timeutil import trade_date, utc_time
from ..operators.asof import asof
from ..operators.keyed import latest_per_key
from ..operators.ranks import normalised_ranks
from ..session import load
from ..sources.tables import bars, ticks
from .campaigns import BOOK, LEDGER, SCOPES_SQL, SIGNALS, _ledger, _signals, metrics_sql, q13_scope_metrics
from .events import SAMPLES, samples
from .market import BARS, NYB, TICKS, R


def q14_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One definition per construction: the best of the worse of inner and outer mean, then the combined median, then the fewest names."""
    m = q13_scope_metrics(spark, sf_dir)
    wide = m.groupBy("construction", "top_n").pivot("scope", ["INNER", "OUTER", "COMBINED"]).agg(F.max("avg_net").alias("avg"), F.max("median_net").alias("median"))
    order = [F.least("INNER_avg", "OUTER_avg").desc_nulls_last(), F.col("COMBINED_median").desc_nulls_last(), F.col("top_n").asc()]
    return latest_per_key(wide, ["construction"], *order).select("construction", "top_n", "INNER_avg", "OUTER_avg", "COMBINED_median")


Q14 = f"""WITH {BOOK}, {SCOPES_SQL}, m AS (SELECT scope, construction, top_n, {metrics_sql('net')} FROM ledger JOIN scopes ON signal_date BETWEEN scope_start AND scope_end GROUP BY ALL)
SELECT i.construction, i.top_n, i.avg_net AS INNER_avg, o.avg_net AS OUTER_avg, c.median_net AS COMBINED_median FROM m i JOIN m o USING (construction, top_n) JOIN m c USING (construction, top_n)
WHERE i.scope = 'INNER' AND o.scope = 'OUTER' AND c.scope = 'COMBINED' QUALIFY row_number() OVER (PARTITION BY i.construction ORDER BY least(i.avg_net, o.avg_net) DESC NULLS LAST, c.median_net DESC NULLS LAST, i.top_n) = 1"""


class HoldoutLocked(RuntimeError):
    """Stage B was asked for although no definition passed stage A."""


def holdout_gate(df: DataFrame, keys: list[str], net: str, stage: str, passed: DataFrame | None = None, min_trades: int = 10) -> DataFrame:
    """Metrics with the list of gates each definition fails. Stage B takes stage A's survivors alone and is locked without any."""
    if stage == "B":
        if passed is None or passed.isEmpty():
            raise HoldoutLocked("no definition passed stage A")
        df = df.join(passed.select(*keys), keys, "left_semi")
    m = summarise(df, keys, net)
    gates = (("TRADES", F.col("trades") >= min_trades), ("MEAN", F.col("avg_net") > 0), ("MEDIAN", F.col("median_net") > 0), ("WIN_RATE", F.col("win_rate") > 0.5), ("PROFIT_FACTOR", F.col("profit_factor") > 1))
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in gates]))
    return m.withColumn("failed", failed).withColumn("passed", F.size("failed") == 0)


def q15_sequential_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _ledger(spark, sf_dir)
    keys = ["l_returnflag", "l_linestatus"]
    a = holdout_gate(d.filter("day < date '1999-01-01'"), keys, "gross", "A")
    survivors = a.filter("passed")
    out = a.withColumn("stage", F.lit("A"))
    if not survivors.isEmpty():
        out = out.unionByName(holdout_gate(d.filter("day >= date '1999-01-01'"), keys, "gross", "B", survivors).withColumn("stage", F.lit("B")))
    return out.select("stage", *keys, "trades", "avg_net", "median_net", F.array_join("failed", ",").alias("failed"), "passed")


_GATE = "array_to_string(list_filter([CASE WHEN NOT coalesce(trades >= 10, FALSE) THEN 'TRADES' END, CASE WHEN NOT coalesce(avg_net > 0, FALSE) THEN 'MEAN' END, CASE WHEN NOT coalesce(median_net > 0, FALSE) THEN 'MEDIAN' END, CASE WHEN NOT coalesce(win_rate > 0.5, FALSE) THEN 'WIN_RATE' END, CASE WHEN NOT coalesce(profit_factor > 1, FALSE) THEN 'PROFIT_FACTOR' END], lambda x: x IS NOT NULL), ',')"
Q15 = f"""WITH {LEDGER}, a0 AS (SELECT l_returnflag, l_linestatus, {metrics_sql('gross')} FROM led WHERE day < DATE '1999-01-01' GROUP BY ALL), a AS (SELECT *, coalesce({_GATE}, '') AS failed FROM a0),
b0 AS (SELECT l_returnflag, l_linestatus, {metrics_sql('gross')} FROM led WHERE day >= DATE '1999-01-01' AND EXISTS (SELECT 1 FROM a WHERE a.l_returnflag = led.l_returnflag AND a.l_linestatus = led.l_linestatus AND a.failed = '') GROUP BY ALL), b AS (SELECT *, coalesce({_GATE}, '') AS failed FROM b0)
SELECT 'A' AS stage, l_returnflag, l_linestatus, trades, avg_net, median_net, failed, failed = '' AS passed FROM a UNION ALL SELECT 'B', l_returnflag, l_linestatus, trades, avg_net, median_net, failed, failed = '' FROM b"""


def q10_context_postprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions by context bin of a second column, with the share of positive years and HAVING on the exact median."""
    d = _ledger(spark, sf_dir).withColumn("context", F.when(F.col("l_quantity") < 15, "small").when(F.col("l_quantity") <= 35, "middle").otherwise("large")).withColumn("net", F.col("gross") - 0.005)
    y = d.groupBy("l_returnflag", "context", F.year("day").alias("y")).agg(F.count("*").alias("n"), F.round(F.avg("net"), 7).alias("m"))
    a = y.groupBy("l_returnflag", "context").agg(F.count("*").alias("years"), F.count_if(F.col("m") > 0).alias("positive"), F.min("n").alias("min_n"), F.sum("n").alias("n"), R(F.median("m")).alias("median_year"))
    return a.filter("positive >= 3 and median_year > 0")


Q10 = f"""WITH {LEDGER}, y AS (SELECT l_returnflag, CASE WHEN l_quantity < 15 THEN 'small' WHEN l_quantity <= 35 THEN 'middle' ELSE 'large' END AS context, year(day) AS y, count(*) AS n, round(avg(gross - 0.005), 7) AS m FROM led GROUP BY ALL)
SELECT l_returnflag, context, count(*) AS years, count(*) FILTER (WHERE m > 0) AS positive, min(n) AS min_n, sum(n)::BIGINT AS n, round(median(m), 6) AS median_year FROM y GROUP BY ALL HAVING count(*) FILTER (WHERE m > 0) >= 3 AND round(median(m), 6) > 0"""


def q18_rank_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank books by regime of the day's cross-section: breadth of positive day returns in thirds."""
    s = _signals(spark, sf_dir).filter("next_open > 0 and next_close is not null").withColumn("ret", F.col("next_close") / F.col("next_open") - 1)
    r = normalised_ranks(s, ["signal_date"], "symbol", ["day_return"]).withColumn("breadth", F.avg((F.col("day_return") > 0).cast("double")).over(Window.partitionBy("signal_date")))
    regime = F.when(F.col("breadth") < 0.45, "WEAK").when(F.col("breadth") <= 0.55, "MIXED").otherwise("STRONG")
    side = F.when(F.col("day_return_rank") <= 0.1, 1).when(F.col("day_return_rank") >= 0.9, -1)
    return summarise(r.withColumn("regime", regime).withColumn("net", side * F.col("ret") - 0.001).filter("net is not null"), ["regime"], "net")


Q18 = f"""WITH {SIGNALS}, r AS (SELECT *, next_close / next_open - 1 AS ret, (row_number() OVER (PARTITION BY signal_date ORDER BY day_return, symbol) - 1)::DOUBLE / nullif(count(*) OVER (PARTITION BY signal_date) - 1, 0) AS k, avg((day_return > 0)::INT) OVER (PARTITION BY signal_date) AS breadth FROM sig WHERE next_open > 0 AND next_close IS NOT NULL),
n AS (SELECT CASE WHEN breadth < 0.45 THEN 'WEAK' WHEN breadth <= 0.55 THEN 'MIXED' ELSE 'STRONG' END AS regime, CASE WHEN k <= 0.1 THEN ret WHEN k >= 0.9 THEN -ret END - 0.001 AS net FROM r)
SELECT regime, {metrics_sql('net')} FROM n WHERE net IS NOT NULL GROUP BY 1"""


def q41_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last bar strictly before each checkpoint of the New York session (open + 1 h, middle, close), within two hours."""
    b = bars(spark, sf_dir)
    points = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(m).alias("minute")) for n, m in (("open_plus_1h", 630), ("mid_session", 765), ("close", 960))])).alias("p")
    days = b.select("symbol", trade_date(F.col("bar_ts")).alias("day")).distinct().select("symbol", "day", points)
    due = utc_time(F.col("day").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("p.minute")))
    left = days.select("symbol", "day", F.col("p.name").alias("checkpoint"), due.alias("due")).withColumn("left_id", F.concat_ws("|", "symbol", "day", "checkpoint"))
    right = b.select("symbol", F.col("bar_ts").alias("seen"), "close")
    return asof(left, right, "symbol", "due", "seen", 7200).select("symbol", "day", "checkpoint", "seen", "close")


Q41 = f"""WITH {BARS}, d AS (SELECT DISTINCT symbol, CAST({NYB} AS DATE) AS day FROM bars), c AS (SELECT *, ((day + to_minutes(m)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS due FROM d CROSS JOIN (VALUES ('open_plus_1h', 630), ('mid_session', 765), ('close', 960)) t(checkpoint, m)),
m AS (SELECT c.symbol, c.day, c.checkpoint, b.bar_ts AS seen, b.close FROM c JOIN bars b ON b.symbol = c.symbol AND b.bar_ts < c.due AND b.bar_ts >= c.due - INTERVAL 2 HOUR QUALIFY row_number() OVER (PARTITION BY c.symbol, c.day, c.checkpoint ORDER BY b.bar_ts DESC) = 1)
SELECT c.symbol, c.day, c.checkpoint, m.seen, m.close FROM c LEFT JOIN m USING (symbol, day, checkpoint)"""


def q44_expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rate of all earlier folds against the fold's own, by language, five folds in order of id."""
    s = samples(spark, sf_dir).withColumn("fold", F.ntile(5).over(Window.partitionBy("lang").orderBy("doc_id")))
    f = s.groupBy("lang", "fold").agg(F.count("*").alias("n"), F.count_if("target").alias("hits"))
    w = Window.partitionBy("lang").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    return f.select("lang", "fold", "n", R(F.col("hits") / F.col("n")).alias("rate"), R(F.sum("hits").over(w) / F.sum("n").over(w)).alias("earlier_rate"))


Q44 = f"""WITH {SAMPLES}, f AS (SELECT *, ntile(5) OVER (PARTITION BY lang ORDER BY doc_id) AS fold FROM s), g AS (SELECT lang, fold, count(*) AS n, count(*) FILTER (WHERE target) AS hits FROM f GROUP BY ALL)
SELECT lang, fold, n, round(hits / n, 6) AS rate, round(sum(hits) OVER w / sum(n) OVER w, 6) AS earlier_rate FROM g WINDOW w AS (PARTITION BY lang ORDER BY fold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def q43_pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under precision and recall per language; equal scores in order of id."""
    s = samples(spark, sf_dir)
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    s = s.select("lang", "target", F.sum(F.col("target").cast("int")).over(w).alias("tp"), F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), "doc_id")).alias("k"))
    return s.groupBy("lang").agg(R(F.sum(F.when(F.col("target"), F.col("tp") / F.col("k"))) / F.nullif(F.count_if("target"), F.lit(0))).alias("pr_auc"))


Q43P = f"""WITH {SAMPLES}, r AS (SELECT lang, target, sum(target::INT) OVER w AS tp, row_number() OVER w AS k FROM s WINDOW w AS (PARTITION BY lang ORDER BY score DESC, doc_id)) SELECT lang, round(sum(tp / k) FILTER (WHERE target) / nullif(count(*) FILTER (WHERE target), 0), 6) AS pr_auc FROM r GROUP BY 1"""

def q32_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stress pass rate of each supplier over six scenarios of cost and balance."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    case = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h).alias("haircut"), F.lit(f).alias("floor")) for n, h, f in (("base", 0.0, 0.0), ("cost", 0.1, 0.0), ("stress", 0.3, 500.0), ("severe", 0.5, 500.0), ("liquidity", 0.0, 3000.0), ("tail", 0.6, 2000.0))])).alias("c")
    x = s.select("*", case).withColumn("left", F.col("s_acctbal") * (1 - F.col("c.haircut")) - F.col("c.floor"))
    return x.groupBy("s_suppkey").agg(R(F.avg((F.col("left") > 0).cast("double"))).alias("pass_rate"), R(F.min("left"), 4).alias("worst"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("left") <= 0, F.col("c.name")))), ",").alias("failed"))


Q32 = """WITH c(name, haircut, fl) AS (VALUES ('base', 0.0::DOUBLE, 0.0::DOUBLE), ('cost', 0.1, 0.0), ('stress', 0.3, 500.0), ('severe', 0.5, 500.0), ('liquidity', 0.0, 3000.0), ('tail', 0.6, 2000.0)), x AS (SELECT s_suppkey, name, s_acctbal * (1 - haircut) - fl AS rest FROM supplier CROSS JOIN c)
SELECT s_suppkey, round(avg((rest > 0)::INT), 6) AS pass_rate, round(min(rest), 4) AS worst, coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE rest <= 0), '') AS failed FROM x GROUP BY 1"""


def a19_object_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rollup per segment as a map, with width buckets of balances."""
    c = load(spark, sf_dir, "customer").withColumn("bucket", F.width_bucket("c_acctbal", F.lit(-1000.0), F.lit(10000.0), F.lit(5)))
    n = c.groupBy("c_mktsegment", "bucket").agg(F.count("*").alias("n"))
    pair = F.concat(F.col("bucket").cast("string"), F.lit(":"), F.col("n").cast("string"))
    return n.groupBy("c_mktsegment").agg(F.array_join(F.sort_array(F.collect_list(pair)), ";").alias("buckets"), F.sum("n").alias("total"))


A19 = """WITH b AS (SELECT c_mktsegment, CASE WHEN c_acctbal < -1000 THEN 0 WHEN c_acctbal >= 10000 THEN 6 ELSE floor((c_acctbal + 1000) / 2200)::INT + 1 END AS bucket, count(*) AS n FROM customer GROUP BY ALL)
SELECT c_mktsegment, string_agg(bucket || ':' || n, ';' ORDER BY bucket || ':' || n) AS buckets, sum(n)::BIGINT AS total FROM b GROUP BY 1"""


def q60_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary event and tags of an order from its lines: the first rung that fits, distinct tags, damage band."""
    line = load(spark, sf_dir, "lineitem")
    x = line.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.max("l_discount").alias("cut"), F.sum("l_quantity").alias("q"), F.bool_or(F.col("l_linestatus") == "O").alias("open"))
    primary = F.when(F.col("returned") & (F.col("cut") >= 0.08), "capital_distress").when(F.col("cut") >= 0.08, "guidance_reduction").when(F.col("returned"), "temporary_issue").when(F.col("q") < 20, "sentiment").otherwise("unknown")
    tags = F.array_distinct(F.array_compact(F.array(primary, F.when(F.col("returned"), "temporary_issue"), F.when(F.col("open"), "open"), F.when(F.col("q") > 150, "bulk"))))
    damage = F.round(F.col("cut") * 800 + F.when(F.col("returned"), 20).otherwise(0), 4)
    return x.select("l_orderkey", primary.alias("primary_event"), F.array_join(tags, ",").alias("tags"), F.when(damage >= 80, "STRUCTURAL").when(damage >= 65, "HIGH").when(damage >= 30, "MODERATE").otherwise("LOW").alias("damage"))


Q60 = """WITH x AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, max(l_discount) AS cut, sum(l_quantity) AS q, bool_or(l_linestatus = 'O') AS open FROM lineitem GROUP BY 1),
y AS (SELECT *, CASE WHEN returned AND cut >= 0.08 THEN 'capital_distress' WHEN cut >= 0.08 THEN 'guidance_reduction' WHEN returned THEN 'temporary_issue' WHEN q < 20 THEN 'sentiment' ELSE 'unknown' END AS p, round(cut * 800 + CASE WHEN returned THEN 20 ELSE 0 END, 4) AS d FROM x)
SELECT l_orderkey, p AS primary_event, p || CASE WHEN returned AND p <> 'temporary_issue' THEN ',temporary_issue' ELSE '' END || CASE WHEN open THEN ',open' ELSE '' END || CASE WHEN q > 150 THEN ',bulk' ELSE '' END AS tags,
 CASE WHEN d >= 80 THEN 'STRUCTURAL' WHEN d >= 65 THEN 'HIGH' WHEN d >= 30 THEN 'MODERATE' ELSE 'LOW' END AS damage FROM y"""


def q59_alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names matched by normalised alias: part names' words in order against brands' parts of the same alias."""
    alias = F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(F.lower("p_name"), "[^a-z0-9 ]", " ")), " +")), " ")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand", alias.alias("alias"))
    return p.groupBy("alias").agg(F.countDistinct("p_brand").alias("brands"), F.count("*").alias("parts"), F.min("p_partkey").alias("first_part"))


Q59 = "WITH p AS (SELECT p_partkey, p_brand, array_to_string(list_sort(regexp_split_to_array(trim(regexp_replace(lower(p_name), '[^a-z0-9 ]', ' ', 'g')), ' +')), ' ') AS alias FROM part) SELECT alias, count(DISTINCT p_brand) AS brands, count(*) AS parts, min(p_partkey) AS first_part FROM p GROUP BY 1"

_SQL = {
    "q14_freeze": Q14, "q15_sequential_holdout": Q15, "q10_context_postprocess": Q10, "q18_rank_regimes": Q18, "q41_checkpoints": Q41, "q44_expanding_folds": Q44, "q43_pr_auc": Q43P,
    "q32_scenarios": Q32, "a19_object_aggregates": A19, "q60_taxonomy": Q60, "q59_alias_match": Q59,
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
