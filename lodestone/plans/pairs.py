"""Pair campaign: yearly ledger of all definitions, discovery, validation and freeze, with their DuckDB SQL.

Line items stand in for the pair panel: return flag and line status are the pair, the line number the decision minute. The
first five years are for discovery, all later ones for validation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from ..session import load
from .market import R

#: Signals (divergences) and exits (spreads) in percent, as expressions over the stand-in.
SIGNALS = {"15m": "10 * (l_discount - l_tax)", "30m": "5 * (l_discount - l_tax)", "60m": "10 * (l_discount - 0.05)", "open": "10 * (l_tax - 0.04)"}
EXITS = {"30m": "l_quantity / 100", "60m": "l_quantity / 100 - 0.25", "close": "0.3 - l_quantity / 100"}
#: Magnitude rules, closed below and open above, and the cost of a trade in percent (fixed values).
BANDS = [
    ("all", 0.0, None), (">=0.05", 0.05, None), (">=0.10", 0.10, None), (">=0.25", 0.25, None), (">=0.50", 0.50, None), (">=1.00", 1.00, None),
    ("0.05:0.10", 0.05, 0.10), ("0.10:0.25", 0.10, 0.25), ("0.25:0.50", 0.25, 0.50), ("0.50:1.00", 0.50, 1.00),
]
EDGES = [0.0, 0.05, 0.10, 0.25, 0.50, 1.00]
COST = 0.10
#: Years of discovery, and what discovery and validation ask for (fixed values).
DISCOVERY_YEARS = 5
PAIR = ["a_symbol", "b_symbol", "decision_minute"]
ROUNDED = ("median_net", "win_rate", "worst", "best")
KEYS = ["signal_name", "exit_name", *PAIR, "mag_rule", "style"]


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = load(spark, sf_dir, "lineitem").filter("l_shipdate is not null")
    return line.select(F.year(F.col("l_shipdate").cast("date")).alias("yr"), F.col("l_returnflag").alias("a_symbol"), F.col("l_linestatus").alias("b_symbol"), F.col("l_linenumber").alias("decision_minute"), "l_discount", "l_tax", "l_quantity")


def signed_counts(panel: DataFrame) -> DataFrame:
    """n trades by year, pair, signal, interval of magnitude, exit and signed spread: each row is counted before any definition is formed."""
    first = panel.groupBy("yr", *PAIR, "l_discount", "l_tax", "l_quantity").agg(F.count("*").alias("n"))
    stacked = first.select("yr", *PAIR, "l_quantity", "n", F.explode(F.array(*[F.struct(F.lit(s).alias("signal_name"), F.expr(e).cast("double").alias("div")) for s, e in SIGNALS.items()])).alias("s"))
    size = F.abs("s.div")
    step = sum((F.when(size >= e, 1).otherwise(0) for e in EDGES[1:]), F.lit(0))
    by_size = stacked.filter("s.div is not null and l_quantity is not null").groupBy("yr", *PAIR, F.col("s.signal_name").alias("signal_name"), step.alias("step"), F.signum("s.div").alias("side"), "l_quantity").agg(F.sum("n").alias("n"))
    out = by_size.select("*", F.explode(F.array(*[F.struct(F.lit(x).alias("exit_name"), F.expr(e).cast("double").alias("spread")) for x, e in EXITS.items()])).alias("x"))
    return out.select("yr", *PAIR, "signal_name", "step", F.col("x.exit_name").alias("exit_name"), (F.col("side") * F.col("x.spread") + 0.0).alias("signed"), "n")


def in_bands(counts: DataFrame) -> DataFrame:
    """Each interval's counts under every magnitude rule that it is part of; the intervals' edges are the rules' own."""
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(EDGES.index(lo)).alias("lo"), F.lit(len(EDGES) if hi is None else EDGES.index(hi)).alias("hi")) for name, lo, hi in BANDS])
    fit = F.filter(rules, lambda r: (r["lo"] <= F.col("step")) & (F.col("step") < r["hi"]))
    met = counts.withColumn("mag_rule", F.explode(F.transform(fit, lambda r: r["rule"])))
    return met.groupBy("signal_name", "exit_name", *PAIR, "mag_rule", "yr", "signed").agg(F.sum("n").alias("n"))


def styled(counts: DataFrame) -> DataFrame:
    """Both styles, with the net of each value: style * signed spread - cost."""
    return counts.withColumn("style", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("net", F.col("style") * F.col("signed") - COST)


def weighted(net: Column, n: Column) -> dict[str, Column]:
    """Statistics of values that occur n times each; values lie on a grid of prices, so a group has few of them.

    Sums are rounded beyond the grid, so that means don't show the order of summation.
    """
    mean = lambda fit: F.round(F.sum(F.when(fit, net * n)), 9) / F.sum(F.when(fit, n))
    return {
        "n": F.sum(n), "avg_net": mean(F.lit(True)), "median_net": F.percentile(net, F.lit(0.5), n), "win_rate": F.sum(F.when(net > 0, n).otherwise(0)) / F.sum(n) * 100,
        "worst": F.min(net), "best": F.max(net), "avg_win": mean(net > 0), "avg_loss": mean(net < 0),
    }


def _stats(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[(c if k == "n" else R(c) + F.lit(0.0) if k in ROUNDED else c + F.lit(0.0)).alias(k) for k, c in weighted(F.col("net"), F.col("n")).items()])


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styled(in_bands(signed_counts(_panel(spark, sf_dir))))


def _first_validation_year(spark: SparkSession, sf_dir: str) -> int:
    return (load(spark, sf_dir, "lineitem").agg(F.min(F.year(F.col("l_shipdate").cast("date")))).first()[0] or 0) + DISCOVERY_YEARS


def q8_pair_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly statistics of all definitions: 4 signals, 3 exits, 10 magnitude rules, 2 styles, every pair and minute."""
    return _stats(_ledger(spark, sf_dir), [*KEYS, "yr"])


def q9_discovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions that hold in the years of discovery: present in all, positive in four, enough trades, no bad year."""
    return _discovery(_stats(_ledger(spark, sf_dir), [*KEYS, "yr"]), _first_validation_year(spark, sf_dir))


def _discovery(years: DataFrame, cut: int) -> DataFrame:
    a = years.filter(F.col("yr") < cut).groupBy(*KEYS).agg(
        F.count("*").alias("years"), F.count_if(F.col("avg_net") > 0).alias("positive_years"), F.sum("n").alias("total_n"), F.min("n").alias("min_year_n"), F.min("avg_net").alias("worst_year_avg"),
        R(F.avg("avg_net")).alias("mean_year_avg"), F.min("median_net").alias("worst_year_median"), F.min("win_rate").alias("worst_year_win"), F.min("worst").alias("worst_trade"), F.max("best").alias("best_trade"),
    )
    kept = a.filter(f"years = {DISCOVERY_YEARS} and positive_years >= 4 and min_year_n >= 15 and mean_year_avg > 0 and worst_year_avg > -0.10")
    return kept.withColumn("candidate_id", F.md5(F.concat_ws("|", *KEYS)))


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered definitions with their statistics in the later years; the events of those years come from the same counts."""
    cut = _first_validation_year(spark, sf_dir)
    counts = _ledger(spark, sf_dir)
    found = _discovery(_stats(counts.filter(F.col("yr") < cut), [*KEYS, "yr"]), cut)
    events = counts.filter(F.col("yr") >= cut).join(found.select(*KEYS, "candidate_id"), KEYS)
    whole = _stats(events, ["candidate_id"])
    whole = whole.select("candidate_id", *[F.col(c).alias(f"validation_{c}") for c in whole.columns[1:]])
    years = _stats(events, ["candidate_id", "yr"]).groupBy("candidate_id").agg(
        F.count("*").alias("validation_years"), F.count_if(F.col("avg_net") > 0).alias("validation_positive_years"), F.min("n").alias("validation_min_year_n"), F.min("avg_net").alias("validation_worst_year_avg"),
        F.min("median_net").alias("validation_worst_year_median"), F.min("win_rate").alias("validation_worst_year_win"),
    )
    return found.join(whole, "candidate_id").join(years, "candidate_id")


def q9_validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every discovered definition beside its years of validation."""
    return _validation(spark, sf_dir)


def q9_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions that hold in all years of validation; these are what a holdout may be opened for."""
    v = _validation(spark, sf_dir)
    gates = "validation_years >= 2 and validation_positive_years = validation_years and validation_min_year_n >= 5 and validation_avg_net > 0 and validation_median_net > 0 and validation_win_rate > 50"
    return v.filter(gates).select("candidate_id", *KEYS, "total_n", "mean_year_avg", "validation_n", "validation_avg_net", "validation_median_net", "validation_win_rate")


def a5_exact_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and quartiles of prices, which take nearly as many values as there are rows, by flag and status."""
    q = exact_quantiles(load(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice") * (1 - F.col("l_discount"))), ["l_returnflag", "l_linestatus"], "price", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return q.select("l_returnflag", "l_linestatus", *[R(F.col(c)).alias(c) for c in ("q25", "median", "q75")])


_MET = {"n": "count(*)", "avg_net": "round(sum(net), 9) / count(*)", "median_net": "median(net)", "win_rate": "avg((net > 0)::INT) * 100", "worst": "min(net)", "best": "max(net)", "avg_win": "round(sum(net) FILTER (net > 0), 9) / count(*) FILTER (net > 0)", "avg_loss": "round(sum(net) FILTER (net < 0), 9) / count(*) FILTER (net < 0)"}
_METRICS = ", ".join(f"{v} AS {k}" if k == "n" else f"round({v}, 6) + 0.0 AS {k}" if k in ROUNDED else f"{v} + 0.0 AS {k}" for k, v in _MET.items())
_K = ", ".join(KEYS)
_LEDGER = f"""panel AS (SELECT year(CAST(l_shipdate AS DATE)) AS yr, l_returnflag AS a_symbol, l_linestatus AS b_symbol, l_linenumber AS decision_minute, * FROM lineitem WHERE l_shipdate IS NOT NULL),
rules(mag_rule, lo, hi) AS (VALUES {', '.join(f"('{b}', {lo}::DOUBLE, {'NULL' if hi is None else hi}::DOUBLE)" for b, lo, hi in BANDS)}),
divs AS ({' UNION ALL '.join(f"SELECT yr, a_symbol, b_symbol, decision_minute, l_quantity, '{s}' AS signal_name, CAST({e} AS DOUBLE) AS div FROM panel" for s, e in SIGNALS.items())}),
both_of AS ({' UNION ALL '.join(f"SELECT *, '{x}' AS exit_name, CAST({e} AS DOUBLE) AS spread FROM divs" for x, e in EXITS.items())}),
events AS (SELECT {_K}, yr, style * sign(div) * spread - 0.10::DOUBLE AS net FROM both_of CROSS JOIN (VALUES (1), (-1)) s(style) JOIN rules ON abs(div) >= lo AND (hi IS NULL OR abs(div) < hi) WHERE div IS NOT NULL AND spread IS NOT NULL),
cut AS (SELECT min(yr) + {DISCOVERY_YEARS} AS cut FROM panel),
years AS (SELECT {_K}, yr, {_METRICS} FROM events GROUP BY {_K}, yr)"""
_FOUND = f"""found AS (SELECT {_K}, count(*) AS years, count(*) FILTER (avg_net > 0) AS positive_years, sum(n)::BIGINT AS total_n, min(n) AS min_year_n, min(avg_net) AS worst_year_avg, round(avg(avg_net), 6) AS mean_year_avg,
  min(median_net) AS worst_year_median, min(win_rate) AS worst_year_win, min(worst) AS worst_trade, max(best) AS best_trade, md5(concat_ws('|', {_K})) AS candidate_id FROM years, cut WHERE yr < cut GROUP BY {_K}
  HAVING count(*) = {DISCOVERY_YEARS} AND count(*) FILTER (avg_net > 0) >= 4 AND min(n) >= 15 AND round(avg(avg_net), 6) > 0 AND min(avg_net) > -0.10)"""
_VALID = f"""later AS (SELECT candidate_id, yr, net FROM events JOIN found USING ({_K}), cut WHERE yr >= cut),
whole AS (SELECT candidate_id, {_METRICS} FROM later GROUP BY 1), by_year AS (SELECT candidate_id, yr, {_METRICS} FROM later GROUP BY 1, 2),
spread_of AS (SELECT candidate_id, count(*) AS validation_years, count(*) FILTER (avg_net > 0) AS validation_positive_years, min(n) AS validation_min_year_n, min(avg_net) AS validation_worst_year_avg, min(median_net) AS validation_worst_year_median,
  min(win_rate) AS validation_worst_year_win FROM by_year GROUP BY 1),
validated AS (SELECT f.*, {', '.join(f'w.{k} AS validation_{k}' for k in _MET)}, s.* EXCLUDE (candidate_id) FROM found f JOIN whole w USING (candidate_id) JOIN spread_of s USING (candidate_id))"""
_SQL = {
    "q8_pair_ledger": f"WITH {_LEDGER} SELECT * FROM years",
    "q9_discovery_summary": f"WITH {_LEDGER}, {_FOUND} SELECT * FROM found",
    "q9_validation_summary": f"WITH {_LEDGER}, {_FOUND}, {_VALID} SELECT * FROM validated",
    "q9_freeze": f"""WITH {_LEDGER}, {_FOUND}, {_VALID} SELECT candidate_id, {_K}, total_n, mean_year_avg, validation_n, validation_avg_net, validation_median_net, validation_win_rate FROM validated
WHERE validation_years >= 2 AND validation_positive_years = validation_years AND validation_min_year_n >= 5 AND validation_avg_net > 0 AND validation_median_net > 0 AND validation_win_rate > 50""",
    "a5_exact_medians": "SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice * (1 - l_discount), 0.25), 6) AS q25, round(quantile_cont(l_extendedprice * (1 - l_discount), 0.5), 6) AS median, round(quantile_cont(l_extendedprice * (1 - l_discount), 0.75), 6) AS q75 FROM lineitem GROUP BY 1, 2",
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
