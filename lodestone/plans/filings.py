"""Facts landed as JSON, known at a cut-off, and the scores made of them, with their DuckDB SQL.

Stand-in: a customer is a company, each of its orders a filed fact; the payload is written as JSON and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facts import FACT, facts_from_json, fundamentals, risk_flags
from ..operators.scores import CORE_WEIGHTS, DAMAGE_CAPS, RATIO_POINTS, final_score, resilience
from ..session import load
from .market import R

#: What the eighths of the orders stand for: concept, days of the period (None: an instant), factor and offset of the value.
ROLES = (
    ("Assets", None, 1.0, 0.0), ("CashAndCashEquivalentsAtCarryingValue", None, 0.2, 0.0), ("Liabilities", None, 0.9, 0.0), ("StockholdersEquity", None, 0.5, -60000.0),
    ("Revenues", 90, 1.0, 0.0), ("NetIncomeLoss", 91, 0.2, -30000.0), ("NetCashProvidedByUsedInOperatingActivities", 364, 0.3, -60000.0), ("WeightedAverageNumberOfDilutedSharesOutstanding", 92, 0.01, 500.0),
)
FORMS = {"1-URGENT": "10-K", "2-HIGH": "10-Q", "3-MEDIUM": "10-Q/A", "4-NOT SPECIFIED": "20-F", "5-LOW": "8-K"}
CUTOFF = "2001-01-01"


def landed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, payload): one JSON document per company."""
    o = load(spark, sf_dir, "orders").withColumn("role", F.col("o_orderkey") % 8).withColumn("day", F.col("o_orderdate").cast("date"))
    pick = lambda i: F.coalesce(*[F.when(F.col("role") == k, F.lit(r[i])) for k, r in enumerate(ROLES)])
    form = F.coalesce(*[F.when(F.col("o_orderpriority") == k, v) for k, v in FORMS.items()], F.lit("8-K"))
    fact = F.struct(
        (F.col("o_totalprice") * pick(2) + pick(3)).alias("val"), F.date_sub("day", pick(1).cast("int")).cast("string").alias("start"), F.col("day").cast("string").alias("end"),
        F.date_add("day", 30).cast("string").alias("filed"), form.alias("form"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("accn"),
    ).cast(FACT)
    by_concept = o.groupBy("o_custkey", pick(0).alias("concept")).agg(F.collect_list(fact).alias("facts"))
    body = F.struct(F.create_map(F.lit("USD"), F.col("facts")).alias("units"))
    company = by_concept.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("concept", body))).alias("concepts"))
    return company.select(F.col("o_custkey").alias("symbol"), F.to_json(F.struct(F.create_map(F.lit("us-gaap"), F.col("concepts")).alias("facts"))).alias("payload"))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fundamentals(facts_from_json(landed_facts(spark, sf_dir)), F.lit(CUTOFF).cast("date"))


OUT = ("assets", "cash", "liabilities", "equity", "revenue", "net_income", "revenue_yoy", "net_margin", "net_margin_yoy_delta", "net_income_change_symmetric", "diluted_shares_yoy", "cash_to_assets", "liabilities_to_assets", "equity_to_assets", "free_cash_flow", "cash_runway_months")


def q36_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time measures and ratios per company, with coverage, age and risk flags."""
    x = _known(spark, sf_dir)
    return x.select("symbol", *[R(F.col(c)).alias(c) for c in OUT], "period_kind", "available_from", "report_period_end", F.col("metric_coverage_count").cast("long").alias("metric_coverage_count"), F.col("age_days").cast("long").alias("age_days"), F.array_join(risk_flags(), ",").alias("flags"))


_PICK = lambda i: "CASE o_orderkey % 8 " + " ".join(f"WHEN {k} THEN {'NULL' if r[i] is None else repr(r[i])}" for k, r in enumerate(ROLES)) + " END"
_NAME = ("assets", "cash", "liabilities", "equity", "revenue", "net_income", "operating_cash_flow", "diluted_shares")
_FORM = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORMS.items()) + " ELSE '8-K' END"
FACTS = f"""facts AS (SELECT o_custkey AS symbol, CASE o_orderkey % 8 {' '.join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(_NAME))} END AS name, o_totalprice * ({_PICK(2)})::DOUBLE + ({_PICK(3)})::DOUBLE AS val,
  ({_PICK(1)})::INT AS days, CAST(o_orderdate AS DATE) AS fin, CAST(o_orderdate AS DATE) + 30 AS filed, lpad(o_orderkey::VARCHAR, 12, '0') AS accn, {_FORM} AS form FROM orders),
known AS (SELECT *, CASE WHEN days BETWEEN 65 AND 125 THEN 'quarter' WHEN days BETWEEN 250 AND 410 THEN 'annual' WHEN days > 125 AND days < 250 THEN 'interim' ELSE 'other' END AS kind FROM facts WHERE form <> '8-K' AND filed < DATE '{CUTOFF}'),
stand AS (SELECT symbol, name, val, fin, filed, NULL::VARCHAR AS kind, NULL::DOUBLE AS prior FROM known WHERE days IS NULL QUALIFY row_number() OVER (PARTITION BY symbol, name ORDER BY fin DESC, filed DESC, accn DESC) = 1),
near AS (SELECT * FROM (SELECT *, max(fin) OVER (PARTITION BY symbol, name) AS last FROM known WHERE days IS NOT NULL) WHERE last - fin <= 10),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY symbol, name ORDER BY CASE kind WHEN 'quarter' THEN 4 WHEN 'annual' THEN 3 WHEN 'interim' THEN 2 ELSE 1 END DESC, filed DESC, abs(days - CASE WHEN kind = 'quarter' THEN 90 ELSE 365 END), fin DESC, accn DESC) = 1),
prior AS (SELECT k.symbol, k.name, k.val AS prior FROM known k JOIN best b USING (symbol, name) WHERE b.fin - k.fin BETWEEN 330 AND 400 AND abs(k.days - b.days) <= 25 QUALIFY row_number() OVER (PARTITION BY k.symbol, k.name ORDER BY k.fin DESC, k.filed DESC, k.accn DESC) = 1),
latest AS (SELECT * FROM stand UNION ALL SELECT symbol, name, val, fin, filed, kind, prior.prior FROM best LEFT JOIN prior USING (symbol, name)),
w AS (SELECT symbol, {', '.join(f"max(val) FILTER (WHERE name = '{n}') AS {n}" for n in _NAME)}, {', '.join(f"max(prior) FILTER (WHERE name = '{n}') AS prior_{n}" for n in ('revenue', 'net_income', 'diluted_shares'))},
  coalesce(max(kind) FILTER (WHERE name = 'revenue'), max(kind) FILTER (WHERE name = 'net_income'), 'unknown') AS period_kind, max(filed) AS available_from, max(fin) AS report_period_end FROM latest GROUP BY symbol),
m AS (SELECT *, (revenue - prior_revenue) / nullif(abs(prior_revenue), 0) AS revenue_yoy, net_income / nullif(revenue, 0) AS net_margin, net_income / nullif(revenue, 0) - prior_net_income / nullif(prior_revenue, 0) AS net_margin_yoy_delta,
  2 * (net_income - prior_net_income) / nullif(abs(net_income) + abs(prior_net_income), 0) AS net_income_change_symmetric, (diluted_shares - prior_diluted_shares) / nullif(abs(prior_diluted_shares), 0) AS diluted_shares_yoy,
  cash / nullif(assets, 0) AS cash_to_assets, liabilities / nullif(assets, 0) AS liabilities_to_assets, equity / nullif(assets, 0) AS equity_to_assets, operating_cash_flow AS free_cash_flow,
  CASE WHEN operating_cash_flow < 0 THEN cash / -operating_cash_flow * CASE period_kind WHEN 'quarter' THEN 3 WHEN 'annual' THEN 12 ELSE 6 END END AS cash_runway_months FROM w),
fund AS (SELECT *, {' + '.join(f'({c} IS NOT NULL)::INT' for c in ('revenue_yoy', 'net_margin', 'net_margin_yoy_delta', 'net_income_change_symmetric', 'diluted_shares_yoy', 'cash_to_assets', 'liabilities_to_assets', 'equity_to_assets', 'free_cash_flow', 'cash_runway_months', 'operating_cash_flow', 'cash', 'assets', 'liabilities', 'equity', 'revenue'))} AS covered, DATE '{CUTOFF}' - available_from AS age_days FROM m)"""
Q36 = f"""WITH {FACTS} SELECT symbol, {', '.join(f'round({c}, 6) AS {c}' for c in OUT)}, period_kind, available_from, report_period_end, covered::BIGINT AS metric_coverage_count, age_days::BIGINT AS age_days,
 concat_ws(',', CASE WHEN diluted_shares_yoy >= 0.2 THEN 'dilution' END, CASE WHEN cash_to_assets <= 0.01 AND liabilities_to_assets >= 1 AND equity_to_assets <= 0 THEN 'solvency' END) AS flags FROM fund WHERE covered >= 3"""


def _inputs(c: Column) -> dict[str, Column]:
    """What the other layers would give, drawn from the key: whole numbers, so that both engines agree."""
    return {"setup": (c % 101).cast("double"), "confirmation": (c * 7 % 101).cast("double"), "catalyst": (c * 13 % 101).cast("double"), "confidence": (c * 29 % 101).cast("double"), "damage": (c * 17 % 101).cast("double"), "cause_verified": c % 3 > 0, "hard_veto": c % 19 == 0}


def q29_final_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resilience from the facts of every customer (those without any get the neutral one), and the final score and verdict."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("symbol"))
    x = resilience(c.join(_known(spark, sf_dir), "symbol", "left")).withColumns(_inputs(F.col("symbol")))
    return final_score(x).select("symbol", "resilience", "resilience_confidence", "damage_cap", "final_score", "verdict")


_POINTS = " + ".join("CASE WHEN " + n + " IS NULL THEN 0 " + " ".join(f"WHEN {n} {s} {b} THEN {p}" for s, b, p in table) + " ELSE 0 END" for n, table in RATIO_POINTS.items())
_CORE = " + ".join(f"{w} * {k}" for k, w in CORE_WEIGHTS.items())
_CAP = "CASE " + " ".join(f"WHEN damage <= {most} THEN {cap}" for most, cap in DAMAGE_CAPS) + " END"
Q29F = f"""WITH {FACTS}, c AS (SELECT c_custkey AS symbol, fund.* EXCLUDE (symbol) FROM customer LEFT JOIN (SELECT * FROM fund WHERE covered >= 3) fund ON fund.symbol = c_custkey),
r AS (SELECT *, 50 + {_POINTS} AS total FROM c), s AS (SELECT symbol, round(round(least(100.0, greatest(0.0, CASE WHEN covered IS NULL THEN 45 WHEN age_days > 180 THEN 45 + (total - 45) * 0.65 ELSE total END))::DOUBLE, 9), 1) AS resilience,
  round(least(100.0, greatest(0.0, CASE WHEN covered IS NULL THEN 35 ELSE least(100, 45 + least(covered, 10) * 4) - CASE WHEN age_days > 180 THEN 12 ELSE 0 END END))::DOUBLE, 1) AS resilience_confidence,
  (symbol % 101)::DOUBLE AS setup, (symbol * 7 % 101)::DOUBLE AS confirmation, (symbol * 13 % 101)::DOUBLE AS catalyst, (symbol * 29 % 101)::DOUBLE AS confidence, (symbol * 17 % 101)::DOUBLE AS damage, symbol % 3 > 0 AS cause_verified, symbol % 19 = 0 AS hard_veto FROM r),
f AS (SELECT *, ({_CAP})::DOUBLE AS damage_cap, least(100.0, greatest(0.0, 50 + (({_CORE}) - 50) * confidence / 100 - least(15.0, greatest(0.0, damage - 25) * 0.2)))::DOUBLE AS pre FROM s),
g AS (SELECT *, round(round(least(pre, CASE WHEN hard_veto THEN 20.0 WHEN NOT cause_verified THEN least(damage_cap, 60.0) ELSE damage_cap END), 9), 1) AS final_score FROM f)
SELECT symbol, resilience, resilience_confidence, damage_cap, final_score, CASE WHEN hard_veto OR final_score < 55 THEN 'PASS' WHEN final_score >= 75 AND cause_verified THEN 'INVESTIGATE' ELSE 'WATCH' END AS verdict FROM g"""

QUERIES = {"q36_fundamentals": q36_fundamentals, "q29_final_scores": q29_final_scores}
ORACLES = {"q36_fundamentals": Q36, "q29_final_scores": Q29F}
