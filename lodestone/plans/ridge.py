"""Nested cross-sectional ridge: 26 ranked features, linear and quadratic maps, five penalties, books, gates and freeze.

Line items by supplier and month stand in for the minute bars of a symbol's session: unit prices in order of shipping. The first half of the
sessions trains (A), the next quarter selects (B), the last one confirms after refitting on A and B (C).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import benjamini_hochberg, trade_metrics
from ..operators.inference import block_bootstrap
from ..operators.ranks import normalised_ranks
from ..operators.ridge import Ridge, moments, predict, solve
from ..operators.session_features import FEATURES, MINUTES, session_features
from ..session import load, written

#: Registered penalties, book sizes, costs and bootstrap (fixed values).
PENALTIES = (0.0001, 0.001, 0.01, 0.1, 1.0)
SIZES = (1, 2)
COST, STRESS = 0.0010, 0.0020
BOOTSTRAP = {"block": 5, "replications": 20_000, "seed": 20260813}
#: Names that a date needs (the campaign's 200, scaled to the stand-in), and the least price of an entry.
LEAST_NAMES, LEAST_PRICE = 20, 5.0
RANKS = [f"{f}_rank" for f in FEATURES]
KEYS = ["map", "penalty", "construction", "top_n"]


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = load(spark, sf_dir, "lineitem").filter("l_shipdate is not null and l_quantity > 0")
    at = F.struct(F.col("l_shipdate").alias("t"), "l_orderkey", "l_linenumber")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    b = line.select(F.col("l_suppkey").alias("symbol"), F.trunc("l_shipdate", "month").alias("day"), at.alias("at"), *[price.alias(c) for c in ("open", "high", "low", "close")], F.col("l_quantity").alias("volume"), F.lit(1).alias("trades"))
    cell = Window.partitionBy("symbol", "day")
    return b.withColumn("minute", F.floor((F.row_number().over(cell.orderBy("at")) - 1) * MINUTES / F.count(F.lit(1)).over(cell)).cast("int"))


def ranked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, day, n, 26 ranks, next_open, raw (the next session's return) and target (raw less its mean over complete names)."""
    f = session_features(_bars(spark, sf_dir))
    by = Window.partitionBy("symbol").orderBy("day")
    f = f.withColumn("next_day", F.lead("day").over(by)).withColumn("adjacent", F.col("next_day") == F.add_months("day", 1))
    f = f.withColumn("next_open", F.when(F.col("adjacent"), F.lead("open_price").over(by))).withColumn("next_close", F.when(F.col("adjacent"), F.lead("close_price").over(by)))
    f = f.dropna(subset=list(FEATURES))
    r = normalised_ranks(f, ["day"], "symbol", list(FEATURES)).filter(f"n >= {LEAST_NAMES}").withColumn("raw", F.col("next_close") / F.col("next_open") - 1)
    return r.select("symbol", "day", "n", *RANKS, "next_open", "raw", (F.col("raw") - F.avg("raw").over(Window.partitionBy("day"))).alias("target"))


def q21_ranked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's inputs and target."""
    r = ranked_features(spark, sf_dir)
    return r.select("symbol", "day", "n", *[F.round(c, 9).alias(c) for c in RANKS], F.round("raw", 6).alias("raw"), (F.round("target", 6) + 0.0).alias("target"))


def books(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Daily gross return of every definition; predictions: symbol, day, model, prediction; outcomes: symbol, day, next_open, raw.

    Names without an entry are skipped; a day on which a chosen name has no return is incomplete and has a null return.
    """
    x = predictions.join(outcomes, ["symbol", "day"]).filter(F.col("next_open") >= LEAST_PRICE)
    w = Window.partitionBy("model", "day")
    x = x.withColumn("top", F.row_number().over(w.orderBy(F.col("prediction").desc(), "symbol"))).withColumn("bottom", F.row_number().over(w.orderBy("prediction", "symbol")))
    x = x.filter(f"top <= {max(SIZES)} or bottom <= {max(SIZES)}").withColumn("top_n", F.explode(F.array(*map(F.lit, SIZES))))

    def side(c: str) -> F.Column:
        chosen = F.col(c) <= F.col("top_n")
        return F.when(F.count(F.when(chosen, F.col("raw"))) == F.col("top_n"), F.round(F.avg(F.when(chosen, F.col("raw"))), 9))

    d = x.groupBy("model", "day", "top_n").agg(side("top").alias("long"), side("bottom").alias("short"))
    kinds = F.array(*[F.struct(F.lit(n).alias("construction"), e.alias("gross")) for n, e in (("LONG_TOP", F.col("long")), ("SHORT_BOTTOM", -F.col("short")), ("TOP_MINUS_BOTTOM", 0.5 * (F.col("long") - F.col("short"))))])
    return d.select("model", "day", "top_n", F.explode(kinds).alias("k")).select("model", "day", "top_n", "k.construction", "k.gross")


def _metrics(daily: DataFrame, models: list[Ridge], stage: str) -> DataFrame:
    """Statistics of each definition after cost, with the bootstrap's interval and q over all definitions of the stage."""
    names = F.array(*[F.struct(F.lit(m.name).alias("map"), F.lit(m.penalty).alias("penalty")) for m in models]) if models else F.array().cast("array<struct<map: string, penalty: double>>")
    d = daily.withColumn("m", F.get(names, F.col("model"))).select("m.map", "m.penalty", "construction", "top_n", "day", (F.col("gross") - COST).alias("net"))
    d = written(d.filter("net is not null"), f"books-{stage}")
    m = trade_metrics(F.col("net"))
    out = d.groupBy(*KEYS).agg(*[m[c].alias(c) for c in ("trades", "avg_net", "median_net", "win_rate", "profit_factor", "t_stat")]).withColumn("stress_net", F.col("avg_net") - (STRESS - COST))
    boot = block_bootstrap(d, KEYS, "day", "net", **BOOTSTRAP)
    return benjamini_hochberg(out.join(boot, KEYS).withColumn("stage", F.lit(stage)), "p", ["stage"])


#: Gates of selection and confirmation (fixed values, but for the number of trades: the share of the sessions that have to be complete).
GATE_B = "trades >= 0.9 * sessions and avg_net >= 0.0010 and median_net > 0 and win_rate > 0.52 and profit_factor >= 1.30 and t_stat >= 2.50 and stress_net > 0 and low > 0 and q <= 0.05"
GATE_C = "trades >= 0.87 * sessions and avg_net > 0 and median_net > 0 and win_rate > 0.50 and profit_factor > 1.10 and stress_net > 0 and low > 0"


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame]]:
    """All rows, and those of A, B and C, by the order of the dates at hand."""
    x = written(ranked_features(spark, sf_dir), "ranked-features")
    days = [r[0] for r in x.select("day").distinct().orderBy("day").collect()]  # one row a session
    cut = [days[: len(days) // 2], days[len(days) // 2 : len(days) * 3 // 4], days[len(days) * 3 // 4 :]]
    return x, [x.filter(F.col("day").isin(c)) for c in cut]


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 60 definitions in B, fitted on A, and in C, fitted on A and B: statistics, gates, and the place in the freeze."""
    x, (a, b, c) = _staged(spark, sf_dir)
    outcomes = x.select("symbol", "day", "next_open", "raw")
    moment = moments(a, RANKS, "target")
    found = []
    for stage, rows, gate in (("B", b, GATE_B), ("C", c, GATE_C)):
        models = solve(moment, len(RANKS), PENALTIES)
        days = rows.filter("raw is not null").select("day").distinct().count()
        m = _metrics(books(predict(rows, RANKS, ["symbol", "day"], models), outcomes), models, stage).withColumn("sessions", F.lit(days))
        found.append(m.withColumn("passed", F.coalesce(F.expr(gate), F.lit(False))))
        moment = moment + moments(b, RANKS, "target")
    b_of, c_of = (m.select(*KEYS, *[F.col(k).alias(f"{m_}_{k}") for k in ("trades", "avg_net", "median_net", "win_rate", "profit_factor", "t_stat", "stress_net", "low", "high", "p", "q", "passed")]) for m, m_ in zip(found, "bc", strict=True))
    both = b_of.join(c_of, KEYS)
    survives, worse = F.col("b_passed") & F.col("c_passed"), F.least("b_stress_net", "c_stress_net")
    directional = F.col("construction") != "TOP_MINUS_BOTTOM"
    # The best survivor of either kind is frozen: one neutral, one directional.
    place = F.row_number().over(Window.partitionBy(survives, directional).orderBy(worse.desc(), F.col("c_median_net").desc(), *KEYS))
    return both.withColumn("frozen", survives & (place == 1))


def q21_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered definitions with their statistics in both stages, and whether they are frozen."""
    d = definitions(spark, sf_dir)
    return d.select(*KEYS, *[F.round(c, 6).alias(c) if dict(d.dtypes)[c] == "double" else c for c in d.columns if c not in KEYS])


def q21_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of all ten models for B, fitted on A."""
    _, (a, b, _) = _staged(spark, sf_dir)
    models = solve(moments(a, RANKS, "target"), len(RANKS), PENALTIES)
    p = predict(b, RANKS, ["symbol", "day"], models)
    return p.select("symbol", "day", "model", F.round("prediction", 6).alias("prediction"))


_B = f"""bars AS (SELECT l_suppkey AS symbol, date_trunc('month', l_shipdate)::DATE AS day, row_number() OVER w AS k, ((row_number() OVER w - 1) * {MINUTES} // count(*) OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate)))::INT AS minute,
  l_extendedprice / l_quantity AS p, l_quantity AS volume FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity > 0 WINDOW w AS (PARTITION BY l_suppkey, date_trunc('month', l_shipdate) ORDER BY l_shipdate, l_orderkey, l_linenumber)),
moves AS (SELECT *, ln(p / lag(p) OVER (PARTITION BY symbol, day ORDER BY k)) AS r FROM bars WHERE p > 0), lagged AS (SELECT *, lag(r) OVER (PARTITION BY symbol, day ORDER BY k) AS before FROM moves),
agg AS (SELECT symbol, day, arg_min(p, k) AS o, arg_max(p, k) AS c, max(p) AS top, min(p) AS bottom, sum(p * volume) / nullif(sum(volume), 0) AS average, stddev_samp(r) AS rv_1m,
  {', '.join(f'arg_max(p, k) FILTER (minute < {x}) AS u{x}' for x in (30, 60, 120, 270, 330, 360))}, max(p) FILTER (minute < 60) - min(p) FILTER (minute < 60) AS er, max(p) FILTER (minute >= 330) - min(p) FILTER (minute >= 330) AS lr,
  coalesce(sum(volume) FILTER (minute < 60), 0) / sum(volume) AS first60_volume_share, coalesce(sum(volume) FILTER (minute >= 330), 0) / sum(volume) AS last60_volume_share, count(*) FILTER (minute < 60) / count(*) AS first60_trade_share,
  count(*) FILTER (minute >= 330) / count(*) AS last60_trade_share, avg((r > 0)::INT) AS pos_minute_fraction, max(r) AS max_minute_ret, min(r) AS min_minute_ret, sum(abs(r)) AS minute_ret_abs_sum, corr(r, before) AS minute_ret_lag1_corr,
  arg_min(minute, {{'a': -p, 'k': k}}) / {MINUTES - 1} AS high_time_fraction, arg_min(minute, {{'a': p, 'k': k}}) / {MINUTES - 1} AS low_time_fraction FROM lagged GROUP BY symbol, day),
feats AS (SELECT *, c / o - 1 AS ret_oc, (top - bottom) / o AS range_pct, (c - bottom) / nullif(top - bottom, 0) AS close_location, c / nullif(average, 0) - 1 AS close_vs_vwap, u30 / o - 1 AS first30_ret, u60 / o - 1 AS first60_ret,
  u270 / u120 - 1 AS midday_ret, c / u330 - 1 AS last60_ret, c / u360 - 1 AS last30_ret, er / o AS first60_range, lr / o AS last60_range, abs(ln(c / o)) / nullif(minute_ret_abs_sum, 0) AS efficiency_ratio, top / o - 1 AS max_runup_from_open, bottom / o - 1 AS max_drawdown_from_open FROM agg),
nexts AS (SELECT *, CASE WHEN lead(day) OVER w = (day + INTERVAL 1 MONTH)::DATE THEN lead(o) OVER w END AS next_open, CASE WHEN lead(day) OVER w = (day + INTERVAL 1 MONTH)::DATE THEN lead(c) OVER w END AS next_close FROM feats WINDOW w AS (PARTITION BY symbol ORDER BY day)),
complete AS (SELECT * FROM nexts WHERE {' AND '.join(f'{f} IS NOT NULL AND NOT isnan({f}::DOUBLE)' for f in FEATURES)}),
counted AS (SELECT *, count(*) OVER (PARTITION BY day) AS n, next_close / next_open - 1 AS raw FROM complete)"""
_R = ", ".join(f"round((row_number() OVER (PARTITION BY day ORDER BY round({f}, 9), symbol) - 1)::DOUBLE / nullif(n - 1, 0), 9) AS {f}_rank" for f in FEATURES)
_SQL = {"q21_ranked_features": f"WITH {_B} SELECT symbol, day, n, {_R}, round(raw, 6) AS raw, round(raw - avg(raw) OVER (PARTITION BY day), 6) + 0.0 AS target FROM counted WHERE n >= {LEAST_NAMES}"}
QUERIES = {name: globals()[name] for name in ("q21_ranked_features", "q21_ridge", "q21_predictions")}
ORACLES = _SQL
