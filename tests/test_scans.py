"""Scanner rules, scores, filed facts and intraday features by vectors and plain Python; prices of zero in every query on prices."""

import datetime as dt
import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions.arrays import deviation, mean, middle, steps, tail, with_robust_deviation
from lodestone.functions.timeutil import capture_due, complete_date, price_session, scan_due
from lodestone.operators.facts import facts_from_json, fundamentals, risk_flags
from lodestone.operators.intraday import best_hypothesis, reliability_policy, session_arrays
from lodestone.operators.scan import drop_candidates, listed_companies, pools, prefilter, priority, session_context, two_stage
from lodestone.operators.scores import final_score, resilience
from lodestone.operators.technicals import technical_features
from lodestone.plans import registry
from lodestone.plans.lookups import latest_covered, load_estimate, project

T, D = dt.datetime, dt.date
SF = "/root/testdata/sf0.001"
PRICED = (
    "q13_composite_ranks", "q13_daily_baskets", "q13_scope_metrics", "q22_gates", "q20_tail_states", "q12_spread_books", "q19_basket_family", "q14_freeze", "q18_rank_regimes", "q17_network_forecast", "q39_horizon_outcome",
    "q40_three_session_path", "q46_hypotheses", "q46_bar_features", "q49_path_outcome", "q28_technical_features", "q46_session_features", "q48_intraday_scan", "f5_drop_candidates", "f6_session_context", "q56_adjusted_audit", "q6_signal_candidates", "q7_basket_eligibility",
)


@pytest.fixture(scope="module")
def zero_prices(spark, tmp_path_factory):
    """The smallest tables with every seventh tick, and all of one user, at a price of zero."""
    folder = tmp_path_factory.mktemp("zeros")
    c = duckdb.connect()
    for t in ("documents", "labels", "lineitem", "orders", "customer", "nation"):
        c.sql(f"copy (from '{SF}/{t}.parquet') to '{folder}/{t}.parquet'")
    c.sql(f"copy (select * replace (case when event_id % 7 = 0 or user_id = 3 then 0.0 else value end as value) from '{SF}/events.parquet') to '{folder}/events.parquet'")
    for t in ("documents", "labels", "lineitem", "orders", "customer", "nation", "events"):
        c.sql(f"create view {t} as from '{folder}/{t}.parquet'")
    return str(folder), c


def plain(v):
    return "None" if v is None or v != v else f"{v:.7g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", PRICED)
def test_prices_of_zero(spark, zero_prices, name):
    folder, c = zero_prices
    df = registry.QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted([plain(v) for v in r] for r in df.select(*cols).collect())
    assert got == sorted([plain(v) for v in r] for r in c.sql(registry.ORACLES[name]).select(", ".join(cols)).fetchall())


def test_calendar_rules(spark):
    at = [T(2026, 1, 6, 1, 14, 59), T(2026, 1, 6, 1, 15), T(2026, 1, 5, 22, 45), T(2026, 1, 5, 23, 5), T(2026, 1, 5, 23, 5, 1), T(2026, 1, 3, 23, 0), T(2026, 1, 5, 23, 30), T(2026, 7, 6, 22, 30)]
    df = spark.createDataFrame([(x, None if i != 6 else D(2026, 1, 5)) for i, x in enumerate(at)], "ts timestamp_ntz, last date")
    ts, last = F.col("ts"), F.col("last")
    r = df.select(complete_date(ts), scan_due(ts, last), capture_due(ts, last), capture_due(ts, F.lit(None).cast("date"))).collect()
    assert [x[0] for x in r[:2]] == [D(2026, 1, 4), D(2026, 1, 5)]
    assert [x[1] for x in r[2:6]] == [True, True, False, False] and not r[7][1]
    assert (r[6][2], r[6][3]) == (False, True)
    sessions = spark.createDataFrame([(T(2026, 1, 5, 14, 29),), (T(2026, 1, 5, 14, 30),), (T(2026, 1, 5, 21, 0),), (T(2026, 1, 6, 1, 0),), (T(2026, 1, 4, 15, 0),), (None,)], "ts timestamp_ntz").select(price_session(ts)).collect()
    assert [x[0] for x in sessions] == ["pre_market", "regular", "after_hours", "closed", "closed", "unknown"]


def test_listed_companies(spark):
    rows = [("AAPL", "Apple Inc", "NASDAQ", "us_equity", True), ("BRK.B", None, "NYSE", "US_EQUITY", True), ("X Y", "n", "NYSE", "us_equity", True), ("OLD", "n", "OTC Markets", "us_equity", True), ("ETF", "Some ETF", "NYSE", "us_equity", True),
            ("ABC", "United Things", "NYSE", "us_equity", True), ("NUL", "n", "NYSE", "us_equity", None), ("TOOLONGTICK", "n", "NYSE", "us_equity", True)]
    df = spark.createDataFrame(rows, "symbol string, name string, exchange string, asset_class string, tradable boolean")
    assert {r["symbol"] for r in listed_companies(df).collect()} == {"AAPL", "BRK.B", "ABC"}


def snapshot(spark, rows):
    names = "symbol string, day date, trade_price double, minute_close double, day_close double, prev_close double, prev_volume long, day_volume long, bid double, ask double, trade_ts timestamp_ntz, event_class string, risk_flags array<string>, headlines int"
    return spark.createDataFrame(rows, names)


def test_discovery(spark):
    at, evening = T(2026, 1, 5, 15, 0), T(2026, 1, 5, 22, 0)
    rows = [
        ("LIQ", D(2026, 1, 5), 80.0, None, 80.0, 100.0, 5_000_000, 10_000_000, 79.9, 80.1, at, "B", [], 3), ("ILL", D(2026, 1, 5), 5.0, None, 5.0, 20.0, 30_000, 30_000, 4.0, 6.0, at, "E", ["solvency", "dilution"], 1),
        ("EXT", D(2026, 1, 5), 0.0, 80.0, 99.0, 100.0, None, 5, None, None, evening, "U", [], 0), ("FLAT", D(2026, 1, 5), 99.0, None, 99.0, 100.0, 10**6, 1, 98.0, 99.0, at, "U", [], 0), ("CHEAP", D(2026, 1, 5), 0.5, None, 0.5, 5.0, 10**6, 1, 0.4, 0.5, at, "U", [], 0),
        ("THIN", D(2026, 1, 5), 50.0, None, 50.0, 100.0, 10, 1, 49.0, 50.0, at, "U", [], 0),
    ]
    c = session_context(drop_candidates(snapshot(spark, rows), 15.0, 1.0, 500_000.0), 15.0)
    x = {r["symbol"]: r for r in two_stage(c, "day", 25, prefilter(), priority(F.col("points"))).collect()}
    assert set(x) == {"LIQ", "ILL", "EXT"} and x["LIQ"]["place"] == 1 and x["ILL"]["place"] == 3
    assert x["EXT"]["extended_hours_only"] and x["EXT"]["last_price"] == 80.0 and x["EXT"]["price_session"] == "after_hours" and not x["LIQ"]["extended_hours_only"]
    liq = min(45, np.log10(5_000_000 * 100 / 100_000) * 12) + 25 + min(18, (20 - 12) * 0.65) + min(12, 2 * 4)
    assert abs(x["LIQ"]["points"] - liq) < 1e-5 and abs(x["LIQ"]["priority"] - round(liq + 32 + 4.5, 2)) < 0.011
    assert abs(x["EXT"]["points"] - (0 + 0 + 5.2 + 0 - 10)) < 1e-5
    assert (pools(5), pools(40), pools(500)) == ((100, 100), (240, 100), (300, 150))


def test_facts_at_a_cutoff(spark):
    fact = lambda val, end, filed, start=None, form="10-Q", accn="a": {"val": val, "end": end, "filed": filed, "form": form, "accn": accn, **({"start": start} if start else {})}
    q = lambda val, before: [fact(val, "2026-06-30", "2026-08-01", "2026-04-01"), fact(before, "2025-06-30", "2025-08-01", "2025-04-01")]
    concepts = {
        "Assets": [fact(100, "2026-06-30", "2026-08-01"), fact(900, "2026-06-30", "2026-08-20"), fact(50, "2026-03-31", "2026-05-01"), fact(7, "2026-06-30", "2026-08-02", form="8-K")],
        "CashAndCashEquivalentsAtCarryingValue": [fact(20, "2026-06-30", "2026-08-01")], "AssetsCurrent": [fact(40, "2026-06-30", "2026-08-01")], "LiabilitiesCurrent": [fact(20, "2026-06-30", "2026-08-01")],
        "LongTermDebt": [fact(10, "2026-06-30", "2026-08-01")], "Revenues": [*q(60, 50), fact(240, "2026-06-30", "2026-08-01", "2025-07-01", "10-K")], "NetIncomeLoss": q(6, 5),
        "NetCashProvidedByUsedInOperatingActivities": q(-3, -1), "WeightedAverageNumberOfDilutedSharesOutstanding": q(10, 9),
    }
    payload = {"facts": {"us-gaap": {k: {"units": {"USD": v}} for k, v in concepts.items()}, "ifrs-full": {"Assets": {"units": {"USD": [fact(5, "2026-06-30", "2026-08-01")]}}}}}
    landed = spark.createDataFrame([("A", json.dumps(payload)), ("B", "{}"), ("C", None), ("D", "not json")], "symbol string, payload string")
    rows = fundamentals(facts_from_json(landed), F.lit("2026-08-20").cast("date")).withColumn("flags", risk_flags()).collect()
    assert [r["symbol"] for r in rows] == ["A"]
    r = rows[0]
    want = {"assets": 100, "revenue_yoy": 0.2, "net_margin": 0.1, "current_ratio": 2.0, "debt_to_assets": 0.1, "cash_runway_months": 20, "diluted_shares_yoy": 1 / 9, "age_days": 19}
    assert all(abs(r[k] - v) < 1e-9 for k, v in want.items()) and r["period_kind"] == "quarter" and r["flags"] == []


def test_scores(spark):
    ratios = "cash_to_assets double, liabilities_to_assets double, equity_to_assets double, revenue_yoy double, net_margin double, net_margin_yoy_delta double, diluted_shares_yoy double, metric_coverage_count int, age_days int"
    rows = [(0.4, 0.4, 0.5, 0.2, 0.1, 0.06, -0.1, 12, 10), (0.01, 0.95, 0.01, -0.3, -0.3, -0.2, 0.6, 5, 200), (None,) * 9]
    got = [(r["resilience"], r["resilience_confidence"]) for r in resilience(spark.createDataFrame(rows, ratios)).collect()]
    total = 50 - 15 - 22 - 20 - 16 - 14 - 10 - 25
    assert got == [(100.0, 85.0), (max(0.0, round(45 + (total - 45) * 0.65, 1)), 53.0), (45.0, 35.0)]
    final = "setup double, catalyst double, resilience double, confirmation double, confidence double, damage double, cause_verified boolean, hard_veto boolean"
    rows = [(90.0, 90.0, 90.0, 90.0, 100.0, 10.0, True, False), (90.0, 90.0, 90.0, 90.0, 100.0, 10.0, False, False), (90.0, 90.0, 90.0, 90.0, 100.0, 60.0, True, False), (90.0, 90.0, 90.0, 90.0, 100.0, 10.0, True, True), (90.0, 90.0, 90.0, 90.0, 0.0, 90.0, True, False)]
    got = [(r["final_score"], r["verdict"]) for r in final_score(spark.createDataFrame(rows, final)).collect()]
    assert got == [(90.0, "INVESTIGATE"), (60.0, "WATCH"), (65.0, "WATCH"), (20.0, "PASS"), (20.0, "PASS")]


def test_technical_features(spark):
    rng = np.random.default_rng(4)
    close = 50 * np.exp(np.cumsum(rng.normal(0, 0.02, 90)))
    rows = [("A", T(2026, 1, 1) + dt.timedelta(days=i), float(c * 0.99), float(c * 1.02), float(c * 0.97), float(c), int(1000 + 10 * (i % 7)), float(c)) for i, c in enumerate(close)]
    rows += [("A", T(2026, 9, 1), 1.0, 1.0, 1.0, 0.0, 5, None)]
    df = technical_features(spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume long, vwap double"), "A", {"A": "none"})
    out = df.orderBy("ts").collect()
    assert len(df.columns) == 35 and len(out) == 90 and out[0]["current_return_pct"] is None and out[0]["history_count"] == 0
    r, before = out[-1], close[:-1]
    returns, moves = np.diff(before[-21:]) / before[-21:-1], np.diff(close[-15:])
    assert r["history_count"] == 80 and abs(r["sma20"] - before[-20:].mean()) < 1e-4 and abs(r["sma50"] - before[-50:].mean()) < 1e-4
    assert abs(r["vol20_pct"] - returns.std(ddof=1) * 100) < 1e-4 and abs(r["rsi14"] - (100 - 100 / (1 + np.maximum(moves, 0).mean() / np.maximum(-moves, 0).mean()))) < 0.01
    assert abs(r["recent_high_60d"] - before[-60:].max() * 1.02) < 1e-4 and r["market_relative_move_pct"] == 0.0 and r["sector_relative_move_pct"] is None
    assert r["feature_availability"]["sector_relative"] is False and r["feature_availability"]["history_50"] is True
    assert r["technical_history_completeness"] == round(sum(r["feature_availability"].values()) / 14 * 100, 1)


def test_array_statistics(spark):
    rng = np.random.default_rng(9)
    series = [[float(x) for x in rng.normal(size=n)] for n in (0, 1, 2, 3, 4, 25, 60)] + [[1.0] * 5 + [9.0], [0.0, 0.1, -0.1, 0.05, 50.0]]
    df = with_robust_deviation(spark.createDataFrame([(i, s) for i, s in enumerate(series)], "i int, a array<double>"), "a", "robust")
    for r in df.select("a", "robust", mean(F.col("a")), deviation(F.col("a")), middle(F.col("a")), steps(F.col("a")), tail(F.col("a"), 3)).collect():
        a = np.array(r[0])
        sd = a.std(ddof=1) if len(a) > 1 else 0.0
        m = np.median(a) if len(a) else None
        mad = 1.4826 * np.median(np.abs(a - m)) if len(a) else 0.0
        drawn = np.clip(a, m - 4 * mad, m + 4 * mad).std(ddof=1) if len(a) > 2 and mad > 0 else sd
        assert np.allclose([r[1], r[2], r[3]], [drawn, a.mean() if len(a) else 0.0, sd]) and (r[4] is None if m is None else abs(r[4] - m) < 1e-12)
        assert np.allclose(r[5], np.diff(a)) and r[6] == r[0][-3:]


def test_session_bars_are_cleaned(spark):
    bars = [(1, "A", T(2026, 1, 5, 15, m), h, lo, c, None, 10, n) for m, h, lo, c, n in [(0, 2.0, 1.0, 1.5, 1), (0, 9.0, 1.0, 1.5, 5), (1, 2.0, 0.0, 1.0, 1), (2, 1.0, 2.0, 1.5, 1), (4, 2.0, 1.0, 2.0, 1)]]
    r = session_arrays(spark.createDataFrame(bars, "scan int, symbol string, bar_ts timestamp_ntz, high double, low double, close double, vwap double, volume long, trades long"), 1).first()
    assert r["bars_used"] == 2 and r["high"] == [9.0, 2.0] and abs(r["gap_ratio"] - (1 - 2 / 5)) < 1e-12 and r["weighted"] == [15.0, 20.0]


def test_reliability_policy(spark):
    base = dict(directional=90.0, confirmation=90.0, opportunity=90.0, liquidity=90.0, execution=90.0, data_quality=95.0, edge_to_cost=9.0, elapsed_minutes=100)
    rows = [dict(base, name=n, k=k, side=s, setup=t, raw=raw, shortable=None, easy_to_borrow=False) for n, k, s, t, raw in [("a", 0, 1, "CONTINUATION", 90.0), ("a", 1, 1, "REVERSION", 80.0), ("b", 0, 1, "CONTINUATION", 70.0), ("b", 2, -1, "CONTINUATION", 70.0), ("c", 2, -1, "CONTINUATION", 90.0)]]
    schema = "name string, k int, side int, setup string, raw double, directional double, confirmation double, opportunity double, liquidity double, execution double, data_quality double, edge_to_cost double, elapsed_minutes int, shortable boolean, easy_to_borrow boolean"
    order = [f.split()[0] for f in schema.split(", ")]
    best = best_hypothesis(spark.createDataFrame([tuple(r[c] for c in order) for r in rows], schema), ["name"])
    x = {r["name"]: r for r in reliability_policy(best).collect()}
    assert (x["a"]["margin"], x["a"]["score"], x["a"]["view"], x["a"]["status"]) == (10.0, 90.0, "INVESTIGATE", "FAILED_EXTERNAL_HOLDOUT")
    assert x["b"]["k"] == 0 and x["b"]["margin"] == 0.0 and x["b"]["score"] == 64.0 and x["b"]["view"] == "WATCH"
    structure = 0.42 * 90 + 0.25 * 90 + 0.23 * 90 + 0.10 * 95
    assert abs(x["a"]["priority"] - min(74.0, structure - 16)) < 1e-9 and abs(x["c"]["priority"] - (structure - 11 - 8 - 12)) < 1e-9


def test_lookups(spark):
    jobs = spark.createDataFrame([(1, D(2026, 1, 1), D(2026, 1, 5)), (2, D(2026, 1, 4), D(2026, 1, 4)), (3, D(2026, 2, 1), D(2026, 2, 2))], "job int, start_day date, end_day date")
    active = spark.createDataFrame([(9, D(2026, 1, 4), D(2026, 1, 9))], "job int, start_day date, end_day date")
    days = spark.createDataFrame([(D(2026, 1, d),) for d in (1, 2, 4, 5)], "day date")
    assert {(r["job"], r["day"]) for r in latest_covered(jobs, days, active).collect()} == {(1, D(2026, 1, 2)), (2, None), (3, None)}
    configs = spark.createDataFrame([("regular", None, None, [1, 5], D(2026, 1, 1), D(2026, 1, 11), True, 41, 20, 5), ("custom", 1200, 240, [60], D(2026, 1, 3), D(2026, 1, 4), True, 10, 20, 5), ("custom", 5, 5, [1440], D(2026, 1, 3), D(2026, 1, 4), False, 0, 20, 5)],
                                    "mode string, start_minute int, end_minute int, timeframes array<int>, start_date date, end_date date, weekdays_only boolean, symbols int, symbol_batch int, date_chunk int")
    got = [(r["active_days"], r["rows"], r["tasks"]) for r in load_estimate(configs).collect()]
    assert got == [(7, 41 * (390 + 78) * 7, 3 * 3 * 2), (0, 0, 1), (2, 0, 0)]
    t = spark.createDataFrame([(1, None, "a"), (2, 5.0, "a"), (3, 7.0, "b"), (4, 9.0, "c")], "k int, v double, g string")
    assert [r["k"] for r in project(t, ["k"], among={"g": ["a", "b"]}, order=[("v", True), ("k", False)], limit=3).collect()] == [3, 2, 1]
