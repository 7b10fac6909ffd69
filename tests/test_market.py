"""Unit vectors of sessions, upserts, as-of joins, bars, outcomes, statistics, sources and streams."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions.stats import benjamini_hochberg, clamp, equity, geometric_mean, jaccard, sigmoid, summarise
from lodestone.functions.timeutil import clock_grid, in_session, rfc3339, session_label, trade_date
from lodestone.operators.asof import asof, within_interval
from lodestone.operators.bars import bars_from_ticks, daily_features, path_outcome
from lodestone.operators.keyed import insert_new, latest_per_key, merge_inventory, newest_active, upsert, write_partitions
from lodestone.operators.ranks import normalised_ranks, ordered_names, rank_where, tail_state
from lodestone.plans.events import fit_calibration, q23_bootstrap
from lodestone.plans.market import d12_ordered_dedup
from lodestone.plans.scanner import q7_basket_eligibility
from lodestone.sources.tables import corporate_events, known_assets, read_bar_pages, read_staged, stage_csv, write_monthly
from lodestone.streaming.ingest import append_new, completed_minutes, fresh_bars
from lodestone.streaming.tracking import run_step

T = dt.datetime


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sessions(spark):
    at = [T(2026, 1, 5, 14, 30), T(2026, 1, 5, 13, 0), T(2026, 1, 5, 12, 0), T(2026, 1, 6, 2, 0), T(2026, 1, 3, 15, 0), T(2026, 1, 5, 21, 0)]
    df = spark.createDataFrame([(x,) for x in at], "ts timestamp_ntz")
    ts = F.col("ts")
    got = df.select("ts", session_label(ts), in_session(ts, "regular", weekdays_only=True), in_session(ts, "custom", 1200, 240), in_session(ts, "custom", 5, 5), trade_date(ts)).collect()
    assert [r[1] for r in got] == ["regular", "premarket", "premarket", "overnight", "regular", "postmarket"]
    assert [r[2] for r in got] == [True, False, False, False, False, False]
    assert [r[3] for r in got] == [False, False, False, True, False, False] and all(r[4] for r in got)
    assert got[3][5] == dt.date(2026, 1, 5)
    with pytest.raises(ValueError):
        in_session(ts, "lunch")


def test_clock_grid_follows_summer_time(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 8),), (dt.date(2024, 3, 11),)], "trade_date date")
    assert [r["clock_ts"] for r in clock_grid(days, [570]).orderBy("trade_date").collect()] == [T(2024, 3, 8, 14, 30), T(2024, 3, 11, 13, 30)]


def test_rfc3339_cuts_nanoseconds(spark):
    df = spark.createDataFrame([("2026-01-05T14:31:01.123456789Z",), ("nonsense",), (None,)], "t string")
    assert [r[0] for r in df.select(rfc3339(F.col("t"))).collect()] == [T(2026, 1, 5, 14, 31, 1, 123456), None, None]


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, o int")
    new = spark.createDataFrame([("b", 9, 2), ("b", 8, 1), ("c", 7, 1)], "k string, v int, o int")
    assert rows(insert_new(old, new, ["k"], F.col("o").asc()).select("k", "v")) == [("a", 1), ("b", 2), ("c", 7)]
    assert rows(upsert(old, new, ["k"], F.col("o").asc()).select("k", "v")) == [("a", 1), ("b", 8), ("c", 7)]
    assert rows(upsert(old, new.limit(0), ["k"], F.col("o").asc()).select("k", "v")) == [("a", 1), ("b", 2)]
    ledger = merge_inventory(old.selectExpr("k", "v as lo", "v as hi", "o as n"), new.selectExpr("k", "v as lo", "v as hi", "o as n"), ["k"], "lo", "hi", "n")
    assert rows(ledger) == [("a", 1, 1, 1), ("b", 2, 9, 4), ("c", 7, 7, 1)]
    assert rows(newest_active(new, ["k"], F.col("o").desc()).filter("active").select("k", "v")) == [("b", 9), ("c", 7)]
    assert rows(latest_per_key(new, ["k"], F.col("v").desc(), keep=2).select("k", "v")) == [("b", 8), ("b", 9), ("c", 7)]


def test_dedup_reads_the_whole_text(spark, tmp_path):
    opening = "the same forty characters open these two texts: "
    texts = [opening + "one", opening + "two", " " + opening.upper() + "ONE", None, None, "", " "]
    spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)] + [("t", i, f"x{i}") for i in range(20, 32)], "source string, doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(d12_ordered_dedup(spark, str(tmp_path))) == [("s", i) for i in (0, 1, 3, 4, 5, 6)] + [("t", i) for i in range(20, 30)]


def test_asof_strictness_and_reach(spark):
    left = spark.createDataFrame([(1, "x", T(2024, 1, 1, 12, 0)), (2, "x", T(2024, 1, 1, 15, 0)), (3, "y", T(2024, 1, 1, 12, 0))], "left_id long, k string, at timestamp_ntz")
    right = spark.createDataFrame([("x", T(2024, 1, 1, 11, 59, 59), 1), ("x", T(2024, 1, 1, 12, 0), 2), ("x", T(2024, 1, 1, 12, 20), 3)], "k string, ts timestamp_ntz, v int")
    get = lambda **o: {r["left_id"]: r["v"] for r in asof(left, right, "k", "at", "ts", 1800, **o).collect()}
    assert get() == {1: 1, 2: None, 3: None}
    assert get(strict=False) == {1: 2, 2: None, 3: None}
    assert get(forward=True) == {1: 3, 2: None, 3: None}
    spans = left.selectExpr("left_id", "k", "at as start", "at + interval 20 minutes as stop")
    assert rows(within_interval(spans, right, "k", "start", "stop", "ts", 1200).select("left_id", "v")) == [(1, 3)]


def ticks_frame(spark):
    at = [(0, 10.0), (1, 12.0), (1, 8.0), (20, 11.0)]
    return spark.createDataFrame([("A", T(2024, 1, 2, 15, m), p, 100, i) for i, (m, p) in enumerate(at)], "symbol string, ts timestamp_ntz, price double, size long, tick_id long")


def test_bars_and_daily_features(spark):
    bars = bars_from_ticks(ticks_frame(spark), 15, "15Min")
    first = bars.orderBy("bar_ts").first()
    assert (first["open"], first["high"], first["low"], first["close"], first["volume"], first["trade_count"], first["vwap"]) == (10.0, 12.0, 8.0, 8.0, 300, 3, 10.0)
    day = daily_features(bars).first()
    assert (day["open"], day["close"], day["bar_count"], day["volume"]) == (10.0, 11.0, 2, 400) and day["realised_volatility"] is None
    assert abs(day["return_pct"] - 10.0) < 1e-9 and abs(day["range_pct"] - 40.0) < 1e-9
    shuffled = daily_features(bars.orderBy(F.rand(1))).first()
    assert shuffled == day and daily_features(bars, "overnight").count() == 0


def test_path_outcome_both_sides(spark):
    bars = spark.createDataFrame([("A", T(2024, 1, 1, 10, m), o, h, lo, c) for m, o, h, lo, c in [(0, 1.0, 999.0, 1.0, 1.0), (1, 101.0, 104.0, 100.0, 102.0), (2, 102.0, 106.0, 98.0, 103.0), (3, 103.0, 106.0, 99.0, 105.0), (4, 9.0, 999.0, 1.0, 9.0)]], "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double")
    signal = spark.createDataFrame([(1, "A", T(2024, 1, 1, 10, 0))], "signal_id long, symbol string, signal_ts timestamp_ntz")
    up, down = path_outcome(signal, bars, 3).first(), path_outcome(signal, bars, 3, side=-1).first()
    assert up["entry"] == 101.0 and up["bars"] == 3 and up["top_ts"] == T(2024, 1, 1, 10, 2)
    assert abs(up["mfe_pct"] - (106 / 101 - 1) * 100) < 1e-9 and abs(up["mae_pct"] - (98 / 101 - 1) * 100) < 1e-9 and abs(up["close_pct"] - (105 / 101 - 1) * 100) < 1e-9
    assert abs(down["mfe_pct"] + up["mae_pct"]) < 1e-9 and abs(down["mae_pct"] + up["mfe_pct"]) < 1e-9


def test_no_look_ahead(spark):
    bars = bars_from_ticks(ticks_frame(spark), 15, "15Min")
    signal = spark.createDataFrame([(1, "A", T(2024, 1, 2, 14, 59))], "signal_id long, symbol string, signal_ts timestamp_ntz")
    later = bars.withColumn("bar_ts", F.expr("bar_ts + interval 1 day")).withColumn("high", F.lit(1e9))
    assert path_outcome(signal, bars, 60).first() == path_outcome(signal, bars.unionByName(later), 60).first()


def test_statistics(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([0.1, -0.05, 0.2, None])] + [("b", 0, 0.5)], "k string, i int, net double")
    m = {r["k"]: r for r in summarise(df, ["k"], "net").collect()}
    assert m["a"]["trades"] == 3 and m["a"]["median_net"] == 0.1 and abs(m["a"]["profit_factor"] - 6.0) < 1e-9 and m["b"]["profit_factor"] is None and m["b"]["t_stat"] is None
    e = equity(df.filter("net is not null"), ["k"], ["i"], "net").orderBy("k", "i").collect()
    assert abs(e[1]["equity"] - 1.1 * 0.95) < 1e-9 and abs(e[1]["peak"] - 1.1) < 1e-9
    q = benjamini_hochberg(spark.createDataFrame([(1, 0.01), (1, 0.04), (1, 0.03), (1, 0.9)], "f int, p double"), "p", ["f"]).orderBy("p").collect()
    assert [round(r["q"], 6) for r in q] == [0.04, 0.053333, 0.053333, 0.9]
    one = spark.range(1).select(clamp(F.lit(5.0), 0, 1), sigmoid(F.lit(1e6)), geometric_mean([(F.lit(100.0), 1), (F.lit(0.0), 1)]), jaccard(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2)))).first()
    assert one[0] == 1.0 and one[1] == 1.0 and abs(one[2] - 10.0) < 1e-9 and one[3] == 0.5


def test_ranks(spark):
    df = spark.createDataFrame([("d", s, v) for s, v in [("a", 1.0), ("b", 1.0), ("c", 3.0)]] + [("e", "z", 1.0)], "day string, s string, v double")
    r = {(x["day"], x["s"]): x["v_rank"] for x in normalised_ranks(df, ["day"], "s", ["v"]).collect()}
    assert r == {("d", "a"): 0.0, ("d", "b"): 0.5, ("d", "c"): 1.0, ("e", "z"): None}
    ok = F.col("s") != "a"
    ranked = df.withColumn("place", rank_where(ok, ["day"], F.col("v"), F.col("s")))
    assert {(x["s"], x["place"]) for x in ranked.collect()} == {("a", None), ("b", 1), ("c", 2), ("z", 1)}
    assert ranked.filter("day = 'd'").agg(ordered_names("s", "place", 2)).first()[0] == ["b", "c"]
    states = df.select(tail_state(F.col("v"), F.lit(1.0), F.lit(3.0))).collect()
    assert [x[0] for x in states] == ["LOW", "LOW", "HIGH", "LOW"]


def test_calibration_recovers_a_mapping(spark):
    data = [(float((17 * i) % 101), ((17 * i) % 101 >= 52) != (i % 11 == 0)) for i in range(360)]
    a, b = fit_calibration(spark.createDataFrame(data, "score double, target boolean"))
    assert b > 0.4 and abs(1 / (1 + 2.718281828 ** -(a + b * 0.0)) - 0.5) < 0.15
    _, inverse = fit_calibration(spark.createDataFrame([(s, not t) for s, t in data], "score double, target boolean"))
    assert abs(inverse + b) < 1e-6


def test_bootstrap_has_the_references_replications(spark, tmp_path):
    net = [round(float(0.04 * np.sin(i)) + (0.01 if i % 3 else -0.005), 6) for i in range(12)]
    lines = [(flag, "F", T(2024, m + 1, 5), x + lift, 0.0) for flag, lift in (("A", 0.01), ("R", 0.5)) for m, x in enumerate(net)]
    spark.createDataFrame(lines, "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["candidate"]: r for r in q23_bootstrap(spark, str(tmp_path)).collect()}
    for name, lift in (("A|F", 0.0), ("R|F", 0.49)):
        x = np.round(np.array(net) + lift, 9)  # all draws at once, as the reference makes them
        at = ((np.random.Generator(np.random.PCG64(20260813)).integers(0, 12, size=(20_000, 3))[:, :, None] + np.arange(5)) % 12).reshape(20_000, -1)[:, :12]
        low, high = np.quantile(x[at].mean(axis=1), [0.025, 0.975], method="linear")
        p = (1 + np.count_nonzero((x - x.mean())[at].mean(axis=1) >= x.mean())) / 20_001
        assert (got[name]["n"], got[name]["p"]) == (12, p) and np.allclose([got[name]["low"], got[name]["high"]], [low, high], rtol=0, atol=2e-9)
    assert got["R|F"]["p"] == 1 / 20_001


def test_baskets_have_six_names(spark, monkeypatch):
    c = spark.createDataFrame([(f"n{i}", dt.date(2024, 1, d)) for d, n in ((1, 5), (2, 6), (3, 6)) for i in range(n)], "symbol string, signal_date date")
    p = c.withColumn("next_open", F.lit(10.0)).withColumn("next_close", F.when(F.substring("symbol", 2, 1).cast("int") < F.when(F.dayofmonth("signal_date") == 2, 6).otherwise(5), 9.0))
    monkeypatch.setattr("lodestone.plans.scanner.q6_signal_candidates", lambda *a: c)
    monkeypatch.setattr("lodestone.plans.scanner.panel", lambda *a: p)
    got = {r["signal_date"].day: (r["priced"], r["net"], r["excluded"]) for r in q7_basket_eligibility(spark, "").collect()}
    assert got == {1: (5, None, "TOO_FEW_NAMES"), 2: (6, 0.0988, None), 3: (5, None, "MISSING_PRICE")}


def test_sources(spark, tmp_path):
    page = {"bars": {"A": [{"t": "2024-01-02T15:00:00.123456789Z", "o": 1, "h": 2, "l": 1, "c": 2, "v": 5, "n": 1}], "B": []}, "next_page_token": None}
    (tmp_path / "p").mkdir()
    (tmp_path / "p/1.json").write_text(json.dumps(page))
    bars = read_bar_pages(spark, f"{tmp_path}/p")
    assert [(r["symbol"], r["bar_ts"], r["volume"], r["vwap"]) for r in bars.collect()] == [("A", T(2024, 1, 2, 15, 0, 0, 123456), 5, None)]
    stage_csv(bars, f"{tmp_path}/csv")
    assert rows(read_staged(spark, f"{tmp_path}/csv", bars.schema)) == rows(bars)
    write_monthly(bars, f"{tmp_path}/m")
    write_monthly(bars.withColumn("bar_ts", F.expr("bar_ts + interval 40 days")), f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m").select("yyyymm").distinct().count() == 2
    write_partitions(bars.withColumn("d", F.lit(1)), f"{tmp_path}/w", "d")
    assert spark.read.parquet(f"{tmp_path}/w").count() == 1
    act = spark.createDataFrame([("AAPL",), ("SAME",)], "symbol string")
    assert rows(known_assets(act, spark.createDataFrame([("OLD",), ("SAME",)], "symbol string"))) == [("AAPL", True), ("OLD", False), ("SAME", True)]
    events = corporate_events(spark.createDataFrame([('{"forward_splits": [{"symbol": "A", "ex_date": "2026-01-20"}], "cash_dividends": []}',)], "payload string"))
    assert [(r["action_type"], r["event"]["symbol"]) for r in events.collect()] == [("forward_splits", "A")]


def test_streams(spark, tmp_path):
    """One landing a step, in order of time; the row of the next day is a step of its own."""
    source = ticks_frame(spark).withColumn("ts", F.col("ts").cast("timestamp"))
    later = source.limit(1).withColumn("ts", F.expr("ts + interval 1 day")).withColumn("symbol", F.lit("Z"))
    stream = spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in*")
    once = fresh_bars(stream.withColumnRenamed("ts", "bar_ts").select("symbol", "bar_ts", "price"))
    for k, step in enumerate((source.unionByName(source), later)):
        step.write.parquet(f"{tmp_path}/in{k}")
        append_new(once, f"{tmp_path}/out", f"{tmp_path}/cp", ["symbol", "bar_ts"]).awaitTermination()
        run_step(completed_minutes(stream), f"{tmp_path}/minutes", f"{tmp_path}/cp2")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.groupBy("symbol", "bar_ts").count().filter("count > 1").count() == 0 and out.filter("symbol = 'A'").count() == 3
    assert spark.read.parquet(f"{tmp_path}/minutes").filter("symbol = 'A'").count() == 3
