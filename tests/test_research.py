"""Exact quantiles, pair ledger, session features, ridge and bootstrap against plain numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators.inference import block_bootstrap
from lodestone.operators.quantiles import exact_quantiles
from lodestone.operators.ridge import mapped, moments, predict, solve
from lodestone.operators.session_features import FEATURES, session_features
from lodestone.plans.pairs import BANDS, EDGES
from lodestone.plans.ridge import books


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_exact_quantiles(spark, bins):
    r = random.Random(bins)
    groups = {"even": [r.gauss(0, 1) for _ in range(200)], "odd": [r.choice([1.0, 2.0, 7.5]) for _ in range(301)], "one": [3.0], None: [-1e308, 1e308, 0.0, 5e-324], "far": [1e12] + [r.random() for _ in range(99)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("even", None), ("even", float("nan")), ("empty", None)]
    r.shuffle(rows)
    got = {x["k"]: x for x in exact_quantiles(spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v", {"q10": 0.1, "median": 0.5, "top": 1.0}, bins).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert [got[k][c] for c in ("q10", "median", "top")] == pytest.approx([float(np.quantile(v, q)) for q in (0.1, 0.5, 1.0)], rel=1e-12)


def test_magnitude_rules_have_their_edges():
    assert len(BANDS) == 10 and all(lo in EDGES and (hi is None or hi in EDGES) for _, lo, hi in BANDS)


def test_session_features(spark):
    r = random.Random(2)
    t0 = dt.datetime(2024, 1, 2, 14, 30)
    path, rows = [], []
    for m in range(390):
        o = path[-1][4] if path else 100.0
        c = o * (1 + r.gauss(0, 0.001))
        path.append((m, o, max(o, c) * 1.0002, min(o, c) * 0.9998, c, r.randrange(1, 90), r.randrange(1, 9)))
        rows.append(("A", t0.date(), t0 + dt.timedelta(minutes=m), *path[-1]))
    rows += [("A", t0.date(), t0 + dt.timedelta(minutes=400), 0, 0.0, 0.0, 0.0, 0.0, 5, 5), ("B", t0.date(), t0, 0, 5.0, 5.0, 5.0, 5.0, 0, 0)]
    out = {x["symbol"]: x for x in session_features(spark.createDataFrame(rows, "symbol string, day date, at timestamp_ntz, minute int, open double, high double, low double, close double, volume int, trades int")).collect()}
    m, o, h, low, c, v, t = map(np.array, zip(*path, strict=True))
    ret = np.diff(np.log(c))
    at = lambda minute: c[m < minute][-1]
    want = {
        "ret_oc": c[-1] / o[0] - 1, "range_pct": (h.max() - low.min()) / o[0], "rv_1m": ret.std(ddof=1), "close_location": (c[-1] - low.min()) / (h.max() - low.min()), "close_vs_vwap": c[-1] / ((c * v).sum() / v.sum()) - 1,
        "first30_ret": at(30) / o[0] - 1, "first60_ret": at(60) / o[0] - 1, "midday_ret": at(270) / at(120) - 1, "last60_ret": c[-1] / at(330) - 1, "last30_ret": c[-1] / at(360) - 1,
        "first60_range": (h[:60].max() - low[:60].min()) / o[0], "last60_range": (h[330:].max() - low[330:].min()) / o[0], "first60_volume_share": v[:60].sum() / v.sum(), "last60_volume_share": v[330:].sum() / v.sum(),
        "first60_trade_share": t[:60].sum() / t.sum(), "last60_trade_share": t[330:].sum() / t.sum(), "pos_minute_fraction": (ret > 0).mean(), "max_minute_ret": ret.max(), "min_minute_ret": ret.min(),
        "minute_ret_abs_sum": np.abs(ret).sum(), "efficiency_ratio": abs(np.log(c[-1] / c[0])) / np.abs(ret).sum(), "minute_ret_lag1_corr": np.corrcoef(ret[1:], ret[:-1])[0, 1],
        "high_time_fraction": h.argmax() / 389, "low_time_fraction": low.argmin() / 389, "max_runup_from_open": h.max() / o[0] - 1, "max_drawdown_from_open": low.min() / o[0] - 1,
    }
    assert set(want) == set(FEATURES) and len(FEATURES) == 26
    assert {f: out["A"][f] for f in FEATURES} == pytest.approx(want, abs=2e-9)
    assert out["B"]["ret_oc"] == 0 and out["B"]["rv_1m"] is None and out["B"]["first60_volume_share"] is None


def test_ridge_equals_plain_least_squares(spark):
    rng = np.random.default_rng(4)
    x = rng.random((300, 4))
    y = 0.3 * x[:, 0] - 0.2 * x[:, 1] * x[:, 2] + 0.01 * rng.standard_normal(300) + 1
    names = ["a", "b", "c", "d_"]
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))] + [(900, None, 0.1, 0.1, 0.1, 1.0)], "id int, a double, b double, c double, d_ double, y double").repartition(4)
    models = solve(moments(df, names, "y"), 4, (0.001, 0.1))
    assert [(m.name, m.penalty, len(m.weights)) for m in models] == [("LINEAR", 0.001, 4), ("LINEAR", 0.1, 4), ("QUADRATIC", 0.001, 14), ("QUADRATIC", 0.1, 14)]
    for m in models:
        z = mapped(x)[:, : len(m.weights)]
        s = (z - z.mean(axis=0)) / z.std(axis=0)
        b = np.linalg.solve(s.T @ s / 300 + m.penalty * np.eye(s.shape[1]), s.T @ (y - y.mean()) / 300)
        assert m.weights == pytest.approx(b / z.std(axis=0), rel=1e-6, abs=1e-9)
    got = {(r["id"], r["model"]): r["prediction"] for r in predict(df, names, ["id"], models).collect()}
    assert len(got) == 1200 and got[7, 2] == pytest.approx(models[2].intercept + float(mapped(x)[7] @ models[2].weights))
    flat = solve(moments(df.withColumn("b", F.lit(0.5)), names, "y"), 4, (0.1,))
    assert flat[0].weights[1] == 0 and solve(moments(df.limit(0), names, "y"), 4, (0.1,)) == []


def test_books(spark):
    p = spark.createDataFrame([(s, 1, 0, v) for s, v in (("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("cheap", 9.0))], "symbol string, day int, model int, prediction double")
    o = spark.createDataFrame([("a", 1, 10.0, 0.1), ("b", 1, 10.0, 0.2), ("c", 1, 10.0, None), ("d", 1, 10.0, -0.3), ("cheap", 1, 4.0, 5.0)], "symbol string, day int, next_open double, raw double")
    got = {(r["construction"], r["top_n"]): r["gross"] for r in books(p, o).collect()}
    assert got == {("LONG_TOP", 1): 0.1, ("SHORT_BOTTOM", 1): 0.3, ("TOP_MINUS_BOTTOM", 1): pytest.approx(0.2), ("LONG_TOP", 2): pytest.approx(0.15), ("SHORT_BOTTOM", 2): pytest.approx(0.05), ("TOP_MINUS_BOTTOM", 2): pytest.approx(0.1)}


def test_block_bootstrap_follows_the_seed(spark):
    x = np.array([0.01, -0.02, 0.03, 0.0, 0.01, 0.02, -0.01])
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x)] + [("none", 0, None)], "k string, i int, net double")
    got = {r["k"]: r for r in block_bootstrap(df, ["k"], "i", "net", 5, 1000, 9).collect()}
    rng = np.random.Generator(np.random.PCG64(9))
    at = (rng.integers(0, 7, size=(1000, 2))[:, :, None] + np.arange(5)).reshape(1000, -1)[:, :7] % 7
    means = x[at].mean(axis=1)
    assert (got["k"]["low"], got["k"]["high"]) == pytest.approx(tuple(np.quantile(means, [0.025, 0.975])), abs=1e-9)
    assert got["k"]["p"] == pytest.approx((1 + (means - x.mean() >= x.mean()).sum()) / 1001) and np.isnan(got["none"]["low"] or np.nan)
