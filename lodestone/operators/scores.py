"""Layered scores of a fall in price: setup, confirmation, resilience, and the final score under damage and caps.

All of it is column expressions over one row; numbers that decide results are tables at the top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import clamp

#: Weights of the parts of each score, by name.
SETUP_WEIGHTS = {"raw_decline": 0.15, "volatility_shock": 0.20, "recent_high_drawdown": 0.10, "moving_average_dislocation": 0.15, "rsi": 0.10, "volume_anomaly": 0.10, "relative_move": 0.10, "tradability": 0.10}
CONFIRMATION_WEIGHTS = {"range_position": 0.25, "intraday_reversal": 0.20, "gap_reclaim": 0.20, "vwap_reclaim": 0.15, "volume_stabilisation": 0.10, "spread_quality": 0.10}
CORE_WEIGHTS = {"setup": 0.25, "catalyst": 0.35, "resilience": 0.15, "confirmation": 0.25}
#: Steps as (bound, points), the first bound that a value doesn't pass decides; None is for all others.
RSI_STEPS = ((15, 95), (25, 86), (35, 68), (45, 40), (None, 18))
SPREAD_STEPS = ((0.5, 95), (1, 85), (2, 68), (5, 38), (None, 12))
SPREAD_QUALITY_STEPS = ((0.5, 92), (1, 80), (2, 62), (5, 30), (None, 10))
#: Steps from above.
TURNOVER_STEPS = ((50_000_000, 95), (10_000_000, 84), (2_000_000, 67), (500_000, 45), (None, 15))
VWAP_STEPS = ((1, 88), (0, 72), (-1, 50), (None, 25))
#: Points of resilience by ratio: (at least, points) and (at most, points); the first that holds decides.
RATIO_POINTS = {
    "cash_to_assets": ((">=", 0.30, 18), (">=", 0.15, 10), ("<", 0.05, -15)),
    "liabilities_to_assets": (("<=", 0.50, 10), (">=", 0.90, -22), (">=", 0.80, -10)),
    "equity_to_assets": ((">=", 0.30, 10), ("<=", 0.05, -20), ("<=", 0.12, -8)),
    "revenue_yoy": ((">=", 0.10, 10), ("<=", -0.25, -16), ("<=", -0.10, -8)),
    "net_margin": ((">=", 0.05, 8), ("<=", -0.20, -14), ("<", 0.0, -7)),
    "net_margin_yoy_delta": (("<=", -0.10, -10), (">=", 0.05, 5)),
    "diluted_shares_yoy": ((">=", 0.50, -25), (">=", 0.20, -15), (">=", 0.10, -7), ("<=", -0.05, 4)),
}
#: The cap on the final score by damage (up to and including), verdict bounds, and the penalty on damage.
DAMAGE_CAPS = ((29, 100), (49, 85), (69, 65), (84, 40), (100, 20))
INVESTIGATE, WATCH, UNKNOWN_CAUSE_CAP, VETO_CAP = 75, 55, 60, 20
PENALTY_START, PENALTY_SLOPE, PENALTY_MOST = 25.0, 0.20, 15.0


def steps(x: Column, table: tuple, missing: float, down: bool = False) -> Column:
    """Points of the first step whose bound x does not pass (or reaches, going down); missing for null."""
    out = F.when(x.isNull(), F.lit(float(missing)))
    for bound, points in table:
        out = out.otherwise(F.lit(float(points))) if bound is None else out.when((x >= bound) if down else (x <= bound), float(points))
    return out


def ramp(x: Column, low: float, high: float, least: float, most: float, missing: Column | float) -> Column:
    """least at low, most at high, linear and cut off between; missing for null."""
    return F.coalesce(clamp(least + clamp((x - low) / (high - low), 0.0, 1.0) * (most - least), 0.0, 100.0), missing if isinstance(missing, Column) else F.lit(float(missing)))


def below(x: Column) -> Column:
    """How far x is below zero; null for null."""
    return F.when(x < 0, -x).when(x.isNotNull(), 0.0)


def digit(x: Column) -> Column:
    """Rounded to one digit; what differs in the tenth digit alone is rounded alike."""
    return F.round(F.round(x, 9), 1)


def weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    return sum((parts[k] * w for k, w in weights.items()), F.lit(0.0))


def setup_and_confirmation(x: DataFrame) -> DataFrame:
    """Adds setup, confirmation, dislocation (0 to 100, one digit) and setup_cap to rows of technical features with spread_pct and prev_dollar_volume."""
    c = F.col
    x = x.withColumn("_fall", below(c("current_return_pct")))
    x = x.withColumn("_decline", ramp(c("_fall"), 15, 45, 55, 95, 45)).withColumn("_place", F.coalesce("session_range_position", F.lit(30.0)))
    x = x.withColumn("_shock", ramp(c("shock_z"), 1.5, 5, 40, 98, c("_decline")))
    averages = F.array_compact(F.array(below(c("sma20_distance_pct")), below(c("sma50_distance_pct"))))
    mean = F.when(F.size(averages) > 0, F.aggregate(averages, F.lit(0.0), lambda a, v: a + v) / F.size(averages)).otherwise(c("_fall"))
    relative = F.array_max(F.array_compact(F.array(below(c("market_relative_move_pct")), below(c("sector_relative_move_pct")))))
    setup = {
        "raw_decline": c("_decline"), "volatility_shock": c("_shock"), "recent_high_drawdown": ramp(below(F.coalesce("drawdown_from_60d_high_pct", -c("_fall"))), 15, 60, 45, 92, c("_decline")),
        "moving_average_dislocation": ramp(mean, 10, 40, 40, 95, c("_decline")), "rsi": F.when(c("rsi14").isNull(), F.least(F.lit(80.0), "_decline")).otherwise(steps(c("rsi14"), RSI_STEPS, 0)),
        "volume_anomaly": ramp(c("relative_volume20"), 0.8, 4, 32, 94, 45), "relative_move": ramp(relative, 3, 25, 35, 95, 50),
        "tradability": 0.6 * steps(c("prev_dollar_volume"), TURNOVER_STEPS, 35, down=True) + 0.4 * steps(c("spread_pct"), SPREAD_STEPS, 35),
    }
    volume = c("relative_volume20")
    confirmation = {
        "range_position": clamp(c("_place"), 0.0, 100.0), "intraday_reversal": F.coalesce(clamp(50 + c("return_from_open_pct") * 7, 0.0, 100.0), F.lit(35.0)),
        "gap_reclaim": F.coalesce(clamp(35 + c("gap_reclaim_pct") * 0.75, 0.0, 100.0), F.lit(40.0)), "vwap_reclaim": steps(c("vwap_distance_pct"), VWAP_STEPS, 35, down=True),
        "volume_stabilisation": F.when(volume.isNull(), 35.0).when((volume >= 2) & (c("_place") >= 55), 88.0).when((volume >= 1.25) & (c("_place") >= 45), 70.0).when(c("_place") < 25, 20.0).otherwise(46.0),
        "spread_quality": steps(c("spread_pct"), SPREAD_QUALITY_STEPS, 35),
    }
    above, calm = F.greatest("sma20_distance_pct", "sma50_distance_pct"), lambda z: F.coalesce(c("shock_z") < z, F.lit(True))
    cap = F.when(above >= 100, 30.0).when(above >= 50, 40.0).when((above >= 20) & calm(2.0), 50.0).when((above >= 10) & calm(1.5), 55.0).otherwise(100.0)
    one = lambda v: digit(clamp(v, 0.0, 100.0))
    x = x.withColumn("setup_cap", cap)
    x = x.withColumns({
        "setup": one(F.least(weighted(setup, SETUP_WEIGHTS), "setup_cap")), "confirmation": one(weighted(confirmation, CONFIRMATION_WEIGHTS)),
        "dislocation": one(0.45 * c("_decline") + 0.35 * c("_shock") + 0.2 * ramp(c("atr_move_multiple"), 1.5, 5, 40, 98, c("_shock"))),
    })
    return x.drop("_fall", "_decline", "_place", "_shock")


def ratio_points(name: str) -> Column:
    """Points of one ratio; 0 for null."""
    x, out = F.col(name), F.when(F.col(name).isNull(), 0.0)
    for sign, bound, points in RATIO_POINTS[name]:
        out = out.when({">=": x >= bound, "<=": x <= bound, "<": x < bound}[sign], float(points))
    return out.otherwise(0.0)


def resilience(x: DataFrame) -> DataFrame:
    """Adds resilience and resilience_confidence from the ratios, metric_coverage_count and age_days (null: nothing known)."""
    total = sum((ratio_points(n) for n in RATIO_POINTS), F.lit(50.0))
    known, old = F.col("metric_coverage_count").isNotNull(), F.coalesce(F.col("age_days") > 180, F.lit(False))
    score = F.when(~known, 45.0).when(old, 45 + (total - 45) * 0.65).otherwise(total)
    sure = F.when(~known, 35.0).otherwise(clamp(45 + F.least("metric_coverage_count", F.lit(10)) * 4.0, 0.0, 100.0) - F.when(old, 12.0).otherwise(0.0))
    return x.withColumns({"resilience": digit(clamp(score, 0.0, 100.0)), "resilience_confidence": digit(clamp(sure, 0.0, 100.0))})


def final_score(x: DataFrame) -> DataFrame:
    """Adds damage_cap, final_score and verdict from setup, catalyst, resilience, confirmation, confidence, damage, cause_verified and hard_veto."""
    c, cut = F.col, lambda v: clamp(v, 0.0, 100.0)
    core = weighted({k: c(k) for k in CORE_WEIGHTS}, CORE_WEIGHTS)
    adjusted = 50 + (core - 50) * cut(c("confidence")) / 100
    fine = F.least(F.lit(PENALTY_MOST), F.greatest(F.lit(0.0), cut(c("damage")) - PENALTY_START) * PENALTY_SLOPE)
    cap = F.lit(float(VETO_CAP))
    for i, (most, own) in reversed(list(enumerate(DAMAGE_CAPS))):
        least = DAMAGE_CAPS[i - 1][0] + 1 if i else 0
        cap = F.when(cut(c("damage")).between(least, most), float(own)).otherwise(cap)
    limit = F.when(c("hard_veto"), float(VETO_CAP)).when(~c("cause_verified"), F.least(cap, F.lit(float(UNKNOWN_CAUSE_CAP)))).otherwise(cap)
    x = x.withColumn("damage_cap", cap).withColumn("final_score", digit(F.least(cut(adjusted - fine), limit)))
    verdict = F.when(c("hard_veto") | (c("final_score") < WATCH), "PASS").when((c("final_score") >= INVESTIGATE) & c("cause_verified"), "INVESTIGATE").otherwise("WATCH")
    return x.withColumn("verdict", verdict)
