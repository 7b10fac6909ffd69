"""Rules of the daily scan: who can be a candidate, in which session a price was made, and which candidates are looked at first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import price_session
from .scores import steps

#: Words that name no operating company, and what a ticker looks like.
NOT_OPERATING = r"\b(etf|etn|exchange[- ]traded fund|exchange[- ]traded note|warrants?|rights?|units?|preferred|inverse|leveraged|microsectors|proshares|direxion|tradr|leverage shares|t-rex|defiance|graniteshares|yieldmax|roundhill|rex shares)\b"
TICKER = r"^[A-Z][A-Z0-9.\-]{0,9}$"
#: Fixed values of the order in which candidates are looked at: points by class of event, penalties by flag, points by spread.
CLASS_POINTS = {"B": 32.0, "A": 27.0, "C": 20.0, "U": 4.0, "D": -25.0, "E": -55.0}
FLAG_PENALTIES = {"solvency": 35.0, "delisting": 30.0, "dilution": 14.0, "clinical_regulatory": 12.0, "legal": 8.0, "earnings_guidance": 3.0}
SPREAD_POINTS = ((0.5, 25), (1.0, 20), (2.0, 13), (5.0, 5), (None, 0))
#: Most points for liquidity, size of a fall, volume and headlines, and what is taken off a move outside the session.
MOST_LIQUIDITY, MOST_FALL, MOST_VOLUME, MOST_NEWS, EXTENDED_PENALTY = 45.0, 18.0, 12.0, 8.0, 10.0


def listed_companies(assets: DataFrame) -> DataFrame:
    """Assets (symbol, name, exchange, asset_class, tradable) that are tradable listed shares of operating companies."""
    ok = F.col("tradable") & (F.lower("asset_class") == "us_equity") & ~F.lower("exchange").contains("otc") & F.upper("symbol").rlike(TICKER) & ~F.lower(F.coalesce("name", F.lit(""))).rlike(NOT_OPERATING)
    return assets.filter(F.coalesce(ok, F.lit(False)))


def drop_candidates(snapshots: DataFrame, min_drop: float, min_price: float, min_turnover: float) -> DataFrame:
    """Snapshots that fell enough, with last_price (first of trade, minute, day that is not 0), drop_pct, prev_turnover and spread_pct. An unknown turnover passes."""
    some = lambda n: F.nullif(F.col(n), F.lit(0.0))
    x = snapshots.withColumn("last_price", F.coalesce(some("trade_price"), some("minute_close"), some("day_close")))
    middle = (F.col("ask") + F.col("bid")) / 2
    x = x.withColumns({
        "drop_pct": (F.try_divide("last_price", "prev_close") - 1) * 100, "prev_turnover": F.col("prev_close") * F.col("prev_volume"),
        "spread_pct": F.when((F.col("bid") > 0) & (F.col("ask") >= F.col("bid")), (F.col("ask") - F.col("bid")) / middle * 100),
    })
    return x.filter((F.col("prev_close") > 0) & (F.col("last_price") >= min_price) & (F.col("drop_pct") <= -abs(min_drop)) & F.coalesce(F.col("prev_turnover") >= min_turnover, F.lit(True)))


def session_context(candidates: DataFrame, min_drop: float) -> DataFrame:
    """Adds the session of the last trade, the regular session's price and move, the move outside it, and whether the fall was outside it alone."""
    c = F.col
    x = candidates.withColumn("price_session", price_session(c("trade_ts")))
    x = x.withColumn("regular_price", F.when(c("price_session") == "regular", c("last_price")).otherwise(c("day_close")))
    x = x.withColumn("regular_move_pct", F.when(c("prev_close") > 0, (c("regular_price") / c("prev_close") - 1) * 100))
    outside = F.when((c("regular_price") > 0) & (c("price_session") != "regular"), (c("last_price") / c("regular_price") - 1) * 100)
    alone = c("price_session").isin("pre_market", "after_hours", "closed") & (c("drop_pct") <= -abs(min_drop)) & F.coalesce(c("regular_move_pct") > -abs(min_drop), F.lit(True))
    return x.withColumns({"extended_move_pct": outside, "extended_hours_only": alone})


def prefilter(unit: float = 100_000.0) -> Column:
    """Points of a candidate by turnover (in units), spread, size of the fall, volume against the day before, and session."""
    c = F.col
    liquidity = F.least(F.lit(MOST_LIQUIDITY), F.greatest(F.lit(0.0), F.log10(F.greatest(F.lit(1.0), F.coalesce("prev_turnover", F.lit(0.0)) / unit)) * 12))
    fall = F.least(F.lit(MOST_FALL), F.greatest(F.lit(0.0), (F.abs(F.least("drop_pct", F.lit(0.0))) - 12) * 0.65))
    volume = F.when((c("prev_volume") != 0) & c("day_volume").isNotNull(), F.least(F.lit(MOST_VOLUME), c("day_volume") / c("prev_volume") * 4)).otherwise(0.0)
    return liquidity + steps(c("spread_pct"), SPREAD_POINTS, 0) + fall + volume - F.when(c("extended_hours_only"), EXTENDED_PENALTY).otherwise(0.0)


def priority(points: Column) -> Column:
    """Prefilter points with class of event, headlines and risk flags."""
    table = F.create_map(*[F.lit(v) for kv in CLASS_POINTS.items() for v in kv])
    fines = F.create_map(*[F.lit(v) for kv in FLAG_PENALTIES.items() for v in kv])
    fine = F.aggregate(F.array_distinct("risk_flags"), F.lit(0.0), lambda a, f: a + F.coalesce(F.try_element_at(fines, f), F.lit(0.0)))
    return points + F.coalesce(F.try_element_at(table, F.col("event_class")), F.lit(0.0)) + F.least(F.lit(MOST_NEWS), F.col("headlines") * 1.5) - fine


def pools(limit: int) -> tuple[int, int]:
    """Sizes of the two pools that a wish for so many candidates gives: those whose news are read, and those analysed in full."""
    return max(100, min(300, 6 * limit)), max(100, min(150, 2 * limit))


def two_stage(candidates: DataFrame, day: str, limit: int, first: Column, second: Column) -> DataFrame:
    """The candidates of each day that both pools keep, with points, priority and place; larger falls and then symbols break ties."""
    market, analysis = pools(limit)
    best = lambda c: F.row_number().over(Window.partitionBy(day).orderBy(F.col(c).desc(), "drop_pct", "symbol"))
    x = candidates.withColumn("points", F.round(first, 6)).withColumn("_k", best("points")).filter(F.col("_k") <= market).drop("_k")
    return x.withColumn("priority", F.round(second, 2)).withColumn("place", best("priority")).filter(F.col("place") <= analysis)
