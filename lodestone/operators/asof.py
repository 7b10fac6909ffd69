"""As-of and interval joins: bucketed equality joins with a range condition, for look-ups within a known reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: int, forward: bool = False, strict: bool = True, tie: list[Column] | None = None) -> DataFrame:
    """Each left row with the nearest right row before it (or after it) at most so many seconds away, or nulls.

    Both sides are dealt by (key, time bucket of the reach), each left row to two buckets, so no key meets
    in one task alone; the nearest row is an aggregate with partial results. Left rows need a column left_id that tells
    them apart; of rows equally near, the one with the least tie (columns of right) is taken.
    """
    bucket = F.floor(_seconds(F.col(left_ts)) / within).cast("long")
    spread = left.select(F.struct(*left.columns).alias("_left"), "left_id", F.col(key).alias("_k"), F.col(left_ts).alias("_t"), F.explode(F.array(bucket, bucket + (1 if forward else -1))).alias("_b"))
    found = [c for c in right.columns if c != key]
    gap = F.lit(1 if forward else -1) * (_seconds(F.col(right_ts)) - _seconds(F.col("_t")))
    values = right.select(F.col(key).alias("_rk"), F.floor(_seconds(F.col(right_ts)) / within).cast("long").alias("_rb"), *found)
    near = ((gap > 0) if strict else (gap >= 0)) & (gap <= within)
    met = spread.join(values, (F.col("_k") == F.col("_rk")) & (F.col("_b") == F.col("_rb")) & near, "left")
    order = F.when(F.col("_rk").isNotNull(), F.struct(gap.alias("gap"), *[t.alias(f"t{i}") for i, t in enumerate(tie or [])]))
    best = met.groupBy("left_id").agg(F.any_value("_left").alias("_left"), F.min_by(F.struct(*found), order).alias("_right"))
    return best.select("_left.*", *[F.col(f"_right.{c}").alias(c) for c in found])


def within_interval(left: DataFrame, right: DataFrame, key: str, start: str, end: str, ts: str, reach: int) -> DataFrame:
    """Right rows of the same key with start < ts <= end.

    Both sides are dealt by (key, time bucket of reach seconds), a left row to every bucket that its interval touches;
    with the usual length of an interval as reach that is two, and a hot key is spread over its time.
    """
    bucket = lambda c: F.floor(_seconds(F.col(c)) / reach).cast("long")
    spread = left.filter(F.col(start) <= F.col(end)).withColumn("_b", F.explode(F.sequence(bucket(start), bucket(end))))
    met = spread.join(right.withColumn("_b", bucket(ts)), [key, "_b"]).drop("_b")
    return met.filter((F.col(ts) > F.col(start)) & (F.col(ts) <= F.col(end)))
