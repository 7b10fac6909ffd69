"""Trade statistics, robust statistics and multiple testing as column expressions and small transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def trade_metrics(net: Column) -> dict[str, Column]:
    """Aggregates of a column of net returns; every one skips nulls."""
    up, down = F.when(net > 0, net), F.when(net < 0, net)
    return {
        "trades": F.count(net),
        "avg_net": F.avg(net),
        "median_net": F.median(net),
        "win_rate": F.avg((net > 0).cast("int")),
        "avg_win": F.avg(up),
        "avg_loss": F.avg(down),
        "worst": F.min(net),
        "best": F.max(net),
        "profit_factor": F.sum(up) / F.nullif(F.abs(F.sum(down)), F.lit(0.0)),
        "t_stat": F.avg(net) / F.nullif(F.stddev_samp(net) / F.sqrt(F.count(net)), F.lit(0.0)),
        "concentration": F.max(up) / F.nullif(F.sum(up), F.lit(0.0)),
    }


def summarise(df: DataFrame, keys: list[str], net: str, digits: int = 6) -> DataFrame:
    """trade_metrics by keys, rounded so that the order of summation does not show (and without negative zeros)."""
    parts = trade_metrics(F.col(net))
    return df.groupBy(*keys).agg(*[(v if k == "trades" else F.round(v, digits) + F.lit(0.0)).alias(k) for k, v in parts.items()])


def equity(df: DataFrame, keys: list[str], order: list[str], net: str) -> DataFrame:
    """Adds the compounded equity and its running maximum per group, in order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("equity", F.exp(F.sum(F.ln(1 + F.col(net))).over(w)))
    return out.withColumn("peak", F.max("equity").over(w))


def benjamini_hochberg(df: DataFrame, p: str, keys: list[str]) -> DataFrame:
    """Adds q: the smallest p * n / rank among equal or larger p, within keys."""
    by = Window.partitionBy(*keys)
    ranked = df.withColumn("_rank", F.row_number().over(by.orderBy(F.col(p).asc_nulls_last()))).withColumn("_n", F.count(p).over(by))
    back = by.orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min(F.col(p) * F.col("_n") / F.col("_rank")).over(back))).drop("_rank", "_n")


def clamp(x: Column, low: float, high: float) -> Column:
    """x cut off at low and high; null for null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def linear_score(x: Column, low: float, high: float) -> Column:
    """0 at low, 100 at high, linear and cut off between."""
    return clamp((x - low) / (high - low) * 100.0, 0.0, 100.0)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clamp(x, -700.0, 700.0)))


def geometric_mean(parts: list[tuple[Column, float]], floor: float = 1.0) -> Column:
    """Weighted geometric mean; values below the floor count as the floor."""
    total = sum(w for _, w in parts)
    return F.exp(sum((F.ln(F.greatest(c, F.lit(floor))) * (w / total) for c, w in parts), F.lit(0.0)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; 0 when both are empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))
