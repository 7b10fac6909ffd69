"""Statistics of short arrays of doubles, as column expressions; for series that a group's bounded window gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    """0 for an empty array."""
    return F.when(F.size(a) > 0, total(a) / F.size(a)).otherwise(0.0)


def deviation(a: Column) -> Column:
    """Sample standard deviation; 0 below two values."""
    m = mean(a)
    return F.when(F.size(a) < 2, 0.0).otherwise(F.sqrt(total(F.transform(a, lambda x: (x - m) * (x - m))) / F.greatest(F.size(a) - 1, F.lit(1))))


def middle(a: Column) -> Column:
    """The median; null for an empty array."""
    s, n = F.array_sort(a), F.size(a)
    at = lambda i: F.get(s, F.floor(i).cast("int"))
    return F.when(n > 0, (at((n - 1) / 2) + at(n / 2)) / 2)


def with_robust_deviation(df: DataFrame, source: str, name: str) -> DataFrame:
    """Adds the standard deviation of an array column after values beyond 4 robust deviations (1.4826 MAD) of the median are drawn in.

    The plain deviation for fewer than three values or a MAD of 0. One column after the other, so that no expression is repeated.
    """
    m, reach, drawn = (f"{name}_{part}" for part in ("middle", "reach", "drawn"))
    x = df.withColumn(m, middle(F.col(source)))
    x = x.withColumn(drawn, F.transform(source, lambda v: F.abs(v - F.col(m))))
    x = x.withColumn(reach, 4.0 * 1.4826 * middle(F.col(drawn)))
    x = x.withColumn(drawn, F.transform(source, lambda v: F.least(F.col(m) + F.col(reach), F.greatest(F.col(m) - F.col(reach), v))))
    plain = F.when((F.size(source) >= 3) & (F.col(reach) > 0), F.col(drawn)).otherwise(F.col(source))
    return x.withColumn(drawn, plain).withColumn(name, deviation(F.col(drawn))).drop(m, reach, drawn)


def tail(a: Column, n: int | Column) -> Column:
    """The last n elements (all of a shorter array)."""
    k = F.least(F.size(a), n if isinstance(n, Column) else F.lit(n))
    return F.when(k > 0, F.slice(a, F.size(a) - k + 1, k)).otherwise(F.slice(a, 1, 0))


def steps(a: Column) -> Column:
    """Differences of neighbours."""
    return F.when(F.size(a) > 1, F.zip_with(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: x - y)).otherwise(F.slice(a, 1, 0))
