"""Exact quantiles of groups of any size: counts by value, then the bins and the values that the wanted places fall into."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], bins: int = 4096) -> DataFrame:
    """keys and one column for each named quantile, linear between neighbours; rows whose value is null or NaN don't count.

    No task holds a group: rows are counted by value with partial results, values by bin (at most so many for a group), and
    only the values of the bins with wanted places are put in order.
    """
    counts = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    counts = written(counts, "value-counts")
    renamed = lambda d: d.withColumnsRenamed({k: f"{k}_of" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys], F.lit(True))
    span = counts.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("all"))
    place = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * bins), F.lit(bins - 1))).otherwise(0).cast("int")
    binned = counts.join(renamed(span), same).select(*keys, "v", "n", "all", place.alias("bin"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("all") - 1)).alias("at")) for name, q in quantiles.items()])).alias("w")
    per_bin = binned.groupBy(*keys, "bin", "all").agg(F.sum("n").alias("n"))
    per_bin = per_bin.withColumn("before", F.sum("n").over(Window.partitionBy(*keys).orderBy("bin")) - F.col("n"))
    inside = lambda p: (F.col("before") <= p) & (p < F.col("before") + F.col("n"))
    held = per_bin.select("*", wanted).filter(inside(F.floor("w.at")) | inside(F.ceil("w.at")))
    held = renamed(held.select(*keys, F.col("bin").alias("bin_of"), F.col("before").alias("start")).distinct())
    rows = binned.join(held, same & (F.col("bin") == F.col("bin_of"))).select(*keys, "bin", "v", "n", "all", "start")
    rows = rows.withColumn("before", F.col("start") + F.sum("n").over(Window.partitionBy(*keys, "bin").orderBy("v")) - F.col("n"))
    found = rows.select("*", wanted).groupBy(*keys).agg(*[c for name in quantiles for c in (
        F.max(F.when((F.col("w.name") == name) & inside(F.floor("w.at")), F.col("v"))).alias(f"low_{name}"),
        F.max(F.when((F.col("w.name") == name) & inside(F.ceil("w.at")), F.col("v"))).alias(f"high_{name}"),
        F.max(F.when(F.col("w.name") == name, F.col("w.at") - F.floor("w.at"))).alias(f"part_{name}"),
    )])
    return found.select(*keys, *[(F.col(f"low_{q}") + (F.col(f"high_{q}") - F.col(f"low_{q}")) * F.col(f"part_{q}")).alias(q) for q in quantiles])
