"""Cross-sectional ranks and baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def normalised_ranks(df: DataFrame, day: list[str], name: str, features: list[str]) -> DataFrame:
    """Adds n (names of the day) and, per feature, (row number - 1) / (n - 1) with ties by name.

    A task ranks one feature of a day over narrow rows, so a day's rows are not sorted whole by one task once for each feature.
    """
    rows = written(df.withColumn("row_id", F.monotonically_increasing_id()), "unranked")
    cells = rows.select("row_id", *day, F.col(name).alias("tie"), F.posexplode(F.array(*features)).alias("feature", "value"))
    by = Window.partitionBy(*day, "feature")
    place = F.row_number().over(by.orderBy(F.col("value").asc_nulls_last(), "tie")) - 1
    ranked = cells.select("row_id", "feature", F.count(F.lit(1)).over(by).alias("n"), place.alias("place"))
    rank = F.col("place").cast("double") / F.nullif(F.col("n") - 1, F.lit(0))
    wide = ranked.groupBy("row_id").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("feature") == i, rank)).alias(f"{f}_rank") for i, f in enumerate(features)])
    return rows.join(wide, "row_id").drop("row_id")


def rank_where(eligible: Column, day: list[str], *order: Column) -> Column:
    """Row number among the eligible rows of a day; null for the others."""
    return F.when(eligible, F.row_number().over(Window.partitionBy(*day, eligible).orderBy(*order)))


def ordered_names(name: str, rank: str, top: int) -> Column:
    """Names of rank 1 to top, in order, as an aggregate; empty if there is none."""
    picked = F.collect_list(F.when(F.col(rank) <= top, F.struct(F.col(rank).alias("r"), F.col(name).alias("s"))))
    return F.transform(F.array_sort(picked), lambda x: x["s"])


def tail_state(x: Column, low: Column, high: Column) -> Column:
    """LOW or HIGH of frozen quantiles, ties included; else MID."""
    return F.when(x <= low, "LOW").when(x >= high, "HIGH").when(x.isNotNull(), "MID")
