"""Deduplication and upserts by key, as new DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *order: Column, keep: int = 1) -> DataFrame:
    """The first rows of each key in the given order. State nulls and ties in the order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= keep).drop("_rank")


def insert_new(target: DataFrame, staged: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Target rows and the staged rows of new keys: what exists wins."""
    return target.unionByName(latest_per_key(staged, keys, *order).join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, staged: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Staged rows and the target rows of other keys: what comes in wins."""
    incoming = latest_per_key(staged, keys, *order)
    return incoming.unionByName(target.join(incoming.select(*keys), keys, "left_anti"))


def merge_inventory(old: DataFrame, new: DataFrame, keys: list[str], first: str, last: str, total: str) -> DataFrame:
    """Ledger of ranges and totals: the earlier first, the later last, the sum."""
    both = old.select(*keys, first, last, total).unionByName(new.select(*keys, first, last, total))
    return both.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last), F.sum(total).alias(total))


def newest_active(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Marks the newest episode of each key as active, all others as not."""
    return df.withColumn("active", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions that df holds (rerunnable)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
