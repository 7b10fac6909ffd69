"""Structured Streaming forms: arriving bars without repeats, and bars built from ticks as minutes complete."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import latest_per_key


def fresh_bars(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Each bar key once, however often it arrives within the delay; later arrivals are late and dropped."""
    keys = [c for c in ("symbol", "timeframe", "feed", "adjustment", "bar_ts") if c in stream.columns]
    return stream.withWatermark("bar_ts", delay).dropDuplicatesWithinWatermark(keys)


def completed_minutes(ticks: DataFrame, settle: str = "180 seconds", width: str = "1 minute") -> DataFrame:
    """OHLCV per symbol and minute, given out once the minute has settled. ticks: symbol, ts (timestamp), price, size, tick_id."""
    order = F.struct("ts", "tick_id")
    bars = ticks.withWatermark("ts", settle).groupBy("symbol", F.window("ts", width).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("size").alias("volume"), F.count("*").alias("trade_count"),
    )
    return bars.select("symbol", F.col("w.start").alias("bar_ts"), "open", "high", "low", "close", "volume", "trade_count")


def append_new(stream: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str = "bar_ts") -> StreamingQuery:
    """Append only unseen keys of each batch to a Parquet table by month of ts (a key column); a replayed batch adds nothing.

    A batch reads only the months that it holds itself. Of rows with one key the least by a hash of the whole row is taken.
    """

    def sink(batch: DataFrame, _: int) -> None:
        dated = batch.withColumn("yyyymm", F.date_format(ts, "yyyyMM"))
        months = [r[0] for r in dated.select("yyyymm").distinct().collect()]
        fresh = latest_per_key(dated, keys, F.xxhash64(*batch.columns))
        try:
            known = batch.sparkSession.read.schema(dated.schema).parquet(path).filter(F.col("yyyymm").isin(months))
            fresh = fresh.join(known.select(*keys), keys, "left_anti")
        except AnalysisException as missing:  # the table does not exist before the first batch
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        fresh.write.mode("append").partitionBy("yyyymm").parquet(path)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
