"""Readers, and the tables that stand in for market data in the test folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bars import bars_from_ticks
from ..session import load

BAR = T.StructType([T.StructField("t", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in "ohlc"], T.StructField("v", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("vw", T.DoubleType())])
BAR_PAGE = T.StructType([T.StructField("bars", T.MapType(T.StringType(), T.ArrayType(BAR))), T.StructField("next_page_token", T.StringType())])
EVENT = T.MapType(T.StringType(), T.ArrayType(T.MapType(T.StringType(), T.StringType())))


def read_bar_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages {bars: {symbol: [{t, o, h, l, c, v, n, vw}]}} as one row per bar."""
    pages = spark.read.schema(BAR_PAGE).json(path)
    bars = pages.select(F.explode("bars").alias("symbol", "rows")).select("symbol", F.explode("rows").alias("b"))
    ts = F.to_timestamp(F.regexp_replace("b.t", r"(\.\d{6})\d+", "$1")).cast("timestamp_ntz")
    return bars.select("symbol", ts.alias("bar_ts"), F.col("b.o").alias("open"), F.col("b.h").alias("high"), F.col("b.l").alias("low"), F.col("b.c").alias("close"), F.col("b.v").cast("long").alias("volume"), F.col("b.n").alias("trade_count"), F.col("b.vw").alias("vwap"))


#: Microseconds, which the default format of CSV files would cut to milliseconds.
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def stage_csv(df: DataFrame, path: str) -> None:
    """Staging area: gzip CSV with a header."""
    df.write.mode("overwrite").option("compression", "gzip").option("header", True).option("timestampNTZFormat", STAMP).csv(path)


def read_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", STAMP).csv(path)


def write_monthly(df: DataFrame, path: str, ts: str = "bar_ts") -> None:
    """Table partitioned by month, sorted by symbol and time inside; only the months at hand are replaced."""
    month = df.withColumn("yyyymm", F.date_format(ts, "yyyyMM"))
    ordered = month.repartition("yyyymm", "symbol").sortWithinPartitions("yyyymm", "symbol", ts)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("yyyymm").parquet(path)


def known_assets(active: DataFrame, inactive: DataFrame) -> DataFrame:
    """Union of both lists; of a symbol in both, the active row."""
    from ..operators.keyed import latest_per_key

    both = active.withColumn("is_active", F.lit(True)).unionByName(inactive.withColumn("is_active", F.lit(False)), allowMissingColumns=True)
    return latest_per_key(both, ["symbol"], F.col("is_active").desc())


def corporate_events(payload: DataFrame, column: str = "payload") -> DataFrame:
    """JSON map of action type to list of events, one row per event."""
    typed = payload.select(F.from_json(column, EVENT).alias("m")).select(F.explode("m").alias("action_type", "events"))
    return typed.select("action_type", F.explode("events").alias("event"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as ticks: symbol = event type, price = value, size = props.k."""
    size = F.get_json_object("props", "$.k").cast("long")
    return load(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").alias("price"), size.alias("size"), F.col("event_id").alias("tick_id"), "user_id")


def bars(spark: SparkSession, sf_dir: str, minutes: int = 15) -> DataFrame:
    return bars_from_ticks(ticks(spark, sf_dir), minutes, f"{minutes}Min")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily panel by user: six features and the next day's open and close."""
    from pyspark.sql import Window

    from ..operators.bars import first_by, last_by

    t = ticks(spark, sf_dir).withColumn("symbol", F.concat(F.lit("U"), F.col("user_id"))).withColumn("signal_date", F.col("ts").cast("date"))
    day = t.groupBy("symbol", "signal_date").agg(
        first_by("price", "ts", "tick_id").alias("open"), last_by("price", "ts", "tick_id").alias("close"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum("size").alias("volume"), F.count("*").alias("n_ticks"),
    )
    nxt = Window.partitionBy("symbol").orderBy("signal_date")
    return day.withColumn("next_open", F.lead("open").over(nxt)).withColumn("next_close", F.lead("close").over(nxt))
