"""What the corpus operators share: the folder for intermediate tables, ASCII lower case, safe column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: The six ASCII white-space characters, \x20 and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "-" in spark.sparkContext.master:
        raise ValueError("local-cluster needs spark.checkpoint.dir")
    folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts lineage, survives lost executors."""
    return reread(df, name)[0]


def reread(df: DataFrame, name: str = "t") -> tuple[DataFrame, str]:
    """As materialise, with the path, for tables that can be dropped before the job ends."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, ASCII_UPPER, ASCII_LOWER))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


#: Bytes of a batch that goes to or comes from Python at a time, unless the session says otherwise; Spark's own bound is eight times that.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of whole texts, of which JVM and Python hold several at once, in a session that has Spark's default."""
    if not spark.sparkContext.getConf().contains(BATCH_SETTING) and spark.conf.get(BATCH_SETTING, "67108864b") == "67108864b":
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """As mapInArrow, for any column names (it can't take names with dots); what Arrow keeps free goes back when a task ends."""
    names = df.columns
    small_batches(df.sparkSession)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)
        pa.default_memory_pool().release_unused()

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def inner(df: DataFrame) -> str:
    """A beginning that no column name of df has, for names of columns that come and go within an operator."""
    taken = [c.lower() for c in df.columns]
    start = "__"
    while any(c.startswith(start) for c in taken):
        start += "_"
    return start


def without(df: DataFrame, *names: str) -> list[Column]:
    """All columns of df but those named in any case, as Spark compares names; quoted so that dots in names do no harm."""
    gone = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]
