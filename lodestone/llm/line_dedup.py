"""Operator 4, line dedup: lines that many documents share stay in one of them.

Lines are exploded, normalised and hashed (two independent 64-bit hashes), distinct documents are counted
per hash, lines over the threshold are dropped everywhere but in the largest document id that holds them,
and the rest is reassembled by position. Only hashes and positions are shuffled for the counting; texts move
once, to meet their list of dropped positions. The shared hashes are written to the shared folder, so the join
with them is a plain one, whose hot keys adaptive execution can split.

Defined cases: a null or empty text is one empty line; rows that repeat (same id, same text) are treated
alike and count once; rows that share an id but not a text are treated one by one and count as one document;
a null id never counts as a document and never keeps a shared line; an empty table gives an empty table;
input columns called n_lines or n_dropped are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, inner, materialise, text_or_empty, without

NEW = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Replace each text by its kept lines; adds n_lines (before) and n_dropped."""
    at = inner(docs)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(text_or_empty(text_col)).alias("version"),
        F.split(text_or_empty(text_col), "\n", -1).alias("lines"),
    )
    exploded = rows.select("doc", "version", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.select("doc", "version", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    hashed = keyed.select("doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))
    shared = (
        hashed.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("doc").alias("n"), F.max("doc").alias("keeper"))
        .filter(F.col("n") >= min_docs).select("h1", "h2", "keeper")
    )
    shared = materialise(shared, "shared-lines")
    dropped = (
        hashed.join(shared, ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version").agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc").alias(f"{at}doc"), F.col("version").alias(f"{at}version"), F.col("gone").alias(f"{at}gone"))
    )
    whole = docs.select(*without(docs, *NEW), F.xxhash64(text_or_empty(text_col)).alias(f"{at}of"))
    joined = whole.join(dropped, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{at}doc")) & (F.col(f"{at}of") == F.col(f"{at}version")), "left")
    joined = joined.withColumn(f"{at}lines", F.split(text_or_empty(text_col), "\n", -1))
    positions = F.array_except(F.sequence(F.lit(0), F.size(f"{at}lines") - 1), F.col(f"{at}gone"))
    kept = F.array_join(F.transform(positions, lambda i: F.get(f"{at}lines", i)), "\n")
    text = F.when(F.col(f"{at}gone").isNull(), text_or_empty(text_col)).otherwise(kept)
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in NEW],
        F.size(f"{at}lines").cast("long").alias("n_lines"),
        F.coalesce(F.size(f"{at}gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
