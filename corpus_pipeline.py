"""A corpus pipeline of five stages; each stage's result is written as Parquet and read as the next one's documents.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents, with n_chars kept true to
the text. A row with a null text passes through as an empty or null text; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import toxicity
from lodestone.llm.common import materialise
from lodestone.llm.decontaminate import remove_contamination
from lodestone.llm.line_dedup import drop_shared_lines
from lodestone.llm.near_dedup import keep_one_of_each
from lodestone.llm.pieces import encode_decode
from lodestone.llm.queries import tokenizer
from lodestone.session import load


def as_documents(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs; n_chars, if there is one, counted anew."""
    return found.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier (operator 1, fitted on the corpus' labels) doesn't reject."""
    model = toxicity.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), model)
    return scored.filter("predicted = 0").select(*[f"`{c}`" for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share (operator 4)."""
    return as_documents(drop_shared_lines(docs), docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 9)."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that benchmark items hold too (operator 5)."""
    return as_documents(remove_contamination(docs, load(spark, sf_dir, "benchmark")), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text (operator 8)."""
    return encode_decode(docs.select("doc_id", "text"), tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", decontaminate),
    ("pieces", encode),
]

#: No SQL can express the classifier's fit or the piece encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
