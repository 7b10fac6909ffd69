"""The queries of the corpus operators, one thin query for each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import load
from . import quality, sql, toxicity
from .byte_bpe import encode_decode_bytes
from .decontaminate import find_contamination
from .embedding_dedup import near_vectors
from .features import fold
from .importance import resample
from .line_dedup import drop_shared_lines
from .near_dedup import near_duplicates
from .pieces import encode_decode
from .pii import pseudonymise
from .token_shards import token_shards
from .url_filter import filter_urls
from .vector_codes import digest, vector_codes, with_label_error

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def tokenizer(name: str) -> str:
    """A public tokenizer's file, which every machine has at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_shards(load(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_shared_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_contamination(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a secret of the deployment: spark.lodestone.pii.key, or a fixed one for tables that are made up."""
    return pseudonymise(load(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get("spark.lodestone.pii.key", "lodestone"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(load(spark, sf_dir, "embeddings"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(load(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(load(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("n_words")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode_bytes(load(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("byte_bpe_multi_50k.tiktoken"))
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(load(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_token_shards": op3_token_shards,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_pieces": op8_pieces,
    "op9_near_dedup": op9_near_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_importance": op11_importance,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES: dict[str, str] = {
    "op4_line_dedup": sql.LINE_DEDUP,
    "op5_decontaminate": sql.DECONTAMINATE,
    "op7_embedding_dedup": sql.EMBEDDING_DEDUP,
    "op9_near_dedup": sql.NEAR_DEDUP,
    "op10_url_filter": sql.URL_FILTER,
    "op11_importance": sql.IMPORTANCE,
    "op13_vector_codes": sql.VECTOR_CODES,
}
