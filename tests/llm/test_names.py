"""Every operator on a table whose other columns have the names that the operator uses itself, in another case, and on odd texts."""

import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestone.llm import quality, toxicity
from lodestone.llm.byte_bpe import encode_decode_bytes
from lodestone.llm.decontaminate import find_contamination, remove_contamination
from lodestone.llm.embedding_dedup import near_vectors
from lodestone.llm.importance import resample
from lodestone.llm.line_dedup import drop_shared_lines
from lodestone.llm.near_dedup import keep_one_of_each, near_duplicates
from lodestone.llm.pieces import encode_decode
from lodestone.llm.pii import pseudonymise
from lodestone.llm.token_shards import token_shards
from lodestone.llm.url_filter import filter_urls
from lodestone.llm.vector_codes import vector_codes

PATH = public_tokenizers.path
#: What each operator adds, its own columns and those that it uses on the way.
ADDED = {
    "op1": (lambda d, s: toxicity.score_toxicity(d, toxicity.ToxicityModel({}, 0.0)), ["score", "predicted"]),
    "op2": (lambda d, s: quality.score_quality(d, quality.QualityModel({}, 0.0, 1.0)), ["score", "predicted"]),
    "op3": (lambda d, s: token_shards(d, PATH("byte_bpe_50k.json")), None),
    "op4": (lambda d, s: drop_shared_lines(d), ["n_lines", "n_dropped"]),
    "op5": (lambda d, s: find_contamination(d, s), ["n_words", "n_hit", "spans", "items"]),
    "op5 in blocks": (lambda d, s: find_contamination(d, s, block_bytes=40), ["n_words", "n_hit", "spans", "items"]),
    "op5 cut": (lambda d, s: remove_contamination(d, s), ["n_words", "n_hit", "spans", "items"]),
    "op6": (lambda d, s: pseudonymise(d, "k"), ["n_values", "kinds"]),
    "op7": (lambda d, s: near_vectors(d.withColumn("vec_id", F.col("doc_id")).withColumn("embedding", F.array(F.lit(1.0))).withColumn("label", F.lit(1))), None),
    "op8": (lambda d, s: encode_decode(d, PATH("piece_bpe_32k.model")), ["ids", "n_tokens", "decoded"]),
    "op9": (lambda d, s: near_duplicates(d), None),
    "op9 kept": (lambda d, s: keep_one_of_each(d), []),
    "op10": (lambda d, s: filter_urls(d, [("block", "a.com/x/")], "text"), ["host", "path", "rule", "verdict"]),
    "op11": (lambda d, s: resample(d, s), None),
    "op12": (lambda d, s: encode_decode_bytes(d, PATH("byte_bpe_multi_50k.tiktoken")), ["ids", "n_tokens", "decoded"]),
    "op13": (lambda d, s: vector_codes(d.withColumn("vec_id", F.col("doc_id")).withColumn("embedding", F.array(F.lit(1.0))).withColumn("label", F.lit(1)), parts=1)[0], None),
}
CLASHES = ["Host", "PATH", "Score", "IDS", "Spans", "Items", "N_Lines", "n_HIT", "Kinds", "Rank", "Weight", "Q", "CODE", "Version", "Part", "Block", "__of", "__DOC", "__gone", "__found", "__to", "__id", "__version", "___x", "a.b"]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "some words that none but this one item has in this order", 1), (2, None, 1), (3, "another item of the benchmark", 1)], "item_id long, text string, `__doc` int")


@pytest.mark.parametrize("name", ADDED)
def test_names_in_any_case(spark, benchmark, name):
    run, added = ADDED[name]
    texts = [(1, "A line of twenty characters\nand more 12"), (1, "A line of twenty characters\nand more 12"), (2, None), (3, ""), (None, "x"), (4, "very long " * 30_000), (5, "chriſtian whıte İn")]
    docs = spark.createDataFrame([(*t, *["v"] * len(CLASHES)) for t in texts], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    out = run(docs, benchmark)
    rows = out.collect()
    assert len(rows) == len(texts) - (name == "op9 kept")
    if added is not None:
        stay = [c for c in docs.columns if c.lower() not in added]
        assert sorted(out.columns) == sorted([*stay, *added])
        assert all(r[c] == "v" for r in rows for c in stay[2:])
    assert run(docs.limit(0), benchmark).collect() == []


def test_ten_thousand_url_rules(spark):
    rules = [("block", f"h{i}.com/p{i % 7}/") for i in range(10_000)]
    pages = spark.range(40_000).select(F.format_string("http://www.h%s.com/p%s/x", F.col("id") % 12_000, F.col("id") % 7).alias("url"), "id")
    began = time.time()
    judged = filter_urls(pages, rules).groupBy("verdict").count().collect()
    want = sum(i % 12_000 < 10_000 and i % 7 == i % 12_000 % 7 for i in range(40_000))
    assert {r["verdict"]: r["count"] for r in judged} == {"block": want, "allow": 40_000 - want}
    assert time.time() - began < 60
