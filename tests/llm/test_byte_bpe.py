"""Operator 12 against the untouched library: pieces, ids, decoded bytes."""

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm.byte_bpe import LONG, ByteBpe, Encoder, encode_decode_bytes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODER = Encoder(RANKS, pieces=200)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.bpe.ranks, special_tokens={})


def agree(texts):
    ids, counts = ENCODER(pa.array(texts, pa.string()))
    want = [LIBRARY.encode_ordinary(t or "") for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert ENCODER.bpe.decode(ids, counts).to_pylist() == [(t or "").encode() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab  \n\r\t's're'll'vedtm.!12é中\u0085\xa0\x1cſİ٣½🦊\x00"), max_size=30), max_size=5))
def test_texts_equal_the_library(texts):
    agree(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_any_characters_equal_the_library(texts):
    agree(texts)


def test_every_code_point_is_in_the_librarys_class():
    agree(["".join(f"a{chr(c)}1{chr(c)} {chr(c)}'s" for c in range(begin, begin + 4096) if not 0xD800 <= c < 0xE000) for begin in range(0, 0x30000, 4096)])


@pytest.mark.parametrize("n", [1, 2, 8, 9, 16, 17, LONG - 1, LONG, LONG + 1, 5000])
def test_pieces_of_all_sizes(n):
    agree(["a" * n, " " + "ab" * n, "abcab" * n + "\n", "中" * n, "!?" * n, " " * n, " " * n + "x", None, ""])


def test_trees_in_step_equal_trees_alone():
    bpe = ENCODER.bpe
    words = [b"tokenization", b"aaaaaaaaaaaa", b"zqzqzqzqzqzq"]
    import numpy as np

    rows = bpe.byte_ids[np.array([list(w) for w in words])]
    assert [r[r >= 0].tolist() for r in bpe.merge_rows(rows)] == [bpe.merge_long(r.tolist()) for r in rows]


def test_files_without_every_byte_are_refused(tmp_path):
    (tmp_path / "few.tiktoken").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="every byte"):
        ByteBpe(str(tmp_path / "few.tiktoken"))


def test_frames(spark):
    rows = [(1, "Tiny words", 5), (1, "Tiny words", 5), (2, None, None), (None, "", 6), (3, "x " * 60_000, 7), (4, "it's\n\n 12", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, `a.text` string, IDS int").withColumnRenamed("a.text", "a.b")
    out = encode_decode_bytes(docs, RANKS, "a.b")
    assert out.columns == ["doc_id", "a.b", "ids", "n_tokens", "decoded"]
    got = sorted((r[0] or 0, r[1] or "", list(r["ids"]), r["n_tokens"], bytes(r["decoded"])) for r in out.collect())
    want = sorted((a or 0, b or "", LIBRARY.encode_ordinary(b or ""), len(LIBRARY.encode_ordinary(b or "")), (b or "").encode()) for a, b, _ in rows)
    assert got == want
    assert encode_decode_bytes(docs.limit(0), RANKS, "a.b").collect() == []
    replaced = encode_decode_bytes(docs.select("doc_id", docs["`a.b`"].alias("Decoded")), RANKS, "Decoded")
    assert replaced.columns == ["doc_id", "ids", "n_tokens", "decoded"] and replaced.filter("n_tokens > 0").count() == 4


def test_query(spark, tmp_path):
    import __spark_entry__

    texts = [(1, "Hello  world's\n"), (2, None), (3, "né " * 50)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in __spark_entry__.queries()["op12_byte_bpe"](spark, str(tmp_path)).collect()}
    for key, text in texts:
        ids = LIBRARY.encode_ordinary(text or "")
        assert got[key]["n_tokens"] == len(ids)
        assert got[key]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
