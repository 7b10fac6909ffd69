"""Features of many texts at once: equal to those of one text after the other, and without a Python call for each token."""

import re
import sys
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import features
from lodestone.llm.features import SHAPE_SPACE, SHAPES, WORD_SPACE, ShapeNgrams, WordIndicators

PARTS = ["a", "B", "aB", "AAb", "ß", "ŉ", "Σ", "ΑΣ", "İ", "ǅ", "²", "½", "ⅷ", "٣", "1", "99", "_", "!!", "é", "中", "🦊", "\x00", " ", "\n", "\x1c", "\xa0", "word", "word ", "word word "]


def plain_words(text):
    words = [w.encode() for token in text.split() for w in re.findall(r"\w+", token.lower())]
    return {crc32(w) % WORD_SPACE for w in words} | {crc32(w[:k], k) % WORD_SPACE for w in words for k in (3, 4, 5) if len(w) >= k}


def plain_shapes(text):
    tokens, shapes = text.split(), []
    for i, token in enumerate(tokens):
        runs = re.findall(r"[^\W\d_]+|\d+|[\W_]+", token)
        marks = [("a" if r != r.upper() else "A") if r[0].isalpha() else "0" if r[0].isdigit() else r for r in runs]
        shapes.append(0 if i and token == tokens[i - 1] else 1 + crc32("".join(marks).encode()) % (SHAPES - 1))
    grams = {(sum(s * SHAPES ** (n - 1 - k) for k, s in enumerate(shapes[i : i + n])), n) for n in (1, 2, 3) for i in range(len(shapes) - n + 1)}
    return {((g * 3 + n - 1) * 0x9E3779B1 >> 7) % SHAPE_SPACE for g, n in grams} | {SHAPE_SPACE + w for w in plain_words(text)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=30).map("".join), st.text(max_size=20)), min_size=1, max_size=6))
def test_features_of_many_texts_equal_plain_ones(texts):
    for kind, plain in ((WordIndicators, plain_words), (ShapeNgrams, plain_shapes)):
        want = [sorted(plain(t or "")) for t in texts]
        assert [x.tolist() for x in kind().each(texts)] == want and [kind()(t).tolist() for t in texts] == want
        used = np.arange(kind.size) % 3 == 0
        assert [x.tolist() for x in kind(used).each(texts)] == [[f for f in x if f % 3 == 0] for x in want]


@pytest.mark.parametrize("kind", [WordIndicators, ShapeNgrams])
def test_features_outlive_a_full_store(kind, monkeypatch):
    monkeypatch.setattr(features, "TOKENS", 20)
    few, texts = kind(), [f"often w{i}a w{i + 1}B! often often" for i in range(60)]
    assert [few(t).tolist() for t in texts] == [kind()(t).tolist() for t in texts] and len(few.store.at) < 40


@pytest.mark.parametrize("kind", [WordIndicators, ShapeNgrams])
def test_scoring_makes_few_python_calls(spark, kind, monkeypatch):
    """Of 40,000 tokens each third one is new: under 5 calls a token, and the scores are those of the sums."""
    monkeypatch.setattr(features, "map_arrow", lambda df, run, schema: run)
    texts = [" ".join(f"new{i}x{j}, often the{j % 7}" for j in range(67)) for i in range(200)]
    weights = {int(f): 0.01 * (f % 7 - 3) for t in texts[:50] for f in kind()(t)}
    run = features.score(spark.createDataFrame([(1, "")], "doc_id long, text string"), kind, weights, 0.5, 2.0, "text", ("score", "predicted"))
    batch, calls = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["doc_id", "text"]), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        out = list(run(iter([batch])))
    finally:
        sys.setprofile(None)
    assert calls < 5 * sum(len(t.split()) for t in texts)
    want = [1 / (1 + np.exp(-0.5 - 2 * sum(weights.get(int(f), 0.0) for f in kind()(t)))) for t in texts]
    assert np.allclose([x for b in out for x in b.column(2).to_pylist()], want, atol=1e-12)
