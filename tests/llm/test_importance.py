"""Operator 11 against plain Python."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import importance
from lodestone.llm.importance import Words, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_buckets(text, buckets=10_000):
    w = plain_words(text)
    return Counter(crc32(" ".join(w[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1))


def plain_resample(docs, target, percent, min_words):
    own, wanted = [plain_buckets(t) for _, t in docs], sum((plain_buckets(t) for t in target), Counter())
    held = sum(own, Counter())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (sum(held.values()) + 10_000) / ((held[b] + 1) * (sum(wanted.values()) + 10_000))))
    rows = []
    for (key, text), o in zip(docs, own, strict=True):
        h = int(sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) * c for b, c in o.items())
        rows.append([key, len(plain_words(text)), sum(o.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("abZ  .é中0_\n"), max_size=40), st.text(max_size=20)), min_size=1, max_size=5))
def test_postings_equal_plain_counts(texts):
    words = Words(pa.array(["skip", *texts], pa.string())[1:])
    key, n = words.postings(10_000)
    inside = int(words.text[-1]) + 1 if len(words.text) else 1
    got = {(k % inside, k // inside): c for k, c in zip(key.tolist(), n.tolist(), strict=True)}
    assert got == {(i, b): c for i, t in enumerate(texts) for b, c in plain_buckets(t).items()}


def test_long_words_and_small_chunks(monkeypatch):
    monkeypatch.setattr(importance, "WORDS", 3)
    texts = ["a " * 9 + "x" * 64 + " " + "y" * 65 + " " + "é" * 400 + " b", "", "z " * 5000]
    words = Words(pa.array(texts))
    key, n = words.postings(10_000)
    assert {(k % 3, k // 3): c for k, c in zip(key.tolist(), n.tolist(), strict=True)} == {(i, b): c for i, t in enumerate(texts) for b, c in plain_buckets(t).items()}


@pytest.mark.parametrize("blocks", [1, 64])
def test_resampling_matches_plain_python(spark, monkeypatch, blocks):
    monkeypatch.setattr(importance, "BLOCKS", blocks)
    monkeypatch.setattr(importance, "TEXTS", 7)
    r = random.Random(4)
    text = lambda: " ".join(r.choice("the old sea Sun was a stone road".split()) for _ in range(r.randrange(30)))
    docs = [(i, text()) for i in range(150)] + [(3, "again " * 25), (3, "again " * 25), (None, "sea sun " * 12), (None, None), (900, ""), (901, "word " * 30_000)]
    target = [text() for _ in range(9)] + [None, ""]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, RANK int").repartition(3)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, `a.b` int")
    out = resample(frame, wanted, percent=20)
    key = lambda row: tuple((v is None, v or 0) for v in row)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, plain_resample(docs, target, 20, 20)), key=key)


def test_nothing_to_draw_from(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    nothing = docs.limit(0)
    assert resample(nothing, docs).collect() == []
    assert {(x["doc_id"], x["n_features"], x["rank"]) for x in resample(docs, nothing).collect()} == {(1, 3, None), (2, 0, None)}


def test_many_repeats_of_a_feature(spark):
    docs = [(1, "same " * 1000), (2, "same " * 255 + "other"), (3, "same " * 256)]
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("same same",)], "text string"), percent=50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain_resample(docs, ["same same"], 50, 20)))
