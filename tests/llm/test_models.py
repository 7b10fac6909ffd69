"""Classifiers by held-out accuracy; tokens, pieces and wavelet matrices by round trips against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import quality, toxicity
from lodestone.llm.features import ShapeNgrams, Sparse, WordIndicators, change, collected, fold, sigmoid, training_sample
from lodestone.llm.fm_index import FMIndex
from lodestone.llm.pieces import encode_decode, model_of
from lodestone.llm.token_shards import Encoder, token_shards
from lodestone.llm.wavelet import WaveletMatrix

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = ["", " ", "\n\n a", "a\tb  c\xa0d", "it's 12,5 né\r\n x", "🦊▁ 中文 ", "a" * 3000, "ab" * 999 + " ", "<|endoftext|>", "\x00\x1c y", "word\n word\n\n  next", "=-=-=-" * 200]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=300))
def test_wavelet_matrix(values):
    v = np.array(values, np.uint32)
    w = WaveletMatrix.from_bytes(WaveletMatrix.build(v, 9).to_bytes())
    assert (w.to_array() == v).all() and (w.access(np.arange(len(v))) == v).all()
    s = int(v[len(v) // 2])
    assert (w.select(s, np.arange(w.count(s))) == np.flatnonzero(v == s)).all()
    at = np.arange(len(v) + 1)
    assert (w.rank(np.full(len(at), s), at) == np.append(0, np.cumsum(v == s))).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=120), st.integers(1, 6))
def test_fm_index(values, length):
    text = np.array([*values, 0], np.uint16)
    index = FMIndex(text, 4, every=5)
    phrases = {tuple(text[i : i + length].tolist()) for i in range(len(text) - length + 1) if text[i : i + length].all()} | {(1,) * length}
    rows = np.array(sorted(phrases))
    for phrase, low, high in zip(rows, *index.ranges(rows), strict=True):
        assert sorted(index.locate(np.arange(low, high)).tolist()) == [i for i in range(len(text) - length + 1) if (text[i : i + length] == phrase).all()]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abc  \n\té中🦊▁1-th'"), max_size=60))
def test_encoders_equal_the_libraries(text):
    model, store = model_of(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, counts = store.texts([model.words(text)])
    assert ids.tolist() == sp.encode(text) and model.decode(ids, counts) == [sp.decode(sp.encode(text))]


ENCODER, LIBRARY = Encoder(BPE, pieces=300, words=100), Tokenizer.from_file(BPE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abcÉ  \n\n\t\r\x85é中🦊<|>1-th's.,", "<|endoftext|>", "\n \n", "it's", "can't", " 12", "%%", " a", "\nb"]), max_size=40).map("".join), max_size=8))
def test_token_ids_equal_the_library(texts):
    flat, counts = ENCODER(pa.array([*texts, None], pa.string()))
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [*map(len, want), 0] and flat.tolist() == [i for x in want for i in x]


def test_token_ids_of_long_texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinsréñ") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", "!%", "'s", "7"])
    texts = [rng.choice([" ", "\n", "\n\n", " "]).join(word() for _ in range(rng.randint(0, 300))) for _ in range(30)] + ["x " * 300_000, "y" * 20_000]
    flat, counts = ENCODER(pa.array(texts))
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and flat.tolist() == [i for x in want for i in x]


def test_store_shrinks():
    from lodestone.llm.wordstore import WordStore

    store = WordStore(lambda words: (np.array([int(w) for w in words], np.uint32), np.ones(len(words), np.int64)), words=20)
    for i in range(30):
        ids, counts = store.texts([["7", str(i), "7"], [], [str(i + 1)] * 3])
        assert ids.tolist() == [7, i, 7, i + 1, i + 1, i + 1] and counts.tolist() == [3, 0, 3]


def test_wavelet_file_unpacks_only_what_is_asked():
    v = np.random.default_rng(2).integers(0, 1 << 10, 900_000).astype(np.uint32)
    data = WaveletMatrix.build(v, 10).to_bytes()
    w, loaded = WaveletMatrix.from_bytes(data), lambda w: sum(int(p.loaded.sum()) for p in w.planes)
    assert w.access(np.array([5, 700_000])).tolist() == v[[5, 700_000]].tolist() and loaded(w) <= 20 < sum(len(p.loaded) for p in w.planes)
    w = WaveletMatrix.from_bytes(data)
    assert w.count(77) == int((v == 77).sum()) and w.select(77, np.array([3]))[0] == np.flatnonzero(v == 77)[3] and loaded(w) <= 60
    w = WaveletMatrix.from_bytes(data)
    assert (w.select(77, np.arange(w.count(77))) == np.flatnonzero(v == 77)).all() and (w.to_array() == v).all()


def test_rows_of_one_id_are_ordered_by_text_over_partitions(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sorted(token_shards(docs, BPE).collect(), key=lambda r: r["start"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [bytes(r["tokens"]) for r in rows] == [np.array([*LIBRARY.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in sorted(texts)]


def test_token_shards_round_trip(spark):
    texts = [*ODD_TEXTS, None, "a<|endoftext|>b"]
    docs = spark.createDataFrame([(100 - i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (3, "twice", "x"), (3, "twice", "x"), (3, None, "x")], "doc_id long, text string, start string")
    library = Tokenizer.from_file(BPE)
    want, start = [], 0
    for i, t in sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["tokens"]))) for r in token_shards(docs, BPE, shard_tokens=200).collect()), key=lambda x: x[1])
    assert got == want
    assert token_shards(docs.limit(0), BPE).count() == 0


def test_encode_decode_frame(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*ODD_TEXTS, None] * 2)], "doc_id long, text string, ids int")
    for r in encode_decode(docs, PIECES).collect():
        ids = sp.encode(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == sp.decode(ids)
    assert encode_decode(docs.limit(0), PIECES).count() == 0


def sentences(n, seed, told=1.0):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(3, 30))]
        bad = rng.random() < 0.3
        group = rng.random() < (0.8 if bad else 0.1)
        words += [rng.choice(["vilest", "scumly"])] * (bad and rng.random() < told) + [rng.choice(["women", "muslims", "gay"])] * group
        rng.shuffle(words)
        out.append((i, " ".join(words), int(bad)))
    return out


def test_counterfactuals_free_identity_terms():
    rows = sentences(600, 1, told=0.5)
    f, swap = WordIndicators(), toxicity.swapper(toxicity.IDENTITY_GROUPS)
    x, y = [f(t) for _, t, _ in rows], np.array([b for _, _, b in rows])
    others = [[change(f(t), f(v)) for v in swap(t)] for _, t, _ in rows]
    score = lambda m, t: sum(m.weights.get(int(k), 0.0) for k in f(t)) + m.bias
    free, plain = toxicity.fit(x, y, others, counterfactual=30.0), toxicity.fit(x, y, [[] for _ in x])
    moved = lambda m: abs(score(m, "the muslims met") - score(m, "the hindus met"))
    assert moved(free) < 0.5 * moved(plain) and moved(plain) > 0.2
    told = [t for _, t, b in sentences(300, 2) if b]
    neutral = [t for _, t, b in sentences(300, 3) if not b and swap(t)]
    assert np.mean([score(free, t) >= 0 for t in told]) > 0.9
    assert np.mean([score(free, t) >= 0 for t in neutral]) < 0.5 * np.mean([score(plain, t) >= 0 for t in neutral])
    assert swap("Gay men") == ["lesbian women", "transgender women"]


@pytest.mark.parametrize("terms", [("women", "muslims", "gay"), ("Frauen", "Muslime", "Schwule"), ("femmes", "musulmans", "gays"), ("mujeres", "musulmanes", "homosexuales")])
def test_counterfactuals_work_at_the_default_weight(terms):
    named = dict(zip(("women", "muslims", "gay"), terms, strict=True))
    rows = [(" ".join(named.get(w, w) for w in t.split()), b) for _, t, b in sentences(600, 1, told=0.5)]
    f, swap = WordIndicators(), toxicity.swapper(toxicity.IDENTITY_GROUPS)
    x, y = [f(t) for t, _ in rows], np.array([b for _, b in rows])
    free, plain = toxicity.fit(x, y, [[change(f(t), f(v)) for v in swap(t)] for t, _ in rows]), toxicity.fit(x, y, [[] for _ in x])
    score = lambda m, t: sum(m.weights.get(int(k), 0.0) for k in f(t)) + m.bias
    for term in terms:
        moved = lambda m: abs(score(m, f"x {term} y") - score(m, swap(f"x {term} y")[0]))  # noqa: B023, E731
        assert moved(plain) > 0.2 and moved(free) < 0.1 * moved(plain)


def test_counterfactuals_of_texts_without_terms():
    variants = toxicity.counterfactuals(toxicity.IDENTITY_GROUPS)
    for text in ("", "a b c", "no such term in this"):
        (bare, one), (again, two), swapped = variants(text)
        assert bare == again == text and swapped == (one, two)
        terms = [next(w for w in v.split(" ") if w and w not in text.split(" ")) for v in (one, two)]
        assert terms[0] != terms[1] and any(set(terms) <= set(g) for g in toxicity.IDENTITY_GROUPS)
        assert [w for w in one.split(" ") if w != terms[0]] == text.split(" ")
    assert variants("Gay men") == [("Gay men", "lesbian women"), ("Gay men", "transgender women")]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(["chriſtian", "whıte", "İnmigrantes", "WEISSE", "weiße", "Gay", "MEN", "x", "ﬁn"]), max_size=5).map(" ".join)))
def test_any_text_has_counterfactuals(text):
    assert all(isinstance(a, str) and a != b for a, b in toxicity.counterfactuals(toxicity.IDENTITY_GROUPS)(text))


def test_terms_are_found_whatever_their_case():
    swap = toxicity.swapper(toxicity.IDENTITY_GROUPS)
    assert swap("CHRISTIAN") == swap("chriſtian") == ["jewish", "muslim"] and swap("WEISSE")[0] == swap("weiße")[0] and swap("whıte") == []
    with pytest.raises(ValueError, match="single"):
        toxicity.swapper((("two words", "x"),))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_penalty_acts_on_the_given_tables(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows, y, changes = collected(training_sample(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0, 10_000), WordIndicators, toxicity.counterfactuals(toxicity.IDENTITY_GROUPS))
    terms = toxicity.term_features(toxicity.IDENTITY_GROUPS)
    free, plain = (toxicity.fit(rows, y, changes, counterfactual=weight, keep=terms) for weight in (1.0, 0.0))
    assert free.pairs == plain.pairs >= 2 * len(y) > 0 and free.change < 0.7 * plain.change and free.filled > 0.9


def brute_toxicity(x, y, more, less, l1, weight):
    """Plain proximal gradient on dense matrices, many small steps."""
    w, bias = np.zeros(x.shape[1]), 0.0
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    step = 1 / (0.25 * np.linalg.norm(x.T @ (x * balance[:, None] / len(y)), 2) + weight * np.linalg.norm((more - less).T @ (more - less) / len(more), 2) + 0.5)
    for _ in range(60_000):
        r = balance * (sigmoid(x @ w + bias) - y) / len(y)
        z = w - step * (x.T @ r + weight / len(more) * (more - less).T @ ((more - less) @ w))
        w, bias = np.sign(z) * np.maximum(np.abs(z) - step * l1, 0), bias - step * r.sum()
    loss = (balance * np.logaddexp(0, -(2 * y - 1) * (x @ w + bias))).mean() + l1 * np.abs(w).sum() + weight / 2 * (((more - less) @ w) ** 2).mean()
    return w, bias, loss


def test_toxicity_fit_equals_a_plain_minimiser():
    rng = np.random.default_rng(6)
    x = (rng.random((90, 12)) < 0.4).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.random(90) > 1.1).astype(int)
    other = x.copy()
    other[:, 1], other[:, 2] = 0, 1
    rows, others = ([np.flatnonzero(r) for r in m] for m in (x, other))
    model = toxicity.fit(rows, y, [[change(a, b)] for a, b in zip(rows, others, strict=True)], l1=5e-3, counterfactual=0.7, min_rows=1, steps=6000)
    w, bias, _ = brute_toxicity(x, y, np.maximum(other - x, 0), np.maximum(x - other, 0), 5e-3, 0.7)
    assert np.allclose([model.weights.get(i, 0.0) for i in range(12)], w, atol=2e-3) and abs(model.bias - bias) < 2e-3


def test_quality_fit_equals_a_plain_minimiser():
    rng = np.random.default_rng(7)
    dense = (rng.random((60, 9)) < 0.4).astype(float)
    dense[:, 8] = 1
    y = (dense[:, 0] - dense[:, 1] + 0.6 * rng.random(60) > 0.3).astype(int)
    x = Sparse([np.flatnonzero(r) for r in dense], 9)
    r = quality.log_count_ratio(x, y)
    p, q = 1 + dense[y == 1].sum(axis=0), 1 + dense[y == 0].sum(axis=0)
    assert np.allclose(r, np.log((p / p.sum()) / (q / q.sum())))
    found = quality.dual_coordinate_descent(x, r, y, np.arange(60), c=0.3, epochs=3000)
    scale = 1 / np.sqrt(max(1.0, (dense @ (r * r)).mean()))
    z, sign = np.column_stack((dense * r * scale, np.ones(60))), 2.0 * y - 1
    cost = 0.3 * np.where(sign > 0, 30 / (sign > 0).sum(), 30 / (sign < 0).sum())
    loss = lambda w: w @ w / 2 + (cost * np.maximum(0, 1 - sign * (z @ w))).sum()
    w = np.zeros(10)
    for i in range(200_000):  # plain subgradient descent on the primal
        active = sign * (z @ w) < 1
        w -= (w - ((cost * sign)[active, None] * z[active]).sum(axis=0)) / (i + 2)
    own = np.append(np.divide(found[:9], r * scale, out=np.zeros(9), where=r != 0), found[9])
    assert loss(own) <= loss(w) + 1e-3 and abs(loss(own) - loss(w)) < 2e-2 * loss(w)


def test_training_ignores_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"w{i % 3} vile" if i % 2 else "fine text", 9, 9, "x") for i in range(60)], "doc_id long, text string, y int, __id int, `a.b` string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2, "t") for i in range(60)], "doc_id long, toxic int, quality int, text string")
    for module, score in ((toxicity, toxicity.score_toxicity), (quality, quality.score_quality)):
        out = score(docs, module.train(docs, labels))
        assert out.columns == [*docs.columns, "score", "predicted"] and out.count() == 60


def test_identity_terms_are_in_one_group():
    terms = [t for g in toxicity.IDENTITY_GROUPS for t in g]
    assert len(terms) == len(set(terms)) and toxicity.swapper(toxicity.IDENTITY_GROUPS)("Hindus") == ["buddhists", "jews"]


@pytest.mark.parametrize("module, frame", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_frames(spark, module, frame):
    rows = sentences(400, 4) if module is toxicity else [(i, ("w x" if i % 5 else "A!! B!!") + f" t{i % 7}", int(i % 5 > 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, 5.0) for i, t, _ in rows] + [(None, None, 0.0), (900, "", 0.0), (901, "w" * 100_000, 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (7, 9)], f"doc_id long, {frame} int")
    score = module.score_toxicity if module is toxicity else module.score_quality
    out = score(docs, module.train(docs, labels)).collect()
    truth = {i: y for i, _, y in rows}
    assert len(out) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    folds, held = (5, 0) if module is toxicity else (3, 1)
    test = [r for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % folds == held]
    assert len(test) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in test]) > 0.93
    empty = module.train(docs, labels.limit(0))
    assert {r["predicted"] for r in score(docs, empty).collect()} == {0 if module is toxicity else 1}
    assert score(docs.limit(0), empty).count() == 0


def test_quality_features_see_repeats_and_count_ratios():
    f = ShapeNgrams()
    assert set(f("x x x")) != set(f("x y z")) and len(f("")) == 0 and len(f(None)) == 0
    x = Sparse([np.array([0, 1]), np.array([1])], 3)
    r = quality.log_count_ratio(x, np.array([1, 0]))
    assert r[0] > 0 > r[1]
