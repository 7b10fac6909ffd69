"""Operator 13 against plain Python."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm.vector_codes import Codebook, assign, digest, vector_codes, with_label_error


def plain_codes(vectors, parts, entries, rounds, scale=256):
    """Codes, errors and codebooks by looking at every entry."""
    q = [[math.floor(scale * x) for x in v] for v in vectors]
    width = len(q[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in q]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            at = [nearest(c[p], books[p])[1] for c in cut]
            own = [[c[p] for c, a in zip(cut, at, strict=True) if a == e] for e in range(len(books[p]))]
            new.append([[sum(x) // len(o) for x in zip(*o, strict=True)] if o else books[p][e] for e, o in enumerate(own)])
        books = new
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return [bytes(e for _, e in f) for f in found], [sum(d for d, _ in f) for f in found], books


def test_exponion_search_finds_the_lowest_nearest_entry():
    r = np.random.default_rng(3)
    for spread, n in ((3, 40), (1000, 64), (1, 5)):
        book = Codebook(r.integers(-spread, spread + 1, (n, 4)))
        x, start = r.integers(-2 * spread, 2 * spread + 1, (500, 4)), r.integers(0, n, 500)
        d = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
        entry, best = book.nearest(x, start)
        assert (entry == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_assign_sums_over_parts():
    book = Codebook(np.array([[0, 0], [4, 0]]))
    code, error = assign(np.array([[1, 1, 4, 1]]), np.zeros((1, 2), np.uint8), [book, book])
    assert code.tolist() == [[0, 1]] and error.tolist() == [3]


def test_vectors_match_plain_python(spark):
    r = random.Random(9)
    vectors = [[r.choice([r.gauss(0, 1), 0.25, -0.5]) for _ in range(8)] for _ in range(120)]
    vectors += [vectors[3]] * 4
    rows = [(i if i < 122 else 121, v, i % 3 or None) for i, v in enumerate(vectors)]
    bad = [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [float("nan")] * 8, 2), (503, [float("inf")] * 8, 2)]
    odd = [(-7, [1.0] * 5, 1), (504, [], 2), (505, [1.0] * 16, None), (506, [1e30] * 8, 1)]
    frame = spark.createDataFrame([(*x, "more") for x in rows + bad + odd], "vec_id long, embedding array<double>, LABEL int, `a.b` string").withColumnRenamed("LABEL", "label").repartition(5)
    coded, books = vector_codes(frame, parts=4, entries=10, rounds=2)
    codes, errors, plain = plain_codes(vectors, 4, 10, 2)
    assert [b.tolist() for b in books] == plain and len(digest(books)) == 64
    out = with_label_error(coded)
    got = sorted((x["id"], x["label"] or 0, bytes(x["code"]), x["error"], x["label_error"]) for x in out.filter("code is not null").collect())
    sums = {k: sum(e for x, e in zip(rows, errors, strict=True) if x[2] == k) for k in (1, 2, None)}
    assert got == sorted((x[0], x[2] or 0, c, e, sums[x[2]]) for x, c, e in zip(rows, codes, errors, strict=True))
    assert sorted(x["id"] for x in out.filter("code is null and error is null").collect()) == [-7, 504, 505, 506]


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(2, [1.0, 2.0], None), (None, [1.0, 5.0], None)], "vec_id long, embedding array<float>, label int")
    coded, books = vector_codes(frame, parts=2, entries=64)
    assert [b.tolist() for b in books] == [[[256], [256]], [[512], [1280]]]
    assert sorted((x["id"] or 0, bytes(x["code"]), x["error"]) for x in coded.collect()) == [(0, b"\0\1", 0), (2, b"\0\0", 0)]
    empty, books = vector_codes(frame.filter(F.lit(False)))
    assert empty.collect() == [] and books == [] and with_label_error(empty).collect() == []
    other, books = vector_codes(frame, parts=3)
    assert books == [] and {x["code"] for x in other.collect()} == {None}
