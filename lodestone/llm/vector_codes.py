"""Operator 13, vector code compression: product codes fitted in integers by exponion search.

Components become floor(scale * x); vectors are cut into equal parts, each with a codebook that starts as that part of the vectors
with the smallest ids. In every round a part starts at its previous entry a (entry 0 at first) at distance r. An entry as
near as a lies within 2r of a, by the triangle inequality, so only that ball of a's distance-sorted neighbour list is scanned; the
comparison D(a, j) <= 4 r^2 is one of whole numbers, and so are all distances. Ties go to the lower index.

Tasks assign rows batch by batch and sum up parts by entry; only the sums by (part, entry, position), as many numbers as a codebook
has, come to the driver. Each round's rows, with their entries, are a table in the shared folder, which replaces the one before.

Defined cases: vectors that are null or hold null or non-finite components are dropped; the length that counts is that of the
smallest kept id whose length is a multiple of the number of parts; vectors of another length, or with components so large that
squared distances pass 64 bits (about 2^60 / length in their square, after scaling), have no part in the fit and get a null code
and error; null ids come last; rows that repeat are coded one by one; with fewer vectors than entries the codebooks are
smaller; an empty table gives an empty table; a label error that passes 64 bits is null; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialise, reread

#: Labels whose sums may be broadcast.
BROADCAST_LABELS = 200_000
#: Rows that are compared at a time.
ROWS = 8192


class Codebook:
    """The entries of one part, and each entry's neighbours by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        apart = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, -1)  # an entry is the first of its own neighbours
        self.neighbours = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.neighbours, axis=1)

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry (the lowest of equals) and its squared distance, searched from the entry start."""
        best = ((x - self.entries[start]) ** 2).sum(axis=1)
        reach = (self.apart[start] <= 4 * best[:, None]).sum(axis=1)
        order = np.argsort(-reach, kind="stable")  # rows that go on are in front
        x, origin, reach, entry, best = x[order], start[order], reach[order], start[order].copy(), best[order]
        for step in range(int(reach[0]) if len(reach) else 0):
            n = int(np.searchsorted(-reach, -step, side="left"))
            j = self.neighbours[origin[:n], step]
            d = ((x[:n] - self.entries[j]) ** 2).sum(axis=1)
            nearer = (d < best[:n]) | ((d == best[:n]) & (j < entry[:n]))
            entry[:n][nearer], best[:n][nearer] = j[nearer], d[nearer]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return entry[back], best[back]


def assign(q: np.ndarray, code: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """New codes (rows x parts) and the squared distances, summed over parts."""
    parts, width = len(books), q.shape[1] // len(books)
    out, error = np.empty_like(code), np.zeros(len(q), np.int64)
    for p, book in enumerate(books):
        for a in range(0, len(q), ROWS):
            b = a + ROWS
            out[a:b, p], d = book.nearest(q[a:b, p * width : (p + 1) * width], code[a:b, p].astype(np.int64))
            error[a:b] += d
    return out, error


def assigned(rows: DataFrame, books: list[np.ndarray], scale: int) -> DataFrame:
    """rows (id, label, q or vector, code) with code and error by these books; a row without a vector has neither."""
    raw = "vector" in rows.columns
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(b) for b in books]
        dim = sum(b.shape[1] for b in books)
        for batch in batches:
            column = batch.column("vector" if raw else "q")
            there = column.is_valid().to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            q = (np.floor(flat.astype(np.float64) * scale) if raw else flat).astype(np.int64).reshape(-1, dim)
            before = np.zeros((len(q), parts), np.uint8) if raw else np.frombuffer(b"".join(batch.column("code").drop_null().to_pylist()), np.uint8).reshape(-1, parts)
            code, error = assign(q, before, own)
            ends = np.append(0, np.cumsum(there))
            lists = pa.ListArray.from_arrays(pa.array(ends * dim, pa.int32()), pa.array(q.astype(np.int32).ravel()), mask=pa.array(~there))
            codes, errors = np.full(len(there), None, object), np.zeros(len(there), np.int64)
            codes[there], errors[there] = [c.tobytes() for c in code], error
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists, pa.array(codes, pa.binary()), pa.array(errors, pa.int64(), mask=~there)], names=["id", "label", "q", "code", "error"])

    return rows.mapInArrow(run, f"id {id_type}, label {label_type}, q array<int>, code binary, error long")


def refitted(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The books with every used entry at the floor of its parts' mean."""
    parts, entries, width = len(books), len(books[0]), books[0].shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)  # behind the sums, the number of parts
        for batch in batches:
            q = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, first = np.unique(code[order, p], return_index=True)
                total[p, used, :width] += np.add.reduceat(q[order, p], first, axis=0)
                total[p, used, width] += np.diff(np.append(first, len(q)))
        seen = np.argwhere(total[:, :, width] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(seen[:, 0], pa.int32()), pa.array(seen[:, 1], pa.int32()), pa.array(list(total[seen[:, 0], seen[:, 1]]), pa.list_(pa.int64()))], names=["part", "entry", "sums"])

    sums = rows.filter("code is not null").select("q", "code").mapInArrow(partial, "part int, entry int, sums array<long>")
    found = sums.select("part", "entry", F.posexplode("sums").alias("at", "v")).groupBy("part", "entry", "at").agg(F.sum("v").alias("v")).collect()
    totals = np.zeros((parts, entries, width + 1), np.int64)
    for r in found:
        totals[r["part"], r["entry"], r["at"]] = r["v"]
    n = totals[:, :, width:]
    return list(np.where(n > 0, totals[:, :, :width] // np.maximum(n, 1), np.stack(books)))


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, list[np.ndarray]]:
    """One row per kept vector (id, label, code as bytes, error), and the final codebooks (entries x part length each)."""
    if not 0 < entries <= 256:
        raise ValueError("a code byte holds 1 to 256 entries")
    spark = vectors.sparkSession
    v = F.col(f"`{vector_col}`")
    sound = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.alias("vector")).filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    size = F.size("vector")
    bound = F.sqrt(F.lit(2.0**60) / size) / scale
    fits = (size > 0) & (size % parts == 0) & F.forall("vector", lambda x: F.abs(x) <= bound)
    smallest = lambda rows, n: [r["vector"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(n).collect()]
    first = smallest(sound.filter(fits), entries)
    if not first:
        return sound.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), []
    dim = len(first[0])
    if any(len(x) != dim for x in first):
        first = smallest(sound.filter(fits & (size == dim)), entries)
    seeds = np.floor(np.array(first, np.float64) * scale).astype(np.int64)
    books = list(seeds.reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2))

    rows, path = reread(assigned(sound.withColumn("vector", F.when(fits & (size == dim), F.col("vector"))), books, scale), "codes")
    for _ in range(rounds):
        books = refitted(rows, books)
        new, new_path = reread(assigned(rows, books, scale), "codes")
        drop_table(spark, path)
        rows, path = new, new_path
    return rows.select("id", "label", "code", "error"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the errors of all rows of the same label (null labels together)."""
    sums = materialise(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers by part, entry and position, joined by commas."""
    return sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
