"""Operator 5, benchmark decontamination: an FM-index per training shard, searched for the benchmark's phrases.

The words of the benchmark form the alphabet; any other word of a document ends a sequence, as it can be
part of no phrase. Each task indexes its documents shard by shard (a bounded number of symbols, whole
documents), searches all windows backwards, locates their occurrences by sampled suffix positions and merges
the words they cover into removal spans.

The benchmark is sent to the tasks in blocks of bounded size (block_bytes), each with a pass of its own, so
nothing unbounded is broadcast.

Defined cases: a null or empty text has no words and no hits; benchmark rows without text, words or id hold
no windows; items that repeat count once; documents that repeat are searched each; empty tables work; input
columns that have the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import inner, map_arrow, without
from .fm_index import FMIndex

#: Bytes that are no part of a word are made spaces, A-Z lower case; words are digits, a-z and all beyond ASCII.
FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
WORD = re.compile(rb"[^ ]+")
NEW = ("n_words", "n_hit", "spans", "items")
RESULT = "n_words long, n_hit long, spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class Phrases:
    """The windows of benchmark items as rows of word numbers (from 1), by length, with their items."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = []
        number: dict[tuple, int] = {}
        owners: list[set[int]] = []
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            self.names.append(name)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                key = tuple(words[i : i + window])
                if number.setdefault(key, len(number)) == len(owners):
                    owners.append(set())
                owners[number[key]].add(len(self.names) - 1)
        self.owners = [np.array(sorted(x)) for x in owners]
        by_length: dict[int, list[tuple]] = {}
        for key in number:
            by_length.setdefault(len(key), []).append(key)
        self.groups = [(np.array([number[k] for k in keys]), np.array(keys)) for keys in by_length.values()]


class Shard:
    """Documents gathered until there are enough for an index: their symbols, runs of foreign words made one 0."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.symbols, self.places, self.n_words, self.size = phrases, [], [], [], 0

    def add(self, text: str | None) -> None:
        words = words_of(text)
        ids = np.fromiter(map(self.phrases.vocabulary.get, words, repeat(0)), np.int32, len(words))
        keep = np.flatnonzero((ids > 0) | np.append(True, ids[:-1] > 0))
        self.symbols.append(np.append(ids[keep], 0))
        self.places.append(np.append(keep, -1))
        self.n_words.append(len(words))
        self.size += len(keep) + 1

    def search(self) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        """For each document: its words, which of them are hit (start and stop of spans), names of items found."""
        hits = self._occurrences()
        for d, n in enumerate(self.n_words):
            spans, items = hits.get(d, (np.empty((0, 2), np.int64), []))
            yield n, spans, items

    def _occurrences(self) -> dict[int, tuple[np.ndarray, list[str]]]:
        if not self.size or not self.phrases.owners:
            return {}
        text = np.concatenate(self.symbols)
        symbols = len(self.phrases.vocabulary) + 1
        index = FMIndex(text.astype(np.uint16 if symbols < 65536 else np.int32), symbols)
        where, which, length = [], [], []
        for numbers, rows in self.phrases.groups:
            low, high = index.ranges(rows)
            found = np.flatnonzero(high > low)
            for at in np.array_split(found, max(1, ceil((high - low).sum() / 1_000_000))):
                n = (high - low)[at]
                suffixes = np.repeat(low[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
                where.append(index.locate(suffixes))
                which.append(np.repeat(numbers[at], n))
                length.append(np.full(n.sum(), rows.shape[1]))
        where, which, length = map(np.concatenate, (where, which, length))
        if not len(where):
            return {}
        bounds = np.cumsum([len(s) for s in self.symbols])
        places, doc = np.concatenate(self.places), np.searchsorted(bounds, where, side="right")
        first = places[where]
        by = np.lexsort((first, doc))
        doc, first, last, which = doc[by], first[by], (first + length)[by], which[by]
        out = {}
        for d in np.unique(doc):
            own = slice(*np.searchsorted(doc, [d, d + 1]))
            reach = np.maximum.accumulate(last[own])
            new = np.append(True, first[own][1:] > reach[:-1])
            spans = np.column_stack((first[own][new], np.append(reach[:-1][new[1:]], reach[-1])))
            owners = np.unique(np.concatenate([self.phrases.owners[w] for w in np.unique(which[own])]))
            out[int(d)] = spans, sorted({self.phrases.names[o] for o in owners})
        return out


def scan(batches: Iterator[pa.RecordBatch], phrases: Phrases, text_col: str, shard_symbols: int, schema: pa.Schema, cut: bool = False) -> Iterator[pa.RecordBatch]:
    """Whole documents in, the same rows with word counts, hit spans (in words) and item names out; with cut, the texts without the spans."""

    def done(held: list[pa.RecordBatch], shard: Shard) -> Iterator[pa.RecordBatch]:
        results = shard.search()
        for batch in held:
            own = [next(results) for _ in range(batch.num_rows)]
            columns = [
                pa.array([n for n, _, _ in own], pa.int64()),
                pa.array([int((s[:, 1] - s[:, 0]).sum()) for _, s, _ in own], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in s.tolist()] for _, s, _ in own], schema.field("spans").type),
                pa.array([i for _, _, i in own], schema.field("items").type),
            ]
            kept = dict(zip(batch.schema.names, batch.columns, strict=True))
            if cut:
                kept[text_col] = pa.array([cut_spans(t, [{"start": a, "stop": b} for a, b in s.tolist()]) for t, (_, s, _) in zip(kept[text_col].to_pylist(), own, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*kept.values(), *columns], names=[*kept, *NEW])

    held, shard = [], Shard(phrases)
    for batch in batches:
        for piece in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
            for text in piece.column(text_col).to_pylist():
                shard.add(text)
            held.append(piece)
            if shard.size >= shard_symbols:
                yield from done(held, shard)
                held, shard = [], Shard(phrases)
    if held:
        yield from done(held, shard)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, block_bytes: int = 16_000_000, shard_symbols: int = 500_000, cut: bool = False,
) -> DataFrame:
    """Adds n_words, n_hit, spans (hit words as [start, stop) word numbers, merged) and items (names, sorted).

    With cut the texts lose their hit spans. Every block_bytes of benchmark is a pass over all documents.
    """
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text")).dropna()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / block_bytes))
    plain = docs.select(*without(docs, *NEW))
    schema = T.StructType([*plain.schema.fields, *T._parse_datatype_string(RESULT).fields])
    arrow = pa.schema([("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.string()))])

    def one(block: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        phrases = Phrases(((r["item"], r["text"]) for r in own), window)
        return map_arrow(plain, lambda b: scan(b, phrases, text_col, shard_symbols, arrow, cut and blocks == 1), schema)

    if blocks == 1:
        return one(0)
    at = inner(docs)
    found = one(0)
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    more = None
    for block in range(1, blocks):
        part = one(block).filter("n_hit > 0").select(F.col(f"`{id_col}`").alias(f"{at}doc"), key.alias(f"{at}version"), F.col("spans").alias(f"{at}spans"), F.col("items").alias(f"{at}items"))
        more = part if more is None else more.unionByName(part)
    more = more.groupBy(f"{at}doc", f"{at}version").agg(F.flatten(F.collect_set(f"{at}spans")).alias(f"{at}spans"), F.flatten(F.collect_set(f"{at}items")).alias(f"{at}items"))
    joined = found.withColumn(f"{at}of", key).join(more, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{at}doc")) & (F.col(f"{at}of") == F.col(f"{at}version")), "left")
    spans = merge_spans(F.concat("spans", F.coalesce(f"{at}spans", F.array().cast("array<struct<start:int,stop:int>>"))))
    joined = joined.withColumn("spans", spans).withColumn("items", F.sort_array(F.array_distinct(F.concat("items", F.coalesce(f"{at}items", F.array().cast("array<string>"))))))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    found = joined.withColumn("n_hit", hit).select(*[f"`{c}`" for c in schema.names])
    return without_spans(found, text_col) if cut else found


def merge_spans(spans):
    """Sorted, overlapping and touching [start, stop) spans made one."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def step(acc, span):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["stop"] >= span["start"]), joined).otherwise(F.concat(acc, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, step)


def cut_spans(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans (numbers of words) and what stands between those words."""
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
    out, at = [], 0
    for span in spans:
        out.append(raw[at : words[span["start"]][0]])
        at = words[span["stop"] - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def without_spans(found: DataFrame, text_col: str) -> DataFrame:
    """The rows with their spans cut out of the texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(text_col).to_pylist(), batch.column("spans").to_pylist()
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[text_col] = pa.array(list(map(cut_spans, texts, spans)), pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return map_arrow(found, cut, found.schema)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """As find_contamination, with the hit spans cut out of the texts."""
    return find_contamination(docs, benchmark, text_col=text_col, cut=True, **options)
