"""Hashed features of texts for the linear classifiers, and their training sample."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, without
from .wordstore import WordStore, small_slices

WORD = re.compile(r"\w+")
WORD_OR_SPACE = re.compile(r"\w+| ")
RUN = re.compile(r"[^\W\d_]+|\d+|[\W_]+")
WORD_SPACE, SHAPE_SPACE, SHAPES = 1 << 20, 1 << 18, 1 << 9
#: Tokens whose features a task keeps, and characters of the texts that it takes at a time.
TOKENS, SLICE = 100_000, 1_000_000


def word_features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each word of the tokens, and its first 3, 4 and 5 bytes, so that unseen endings still tell: features, flat, and the token each is of."""
    parts = WORD_OR_SPACE.findall(" ".join(tokens).lower())
    space = np.fromiter([p == " " for p in parts], bool, len(parts))
    words = [p.encode("utf-8", "surrogatepass") for p in parts if p != " "]
    length = np.fromiter(map(len, words), np.int64, len(words))
    found = np.array([list(map(crc32, words)), *([crc32(w[:k], k) for w in words] for k in (3, 4, 5))], np.uint32).T % WORD_SPACE
    there = length[:, None] >= np.array([1, 3, 4, 5])
    return found[there], np.repeat(np.cumsum(space)[~space], there.sum(axis=1))


def shape_of(token: str) -> str:
    """The token's shape: letters by case, digits, and its other characters as they are."""
    return "".join(("a" if run != run.upper() else "A") if run[0].isalpha() else "0" if run[0].isdigit() else run for run in RUN.findall(token))


class Marks(dict):
    """What each character is in a shape, by code; a character that counts by what stands before it (a number, but no digit) is RARE."""

    RARE = "\xb2"

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = mark = "0" if c.isdecimal() else c if not c.isalnum() else self.RARE if not c.isalpha() else "A" if c == c.upper() else "a"
        return mark


MARKS = Marks()
#: Runs of upper-case letters become one, then runs of letters, then runs of digits; each takes time in proportion.
COLLAPSED = [(re.compile(r"AA+"), "A"), (re.compile(r"A?a[aA]*"), "a"), (re.compile(r"00+"), "0")]


def shapes_of(tokens: list[str]) -> np.ndarray:
    """The number of each token's shape: all tokens are cut to shapes at once."""
    text = " ".join(tokens).translate(MARKS)
    for run, mark in COLLAPSED:
        text = run.sub(mark, text)
    shapes = text.split(" ")
    if Marks.RARE in text:
        shapes = [shape_of(t) if Marks.RARE in s else s for t, s in zip(tokens, shapes, strict=True)]
    return 1 + np.array([crc32(s.encode("utf-8", "surrogatepass")) for s in shapes], np.uint32) % (SHAPES - 1)


def distinct(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner's distinct features, ascending."""
    keys = np.sort(owner << 32 | feature)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return keys >> 32, keys & 0xFFFFFFFF


class WordIndicators:
    """Which words and word beginnings a text has; those that used has as False are left out."""

    size = WORD_SPACE

    def __init__(self, used: np.ndarray | None = None):
        self.used, self.store = used, WordStore(self.of_tokens, TOKENS)

    def of_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What the store keeps of white-space tokens: ids, flat, and how many each token has."""
        found, token = self.kept(*word_features(tokens))
        return found, np.bincount(token, minlength=len(tokens))

    def kept(self, feature: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.used is None:
            return feature, owner
        used = self.used[feature]
        return feature[used], owner[used]

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts as the store's numbers, and the text each is of."""
        tokens = [(t or "").split() for t in texts]
        return self.store.numbers([w for own in tokens for w in own]), np.repeat(np.arange(len(texts)), list(map(len, tokens)))

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Each text's distinct features, ascending, flat; and the text each is of."""
        owner, token = distinct(*self.numbers(texts)[::-1])
        return distinct(np.repeat(owner, self.store.counts[token]), self.store.gather(token))[::-1]

    def each(self, texts: list[str | None]) -> list[np.ndarray]:
        found, owner = self.of_texts(texts)
        return np.split(found, np.searchsorted(owner, np.arange(1, len(texts))))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.of_texts([text])[0]


class ShapeNgrams(WordIndicators):
    """Which n-grams (1 to 3) of token shapes a text has, a token that repeats the last one being a shape of its own, and which words."""

    size = SHAPE_SPACE + WORD_SPACE

    def of_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A token's first id is its shape, the others are features."""
        words, token = word_features(tokens)
        found, token = self.kept(SHAPE_SPACE + words, token)
        return np.insert(found, np.searchsorted(token, np.arange(len(tokens))), shapes_of(tokens)), 1 + np.bincount(token, minlength=len(tokens))

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        numbers, owner = self.numbers(texts)
        shape = self.store.ids[self.store.starts[numbers]].astype(np.int64)
        same = owner[1:] == owner[:-1]
        shape[1:][same & (numbers[1:] == numbers[:-1])] = 0
        found = []
        gram, at = shape, np.arange(len(shape))  # at: where a gram begins
        for n in range(3):
            if n:
                inside = at + n < len(shape)
                gram, at = gram[inside], at[inside]
                inside = owner[at + n] == owner[at]
                gram, at = gram[inside] * SHAPES + shape[at[inside] + n], at[inside]
            found.append(self.kept(((gram * 3 + n) * 0x9E3779B1 >> 7) % SHAPE_SPACE, owner[at]))
        text, token = distinct(owner, numbers)
        counts = self.store.counts[token]
        words = np.delete(self.store.gather(token), np.cumsum(counts) - counts)
        found.append((words, np.repeat(text, counts - 1)))
        features, owners = (np.concatenate(x) for x in zip(*found, strict=True))
        return distinct(owners, features)[::-1]


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, max_rows: int) -> DataFrame:
    """(text, y) of at most max_rows labelled documents, drawn by a hash of the id; labels other than 0 and 1 are left out.

    The bounded list of ids is broadcast, so texts are not shuffled.
    """
    drawn = (
        labels.select(F.col("doc_id").alias("__id"), F.col(f"`{label}`").cast("int").alias("y"))
        .filter(F.col("__id").isNotNull() & F.col("y").isin(0, 1) & keep)
        .groupBy("__id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    )
    return docs.select(F.col("doc_id").alias("__id"), "text").join(F.broadcast(drawn), "__id")


#: Features that a variant of a text has more, and those that it lacks.
Change = tuple[np.ndarray, np.ndarray]


def change(x: np.ndarray, variant: np.ndarray) -> Change:
    return np.setdiff1d(variant, x, assume_unique=True), np.setdiff1d(x, variant, assume_unique=True)


def collected(sample: DataFrame, kind: type, pairs: Callable[[str], list[tuple[str, str]]] | None = None) -> tuple[list[np.ndarray], np.ndarray, list[list[Change]]]:
    """The sample's features on the driver: rows, labels, and what changes from the first to the second text of each of a text's pairs.

    The driver needs 4 bytes for each distinct feature of each sampled text; the sample bounds rows, so very long texts count whole.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = kind()
        encode = lambda found: found.astype("<i4").tobytes()
        for batch in batches:
            for piece, texts in small_slices(batch, "text", SLICE):
                compared = [pairs(t) if pairs else [] for t in texts]
                every = list(dict.fromkeys([*texts, *(t for own in compared for pair in own for t in pair)]))
                found = dict(zip(every, features.each(every), strict=True))
                others = [[encode(part) for a, b in own for part in change(found[a], found[b])] for own in compared]
                columns = [piece.column("__id"), piece.column("y"), pa.array([encode(found[t]) for t in texts], pa.binary()), pa.array(others, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "y", "x", "others"])

    id_type = sample.schema["__id"].dataType.simpleString()
    rows = sorted(sample.mapInArrow(extract, f"id {id_type}, y int, x binary, others array<binary>").collect(), key=lambda r: (r["id"], bytes(r["x"])))
    read = lambda b: np.frombuffer(b, "<i4")
    changes = [[(read(r["others"][i]), read(r["others"][i + 1])) for i in range(0, len(r["others"]), 2)] for r in rows]
    return [read(r["x"]) for r in rows], np.array([r["y"] for r in rows], np.int64), changes


class Sparse:
    """Rows of 0/1 features over columns that at least min_rows rows have, and those of keep; or over given columns."""

    def __init__(self, rows: list[np.ndarray], size: int, min_rows: int = 1, columns: np.ndarray | None = None, keep: np.ndarray | None = None):
        flat = np.concatenate([np.empty(0, np.int32), *rows])
        if columns is None:
            columns = np.flatnonzero(np.bincount(flat, minlength=size) >= min_rows)
            columns = columns if keep is None else np.union1d(columns, keep)
        self.columns = columns
        number = np.full(size, -1, np.int32)
        number[self.columns] = np.arange(len(self.columns))
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        flat = number[flat]
        known = flat >= 0
        self.index, self.owner, self.n = flat[known], owner[known], len(rows)
        self.starts = np.searchsorted(self.owner, np.arange(len(rows) + 1))

    def filled(self) -> np.ndarray:
        """Whether each row has a feature."""
        return np.diff(self.starts) > 0

    def _parts(self):
        """Blocks of rows, so that temporary arrays stay small."""
        for row in range(0, self.n, 500):
            yield row, min(row + 500, self.n), slice(self.starts[row], self.starts[min(row + 500, self.n)])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(np.bincount(self.owner[at] - low, w[self.index[at]], high - low) for low, high, at in self._parts())])

    def back(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.columns))
        for _, _, at in self._parts():
            out += np.bincount(self.index[at], r[self.owner[at]], len(out))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score(docs: DataFrame, kind: type, weights: dict[int, float], bias: float, scale: float, text_col: str, names: tuple[str, str]) -> DataFrame:
    """Adds the score (sigmoid of scale times the sum of a text's weights, plus bias) and predicted (score >= 0.5)."""
    keys = np.array(sorted(weights), np.int64)
    values = np.array([weights[k] for k in keys.tolist()])
    plain = docs.select(*without(docs, *names))
    schema = T.StructType([*plain.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(kind.size)
        table[keys] = values
        features = kind(table != 0)
        for batch in batches:
            for piece, texts in small_slices(batch, text_col, SLICE):
                feature, owner = features.of_texts(texts)
                found = sigmoid(scale * np.bincount(owner, table[feature], len(texts)) + bias)
                columns = [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], names=[*piece.schema.names, *names])

    return map_arrow(plain, run, schema)
