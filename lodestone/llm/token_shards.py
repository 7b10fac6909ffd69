"""Operator 3, token-id output: a wavelet matrix per shard.

Documents are range-partitioned and sorted by id and text; every task encodes its documents and cuts a shard after a
bounded number of tokens. A shard is one compressed blob: bit-planes with rank and select support, from which
tokens are read, counted or found (WaveletMatrix). Shards are rows of a Parquet table in the target folder,
so Spark's commit protocol covers lost executors and any file system that Spark reaches will do. A task
knows how many tokens its partition holds before each shard; only a total per partition is summed up over
partitions to place every document in the whole.

Ids are those of the library's encode with add_special_tokens=False: a special token's string in a text becomes its id.

Defined cases: a null or empty text has the end id alone; null ids come first; rows with equal ids are
ordered by their text (null as empty); rows that repeat are kept; an empty table gives no shards and no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir
from .wavelet import WaveletMatrix

#: Texts that are encoded whole: other white space than spaces and line breaks, or runs of these over which pieces can't be cut.
WHOLE = "[\\x09\\x0B-\\x0D\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{180E}\\x{2000}-\\x{200F}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{2060}\\x{3000}\\x{FEFF}]|  | \n|\n\n\n|\n\n |\n[\n ]\\z"
#: A Latin word or a number, with a space before it or none, and the ASCII marks after it: one pre-token each.
SIMPLE = r"\A(?P<word> ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+))(?P<marks>[!-/:-@\[-`{-~]*)\z"
#: Byte-level BPE writes a byte as a character: printable Latin-1 as it is, the others from U+0100 on in order.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
#: Stands before a text's first piece, which has no space before it.
START = "\r"
#: Partitions whose totals (16 bytes each) may be broadcast.
BROADCAST_PARTITIONS = 200_000


class Store:
    """Ids of the strings met so far; over the limit, those met several times are kept. encode gives the ids of new ones, flat, and how many each has."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self.names, self.ids = pa.array([], pa.string()), np.empty(0, np.uint32)
        self.starts, self.counts, self.hits = (np.empty(0, np.int64) for _ in range(3))

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these places, flat, and where each ends."""
        counts = self.counts[which]
        ends = np.cumsum(counts)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[which] - ends + counts, counts)], ends

    def shrink(self) -> None:
        stay = self.hits > 2
        if 2 * stay.sum() > self.limit:
            stay[:] = False
        kept = np.flatnonzero(stay)
        self.ids = self.gather(kept)[0]
        self.names, self.counts, self.hits = self.names.take(pa.array(kept)), self.counts[kept], np.zeros(len(kept), np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def places(self, strings: pa.Array) -> np.ndarray:
        """Where the strings are in the store, to which new ones are added; good until the next call."""
        if len(self.names) > self.limit:
            self.shrink()
        coded = strings.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.names)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        place = at.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            names = coded.dictionary.take(pa.array(new))
            ids, counts = self.encode(names)
            place[new] = len(self.names) + np.arange(len(new))
            self.names = pa.concat_arrays([self.names, names])
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
            self.ids, self.counts, self.hits = np.append(self.ids, ids), np.append(self.counts, counts), np.append(self.hits, np.zeros(len(new), np.int64))
        which = place[coded.indices.to_numpy()]
        self.hits += np.bincount(which, minlength=len(self.hits))
        return which


def flat_ids(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts


def placed(kept: np.ndarray, flat: np.ndarray, counts: np.ndarray, other: np.ndarray, other_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One flat array of two: rows where kept is set come from the first, the others from the second."""
    n = np.empty(len(kept), np.int64)
    n[kept], n[~kept] = counts, other_counts
    out, own = np.empty(n.sum(), np.uint32), np.repeat(kept, n)
    out[own], out[~own] = flat, other
    return out, n


class Encoder:
    """A worker's encoder: every piece of text (a word with what is attached) is encoded once, texts are gathered from pieces.

    Words and marks of new pieces, one pre-token each, go straight to the library's BPE model, and once as well; other
    pieces, and texts that can't be cut at spaces, to the library's encode.
    """

    def __init__(self, path: str, pieces: int = 500_000, words: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.vocabulary = self.tokenizer.model, self.tokenizer.get_vocab_size()
        self.whole = "|".join([WHOLE, *(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content)])
        self.words, self.pieces = Store(self.new_words, words), Store(self.new_pieces, pieces)

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens by the model, which takes every byte as a character."""
        written = pc.replace_substring(pc.replace_substring(words, " ", chr(BYTE_CHARS[32])), "\n", chr(BYTE_CHARS[10])).to_pylist()
        for i in np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False)).tolist():
            written[i] = words[i].as_py().encode().decode("latin-1").translate(BYTE_CHARS)
        tokenize = self.model.tokenize
        return flat_ids([[t.id for t in tokenize(w)] if w else [] for w in written])

    def new_pieces(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces: a word after a space, or one that begins with START or a line break."""
        broken = pc.starts_with(names, "\n")
        text = pc.if_else(pc.or_(broken, pc.starts_with(names, START)), pc.utf8_slice_codeunits(names, 1), pc.binary_join_element_wise(" ", names, ""))
        parts = pc.extract_regex(text, SIMPLE)
        simple = parts.is_valid().to_numpy(zero_copy_only=False)
        own, breaks = parts.filter(pa.array(simple)), pc.if_else(broken, "\n", "").cast(pa.string())
        units = [breaks.filter(pa.array(simple)), own.field("word"), own.field("marks")]
        which = self.words.places(pa.concat_arrays(units)).reshape(3, -1).T.ravel()
        flat, ends = self.words.gather(which)
        counts = np.diff(np.append(0, ends[2::3]))
        if simple.all():
            return flat, counts
        ids, n = self.library(pc.binary_join_element_wise(breaks, text, "").filter(pa.array(~simple)).to_pylist())
        return placed(simple, flat, counts, ids, n)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has; a null text has none."""
        texts = texts.fill_null("")
        whole = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        cut = texts.filter(pa.array(~whole)) if whole.any() else texts
        marked = pc.binary_join_element_wise(START, pc.replace_substring(cut, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        flat, ends = self.pieces.gather(self.pieces.places(lists.flatten()))
        counts = np.diff(np.append(0, ends)[lists.offsets.to_numpy() - lists.offsets[0].as_py()])
        return placed(~whole, flat, counts, *self.library(texts.filter(pa.array(whole)).to_pylist())) if whole.any() else (flat, counts)


def slices(batch: pa.RecordBatch, text_col: str, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about size bytes of text."""
    ends = np.cumsum(pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + size, side="right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def write_token_shards(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_tokens: int = 1 << 20) -> None:
    """Encode every text, append end_id, and write wavelet-matrix shards in ascending id order to the folder."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # Rows that agree in id and prefix share a partition, so the order within partitions is one over all of them; bounds stay small.
    ordered = rows.repartitionByRange("id", F.substring("text", 1, 256)).sortWithinPartitions("id", "text")
    id_type = ordered.schema["id"].dataType.simpleString()
    schema = f"part int, seq int, part_start long, n_tokens long, ids array<{id_type}>, counts array<int>, shard binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder_of(tokenizer_path)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, tokens, held = [], [], [], 0
        bits = max(encode_texts.vocabulary - 1, end_id, 1).bit_length()

        def shard() -> pa.RecordBatch:
            body = WaveletMatrix.build(np.concatenate(tokens), bits).to_bytes()
            own = pa.array(ids, id_arrow)
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                       pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([counts], pa.list_(pa.int32())), pa.array([body], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "part_start", "n_tokens", "ids", "counts", "shard"])

        for batch in batches:
            id_arrow = batch.schema.field("id").type
            for piece in slices(batch, "text"):
                flat, n = encode_texts(piece.column("text"))
                with_end = np.full(len(flat) + len(n), end_id, np.uint32)
                at = np.ones(len(with_end), bool)
                at[np.cumsum(n + 1) - 1] = False
                with_end[at] = flat
                flat = with_end
                ids += piece.column("id").to_pylist()
                counts += (n + 1).tolist()
                tokens.append(flat)
                held += len(flat)
                if held >= shard_tokens:
                    yield shard()
                    seq, start = seq + 1, start + held
                    ids, counts, tokens, held = [], [], [], 0
        if held:
            yield shard()

    ordered.mapInArrow(encode, schema).write.parquet(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards: id, start (tokens of all documents before it), n_tokens, tokens (little-endian 32-bit)."""
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    if totals.count() <= BROADCAST_PARTITIONS:
        before = F.broadcast(before)
    placed = shards.join(before, "part").select((F.col("before") + F.col("part_start")).alias("start"), "ids", "counts", "shard")
    id_type = shards.schema["ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = WaveletMatrix.from_bytes(batch.column("shard")[i].as_py()).to_array().astype("<u4")
                counts = batch.column("counts")[i].values.to_numpy()
                ends = np.cumsum(counts, dtype=np.int64)
                offsets = pa.array(np.append(0, ends * 4), pa.int32())
                body = pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets.buffers()[1], pa.py_buffer(tokens)])
                start = pa.array(batch.column("start")[i].as_py() + ends - counts, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, start, pa.array(counts.astype(np.int64)), body], names=["id", "start", "n_tokens", "tokens"])

    return placed.mapInArrow(decode, f"id {id_type}, start long, n_tokens long, tokens binary")


def token_shards(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """Write the shards (to the shared folder if no path is given) and read all documents back from them."""
    import uuid

    path = path or f"{shared_dir(docs.sparkSession).rstrip('/')}/shards-{uuid.uuid4().hex}"
    write_token_shards(docs, path, tokenizer_path, id_col=id_col, **options)
    return read_token_shards(docs.sparkSession, path).withColumnRenamed("id", id_col)
