"""Operator 12, byte-level BPE encoding and decoding with segment trees.

A text's pieces (the matches of the splitting pattern) are found in whole slices of bytes at once, from each byte's class.
Every new piece is encoded once a worker. A piece is a row of byte positions; a segment tree over them holds in every node
the leftmost least (rank, position) of the pairs that begin below it, so the root names the next merge. A merge changes three
leaves (the pair itself, the one that begins at the swallowed symbol, the one that ends at the merged symbol), and each
of them updates the nodes above it: logarithmic work a merge, however long the piece. Pieces of one size have their trees in
one numpy table and merge in step; a long piece (LONG bytes or more) has a tree of its own. Decoding gathers the tokens' bytes.

Ids are the ranks of the file; a piece that is a token as a whole is that token, as in the library. Character
classes are those of the library's own pattern engine.

Defined cases: a null or empty text has no ids and decodes to no bytes; an empty table gives an empty table; rows that
repeat are each encoded; input columns that have the name of a result column, in any case, are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, without
from .token_shards import Store, slices

NEW = ("ids", "n_tokens", "decoded")
#: Pieces of so many bytes are merged one by one.
LONG = 256
#: Bytes of text that are cut and encoded at a time; whole texts, so one may be longer.
SLICE = 4_000_000
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Leaves of the trees that merge in step.
TREE_LEAVES = 1 << 19
#: No pair of two tokens makes a token.
NONE = np.iinfo(np.int64).max


def library_classes() -> np.ndarray:
    """The class of every code point, asked of the library: text that a pattern doesn't match yields no ids."""
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    out = np.zeros(0x110000, np.int8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        plain = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found = bytes(plain.encode_ordinary(text)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


class Splitter:
    """Cuts texts where the pattern of the byte-level tokenizers does: contractions, then letters, numbers or marks with a space before
    them, and white space, of which the last one before other text stands apart."""

    def __init__(self) -> None:
        self.classes = library_classes()

    def byte_classes(self, raw: np.ndarray) -> np.ndarray:
        """The class of every byte's character."""
        kinds = self.classes[:256].copy()
        kinds[128:] = -1
        out = kinds[raw]
        lead = np.flatnonzero(raw >= 0xC0)
        for low, high, length, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
            at = lead[(raw[lead] >= low) & (raw[lead] < high)]
            at = at[at + length <= len(raw)]
            point = (raw[at] & mask).astype(np.int64)
            for k in range(1, length):
                point = point << 6 | raw[at + k] & 0x3F
            for k in range(length):
                out[at + k] = self.classes[np.minimum(point, 0x10FFFF)]
        return out

    def starts(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each byte. ends: where each text ends; texts lie behind one another."""
        if not len(raw):
            return np.zeros(0, bool)
        kind = self.byte_classes(raw)
        first = np.zeros(len(raw) + 1, bool)  # a text begins here, or all texts have ended
        first[0] = True
        first[ends] = True
        begin = first[:-1].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        char = (raw & 0xC0) != 0x80
        last_of_run = np.append(begin[1:], True)
        # White space before other text: its last character stands apart, and a plain space goes with what follows.
        close = np.flatnonzero((kind == SPACE) & last_of_run & ~first[1:])
        lead = close.copy()
        for _ in range(3):
            lead -= ~char[lead]
        begin[lead] = True
        begin[close[raw[close] == 0x20] + 1] = False
        # Contractions at the start of a piece.
        quote = np.flatnonzero((raw == 0x27) & begin)
        padded = np.append(raw, np.zeros(3, np.uint8))
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        room = np.append(np.flatnonzero(first), len(raw))
        left = room[np.searchsorted(room, quote, side="right")] - quote
        size = np.where(short & (left >= 2), 2, np.where(long & (left >= 3), 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        after = quote + size
        begin[after[after < len(raw)]] = True
        return begin

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and how many each text has."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        body = texts.buffers()[2]
        raw = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
        ends = offsets[1:] - offsets[0]
        at = np.flatnonzero(self.starts(raw, ends))
        bounds = np.append(at, len(raw)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw)))
        return pieces, np.diff(np.searchsorted(at, ends), prepend=0)


class ByteBpe:
    """Ranked tokens of a rank file (a token in base 64 and its rank in each line), and the pairs of tokens that make a token."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("only rank files that hold every byte")
        self.size = max(self.ranks.values()) + 1
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        body: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            body[rank] = token
        self.counts = np.array([len(b) for b in body], np.int64)
        self.bytes, self.starts = np.frombuffer(b"".join(body), np.uint8), np.cumsum(self.counts) - self.counts

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make; NONE where they make none, or where one is missing (below 0)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NONE)

    def merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """Merge every row (tokens from the left, -1 behind the end); the tokens that stay, -1 elsewhere."""
        rows, width = symbols.shape
        bits = max(1, (width - 1).bit_length())
        leaves = 1 << bits
        left = np.full((rows, leaves), -1, np.int64)
        left[:, :width] = symbols
        rank = np.full((rows, leaves), NONE, np.int64)
        rank[:, :-1] = self.pair_ranks(left[:, :-1], left[:, 1:])
        # A node is rank * leaves + position, so its least value is the leftmost pair of least rank.
        tree = np.full((rows, 2 * leaves), NONE, np.int64)
        tree[:, leaves:] = np.where(rank < NONE, rank * leaves + np.arange(leaves), NONE)
        for level in range(bits - 1, -1, -1):
            low, high = 1 << level, 2 << level
            tree[:, low:high] = np.minimum(tree[:, 2 * low : 2 * high : 2], tree[:, 2 * low + 1 : 2 * high : 2])
        # One place before the first position and one behind the last take what is beyond the ends.
        sym = np.full((rows, leaves + 2), -1, np.int64)
        sym[:, 1:-1] = left
        after = np.tile(np.minimum(np.arange(1, leaves + 3), leaves + 1), (rows, 1))
        before = np.tile(np.maximum(np.arange(-1, leaves + 1), 0), (rows, 1))
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            top = tree[live, 1]
            i = (top & leaves - 1) + 1
            j = after[live, i]
            k, h = after[live, j], before[live, i]
            new = top >> bits
            sym[live, i], sym[live, j] = new, -1
            after[live, i], before[live, k] = k, i
            behind, ahead = self.pair_ranks(new, sym[live, k]), self.pair_ranks(sym[live, h], new)
            at = np.concatenate([i, j, np.where(h > 0, h, i)]) - 1
            value = np.concatenate([behind, np.full(len(live), NONE), np.where(h > 0, ahead, behind)])
            owner, node = np.tile(live, 3), leaves + at
            tree[owner, node] = np.where(value < NONE, value * leaves + at, NONE)
            for _ in range(bits):
                node = node >> 1
                tree[owner, node] = np.minimum(tree[owner, 2 * node], tree[owner, 2 * node + 1])
            live = live[tree[live, 1] < NONE]
        return sym[:, 1:-1]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """As merge_rows, for one long piece, with a tree of its own."""
        n, size, known = len(symbols), self.size, self.pairs.get
        leaves = 1 << max(1, (n - 1).bit_length())
        tree = [NONE] * (2 * leaves)
        sym, after, before = [*symbols, -1], [*range(1, n + 1), n], [*range(-1, n)]
        for i in range(n - 1):
            rank = known(sym[i] * size + sym[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = leaves + at
            tree[node] = value
            while node > 1:
                node >>= 1
                best = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == best:
                    break
                tree[node] = best

        def pair(at: int, right: int) -> int:
            rank = known(sym[at] * size + sym[right]) if right < n else None
            return NONE if rank is None else rank * leaves + at

        while tree[1] < NONE:
            rank, i = divmod(tree[1], leaves)
            j = after[i]
            k, h = after[j], before[i]
            sym[i], sym[j], after[i], before[k] = rank, -1, k, i
            put(j, NONE)
            put(i, pair(i, k))
            if h >= 0:
                put(h, pair(h, i))
        return [s for s in sym[:n] if s >= 0]

    def encode_pieces(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, flat, and how many each has."""
        pieces = names.cast(pa.binary()).to_pylist()
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = (whole >= 0).astype(np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (lengths >= LONG)).tolist():
            ids = self.merge_long(self.byte_ids[np.frombuffer(pieces[i], np.uint8)].tolist())
            counts[i] = len(ids)
            found.append((np.array([i]), np.array(ids, np.int64)))
        high = 8
        low = 0
        while low < LONG:
            own = np.flatnonzero((whole < 0) & (lengths > low) & (lengths <= high) & (lengths < LONG))
            for some in np.array_split(own, max(1, -(-len(own) * high // TREE_LEAVES))):
                if len(some):
                    table = np.full((len(some), high), -1, np.int64)
                    inside = np.arange(high) < lengths[some][:, None]
                    table[inside] = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in some.tolist()]), np.uint8)]
                    merged = self.merge_rows(table)
                    counts[some] = (merged >= 0).sum(axis=1)
                    found.append((some, merged[merged >= 0]))
            low, high = high, 2 * high
        starts = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.uint32)
        for which, ids in found:
            n = counts[which]
            out[np.repeat(starts[which] - np.cumsum(n) + n, n) + np.arange(n.sum())] = ids
        return out, counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of texts whose flat ids and numbers of ids are given."""
        n = self.counts[ids]
        raw = self.bytes[np.repeat(self.starts[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


class Encoder:
    """A worker's tables for a rank file, and the pieces it has met."""

    def __init__(self, path: str, pieces: int = 400_000):
        self.bpe, self.split = ByteBpe(path), Splitter()
        self.store = Store(self.bpe.encode_pieces, pieces)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has; a null text has none."""
        pieces, n = self.split(texts.fill_null(""))
        flat, ends = self.store.gather(self.store.places(pieces))
        return flat, np.diff(np.append(0, ends)[np.append(0, np.cumsum(n))])


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def encode_decode_bytes(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """Adds ids (array of int), n_tokens and decoded (the bytes that the ids decode to)."""
    kept = without(docs, *NEW)
    names = [c for c in docs.columns if c.lower() not in NEW]
    extra = [] if text_col in names else [F.col(f"`{text_col}`")]  # the text stands in a column that is replaced
    plain = docs.select(*extra, *kept)
    at, lead = (0, 1) if extra else (names.index(text_col), 0)
    schema = T.StructType([*plain.schema.fields[lead:], *T._parse_datatype_string("ids array<int>, n_tokens long, decoded binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks_path)
        for batch in batches:
            for piece in slices(batch, batch.schema.names[at], SLICE):
                ids, counts = encoder(piece.column(at))
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                new = [pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))), pa.array(counts, pa.int64()), encoder.bpe.decode(ids, counts)]
                yield pa.RecordBatch.from_arrays([*piece.columns[lead:], *new], names=[*piece.schema.names[lead:], *NEW])

    return map_arrow(plain, run, schema)
