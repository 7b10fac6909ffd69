"""Operator 8, SentencePiece encoding and decoding by vectorised merge rounds.

A task keeps the symbols of all new words in one flat numpy array. In every round each word finds the best
rank among its adjacent pairs (a segmented minimum), merges all places of that rank from the left at once,
and the array is compacted; words without a pair leave. Where a round's merges would bring forth a pair as
good or better, the word makes only its leftmost merge in that round, so the result is that of one merge at a
time. Characters without a piece become bytes. Decoding gathers the pieces' bytes.

Defined cases: a null or empty text has no ids and decodes to ""; U+2581 counts as a space, as in the
library; bytes that are no UTF-8 decode to U+FFFD; an empty table gives an empty table; rows that repeat are
each encoded; input columns that have the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_arrow, without
from .wordstore import WordStore, small_slices

SPACE = "▁"
NEW = ("ids", "n_tokens", "decoded")
NONE = np.iinfo(np.int32).max
#: Characters that are cut into words and encoded at a time; whole texts, so one may be longer.
SLICE = 500_000


class PieceModel:
    """Tables of a BPE model with byte fallback: characters' symbols, ranked pairs, pieces' bytes.

    A symbol is a piece's id or, for a character that is no piece, the number of pieces plus its code point.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        pieces = {sp.id_to_piece(i): i for i in range(size) if not special[i]}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if any(sp.is_unused(i) for i in range(size)) or not all(sp.is_byte(int(i)) for i in self.byte_ids):
            raise ValueError("only models with byte fallback and without unused pieces")
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("only models whose pieces have spaces in front alone")
        if sp.encode("ﬁ ½  x ", out_type=str) != sp.encode(" ﬁ ½  x ".removeprefix(" "), out_type=str) or sp.decode(sp.encode(" ﬁ  x ")) != " ﬁ  x ":
            raise ValueError("only models that normalise nothing")
        self.size, self.base = size, size + 0x110000
        self.chars = np.arange(size, self.base, dtype=np.int64)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in pieces.values()}, reverse=True))}
        symbol = lambda p: pieces.get(p, int(self.chars[ord(p)]) if len(p) == 1 else -1)
        pairs = {}
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left >= 0 and right >= 0:
                    pairs[left * self.base + right] = (ranks[sp.get_score(i)], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*(pairs[k] for k in self.keys.tolist()), strict=True))
        alphabet = set("".join(pieces))
        #: Words begin at a space; a line break that no piece holds stands alone.
        self.word = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if "\n" in alphabet else f"{SPACE}+[^{SPACE}\n]*|\n+|[^{SPACE}\n]+")
        body = [b"" if sp.is_control(i) or sp.is_unknown(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        self.counts = np.array([len(b) for b in body], np.int64)
        self.bytes, self.starts = np.frombuffer(b"".join(body), np.uint8), np.cumsum(self.counts) - self.counts

    def words(self, text: str) -> list[str]:
        return self.word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with the next one of its word; NONE where there is no such piece."""
        rank, piece = np.full(len(symbols), NONE, np.int64), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            key = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][known], piece[:-1][known] = self.ranks[at[known]], self.merged[at[known]]
        return rank, piece

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and how many each word has."""
        symbols = self.chars[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, piece = self.pair_ranks(symbols, word)
        done_symbols, done_word = [], []
        while len(symbols):
            first = np.append(True, word[1:] != word[:-1])
            segment = np.cumsum(first) - 1
            best = np.minimum.reduceat(rank, np.flatnonzero(first))
            live = (best < NONE)[segment]
            done_symbols.append(symbols[~live])
            done_word.append(word[~live])
            symbols, word, rank, piece = symbols[live], word[live], rank[live], piece[live]
            best = best[best < NONE]
            if not len(symbols):
                break
            segment = np.cumsum(np.append(True, word[1:] != word[:-1])) - 1
            place = np.arange(len(symbols))
            fits = rank == best[segment]
            run = np.maximum.accumulate(np.where(fits & ~np.append(False, fits[:-1]), place, -1))
            take = fits & ((place - run) % 2 == 0)
            result = self._merge(symbols, word, piece, take)
            new_first = np.flatnonzero(np.append(True, result[1][1:] != result[1][:-1]))
            many = np.add.reduceat(take.astype(np.int64), np.flatnonzero(np.append(True, word[1:] != word[:-1]))) > 1
            hasty = many & (np.minimum.reduceat(result[2], new_first) <= best)
            if hasty.any():
                leftmost = np.append(True, segment[take][1:] != segment[take][:-1])
                spare = np.flatnonzero(take)[~leftmost & hasty[segment[take]]]
                take[spare] = False
                result = self._merge(symbols, word, piece, take)
            symbols, word, rank, piece = result
        symbols, word = np.concatenate([*done_symbols, symbols]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return self._with_bytes(symbols[order], word[order], len(words))

    def _merge(self, symbols: np.ndarray, word: np.ndarray, piece: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, ...]:
        stay = ~np.append(False, take[:-1])
        symbols, word = np.where(take, piece, symbols)[stay], word[stay]
        return symbols, word, *self.pair_ranks(symbols, word)

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        odd = np.flatnonzero(symbols >= self.size)
        if len(odd):
            kinds, which = np.unique(symbols[odd], return_inverse=True)
            forms = [np.frombuffer(chr(c - self.size).encode("utf-8", "surrogatepass"), np.uint8) for c in kinds.tolist()]
            lengths = np.array([len(f) for f in forms])
            n = np.ones(len(symbols), np.int64)
            n[odd] = lengths[which]
            out = np.repeat(symbols, n)
            out[np.repeat(symbols >= self.size, n)] = self.byte_ids[np.concatenate([forms[w] for w in which])]
            symbols, word = out, np.repeat(word, n)
        return symbols.astype(np.uint32), np.bincount(word, minlength=words)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of flat ids: the pieces' bytes without the space that encoding puts in front."""
        n = self.counts[ids]
        raw = self.bytes[np.repeat(self.starts[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())].tobytes()
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))].tolist()
        return [raw[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]


@lru_cache(maxsize=2)
def model_of(path: str) -> tuple[PieceModel, WordStore]:
    """A worker's tables for a model file, and the words it has met."""
    model = PieceModel(path)
    return model, WordStore(model.encode_words)


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Adds ids (array of int), n_tokens and decoded (the text that the ids decode to)."""
    plain = docs.select(*without(docs, *NEW))
    schema = T.StructType([*plain.schema.fields, *T._parse_datatype_string("ids array<int>, n_tokens long, decoded string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, store = model_of(model_path)
        for batch in batches:
            for piece, texts in small_slices(batch, text_col, SLICE):
                ids, counts = store.texts([model.words(t) for t in texts])
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                columns = [pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))), pa.array(counts, pa.int64()), pa.array(model.decode(ids, counts), pa.string())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], names=[*piece.schema.names, *NEW])

    return map_arrow(plain, run, schema)
