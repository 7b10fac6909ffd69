"""Wavelet matrix over unsigned integers, as numpy bit-planes with rank directories.

A level holds one bit of every value, in the order in which the levels before left the values (zeros before
ones). rank, access, count and select take whole arrays of queries.

The file format keeps what these need: a plane is cut into chunks, each compressed on its own, and before them
stands a directory with every chunk's place and the number of set bits before it. A matrix read from a file
unpacks only the chunks that a query touches.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"LWM2"
#: numpy's 64-bit words are read little-endian everywhere.
WORD = np.dtype("<u8")
#: Words of a chunk of the file: 32 KiB, 262,144 bits.
CHUNK = 4096


class Plane:
    """Words of one level, and ones[w]: the set bits before word w."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def load(self, words: np.ndarray | None = None) -> None:
        """Have these words and their counts ready."""

    def word_of(self, which: np.ndarray, one: int) -> np.ndarray:
        """The word that holds the which-th set (or clear) bit."""
        ahead = self.ones if one else np.arange(len(self.ones)) * 64 - self.ones
        return np.searchsorted(ahead, which, side="right") - 1

    def to_bytes(self) -> bytes:
        packer = zstandard.ZstdCompressor(level=1)
        bodies = [packer.compress(self.words[at : at + CHUNK].tobytes()) for at in range(0, len(self.words), CHUNK)]
        places = np.cumsum([0, *map(len, bodies)], dtype="<u4")
        before = np.append(self.ones[:-1:CHUNK], self.ones[-1]).astype("<u4")
        return b"".join([struct.pack("<II", len(self.words), len(bodies)), places.tobytes(), before.tobytes(), *bodies])


class FilePlane(Plane):
    """A plane in a file; chunks are unpacked when they are asked for."""

    def __init__(self, data: memoryview):
        n, chunks = struct.unpack_from("<II", data)
        self.places = np.frombuffer(data, "<u4", chunks + 1, 8)
        self.before = np.frombuffer(data, "<u4", chunks + 1, 8 + 4 * (chunks + 1)).astype(np.int64)
        self.body = data[8 + 8 * (chunks + 1) :]
        self.words, self.ones, self.loaded = np.zeros(n, WORD), np.zeros(n + 1, np.int64), np.zeros(chunks, bool)
        self.ones[-1] = self.before[-1]

    @property
    def size(self) -> int:
        return 8 + 8 * len(self.places) + int(self.places[-1])

    def load(self, words: np.ndarray | None = None) -> None:
        wanted = np.arange(len(self.loaded)) if words is None else np.unique(np.minimum(words, len(self.words) - 1) // CHUNK)
        for c in wanted[~self.loaded[wanted]].tolist():
            own = slice(c * CHUNK, min((c + 1) * CHUNK, len(self.words)))
            self.words[own] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.body[self.places[c] : self.places[c + 1]]), WORD)
            self.ones[own.start + 1 : own.stop + 1] = self.before[c] + np.cumsum(np.bitwise_count(self.words[own]), dtype=np.int64)
            self.ones[own.start] = self.before[c]
            self.loaded[c] = True

    def word_of(self, which: np.ndarray, one: int) -> np.ndarray:
        ahead = self.before if one else np.minimum(np.arange(len(self.before)) * CHUNK, len(self.words)) * 64 - self.before
        chunk, out = np.searchsorted(ahead, which, side="right") - 1, np.empty(len(which), np.int64)
        for c in np.unique(chunk).tolist():
            at = np.arange(c * CHUNK, min((c + 1) * CHUNK, len(self.words)))
            self.load(at[:1])
            inside = self.ones[at] if one else at * 64 - self.ones[at]
            out[chunk == c] = at[0] + np.searchsorted(inside, which[chunk == c], side="right") - 1
        return out


class WaveletMatrix:
    """Planes from the highest bit to the lowest, and how many values have a zero there."""

    def __init__(self, length: int, planes: list[Plane], zeros: list[int]):
        self.length, self.planes, self.zeros = length, planes, zeros

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        values = np.ascontiguousarray(values, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            bit = values & values.dtype.type(1 << level) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(Plane(np.pad(packed, (0, -len(packed) % 8 + 8)).view(WORD)))
            below, above = np.flatnonzero(~bit), np.flatnonzero(bit)
            zeros.append(len(below))
            values = np.concatenate((values[below], values[above]))
        return cls(len(values), planes, zeros)

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        plane, word, bit = self.planes[level], at >> 6, (at & 63).astype(np.uint64)
        plane.load(word)
        below = plane.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return plane.ones[word] + np.bitwise_count(below)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        start, end = np.zeros(len(at), np.int64), np.asarray(at, np.int64)
        for level in range(len(self.planes)):
            one = ((symbols >> (len(self.planes) - 1 - level)) & 1).astype(bool)
            s, e = self._rank1(level, start), self._rank1(level, end)
            start = np.where(one, self.zeros[level] + s, start - s)
            end = np.where(one, self.zeros[level] + e, end - e)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at these positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(len(self.planes)):
            before = self._rank1(level, at)
            one = (self.planes[level].words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
            at = np.where(one, self.zeros[level] + before, at - before)
            out = out << 1 | one
        return out

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        """How often the symbol stands in [start, end)."""
        r = self.rank(np.array([symbol, symbol]), np.array([start, self.length if end is None else end]))
        return int(r[1] - r[0])

    def select(self, symbol: int, which: np.ndarray) -> np.ndarray:
        """Where the symbol stands for the which-th time, from 0; positions of all with which = arange(count)."""
        start, levels = 0, len(self.planes)
        for level in range(levels):
            before = int(self._rank1(level, np.array([start]))[0])
            start = self.zeros[level] + before if symbol >> (levels - 1 - level) & 1 else start - before
        at = start + np.asarray(which, np.int64)
        for level in range(levels - 1, -1, -1):
            one = symbol >> (levels - 1 - level) & 1
            at = self._select_bit(level, one, at - self.zeros[level] if one else at)
        return at

    def _select_bit(self, level: int, one: int, which: np.ndarray) -> np.ndarray:
        """Where the which-th set (or clear) bit of a plane stands."""
        plane = self.planes[level]
        word = plane.word_of(which, one)
        plane.load(word)
        left = which - (plane.ones[word] if one else word * 64 - plane.ones[word])
        words = plane.words[word] if one else ~plane.words[word]
        bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return word * 64 + np.argmax(np.cumsum(bits, axis=1) == left[:, None] + 1, axis=1)

    def to_array(self) -> np.ndarray:
        """All values in order, by undoing the partitions from the last level up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.length, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            self.planes[level].load()
            bit = np.unpackbits(self.planes[level].words.view(np.uint8), count=self.length, bitorder="little").view(bool)
            above, zeros = np.empty_like(values), self.zeros[level]
            above[np.flatnonzero(~bit)] = values[:zeros]
            above[np.flatnonzero(bit)] = values[zeros:] | kind(1 << (len(self.planes) - 1 - level))
            values = above
        return values

    def to_bytes(self) -> bytes:
        """The file format: magic, length, levels; for each level the zeros, and the plane with its directory."""
        out = [MAGIC, struct.pack("<QI", self.length, len(self.planes))]
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            out += [struct.pack("<Q", zeros), plane.to_bytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        view = memoryview(data)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a wavelet matrix")
        length, levels = struct.unpack_from("<QI", view, 4)
        at, planes, zeros = 16, [], []
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", view, at)[0])
            planes.append(FilePlane(view[at + 8 :]))
            at += 8 + planes[-1].size
        return cls(length, planes, zeros)
