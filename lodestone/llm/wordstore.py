"""Token ids of the pieces of text that a task has met: each piece is encoded once, texts are gathered from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


class WordStore:
    """Ids of the pieces met so far. Over its limit it keeps only the pieces that were met several times.

    encode gives a list of pieces' ids, flat, and how many each has.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], words: int = 150_000):
        self.encode, self.limit = encode, words
        self.at: dict[str, int] = {}
        self.ids, self.starts, self.counts, self.hits = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def gather(self, which: np.ndarray) -> np.ndarray:
        counts = self.counts[which]
        return self.ids[np.repeat(self.starts[which] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]

    def _shrink(self) -> None:
        stay = self.hits > 2
        if 2 * stay.sum() > self.limit:
            stay[:] = False
        kept = np.flatnonzero(stay)
        names = list(self.at)
        self.at = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.ids, self.counts, self.hits = self.gather(kept), self.counts[kept], np.zeros(len(kept), np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """A number for each piece, the same for equal pieces, that holds until the next call."""
        if len(self.at) > self.limit:
            self._shrink()
        new = list(set(pieces).difference(self.at))
        if new:
            ids, counts = self.encode(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
            self.counts, self.ids = np.append(self.counts, counts), np.append(self.ids, ids)
            self.hits = np.append(self.hits, np.zeros(len(new), np.int64))
        which = np.fromiter(map(self.at.__getitem__, pieces), np.int64, len(pieces))
        self.hits += np.bincount(which, minlength=len(self.hits))
        return which

    def flat(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, flat, and how many each has."""
        which = self.numbers(pieces)
        return self.gather(which), self.counts[which]

    def texts(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has; a text is a list of pieces."""
        ids, counts = self.flat([p for text in pieces for p in text])
        ends = np.append(0, np.cumsum(counts))[np.cumsum([len(t) for t in pieces], dtype=np.int64)]
        return ids, np.diff(ends, prepend=0)


def small_slices(batch: pa.RecordBatch, text_col: str, size: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in slices of about size characters, with their texts (null as empty)."""
    begin, total, texts = 0, 0, []
    for i, text in enumerate(batch.column(text_col)):
        texts.append(text.as_py() or "")
        total += len(texts[-1])
        if total >= size:
            yield batch.slice(begin, i + 1 - begin), texts
            begin, total, texts = i + 1, 0, []
    if texts:
        yield batch.slice(begin), texts
