"""Distinct-chunk tables: segment each distinct chunk once, join the ids back by position."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd

from roundhaul.llm.hashing import hash_words, slices, words_of

#: Chunks that a worker remembers; beyond it, those that came up often stay. Results don't depend on it.
TABLE_CHUNKS = 600_000


class _Column:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 14, kind), 0

    def add(self, more: np.ndarray) -> None:
        wanted = self.used + len(more)
        if wanted > len(self.values):
            self.values = np.concatenate([self.values[: self.used], np.zeros(max(wanted, self.used), self.values.dtype)])
        self.values[self.used : wanted] = more
        self.used = wanted


def _cut(values: _Column, ends: _Column, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the chunks under some codes, one chunk after another, and how many each has."""
    first = np.where(kept > 0, ends.values[kept - 1], 0)
    lengths = ends.values[kept] - first
    borders = np.append(0, np.cumsum(lengths))
    return values.values[np.arange(borders[-1]) + np.repeat(first - borders[:-1], lengths)], lengths


class ChunkTable:
    """Chunk -> ids, filled as chunks come up.

    Valid for a tokenizer whose pieces never cross a chunk's border, so that the ids of a text
    are those of its chunks in order. `segment` gets the chunks that the table lacks, all
    distinct, and returns one list of ids for each. A full table forgets what came up once. Chunks are looked up by 64-bit hashes under a
    seed drawn for the table, and compared byte by byte with what the table holds: where two
    chunks share a hash, the table starts anew under another seed.
    """

    def __init__(self, segment: Callable[[list[bytes]], Iterable[list[int]]], capacity: int = TABLE_CHUNKS):
        self.segment = segment
        self.capacity = capacity
        self._clear()

    def _clear(self) -> None:
        self.seed = int.from_bytes(os.urandom(4), "little")
        self.keys = np.zeros(0, np.uint64)
        self.codes = np.zeros(0, np.int64)
        self.ids, self.ends = _Column(np.int32), _Column(np.int64)
        # The chunks' bytes as 8-byte words: where they end, and how many bytes there are.
        self.words, self.word_ends, self.sizes = _Column(np.uint64), _Column(np.int64), _Column(np.int64)
        self.seen = _Column(np.int64)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        held = data.tobytes()
        chunks = [held[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        lists = list(self.segment(chunks))
        known = len(self.keys)
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.ends.add(self.ids.used + np.cumsum(lengths))
        self.ids.add(np.fromiter((i for ids in lists for i in ids), np.int32, int(lengths.sum())))
        words, borders = words_of(data, starts, ends)
        self.word_ends.add(self.words.used + borders[1:])
        self.words.add(words)
        self.sizes.add(ends - starts)
        self.seen.add(np.zeros(len(keys), np.int64))
        order = np.argsort(keys)
        places = np.searchsorted(self.keys, keys[order])
        self.codes = np.insert(self.codes, places, known + order)
        self.keys = np.insert(self.keys, places, keys[order])

    def _forget(self) -> None:
        """Keep the chunks that came up at least twice, and of those no more than fill half of the table."""
        seen = self.seen.values[: self.seen.used]
        kept = np.flatnonzero(seen > 1)
        half = self.capacity // 2
        if len(kept) > half:
            kept = np.sort(kept[np.argpartition(-seen[kept], half)[:half]])
        keys = np.empty(len(seen), np.uint64)
        keys[self.codes] = self.keys
        ids, lengths = _cut(self.ids, self.ends, kept)
        words, counts = _cut(self.words, self.word_ends, kept)
        sizes, often = self.sizes.values[kept], seen[kept] // 2
        seed = self.seed
        self._clear()
        self.seed = seed
        self.codes = np.argsort(keys[kept])
        self.keys = keys[kept][self.codes]
        held = (self.ids, ids), (self.ends, np.cumsum(lengths)), (self.words, words), (self.word_ends, np.cumsum(counts))
        for column, values in (*held, (self.sizes, sizes), (self.seen, often)):
            column.add(values)

    def _missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[places] != keys

    def _hold(self, words: np.ndarray, borders: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> bool:
        """Whether each chunk, given by its words, is the one that the table has under its code."""
        if (self.sizes.values[codes] != sizes).any():
            return False
        counts = np.diff(borders)
        first = self.word_ends.values[codes] - counts
        at = np.arange(len(words)) + np.repeat(first - borders[:-1], counts)
        return bool((self.words.values[at] == words).all())

    def encode(self, data: np.ndarray, starts: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders between those of the texts.

        Chunk i is `data[starts[i]:starts[i + 1]]`, the last one ends with the data; text j holds
        the chunks from `texts[j]` to `texts[j + 1]`.
        """
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.append(starts[1:], len(data))
        ids, lengths = [], []
        for part in slices(starts):  # so that the arrays of a very long text stay small
            low, high = int(starts[part][0]), int(ends[part][-1])
            found = self._encode(data[low:high], starts[part] - low, ends[part] - low)
            ids.append(found[0])
            lengths.append(found[1])
        borders = np.append(0, np.cumsum(np.concatenate(lengths)))
        return np.concatenate(ids), borders[texts]

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some chunks, and how many each has."""
        words, places = words_of(data, starts, ends)
        while True:
            which, keys = pd.factorize(hash_words(words, places, data, starts, ends, self.seed))
            where = np.empty(len(keys), np.int64)
            where[which[::-1]] = np.arange(len(which) - 1, -1, -1)  # the first of each
            missing = self._missing(keys)
            if len(self.keys) and len(self.keys) + missing.sum() > self.capacity:
                self._forget()
                missing = self._missing(keys)
            if missing.any():
                self._learn(keys[missing], data, starts[where[missing]], ends[where[missing]])
            distinct = self.codes[np.searchsorted(self.keys, keys)]
            self.seen.values[distinct] += np.bincount(which, minlength=len(keys))
            codes = distinct[which]
            if self._hold(words, places, ends - starts, codes):
                break
            self._clear()
        return _cut(self.ids, self.ends, codes)


def joined(texts: list[str], before: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one buffer, with `before` in front of every text that isn't empty, and their borders."""
    parts = [(before + text).encode() if text else b"" for text in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def cut(data: np.ndarray, borders: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks start: at the marked bytes and where a text begins; the first chunk of each text."""
    marks = marks.copy()
    marks[borders[:-1][np.diff(borders) > 0]] = True
    starts = np.flatnonzero(marks)
    return starts, np.searchsorted(starts, borders)
