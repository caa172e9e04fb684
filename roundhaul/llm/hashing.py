"""64-bit hashes of many byte ranges of one buffer at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from roundhaul.llm.common import mix64

#: Ranges of up to so many 8-byte words are hashed side by side, longer ones by a cryptographic hash.
SHORT_WORDS = 4
#: Ranges worked on at once.
STEP = 1 << 19

ODD = np.uint64(0x9E3779B97F4A7C15)
MASKS = np.array([0, *((1 << (8 * k)) - 1 for k in range(1, 9))], np.uint64)


def words_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges as 8-byte words, the last one of each filled up with zeros, and the borders between ranges."""
    counts = -(-(ends - starts) // 8)
    borders = np.append(0, np.cumsum(counts))
    own = np.repeat(np.arange(len(starts)), counts)
    at = starts[own] + 8 * (np.arange(borders[-1]) - borders[own])
    low, high = (int(starts.min()), int(ends.max())) if len(starts) else (0, 0)
    held = np.concatenate([data[low:high], np.zeros(8, np.uint8)])
    anywhere = np.ndarray((high - low + 1,), "<u8", held, strides=(1,))
    return anywhere[at - low] & MASKS[np.minimum(ends[own] - at, 8)], borders


def slices(starts: np.ndarray) -> Iterator[slice]:
    for begin in range(0, len(starts), STEP):
        yield slice(begin, begin + STEP)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each range `data[starts[i]:ends[i]]`; the ranges ascend and don't overlap.

    Ranges of one length up to 8 bytes never share a hash. Up to 32 bytes two lanes take in the words one
    after the other, each mixed with all that went before; no sum of parts can cancel out. Longer
    ranges are hashed by BLAKE2.
    """
    out = np.empty(len(starts), np.uint64)
    for part in slices(starts):
        a, b = starts[part], ends[part]
        words, borders = words_of(data, a, np.where(b - a <= 8 * SHORT_WORDS, b, a))
        out[part] = hash_words(words, borders, data, a, b, seed)
    return out


def hash_words(words: np.ndarray, borders: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """`range_hashes` from the words of the ranges; those of long ranges are not looked at."""
    keys = mix64(np.array([2 * seed + 1, 2 * seed + 2], np.uint64))
    found = np.full(len(starts), keys[0], np.uint64)
    counts = np.diff(borders)
    first = np.flatnonzero(counts > 0)
    found[first] = mix64(found[first] ^ words[borders[first]])
    at = np.flatnonzero((counts > 1) & (counts <= SHORT_WORDS))
    several, one, other = at, found[at], mix64(keys[1] + words[borders[at]] * ODD)
    place = np.arange(len(at))
    for k in range(1, SHORT_WORDS):
        word = words[borders[at] + k]
        one[place] = mix64(one[place] ^ word)
        other[place] = mix64(other[place] + word * ODD)
        left = counts[at] > k + 1
        at, place = at[left], place[left]
    found[several] = mix64(one + other)
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(ends - starts > 8 * SHORT_WORDS).tolist():
        held = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest()
        found[i] = int.from_bytes(held, "little")
    return mix64(found + mix64((ends - starts).astype(np.uint64)))
