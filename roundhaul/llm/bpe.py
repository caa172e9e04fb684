"""Ids of two public BPE vocabularies, through distinct-chunk tables cut at single spaces.

Both libraries split a text into words before they merge, never across a space that follows
another character. Ids are those that the libraries give for the whole text.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import regex
import tiktoken
import tokenizers

from roundhaul.llm.chunks import ChunkTable, cut, joined

# The word patterns of the two vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACED_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters that the normalizer only lower-cases, each by itself.
PLAIN = re.compile("[\n !-~¡-ÿ]*")


#: Stands between chunks; no plain chunk holds it.
BETWEEN = "\t"
#: Words that a worker remembers besides its chunks.
KNOWN_WORDS = 100_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in printable)}
    return [chr(others.get(byte, byte)) for byte in range(256)]


class WordBpe:
    """A lower-casing BPE with word ends (a `tokenizers` file); white space is dropped."""

    def __init__(self, path: str):
        self.library = tokenizers.Tokenizer.from_file(path)
        self.model = self.library.model
        self.words = regex.compile(f"{BETWEEN}|{WORDS}")
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[str, list[int]] = {}
        self.largest = max(self.library.get_vocab().values())
        self.table = ChunkTable(self._segment)

    def _word(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(word)]

    def _segment(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [chunk.decode() for chunk in chunks]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        plain = [text if PLAIN.fullmatch(text) and "<|" not in text else "" for text in texts]
        out: list[list[int]] = [[]]
        for word in self.words.findall(BETWEEN.join(plain).lower()):
            if word == BETWEEN:
                out.append([])
                continue
            ids = self.known.get(word)
            if ids is None:
                ids = self.known[word] = self._word(word)
            out[-1] += ids
        for i, text in enumerate(texts):
            if text and not plain[i]:
                out[i] = self.library.encode(text, add_special_tokens=False).ids
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders between those of the texts."""
        data, borders = joined(texts)
        return self.table.encode(data, *cut(data, borders, data == ord(" ")))


class ByteBpe:
    """A byte-level BPE that keeps every byte (a `tiktoken` rank file)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding(path, pat_str=SPACED_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.size = len(ranks)
        self.largest = max(ranks.values())
        self.table = ChunkTable(self._segment)

    def _segment(self, chunks: list[bytes]) -> list[list[int]]:
        return [self.library.encode_ordinary(chunk.decode()) for chunk in chunks]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders between those of the texts.

        A chunk starts at a space that surely follows something else than white space: printable
        ASCII, or a character whose first UTF-8 byte no white space has.
        """
        data, borders = joined(texts)
        marks = np.zeros(len(data), bool)
        marks[1:] = (data[1:] == ord(" ")) & (data[:-1] > 32) & (data[:-1] < 127)
        for size, least, most in ((2, 0xC3, 0xDF), (3, 0xE4, 0xEF), (4, 0xF0, 0xFF)):
            if len(data) > size:
                marks[size:] |= (data[size:] == ord(" ")) & (data[:-size] >= least) & (data[:-size] <= most)
        return self.table.encode(data, *cut(data, borders, marks))


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@cache
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)
