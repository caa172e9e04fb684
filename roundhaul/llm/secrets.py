"""Secret scans: known patterns, and random strings that a vocabulary spells inefficiently.

Pattern spans: `assign` (a key word, a separator, a value), `access` (AKIA and more) and `hex`.
The method adds `token` spans: runs of key characters that take a token for every few characters
under a public vocabulary, where words take far fewer. Known forms that look random but aren't
secret (digests by their length, UUIDs, plain numbers, also joined by separators) are left out,
and so are runs that a pattern span already touches. All others are counted, whatever their case.

Starts and ends count code points. NULL and empty texts have no spans. Whole texts are scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.llm.bpe import ByteBpe, byte_bpe
from roundhaul.llm.common import reachable, text_blocks

# The patterns of known secrets, the least lengths, and the order of the kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "token")

#: Runs that may be keys, and the fewest characters of one.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Digest lengths in hexadecimal: 128, 160, 224, 256, 384 and 512 bits.
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Numbers, joined by separators.
NUMBERS = re.compile(r"[0-9]+(?:[+/_=-]+[0-9]+)*[+/_=-]*")

#: A run is random if it has fewer characters for each token than this.
CHARS_PER_TOKEN = 2.0

SPANS = "array<struct<kind:string,start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def known_form(run: str) -> bool:
    """Whether a run is a digest, an identifier or numbers."""
    if len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run):
        return True
    return bool(UUID.fullmatch(run) or NUMBERS.fullmatch(run))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's rank, end) of what the patterns match, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def random_spans(text: str, held: list[tuple[int, int, int]], vocabulary: ByteBpe, ratio: float):
    """Runs of few characters a token that no pattern span touches."""
    for match in RUN.finditer(text):
        start, end = match.span()
        if any(a < end and start < b for a, _, b in held) or known_form(match[0]):
            continue
        if end - start < ratio * len(vocabulary.library.encode_ordinary(match[0])):
            yield start, 3, end


def spans_of(text: str, vocabulary: ByteBpe, ratio: float = CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    found = pattern_spans(text)
    return sorted(found + list(random_spans(text, found, vocabulary, ratio)))


def found_spans(spark: SparkSession, text: Column | str, vocabulary: str, ratio: float = CHARS_PER_TOKEN) -> Column:
    """The spans of a text, by start and then by kind."""
    reachable(spark)

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = byte_bpe(vocabulary)
        for batch in batches:
            rows = [
                [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans_of(text, known, ratio)]
                for block in text_blocks(batch)
                for text in block
            ]
            yield pa.array(rows, ARROW_SPANS)

    return scan(text)


def scan(docs: DataFrame, vocabulary: str, text: str = "text", spans: str = "spans") -> DataFrame:
    """`docs` with the spans of each text in a new column (an existing one of that name is replaced)."""
    return docs.withColumn(spans, found_spans(docs.sparkSession, F.col(text), vocabulary))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def cover(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with every stretch that spans cover replaced by one mask."""
    joined: list[list[int]] = []
    for start, _, end in spans:
        if joined and start < joined[-1][1]:
            joined[-1][1] = max(end, joined[-1][1])
        else:
            joined.append([start, end])
    edges = [0, *(edge for pair in joined for edge in pair), len(text)]
    kept = [text[a:b] for a, b in list(pairwise(edges))[::2]]
    return mask.join(kept)


def redacted(spark: SparkSession, text: Column | str, vocabulary: str, mask: str = "[secret]") -> Column:
    """The text with its secrets replaced; a text without any stays as it is, NULL too."""
    reachable(spark)

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = byte_bpe(vocabulary)
        for batch in batches:
            texts = (text for block in text_blocks(batch) for text in block)
            rows = [cover(text, spans_of(text, known), mask) for text in texts]
            yield pa.array(rows, pa.string())

    return F.when(F.col(text).isNotNull() if isinstance(text, str) else text.isNotNull(), redact(text))
