"""Document fingerprints: a Merkle tree over spans, paragraphs and sections.

Leaves are spans of words, ended where a word's hash says so (every word in short paragraphs),
so an edit changes the spans around it alone. A paragraph (line) hashes its spans, a section
(paragraphs up to a blank line, or to one whose hash says so) its paragraphs, the root its
sections. A fingerprint lists the whole tree:

    root#section:paragraph.spans,paragraph.spans/section:...

with 32 hexadecimal digits for the root, 16 for a section or paragraph and 8 for each span.
Equal texts have equal fingerprints; equal roots mean equal texts (but for white space at the
ends of spans, which the paragraph's hash still sees). NULL is the empty text, whose tree is a
root alone. Trees are built from whole texts.

The text after a document is that of the next smaller doc_id (after the smallest: the largest);
rows that repeat an id follow each other by text. Rows without an id follow each other by text
within groups, the last of a group is followed by the largest id.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roundhaul.llm.common import blocks, reachable
from roundhaul.llm.chunks import joined
from roundhaul.llm.hashing import range_hashes

#: Words in a span, and paragraphs in a section, on average; words of a paragraph that is cut at each.
SPAN_WORDS, SECTION_PARAGRAPHS, SHORT_PARAGRAPH = 8, 4, 16
#: Documents in one range of ids, at least, and ranges for each partition of a shuffle, at most: enough for
#: partitions of like size, and a number that the session's settings bound, not the rows.
SLOT_ROWS, SLOTS_PER_PARTITION = 200, 4
#: Groups for rows without an id.
LOOSE_SLOTS = 64

NEXT = "__next"


def _digest(parts: bytes, size: int = 8) -> bytes:
    return hashlib.blake2b(parts, digest_size=size).digest()


def trees(texts: list[str]) -> list[tuple[str, np.ndarray]]:
    """The fingerprint of each text, and the hashes of its spans."""
    data, borders = joined(texts)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.zeros(len(data) + 1, bool)  # of lines
    begins[1:] = data == 10
    begins[borders] = True
    lines = np.flatnonzero(begins)
    fresh = begins[:-1].copy()  # after a blank or at a line's start
    fresh[1:] |= blank[:-1]
    word = np.flatnonzero(fresh & ~blank)
    stop = np.append(word[1:], len(data))
    line = np.searchsorted(lines, word, side="right") - 1
    stop = np.minimum(stop, lines[np.minimum(line + 1, len(lines) - 1)])
    hashes = range_hashes(data, word, stop)
    size = np.bincount(line, minlength=len(lines))
    ends = (hashes % np.uint64(SPAN_WORDS) == 0) | (size[line] < SHORT_PARAGRAPH)
    ends |= np.append(line[1:] != line[:-1], True) if len(line) else False
    last = np.flatnonzero(ends)
    begin = word[np.append(0, last[:-1] + 1)] if len(last) else word
    spans = range_hashes(data, begin, stop[last]).astype(">u8")
    cells = spans.astype(">u4")  # the low half of each hash
    span_line = line[last]
    held, span_bytes = data.tobytes(), cells.tobytes()
    first_span = np.searchsorted(span_line, np.arange(len(lines) + 1))
    first_line = np.searchsorted(lines, borders)
    out = []
    for i, text in enumerate(texts):
        a, b = int(first_line[i]), int(first_line[i + 1])
        sections, paragraphs, nodes, roots = [], [], [], []
        for j in range(a, b if text else a):
            start, end = int(lines[j]), int(lines[j + 1])
            at, to = int(first_span[j]), int(first_span[j + 1])
            node = _digest(held[start:end])
            paragraphs.append(f"{node.hex()}.{span_bytes[4 * at : 4 * to].hex()}")
            nodes.append(node)
            if at == to or node[0] % SECTION_PARAGRAPHS == 0 or j == b - 1:
                roots.append(_digest(b"".join(nodes)))
                sections.append(f"{roots[-1].hex()}:{','.join(paragraphs)}")
                paragraphs, nodes = [], []
        root = _digest(b"".join(roots), 16).hex()
        at, to = int(first_span[a]), int(first_span[b]) if text else int(first_span[a])
        out.append((f"{root}#{'/'.join(sections)}", cells[at:to]))
    return out


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """Spans in common over those of the larger tree, each counted as often as it occurs; 1 for equal roots."""
    if a[0][:32] == b[0][:32]:
        return 1.0
    if not len(a[1]) or not len(b[1]):
        return 0.0
    keys, counts = np.unique(a[1], return_counts=True)
    others, more = np.unique(b[1], return_counts=True)
    _, here, there = np.intersect1d(keys, others, assume_unique=True, return_indices=True)
    return float(np.minimum(counts[here], more[there]).sum() / max(len(a[1]), len(b[1])))


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """The numbers of the paragraphs of either fingerprint that the other one lacks, or has fewer times.

    Walked from the roots: below equal roots and equal sections nothing is compared. The order of
    paragraphs doesn't count.
    """
    if a[:32] == b[:32]:
        return [], []

    def branches(fingerprint: str) -> list[tuple[str, int, str]]:
        """Each section's hash, the number of its first paragraph, and what is below it."""
        tree, first, out = fingerprint.split("#", 1)[1], 0, []
        for section in tree.split("/") if tree else []:
            node, below = section.split(":", 1)
            out.append((node, first, below))
            first += below.count(",") + 1
        return out

    def left(own: list, other: list) -> list:
        """The items of one side without those that the other side has, each as often as it has it."""
        more = Counter(item[0] for item in other)
        out = []
        for item in own:
            if more[item[0]]:
                more[item[0]] -= 1
            else:
                out.append(item)
        return out

    def paragraphs(sections: list[tuple[str, int, str]]) -> list[tuple[str, int]]:
        return [(p.split(".", 1)[0], first + i) for _, first, below in sections for i, p in enumerate(below.split(","))]

    one, two = branches(a), branches(b)
    one, two = paragraphs(left(one, two)), paragraphs(left(two, one))
    return [number for _, number in left(one, two)], [number for _, number in left(two, one)]


def followed(docs: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """doc_id, text, and the text that follows in descending order of doc_id.

    Rows are dealt into ranges of ids whose upper ends are ids that occur. So the row after a
    range's last is the one with the upper end of the range below, and a copy of it is added:
    one shuffle by range, no global order. A range is sorted by Spark, which spills; no range is held.
    There are no more ranges than a few for each partition of a shuffle, so their ends, which the driver sends to
    all tasks, don't grow with the rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    reachable(docs.sparkSession)
    rows = docs.agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("most")).first()
    most = SLOTS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = min(-(-rows["n"] // slot_rows), most)
    ends = np.zeros(0, np.int64)
    if slots:
        shares = F.percentile_approx("doc_id", [i / slots for i in range(1, slots)] or [1.0], max(10_000, 20 * slots))
        ends = np.unique([*docs.select(shares.alias("at")).first()["at"], rows["most"]]).astype(np.int64)

    @F.arrow_udf("int")
    def slot_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(ends, ids.to_numpy(zero_copy_only=False)), pa.int32())

    loose = -1 - F.pmod(F.xxhash64("text"), F.lit(LOOSE_SLOTS)).cast("int")
    placed = docs.withColumn(
        "slot", F.when(F.col("doc_id").isNull(), loose).otherwise(slot_of(F.coalesce("doc_id", F.lit(0))))
    )
    pairs = [(int(end), (i + 1) % len(ends)) for i, end in enumerate(ends)]
    if len(ends):
        pairs += [(int(ends[-1]), -1 - i) for i in range(LOOSE_SLOTS)]
    following = docs.sparkSession.createDataFrame(pairs, "doc_id long, slot int")
    extra = docs.join(F.broadcast(following), "doc_id").withColumn("extra", F.lit(True))
    order = Window.partitionBy("slot").orderBy("extra", F.col("doc_id").desc(), "text")
    stacked = placed.withColumn("extra", F.lit(False)).unionByName(extra)
    ordered = stacked.withColumn(NEXT, F.coalesce(F.lead("text").over(order), F.lit("")))
    return ordered.where("NOT extra").select("doc_id", "text", NEXT)


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each row its fingerprint, that of its edited text, and how like it is to that and to the next text.

    Columns: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next, and the
    numbers of the paragraphs (from 0, joined by commas) that the edit took out (`edited_out`) and put in (`edited_in`).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(t.as_py()) for t in batch.column(1)], np.int64)
            for start, end in blocks(sizes + 64):
                texts = batch.column(1).slice(start, end - start).to_pylist()
                nexts = batch.column(2).slice(start, end - start).to_pylist()
                edited = [edited_text(text, after) for text, after in zip(texts, nexts, strict=True)]
                every = list(dict.fromkeys([*texts, *nexts, *edited]))
                tree = dict(zip(every, trees(every), strict=True))
                places = [differing(tree[a][0], tree[b][0]) for a, b in zip(texts, edited, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(edited, pa.string()),
                        pa.array([tree[t][0] for t in texts], pa.string()),
                        pa.array([tree[t][0] for t in edited], pa.string()),
                        pa.array([likeness(tree[a], tree[b]) for a, b in zip(texts, edited, strict=True)], pa.float64()),
                        pa.array([likeness(tree[a], tree[b]) for a, b in zip(texts, nexts, strict=True)], pa.float64()),
                        *(pa.array([",".join(map(str, pair[side])) for pair in places], pa.string()) for side in (0, 1)),
                    ],
                    [
                        *("doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"),
                        *("edited_out", "edited_in"),
                    ],
                )

    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_text string, "
        "fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
        "edited_out string, edited_in string"
    )
    return followed(docs).mapInArrow(run, schema)
