"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its byte pairs, the shapes of its words, words that repeat the one before
and its length, hashed into a fixed number of columns. Term weights and the latent space (a
truncated singular value decomposition) are fitted on a bounded sample of labelled rows, whose
vectors are broadcast; every document's exact cosines with all of them are computed in blocks,
and the most similar ones vote with their labels, weighted by similarity.

The sample holds at most `sample_rows` labelled documents, chosen by a hash of their ids from all rows that
may be learned from; beyond it, more labels change nothing. Everything else covers all rows.

NULL and empty texts are scored like others (their one term is their length). Labels that are
NULL are not learned from; of several labels of one doc_id the smallest counts. Without
anything to learn from, every score is 0.5. Whole texts are read. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.llm.chunks import joined
from roundhaul.llm.common import binary_array, mix64, reachable, text_blocks
from roundhaul.llm.hashing import range_hashes

#: Labelled rows that are learned from, at most.
SAMPLE_ROWS = 6000
DIMENSIONS = 48
NEIGHBOURS = 25
#: Weight of a neighbour: its cosine to this power.
SHARPNESS = 8
THRESHOLD = 0.7

PAIRS, SHAPES, LENGTHS = 1024, 6 * 6 * 6, 32
#: How much repeated words and the length count beside byte pairs and shapes.
REPEATS_WEIGHT, LENGTHS_WEIGHT = 2.0, 0.3
COLUMNS = PAIRS + SHAPES + 2 + LENGTHS
PAIR_OF = (mix64(np.arange(65536, dtype=np.uint64) + np.uint64(17)) % np.uint64(PAIRS)).astype(np.int64)


def _byte_classes() -> np.ndarray:
    """0 control, 1 lower case, 2 upper case, 3 digit, 4 other ASCII, 5 beyond ASCII."""
    kinds = np.full(256, 4, np.int64)
    kinds[:33] = 0
    kinds[ord("a") : ord("z") + 1] = 1
    kinds[ord("A") : ord("Z") + 1] = 2
    kinds[ord("0") : ord("9") + 1] = 3
    kinds[128:] = 5
    return kinds


CLASSES = _byte_classes()


def features(texts: list[str]) -> np.ndarray:
    """Square roots of the terms' shares, each kind of term by itself (rows, COLUMNS)."""
    data, borders = joined(texts)
    rows = len(texts)
    owner = np.repeat(np.arange(rows), np.diff(borders))
    pairs = np.zeros((rows, PAIRS))
    if len(data) > 1:
        inside = owner[1:] == owner[:-1]
        code = PAIR_OF[data[:-1].astype(np.int64) * 256 + data[1:]]
        pairs = np.bincount((owner[1:] * PAIRS + code)[inside], minlength=rows * PAIRS).reshape(rows, PAIRS)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.zeros(len(data) + 1, bool)
    begins[borders] = True
    before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    before[1:], after[:-1] = blank, blank
    starts = np.flatnonzero(~blank & (before | begins)[:-1])
    ends = np.flatnonzero(~blank & (after | begins)[1:]) + 1
    where = owner[starts]
    shape = CLASSES[data[starts]] * 36 + CLASSES[data[ends - 1]] * 6 + np.minimum(np.log2(ends - starts).astype(int), 5)
    shapes = np.bincount(where * SHAPES + shape, minlength=rows * SHAPES).reshape(rows, SHAPES)
    hashes = range_hashes(data, starts, ends)
    again = np.zeros(len(starts), np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (where[1:] == where[:-1])
    repeats = np.bincount(where * 2 + again, minlength=rows * 2).reshape(rows, 2)
    words = repeats.sum(axis=1)
    lengths = np.zeros((rows, LENGTHS))
    lengths[np.arange(rows), np.minimum(np.log2(words + 1).astype(int), LENGTHS - 1)] = 1
    out = np.empty((rows, COLUMNS), np.float32)
    at = 0
    for part, weight in ((pairs, 1.0), (shapes, 1.0), (repeats, REPEATS_WEIGHT), (lengths, LENGTHS_WEIGHT)):
        scale = weight / np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1))
        np.multiply(np.sqrt(part.astype(np.float32)), scale.astype(np.float32), out=out[:, at : at + part.shape[1]])
        at += part.shape[1]
    return out


def crc_remainder(doc_id: Column | str) -> Column:
    """crc32 of an id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


@dataclass(frozen=True)
class Model:
    space: np.ndarray  # (terms, dimensions), with the terms' weights in it
    vectors: np.ndarray  # of the labelled rows, of length 1
    labels: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        points = rows @ self.space
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        cosines = self.project(features(texts)) @ self.vectors.T
        count = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-3).astype(np.float64) ** SHARPNESS
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def fit_rows(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    weights = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    weighted = rows * weights
    _, directions = np.linalg.eigh(weighted.T @ weighted)
    space = (weights[:, None] * directions[:, ::-1][:, :dimensions]).astype(np.float32)
    empty = Model(space, np.zeros((0, dimensions)), labels)
    return Model(space, empty.project(rows).astype(np.float32), labels)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from labelled rows whose `crc_remainder` isn't 2; labels have doc_id and `label` (0 or 1)."""
    reachable(docs.sparkSession)
    usable = labels.where(F.col(label).isNotNull() & (crc_remainder("doc_id") != 2))
    chosen = usable.groupBy("doc_id").agg(F.min(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(2)):
                rows = features(texts).astype("<f4")
                cells = binary_array(rows.ravel(), np.arange(len(rows) + 1) * COLUMNS)
                part = batch.slice(done, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cells], ["doc_id", "label", "terms"])
                done += len(texts)

    given = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Rows that repeat a doc_id count once, by the first of their texts, so the bound holds for any table.
    known = given.groupBy("doc_id").agg(F.first("label").cast("double").alias("label"), F.min("text").alias("text"))
    table = known.mapInArrow(described, f"doc_id {kind}, label double, terms binary").orderBy("doc_id").toArrow()
    if not table.num_rows:
        return Model(np.zeros((COLUMNS, 1)), np.zeros((0, 1)), np.zeros(0))
    rows = np.frombuffer(b"".join(table.column("terms").to_pylist()), "<f4").reshape(-1, COLUMNS)
    return fit_rows(rows, table.column("label").to_numpy())


def score(spark: SparkSession, text: Column | str, model: Model) -> Column:
    """How likely a text has the label 1, from 0 to 1."""
    reachable(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [sent.value.scores(part) for texts in text_blocks(batch) for part in _tens(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return scores(text)


def _tens(texts: list[str], rows: int = 256) -> Iterator[list[str]]:
    """Blocks of documents whose cosines with all labelled vectors are held at once."""
    for start in range(0, len(texts), rows):
        yield texts[start : start + rows]


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least `threshold`, with all their columns."""
    model = fit(docs, labels)
    return docs.where(score(docs.sparkSession, "text", model) >= threshold)
