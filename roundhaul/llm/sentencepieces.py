"""SentencePiece encoding through a distinct-chunk table, and decoding.

A chunk is a run of whitespace markers with the word after it. No piece of the model has a
marker after another character, so no merge crosses the border before a marker: each distinct
marked word is segmented once in a worker's table and its ids are put back at every position.
A model for which that does not hold is refused.

NULL and empty texts have no ids; an empty or NULL list of ids decodes to the empty text.
Whole texts are encoded, whatever their length. Other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.llm.chunks import ChunkTable, cut, joined
from roundhaul.llm.common import list_array, reachable, text_blocks

MARKER = "▁"


class Pieces:
    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        kinds = range(self.library.get_piece_size())
        if any(re.search(f"[^{MARKER}]{MARKER}", self.library.id_to_piece(i)) for i in kinds):
            raise ValueError(f"{model}: a piece crosses a whitespace marker")
        if self.library.encode("a b  c") != self.library.encode(f"a{MARKER}b{MARKER}{MARKER}c"):
            raise ValueError(f"{model}: white space is not kept as markers")
        self.marker = [self.library.piece_to_id(MARKER)]
        self.table = ChunkTable(self._segment)

    def _segment(self, chunks: list[bytes]) -> list[list[int]]:
        """The encoder puts a marker before whatever it is given, in place of the first blank."""
        found = self.library.encode([chunk[1:].decode() for chunk in chunks], num_threads=1)
        return [ids if len(chunk) > 1 else self.marker for chunk, ids in zip(chunks, found, strict=True)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the borders between those of the texts."""
        data, borders = joined([text.replace(MARKER, " ") for text in texts], before=" ")
        blank = data == ord(" ")
        marks = blank.copy()
        marks[1:] &= ~blank[:-1]
        return self.table.encode(data, *cut(data, borders, marks))


@cache
def pieces(model: str) -> Pieces:
    """One for each worker, so that the table serves all its tasks."""
    return Pieces(model)


def encoded(spark: SparkSession, text: Column | str, model: str) -> Column:
    """The ids of a text, without begin or end ids, as the library's `encode` gives them."""
    reachable(spark)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [list_array(*pieces(model).encode(block), pa.int32()) for block in text_blocks(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode(text)


def decoded(spark: SparkSession, ids: Column | str, model: str) -> Column:
    """The text of a list of ids, as the library's `decode` gives it."""
    reachable(spark)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([pieces(model).library.decode(row.as_py() or []) for row in batch], pa.string())

    return decode(ids)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the ids of each text in a new column (an existing one of that name is replaced)."""
    return docs.withColumn(ids, encoded(docs.sparkSession, F.col(text), model))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and decoded (the text of the ids) for each row of (doc_id, text), in one pass.

    Rows leave in small batches, so a task holds the ids of a few megabytes of text at a time.
    """
    reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1)):
                values, borders = pieces(model).encode(texts)
                spans = zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)
                read = [pieces(model).library.decode(values[a:b].tolist()) for a, b in spans]
                columns = [batch.column(0).slice(done, len(texts)), list_array(values, borders, pa.int32()), pa.array(read, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])
                done += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
