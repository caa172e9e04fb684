"""Documents as pieces of token ids, dealt into shards for packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.llm import bpe
from roundhaul.llm.common import binary_array, reachable, text_blocks

#: Bytes of text that one shard's pieces come from; a packing loses less than a sequence in each.
SHARD_BYTES = 8 * 1024**2
SHARD = "__shard"
ENCODERS: dict[str, Callable] = {"word": bpe.word_bpe, "byte": bpe.byte_bpe}


def cut_pieces(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece its document, its number and where it starts; an empty document has none."""
    counts = -(-lengths // longest)
    owner = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, number, number * longest


def token_pieces(docs: DataFrame, vocabulary: str, kind: str, longest: int, end_id: int, width: str = "<u4") -> DataFrame:
    """Pieces of at most `longest` ids: doc_id, piece (from 0), start, length, ids (binary).

    A document's ids are those of its whole text (NULL: empty) and then `end_id`; only documents
    of more than `longest` ids are cut, and their pieces in order hold all ids. `ids` holds the
    numbers in the given fixed width; a vocabulary with ids beyond it stops the job. Rows that repeat are kept, each with its pieces; other
    columns of `docs` are left out.
    """
    reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ENCODERS[kind](vocabulary)
        if max(encoder.largest, end_id) > np.iinfo(width).max:
            raise ValueError(f"{vocabulary}: the id {max(encoder.largest, end_id)} does not fit numbers of the type {width}")
        for batch in batches:
            done = 0
            for texts in text_blocks(batch.column(1)):
                ids, borders = encoder.encode(texts)
                ids = np.insert(ids, borders[1:], end_id).astype(width)
                borders = borders + np.arange(len(borders))
                lengths = np.diff(borders)
                owner, number, start = cut_pieces(lengths, longest)
                length = np.minimum(lengths[owner] - start, longest)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(texts)).take(pa.array(owner)),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        binary_array(ids, np.append(0, np.cumsum(length))),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )
                done += len(texts)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def shard_count(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """How many shards of about `shard_bytes` the documents' texts make."""
    total = docs.select(F.sum(F.octet_length("text") + F.lit(64)).alias("total")).first()["total"]
    return max(1, -(-int(total or 0) // shard_bytes))


def by_shard(pieces: DataFrame, shards: int, place: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Deal the pieces into shards of like size and apply `place` to each shard's rows.

    No shard depends on another. A piece's shard depends on its content and its place in its file, which
    deals rows that repeat over all shards; a lost task reads the same places and gives the same rows again.
    """
    content = "ids" if "ids" in pieces.columns else "ids_crc32"
    spread = F.pmod(F.xxhash64("doc_id", "piece", content, F.monotonically_increasing_id()), F.lit(shards))
    return pieces.withColumn(SHARD, spread).groupBy(SHARD).applyInArrow(place, schema)
