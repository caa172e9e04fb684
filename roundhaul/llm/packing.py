"""Packing documents into token sequences by the sum-of-squares rule.

Pieces are placed longest first. With N(g) open sequences of residual gap g, a piece goes where
the sum of all N(g)^2 becomes smallest; among equals, into the smallest gap. A sequence is
opened only if the piece fits nowhere. Sequences stay within a shard of bounded size, so a
corpus of any size is packed side by side, at a loss of less than one sequence in a shard.

NULL and empty texts are documents of the end id alone. Repeated rows are packed one by one. A
table without rows gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from roundhaul.llm.pieces import SHARD, SHARD_BYTES, by_shard, shard_count, token_pieces

CAPACITY = 2048
END_ID = 0


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A sequence and a place in it for each length, taken in the given order."""
    counts = np.zeros(capacity + 1, np.int64)
    holders: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        open_now = counts[length:capacity]
        gap = capacity
        if open_now.any():
            after = counts[: capacity - length]
            change = 2 * (after - open_now) + 2
            change[0] = 1 - 2 * open_now[0]  # a full sequence is not open any more
            gap = length + int(np.where(open_now > 0, change, np.iinfo(np.int64).max).argmin())
        if gap == capacity:
            sequence[i], opened = opened, opened + 1
        else:
            sequence[i] = holders[gap].pop()
            counts[gap] -= 1
        offset[i] = capacity - gap
        if gap > length:
            counts[gap - length] += 1
            holders[gap - length].append(int(sequence[i]))
    return sequence, offset


def pack(pieces: DataFrame, shards: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; all their columns stay."""

    def place(table: pa.Table) -> pa.Table:
        shard = table.column(SHARD)[0].as_py()
        keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        table = table.drop_columns([SHARD]).take(pc.sort_indices(table, keys))
        sequence, offset = sum_of_squares(table.column("length").to_numpy(), capacity)
        table = table.append_column("sequence_id", pa.array(sequence + (shard << 32), pa.int64()))
        return table.append_column("offset", pa.array(offset, pa.int64()))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return by_shard(pieces, shards, place, f"{names}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, piece, start, length, ids (unsigned 32-bit, little-endian), sequence_id, offset."""
    pieces = token_pieces(docs, vocabulary, "word", capacity, end_id)
    return pack(pieces, shard_count(docs, shard_bytes), capacity)
