"""Packed id matrices by best-fit-decreasing with a segment tree over capacities.

Each output row is one sequence: a matrix row of `capacity` ids (padded at its end), the
cumulative lengths of its segments, and position ids that start at 0 in each segment. Documents
longer than a row are cut; the pieces in order hold all their ids, and the vocabulary keeps
every byte, so texts can be read back.

NULL and empty texts are documents of the end id alone. Repeated rows are packed one by one. A
table without rows gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from roundhaul.llm.common import binary_array, list_array
from roundhaul.llm.pieces import SHARD, SHARD_BYTES, by_shard, shard_count, token_pieces

CAPACITY = 2048
END_ID = 50256
#: Ids below 65,536 fit in two bytes.
WIDTH = "<u2"
SCHEMA = (
    "sequence_id long, n_tokens int, n_segments int, doc_ids array<long>, pieces array<int>, starts array<long>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary"
)


class CapacityTree:
    """Open sequences by residual gap: a segment tree whose nodes count those below them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, gap: int, change: int) -> None:
        node = gap + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def least(self, gap: int) -> int | None:
        """The smallest gap of an open sequence that is at least `gap`."""
        node = gap + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A sequence and a place in it for each length, taken in the given order."""
    tree = CapacityTree(capacity)
    holders: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, length in enumerate(lengths.tolist()):
        gap = tree.least(length)
        if gap is None:
            gap, held, opened = capacity, opened, opened + 1
        else:
            held = holders[gap].pop()
            tree.add(gap, -1)
        sequence[i], offset[i] = held, capacity - gap
        if gap > length:
            tree.add(gap - length, 1)
            holders[gap - length].append(held)
    return sequence, offset


def matrices(table: pa.Table, capacity: int, pad_id: int) -> pa.Table:
    """The sequences of one shard's pieces."""
    shard = table.column(SHARD)[0].as_py()
    keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
    table = table.take(pc.sort_indices(table, keys)).combine_chunks()
    lengths = table.column("length").to_numpy()
    sequence, offset = best_fit(lengths, capacity)
    order = np.lexsort((offset, sequence))
    rows = int(sequence.max()) + 1
    ids = np.full((rows, capacity), pad_id, WIDTH)
    positions = np.zeros((rows, capacity), WIDTH)
    for row, at, length, cell in zip(
        sequence.tolist(), offset.tolist(), lengths.tolist(), table.column("ids").to_pylist(), strict=True
    ):
        ids[row, at : at + length] = np.frombuffer(cell, WIDTH)
        positions[row, at : at + length] = np.arange(length)
    segments = np.bincount(sequence, minlength=rows)
    borders = np.append(0, np.cumsum(segments))
    ends = (offset + lengths)[order]
    cumulative = np.insert(ends, borders[:-1], 0)
    cells = np.arange(rows + 1) * capacity
    held = table.take(pa.array(order)).combine_chunks()

    def lists(name: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), held.column(name).combine_chunks())

    return pa.table(
        {
            "sequence_id": pa.array(np.arange(rows) + (shard << 32), pa.int64()),
            "n_tokens": pa.array(ends[borders[1:] - 1], pa.int32()),
            "n_segments": pa.array(segments, pa.int32()),
            "doc_ids": lists("doc_id"),
            "pieces": lists("piece"),
            "starts": lists("start"),
            "cu_seqlens": list_array(cumulative, borders + np.arange(rows + 1), pa.int32()),
            "input_ids": binary_array(ids.ravel(), cells),
            "position_ids": binary_array(positions.ravel(), cells),
        }
    )


def packed_matrices(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per sequence; ids and positions are little-endian unsigned 16-bit numbers."""
    if not 0 < capacity < 1 << 16 or not 0 <= end_id < 1 << 16:
        raise ValueError("capacity and end_id must fit in 16 bits")
    pieces = token_pieces(docs, vocabulary, "byte", capacity, end_id, WIDTH)
    return by_shard(pieces, shard_count(docs, shard_bytes), lambda table: matrices(table, capacity, end_id), SCHEMA)


def write_packed(sequences: DataFrame, path: str) -> None:
    """Parquet files whose binary cells are the rows of the id and position matrices."""
    sequences.write.parquet(path)
