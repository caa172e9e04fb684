"""Comparing all rows of a bucket in blocks of bounded size, two blocks at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, *columns: str) -> DataFrame:
    """Deal each bucket's rows into `parts` blocks, and each row to every pair of blocks that holds its own.

    Takes (bucket, id, parts) and the given columns. Gives id, those columns, `own` (the row's
    block), `block` (the pair) and `apart`: whether the pair has two blocks, so that only rows
    of different ones are to be compared.
    """
    parts = F.col("parts")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    every = members.select("bucket", "id", *columns, own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    return every.select(
        "id",
        *columns,
        "own",
        (F.col("own") != F.col("other")).alias("apart"),
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
    )


def by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block")


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key; the batches come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(start, end - start))
            if end < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of `size` rows the least row that links reach."""
    least = np.arange(size)
    while True:
        before = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
        if (least == before).all():
            return least
