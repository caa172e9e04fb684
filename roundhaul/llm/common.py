"""What the operators share: written intermediate tables, small blocks of rows, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import roundhaul
from roundhaul.session import fresh_folder

#: Bytes of text that a task works on at once.
BLOCK_BYTES = 2_000_000


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver's working folder is another one."""
    root = str(Path(roundhaul.__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


class Scratch:
    """Intermediate tables of one run, written as Parquet under the shared folder.

    A written table cuts the lineage: a lost executor costs its own tasks, not the stages
    before. `drop` removes a table once nothing reads it any more; what a lazy result still
    reads stays until its owner calls `drop_all`.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_folder(spark, label)
        self.paths: dict[str, str] = {}

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        frame.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._delete(self.paths.pop(name))

    def drop_all(self) -> None:
        self.paths.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def blocks(sizes: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to at most `limit`; a larger row stands alone."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, end
        start = end


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[list[str]]:
    """The texts of an Arrow array in blocks, NULL as the empty text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for start, end in blocks(sizes + 64, limit):
        yield [text or "" for text in texts.slice(start, end - start).to_pylist()]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary cells cut from one buffer; offsets count the items of `values`."""
    width = values.dtype.itemsize
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(data)]
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mix of 64-bit words (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
