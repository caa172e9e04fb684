"""Near-duplicate vectors: random-hyperplane hashing in several tables, exact verification, components.

Vectors are compared only within one label. Those with equal components are one class, hashed
and compared once, so copies are never paired with each other. In each table a class falls into
the bucket of its signs against some random hyperplanes. Buckets are compared in blocks of
bounded size by exact cosines in double precision; a link counts in the first table that puts
both ends into one bucket. Blocks report the links of each class, and a forest of them for the
components, so no pairs leave a task.

The number of hyperplanes follows the number of classes, so that unlike vectors rarely meet, and
the number of tables follows from it: a pair at the threshold is missed with a probability of
at most `miss`.

Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, and
so do those without a label, and vectors of different lengths. Rows that repeat entirely count
as one vector; rows that share an id and differ are vectors of their own, told apart by their contents. A row without an id has no links, no component, and is kept. An empty table
gives no rows. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.llm.blocks import block_pairs, by_block, forest, groups
from roundhaul.llm.common import Scratch, mix64, reachable
from roundhaul.llm.components import components

THRESHOLD = 0.98
MISS = 1e-5
#: Rows of a block: in a bucket of n rows each row is sent to n / BLOCK_ROWS pairs of blocks.
BLOCK_ROWS = 1024
#: Linked pairs whose earlier tables are looked at together.
PAIRS_AT_ONCE = 100_000
SEED = 20240229


def plan_tables(classes: int, threshold: float, miss: float) -> tuple[int, int]:
    """Hyperplanes in a table, and tables."""
    planes = max(4, math.ceil(math.log2(max(classes, 1))))
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** planes
    tables = 1 if agree >= 1 else math.ceil(math.log(miss) / math.log1p(-agree))
    return planes, max(1, tables)


def signatures(vectors: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """The bucket of each vector in each table (rows, tables)."""
    normals = np.random.default_rng([SEED, vectors.shape[1]]).standard_normal((vectors.shape[1], planes * tables))
    signs = (vectors @ normals >= 0).reshape(len(vectors), tables, planes)
    weights = mix64(np.arange(1, planes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(signs, weights, np.uint64(0)).sum(axis=2, dtype=np.uint64)


def unit_rows(cells: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def block_links(ids: np.ndarray, copies: np.ndarray, sides: np.ndarray, units: np.ndarray, seen: np.ndarray, table: int, same: bool, threshold: float):
    """(id, linked copies, smallest id reached) of the rows of one block pair that have links."""
    order = np.argsort(ids)
    ids, copies, sides, units, seen = ids[order], copies[order], sides[order], units[order], seen[order]
    near = np.triu(units @ units.T >= threshold, 1)
    if not same:
        near &= sides[:, None] != sides[None, :]
    a, b = np.nonzero(near)
    first = np.ones(len(a), bool)
    for start in range(0, len(a) if table else 0, PAIRS_AT_ONCE):
        part = slice(start, start + PAIRS_AT_ONCE)
        first[part] = ~(seen[a[part], :table] == seen[b[part], :table]).any(axis=1)
    a, b = a[first], b[first]
    links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    rows = np.unique(np.concatenate([a, b]))
    return ids[rows], links[rows].astype(np.int64), ids[forest(len(ids), a, b)[rows]]


def near_duplicates(
    vectors: DataFrame,
    scratch: Scratch,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    reachable(spark)
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    size = F.size("embedding")
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (size > 0) & fit & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    marks = [F.xxhash64(F.lit(seed), "label", "embedding").alias(f"h{seed}") for seed in (1, 2)]
    rows = given.select("vec_id", "embedding", "label", usable.alias("usable"), *marks)
    classes = (
        rows.where("usable")
        .groupBy("h1", "h2", "vec_id")
        .agg(F.first("embedding").alias("embedding"), F.first("label").alias("label"))
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
    )
    classes = scratch.write(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    planes, tables = plan_tables(classes.count(), threshold, miss)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            values = lists.values.to_numpy()[lists.offsets[0].as_py() :]
            begin = np.cumsum(lengths) - lengths
            cells = [values[s : s + n].astype("<f8").tobytes() for s, n in zip(begin.tolist(), lengths.tolist(), strict=True)]
            found = np.zeros((len(cells), tables), np.uint64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                found[at] = signatures(unit_rows([cells[i] for i in at]), planes, tables)
            salt = batch.column(2).to_numpy().astype(np.uint64) + lengths.astype(np.uint64)
            found = mix64(found ^ mix64(salt)[:, None])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells, pa.binary()), pa.array([row.tobytes() for row in found], pa.binary())],
                ["id", "vector", "seen"],
            )

    # The label's hash, not the label, salts the buckets: labels may be of any type.
    told = classes.select("id", "embedding", F.xxhash64("label").alias("salt"))
    points = told.mapInArrow(hashed, "id long, vector binary, seen binary")
    points = scratch.write(points.join(classes.select("id", "copies"), "id"), "points")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, tables)
            place = np.arange(tables, dtype=np.uint64)
            bucket = mix64(seen + mix64(place + np.uint64(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket.ravel().view(np.int64)),
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), len(seen))),
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(seen)), tables))),
                ],
                ["bucket", "table", "id"],
            )

    buckets = points.select("id", "seen").mapInArrow(keyed, "bucket long, table int, id long")
    full = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = buckets.join(full, "bucket")
    parts = F.ceil(F.col("n") / F.lit(block_rows)).cast("int")
    members = block_pairs(members.withColumn("parts", parts), "table")
    blocks = members.join(points.select("id", "vector", "seen", "copies"), "id")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "block"):
            if group.num_rows < 2:
                continue
            seen = np.frombuffer(b"".join(group.column("seen").to_pylist()), np.uint64).reshape(-1, tables)
            found = block_links(
                group.column("id").to_numpy(),
                group.column("copies").to_numpy(),
                group.column("own").to_numpy(),
                unit_rows(group.column("vector").to_pylist()),
                seen,
                group.column("table")[0].as_py(),
                not group.column("apart")[0].as_py(),
                threshold,
            )
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["id", "n", "reached"])

    found = scratch.write(by_block(blocks).mapInArrow(linked, "id long, n long, reached long"), "found")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("id").alias("a"), F.col("reached").alias("b")), scratch)
    # A component is named by the smallest vec_id of its classes.
    known = (
        classes.select("h1", "h2", "id", "least", "copies")
        .join(links, "id", "left")
        .join(reached.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "component").select(
        "h1", "h2", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n")
    )
    keys = [F.when(F.col("usable"), F.col(h)).alias(h) for h in ("h1", "h2")]
    out = rows.select("vec_id", *keys).join(known, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
