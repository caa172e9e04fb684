"""Whitening of vectors, with covariances by polarisation.

A component c becomes the whole number x = floor(scale * c) + shift. With n vectors and the sums S of
their x, y = n * x - S are centred values as whole numbers. Summed exactly are y_i^2 for every
dimension and (y_i + y_j)^2 for every pair of dimensions, which are n^3 times the variances of x_i and
of x_i + x_j. Half of what the variance of a sum has beyond those of its parts is the
covariance; so squares alone give the whole matrix, without error, to be rounded once. Its
eigenvectors are found on the driver, as it has a row for each dimension whatever the rows are.

Vectors that are NULL, empty, or hold NULL or non-finite entries are left out. All others must have one
length; another one stops the job. Rows that repeat, or share an id, or have none, are rows of their
own. A component without variance (below rounding) cannot be scaled and is left out, so fewer
vectors than dimensions, or vectors that are all equal, give fewer components or none. An empty
table gives no rows. Other columns are left out. Numbers whose products n * x leave a long stop the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.llm.common import Scratch, reachable

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Vectors that a task works on at once: so many bytes of 64-bit numbers.
SLICE_BYTES = 4 * 1024**2
#: Sums leave a task in two parts, the lower one with so many bits, so that no sum of them overflows.
PART_BITS = 60
_LONG = 2**63


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each slice of a batch starts, and its vectors as a matrix."""
    lists = batch.column(column)
    width = len(lists[0].as_py()) if len(lists) else 1
    step = max(1, SLICE_BYTES // (8 * width))
    for start in range(0, len(lists), step):
        part = lists.slice(start, step)
        yield start, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), width)


def square_sums(values: np.ndarray) -> list[int]:
    """Exact sums of the squares of each column, for whole numbers of any size in a long."""
    most = int(np.abs(values).max(initial=0))
    if most * most * max(len(values), 1) < _LONG:
        return [int(s) for s in np.einsum("ij,ij->j", values, values)]
    if most < 2**62 and len(values) <= 2**18:
        # Three digits of 21 bits; products of two, summed over the rows, fit a long.
        signs = np.sign(values)
        left, digits = np.abs(values), []
        for _ in range(3):
            digits.append(left & (2**21 - 1))
            left = left >> 21
        digits = [d * signs for d in digits]
        total = np.zeros(values.shape[1], object)
        for i, one in enumerate(digits):
            for j, two in enumerate(digits):
                total += np.einsum("ij,ij->j", one, two).astype(object) << (21 * (i + j))
        return [int(s) for s in total]
    return [int(s) for s in (values.astype(object) ** 2).sum(axis=0)]


def polarised_sums(centred: np.ndarray) -> list[int]:
    """Sums of squares of every column, then of the sum of every pair of columns, in order of the first."""
    found = square_sums(centred)
    for i in range(centred.shape[1] - 1):
        found += square_sums(centred[:, i : i + 1] + centred[:, i + 1 :])
    return found


def cross_sums(squares: list[int], width: int) -> list[list[int]]:
    """The sums of y_i * y_j from those that `polarised_sums` gives."""
    cross = [[0] * width for _ in range(width)]
    at = width
    for i in range(width):
        cross[i][i] = squares[i]
        for j in range(i + 1, width):
            cross[i][j] = cross[j][i] = (squares[at] - squares[i] - squares[j]) // 2
            at += 1
    return cross


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the fit's size and sums, components as columns, their eigenvalues, and all variance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        if 4 * most >= _LONG:
            raise OverflowError(f"{self.n} vectors with entries up to {int(np.abs(x).max())} leave the range of a long")
        return x * np.int64(self.n) - np.array(self.sums, np.int64)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """The whitened values of each vector, one column a component."""
        return (self.centred(x) / self.n) @ self.axes / np.sqrt(self.values)


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x of every vector that takes part."""
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = given.where(F.coalesce((F.size("embedding") > 0) & finite, F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c).cast("long") + F.lit(shift))
    return given.select("vec_id", x.alias("x"))


def _counted(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            for width in np.unique(lengths):
                held = flat[np.repeat(lengths == width, lengths)].reshape(-1, width)
                exact = int(np.abs(held).max()) * len(held) < _LONG
                sums = held.sum(axis=0) if exact else held.astype(object).sum(axis=0)
                found = [Decimal(int(s)) for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([width] * width, pa.int32()),
                        pa.array(range(width), pa.int32()),
                        pa.array([len(held)] * width, pa.int64()),
                        pa.array(found, pa.decimal128(38, 0)),
                    ],
                    ["width", "i", "n", "s"],
                )

    parts = rows.select("x").mapInArrow(summed, "width int, i int, n long, s decimal(38,0)")
    # One row for each dimension.
    found = parts.groupBy("width", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("width", "i").collect()
    widths = {row["width"] for row in found}
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths cannot be whitened together: {sorted(widths)[:10]}")
    return (found[0]["n"] if found else 0), [int(row["s"]) for row in found]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of the vectors of `whole_vectors`, by falling eigenvalue."""
    reachable(rows.sparkSession)
    n, sums = _counted(rows)
    width = len(sums)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    centring = Whitening(n, tuple(sums), np.zeros((width, 0)), np.zeros(0), 0.0)

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _slices(batch, 0):
                found = polarised_sums(centring.centred(x))
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            parts = [[Decimal(t >> PART_BITS) for t in total], [Decimal(t & (2**PART_BITS - 1)) for t in total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), *[pa.array(p, pa.decimal128(38, 0)) for p in parts]],
                ["k", "high", "low"],
            )

    parts = rows.select("x").mapInArrow(squared, "k int, high decimal(38,0), low decimal(38,0)")
    # One row for each dimension and each pair of them.
    found = parts.groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("k").collect()
    cross = cross_sums([(int(row["high"]) << PART_BITS) + int(row["low"]) for row in found], width)
    covariance = np.array([[c / n**3 for c in row] for row in cross])  # whole numbers divided: rounded once
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    least = max(float(values[0]), 0.0) * width * np.finfo(float).eps
    count = min(components, int((values > least).sum()))
    trace = sum(cross[i][i] for i in range(width)) / n**3
    return Whitening(n, tuple(sums), np.ascontiguousarray(axes[:, :count]), values[:count].copy(), trace)


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on all of them."""
    count = len(model.values)
    if not count:
        return None

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            for _, x in _slices(batch, 0):
                z = model.apply(x)
                total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["k", "s"]
        )

    parts = rows.select("x").mapInArrow(multiplied, "k int, s double")
    found = parts.groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()  # one row for each pair of components
    sums = np.array([row["s"] for row in found]).reshape(count + 1, count) / model.n
    return float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(count)).max())


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (sum of (n * x - S)^2, exact) and the whitened vector of every row."""
    reachable(rows.sparkSession)
    count = len(model.values)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in _slices(batch, 1):
                centred = model.centred(x)
                deviation = [Decimal(s) for s in square_sums(np.ascontiguousarray(centred.T))]
                z = model.apply(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * count, pa.int32()), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(x)), pa.array(deviation, pa.decimal128(38, 0)), lists],
                    ["vec_id", "deviation", "whitened"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(applied, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, a row a vector and component."""
    rows = scratch.write(whole_vectors(vectors), "vectors")
    model = fit(rows, components)
    error = identity_error(rows, model)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    each = whitened(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained") if len(model.values) else F.lit(None).cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
