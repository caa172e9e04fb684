"""Order-free digests: how many rows there are, and sums over their hashes.

Digests of parts add up to the digest of the whole, whichever way it is cut, and one taken away from
another is that of the rest. They count repeated rows. Two different sets of rows share one with a
chance of about 10^-19.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A hash is added up in parts of 16 bits, so short that 10^14 rows cannot overflow a sum.
PART_BITS = 16
PARTS = 64 // PART_BITS


def row_hash(values: Sequence[Column], start: int = 0) -> Column:
    """64 bits that depend on every value of a row.

    Spark's hash skips NULL, so which values are NULL is hashed too; otherwise a value
    that moves from one column into an empty neighbour would go unnoticed.
    """
    return F.xxhash64(F.lit(start), *[value.isNull() for value in values], *values)


def hash_part(hashed: Column, position: int) -> Column:
    return F.shiftrightunsigned(hashed, position * PART_BITS).bitwiseAND(F.lit(2**PART_BITS - 1))


@dataclass(frozen=True)
class Digest:
    rows: int
    sums: tuple[int, ...]

    def __add__(self, other: Digest) -> Digest:
        return Digest(self.rows + other.rows, tuple(a + b for a, b in zip(self.sums, other.sums, strict=True)))

    def __sub__(self, other: Digest) -> Digest:
        return Digest(self.rows - other.rows, tuple(a - b for a, b in zip(self.sums, other.sums, strict=True)))


NOTHING = Digest(0, (0,) * PARTS)


def sums(values: Sequence[Column], prefix: str = "") -> list[Column]:
    """The aggregates that make up a digest of rows with these values."""
    hashed = row_hash(values)
    added = [F.coalesce(F.sum(hash_part(hashed, i)), F.lit(0)).alias(f"{prefix}sum{i}") for i in range(PARTS)]
    return [F.count(F.lit(1)).alias(f"{prefix}rows"), *added]


def read_off(found: Row | dict, prefix: str = "") -> Digest:
    return Digest(found[f"{prefix}rows"], tuple(found[f"{prefix}sum{i}"] for i in range(PARTS)))


def exported(values: Sequence[Column], kinds: Sequence[T.DataType]) -> list[Column]:
    """The values as they leave for a relational target: NaN is NULL there."""
    floating = (T.FloatType, T.DoubleType)
    pairs = zip(values, kinds, strict=True)
    return [F.when(~F.isnan(value), value) if isinstance(kind, floating) else value for value, kind in pairs]
