"""A locality key: rows that are near each other in several columns at once get near keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import named
from roundhaul.functions.profiles import measure

#: Each column is cut into 2^BITS parts of about as many rows.
BITS = 6
#: Letters of a text that count.
TEXT_BYTES = 6


def scale(value: Column, kind: T.DataType) -> Column:
    """A value's place on a scale that keeps its order: numbers and times as they are, text by its first bytes."""
    place = measure(value, kind)
    if place is not None:
        return place
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.rpad(F.substring(F.hex(value), 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0")
        return F.conv(digits, 16, 10).cast("double")
    raise ValueError(f"values of the type {kind.simpleString()} have no order")


def borders(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """The borders between parts of like size of each column, found in one pass over these columns."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    figures = [F.percentile_approx(scale(named(name), kinds[name]), shares, 10_000).alias(f"b{i}") for i, name in enumerate(columns)]
    row = df.agg(*figures).first()  # one row, as many numbers as there are parts
    return [sorted(set(row[f"b{i}"] or [])) for i in range(len(columns))]


def _part(place: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """How many of the borders a value has reached, by halving; NULL comes first of all."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below, above = _part(place, cuts[:middle], first), _part(place, cuts[middle + 1 :], first + middle + 1)
    return F.when(place >= cuts[middle], above).otherwise(below)


def locality_key(df: DataFrame, columns: Sequence[str], cuts: Sequence[Sequence[float]], bits: int = BITS) -> Column:
    """The bits of each column's part taken in turn, the highest first: a Z-order curve over the parts."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a key")
    key = F.lit(0).cast("bigint")
    for i, (name, held) in enumerate(zip(columns, cuts, strict=True)):
        part = _part(scale(named(name), kinds[name]), held).cast("bigint")
        for bit in range(bits):
            taken = F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key + F.shiftleft(taken, bit * len(columns) + len(columns) - 1 - i)
    return key
