"""Schema drift, safe widening, and appending rows that follow a newer contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from roundhaul.contracts import Column, Contract, named
from roundhaul.functions.convert import strict_cast


class UnsafeChange(ValueError):
    """A column's type changed in a way that could lose values."""


@dataclass(frozen=True)
class Drift:
    added: tuple[Column, ...]
    removed: tuple[Column, ...]
    changed: tuple[tuple[str, T.DataType, T.DataType], ...]


def schema_drift(old: Contract, new: Contract) -> Drift:
    """Columns by exact name; order and nullability do not count."""
    before = {c.name: c for c in old.columns}
    after = {c.name: c for c in new.columns}
    return Drift(
        tuple(c for c in new.columns if c.name not in before),
        tuple(c for c in old.columns if c.name not in after),
        tuple((n, c.type, after[n].type) for n, c in before.items() if n in after and after[n].type != c.type),
    )


def widens_safely(old: T.DataType, new: T.DataType) -> bool:
    """int to bigint, float to double, and decimals that keep their scale and lose no digits."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale == old.scale and new.precision >= old.precision
    # The other widenings that are allowed.
    return (type(old), type(new)) in {(T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)}


def evolve_append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Old rows and new rows under one schema.

    Widened columns take the new type; columns only one side has are NULL for the other.
    An unsafe type change rejects the load before any row is read.
    """
    old, new = Contract.of("existing", existing), Contract.of("incoming", incoming)
    drift = schema_drift(old, new)
    unsafe = [
        f"{name}: {before.simpleString()} to {after.simpleString()}"
        for name, before, after in drift.changed
        if not widens_safely(before, after)
    ]
    if unsafe:
        raise UnsafeChange("; ".join(unsafe))
    wider = {name: after for name, _, after in drift.changed}
    widened = existing.select(
        *[
            strict_cast(named(c.name), wider[c.name], c.name).alias(c.name) if c.name in wider else named(c.name)
            for c in old.columns
        ]
    )
    return widened.unionByName(incoming, allowMissingColumns=True)
