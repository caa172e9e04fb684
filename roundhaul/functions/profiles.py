"""Column profiles that can be merged: counts, bounds, and sketches of distinct values and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import Column as ContractColumn

# Distinct counts are off by 1.6 % (one standard deviation), ranks of quantiles by less than 1 %.
DISTINCT_BITS, QUANTILE_SIZE = 12, 400
#: Bounds of text are cut to so many characters; the first of a cut bound is the cut of the first.
TEXT_BOUND = 256
QUARTILES = (0.25, 0.5, 0.75)


def _bound(value: Column, kind: T.DataType) -> Column | None:
    """What bounds are kept of; None where values have no order."""
    if isinstance(kind, T.BinaryType):
        return None
    return F.substring(value, 1, TEXT_BOUND) if isinstance(kind, T.StringType) else value


def measure(value: Column, kind: T.DataType) -> Column | None:
    """A value's place on a scale, for quantiles: numbers, days since 1970, microseconds; None for other types."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value.cast("double"))
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return None


def schema(columns: Sequence[ContractColumn]) -> str:
    fields = ["directory string", "rows bigint"]
    for i, column in enumerate(columns):
        kind = column.type.simpleString()
        fields += [f"present{i} bigint", f"distinct{i} binary"]
        if _bound(F.lit(None), column.type) is not None:
            fields += [f"least{i} {kind}", f"most{i} {kind}"]
        if measure(F.lit(None), column.type) is not None:
            fields.append(f"quantiles{i} binary")
    return ", ".join(fields)


def sketches(values: Sequence[Column], columns: Sequence[ContractColumn]) -> list[Column]:
    """The aggregates of rows that make up a profile."""
    found = [F.count(F.lit(1)).alias("rows")]
    for i, (value, column) in enumerate(zip(values, columns, strict=True)):
        hashed = F.when(value.isNotNull(), F.xxhash64(value))
        found += [F.count(value).alias(f"present{i}"), F.hll_sketch_agg(hashed, F.lit(DISTINCT_BITS)).alias(f"distinct{i}")]
        bound, place = _bound(value, column.type), measure(value, column.type)
        if bound is not None:
            found += [F.min(bound).alias(f"least{i}"), F.max(bound).alias(f"most{i}")]
        if place is not None:
            found.append(F.kll_sketch_agg_double(place, F.lit(QUANTILE_SIZE)).alias(f"quantiles{i}"))
    return found


def merges(columns: Sequence[ContractColumn]) -> list[Column]:
    """The aggregates that make one profile of several."""
    found = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for i, column in enumerate(columns):
        found += [F.coalesce(F.sum(f"present{i}"), F.lit(0)).alias(f"present{i}"), F.hll_union_agg(f"distinct{i}").alias(f"distinct{i}")]
        if _bound(F.lit(None), column.type) is not None:
            found += [F.min(f"least{i}").alias(f"least{i}"), F.max(f"most{i}").alias(f"most{i}")]
        if measure(F.lit(None), column.type) is not None:
            found.append(F.kll_merge_agg_double(f"quantiles{i}", F.lit(QUANTILE_SIZE)).alias(f"quantiles{i}"))
    return found


def told(merged: DataFrame, columns: Sequence[ContractColumn]) -> DataFrame:
    """One row per column: position, type, rows, NULLs, bounds as text, and estimates of distinct values and quartiles."""
    figures = []
    for i, column in enumerate(columns):
        bounded = _bound(F.lit(None), column.type) is not None
        quartiles = F.lit(None).cast("array<double>")
        if measure(F.lit(None), column.type) is not None:
            held = F.kll_sketch_get_n_double(f"quantiles{i}") > 0
            at = F.array(*[F.lit(q) for q in QUARTILES])
            quartiles = F.when(held, F.kll_sketch_get_quantile_double(f"quantiles{i}", at))
        figures.append(
            F.struct(
                F.lit(column.name).alias("column_name"),
                F.lit(column.type.simpleString()).alias("column_type"),
                F.lit(i + 1).alias("position"),
                F.lit(1 if column.nullable else 0).alias("nullable"),
                F.col("rows").alias("row_count"),
                (F.col("rows") - F.col(f"present{i}")).alias("null_count"),
                F.when(F.col(f"present{i}") > 0, F.hll_sketch_estimate(f"distinct{i}")).otherwise(0).cast("bigint").alias("distinct_estimate"),
                (F.col(f"least{i}") if bounded else F.lit(None)).cast("string").alias("min_value"),
                (F.col(f"most{i}") if bounded else F.lit(None)).cast("string").alias("max_value"),
                quartiles.alias("quartiles"),
            )
        )
    return merged.select(F.inline(F.array(*figures)))
