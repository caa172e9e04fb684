"""Counts, load statistics, filters and profiles."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import named


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def labelled_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count of each table."""
    counts = [row_count(df).select(F.lit(name).alias("name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def total_rows(tables: Mapping[str, DataFrame], metric: str = "Total Rows") -> DataFrame:
    """The sum of all row counts under a metric name."""
    total = labelled_counts(tables).agg(F.sum("row_count").alias("value"))
    return total.select(F.lit(metric).alias("metric"), "value")


def total_rows_scalar(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same sum from one scalar subquery per table, without joining anything."""
    counts = [row_count(df).scalar() for df in tables.values()]
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(reduce(lambda a, b: a + b, counts).alias("total_rows"))


def load_statistics(df: DataFrame, entity: str, moment: str) -> DataFrame:
    """Rows, distinct entities and first and last moment, in one pass over two columns."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(named(entity)).alias("unique_entities"),
        F.min(named(moment)).alias("min_date"),
        F.max(named(moment)).alias("max_date"),
    )


def equal_to(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    return df.where(reduce(lambda a, b: a & b, [named(name) == value for name, value in values.items()]))


def one_of(df: DataFrame, column: str, values: list[object]) -> DataFrame:
    return df.where(named(column).isin(values))


def latest(df: DataFrame, *newest_first: str, n: int = 10) -> DataFrame:
    """The ``n`` newest rows; each task keeps only its own best ``n`` before they are merged."""
    return df.orderBy(*[named(name).desc() for name in newest_first]).limit(n)


def profile_columns(df: DataFrame, required: Collection[str] = (), exact: bool = True) -> DataFrame:
    """One row per column: position, type, null count, distinct count, smallest and largest.

    ``nullable`` is 0 for the ``required`` columns, as declared; Parquet itself does not say.

    Exact: each column is grouped by value on its own, so map-side aggregation collapses
    frequent values, and all figures follow from the value counts. A single aggregate with
    several distinct counts would copy every row once per column instead. Approximate: one
    pass without a shuffle of the data.
    """
    fields = list(enumerate(df.schema.fields, start=1))
    if not exact:
        return _profile_in_one_pass(df, fields, required)
    parts = []
    for position, field in fields:
        values = df.groupBy(named(field.name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        orderable = F.col("v") if _orderable(field.dataType) else F.lit(None).cast("string")
        parts.append(
            values.agg(
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
                F.count("v").alias("distinct_count"),
                F.min(orderable).cast("string").alias("min_value"),
                F.max(orderable).cast("string").alias("max_value"),
            ).select(*_label(position, field, required), "null_count", "distinct_count", "min_value", "max_value")
        )
    return reduce(DataFrame.unionAll, parts)


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, T.BinaryType)


def _label(position: int, field: T.StructField, required: Collection[str]) -> list[Column]:
    return [
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("column_type"),
        F.lit(position).alias("position"),
        F.lit(0 if field.name in required else 1).alias("nullable"),
    ]


def _profile_in_one_pass(
    df: DataFrame, fields: list[tuple[int, T.StructField]], required: Collection[str]
) -> DataFrame:
    figures = []
    for position, field in fields:
        value = named(field.name)
        orderable = value if _orderable(field.dataType) else F.lit(None).cast("string")
        figures.append(
            F.struct(
                *_label(position, field, required),
                F.count_if(value.isNull()).alias("null_count"),
                F.approx_count_distinct(value).alias("distinct_count"),
                F.min(orderable).cast("string").alias("min_value"),
                F.max(orderable).cast("string").alias("max_value"),
            )
        )
    return df.agg(F.array(*figures).alias("profile")).select(F.inline("profile"))
