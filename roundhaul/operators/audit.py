"""Constraint audits: what the warehouse cannot enforce is counted on the data."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, named


def audit_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs in each column that must have none; one pass over those columns."""
    nulls = [
        F.struct(F.lit(name).alias("column_name"), F.count_if(named(name).isNull()).alias("violations"))
        for name in columns
    ]
    return df.agg(F.array(*nulls).alias("nulls")).select(F.inline("nulls"))


def audit_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    A key with a NULL in it counts like any other, as the source database has it.
    """
    return df.groupBy(*[named(k) for k in key]).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def audit_foreign_key(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Child keys without a parent, with their number of rows; a key with a NULL refers to nothing.

    Both sides are stacked and counted by key, so a frequent key is reduced before the
    shuffle. An anti join would not be: Spark moves it below the aggregation of the child.
    """
    own = [named(c) for c in columns]
    keys = [named(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)]
    refers = reduce(lambda a, b: a & b, [key.isNotNull() for key in own])
    from_child = child.where(refers).select(*own, F.lit(1).alias("_child"))
    both = from_child.unionByName(parent.select(*keys, F.lit(0).alias("_child")))
    per_key = both.groupBy(*own).agg(F.sum("_child").alias("orphans"), F.min("_child").alias("_child"))
    return per_key.where("_child = 1").drop("_child")


def audit_inclusions(columns: Mapping[Hashable, DataFrame], pairs: Sequence[tuple[Hashable, Hashable]]) -> DataFrame:
    """One row: ``orphans``, for each (child, parent) how many values of the child's column the parent's lacks.

    ``columns`` are tables of one column, all of one type; NULL refers to nothing. All columns are stacked and
    reduced by value to the set of those that hold it, so each is read and shuffled once, in however many pairs it is.
    """
    places = {column: divmod(i, 63) for i, column in enumerate(columns)}  # the sign bit is left out
    words = [f"_set{w}" for w in range(-(-len(places) // 63))]
    sides = []
    for column, df in columns.items():
        at, bit = places[column]
        value = named(df.columns[0])
        bits = [F.lit(1 << bit if w == at else 0).cast("bigint").alias(word) for w, word in enumerate(words)]
        sides.append(df.where(value.isNotNull()).select(value.alias("_value"), *bits))
    holders = reduce(DataFrame.unionAll, sides).groupBy("_value").agg(*[F.bit_or(word).alias(word) for word in words])
    per_set = holders.groupBy(*words).agg(F.count(F.lit(1)).alias("_values"))

    def holds(column: Hashable):
        at, bit = places[column]
        return F.col(words[at]).bitwiseAND(F.lit(1 << bit)) != 0

    orphans = [F.sum(F.when(holds(child) & ~holds(parent), F.col("_values")).otherwise(0)) for child, parent in pairs]
    return per_set.agg(F.array(*[F.coalesce(n, F.lit(0)) for n in orphans]).alias("orphans"))


def audit_contracts(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """Every declared rule of every table, with the number of rows that break it, 0 included.

    Of rows that share a unique key all but one break it. A foreign key whose parent is not
    among the tables cannot be audited and raises.
    """
    found = []
    for contract in contracts:
        rows = tables[contract.name]

        def rule(counts: DataFrame, kind: str, columns: Sequence[str], violations) -> DataFrame:
            return counts.select(
                F.lit(contract.name).alias("table_name"),  # noqa: B023 - used within this turn only
                F.lit(kind).alias("rule"),
                F.lit(", ".join(columns)).alias("columns"),
                F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
            )

        if contract.required:
            nulls = audit_not_null(rows, contract.required)
            found.append(
                nulls.select(
                    F.lit(contract.name).alias("table_name"),
                    F.lit("not null").alias("rule"),
                    F.col("column_name").alias("columns"),
                    "violations",
                )
            )
        for key in dict.fromkeys(k for k in (contract.key, *contract.unique) if k):
            copies = audit_unique(rows, key).agg(F.sum(F.col("copies") - 1).alias("n"))
            found.append(rule(copies, "unique", key, F.col("n")))
        for fk in contract.foreign_keys:
            orphans = audit_foreign_key(rows, fk.columns, tables[fk.parent], fk.parent_columns)
            found.append(rule(orphans.agg(F.sum("orphans").alias("n")), "foreign key", fk.columns, F.col("n")))
    if not found:
        raise ValueError("no rule is declared")
    return reduce(DataFrame.unionAll, found)
