"""What changed between two states of a table, row by row, and how to make the one into the other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhaul.contracts import named
from roundhaul.operators.validate import keyed_diff, same_columns

CHANGE = "change_type"
# Which kinds of change carry rows as they were, and rows as they are.
PRE_IMAGES = ("delete", "update_before")
POST_IMAGES = ("insert", "update_after")


def change_feed(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row that went, came or changed, with ``change_type``.

    ``insert`` and ``delete`` have the rows of keys that one side alone holds, ``update_before`` and
    ``update_after`` those of keys whose rows differ; a key that is not unique changes as a whole. NULL is
    a key like any other. Keys are compared by the hashes of their rows, in one shuffle of keys and hashes;
    then the rows of changed keys alone are joined back.
    """
    same_columns(before, after)
    if CHANGE in before.columns:
        raise ValueError(f"the table has a column named {CHANGE}")
    changed = keyed_diff(before, after, key)
    renamed = [named(name).alias(f"_key{i}") for i, name in enumerate(key)]
    changed = changed.select(*renamed, F.col("change").alias("_change"))
    sides = before.withColumn("_before", F.lit(True)).unionByName(after.withColumn("_before", F.lit(False)))
    same_key = reduce(lambda a, b: a & b, [named(name).eqNullSafe(F.col(f"_key{i}")) for i, name in enumerate(key)])
    updated = F.when(F.col("_before"), "update_before").otherwise("update_after")
    kind = F.when(F.col("_change") == "added", "insert").when(F.col("_change") == "removed", "delete").otherwise(updated)
    return sides.join(changed, same_key).select(kind.alias(CHANGE), *[named(name) for name in before.columns])


def _counted(rows: DataFrame, times: Column) -> DataFrame:
    return rows.withColumn("_times", times)


def applied(base: DataFrame, feed: DataFrame) -> DataFrame:
    """The rows after a feed: pre-images are taken out, post-images put in, each as often as the feed has it.

    A pre-image that the base lacks stops the job, as the feed then belongs to another state. Rows are
    stacked and summed up, not joined, so rows that repeat without end are collapsed before the shuffle.
    """
    names = [named(name) for name in base.columns]
    sign = F.when(F.col(CHANGE).isin(*PRE_IMAGES), -1).when(F.col(CHANGE).isin(*POST_IMAGES), 1)
    unknown = F.raise_error(F.concat(F.lit("not a kind of change: "), F.coalesce(F.col(CHANGE), F.lit("NULL")))).cast("int")
    stacked = _counted(base, F.lit(1)).unionByName(_counted(feed.select(*names, CHANGE), F.coalesce(sign, unknown)).drop(CHANGE))
    summed = stacked.groupBy(*names).agg(F.sum("_times").alias("_times"))
    missing = F.raise_error(F.lit("a row to be changed is not in the table")).cast("boolean")
    held = summed.where(F.when(F.col("_times") < 0, missing).otherwise(F.col("_times") > 0))
    again = held.where("_times > 1").select(*names, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))).alias("_copy"))
    return held.where("_times = 1").select(*names).unionByName(again.select(*names))
