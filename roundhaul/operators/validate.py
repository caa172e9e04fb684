"""Is the target the same as the source: counts, statistics, types, tolerances, contents.

Comparisons stack both sides and aggregate; they never join them. A key or a row that is
repeated without end is then collapsed before the shuffle, where a join would pair every
copy on one side with every copy on the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, named
from roundhaul.functions.convert import FLOATS
from roundhaul.functions.digest import PARTS, hash_part, row_hash
from roundhaul.session import local_table

PASSED, FAILED = "PASSED", "FAILED"
# Fixed value: the largest difference between two floats that still passes.
TOLERANCE = 1e-9

# Two hashes with different starts make a fingerprint of 128 bits: among 10^12 different
# rows, the chance that any two share one is about 10^-15.
_PRINTS = ("_print0", "_print1")
# One hash is enough to compare two given sets of rows.
_PARTS = tuple(f"_part{i}" for i in range(PARTS))


def _status(passed: Column) -> Column:
    return F.when(passed, PASSED).otherwise(FAILED).alias("status")


def _stack(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both sides as one table, each row marked with the side it is from."""
    from_source = source.withColumn("_in_source", F.lit(True))
    return from_source.unionByName(target.withColumn("_in_source", F.lit(False)))


def _hash(columns: Sequence[str], start: int) -> Column:
    return row_hash([named(c) for c in columns], start)


def _fingerprint(columns: Sequence[str]) -> list[Column]:
    return [_hash(columns, start).alias(name) for start, name in enumerate(_PRINTS)]


def _net_sums() -> list[Column]:
    """Per part of ``_hash``: its sum over the source minus its sum over the target."""
    sums = []
    for position, name in enumerate(_PARTS):
        part = hash_part(F.col("_hash"), position)
        signed = F.when(F.col("_in_source"), part).otherwise(-part)
        sums.append(F.coalesce(F.sum(signed), F.lit(0)).alias(name))
    return sums


def _sums_differ() -> Column:
    return reduce(lambda a, b: a | b, [F.col(name) != 0 for name in _PARTS])


def _surplus() -> Column:
    """How many more rows the source has than the target."""
    return F.sum(F.when(F.col("_in_source"), 1).otherwise(-1))


def row_count_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides and whether they are equal."""
    both = _stack(source.select(), target.select()).agg(
        F.count_if("_in_source").alias("source_rows"),
        F.count_if(~F.col("_in_source")).alias("target_rows"),
    )
    return both.select("source_rows", "target_rows", _status(F.col("source_rows") == F.col("target_rows")))


def statistics_match(source: DataFrame, target: DataFrame, entity: str, moment: str) -> DataFrame:
    """Load statistics of both sides, one row per statistic, compared as text."""
    counted = (
        _stack(source.select(named(entity), named(moment)), target.select(named(entity), named(moment)))
        .groupBy("_in_source", named(entity).alias("entity"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(named(moment)).alias("first"),
            F.max(named(moment)).alias("last"),
        )
    )
    figures = {
        "total_rows": lambda side: F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)),
        "unique_entities": lambda side: F.count(F.when(side, F.col("entity"))),
        "min_date": lambda side: F.min(F.when(side, F.col("first"))),
        "max_date": lambda side: F.max(F.when(side, F.col("last"))),
    }
    source_side, target_side = F.col("_in_source"), ~F.col("_in_source")
    compared = [
        F.struct(
            F.lit(name).alias("statistic"),
            figure(source_side).cast("string").alias("source_value"),
            figure(target_side).cast("string").alias("target_value"),
        )
        for name, figure in figures.items()
    ]
    rows = counted.agg(F.array(*compared).alias("rows")).select(F.inline("rows"))
    return rows.select(
        "statistic",
        "source_value",
        "target_value",
        _status(F.col("source_value").eqNullSafe(F.col("target_value"))),
    )


def column_match(source: Contract, target: Contract) -> list[dict[str, object]]:
    """Per column: missing on one side, or both types and whether they are the same."""
    wanted = {c.name: c.type for c in source.columns}
    present = {c.name: c.type for c in target.columns}
    result: list[dict[str, object]] = []
    for name, kind in wanted.items():
        if name not in present:
            result.append({"column": name, "status": "missing_in_target"})
            continue
        types = {"source_type": kind.simpleString(), "target_type": present[name].simpleString()}
        result.append({"column": name, "type_match": kind == present[name], **types})
    result += [{"column": name, "status": "extra_in_target"} for name in present if name not in wanted]
    return result


def same_columns(source: DataFrame, target: DataFrame) -> None:
    """Refuse to compare contents of tables that differ in columns or types."""
    checks = column_match(Contract.of("source", source), Contract.of("target", target))
    wrong = [check for check in checks if not check.get("type_match")]
    if wrong:
        raise ValueError(f"source and target differ in columns: {wrong}")


def float_tolerance(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Largest difference of each column that is a float on both sides, over rows paired by key.

    NULLs are left out, and a key with a NULL in it pairs with nothing.

    Over all pairs of a key, the largest difference follows from the smallest and largest
    value of each side, so no pair is ever built. Equal values, NaN and infinities
    included, differ by 0; NaN against a number gives NaN and fails.
    """
    floating = [{f.name for f in side.schema.fields if isinstance(f.dataType, FLOATS)} for side in (source, target)]
    if columns is None:
        columns = [name for name in source.columns if name in floating[0] & floating[1] and name not in key]
    elif not set(columns) <= floating[0] & floating[1]:
        raise ValueError(f"not floats on both sides: {sorted(set(columns) - (floating[0] & floating[1]))}")
    if not columns:
        return local_table(source.sparkSession, [], "column_name string, max_diff double, within_tolerance boolean")
    kept = [named(name) for name in (*key, *columns)]
    ends = []
    for i, name in enumerate(columns):
        for side, here in (("s", F.col("_in_source")), ("t", ~F.col("_in_source"))):
            value = F.when(here, named(name).cast("double"))
            ends += [F.min(value).alias(f"{side}{i}_min"), F.max(value).alias(f"{side}{i}_max")]
    whole = reduce(lambda a, b: a & b, [named(name).isNotNull() for name in key], F.lit(True))
    per_key = _stack(source.select(*kept), target.select(*kept)).where(whole).groupBy(*kept[: len(key)]).agg(*ends)
    gaps = []
    for i, name in enumerate(columns):
        low_s, high_s, low_t, high_t = (F.col(f"{side}{i}_{end}") for side in "st" for end in ("min", "max"))
        equal = (low_s == high_t) & (high_s == low_t)
        widest = F.greatest(F.abs(high_s - low_t), F.abs(high_t - low_s))
        paired = low_s.isNotNull() & low_t.isNotNull()
        gap = F.coalesce(F.max(F.when(paired, F.when(equal, F.lit(0.0)).otherwise(widest))), F.lit(0.0))
        gaps.append(F.struct(F.lit(name).alias("column_name"), gap.alias("max_diff")))
    found = per_key.agg(F.array(*gaps).alias("gaps")).select(F.inline("gaps"))
    return found.select("column_name", "max_diff", (F.col("max_diff") <= tolerance).alias("within_tolerance"))


def content_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whether both sides hold the same rows equally often, by count and hash sums.

    The sums do not depend on row order but do count repeated rows. One pass over each
    side, no shuffle of the data.
    """
    same_columns(source, target)
    hashed = _stack(source, target).select("_in_source", _hash(source.columns, 0).alias("_hash"))
    found = hashed.agg(
        F.count_if("_in_source").alias("source_rows"),
        F.count_if(~F.col("_in_source")).alias("target_rows"),
        *_net_sums(),
    )
    equal = (F.col("source_rows") == F.col("target_rows")) & ~_sums_differ()
    return found.select("source_rows", "target_rows", _status(equal))


def content_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """How many rows only the source or only the target has, repeated rows counted.

    Shuffles a fingerprint instead of each row, and identical rows collapse beforehand.
    """
    same_columns(source, target)
    surplus = (
        _stack(source, target)
        .select("_in_source", *_fingerprint(source.columns))
        .groupBy(*_PRINTS)
        .agg(_surplus().alias("surplus"))
    )
    more, less = F.greatest("surplus", F.lit(0)), F.greatest(-F.col("surplus"), F.lit(0))
    found = surplus.agg(
        F.coalesce(F.sum(more), F.lit(0)).alias("only_in_source"),
        F.coalesce(F.sum(less), F.lit(0)).alias("only_in_target"),
    )
    equal = (F.col("only_in_source") == 0) & (F.col("only_in_target") == 0)
    return found.select("only_in_source", "only_in_target", _status(equal))


def validation_checks(
    table: str, source: DataFrame, target: DataFrame, entity: str | None = None, moment: str | None = None
) -> DataFrame:
    """Every check of a table with what was expected, what was found, and its status.

    Rows, rows lost and made up, and the load statistics where their columns are named. Columns
    must agree before contents can be compared.
    """
    counts = row_count_match(source, target).select(
        F.lit("row_count").alias("check"),
        F.col("source_rows").cast("string").alias("expected"),
        F.col("target_rows").cast("string").alias("actual"),
        "status",
    )
    sides = [
        F.struct(F.lit(name).alias("check"), F.lit("0").alias("expected"), F.col(column).cast("string").alias("actual"),
                 _status(F.col(column) == 0))
        for name, column in (("rows_lost", "only_in_source"), ("rows_made_up", "only_in_target"))
    ]
    found = counts.unionByName(content_diff(source, target).select(F.inline(F.array(*sides))))
    if entity is not None and moment is not None:
        statistics = statistics_match(source, target, entity, moment)
        found = found.unionByName(
            statistics.select(
                F.col("statistic").alias("check"),
                F.col("source_value").alias("expected"),
                F.col("target_value").alias("actual"),
                "status",
            )
        )
    return found.select(F.lit(table).alias("table_name"), "*")


def differing_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """The rows themselves, with the side that has more of them and by how many.

    Compares every value rather than a fingerprint.
    """
    same_columns(source, target)
    names = [named(name) for name in source.columns]
    surplus = _stack(source, target).groupBy(*names).agg(_surplus().alias("_surplus")).where("_surplus <> 0")
    return surplus.select(
        *names,
        F.when(F.col("_surplus") > 0, "source").otherwise("target").alias("only_in"),
        F.abs("_surplus").alias("copies"),
    )


def keyed_diff(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows were added, removed or changed.

    A key counts as changed unless both sides hold the same rows under it equally often, so
    a key that is not unique is compared as a whole.
    """
    same_columns(source, target)
    values = [name for name in source.columns if name not in key]
    keys = [named(name) for name in key]
    hashed = _stack(source, target).select(*keys, "_in_source", _hash(values, 0).alias("_hash"))
    per_key = hashed.groupBy(*keys).agg(
        F.count_if("_in_source").alias("_source"),
        F.count_if(~F.col("_in_source")).alias("_target"),
        *_net_sums(),
    )
    differs = (F.col("_source") != F.col("_target")) | _sums_differ()
    change = F.when(F.col("_source") == 0, "added").when(F.col("_target") == 0, "removed").otherwise("changed")
    return per_key.where(differs).select(*keys, change.alias("change"))
