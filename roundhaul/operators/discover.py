"""Keys and references that rows obey, where no constraint says so.

Sketches, one pass over each table, rule out what cannot hold; what they leave is confirmed exactly. So every
answer is right, and a candidate is missed only if its sketch is off by six standard deviations. Several columns
are first looked for repeats among the rows of some values: a repeat there is one of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import named
from roundhaul.operators.audit import audit_inclusions, audit_unique

# A sketch of 2^14 cells is off by 0.8 %; six times that, rounded up.
SKETCH_BITS, SLACK = 14, 0.05
#: Repeats are first looked for among one value of a column in so many, of a table with SLICE_ROWS rows for each.
SLICES, SLICE_ROWS = 64, 1 << 16
#: Columns whose values are sliced in one pass, and candidates that one aggregation of a slice tests.
PASS_COLUMNS, PASS_CANDIDATES = 8, 20
#: Rows whose hashes one task compares, and repeated hashes that it tells.
TASK_ROWS, TOLD = 1 << 20, 10


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of the type; columns of others are no keys."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _figures(df: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of rows, and about how many distinct values each column without NULLs has: one pass."""
    names = [f.name for f in df.schema.fields if _hashable(f.dataType)]
    # Each hash is used twice, so Spark projects it in compiled code rather than within the sketch.
    hashes = df.select(*[F.when(named(name).isNotNull(), F.xxhash64(named(name))).alias(f"h{i}") for i, name in enumerate(names)])
    figures = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(names)):
        sketch = F.hll_sketch_agg(f"h{i}", F.lit(SKETCH_BITS))
        figures += [F.count(f"h{i}").alias(f"held{i}"), F.hll_sketch_estimate(sketch).alias(f"n{i}")]
    row = hashes.agg(*figures).first()
    return row["rows"], {name: row[f"n{i}"] for i, name in enumerate(names) if row["rows"] and row[f"held{i}"] == row["rows"]}


def _without_near_repeats(df: DataFrame, sets: Sequence[tuple[str, ...]], single: Mapping[str, int], rows: int) -> list[tuple[str, ...]]:
    """The sets that do not repeat among the rows of some values of their column with the most values.

    Rows that agree in a set agree in that column, so a slice by its values holds all or none of them.
    """
    share = max(1, min(SLICES, rows // SLICE_ROWS))
    sliced: dict[str, list[tuple[str, ...]]] = {}
    for s in sets:
        sliced.setdefault(max(s, key=single.__getitem__), []).append(s)
    columns, repeated = list(sliced), set()
    for start in range(0, len(columns), PASS_COLUMNS):
        part = {c: F.pmod(F.xxhash64(named(c)), F.lit(share)) == 0 for c in columns[start : start + PASS_COLUMNS]}
        used = {name: f"c{i}" for i, name in enumerate(dict.fromkeys(name for c in part for s in sliced[c] for name in s))}
        cut = df.where(reduce(lambda a, b: a | b, part.values()))
        held = cut.select(*[named(name).alias(c) for name, c in used.items()], *[chosen.alias(f"in_{used[c]}") for c, chosen in part.items()]).persist()
        tests, verdicts = [], []
        for c in part:
            for first in range(0, len(sliced[c]), PASS_CANDIDATES):
                tested = sliced[c][first : first + PASS_CANDIDATES]
                others = [[used[name] for name in s if name != c] for s in tested]
                distinct = [F.count_distinct(*o) for o in others]
                per_value = held.where(f"in_{used[c]}").groupBy(used[c]).agg(
                    F.count(F.lit(1)).alias("rows"), *[n.alias(f"n{i}") for i, n in enumerate(distinct)]
                )
                more = [F.bool_or(F.col("rows") > F.col(f"n{i}")) for i in range(len(tested))]
                verdicts.append(per_value.agg(F.array(*more).alias("more")).select(F.lit(len(tests)).alias("test"), "more"))
                tests.append(tested)
        try:
            for row in reduce(DataFrame.unionAll, verdicts).collect():  # one row a test; Spark runs them side by side
                repeated |= {s for s, more in zip(tests[row["test"]], row["more"], strict=True) if more}
        finally:
            held.unpersist()
    return [s for s in sets if s not in repeated]


def _told_twice(task_rows: int, told: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function: some of the hashes that occur more than once; each is held once, however often it occurs.

    Made here, so that it travels whole: workers need not find this package.
    """

    def twice_in(batches):
        seen = twice = np.empty(0, np.int64)
        held, size = [], 0

        def merged():
            both = np.sort(np.concatenate([seen, *held]))
            again = np.append(False, both[1:] == both[:-1])[: len(both)]
            return both[~again], np.unique(np.concatenate([twice, both[again]]))[:told]

        for batch in batches:
            held.append(batch.column(0).to_numpy())
            size += batch.num_rows
            if size > max(task_rows, len(seen)):
                seen, twice = merged()
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(merged()[1])], ["hash"])

    return twice_in


def _repeats(df: DataFrame, key: tuple[str, ...], rows: int) -> bool:
    """Whether any values of the key occur twice, among all rows.

    Rows that agree have one hash, so without a repeated hash there are none. The rows of repeated hashes are
    compared by their values; if those differ, the hashes met by chance, and all rows are counted. So they are where
    text is collated: equal texts may have several hashes.
    """
    if any(" collate " in df.schema[name].dataType.simpleString() for name in key):
        return not audit_unique(df, key).isEmpty()
    hashed = F.xxhash64(*[named(name) for name in key])
    dealt = df.select(hashed.alias("hash")).repartition(max(16, rows // TASK_ROWS), "hash")
    told = [row["hash"] for row in dealt.mapInArrow(_told_twice(TASK_ROWS, TOLD), "hash long").collect()]  # so many a task at most
    if not told:
        return False
    return not audit_unique(df.where(hashed.isin(told[:100])), key).isEmpty() or not audit_unique(df, key).isEmpty()


def candidate_keys(df: DataFrame, most_columns: int = 2) -> list[tuple[str, ...]]:
    """The minimal sets of up to so many columns that are never NULL and never repeat, smaller sets first.

    Level by level: a set that holds a key is not looked at; one whose columns have fewer combinations than there
    are rows is ruled out, and so are columns that together repeat among the rows of some values; the others are
    compared over all rows. A table without rows has no keys.
    """
    rows, single = _figures(df)
    found: list[tuple[str, ...]] = []
    for size in range(1, most_columns + 1):
        possible = []
        for s in combinations(single, size):
            if any(set(key) <= set(s) for key in found):
                continue
            combined = 1.0
            for name in s:
                combined *= single[name] * (1 + SLACK)
            if combined >= rows:
                possible.append(s)
        left = possible if size == 1 else _without_near_repeats(df, possible, single, rows)
        found += [s for s in left if not _repeats(df, s, rows)]
    return found


def _family(kind: T.DataType) -> str | None:
    """Types whose values can refer to each other; None for those that identify nothing."""
    if isinstance(kind, T.IntegralType):
        return "bigint"
    return kind.simpleString() if isinstance(kind, (T.StringType, T.DateType, T.DecimalType)) else None


def references(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> list[tuple[str, str, str, str]]:
    """(child, column, parent, key): every value of the column occurs in the parent's key, and it has values.

    ``keys`` names the columns of each table that other columns may refer to. A column refers to its own
    table's other keys as well. Bounds and sketches rule pairs out: one pass over each table. All that are left of a
    type are confirmed together: one more pass over each column. Inclusion is all that is told: a small number that
    counts something lies within any dense key.
    """
    referred = {_family(tables[t].schema[k].dataType) for t, names in keys.items() if t in tables for k in names if k in tables[t].columns}
    kept: dict[tuple[str, str], tuple] = {}
    for table, df in tables.items():
        kinds = {f.name: kind for f in df.schema.fields if (kind := _family(f.dataType)) and kind in referred}
        if not kinds:
            continue
        values = [named(name).cast(kind) for name, kind in kinds.items()]
        # Each hash is used twice, so Spark projects it in compiled code rather than within the sketch.
        hashes = [F.when(value.isNotNull(), F.xxhash64(value)).alias(f"hash{i}") for i, value in enumerate(values)]
        projected = df.select(*[value.alias(f"value{i}") for i, value in enumerate(values)], *hashes)
        figures = []
        for i in range(len(kinds)):
            figures += [F.min(f"value{i}").alias(f"least{i}"), F.max(f"value{i}").alias(f"most{i}"), F.count(f"hash{i}")]
            figures.append(F.theta_sketch_agg(f"hash{i}", F.lit(SKETCH_BITS)).alias(f"set{i}"))
        row = projected.agg(*figures).first()  # one row a table; a sketch has a bounded size
        for i, (name, kind) in enumerate(kinds.items()):
            kept[table, name] = (kind, row[f"least{i}"], row[f"most{i}"], row[f"set{i}"])
    pairs = []
    for (child, column), (kind, least, most, sketch) in kept.items():
        for parent, names in keys.items():
            for key in names:
                held = kept.get((parent, key))
                if held is None or (child, column) == (parent, key) or least is None or held[0] != kind:
                    continue
                if held[1] is not None and held[1] <= least and most <= held[2]:
                    pairs.append((child, column, parent, key, sketch, held[3]))
    if not pairs:
        return []
    spark = next(iter(tables.values())).sparkSession
    told = spark.createDataFrame([(i, p[4], p[5]) for i, p in enumerate(pairs)], "i int, a binary, b binary")
    outside = F.theta_sketch_estimate(F.theta_difference("a", "b"))
    likely = told.where(outside <= SLACK * F.theta_sketch_estimate("a")).select("i").collect()
    left = [pairs[i][:4] for i in sorted(row["i"] for row in likely)]
    holds: set[tuple[str, str, str, str]] = set()
    for kind in dict.fromkeys(kept[pair[:2]][0] for pair in left):
        alike = [pair for pair in left if kept[pair[:2]][0] == kind]
        columns = {side: tables[side[0]].select(named(side[1]).cast(kind).alias("value")) for pair in alike for side in (pair[:2], pair[2:])}
        orphans = audit_inclusions(columns, [(pair[:2], pair[2:]) for pair in alike])
        holds |= {pair for pair, n in zip(alike, orphans.first()["orphans"], strict=True) if n == 0}
    return [pair for pair in left if pair in holds]
