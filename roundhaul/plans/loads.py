"""Comparing the loads of a table, carrying changes over, histories, and compaction."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, named
from roundhaul.functions import digest
from roundhaul.functions.convert import as_contract
from roundhaul.operators.changes import applied, change_feed
from roundhaul.operators.validate import differing_rows
from roundhaul.session import local_table
from roundhaul.sources.warehouse import Layout, Load, Ranges, Warehouse

#: Up to so many ranges are named one by one where files are read; beyond, the span from the first to the last.
NAMED_RANGES = 100

Places = dict[int, list[str]]


@dataclass(frozen=True)
class Opened:
    """What has to be read to compare two loads: directories of either, and starts of ranges (None: all of them)."""

    before: Places
    after: Places
    starts: list[int | None] | None

    @property
    def nothing(self) -> bool:
        return not any(self.before.values()) and not any(self.after.values())


def _alike(one: Layout, two: Layout) -> bool:
    """Whether two loads were written alike, so that directories and digests mean the same."""
    same = one.contract.stored_schema == two.contract.stored_schema
    return same and one.contract.partitions == two.contract.partitions


def _without(places: Places, shared: set[tuple[int, str]]) -> Places:
    return {n: [d for d in held if (n, d) not in shared] for n, held in places.items()}


def opened(warehouse: Warehouse, contract: Contract, before: int, after: int) -> Opened:
    """Where two loads may differ, found from what was kept of them; no row is read.

    From the root down: equal digests of the tables open nothing. Directories that both loads name
    in the same place are the same files. Of the rest, those whose ranges all have equal digests are
    left out, and the starts of the ranges that differ are told.
    """
    one, two = warehouse.described(contract.name, before), warehouse.described(contract.name, after)
    places = [warehouse.places(contract.name, n) for n in (before, after)]
    if not _alike(one, two):
        return Opened(*places, None)
    if one.digest is not None and one.digest == two.digest:
        return Opened({}, {}, [])
    shared = {(n, d) for n, held in places[0].items() for d in held if d in places[1].get(n, [])}
    left = [_without(held, shared) for held in places]
    if one.ranges is None or one.ranges != two.ranges:
        return Opened(*left, None)
    sums = ["rows", *[f"sum{i}" for i in range(digest.PARTS)]]
    sides = []
    for load_id, held, sign in ((before, left[0], 1), (after, left[1], -1)):
        named_here = local_table(warehouse.spark, [(d,) for names in held.values() for d in names], "directory string")
        leaves = warehouse.leaves(contract, load_id).join(named_here, "directory", "left_semi")
        sides.append(leaves.select("directory", "start", *[(F.col(name) * sign).alias(name) for name in sums]))
    net = sides[0].unionByName(sides[1]).groupBy("directory", "start").agg(*[F.sum(name).alias(name) for name in sums])
    differing = net.where(reduce(lambda a, b: a | b, [F.col(name) != 0 for name in sums]))
    # A row a directory, as the listing has; of the ranges, no more than are named.
    found = differing.groupBy("directory").agg(
        F.slice(F.array_sort(F.collect_set("start")), 1, NAMED_RANGES + 1).alias("starts"),
        F.min("start").alias("first"),
        F.max("start").alias("last"),
        F.count_if(F.col("start").isNull()).alias("unknown"),
    ).collect()
    touched = {row["directory"] for row in found}
    left = [{n: [d for d in held if d in touched] for n, held in side.items()} for side in left]
    starts: set[int | None] = {start for row in found for start in row["starts"]}
    if len(starts) > NAMED_RANGES:
        first, last = min(r["first"] for r in found if r["starts"]), max(r["last"] for r in found if r["starts"])
        starts = set(range(first, last + 1, one.ranges.width)) if last - first < NAMED_RANGES * one.ranges.width else None
    if starts is not None and any(row["unknown"] for row in found):
        starts.add(None)
    return Opened(*left, None if starts is None else sorted(starts, key=lambda s: (s is None, s)))


def _rows(warehouse: Warehouse, contract: Contract, places: Places, ranges: Ranges | None, starts: list | None) -> DataFrame:
    """Rows of some directories, of those ranges alone; bounds reach the files' statistics."""
    rows = warehouse.in_places(contract, places)
    if starts is not None and ranges is not None:
        value = named(ranges.column)
        bounds = [(value >= start) & (value < start + ranges.width) for start in starts if start is not None]
        if None in starts:  # NULL, and numbers too small for a start
            bounds.append(value.isNull() | ranges.start().isNull())
        rows = rows.where(reduce(lambda a, b: a | b, bounds, F.lit(False)))
    return contract.from_stored(rows)


def _pair(warehouse: Warehouse, contract: Contract, before: int, after: int, found: Opened) -> tuple[DataFrame, DataFrame]:
    if not _alike(warehouse.described(contract.name, before), warehouse.described(contract.name, after)):
        return warehouse.read(contract, before), warehouse.read(contract, after)
    layout = warehouse.described(contract.name, before)
    one, two = (_rows(warehouse, layout.contract, held, layout.ranges, found.starts) for held in (found.before, found.after))
    return one, two


def load_difference(warehouse: Warehouse, contract: Contract, before: int, after: int) -> DataFrame:
    """The rows that one of two loads has more often than the other (``differing_rows``).

    Only what ``opened`` names is read: nothing for equal loads, one range of one directory for one changed row.
    """
    found = opened(warehouse, contract, before, after)
    one, two = _pair(warehouse, contract, before, after, found)
    return differing_rows(one, two)


def feed_between(warehouse: Warehouse, contract: Contract, before: int, after: int) -> DataFrame:
    """The change feed from one load to another, by the contract's key.

    Directories that both loads have in common are not read. Where a key is not unique, its rows in such
    directories are the same on both sides and take no part, so its kind of change is that of the others.
    """
    if not contract.key:
        raise ValueError(f"{contract.name} has no key")
    found = opened(warehouse, contract, before, after)
    # Whole directories: a row may have moved from one range or directory to another.
    one, two = _pair(warehouse, contract, before, after, Opened(found.before, found.after, None))
    return change_feed(one, two, contract.key)


def apply_feed(warehouse: Warehouse, contract: Contract, feed: DataFrame) -> Load:
    """A new load: the current one with a feed applied. Only directories that the feed touches are rewritten."""
    load_id = warehouse.require_load(contract.name)
    places = warehouse.places(contract.name, load_id)
    rows = feed.select(*[named(name) for name in contract.names])
    if contract.partitions:
        days = [contract.day_of(p.column).alias(p.key) for p in contract.partitions if p.by_day]
        keys = [p.key for p in contract.partitions]
        touched = rows.select("*", *days).select(*[named(key).alias(f"_{key}") for key in keys]).distinct()
        same = reduce(lambda a, b: a & b, [named(key).eqNullSafe(named(f"_{key}")) for key in keys])
        held = warehouse.keyed(contract, places).join(touched, same, "left_semi")
        chosen = {row["_directory"] for row in held.select("_directory").collect()}
    else:
        chosen = {name for held in places.values() for name in held}
    base = contract.from_stored(warehouse.in_places(contract, {n: [d for d in held if d in chosen] for n, held in places.items()}))
    return warehouse.replace(applied(base, feed), contract, chosen)


def history(warehouse: Warehouse, contract: Contract, load_ids: list[int] | None = None) -> DataFrame:
    """Every row of some loads (by default all that are kept) with the load it is valid from and the one it ends with.

    ``valid_to`` is the first load that no longer has the row equally often, NULL while it is valid; ``copies`` is
    how often the loads have it. Rows with ``valid_from <= n`` and ``valid_to`` NULL or beyond n make up load n.
    Loads may have different layouts; all are brought to the contract. A directory that several loads name is read once.
    One pass stacks the directories with the loads that see them; a row's copies in each load are summed up before
    the one shuffle, and its spans follow from the changes between neighbours.
    """
    ids = sorted(warehouse.loads(contract.name) if load_ids is None else load_ids)
    for name in ("valid_from", "valid_to", "copies"):
        if name in contract.names:
            raise ValueError(f"the table has a column named {name}")
    seen: dict[tuple[int, str], list[int]] = {}
    written = {}
    for i, load_id in enumerate(ids):
        shape = warehouse.described(contract.name, load_id).contract
        for holder, directories in warehouse.places(contract.name, load_id).items():
            for directory in directories:
                seen.setdefault((holder, directory), []).append(i)
                written.setdefault(holder, shape)
    alike: dict[tuple[int, tuple[int, ...]], list[str]] = {}
    for (holder, directory), loads in seen.items():
        alike.setdefault((holder, tuple(loads)), []).append(directory)
    span = "valid_from bigint, valid_to bigint, copies bigint"
    if not alike:
        empty = local_table(warehouse.spark, [], contract.schema)
        return empty.select("*", *[F.lit(None).cast("bigint").alias(part.split()[0]) for part in span.split(", ")])
    parts = []
    for (holder, loads), directories in alike.items():
        stored = warehouse.in_places(written[holder], {holder: directories})
        rows = as_contract(written[holder].from_stored(stored), contract)
        parts.append(rows.withColumn("_seen", F.array(*[F.lit(i) for i in loads])))
    names = [named(name) for name in contract.names]
    copies = [F.sum(F.when(F.array_contains("_seen", i), 1).otherwise(0)) for i in range(len(ids))]
    counted = reduce(DataFrame.unionByName, parts).groupBy(*names).agg(F.array(*copies).alias("_copies"))
    steps = F.sequence(F.lit(0), F.lit(len(ids) - 1))

    def at(i: Column) -> Column:
        return F.get(F.col("_copies"), i)

    starts = F.filter(steps, lambda i: (at(i) > 0) & ((i == 0) | (at(i) != F.coalesce(at(i - 1), F.lit(0)))))
    begun = counted.select(*names, "_copies", F.explode(starts).alias("_from"))
    ends = F.filter(steps, lambda i: (i > F.col("_from")) & (at(i) != at(F.col("_from"))))
    known = F.array(*[F.lit(load_id).cast("bigint") for load_id in ids])
    return begun.select(
        *names,
        F.get(known, F.col("_from")).alias("valid_from"),
        F.get(known, F.get(ends, F.lit(0))).alias("valid_to"),
        at(F.col("_from")).alias("copies"),
    )


def compact(warehouse: Warehouse, contract: Contract, target_bytes: int = 256 * 1024**2) -> Load | None:
    """A new load in which no directory has more files than its bytes need; None if none has.

    Files are never mixed between directories. Directories with more files than ``target_bytes`` asks for are
    rewritten, each into that many; all others are named where they lie. Rows of a directory are dealt over its
    files by their hash, so a large directory is written by several tasks.
    """
    load_id = warehouse.require_load(contract.name)
    sizes: dict[str, list[int]] = {}
    places: Places = {}
    for (holder, directory), held in warehouse.files(contract.name, load_id).items():
        sizes.setdefault(directory, []).extend(held)
        places.setdefault(holder, []).append(directory)
    wanted = {directory: max(1, -(-sum(held) // target_bytes)) for directory, held in sizes.items()}
    chosen = {directory for directory, held in sizes.items() if len(held) > wanted[directory]}
    if not chosen:
        return None
    kept = {n: [d for d in held if d in chosen] for n, held in places.items()}
    rows = contract.from_stored(warehouse.in_places(contract, kept))
    count = sum(wanted[d] for d in chosen)
    if contract.partitions:
        keys = [p.key for p in contract.partitions]
        days = [contract.day_of(p.column).alias(p.key) for p in contract.partitions if p.by_day]
        counts = local_table(warehouse.spark, [(d, wanted[d]) for d in sorted(chosen)], "_name string, _files int")
        held = warehouse.keyed(contract, kept).join(counts, F.col("_directory") == F.col("_name"))
        held = held.select("_files", *[named(key).alias(f"_{key}") for key in keys])
        same = reduce(lambda a, b: a & b, [named(key).eqNullSafe(named(f"_{key}")) for key in keys])
        rows = rows.select("*", *days).join(held, same)
        salt = F.pmod(F.xxhash64(*[named(name) for name in contract.names]), F.col("_files"))
        rows = rows.withColumn("_part", salt).repartition(count, *[named(key) for key in keys], "_part")
    else:
        rows = rows.repartition(count)
    return warehouse.replace(rows.select(*[named(name) for name in contract.names]), contract, chosen, gather=False)
