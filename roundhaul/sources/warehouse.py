"""A Parquet warehouse in which every reload is a new directory.

Layout: ``<root>/<namespace>/<table>/data/load=<n>/<directory keys>/part-*.parquet``. Beside the
files of a load lies ``_layout.json``: the contract it was written with, its number of rows and their
digest. It is written last, and a load counts once it is there. So replacing a table is one step for
readers, a failed or killed run leaves the previous load in force, and earlier loads stay
readable whatever the table's contract has become.

A load that replaces only some directories of the one before it holds the new ones and names the
others where they lie, in earlier loads; no file is copied or touched. Digests of the ranges of a
key, where asked for, lie in ``<table>/digest/load=<n>``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import Contract, named
from roundhaul.functions import digest, locality, profiles
from roundhaul.functions.convert import as_contract
from roundhaul.functions.digest import Digest
from roundhaul.session import local_table


class NotMigrated(RuntimeError):
    """A restore was asked for before anything was migrated."""


@dataclass(frozen=True)
class Load:
    table: str
    id: int
    path: str
    rows: int


@dataclass(frozen=True)
class Ranges:
    """Equal ranges of an integer column, over which digests are kept and in whose order files are sorted."""

    column: str
    width: int

    def start(self) -> Column:
        """Where a row's range starts; NULL for NULL, and for a range that a long cannot tell."""
        value = named(self.column).cast("long")
        return F.try_subtract(value, F.pmod(value, F.lit(self.width).cast("long")))


@dataclass(frozen=True)
class Layout:
    """What is known of a load without reading it.

    ``digest`` is that of the rows as stored, ``exported`` of the rows as they leave for a target; loads
    written before there were digests have none. ``places`` are the directories of each load that holds
    some, or None where all lie in the load itself.
    """

    contract: Contract
    rows: int
    digest: Digest | None = None
    exported: Digest | None = None
    places: dict[int, list[str]] | None = None
    ranges: Ranges | None = None

    def text(self) -> str:
        held: dict[str, object] = {"rows": self.rows, "contract": self.contract.layout()}
        for name in ("digest", "exported", "ranges"):
            value = getattr(self, name)
            held[name] = value and asdict(value)
        held["places"] = self.places and {str(n): names for n, names in self.places.items()}
        return json.dumps(held, indent=1)

    @classmethod
    def parse(cls, text: str) -> Layout:
        held = json.loads(text)
        taken = [held.get(name) and Digest(held[name]["rows"], tuple(held[name]["sums"])) for name in ("digest", "exported")]
        places = held.get("places") and {int(n): names for n, names in held["places"].items()}
        ranges = held.get("ranges") and Ranges(**held["ranges"])
        return cls(Contract.from_layout(held["contract"]), held["rows"], *taken, places, ranges)


LAYOUT = "_layout.json"
_DIRECTORY = "_directory"
_LEAVES = "directory string, start bigint, rows bigint, " + ", ".join(f"sum{i} bigint" for i in range(digest.PARTS))


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if there is no such directory."""
    place, files = _place(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def _literal(path: str) -> str:
    """The path for Spark's readers, which would take brackets and stars as patterns."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def _sized_files(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Parquet files below a directory, relative to it, and their bytes; what Spark takes as hidden is left out."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return
    top, found = files.makeQualified(place).toUri(), files.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        name = top.relativize(status.getPath().toUri()).getPath()
        if name.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in name.split("/")):
            yield name, status.getLen()


def _parquet_files(spark: SparkSession, path: str) -> Iterator[str]:
    return (name for name, _ in _sized_files(spark, path))


def read_directory(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """All Parquet files of a directory and the directories in it as one table; without any there are no rows.

    Directories that hold values in their names (``key=value``) are refused, since those values
    are no part of the files.
    """
    empty = True
    for name in _parquet_files(spark, path):
        empty = False
        keys = [part for part in name.split("/")[:-1] if "=" in part]
        if keys:
            raise ValueError(f"{path} is partitioned by directories such as {keys[0]}; read it through a warehouse")
    if empty:
        return local_table(spark, [], contract.schema)
    reader = spark.read.schema(contract.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return reader.parquet(_literal(path)).select(*[named(name) for name in contract.names])


def directory_of(path: Column, load: int) -> Column:
    """The directory below its load that a file lies in, as the file system names it."""
    # Paths come URL-encoded, but with a plus sign as itself.
    inside = F.regexp_extract(path, f"/load={load}/(?:(.*)/)?[^/]*$", 1)
    return F.url_decode(F.replace(inside, F.lit("+"), F.lit("%2B")))


def count_by_table(spark: SparkSession, namespace: str, paths: Mapping[str, str | list[str]], owner: str) -> DataFrame:
    """Row count of each ``{table: path or paths}``, found in one job that reads no column.

    ``owner`` is a pattern whose first group takes the table name out of a file's path.
    Grouping by the file a row came from keeps the plan the same size for any number of
    tables; with no column to decode, Parquet answers from its footers. The pattern is
    matched once per file, not per row.
    """
    every = [path for held in paths.values() for path in ([held] if isinstance(held, str) else held)]
    rows = spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true").parquet(*map(_literal, every))
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    # Paths come URL-encoded, but with a plus sign as itself.
    table_name = F.url_decode(F.replace(F.regexp_extract("file", owner, 1), F.lit("+"), F.lit("%2B"))).alias("table_name")
    counted = per_file.groupBy(table_name).agg(F.sum("n").alias("rows"))
    names = local_table(spark, [(namespace, table) for table in paths], "namespace string, table_name string")
    unknown = F.raise_error(F.concat(F.lit("files that belong to no table: "), F.col("table_name")))
    return names.join(counted, "table_name", "full").select(
        F.coalesce("namespace", unknown.cast("string")).alias("namespace"),
        "table_name",
        F.coalesce("rows", F.lit(0)).alias("row_count"),
    )


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, namespace: str = "sales"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace

    def folder(self, table: str) -> str:
        return f"{self.root}/{self.namespace}/{table}/data"

    def _attempts(self, table: str) -> list[int]:
        found = (re.fullmatch(r"load=(\d+)", name) for name in _children(self.spark, self.folder(table)))
        return sorted(int(match[1]) for match in found if match)

    def _finished(self, table: str, load_id: int) -> bool:
        place, files = _place(self.spark, f"{self.folder(table)}/load={load_id}/{LAYOUT}")
        return files.exists(place)

    def loads(self, table: str) -> list[int]:
        """Ids of the finished loads of a table, oldest first."""
        return [load_id for load_id in self._attempts(table) if self._finished(table, load_id)]

    def tables(self) -> list[str]:
        """Tables that have at least one finished load."""
        return sorted(name for name in _children(self.spark, f"{self.root}/{self.namespace}") if self.loads(name))

    def _keep_layout(self, path: str, layout: Layout) -> None:
        """Put the layout into place under its name in one step."""
        draft, files = _place(self.spark, f"{path}/_draft-{LAYOUT}")
        out = files.create(draft, True)
        out.write(bytearray(layout.text().encode()))
        out.close()
        if not files.rename(draft, _place(self.spark, f"{path}/{LAYOUT}")[0]):
            raise OSError(f"{path}: {LAYOUT} could not be put into place")

    def described(self, table: str, load_id: int) -> Layout:
        """What was kept of a load when it was written."""
        place, files = _place(self.spark, f"{self.folder(table)}/load={load_id}/{LAYOUT}")
        stream = files.open(place)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return Layout.parse(text)

    def layout(self, table: str, load_id: int) -> tuple[Contract, int]:
        """The contract a load was written with, and its number of rows."""
        layout = self.described(table, load_id)
        return layout.contract, layout.rows

    def directories(self, table: str, load_id: int) -> list[str]:
        """The directories with files in a load's own folder; an unpartitioned load has one without a name."""
        names = _parquet_files(self.spark, f"{self.folder(table)}/load={load_id}")
        return sorted({name.rpartition("/")[0] for name in names})

    def places(self, table: str, load_id: int) -> dict[int, list[str]]:
        """Every directory of a load, under the load that holds its files."""
        held = self.described(table, load_id).places
        return {load_id: self.directories(table, load_id)} if held is None else held

    def require_migrated(self) -> None:
        if not self.tables():
            raise NotMigrated(f"nothing has been migrated to {self.root}/{self.namespace} yet")

    def write(
        self, df: DataFrame, contract: Contract, gather: bool = True, ranges: Ranges | None = None, cluster: Sequence[str] = ()
    ) -> Load:
        """Create or replace a table and tell how many rows went into it.

        With ``gather``, rows of a partitioned table are rebalanced on their directory keys,
        so each task writes few directories; adaptive execution splits a key that holds too
        much. Without it every task writes all the keys it meets, which saves the shuffle
        where the keys have only a few values; so does a session without adaptive execution,
        where a frequent key would end up in one task. An unpartitioned table is never shuffled.
        Rows are counted and digested in the stage that writes, where a retried task is counted once.

        With ``ranges``, the rows of each file are sorted by their column (unless ``cluster`` orders them), and what was written is
        read once more for the digest of each range of each directory.

        With ``cluster``, the rows of each directory are laid along a curve through these columns, by ranges and
        sorted within them, so that files and row groups have narrow bounds in all of them at once and a
        filter on any few of them skips most. The rows are read twice more, for the parts of the columns and for the ranges.
        """
        load_id, path, found = self._files(df, contract, gather, ranges, cluster)
        layout = Layout(contract, found[0].rows, *found, None, ranges)
        if ranges is not None:
            self._keep_leaves(contract, load_id, ranges)
        self._keep_layout(path, layout)
        return Load(contract.name, load_id, path, layout.rows)

    def _files(
        self, df: DataFrame, contract: Contract, gather: bool, ranges: Ranges | None, cluster: Sequence[str] = ()
    ) -> tuple[int, str, list[Digest]]:
        """Write the files of a new load; its digests as stored and as exported."""
        load_id = max(self._attempts(contract.name), default=0) + 1
        path = f"{self.folder(contract.name)}/load={load_id}"
        keys = [p.key for p in contract.partitions]
        rows = contract.to_stored(df)
        if cluster:
            along = locality.locality_key(rows, cluster, locality.borders(rows, cluster))
            order = [*[named(key) for key in keys], along]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        elif keys and gather and self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
            rows = rows.hint("rebalance", *[named(key) for key in keys])
        if ranges is not None and not cluster:
            rows = rows.sortWithinPartitions(*[named(key) for key in keys], named(ranges.column))
        observed = Observation()
        values = contract.stored_values()
        writer = rows.observe(observed, *_digests(values, contract)).write.mode("errorifexists")
        writer = writer.option("compression", "snappy")
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(path)
        return load_id, path, _read_digests(observed.get, contract)

    def reload(self, df: DataFrame, contract: Contract, only: Column | None = None, gather: bool = True) -> Load:
        """Replace the directories that these rows fall into, and keep the others where they are.

        ``only`` is a condition on the directory keys (the column, or ``<column>_day``). Directories it
        holds for are replaced even if no row falls into them any more; a row it does not hold for stops the job.
        The layout must be that of the current load; without directories, or without a current load, all is written.
        """
        if only is not None and not contract.partitions:
            raise ValueError(f"{contract.name} has no directories to choose from")
        load_id = self.newest(contract.name, None)
        rows = self._within(df, contract, only)
        if load_id is None or not contract.partitions:
            return self.write(rows, contract, gather)
        chosen: set[str] = set()
        if only is not None:
            held = self.keyed(contract, self.places(contract.name, load_id)).where(only)
            chosen = {row[_DIRECTORY] for row in held.select(_DIRECTORY).collect()}
        return self.replace(rows, contract, chosen, gather)

    def replace(self, df: DataFrame, contract: Contract, gone: set[str], gather: bool = True) -> Load:
        """A load with these rows in place of some directories of the current one, and of all that the rows fall into.

        It names the untouched directories in the loads that hold them; their files are neither read
        nor written. The replaced ones are read once, to take their digest away from the table's.
        """
        load_id = self.require_load(contract.name)
        base = self.described(contract.name, load_id)
        if base.contract.partitions != contract.partitions or base.contract.stored_schema != contract.stored_schema:
            raise ValueError(f"{contract.name}: the current load has other columns or directories; write it anew")
        before = self.places(contract.name, load_id)
        new_id, path, found = self._files(df, contract, gather, base.ranges)
        written = self.directories(contract.name, new_id)
        gone = gone | set(written)
        lost = self._digest_of(contract, {n: [d for d in held if d in gone] for n, held in before.items()})
        kept = {n: [d for d in held if d not in gone] for n, held in before.items()}
        places = {n: held for n, held in kept.items() if held} | {new_id: written}
        rows, digests = base.rows - lost[0].rows + found[0].rows, [None, None]
        if base.digest is not None:  # loads written before there were digests have none
            digests = [base.digest - lost[0] + found[0], base.exported - lost[1] + found[1]]
        if base.ranges is not None:
            self._keep_leaves(contract, new_id, base.ranges)
        self._keep_layout(path, Layout(contract, rows, *digests, places, base.ranges))
        return Load(contract.name, new_id, path, rows)

    def append(self, df: DataFrame, contract: Contract, gather: bool = True) -> Load:
        """A load with these rows beside those of the current one, whose files it names; none is read or written again."""
        load_id = self.newest(contract.name)
        if load_id is None:
            return self.write(df, contract, gather)
        base = self.described(contract.name, load_id)
        if base.contract.partitions != contract.partitions or base.contract.stored_schema != contract.stored_schema:
            raise ValueError(f"{contract.name}: the current load has other columns or directories; write it anew")
        before = self.places(contract.name, load_id)
        new_id, path, found = self._files(df, contract, gather, base.ranges)
        digests = [None, None] if base.digest is None else [base.digest + found[0], base.exported + found[1]]
        places = before | {new_id: self.directories(contract.name, new_id)}
        if base.ranges is not None:
            self._keep_leaves(contract, new_id, base.ranges)
        rows = base.rows + found[0].rows
        self._keep_layout(path, Layout(contract, rows, *digests, places, base.ranges))
        return Load(contract.name, new_id, path, rows)

    def require_load(self, table: str, as_of: int | None = None) -> int:
        """``newest``, where there must be one."""
        load_id = self.newest(table, as_of)
        if load_id is None:
            raise NotMigrated(f"{table} has no load in {self.root}/{self.namespace}")
        return load_id

    def _within(self, df: DataFrame, contract: Contract, only: Column | None) -> DataFrame:
        """The rows, none of which may lie outside the condition on the directory keys."""
        if only is None:
            return df
        days = [contract.day_of(p.column).alias(p.key) for p in contract.partitions if p.by_day]
        refused = F.raise_error(F.lit(f"{contract.name}: a row lies outside the directories to be replaced"))
        held = df.select("*", *days).where(F.when(only, True).otherwise(refused.cast("boolean")))
        return held.select(*[named(name) for name in contract.names])

    def keyed(self, contract: Contract, places: dict[int, list[str]]) -> DataFrame:
        """One row for each directory, with its keys as the values they stand for. No file is read."""
        kinds = {f.name: f.dataType for f in contract.stored_schema.fields}
        keys = [p.key for p in contract.partitions]
        told = []
        for directory in sorted({name for held in places.values() for name in held}):
            texts = [unquote(part.partition("=")[2]) for part in directory.split("/")]
            told.append((directory, *[None if text == "__HIVE_DEFAULT_PARTITION__" else text for text in texts]))
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (_DIRECTORY, *keys)])
        held = local_table(self.spark, told, schema)
        held = held.select(_DIRECTORY, *[named(key).cast(kinds[key]).alias(key) for key in keys])
        values = dict(zip(contract.names, contract.stored_values(), strict=True))
        return held.select(_DIRECTORY, *[values[key].alias(key) if key in values else named(key) for key in keys])

    def _digest_of(self, contract: Contract, places: dict[int, list[str]]) -> list[Digest]:
        """The digests, as stored and as exported, of the rows in some directories."""
        if not any(places.values()):
            return [digest.NOTHING, digest.NOTHING]
        rows = self.in_places(contract, places)
        return _read_digests(rows.agg(*_digests(contract.stored_values(), contract)).first().asDict(), contract)

    def _keep_leaves(self, contract: Contract, load_id: int, ranges: Ranges) -> None:
        """Digests of each range of each directory that a load holds itself."""
        target = self.beside("digest", contract.name, load_id)
        if not self.directories(contract.name, load_id):
            local_table(self.spark, [], _LEAVES).write.parquet(target)
            return
        rows = self._below(contract, load_id, [""])
        path = F.col("_metadata.file_path").alias("path")
        per_file = rows.groupBy(path, ranges.start().alias("start")).agg(*digest.sums(contract.stored_values()))
        totals = [F.sum(name).alias(name) for name in per_file.columns[2:]]
        leaves = per_file.groupBy(directory_of(F.col("path"), load_id).alias("directory"), "start").agg(*totals)
        leaves.write.parquet(target)

    def beside(self, kind: str, table: str, load_id: int) -> str:
        """Where what was worked out of a load's own files is kept: its ``digest`` or its ``profile``."""
        return f"{self.root}/{self.namespace}/{table}/{kind}/load={load_id}"

    def read_beside(self, kind: str, table: str, load_id: int, schema: str) -> DataFrame:
        """What is kept of all directories of a load, wherever they lie; each row has its ``directory``."""
        found = [local_table(self.spark, [], schema)]
        for holder, directories in self.places(table, load_id).items():
            path = _literal(self.beside(kind, table, holder))
            rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
            kept = local_table(self.spark, [(name,) for name in directories], "directory string")
            found.append(rows.join(kept, "directory", "left_semi"))
        return reduce(DataFrame.unionByName, found)

    def leaves(self, contract: Contract, load_id: int) -> DataFrame | None:
        """directory, start, rows and sums of each range of each directory of a load; None if they were not kept."""
        if self.described(contract.name, load_id).ranges is None:
            return None
        return self.read_beside("digest", contract.name, load_id, _LEAVES)

    def keep_profile(self, contract: Contract, load_id: int) -> None:
        """Keep a mergeable profile of each directory of a load; directories that have one are not read again."""
        for holder in self.places(contract.name, load_id):
            target = self.beside("profile", contract.name, holder)
            if _children(self.spark, target):
                continue
            rows = self.in_places(contract, {holder: self.directories(contract.name, holder)})
            path = F.col("_metadata.file_path") if self.directories(contract.name, holder) else F.lit("")
            per_file = rows.groupBy(path.alias("path")).agg(*profiles.sketches(contract.stored_values(), contract.columns))
            named_files = per_file.withColumn("directory", directory_of(F.col("path"), holder))
            named_files.groupBy("directory").agg(*profiles.merges(contract.columns)).write.parquet(target)

    def profile(self, contract: Contract, only: Column | None = None, as_of: int | None = None) -> DataFrame:
        """One row per column over the directories that a condition on their keys holds for, or over all.

        Nothing but the kept profiles is read (``keep_profile``).
        """
        load_id = self.require_load(contract.name, as_of)
        kept = self.read_beside("profile", contract.name, load_id, profiles.schema(contract.columns))
        if only is not None:
            chosen = self.keyed(contract, self.places(contract.name, load_id)).where(only)
            kept = kept.join(chosen.select(F.col(_DIRECTORY).alias("directory")), "directory", "left_semi")
        return profiles.told(kept.agg(*profiles.merges(contract.columns)), contract.columns)

    def files(self, table: str, load_id: int) -> dict[tuple[int, str], list[int]]:
        """The sizes of the files in each directory of a load, under the load that holds it and its name."""
        found: dict[tuple[int, str], list[int]] = {}
        for holder, directories in self.places(table, load_id).items():
            wanted = set(directories)
            for name, size in _sized_files(self.spark, f"{self.folder(table)}/load={holder}"):
                directory = name.rpartition("/")[0]
                if directory in wanted:
                    found.setdefault((holder, directory), []).append(size)
        return found

    def newest(self, table: str, as_of: int | None = None) -> int | None:
        """The id of the newest finished load, or of the newest up to ``as_of``; None without one."""
        usable = [n for n in self._attempts(table) if as_of is None or n <= as_of]
        return next((n for n in reversed(usable) if self._finished(table, n)), None)

    def _stored(self, contract: Contract, as_of: int | None) -> tuple[DataFrame, Contract]:
        """The rows of a load as they lie in its files, and the contract they were written with."""
        load_id = self.newest(contract.name, as_of)
        if load_id is None:
            return local_table(self.spark, [], contract.stored_schema), contract
        layout = self.described(contract.name, load_id)
        if layout.places is not None:
            return self.in_places(layout.contract, layout.places), layout.contract
        return self._below(layout.contract, load_id, [""]), layout.contract

    def _below(self, written: Contract, load_id: int, directories: list[str]) -> DataFrame:
        """Stored rows in some directories of the files of one load."""
        path = f"{self.folder(written.name)}/load={load_id}"
        reader = self.spark.read.schema(written.stored_schema).option("basePath", path)
        paths = [f"{path}/{name}" if name else path for name in directories]
        return reader.option("pathGlobFilter", "*.parquet").parquet(*map(_literal, paths))

    def in_places(self, written: Contract, places: dict[int, list[str]]) -> DataFrame:
        """Stored rows of directories that lie in several loads; a load that is wanted whole is read as one."""
        found = []
        for load_id, directories in sorted(places.items()):
            if directories:
                whole = directories == self.directories(written.name, load_id)
                found.append(self._below(written, load_id, [""] if whole else directories))
        if not found:
            return local_table(self.spark, [], written.stored_schema)
        return reduce(DataFrame.unionByName, found)

    def read(self, contract: Contract, as_of: int | None = None) -> DataFrame:
        """The newest finished load, or the newest with an id up to ``as_of``.

        A load is read with the layout it was written with, then brought to the contract: columns
        it lacks are NULL, others are converted, and a value that does not fit stops the job.
        """
        rows, written = self._stored(contract, as_of)
        return as_contract(written.from_stored(rows), contract)

    def read_range(self, contract: Contract, column: str, start, end, as_of: int | None = None) -> DataFrame:
        """Rows with ``start <= column < end``, opening only the directories of those days.

        Spark does not conclude the day from the timestamp, so the bounds on the directory
        key are stated as well. Bounds go in as text, because a datetime literal would pass
        through the session's time zone.
        """
        rows, written = self._stored(contract, as_of)
        kind = written.column(column).type
        low, high = (F.lit(str(bound)).cast(kind) for bound in (start, end))
        if isinstance(kind, T.DateType):  # a day counts as its first instant; cut bounds only prune
            first, last = (F.lit(str(bound)).cast("timestamp_ntz") for bound in (start, end))
            moment = named(column).cast("timestamp_ntz")
            rows = rows.where((named(column) >= low) & (named(column) <= high) & (moment >= first) & (moment < last))
        else:
            rows = rows.where((named(column) >= low) & (named(column) < high))
        level = next((p for p in written.partitions if p.column == column and p.by_day), None)
        if level is not None:
            first, last = (written.day_of(column, bound) for bound in (low, high))
            rows = rows.where((named(level.key) >= first) & (named(level.key) <= last))
        return as_contract(written.from_stored(rows), contract)

    def drop_loads(self, table: str, keep: int = 1) -> list[int]:
        """Delete all but the newest ``keep`` finished loads, and unfinished ones older than those.

        Directories that a kept load still names stay where they are, though their load is gone.
        Nothing may be reading or writing the deleted loads.
        """
        if keep < 1:
            raise ValueError("at least the current load must be kept")
        finished = self.loads(table)
        oldest_kept = finished[-keep:][0] if finished else 0
        named_still: dict[int, set[str]] = {}
        for load_id in finished[-keep:]:
            for holder, directories in (self.described(table, load_id).places or {}).items():
                named_still.setdefault(holder, set()).update(directories)
        dropped = [n for n in self._attempts(table) if n < oldest_kept]
        for load_id in dropped:
            path = f"{self.folder(table)}/load={load_id}"
            if load_id not in named_still:
                self._delete(path)
                for kind in ("digest", "profile"):
                    self._delete(self.beside(kind, table, load_id))
                continue
            self._delete(f"{path}/{LAYOUT}")  # first of all, so that it no longer counts as a load
            for directory in self.directories(table, load_id):
                if directory not in named_still[load_id]:
                    self._delete(f"{path}/{directory}")
        return dropped

    def _delete(self, path: str) -> None:
        place, files = _place(self.spark, path)
        files.delete(place, True)

    def publish(self, contracts: Iterable[Contract]) -> None:
        """Make the current loads available to SQL under their table names."""
        for contract in contracts:
            self.read(contract).createOrReplaceTempView(contract.name)

    def inventory(self) -> DataFrame:
        """Namespace, table and row count of every table that has been loaded."""
        paths = {table: self._paths(table, self.newest(table, None)) for table in self.tables()}
        if not paths:
            return local_table(self.spark, [], "namespace string, table_name string, row_count bigint")
        return count_by_table(self.spark, self.namespace, paths, r"/([^/]+)/data/load=")

    def _paths(self, table: str, load_id: int) -> list[str]:
        """The load's folder, or the folders of all its directories where they lie in several loads."""
        places = self.described(table, load_id).places
        if places is None:
            return [f"{self.folder(table)}/load={load_id}"]
        return [f"{self.folder(table)}/load={n}/{name}" for n, names in places.items() for name in names]


def _digests(values: list[Column], contract: Contract) -> list[Column]:
    """Aggregates for the digest of stored rows and, where they differ, for that of exported ones."""
    kinds = [c.type for c in contract.columns]
    wanted = digest.sums(values)
    if any(isinstance(kind, (T.FloatType, T.DoubleType)) for kind in kinds):
        wanted += digest.sums(digest.exported(values, kinds), "exported_")
    return wanted


def _read_digests(found: Mapping, contract: Contract) -> list[Digest]:
    stored = digest.read_off(found)
    return [stored, digest.read_off(found, "exported_") if "exported_rows" in found else stored]
