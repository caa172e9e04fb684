"""A restore that goes on where an earlier one failed: by ranges of a key, with a ledger of those that arrived."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, named
from roundhaul.functions import digest
from roundhaul.functions.convert import export_form
from roundhaul.functions.digest import Digest
from roundhaul.plans.jobs import Outcome, _timed
from roundhaul.plans.targets import RangeTarget
from roundhaul.sources.warehouse import Ranges, Warehouse

_LEDGER = "start bigint, rows bigint, " + ", ".join(f"sum{i} bigint" for i in range(digest.PARTS))
#: The table is sent in about so many parts, each checked and entered in the ledger by itself.
BATCHES = 16


class HalfSent(RuntimeError):
    """A range arrived in part, and the target cannot take it back."""


def digests(rows: DataFrame, contract: Contract, ranges: Ranges) -> DataFrame:
    """start, rows and sums of each range, of the rows as they are exported. One pass, summed up before the shuffle."""
    values = digest.exported([named(name) for name in contract.names], [c.type for c in contract.columns])
    return rows.groupBy(ranges.start().alias("start")).agg(*digest.sums(values))


def _within(ranges: Ranges, starts: list[int | None]) -> Column:
    """Rows of these ranges; neighbours are one condition, so there are few."""
    value, known = named(ranges.column), sorted(s for s in starts if s is not None)
    spans: list[list[int]] = []
    for start in known:
        if spans and spans[-1][1] == start:
            spans[-1][1] = start + ranges.width
        else:
            spans.append([start, start + ranges.width])
    # An end beyond the largest long is none.
    conditions = [(value >= low) & ((value < high) if high < 2**63 else F.lit(True)) for low, high in spans]
    if None in starts:
        conditions.append(value.isNull() | ranges.start().isNull())
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _collected(found: DataFrame) -> dict[int | None, Digest]:
    """One row a range: as many as the width makes, which the caller chooses."""
    return {row["start"]: digest.read_off(row) for row in found.collect()}


def _batches(pending: dict[int | None, Digest], count: int) -> list[list[int | None]]:
    """Ranges in order, in parts of about as many rows."""
    size = max(1, -(-sum(d.rows for d in pending.values()) // max(1, count)))
    out: list[list[int | None]] = []
    held = size
    for start in sorted(pending, key=lambda s: (s is None, s)):
        if held >= size:
            out.append([])
            held = 0
        out[-1].append(start)
        held += pending[start].rows
    return out


class Ledger:
    """The ranges of one load that arrived at one target, with the digests they arrived with."""

    def __init__(self, warehouse: Warehouse, table: str, load_id: int, label: str, ranges: Ranges):
        self.spark = warehouse.spark
        place = f"{label}/{ranges.column}-{ranges.width}/load={load_id}"
        self.path = f"{warehouse.root}/{warehouse.namespace}/{table}/restored/{place}"

    def read(self) -> dict[int | None, Digest]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return {}
        return _collected(self.spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(self.path))

    def add(self, arrived: DataFrame) -> None:
        """One file for each batch, put into place at once by Spark's committer."""
        arrived.coalesce(1).write.mode("append").parquet(self.path)


def restore_by_ranges(
    warehouse: Warehouse,
    contract: Contract,
    target: RangeTarget,
    ranges: Ranges,
    label: str = "target",
    as_of: int | None = None,
    batches: int = BATCHES,
) -> Outcome:
    """Bring a load back range by range; call it again after a failure and only what is missing is sent.

    A batch of ranges is sent, read back and compared, then entered in the ledger under ``label``, which stands for
    the target. Entered ranges are neither sent nor read again, as long as the load's digests are the same. Ranges
    that had arrived but were not entered are found by their digests and entered; one that arrived in part
    stops the restore, as the target has to be rid of it by hand. The target must be empty at first.
    """

    def work() -> Outcome:
        load_id = warehouse.require_load(contract.name, as_of)
        rows = warehouse.read(contract, load_id)
        ledger = Ledger(warehouse, contract.name, load_id, label, ranges)
        wanted, entered = _collected(digests(rows, contract, ranges)), ledger.read()
        pending = {start: found for start, found in wanted.items() if entered.get(start) != found}
        changed = [start for start in pending if start in entered]
        if changed:
            raise HalfSent(f"{contract.name}: {len(changed)} ranges have other contents than when they were sent")
        if not wanted:
            return Outcome("restore", contract.name, "no_data")
        sent = 0
        for batch in _batches(pending, batches):
            where = _within(ranges, batch)
            held = _arrived(target, contract, ranges, where, first=not entered and not sent)
            missing = [start for start in batch if start not in held]
            wrong = [start for start in batch if start in held and held[start] != pending[start]]
            if wrong:
                raise HalfSent(f"{contract.name}: {len(wrong)} ranges arrived in part, the first from {ranges.column} {wrong[0]}")
            if missing:
                target.append(export_form(rows.where(_within(ranges, missing))), contract)
                sent += sum(pending[start].rows for start in missing)
            arrived = digests(target.read(contract).where(where), contract, ranges)
            if _collected(arrived) != {start: pending[start] for start in batch}:
                return Outcome("restore", contract.name, "warning", sent, "FAILED", error="a batch differs from what was sent")
            ledger.add(arrived)
        return Outcome("restore", contract.name, "success", sum(d.rows for d in wanted.values()), "PASSED", note=f"{sent} rows sent")

    return _timed("restore", contract.name, work)


def _arrived(target: RangeTarget, contract: Contract, ranges: Ranges, where: Column, first: bool) -> dict[int | None, Digest]:
    """The digests of those ranges that the target has already; none where it has no table yet."""
    try:
        held = target.read(contract)
    except Exception:
        if first:  # nothing has been sent, so there may be no table to read
            return {}
        raise
    return _collected(digests(held.where(where), contract, ranges))
