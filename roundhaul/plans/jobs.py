"""Migration, restore and the full cycle, with one report row per table."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, named
from roundhaul.functions import digest
from roundhaul.functions.convert import conform, export_form
from roundhaul.operators.audit import audit_contracts
from roundhaul.operators.validate import FAILED, PASSED, content_match, same_columns, statistics_match
from roundhaul.plans.targets import Target
from roundhaul.session import activate, local_table
from roundhaul.sources.warehouse import Layout, Warehouse

log = logging.getLogger(__name__)

ERROR = "ERROR"
_REPORT = (
    "job string, table_name string, status string, rows bigint, validation string, "
    "seconds double, error string, note string, finished_at timestamp_ntz"
)


@dataclass(frozen=True)
class Source:
    """A table to migrate: its contract, how to read it, and whether its directories are worth a shuffle."""

    contract: Contract
    read: Callable[[], DataFrame]
    gather: bool = True


@dataclass(frozen=True)
class Statistics:
    """The columns a table's load statistics are taken over."""

    entity: str
    moment: str


@dataclass(frozen=True)
class Outcome:
    job: str
    table: str
    status: str
    rows: int = 0
    validation: str | None = None
    seconds: float = 0.0
    error: str | None = None
    note: str | None = None
    finished_at: dt.datetime | None = None


def report(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """The outcomes of a job, one row per table."""
    rows = [
        (o.job, o.table, o.status, o.rows, o.validation, o.seconds, o.error, o.note, o.finished_at) for o in outcomes
    ]
    return local_table(spark, rows, _REPORT)


def keep_report(warehouse: Warehouse, outcomes: Sequence[Outcome]) -> None:
    """Add the outcomes of a finished job to the warehouse's log."""
    kept = report(warehouse.spark, outcomes).coalesce(1)
    kept.write.mode("append").parquet(f"{warehouse.root}/job_report")


def past_reports(warehouse: Warehouse) -> DataFrame:
    return warehouse.spark.read.schema(_REPORT).parquet(f"{warehouse.root}/job_report")


def total_rows(outcomes: Iterable[Outcome]) -> int:
    """Rows moved by the tables that went through."""
    return sum(o.rows for o in outcomes if o.status == "success")


def _each(spark: SparkSession, tables: Sequence, work: Callable, parallel: int) -> list[Outcome]:
    """Run the tables next to each other, each as jobs of its own; results keep the given order."""
    with ThreadPoolExecutor(max(1, parallel), initializer=activate, initargs=(spark,)) as pool:
        return list(pool.map(work, tables))


def _timed(job: str, table: str, work: Callable[[], Outcome]) -> Outcome:
    """Run one table; whatever goes wrong with it must not stop the others."""
    start = time.monotonic()
    try:
        outcome = work()
    except Exception as problem:  # noqa: BLE001 - the report carries any failure
        log.error("%s of %s failed: %s", job, table, problem)
        outcome = Outcome(job, table, "failed", error=str(problem))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return replace(outcome, seconds=time.monotonic() - start, finished_at=now)


def migrate(warehouse: Warehouse, sources: Sequence[Source], parallel: int = 4) -> list[Outcome]:
    """Load each table into the warehouse, replacing what an earlier run put there."""

    def one(source: Source) -> Outcome:
        def work() -> Outcome:
            rows = conform(source.read(), source.contract)
            load = warehouse.write(rows, source.contract, source.gather)
            shortened = ", ".join(source.contract.shortened)
            note = f"kept to the microsecond: {shortened}" if shortened else None
            return Outcome("migrate", source.contract.name, "success", load.rows, note=note)

        return _timed("migrate", source.contract.name, work)

    return _each(warehouse.spark, sources, one, parallel)


def audit(warehouse: Warehouse, contracts: Sequence[Contract], as_of: int | None = None) -> DataFrame:
    """How many stored rows break each declared rule, over the newest loads or those up to ``as_of``."""
    return audit_contracts({c.name: warehouse.read(c, as_of) for c in contracts}, contracts)


def _validated(
    expected: DataFrame, read_target: Callable[[], DataFrame], statistics: Statistics | None
) -> tuple[str, int, str | None, str | None]:
    """Validation status, rows found in the target, what went wrong in the check itself, and the values that failed."""
    try:
        target = read_target()
        # Both results have a fixed, small number of rows.
        contents = content_match(expected, target).first()
        wrong = []
        if contents["source_rows"] != contents["target_rows"]:
            wrong.append(f"rows: {contents['source_rows']} expected, {contents['target_rows']} found")
        elif contents["status"] == FAILED:
            wrong.append("rows with other contents")
        if statistics is not None:
            checked = statistics_match(expected, target, statistics.entity, statistics.moment).where(F.col("status") == FAILED)
            wrong += [f"{r['statistic']}: {r['source_value']} expected, {r['target_value']} found" for r in checked.collect()]
        return FAILED if wrong else PASSED, contents["target_rows"], None, "; ".join(wrong) or None
    except Exception as problem:  # noqa: BLE001 - a check that cannot run is reported, not raised
        return ERROR, 0, str(problem), None


def restore(
    warehouse: Warehouse,
    contracts: Sequence[Contract],
    target: Target,
    *,
    only: Sequence[str] | None = None,
    create: bool = True,
    validate: bool = True,
    statistics: dict[str, Statistics] | None = None,
    as_of: int | None = None,
    attempts: int = 2,
    parallel: int = 4,
) -> list[Outcome]:
    """Bring tables back from the warehouse and compare what arrived with what was sent.

    A table whose contents differ is sent again, up to ``attempts`` times, because a
    database commits task by task and a retried task may have repeated its rows. It ends as
    ``warning`` if it still differs, and its note tells what was expected and found.
    """
    warehouse.require_migrated()
    by_name = {c.name: c for c in contracts}
    unknown = [name for name in only or () if name not in by_name]
    if unknown:
        raise LookupError(f"no contract for {unknown}")
    chosen = [by_name[name] for name in only] if only is not None else list(contracts)

    def one(contract: Contract) -> Outcome:
        def work() -> Outcome:
            held = warehouse.newest(contract.name, as_of)
            if held is None or warehouse.described(contract.name, held).rows == 0:
                return Outcome("restore", contract.name, "no_data")
            rows = warehouse.read(contract, held)
            checked = (statistics or {}).get(contract.name)
            if not validate:
                target.write(rows, contract, create)
                return Outcome("restore", contract.name, "success", target.read(contract).count())
            for _ in range(max(1, attempts)):
                target.write(rows, contract, create)
                validation, found, error, wrong = _validated(export_form(rows), lambda: target.read(contract), checked)
                if validation != FAILED:
                    break
            status = "success" if validation == PASSED else "warning"
            return Outcome("restore", contract.name, status, found, validation, error=error, note=wrong)

        return _timed("restore", contract.name, work)

    return _each(warehouse.spark, chosen, one, parallel)


def _same_contents(load: Layout, target: DataFrame, contract: Contract) -> bool:
    """Whether a target holds the rows that went into a load, by the digest taken while they were written."""
    same_columns(local_table(target.sparkSession, [], contract.schema), target)
    values = digest.exported([named(name) for name in contract.names], [c.type for c in contract.columns])
    return digest.read_off(target.agg(*digest.sums(values)).first()) == load.exported


def full_cycle(
    warehouse: Warehouse, sources: Sequence[Source], target: Target, parallel: int = 4
) -> list[dict[str, object]]:
    """Migrate, restore, and compare what the restore delivered with what the source gave.

    PASSED means that both steps went through, moved as many rows as the source gave, and delivered
    their contents. The source is read once: its rows are counted and digested in the stage that writes them,
    and the target, read back, must have the same digest. The load that was just written is the one restored;
    after a failed migration nothing is. Each table goes through on its own, so none waits for the slowest of a stage.
    """

    def one(source: Source) -> dict[str, object]:
        contract = source.contract
        migrated = migrate(warehouse, [source], 1)[0]
        restored = Outcome("restore", contract.name, "no_data")
        row = {"table_name": contract.name, "source_rows": None, "migrated_rows": migrated.rows}
        row |= {"restored_rows": 0, "status": ERROR}
        if migrated.status != "success":
            return row
        try:
            written = warehouse.loads(contract.name)[-1]
            load = warehouse.described(contract.name, written)
            row["source_rows"] = load.digest.rows
            restored = restore(warehouse, [contract], target, validate=False, as_of=written, parallel=1)[0]
            row["restored_rows"] = restored.rows
            empty = restored.status == "no_data" and load.digest.rows == 0
            if empty:
                row["status"] = PASSED
            elif restored.status == "success":
                moved = {load.digest.rows, migrated.rows, restored.rows}
                equal = len(moved) == 1 and _same_contents(load, target.read(contract), contract)
                row["status"] = PASSED if equal else FAILED
        except Exception as problem:  # noqa: BLE001 - reported per table like every other failure
            log.error("check of %s failed: %s", contract.name, problem)
        return row

    return _each(warehouse.spark, sources, one, parallel)
