"""Command line: ``python -m roundhaul migrate|restore|inventory|compare|compact ...``.

The five sales tables are known by themselves; ``migrate --catalog`` takes the tables and their types from
the source's catalog, and the other commands take any table of the warehouse as it was written. Master and driver jar (``spark.jars``) come from the Spark configuration, the database
password from ``ROUNDHAUL_PASSWORD``.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from roundhaul.contracts import Contract
from roundhaul.contracts.sales import SALES
from roundhaul.plans import jobs, loads
from roundhaul.plans.targets import JdbcTarget, Target, WarehouseTarget
from roundhaul.session import build_session
from roundhaul.sources import NotMigrated, Warehouse, jdbc


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roundhaul")
    commands = parser.add_subparsers(dest="command", required=True)
    names = [c.name for c in SALES]
    for command in ("migrate", "restore", "inventory", "compare", "compact"):
        one = commands.add_parser(command)
        one.add_argument("--warehouse", required=True, help="root folder of the Parquet warehouse")
        one.add_argument("--schema", default="sales", help="schema of the database and of the warehouse")
        if command == "inventory":
            continue
        if command in ("compare", "compact"):
            one.add_argument("--table", required=True, help="a table of the warehouse")
        if command == "compare":
            one.add_argument("--before", type=int, required=True, help="a load of the table")
            one.add_argument("--after", type=int, help="a later one (default: the newest)")
            one.add_argument("--rows", type=int, default=20, help="differing rows to print at most")
        if command == "compact":
            one.add_argument("--file-bytes", type=int, default=256 * 1024**2, help="bytes that a file should have")
        if command in ("compare", "compact"):
            continue
        one.add_argument("--tables", nargs="+", help="tables to move (default: all)")
        whole = "--catalog" if command == "migrate" else "--stored"
        one.add_argument(whole, action="store_true", help="any table, as the source's catalog or the warehouse has it")
        one.add_argument("--user")
        one.add_argument("--partitions", type=int, help="connections per table (default: by its rows)")
        end = one.add_mutually_exclusive_group(required=True) if command == "restore" else one
        end.add_argument("--url", required=command == "migrate", help="JDBC address of the database")
        if command == "restore":
            end.add_argument("--target-warehouse", help="restore into another warehouse instead")
            one.add_argument("--as-of", type=int, help="newest load to restore")
            one.add_argument("--no-validate", action="store_true")
    options = parser.parse_args(given)
    if options.command in ("migrate", "restore") and not (getattr(options, "catalog", False) or getattr(options, "stored", False)):
        options.tables = options.tables or names
        unknown = sorted(set(options.tables) - set(names))
        if unknown:
            parser.error(f"not one of the sales tables: {', '.join(unknown)}")
    return options


def connection(options: argparse.Namespace) -> dict[str, str]:
    account = {"user": options.user, "password": os.environ.get("ROUNDHAUL_PASSWORD")}
    return {"url": options.url} | {k: v for k, v in account.items() if v}


def sources(spark: SparkSession, options: argparse.Namespace, chosen: Sequence[Contract]) -> list[jobs.Source]:
    def reader(contract: Contract):
        return lambda: jdbc.read_table(
            spark,
            connection(options),
            options.schema,
            contract,
            split_by=contract.key[0] if contract.key else None,
            partitions=options.partitions,
        )

    return [jobs.Source(contract, reader(contract)) for contract in chosen]


def restore_target(spark: SparkSession, options: argparse.Namespace) -> Target:
    if options.target_warehouse:
        return WarehouseTarget(Warehouse(spark, options.target_warehouse, options.schema))
    return JdbcTarget(spark, connection(options), options.schema, partitions=options.partitions)


def contracts(spark: SparkSession, options: argparse.Namespace, warehouse: Warehouse) -> list[Contract]:
    """The contracts of the tables that were asked for."""
    if getattr(options, "catalog", False):
        listed = jdbc.catalog_columns(spark, connection(options))
        return jdbc.contracts_from_catalog(listed, options.schema, options.tables)
    if getattr(options, "stored", False):
        return [as_written(warehouse, name) for name in options.tables or warehouse.tables()]
    return [c for c in SALES if c.name in options.tables]


def as_written(warehouse: Warehouse, table: str) -> Contract:
    return warehouse.described(table, warehouse.require_load(table)).contract


def compare(warehouse: Warehouse, options: argparse.Namespace) -> int:
    """Print rows that two loads do not share; 0 if they share all."""
    after = warehouse.require_load(options.table, options.after)
    rows = loads.load_difference(warehouse, as_written(warehouse, options.table), options.before, after)
    found = rows.limit(options.rows).collect()
    for row in found:
        print(f"{'-' if row['only_in'] == 'source' else '+'} {row['copies']} x {row.asDict()}")
    return 1 if found else 0


def run(spark: SparkSession, options: argparse.Namespace) -> int:
    """Carry out one command; 0 if every table went through."""
    warehouse = Warehouse(spark, options.warehouse, options.schema)
    if options.command == "inventory":
        for row in warehouse.inventory().orderBy("table_name").toLocalIterator():
            print(f"{row['namespace']}.{row['table_name']}: {row['row_count']} rows")
        return 0
    if options.command == "compare":
        return compare(warehouse, options)
    if options.command == "compact":
        load = loads.compact(warehouse, as_written(warehouse, options.table), options.file_bytes)
        print(f"{options.table}: load {load.id}, {load.rows} rows" if load else f"{options.table}: nothing to compact")
        return 0
    if options.command == "migrate":
        outcomes = jobs.migrate(warehouse, sources(spark, options, contracts(spark, options, warehouse)))
    else:
        try:
            chosen = contracts(spark, options, warehouse)
            target = restore_target(spark, options)
            validate = not options.no_validate
            outcomes = jobs.restore(warehouse, chosen, target, validate=validate, as_of=options.as_of)
        except NotMigrated as problem:
            print(problem, file=sys.stderr)
            return 1
    jobs.keep_report(warehouse, outcomes)
    for o in outcomes:
        details = " ".join(part for part in (o.validation, o.error, o.note) if part)
        print(f"{o.table}: {o.status}, {o.rows} rows, {o.seconds:.2f} s {details}".rstrip())
    print(f"total: {jobs.total_rows(outcomes)} rows")
    return 0 if all(o.status in ("success", "no_data") for o in outcomes) else 1


def main() -> None:
    options = arguments()
    sys.exit(run(build_session(), options))


if __name__ == "__main__":
    main()
