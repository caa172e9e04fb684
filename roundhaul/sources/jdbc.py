"""Relational databases over JDBC: typed extraction and restore.

The driver jar comes from the user (``spark.jars``). Statements that change the target's
schema run as the session-initialisation statement of a one-row read, so they go through
the same connection settings as the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from roundhaul.contracts import Column, Contract, SqlType
from roundhaul.contracts.sqltypes import STORED
from roundhaul.functions.convert import conform, export_form

FETCH_ROWS = 10_000
#: Rows that one task reads over its connection, where nothing else is asked for.
PARTITION_ROWS = 1_000_000
# Rows per insert batch and the ending of restored table names.
BATCH_ROWS = 1000
SUFFIX = "_backload"

Connection = Mapping[str, str]


def quoted(*parts: str) -> str:
    return ".".join("[" + part.replace("]", "]]") + "]" for part in parts)


def _read(spark: SparkSession, connection: Connection, **options: object) -> DataFrame:
    reader = spark.read.format("jdbc").options(**connection)
    return reader.options(fetchsize=FETCH_ROWS, preferTimestampNTZ=True, **options).load()


def column_metadata(spark: SparkSession, connection: Connection, schema: str, table: str) -> DataFrame:
    """Name, type, precision, scale, nullability and position of each column, in order."""
    return metadata_rows(catalog_columns(spark, connection), schema, table)


def catalog_columns(spark: SparkSession, connection: Connection) -> DataFrame:
    """The columns of all tables, as the database's catalog lists them."""
    return _read(spark, connection, dbtable="INFORMATION_SCHEMA.COLUMNS")


def metadata_rows(listed: DataFrame, schema: str, table: str) -> DataFrame:
    chosen = listed.where((F.col("TABLE_SCHEMA") == schema) & (F.col("TABLE_NAME") == table))
    return chosen.select(
        F.col("COLUMN_NAME").alias("name"),
        F.col("DATA_TYPE").alias("type"),
        F.coalesce("NUMERIC_PRECISION", "DATETIME_PRECISION").cast("int").alias("precision"),
        F.col("NUMERIC_SCALE").cast("int").alias("scale"),
        F.when(F.col("IS_NULLABLE") == "YES", 1).otherwise(0).alias("nullable"),
        F.col("ORDINAL_POSITION").cast("int").alias("position"),
    ).orderBy("position")


def contract_from_metadata(
    name: str, metadata: DataFrame, *, key: Iterable[str] = (), partition_by: Iterable[str] = ()
) -> Contract:
    """A contract from ``column_metadata``; one row per column, so small enough to collect."""
    columns = []
    for row in metadata.collect():
        declared = SqlType(row["type"].lower(), row["precision"], row["scale"])
        columns.append(Column(row["name"], declared.stored(), bool(row["nullable"]), declared))
    return Contract(name, tuple(columns), tuple(key)).partitioned_by(*partition_by)


def contracts_from_catalog(listed: DataFrame, schema: str, tables: Iterable[str] | None = None) -> list[Contract]:
    """A contract for each table of a schema (or each of the given ones), by name, from rows of
    ``INFORMATION_SCHEMA.COLUMNS``; a given table that is not listed raises."""
    of_schema = listed.where(F.col("TABLE_SCHEMA") == schema)
    held = sorted(row[0] for row in of_schema.select("TABLE_NAME").distinct().collect())
    wanted = held if tables is None else list(tables)
    missing = [name for name in wanted if name not in held]
    if missing:
        raise LookupError(f"{schema} has no tables {missing}")
    return [contract_from_metadata(name, metadata_rows(listed, schema, name)) for name in wanted]


def partitions_for(rows: int, partition_rows: int = PARTITION_ROWS) -> int:
    """How many tasks read a table of that many rows."""
    return max(1, -(-rows // partition_rows))


def range_splits(low: int, high: int, column: str, partitions: int) -> dict[str, object]:
    """Options for reading a numeric key range in parallel; the bounds only place the splits."""
    return {
        "partitionColumn": column,
        "lowerBound": low,
        "upperBound": max(high, low + 1),
        "numPartitions": partitions,
    }


def hash_splits(columns: Iterable[str], partitions: int) -> list[str]:
    """Conditions that deal the rows out by a hash the database takes over ``columns``.

    Each condition makes the database look at the whole table, so a range of an indexed key
    is the better split where there is one.
    """
    hashed = f"ABS(CAST(BINARY_CHECKSUM({', '.join(quoted(c) for c in columns)}) AS BIGINT))"
    return [f"{hashed} % {partitions} = {part}" for part in range(partitions)]


def read_as_text(contract: Contract) -> dict[str, str]:
    """Columns the driver should hand over as text: times of day and types not in the type map.

    Left alone, a time of day would arrive as a timestamp on the first of January 1970.
    """
    kept = [c for c in contract.columns if c.declared and c.type == StringType()]
    names = [c.name for c in kept if c.declared.name == "time" or c.declared.name not in STORED]
    escaped = [name.replace("`", "``") for name in names]
    return {"customSchema": ", ".join(f"`{name}` STRING" for name in escaped)} if names else {}


def read_table(
    spark: SparkSession,
    connection: Connection,
    schema: str,
    contract: Contract,
    *,
    split_by: str | None = None,
    partitions: int | None = None,
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """A whole table, converted to its contract, read by ``partitions`` tasks with a connection each.

    Left out, their number follows from the table's rows, ``partition_rows`` to a task; how many
    run at once is up to the session's cores. ``split_by`` must be a numeric column that is
    spread evenly, normally the identity key; rows outside the bounds still belong to the first
    or last split. Without it, or where it is NULL throughout, the rows are dealt out by a hash
    of the key, so that no task reads the whole table.
    """
    table = quoted(schema, contract.name)
    as_text = read_as_text(contract)
    ends = f", MIN({quoted(split_by)}) AS low, MAX({quoted(split_by)}) AS high" if split_by else ""
    if split_by is not None or partitions is None:
        found = _read(spark, connection, query=f"SELECT COUNT_BIG(*) AS n{ends} FROM {table}").first()
        partitions = partitions or partitions_for(found["n"], partition_rows)
        if split_by is not None and found["low"] is not None:
            splits = range_splits(int(found["low"]), int(found["high"]), split_by, partitions)
            return conform(_read(spark, connection, dbtable=table, **as_text, **splits), contract)
    settings = {"fetchsize": str(FETCH_ROWS), "preferTimestampNTZ": "true"} | as_text
    properties = {k: v for k, v in connection.items() if k != "url"} | settings
    conditions = hash_splits(contract.key or contract.names, partitions)
    rows = spark.read.jdbc(connection["url"], table, predicates=conditions, properties=properties)
    return conform(rows, contract)


def create_table_sql(schema: str, table: str, contract: Contract, wide_text: bool = True) -> str:
    """Statements that drop the target if it exists and create it with its restored types."""
    target = quoted(schema, table)
    lines = [
        f"    {quoted(c.name)} {c.restored(wide_text)} {'NULL' if c.nullable else 'NOT NULL'}"
        for c in contract.columns
    ]
    body = ",\n".join(lines)
    return f"DROP TABLE IF EXISTS {target};\nCREATE TABLE {target} (\n{body}\n);"


def run_statement(spark: SparkSession, connection: Connection, statement: str) -> None:
    _read(spark, connection, query="SELECT 1 AS done", sessionInitStatement=statement).collect()


def export_table(
    df: DataFrame,
    connection: Connection,
    schema: str,
    contract: Contract,
    *,
    suffix: str = SUFFIX,
    create: bool = True,
    partitions: int | None = None,
) -> None:
    """Restore a table as ``<table><suffix>``.

    Spark commits each partition by itself, so a run that dies half-way, or a task that is
    retried after its commit, can leave too few or too many rows. Every run therefore
    starts from an empty target, and the caller compares contents afterwards. ``partitions``
    bounds the connections by merging the partitions of the scan too; left out, every task of
    the scan has its own.
    """
    table = contract.name + suffix
    if not create and column_metadata(df.sparkSession, connection, schema, table).isEmpty():
        raise LookupError(f"{schema}.{table} does not exist and may not be created")
    if create:
        run_statement(df.sparkSession, connection, create_table_sql(schema, table, contract))
    options: dict[str, object] = {"dbtable": quoted(schema, table), "batchsize": BATCH_ROWS, "truncate": True}
    if partitions:
        options["numPartitions"] = partitions
    export_form(df, times_as_text=True).write.format("jdbc").options(**connection).options(**options).mode("overwrite").save()


def append_table(
    df: DataFrame,
    connection: Connection,
    schema: str,
    contract: Contract,
    *,
    suffix: str = SUFFIX,
    partitions: int | None = None,
) -> None:
    """Add rows to ``<table><suffix>``, which is created where it is missing.

    Like `export_table` a run that dies half-way leaves the partitions that were committed.
    """
    table = contract.name + suffix
    if column_metadata(df.sparkSession, connection, schema, table).isEmpty():
        run_statement(df.sparkSession, connection, create_table_sql(schema, table, contract))
    options: dict[str, object] = {"dbtable": quoted(schema, table), "batchsize": BATCH_ROWS}
    if partitions:
        options["numPartitions"] = partitions
    export_form(df, times_as_text=True).write.format("jdbc").options(**connection).options(**options).mode("append").save()
