"""Where a restore goes. A target takes rows under a table's name and gives them back."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType

from roundhaul.contracts import Contract
from roundhaul.functions.convert import export_form
from roundhaul.sources import jdbc
from roundhaul.sources.warehouse import Warehouse


class Target(Protocol):
    def write(self, df: DataFrame, contract: Contract, create: bool) -> None: ...

    def read(self, contract: Contract) -> DataFrame: ...


class RangeTarget(Target, Protocol):
    """A target that can be filled bit by bit: ``append`` adds rows, and creates the table where it is missing."""

    def append(self, df: DataFrame, contract: Contract) -> None: ...


class WarehouseTarget:
    """Restores into ``<table>_backload`` of a second warehouse, unpartitioned like a database table.

    Spark's committer publishes a table only when all of its tasks are done, so a lost
    executor neither repeats nor loses rows.
    """

    def __init__(self, warehouse: Warehouse, suffix: str = jdbc.SUFFIX):
        self.warehouse = warehouse
        self.suffix = suffix

    def _restored(self, contract: Contract) -> Contract:
        return replace(contract, name=contract.name + self.suffix, partitions=())

    def write(self, df: DataFrame, contract: Contract, create: bool) -> None:
        restored = self._restored(contract)
        if not create and not self.warehouse.loads(restored.name):
            raise LookupError(f"{restored.name} does not exist and may not be created")
        self.warehouse.write(export_form(df), restored)

    def append(self, df: DataFrame, contract: Contract) -> None:
        self.warehouse.append(export_form(df), self._restored(contract))

    def read(self, contract: Contract) -> DataFrame:
        return self.warehouse.read(self._restored(contract))


class JdbcTarget:
    """Restores into ``<table>_backload`` of a relational database."""

    def __init__(
        self,
        spark: SparkSession,
        connection: Mapping[str, str],
        schema: str = "sales",
        suffix: str = jdbc.SUFFIX,
        partitions: int | None = None,
    ):
        self.spark = spark
        self.connection = connection
        self.schema = schema
        self.suffix = suffix
        self.partitions = partitions

    def write(self, df: DataFrame, contract: Contract, create: bool) -> None:
        jdbc.export_table(
            df,
            self.connection,
            self.schema,
            contract,
            suffix=self.suffix,
            create=create,
            partitions=self.partitions,
        )

    def append(self, df: DataFrame, contract: Contract) -> None:
        jdbc.append_table(df, self.connection, self.schema, contract, suffix=self.suffix, partitions=self.partitions)

    def read(self, contract: Contract) -> DataFrame:
        numeric = [c.name for c in contract.columns if isinstance(c.type, (IntegerType, LongType))]
        split_by = contract.key[0] if len(contract.key) == 1 and contract.key[0] in numeric else None
        restored = replace(contract, name=contract.name + self.suffix)
        return jdbc.read_table(
            self.spark, self.connection, self.schema, restored, split_by=split_by, partitions=self.partitions
        )
