"""What a table must look like: columns, keys, constraints and partition layout."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts.sqltypes import SqlType, restored_type, sql_type_for

# Values Spark cannot tell apart from NULL in a directory name, and the mark put before them.
_HIDDEN_BY_SPARK = ("", "__HIVE_DEFAULT_PARTITION__")
_MARK = "~"


def named(name: str) -> Col:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = True
    declared: SqlType | None = None

    def restored(self, wide_text: bool = True) -> str:
        if self.declared is None:
            return sql_type_for(self.type, wide_text)
        return restored_type(self.declared, wide_text)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Partition:
    """One level of the directory layout: the raw value of a column, or its calendar day."""

    column: str
    by_day: bool = False

    @property
    def key(self) -> str:
        return f"{self.column}_day" if self.by_day else self.column


@dataclass(frozen=True)
class Contract:
    """A table's declared shape.

    ``schema`` is nullable throughout because Parquet reads always are; the NOT NULL
    columns are kept in ``required`` and audited on the data instead.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    partitions: tuple[Partition, ...] = ()

    @classmethod
    def declare(
        cls,
        name: str,
        declarations: Mapping[str, str],
        *,
        key: Iterable[str] = (),
        unique: Iterable[Iterable[str]] = (),
        foreign_keys: Iterable[ForeignKey] = (),
        partition_by: Iterable[str] = (),
    ) -> Contract:
        """Build a contract from ``{column: "decimal(19,4) not null"}`` declarations."""
        columns = []
        for column, text in declarations.items():
            required = text.lower().endswith(" not null")
            declared = SqlType.parse(text[: -len(" not null")] if required else text)
            columns.append(Column(column, declared.stored(), not required, declared))
        return cls(
            name,
            tuple(columns),
            tuple(key),
            tuple(tuple(group) for group in unique),
            tuple(foreign_keys),
        ).partitioned_by(*partition_by)

    @classmethod
    def of(cls, name: str, df: DataFrame, *, key: Iterable[str] = (), partition_by: Iterable[str] = ()) -> Contract:
        """Take the contract from a DataFrame that already has the wanted types."""
        columns = tuple(Column(f.name, f.dataType) for f in df.schema.fields)
        return cls(name, columns, tuple(key)).partitioned_by(*partition_by)

    def layout(self) -> dict[str, object]:
        """What is needed to read files of this shape again, as plain values; `from_layout` undoes it."""
        columns = [
            {
                "name": c.name,
                "type": c.type.jsonValue(),
                "nullable": c.nullable,
                "declared": c.declared and [c.declared.name, c.declared.precision, c.declared.scale],
            }
            for c in self.columns
        ]
        partitions = [{"column": p.column, "by_day": p.by_day} for p in self.partitions]
        return {"name": self.name, "columns": columns, "key": list(self.key), "partitions": partitions}

    @classmethod
    def from_layout(cls, held: Mapping) -> Contract:
        columns = []
        for c in held["columns"]:
            kind = T.StructType.fromJson({"fields": [{"name": c["name"], "type": c["type"], "nullable": True, "metadata": {}}]})
            declared = SqlType(*c["declared"]) if c["declared"] else None
            columns.append(Column(c["name"], kind[0].dataType, c["nullable"], declared))
        partitions = tuple(Partition(p["column"], p["by_day"]) for p in held["partitions"])
        return cls(held["name"], tuple(columns), tuple(held["key"]), partitions=partitions)

    def with_native_times(self) -> Contract:
        """Hold columns declared ``time`` in Spark's type for times of day instead of text.

        It keeps microseconds; a value with a digit beyond them stops the load. The session must have the type
        switched on (``session.allow_times``).
        """
        columns = [
            replace(c, type=T.TimeType(6)) if c.declared is not None and c.declared.name == "time" else c for c in self.columns
        ]
        return replace(self, columns=tuple(columns)).partitioned_by(*[p.column for p in self.partitions])

    def partitioned_by(self, *names: str) -> Contract:
        """Partition dates and timestamps by calendar day and everything else by raw value."""
        types = {c.name: c.type for c in self.columns}
        levels = []
        for name in names:
            if name not in types:
                raise ValueError(f"{self.name} has no column {name} to partition by")
            if isinstance(types[name], T.BinaryType):
                raise ValueError(f"{name} is binary and cannot name a directory")
            if isinstance(types[name], T.TimeType):
                raise ValueError(f"{name} is a time of day and cannot name a directory; keep it as text")
            by_day = isinstance(types[name], (T.DateType, T.TimestampType, T.TimestampNTZType))
            levels.append(Partition(name, by_day))
        taken = {c.name for c in self.columns}
        clash = [p.key for p in levels if p.by_day and p.key in taken]
        if clash:
            raise ValueError(f"{self.name} already has a column named {clash[0]}")
        return replace(self, partitions=tuple(levels))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def shortened(self) -> list[str]:
        """Timestamps declared with more digits than the microseconds Spark keeps."""
        kinds = (T.TimestampType, T.TimestampNTZType)
        timed = [c for c in self.columns if c.declared and isinstance(c.type, kinds)]
        return [c.name for c in timed if c.declared.name != "datetime" and c.declared.fraction_digits > 6]

    @property
    def stored_schema(self) -> T.StructType:
        """The schema with directory keys included, so that Spark never guesses their types."""
        days = [T.StructField(p.key, T.DateType()) for p in self.partitions if p.by_day]
        return T.StructType(self.schema.fields + days)

    def column(self, name: str) -> Column:
        for column in self.columns:
            if column.name == name:
                return column
        raise KeyError(f"{self.name} has no column {name}")

    def day_of(self, name: str, value: Col | None = None) -> Col:
        """The calendar day of a column, or of a value of that column's type.

        Instants count in UTC whatever the session's zone.
        """
        value = named(name) if value is None else value
        if isinstance(self.column(name).type, T.TimestampType):
            return F.date_from_unix_date(F.floor(F.unix_seconds(value) / 86400).cast("int"))
        return F.to_date(value)

    def _text_keys(self) -> set[str]:
        plain = [p.column for p in self.partitions if not p.by_day]
        return {name for name in plain if isinstance(self.column(name).type, T.StringType)}

    def to_stored(self, df: DataFrame) -> DataFrame:
        """Add the directory keys to rows that follow the contract."""
        marked = self._text_keys()
        columns = []
        for name in self.names:
            value = named(name)
            if name in marked:
                clashes = value.isin(*_HIDDEN_BY_SPARK) | value.startswith(_MARK)
                value = F.when(clashes, F.concat(F.lit(_MARK), value)).otherwise(value).alias(name)
            columns.append(value)
        days = [self.day_of(p.column).alias(p.key) for p in self.partitions if p.by_day]
        return df.select(*columns, *days)

    def stored_values(self) -> list[Col]:
        """The contract's columns as they were before ``to_stored``, taken from stored rows."""
        marked = self._text_keys()
        columns = []
        for name in self.names:
            value = named(name)
            if name in marked:
                unmarked = F.substring(value, len(_MARK) + 1, 2**31 - 1)
                value = F.when(value.startswith(_MARK), unmarked).otherwise(value).alias(name)
            columns.append(value)
        return columns

    def from_stored(self, df: DataFrame) -> DataFrame:
        """Undo ``to_stored``: contract columns in contract order, original values."""
        return df.select(*self.stored_values())
