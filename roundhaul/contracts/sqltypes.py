"""Relational type names, the Spark types that hold them, and the types they are restored to."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import types as T

log = logging.getLogger(__name__)

# How each relational type name is held in Spark. Small integers are
# stored as int; `time` has no default Spark type and is kept as text.
STORED = {
    "bit": T.BooleanType(),
    "tinyint": T.IntegerType(),
    "smallint": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "date": T.DateType(),
    "time": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "nchar": T.StringType(),
    "nvarchar": T.StringType(),
    "text": T.StringType(),
    "ntext": T.StringType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "image": T.BinaryType(),
    "uniqueidentifier": T.StringType(),
}

# Precision and scale of a decimal declared without them.
DEFAULT_DECIMAL = (38, 18)


# The smallest and largest value of types that are held in a wider one.
RANGES = {"tinyint": (0, 255), "smallint": (-32768, 32767)}


@dataclass(frozen=True)
class SqlType:
    """A relational type as the source catalog reports it."""

    name: str
    precision: int | None = None
    scale: int | None = None

    @classmethod
    def parse(cls, text: str) -> SqlType:
        """Read a declaration such as ``decimal(19,4)``, ``datetime2(7)`` or ``nvarchar(max)``."""
        found = re.fullmatch(r"\s*(\w+)\s*(?:\(\s*(\w+)\s*(?:,\s*(\d+)\s*)?\))?\s*", text)
        if not found:
            raise ValueError(f"not a type declaration: {text!r}")
        name, first, second = found.groups()
        precision = int(first) if first and first.isdigit() else None
        return cls(name.lower(), precision, int(second) if second else None)

    @property
    def is_decimal(self) -> bool:
        return self.name in ("decimal", "numeric")

    @property
    def fraction_digits(self) -> int:
        """Digits kept after the second; an undeclared precision means all seven."""
        return 7 if self.precision is None else self.precision

    @property
    def range(self) -> tuple[int, int] | None:
        """The declared bounds, where the type that holds the values has wider ones."""
        return RANGES.get(self.name)

    def stored(self) -> T.DataType:
        """The Spark type that holds this type in the warehouse."""
        if self.is_decimal:
            if self.precision and self.scale is not None:
                return T.DecimalType(self.precision, self.scale)
            return T.DecimalType(*DEFAULT_DECIMAL)
        if self.name not in STORED:
            log.warning("type %s is not known, stored as text", self.name)
            return T.StringType()
        return STORED[self.name]


def restored_type(declared: SqlType, wide_text: bool = True) -> str:
    """The relational type a declared column gets when it is restored."""
    if declared.name in ("tinyint", "smallint"):
        return declared.name.upper()
    if declared.name == "datetime":
        return "DATETIME2(3)"
    if declared.name == "datetime2":
        digits = declared.fraction_digits
        return f"DATETIME2({3 if digits <= 3 else 6 if digits <= 6 else 7})"
    if declared.name == "time":
        return "TIME(7)" if declared.fraction_digits > 6 else "TIME"
    return sql_type_for(declared.stored(), wide_text)


def sql_type_for(held: T.DataType, wide_text: bool = True) -> str:
    """The relational type for a Spark column whose declaration is not known."""
    text = "NVARCHAR(MAX)" if wide_text else "VARCHAR(MAX)"
    if isinstance(held, T.DecimalType):
        if (held.precision, held.scale) == (19, 4):
            return "MONEY"
        if (held.precision, held.scale) == (10, 4):
            return "SMALLMONEY"
        return f"DECIMAL({held.precision},{held.scale})"
    # The restored name of each remaining Spark type.
    names = {
        T.BooleanType: "BIT",
        T.ByteType: "TINYINT",
        T.ShortType: "SMALLINT",
        T.IntegerType: "INT",
        T.LongType: "BIGINT",
        T.FloatType: "REAL",
        T.DoubleType: "FLOAT",
        T.StringType: text,
        T.BinaryType: "VARBINARY(MAX)",
        T.DateType: "DATE",
        T.TimestampNTZType: "DATETIME2(6)",
        T.TimestampType: "DATETIMEOFFSET",
        T.TimeType: "TIME",
    }
    name = names.get(type(held))
    if name is None:
        log.warning("no relational type for %s, restored as text", held.simpleString())
        return "NVARCHAR(MAX)"
    return name
