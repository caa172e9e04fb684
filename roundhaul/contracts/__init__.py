"""Table contracts: declared columns, keys, constraints and partition layout."""

from roundhaul.contracts.sqltypes import SqlType, restored_type, sql_type_for
from roundhaul.contracts.table import Column, Contract, ForeignKey, Partition, named

__all__ = [
    "Column",
    "Contract",
    "ForeignKey",
    "Partition",
    "SqlType",
    "named",
    "restored_type",
    "sql_type_for",
]
