"""Where rows come from and go to: Parquet warehouses and relational databases."""

from roundhaul.sources.warehouse import Load, NotMigrated, Warehouse, read_directory

__all__ = ["Load", "NotMigrated", "Warehouse", "read_directory"]
