"""Move relational tables into a partitioned Parquet warehouse and back, and prove nothing was lost."""
