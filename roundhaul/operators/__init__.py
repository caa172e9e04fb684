"""Operators over whole tables: counts, statistics, validation, audits and evolution."""
