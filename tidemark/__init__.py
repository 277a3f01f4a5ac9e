"""Market time-series warehouse and quality engine built on Spark DataFrames."""

from tidemark.specs import AuditConfig, TABLES, TableSpec, table_spec

__all__ = ["AuditConfig", "TABLES", "TableSpec", "table_spec"]
