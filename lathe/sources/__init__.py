"""Readers and writers: test tables, CSV/Parquet files, models."""

from lathe.sources.tables import ORDER_ROLES, order_features, read_table

__all__ = ["ORDER_ROLES", "order_features", "read_table"]
