"""Source tables."""

from orderlens.sources.tables import RetailTables, load_files, load_tables

__all__ = ["RetailTables", "load_files", "load_tables"]
