"""Retail order analytics on PySpark: reports, audits and reconciliations."""

from orderlens.session import configure, release, size_shuffles
from orderlens.sources import RetailTables, load_files, load_tables

__all__ = ["RetailTables", "configure", "load_files", "load_tables", "release", "size_shuffles"]
