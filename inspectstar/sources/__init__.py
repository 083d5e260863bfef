"""Readers: record files, record columns, Parquet tables, delimited text."""

from inspectstar.sources.records import frame_of, parse_records, read_records
from inspectstar.sources.tables import read_stage, read_table, table_path
from inspectstar.sources.text import read_fields

__all__ = [
    "frame_of",
    "parse_records",
    "read_fields",
    "read_records",
    "read_stage",
    "read_table",
    "table_path",
]
