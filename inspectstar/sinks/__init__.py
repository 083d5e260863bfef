"""Writers: whole-table Parquet overwrite, partitioned overwrite, staging, JSON records."""

from inspectstar.sinks.tables import overwrite, write_records, write_stage

__all__ = ["overwrite", "write_records", "write_stage"]
