"""Column helpers: audit columns, tolerant casts, deterministic picks."""

from inspectstar.functions.columns import audit_columns, try_casts
from inspectstar.functions.picks import first_non_null, first_row

__all__ = ["audit_columns", "first_non_null", "first_row", "try_casts"]
