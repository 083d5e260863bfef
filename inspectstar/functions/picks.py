"""Repeatable stand-ins for "whichever value comes first" in a group.

Both are plain ``min`` aggregates, so each task combines its own rows before the shuffle
and a group holding most of the table arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_row(columns: Sequence[str]) -> Column:
    """One row of the group supplies all ``columns``: the smallest tuple, NULLs first."""
    return F.min(F.struct(*columns))


def first_non_null(column: str) -> Column:
    """The smallest value present; NULL only if the group has none."""
    return F.min(column)
