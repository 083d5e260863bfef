from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def audit_columns(as_of: Column | datetime.datetime | None = None) -> dict[str, Column]:
    """Ingestion date and time: the clock, or one fixed moment for repeatable builds."""
    if as_of is None:
        return {"INGESTION_DATE": F.current_date(), "INGESTION_TIME": F.current_timestamp()}
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return {"INGESTION_DATE": moment.cast("date"), "INGESTION_TIME": moment}


def try_casts(types: Mapping[str, str]) -> dict[str, Column]:
    """Casts that turn unreadable text into NULL, whatever the session's ANSI setting."""
    return {name: F.col(name).try_cast(to) for name, to in types.items()}
