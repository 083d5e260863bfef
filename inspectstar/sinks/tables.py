"""Parquet outputs. Every write replaces the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, laid out in folders by ``partition_by`` if given.

    No shuffle is added: facts are written straight from the tasks that compute them.
    NULL and "" share one partition folder and both read back as NULL.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


#: Records of one compressed file, which one task reads.
RECORDS_PER_FILE = 500_000


def write_records(df: DataFrame, path: str) -> None:
    """Export rows as JSON records, one a line, in gzipped files.

    Names repeat in every record, so plain files take some ten times the space. A gzipped file
    cannot be split between tasks: its records are bounded, and a larger table has more files.
    """
    writer = df.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.json(path)


def write_stage(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Land staging rows; ``partitions`` spreads them over that many files, visit by visit.

    Rows of one visit say mostly the same: next to each other they take a fraction of the space, in
    the shuffle and in the files. Rows without a place or a date, which may be many, are dealt
    one by one, all by a hash of their values.
    Without ``partitions`` the input splits are kept and nothing is shuffled, which is what a large
    load wants.
    """
    overwrite(df if partitions is None else _dealt(df, partitions), path)


def _dealt(df: DataFrame, partitions: int) -> DataFrame:
    visit = [F.col("camis"), F.col("inspection_date")]
    known = visit[0].isNotNull() & visit[1].isNotNull()
    deal = F.when(known, F.xxhash64(*visit)).otherwise(F.xxhash64(*df.columns))
    return df.repartition(partitions, deal)
