"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: A word: code points other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def wrapped(docs: DataFrame) -> DataFrame:
    """Each row as one struct ``doc``, so that added columns clash with none of its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def schema_with_doc(rows: DataFrame, columns: str) -> StructType:
    """The column ``doc`` of ``rows``, followed by ``columns`` (as DDL)."""
    return StructType([rows.schema["doc"], *StructType.fromDDL(columns).fields])


def unwrapped(docs: DataFrame) -> DataFrame:
    return docs.select("doc.*")
