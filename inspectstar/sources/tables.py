"""Parquet tables addressed by base folder and table name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inspectstar.schema import STAGE_SCHEMA


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def read_table(
    spark: SparkSession, base: str, table: str, schema: str | None = None
) -> DataFrame:
    """Scan one table, plain or partitioned.

    Give ``schema`` (DDL) where partition values must keep their type: a folder named 007
    would otherwise be discovered as a number.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(base, table))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGE_SCHEMA).parquet(path)

