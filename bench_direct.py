"""The same build stated directly, for comparison with bench.py.

Lookups join all columns and fan out, duplicates are grouped away afterwards, and keys come
from one global ``row_number``. Same output tables, same driver settings; no lookup, numbering
or skew operator of the package is used. Prints one JSON line with the fastest pass of each step.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.functions import audit_columns, first_non_null, first_row, try_casts
from inspectstar.plans.dimensions import DIMENSIONS, SPECS, DimensionSpec
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.plans.inspections import INSPECTION_GRAIN
from inspectstar.plans.jobs import dimension_schema, inspections_schema
from inspectstar.sources import read_stage


def numbered(df: DataFrame, order: list[str], key: str) -> DataFrame:
    window = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(key, F.row_number().over(window)).withColumns(audit_columns())


def dimension(stage: DataFrame, spec: DimensionSpec) -> DataFrame:
    picks = [first_non_null(c).alias(c) for c in spec.value_attributes]
    if spec.row_attributes:
        picks.append(first_row(list(spec.row_attributes)).alias("row"))
    grouped = stage.groupBy(*spec.grain)
    rows = grouped.agg(*picks) if picks else stage.select(*spec.grain).distinct()
    if spec.row_attributes:
        rows = rows.select("*", "row.*").drop("row")
    if spec.drop_null_grain:
        rows = rows.where(F.col("camis").isNotNull())
    rows = rows.withColumnsRenamed({**spec.grain, **spec.row_attributes, **spec.value_attributes})
    return numbered(rows.withColumns(try_casts(spec.casts)), list(spec.grain.values()), spec.key)


def joined(rows: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    other = other.withColumnsRenamed({c: f"other_{c}" for c in on.values()})
    matches = (F.col(a).eqNullSafe(F.col(f"other_{b}")) for a, b in on.items())
    return rows.join(other, reduce(and_, matches))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="inspectstar-direct-")
    passes: dict[str, list[float]] = {}

    def write(df: DataFrame, table: str, *by: str) -> None:
        start = time.perf_counter()
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{table}")
        passes.setdefault(table, []).append(time.perf_counter() - start)

    def dim(table: str, *columns: str) -> DataFrame:
        reader = spark.read.schema(dimension_schema(table))
        return reader.parquet(f"{root}/{table}").select(SPECS[table].key, *columns)

    def members(table: str) -> tuple[DataFrame, dict[str, str]]:
        return dim(table, *SPECS[table].grain.values()), dict(SPECS[table].grain)

    for _ in range(int(os.environ.get("BENCH_PASSES", "3"))):
        write(derive_stage(spark, sf_dir), "stage")
        stage = read_stage(spark, f"{root}/stage")
        for spec in DIMENSIONS:
            write(dimension(stage, spec), spec.table, *spec.partition_by)

        rows = joined(stage, *members(names.FOOD_PLACES))
        rows = joined(rows, *members(names.BOROUGH))
        address = {"bin": "BIN", "bbl": "BBL", "zipcode": "ZIPCODE"}
        rows = joined(rows, dim(names.ADDRESSES, *address.values()), address)
        rows = joined(rows, *members(names.CUISINE))
        keys = ["FOOD_PLACES_SK", "BOROUGH_SK", "CUISINE_DESCRIPTION_SK", "ADDRESS_SK"]
        rows = rows.groupBy(*INSPECTION_GRAIN).agg(*[F.min(k).alias(k) for k in keys])
        rows = rows.withColumnsRenamed({"inspection_date": "INSCPECTION_DATE", "phone": "PHONE"})
        order = [*keys[:1], "INSCPECTION_DATE", *keys[1:3], "PHONE", "ADDRESS_SK"]
        fact = numbered(rows, order, "INSPECTION_SK")
        columns = [*names.INSPECTION_COLUMNS, *names.AUDIT_COLUMNS]
        write(fact.select(*columns), names.INSPECTIONS, "BOROUGH_SK")

        visits = spark.read.schema(inspections_schema()).parquet(f"{root}/{names.INSPECTIONS}")
        visits = visits.select(*names.INSPECTION_COLUMNS).withColumnRenamed("PHONE", "VISIT_PHONE")
        rows = stage
        sks = []
        for table in (
            names.ACTIONS,
            names.CRITICAL_FLAG,
            names.GRADES,
            names.INSPECTION_TYPE,
            names.VIOLATION_CODES,
        ):
            rows = joined(rows, *members(table))
            sks.append(SPECS[table].key)
        met = joined(rows, visits, {"inspection_date": "INSCPECTION_DATE", "phone": "VISIT_PHONE"})
        met = met.withColumnsRenamed(
            {"other_INSCPECTION_DATE": "INSCPECTION_DATE", "other_VISIT_PHONE": "VISIT_PHONE"}
        )
        grain = ["BOROUGH_SK", "INSPECTION_SK", "VISIT_PHONE", *sks]
        carried = ["INSCPECTION_DATE", "FOOD_PLACES_SK", "ADDRESS_SK", "CUISINE_DESCRIPTION_SK"]
        fact = met.groupBy(*grain).agg(
            *[F.min(c).alias(c) for c in carried],
            first_row(["score", "grade_date", "action"]).alias("row"),
        )
        fact = numbered(fact, ["BOROUGH_SK", "INSPECTION_SK", *sks], "INSPECTION_VIOLATION_SK")
        fact = fact.select("*", "row.*").withColumnRenamed("VISIT_PHONE", "PHONE")
        columns = [*names.VIOLATION_COLUMNS, *names.AUDIT_COLUMNS]
        write(fact.select(*columns), names.VIOLATIONS, "BOROUGH_SK")

    seconds = {name: round(min(times), 3) for name, times in passes.items()}
    total = round(sum(seconds.values()), 3)
    rows_written = spark.read.parquet(f"{root}/{names.VIOLATIONS}").count()
    spark.stop()
    print(json.dumps({"value": total, "unit": "sec", "queries": seconds, "rows": rows_written}))


if __name__ == "__main__":
    main()
