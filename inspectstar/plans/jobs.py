"""The jobs: land staging, write the dimensions, write the two facts, or all in order."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.operators import Limits
from inspectstar.plans.dimensions import DIMENSIONS, SPECS, build_dimension
from inspectstar.plans.inspections import INSPECTION_DIMENSIONS, build_inspections
from inspectstar.plans.violations import VIOLATION_DIMENSIONS, build_violations
from inspectstar.scratch import Scratch
from inspectstar.sinks import overwrite, write_stage
from inspectstar.sources import read_records, read_stage, read_table, table_path


@dataclass(frozen=True)
class BuildOptions:
    """Settings of a build.

    ``key_type="bigint"`` is for tables past 2^31 rows; ``number_type`` is the type of the
    violation fact's own key where only that table is so long. ``concurrent_jobs`` lets small
    dimension jobs fill the cluster while the tail of another one drains.
    """

    limits: Limits = Limits()
    as_of: Column | datetime.datetime | None = None
    key_type: str = "int"
    number_type: str | None = None
    concurrent_jobs: int = len(DIMENSIONS)

    @property
    def violation_number(self) -> str:
        return self.number_type or self.key_type


def land_stage(
    spark: SparkSession,
    records_path: str,
    stage_path: str,
    partitions: int | None = None,
    arrays: bool = False,
) -> None:
    """Exported JSON records -> staging table."""
    write_stage(read_records(spark, records_path, arrays), stage_path, partitions)


def write_dimensions(
    spark: SparkSession,
    stage: DataFrame,
    base: str,
    options: BuildOptions = BuildOptions(),
    tables: Iterable[str] = tuple(SPECS),
) -> None:
    """Build and write dimensions.

    Each one scans only its own staging columns, so all nine together read about one pass
    of the table and nothing needs caching.
    """

    def write(table: str) -> None:
        spec = SPECS[table]
        with Scratch(spark) as scratch:
            df = build_dimension(stage, spec, scratch, options.as_of, options.key_type)
            overwrite(df, table_path(base, table), spec.partition_by)

    with ThreadPoolExecutor(max(1, options.concurrent_jobs)) as pool:
        target = inheritable_thread_target(spark)(write)
        for done in [pool.submit(target, table) for table in tables]:
            done.result()


_AUDIT_SCHEMA = "INGESTION_DATE date, INGESTION_TIME timestamp"


def dimension_schema(table: str, key_type: str = "int") -> str:
    """The schema of a stored dimension: no footer is read to infer it, and partition
    values keep their type."""
    spec = SPECS[table]
    types = {c: "string" for c in spec.output_columns()} | spec.casts | {spec.key: key_type}
    return ", ".join(f"{c} {t}" for c, t in types.items()) + ", " + _AUDIT_SCHEMA


def inspections_schema(key_type: str = "int") -> str:
    """The schema of the stored inspection fact, its partition column included."""
    types = {c: key_type if c.endswith("_SK") else "string" for c in names.INSPECTION_COLUMNS}
    return ", ".join(f"{c} {t}" for c, t in types.items()) + ", " + _AUDIT_SCHEMA


def violations_schema(key_type: str = "int", number_type: str | None = None) -> str:
    """The schema of the stored violation fact, its partition column included."""
    types = {c: key_type if c.endswith("_SK") else "string" for c in names.VIOLATION_COLUMNS}
    types["INSPECTION_VIOLATION_SK"] = number_type or key_type
    return ", ".join(f"{c} {t}" for c, t in types.items()) + ", " + _AUDIT_SCHEMA


def read_dimensions(
    spark: SparkSession, base: str, tables: Iterable[str], key_type: str = "int"
) -> dict[str, DataFrame]:
    return {t: read_table(spark, base, t, dimension_schema(t, key_type)) for t in tables}


def write_inspections(
    spark: SparkSession,
    stage: DataFrame,
    dimension_base: str,
    fact_base: str,
    options: BuildOptions = BuildOptions(),
) -> None:
    """Build and write the inspection fact from staging and four stored dimensions."""
    dims = read_dimensions(spark, dimension_base, INSPECTION_DIMENSIONS, options.key_type)
    with Scratch(spark) as scratch:
        fact = build_inspections(
            stage, dims, scratch, options.limits, options.as_of, options.key_type
        )
        overwrite(fact, table_path(fact_base, names.INSPECTIONS), ["BOROUGH_SK"])


def write_violations(
    spark: SparkSession,
    stage: DataFrame,
    dimension_base: str,
    fact_base: str,
    options: BuildOptions = BuildOptions(),
) -> None:
    """Build and write the violation fact from staging, five dimensions and the stored
    inspection fact, all of the same build."""
    dims = read_dimensions(spark, dimension_base, VIOLATION_DIMENSIONS, options.key_type)
    inspections = read_table(
        spark, fact_base, names.INSPECTIONS, inspections_schema(options.key_type)
    )
    with Scratch(spark) as scratch:
        fact = build_violations(
            stage, dims, inspections, scratch, options.limits, options.as_of,
            options.violation_number,
        )
        overwrite(fact, table_path(fact_base, names.VIOLATIONS), ["BOROUGH_SK"])


def build_all(
    spark: SparkSession,
    stage: DataFrame,
    dimension_base: str,
    fact_base: str,
    options: BuildOptions = BuildOptions(),
) -> None:
    """Dimensions, then inspections, then violations.

    Keys are positions in a sort and change with every rebuild, so the three always run
    together and in this order.
    """
    write_dimensions(spark, stage, dimension_base, options)
    write_inspections(spark, stage, dimension_base, fact_base, options)
    write_violations(spark, stage, dimension_base, fact_base, options)


#: Sums of a summary are taken modulo this.
SUMMARY_MODULUS = 10**15

#: Values below the modulus are summed in two parts, the lower of so many bits: as longs, which
#: hold the sums of 2 ** 38 rows.
SUMMARY_BITS = 25

#: Lengths below this are written from a list.
SUMMARY_LENGTHS = 100


def _summary(df: DataFrame, table: str) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    keys = [c for c in df.columns if c.endswith("_SK")]
    texts = [c for c, kind in kinds.items() if kind == "string"]

    def total(values: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, values, F.lit(0).cast("long"))

    def rest(name: str) -> Column:
        value = F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))
        return value % SUMMARY_MODULUS if kinds[name] == "bigint" else value

    lengths = F.array(*[F.lit(f"{n}:") for n in range(SUMMARY_LENGTHS)])

    def entry(name: str) -> list[Column]:
        """A value behind its length, so that no two rows read alike; null is a dash."""
        text = F.col(name).cast("string")
        size = F.octet_length(text)
        listed = F.when(size < SUMMARY_LENGTHS, F.get(lengths, size))
        length = listed.otherwise(F.concat(size.cast("string"), F.lit(":")))
        return [F.coalesce(length, F.lit("-")), F.coalesce(text, F.lit(""))]

    entries = [part for c in sorted(keys + texts) for part in entry(c)]
    digest = F.conv(F.substring(F.md5(F.concat(*entries)), 1, 12), 16, 10)
    size = total([F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in texts])
    rows = df.select(
        (total([rest(c) for c in keys]) % SUMMARY_MODULUS).alias("key"),
        rest(keys[0]).alias("own"),
        size.alias("size"),
        digest.cast("long").alias("row"),
    )

    def parts(value: Column) -> tuple[Column, Column]:
        return F.shiftright(value, SUMMARY_BITS), value.bitwiseAND((1 << SUMMARY_BITS) - 1)

    high, low = (part * F.col("size") % SUMMARY_MODULUS for part in parts(F.col("own")))
    summed = {"key": F.col("key"), "high": high, "low": low, "row": F.col("row")}
    sums = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[
            F.sum(part).alias(f"{name}_{i}")
            for name, value in summed.items()
            for i, part in enumerate(parts(value))
        ],
    )

    def whole(name: str) -> Column:
        high, low = (
            F.coalesce(F.col(f"{name}_{i}"), F.lit(0)).cast("decimal(38,0)") for i in range(2)
        )
        return (high * (1 << SUMMARY_BITS) + low) % SUMMARY_MODULUS

    own = (whole("high") * (1 << SUMMARY_BITS) + whole("low")) % SUMMARY_MODULUS
    return sums.select(
        F.lit(table).alias("table_name"),
        "row_count",
        whole("key").cast("long").alias("key_sum"),
        own.cast("long").alias("key_text_sum"),
        whole("row").cast("long").alias("row_sum"),
    )


def table_summaries(spark: SparkSession, schemas: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per stored table (name -> base folder, schema): rows, and what they hold.

    ``key_sum`` adds up all keys; ``key_text_sum`` ties the first key of each row to the
    length of its texts; ``row_sum`` adds up 48 bits of the md5 of each row's keys and texts, so
    it does not depend on the order of rows, yet on every value and on what stands beside it.
    """
    summaries = [
        _summary(read_table(spark, base, table, schema), table)
        for table, (base, schema) in schemas.items()
    ]
    return reduce(DataFrame.unionAll, summaries)


def stored_schemas(
    dimension_base: str,
    fact_base: str | None = None,
    key_type: str = "int",
    number_type: str | None = None,
) -> dict[str, tuple[str, str]]:
    """Base folder and schema of the tables of a build; without ``fact_base`` the dimensions."""
    tables = {t: (dimension_base, dimension_schema(t, key_type)) for t in SPECS}
    if fact_base is not None:
        tables[names.INSPECTIONS] = (fact_base, inspections_schema(key_type))
        tables[names.VIOLATIONS] = (fact_base, violations_schema(key_type, number_type))
    return tables


def run(
    spark: SparkSession,
    records_path: str,
    stage_path: str,
    dimension_base: str,
    fact_base: str,
    options: BuildOptions = BuildOptions(),
    partitions: int | None = None,
) -> DataFrame:
    """Everything from exported records to facts; returns a summary of each table."""
    land_stage(spark, records_path, stage_path, partitions)
    build_all(spark, read_stage(spark, stage_path), dimension_base, fact_base, options)
    schemas = stored_schemas(
        dimension_base, fact_base, options.key_type, options.number_type
    )
    return table_summaries(spark, schemas)
