"""One runnable query per operator, all over the driver's star tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.functions import audit_columns, first_non_null, first_row, try_casts
from inspectstar.operators import (
    assign_key,
    distinct_rows,
    match_all,
    narrowest_key,
    null_safe,
    row_number,
    star_lookup,
)
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import SPECS, build_dimension, dimension_lookup, members
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.plans.inspections import (
    INSPECTION_DIMENSIONS,
    INSPECTION_GRAIN,
    address_lookup,
    address_matches,
    build_inspections,
    inspection_rows,
)
from inspectstar.plans.violations import (
    VIOLATION_DIMENSIONS,
    all_violations,
    build_violations,
    violation_lookups,
)
from inspectstar.scratch import Scratch
from inspectstar.sinks import overwrite, write_records, write_stage
from inspectstar.sources import (
    parse_records,
    read_fields,
    read_records,
    read_stage,
    read_table,
    table_path,
)

Query = Callable[[SparkSession, str], DataFrame]


def fixed_moment() -> Column:
    """The ingestion moment of every query, so that results repeat."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def _landed(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """Staging as a stored table, for queries that scan it more than once."""
    path = scratch.path("stage")
    write_stage(derive_stage(spark, sf_dir), path)
    return read_stage(spark, path)


def _dimensions(
    spark: SparkSession, stage: DataFrame, tables: Iterable[str], scratch: Scratch
) -> dict[str, DataFrame]:
    """Stored dimensions built from ``stage``."""
    base = scratch.path("dimensions")
    options = jobs.BuildOptions(as_of=fixed_moment())
    tables = tuple(tables)
    jobs.write_dimensions(spark, stage, base, options, tables)
    return jobs.read_dimensions(spark, base, tables)


# Sources


def src_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("records")
    write_records(derive_stage(spark, sf_dir), path)
    return read_records(spark, path)


def src_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # to_json leaves NULL fields out, as the portal does.
    records = derive_stage(spark, sf_dir).select(F.to_json(F.struct("*")).alias("record"))
    return parse_records(records, "record")


def src_parquet_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, Scratch(spark))


def src_parquet_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = Scratch(spark).path("dimensions")
    options = jobs.BuildOptions(as_of=fixed_moment())
    jobs.write_dimensions(
        spark, derive_stage(spark, sf_dir), base, options, [names.VIOLATION_CODES]
    )
    return read_table(spark, base, names.VIOLATION_CODES)


def src_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = Scratch(spark).path("dimensions")
    options = jobs.BuildOptions(as_of=fixed_moment())
    jobs.write_dimensions(spark, derive_stage(spark, sf_dir), base, options, [names.ADDRESSES])
    return read_table(spark, base, names.ADDRESSES, jobs.dimension_schema(names.ADDRESSES))


def src_text_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("lines")
    line = F.concat_ws(",", "camis", "phone", "zipcode")  # NULLs are left out: short lines
    derive_stage(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_fields(spark, path, ["field_1", "field_2", "field_3"])


# Sinks


def sink_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(Scratch(spark).root, "overwritten")
    stage = derive_stage(spark, sf_dir)
    overwrite(stage.select("camis", "record_date"), path)
    overwrite(stage.select("camis", "dba", "grade"), path)
    return spark.read.parquet(path)


def sink_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(Scratch(spark).root, "by_borough")
    stage = derive_stage(spark, sf_dir).select("camis", "boro", "inspection_date", "score")
    overwrite(stage, path, ["boro"])
    return spark.read.schema(stage.schema).parquet(path)


#: Staging rows of one file where they are dealt out: about 230 MB as they are shuffled.
ROWS_PER_FILE = 1_000_000


def sink_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("stage")
    # At most one staging row per line item, which are counted from the footers.
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    files = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE))
    write_stage(derive_stage(spark, sf_dir), path, files)
    return read_stage(spark, path)


# Projections and predicates


def proj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_stage(spark, sf_dir).select("camis", "boro", "phone", "score")


def proj_alias_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    borough = build_dimension(stage, SPECS[names.BOROUGH], scratch, fixed_moment())
    matches = F.col("record.boro").eqNullSafe(F.col("member.BOROUGH"))
    joined = stage.alias("record").join(borough.alias("member"), matches, "inner")
    return joined.select("record.camis", "record.boro", "record.phone", "member.BOROUGH_SK")


def proj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("camis", "score", "grade_date", "action")
    return stage.withColumnsRenamed(
        {"score": "SCORE_TEXT", "grade_date": "GRADED_ON", "action": "ACTION_TAKEN"}
    )


def proj_rename_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("inspection_date", "camis", "phone")
    return stage.toDF("VISITED_ON", "PLACE", "CONTACT")


def proj_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("camis", "dba", "boro", "phone")
    return stage.select("phone", "boro", "camis", "dba")


def proj_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select(
        "camis",
        "inspection_date",
        F.col("record_date").alias("INGESTION_DATE"),
        F.col("record_date").alias("INGESTION_TIME"),
    )
    return stage.withColumns(audit_columns(fixed_moment()))


def proj_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("camis", "dba", "boro", "record_date")
    return stage.drop("record_date")


def pred_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("bin"), F.col("bbl")
    return derive_stage(spark, sf_dir).select(
        "camis",
        "bin",
        "bbl",
        (a == b).alias("is_equal"),
        a.isNull().alias("is_missing"),
        ((a == b) | (a.isNull() & b.isNull())).alias("is_equal_or_both_missing"),
        null_safe([("bin", "bbl")]).alias("is_same"),
    )


# Joins


def join_using_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _landed(spark, sf_dir, Scratch(spark))
    places = stage.select("camis").distinct()
    return places.join(stage.select("camis", "dba", "inspection_date"), on="camis", how="inner")


def join_lookup_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, VIOLATION_DIMENSIONS, scratch)
    specs = [s for s in violation_lookups(dims) if len(s.on) == 1]
    columns = ["camis", "inspection_date", *[c for s in specs for c in s.on]]
    return star_lookup(stage.select(*columns), specs, scratch)


def join_lookup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, [names.VIOLATION_CODES], scratch)
    rows = stage.select("camis", "inspection_date", "violation_code", "violation_description")
    codes = dimension_lookup(names.VIOLATION_CODES, dims[names.VIOLATION_CODES])
    return star_lookup(rows, [codes], scratch)


def join_lookup_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits and the address they settle on, with the number of addresses that qualify."""
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, [names.ADDRESSES], scratch)
    address = address_lookup(
        dims[names.ADDRESSES], scratch, ("ADDRESS_SK", "ADDRESS_CANDIDATES")
    )
    return star_lookup(distinct_rows(stage.select(*INSPECTION_GRAIN)), [address], scratch)


def _inspections(
    spark: SparkSession, stage: DataFrame, dims: dict[str, DataFrame], scratch: Scratch
) -> DataFrame:
    """The stored inspection fact."""
    fact = build_inspections(stage, dims, scratch, as_of=fixed_moment())
    return scratch.keep(fact, "inspections")


def _all_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, SPECS, scratch)
    return all_violations(stage, dims, _inspections(spark, stage, dims, scratch), scratch)


def join_fact_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staging row met with every inspection of the same date and phone."""
    return _all_violations(spark, sf_dir).select(
        "INSPECTION_SK", "INSCPECTION_DATE", "PHONE", "VIOLATION_CODE_SK", "ACTION_SK",
        "CRITICAL_FLAG_SK", "GRADE_SK", "INSPECTION_TYPE_SK",
    )


def star_lookup_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staging row with a known place, its keys and every address that qualifies."""
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, INSPECTION_DIMENSIONS, scratch)
    rows = stage.select(*INSPECTION_GRAIN).where(F.col("camis").isNotNull())
    single = (names.FOOD_PLACES, names.BOROUGH, names.CUISINE)
    rows = star_lookup(rows, [dimension_lookup(t, dims[t]) for t in single], scratch)
    return match_all(rows, address_matches(dims[names.ADDRESSES]), "ADDRESS_SK", scratch)


def star_lookup_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staging row's keys, score and grade date joined to the inspection fact."""
    return _all_violations(spark, sf_dir)


# Aggregations


def agg_distinct_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_stage(spark, sf_dir).select("cuisine_description").distinct()


def agg_distinct_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["violation_code", "violation_description"]
    return derive_stage(spark, sf_dir).select(*columns).distinct()


def agg_first_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = derive_stage(spark, sf_dir).select("camis", "dba").distinct()
    return pairs.groupBy("camis").agg(first_non_null("dba").alias("dba"))


def agg_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = list(SPECS[names.ADDRESSES].grain)
    attributes = list(SPECS[names.ADDRESSES].row_attributes)
    rows = derive_stage(spark, sf_dir).select(*grain, *attributes).distinct()
    picked = rows.groupBy(*grain).agg(first_row(attributes).alias("row"))
    return picked.select(*grain, "row.*")


def agg_dict_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, INSPECTION_DIMENSIONS, scratch)
    return inspection_rows(stage, dims, scratch, carry=INSPECTION_GRAIN)


def agg_fact2_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violation fact without its number: one row per pair in the fact's grain."""
    lower = {"SCORE": "score", "GRADE_DATE": "grade_date", "ACTION": "action"}
    fact = fact_violations(spark, sf_dir).drop("INSPECTION_VIOLATION_SK", *names.AUDIT_COLUMNS)
    return fact.withColumnsRenamed(lower)


# Numbering, order


def win_row_number_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = derive_stage(spark, sf_dir).select("camis").distinct()
    return row_number(places, ["camis"], "row_num", Scratch(spark))


def win_row_number_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = list(SPECS[names.ADDRESSES].grain)
    addresses = derive_stage(spark, sf_dir).select(*order).distinct()
    return row_number(addresses, order, "row_num", Scratch(spark))


def sort_asc_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["violation_code", "violation_description"]
    codes = derive_stage(spark, sf_dir).select(*columns).distinct()
    return codes.orderBy(*[F.col(c).asc_nulls_first() for c in columns])


def limit_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["camis", "inspection_date", "violation_code", "violation_description", "score"]
    stage = derive_stage(spark, sf_dir).select(*order)
    return stage.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(1)


# Scalar functions and keys


def fn_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("camis", "inspection_date")
    return stage.withColumns(audit_columns(fixed_moment()))


def fn_cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = derive_stage(spark, sf_dir).select("camis", "latitude", "longitude")
    casts = {"latitude": names.COORDINATE, "longitude": names.COORDINATE}
    return stage.withColumns(try_casts(casts))


def fn_cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Names are no numbers: they must come back NULL, not fail the query.
    columns = ["census_tract", "community_board", "council_district", "street"]
    stage = derive_stage(spark, sf_dir).select("camis", *columns)
    return stage.withColumns(try_casts(dict.fromkeys(columns, "int")))


def key_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS[names.VIOLATION_CODES]
    codes = members(derive_stage(spark, sf_dir), spec)
    return assign_key(codes, list(spec.grain.values()), spec.key, Scratch(spark))


def key_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = derive_stage(spark, sf_dir).select(*INSPECTION_GRAIN).distinct()
    return assign_key(visits, INSPECTION_GRAIN, "VISIT_SK", Scratch(spark))


# Dimensions, facts, jobs


def _dimension_query(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stage = derive_stage(spark, sf_dir)
        return build_dimension(stage, SPECS[table], Scratch(spark), fixed_moment())

    return query


def fact_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, INSPECTION_DIMENSIONS, scratch)
    return build_inspections(stage, dims, scratch, as_of=fixed_moment())


def fact_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims = _dimensions(spark, stage, SPECS, scratch)
    inspections = _inspections(spark, stage, dims, scratch)
    return build_violations(
        stage, dims, inspections, scratch, as_of=fixed_moment(), number_type=None
    )


def job_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land exported records, write the nine dimensions; a summary of each table."""
    scratch = Scratch(spark)
    records, stage, base = (scratch.path(p) for p in ("records", "stage", "dimensions"))
    write_records(derive_stage(spark, sf_dir), records)
    jobs.land_stage(spark, records, stage)
    jobs.write_dimensions(spark, read_stage(spark, stage), base)
    return jobs.table_summaries(spark, jobs.stored_schemas(base))


def _stored_facts(spark: SparkSession, sf_dir: str, violations: bool) -> str:
    """The base folder of facts written by the jobs."""
    scratch = Scratch(spark)
    stage = _landed(spark, sf_dir, scratch)
    dims, facts = scratch.path("dimensions"), scratch.path("facts")
    options = jobs.BuildOptions(as_of=fixed_moment(), number_type="bigint")
    jobs.write_dimensions(spark, stage, dims, options)
    jobs.write_inspections(spark, stage, dims, facts, options)
    if violations:
        jobs.write_violations(spark, stage, dims, facts, options)
    return facts


def job_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored, partitioned inspection fact, read back."""
    facts = _stored_facts(spark, sf_dir, violations=False)
    return read_table(spark, facts, names.INSPECTIONS, jobs.inspections_schema())


def job_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored, partitioned violation fact, built on the stored inspection fact."""
    facts = _stored_facts(spark, sf_dir, violations=True)
    fact = read_table(
        spark, facts, names.VIOLATIONS, jobs.violations_schema(number_type="bigint")
    )
    # Written wide, as the rows are not known before; as an int where all of them fit.
    number = F.col("INSPECTION_VIOLATION_SK").cast(narrowest_key(fact.count()))
    return fact.withColumn("INSPECTION_VIOLATION_SK", number)


def job_full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to facts; a summary of each table."""
    scratch = Scratch(spark)
    records, stage, dims, facts = (
        scratch.path(p) for p in ("records", "stage", "dimensions", "facts")
    )
    write_records(derive_stage(spark, sf_dir), records)
    options = jobs.BuildOptions(number_type="bigint")
    return jobs.run(spark, records, stage, dims, facts, options)


QUERIES: dict[str, Query] = {
    "src_json_ingest": src_json_ingest,
    "src_rows": src_rows,
    "src_parquet_stage": src_parquet_stage,
    "src_parquet_dim": src_parquet_dim,
    "src_parquet_partitioned": src_parquet_partitioned,
    "src_text_split": src_text_split,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "sink_parquet_partitioned": sink_parquet_partitioned,
    "sink_repartition": sink_repartition,
    "proj_select": proj_select,
    "proj_alias_qualified": proj_alias_qualified,
    "proj_rename": proj_rename,
    "proj_rename_positional": proj_rename_positional,
    "proj_reorder": proj_reorder,
    "proj_replace": proj_replace,
    "proj_drop": proj_drop,
    "pred_null_safe": pred_null_safe,
    "join_using_self": join_using_self,
    "join_lookup_single": join_lookup_single,
    "join_lookup_composite": join_lookup_composite,
    "join_lookup_fanout": join_lookup_fanout,
    "join_fact_to_fact": join_fact_to_fact,
    "star_lookup_inspections": star_lookup_inspections,
    "star_lookup_violations": star_lookup_violations,
    "agg_distinct_single": agg_distinct_single,
    "agg_distinct_composite": agg_distinct_composite,
    "agg_first_nonnull": agg_first_nonnull,
    "agg_first_row": agg_first_row,
    "agg_dict_first": agg_dict_first,
    "agg_fact2_dedup": agg_fact2_dedup,
    "win_row_number_single": win_row_number_single,
    "win_row_number_multi": win_row_number_multi,
    "sort_asc_nulls_first": sort_asc_nulls_first,
    "limit_first": limit_first,
    "fn_audit_columns": fn_audit_columns,
    "fn_cast_decimal": fn_cast_decimal,
    "fn_cast_integer": fn_cast_integer,
    "key_window": key_window,
    "key_bucketed": key_bucketed,
    "dim_food_places": _dimension_query(names.FOOD_PLACES),
    "dim_cuisine": _dimension_query(names.CUISINE),
    "dim_borough": _dimension_query(names.BOROUGH),
    "dim_addresses": _dimension_query(names.ADDRESSES),
    "dim_critical_flag": _dimension_query(names.CRITICAL_FLAG),
    "dim_grades": _dimension_query(names.GRADES),
    "dim_inspection_type": _dimension_query(names.INSPECTION_TYPE),
    "dim_actions": _dimension_query(names.ACTIONS),
    "dim_violation_codes": _dimension_query(names.VIOLATION_CODES),
    "fact_inspections": fact_inspections,
    "fact_violations": fact_violations,
    "job_dimensions": job_dimensions,
    "job_inspections": job_inspections,
    "job_violations": job_violations,
    "job_full_build": job_full_build,
}
