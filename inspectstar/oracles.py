"""The queries as plain SQL, each from the star tables to the result in one statement.

The SQL states the definitions directly: many-to-many joins are joined and then grouped,
keys are one ``row_number`` over the whole table.
"""

from __future__ import annotations

STAGE = """stage as (
select
 case when c_custkey % 29 = 0 then null else cast(c_custkey as string) end as camis,
 case when l_linenumber = 1 or c_custkey % 23 = 0 then null else c_name end as dba,
 nullif(r_name, 'ASIA') as boro,
 cast(c_custkey % 50 as string) as building,
 n_name as street,
 cast(10000 + c_nationkey as string) as zipcode,
 case when c_custkey % 11 = 0 then null else cast(c_custkey % 40 as string) end as bin,
 case when c_custkey % 11 = 0 then null else cast(c_custkey % 13 as string) end as bbl,
 c_mktsegment as nta,
 cast(cast(c_acctbal as decimal(12,2)) as string) as latitude,
 cast(cast(-c_acctbal as decimal(12,2)) as string) as longitude,
 lpad(cast(c_nationkey * 100 as string), 6, '0') as census_tract,
 cast(100 + c_nationkey % 5 as string) as community_board,
 cast(c_nationkey as string) as council_district,
 case when c_custkey % 17 = 0 then null else cast(c_custkey % 97 as string) end as phone,
 p_type as cuisine_description,
 cast(cast(o_orderdate as date) as string) as inspection_date,
 o_orderstatus as action,
 o_orderpriority as inspection_type,
 nullif(l_returnflag, 'N') as grade,
 cast(cast(l_shipdate as date) as string) as grade_date,
 cast(cast(l_quantity as decimal(12,2)) as string) as score,
 l_linestatus as critical_flag,
 nullif(p_brand, 'Brand#11') as violation_code,
 p_name as violation_description,
 cast(cast(o_orderdate as date) as string) as record_date
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
join part on l_partkey = p_partkey)"""

AUDIT = (
    "cast('2024-01-01' as date) as INGESTION_DATE, "
    "cast('2024-01-01 00:00:00' as timestamp) as INGESTION_TIME"
)


def _single(key: str, column: str, output: str) -> str:
    return (
        f"select cast(row_number() over (order by {column} nulls first) as integer) as {key}, "
        f"{column} as {output} from (select distinct {column} from stage)"
    )


# Dimension definitions: name of the common table -> select over stage.
DIMS = {
    "food_places": (
        "select cast(row_number() over (order by camis nulls first) as integer) "
        "as FOOD_PLACES_SK, camis as CAMIS, min(dba) as DBA "
        "from stage where camis is not null group by camis"
    ),
    "cuisine": _single("CUISINE_DESCRIPTION_SK", "cuisine_description", "CUISINE_DESCRIPTION"),
    "borough": _single("BOROUGH_SK", "boro", "BOROUGH"),
    "critical_flag": _single("CRITICAL_FLAG_SK", "critical_flag", "CRITICAL_FLAG"),
    "grades": _single("GRADE_SK", "grade", "GRADE"),
    "inspection_type": _single("INSPECTION_TYPE_SK", "inspection_type", "INSPECTION_TYPE"),
    "actions": _single("ACTION_SK", "action", "ACTION"),
    "violation_codes": (
        "select cast(row_number() over (order by violation_code nulls first, "
        "violation_description nulls first) as integer) as VIOLATION_CODE_SK, "
        "violation_code as VIOLATION_CODE, violation_description as VIOLATION_DESCRIPTION "
        "from (select distinct violation_code, violation_description from stage)"
    ),
    "addresses": """select cast(row_number() over (order by boro nulls first,
 building nulls first, street nulls first, zipcode nulls first, bin nulls first,
 bbl nulls first, nta nulls first) as integer) as ADDRESS_SK,
 building as BUILDING, bbl as BBL, bin as BIN, street as STREET, zipcode as ZIPCODE,
 boro as BOROUGH, nta as NTA,
 try_cast(latitude as decimal(38,12)) as LATITUTDE,
 try_cast(longitude as decimal(38,12)) as LONGITUDE,
 try_cast(census_tract as integer) as CENSUS_TRACT,
 try_cast(community_board as integer) as COMMUNITY_BOARD,
 try_cast(council_district as integer) as COUNCIL_DISTRICT
from (select *, row_number() over (
   partition by boro, building, street, zipcode, bin, bbl, nta
   order by latitude nulls first, longitude nulls first, census_tract nulls first,
     community_board nulls first, council_district nulls first) as pick from stage)
where pick = 1""",
}

# Inspections before numbering: the lookups fan out, the grouping settles on one address.
J4 = """j4 as (
select s.inspection_date, s.camis, s.boro, s.zipcode, s.phone, s.cuisine_description,
 s.bin, s.bbl, FOOD_PLACES_SK, BOROUGH_SK, ADDRESS_SK, CUISINE_DESCRIPTION_SK
from stage s
join food_places f on s.camis is not distinct from f.CAMIS
join borough b on s.boro is not distinct from b.BOROUGH
join addresses a on s.bin is not distinct from a.BIN and s.bbl is not distinct from a.BBL
 and s.zipcode is not distinct from a.ZIPCODE
join cuisine c on s.cuisine_description is not distinct from c.CUISINE_DESCRIPTION)"""

INSPECTION_ROWS = """inspection_rows as (
select inspection_date, camis, boro, zipcode, phone, cuisine_description, bin, bbl,
 min(FOOD_PLACES_SK) as FOOD_PLACES_SK, min(BOROUGH_SK) as BOROUGH_SK,
 min(ADDRESS_SK) as ADDRESS_SK, min(CUISINE_DESCRIPTION_SK) as CUISINE_DESCRIPTION_SK
from j4
group by inspection_date, camis, boro, zipcode, phone, cuisine_description, bin, bbl)"""

INSPECTIONS = """inspections as (
select cast(row_number() over (order by FOOD_PLACES_SK nulls first,
 inspection_date nulls first, BOROUGH_SK nulls first, CUISINE_DESCRIPTION_SK nulls first,
 phone nulls first, ADDRESS_SK nulls first) as integer) as INSPECTION_SK,
 inspection_date as INSCPECTION_DATE, FOOD_PLACES_SK, BOROUGH_SK, ADDRESS_SK, phone as PHONE,
 CUISINE_DESCRIPTION_SK
from inspection_rows)"""

J6 = """j6 as (
select i.INSPECTION_SK, i.INSCPECTION_DATE, i.FOOD_PLACES_SK, i.BOROUGH_SK, i.ADDRESS_SK,
 i.PHONE, i.CUISINE_DESCRIPTION_SK, VIOLATION_CODE_SK, ACTION_SK, INSPECTION_TYPE_SK,
 GRADE_SK, CRITICAL_FLAG_SK, s.score, s.grade_date, s.action
from stage s
join violation_codes v on s.violation_code is not distinct from v.VIOLATION_CODE
 and s.violation_description is not distinct from v.VIOLATION_DESCRIPTION
join actions a on s.action is not distinct from a.ACTION
join inspection_type t on s.inspection_type is not distinct from t.INSPECTION_TYPE
join grades g on s.grade is not distinct from g.GRADE
join critical_flag c on s.critical_flag is not distinct from c.CRITICAL_FLAG
join inspections i on s.inspection_date is not distinct from i.INSCPECTION_DATE
 and s.phone is not distinct from i.PHONE)"""

_J6_GRAIN = (
    "BOROUGH_SK, INSPECTION_SK, PHONE, ACTION_SK, CRITICAL_FLAG_SK, GRADE_SK, "
    "INSPECTION_TYPE_SK, VIOLATION_CODE_SK"
)

VIOLATION_ROWS = f"""violation_rows as (
select * from (select *,
 row_number() over (partition by {_J6_GRAIN} order by score nulls first,
  grade_date nulls first, action nulls first) as pick
from j6) where pick = 1)"""

_VISIT_GRAIN = "inspection_date, camis, boro, zipcode, phone, cuisine_description, bin, bbl"

_INSPECTION_PARTS = ["food_places", "borough", "addresses", "cuisine"]
_VIOLATION_PARTS = ["violation_codes", "actions", "inspection_type", "grades", "critical_flag"]


def _with(parts: list[str], select: str) -> str:
    """A statement over stage and the named definitions."""
    texts = [STAGE, *[f"{p} as ({DIMS[p]})" if p in DIMS else p for p in parts]]
    return "with " + ",\n".join(texts) + "\n" + select


def _dim(part: str) -> str:
    return _with([part], f"select *, {AUDIT} from {part}")


_TO_INSPECTIONS = [*_INSPECTION_PARTS, J4, INSPECTION_ROWS, INSPECTIONS]
_TO_J6 = [*_TO_INSPECTIONS, *_VIOLATION_PARTS, J6]
_TO_VIOLATIONS = [*_TO_J6, VIOLATION_ROWS]

VIOLATIONS = """violations as (
select cast(row_number() over (order by BOROUGH_SK nulls first,
 INSPECTION_SK nulls first, ACTION_SK nulls first, CRITICAL_FLAG_SK nulls first,
 GRADE_SK nulls first, INSPECTION_TYPE_SK nulls first, VIOLATION_CODE_SK nulls first)
 as integer) as INSPECTION_VIOLATION_SK, INSPECTION_SK, INSPECTION_TYPE_SK, ACTION_SK,
 CRITICAL_FLAG_SK, score as SCORE, GRADE_SK, VIOLATION_CODE_SK, ADDRESS_SK, BOROUGH_SK,
 CUISINE_DESCRIPTION_SK, FOOD_PLACES_SK, INSCPECTION_DATE, PHONE, action as ACTION,
 grade_date as GRADE_DATE from violation_rows)"""

_TABLES = {
    "Dim_NYC_Food_Places": "food_places",
    "Dim_NYC_Cuisine": "cuisine",
    "Dim_NYC_Borough": "borough",
    "Dim_NYC_Addresses": "addresses",
    "Dim_NYC_Critical_Flag": "critical_flag",
    "Dim_NYC_Inspection_Grades": "grades",
    "Dim_NYC_Inspection_Type": "inspection_type",
    "Dim_NYC_Inspection_Actions": "actions",
    "Dim_NYC_Violation_Codes": "violation_codes",
    "FCT_NYC_Food_Inspections": "inspections",
    "FCT_NYC_FoodInspection_Violations": "violations",
}


# Keys (the own one first) and texts of each table.
_COLUMNS = {
    "food_places": ("FOOD_PLACES_SK", "CAMIS DBA"),
    "cuisine": ("CUISINE_DESCRIPTION_SK", "CUISINE_DESCRIPTION"),
    "borough": ("BOROUGH_SK", "BOROUGH"),
    "addresses": ("ADDRESS_SK", "BUILDING BBL BIN STREET ZIPCODE BOROUGH NTA"),
    "critical_flag": ("CRITICAL_FLAG_SK", "CRITICAL_FLAG"),
    "grades": ("GRADE_SK", "GRADE"),
    "inspection_type": ("INSPECTION_TYPE_SK", "INSPECTION_TYPE"),
    "actions": ("ACTION_SK", "ACTION"),
    "violation_codes": ("VIOLATION_CODE_SK", "VIOLATION_CODE VIOLATION_DESCRIPTION"),
    "inspections": (
        "INSPECTION_SK FOOD_PLACES_SK BOROUGH_SK ADDRESS_SK CUISINE_DESCRIPTION_SK",
        "INSCPECTION_DATE PHONE",
    ),
    "violations": (
        "INSPECTION_VIOLATION_SK INSPECTION_SK INSPECTION_TYPE_SK ACTION_SK CRITICAL_FLAG_SK "
        "GRADE_SK VIOLATION_CODE_SK ADDRESS_SK BOROUGH_SK CUISINE_DESCRIPTION_SK FOOD_PLACES_SK",
        "SCORE INSCPECTION_DATE PHONE ACTION GRADE_DATE",
    ),
}


def _summary(table: str, part: str) -> str:
    keys, texts = (columns.split() for columns in _COLUMNS[part])
    key = " + ".join(f"coalesce({k}, 0)::hugeint" for k in keys)
    size = " + ".join(f"coalesce(strlen({t}), 0)::hugeint" for t in texts)
    own = f"coalesce({keys[0]}, 0)::hugeint"
    row = " || ".join(
        f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
        for c in sorted(keys + texts)
    )
    digest = f"('0x' || substr(md5({row}), 1, 12))::bigint::hugeint"
    return (
        f"select '{table}' as table_name, count(*) as row_count, "
        f"cast(coalesce(sum({key}), 0) % 1000000000000000 as bigint) as key_sum, "
        f"cast(coalesce(sum({own} * ({size})), 0) % 1000000000000000 as bigint) as key_text_sum, "
        f"cast(coalesce(sum({digest}), 0) % 1000000000000000 as bigint) as row_sum "
        f"from {part}"
    )


def _summaries(tables: list[str]) -> str:
    return " union all ".join(_summary(t, _TABLES[t]) for t in tables)


_NINE = list(_TABLES)[:9]

ORACLES: dict[str, str] = {
    "src_json_ingest": _with([], "select * from stage"),
    "src_rows": _with([], "select * from stage"),
    "src_parquet_stage": _with([], "select * from stage"),
    "src_parquet_dim": _dim("violation_codes"),
    "src_parquet_partitioned": _dim("addresses"),
    "src_text_split": _with(
        [],
        "select parts[1] as field_1, parts[2] as field_2, parts[3] as field_3 from "
        "(select string_split(concat_ws(',', camis, phone, zipcode), ',') as parts from stage)",
    ),
    "sink_parquet_overwrite": _with([], "select camis, dba, grade from stage"),
    "sink_parquet_partitioned": _with(
        [], "select camis, nullif(boro, '') as boro, inspection_date, score from stage"
    ),
    "sink_repartition": _with([], "select * from stage"),
    "proj_select": _with([], "select camis, boro, phone, score from stage"),
    "proj_alias_qualified": _with(
        ["borough"],
        "select s.camis, s.boro, s.phone, b.BOROUGH_SK from stage s "
        "join borough b on s.boro is not distinct from b.BOROUGH",
    ),
    "proj_rename": _with(
        [],
        "select camis, score as SCORE_TEXT, grade_date as GRADED_ON, action as ACTION_TAKEN "
        "from stage",
    ),
    "proj_rename_positional": _with(
        [], "select inspection_date as VISITED_ON, camis as PLACE, phone as CONTACT from stage"
    ),
    "proj_reorder": _with([], "select phone, boro, camis, dba from stage"),
    "proj_replace": _with([], f"select camis, inspection_date, {AUDIT} from stage"),
    "proj_drop": _with([], "select camis, dba, boro from stage"),
    "pred_null_safe": _with(
        [],
        "select camis, bin, bbl, bin = bbl as is_equal, bin is null as is_missing, "
        "(bin = bbl) or (bin is null and bbl is null) as is_equal_or_both_missing, "
        "bin is not distinct from bbl as is_same from stage",
    ),
    "join_using_self": _with(
        [],
        "select camis, dba, inspection_date from (select distinct camis from stage) "
        "join (select camis, dba, inspection_date from stage) using (camis)",
    ),
    "join_lookup_single": _with(
        ["actions", "inspection_type", "grades", "critical_flag"],
        "select camis, inspection_date, s.action, s.inspection_type, s.grade, s.critical_flag, "
        "ACTION_SK, INSPECTION_TYPE_SK, GRADE_SK, CRITICAL_FLAG_SK from stage s "
        "join actions a on s.action is not distinct from a.ACTION "
        "join inspection_type t on s.inspection_type is not distinct from t.INSPECTION_TYPE "
        "join grades g on s.grade is not distinct from g.GRADE "
        "join critical_flag c on s.critical_flag is not distinct from c.CRITICAL_FLAG",
    ),
    "join_lookup_composite": _with(
        ["violation_codes"],
        "select camis, inspection_date, s.violation_code, s.violation_description, "
        "VIOLATION_CODE_SK from stage s "
        "join violation_codes v on s.violation_code is not distinct from v.VIOLATION_CODE "
        "and s.violation_description is not distinct from v.VIOLATION_DESCRIPTION",
    ),
    "join_lookup_fanout": _with(
        ["addresses"],
        f"select {', '.join('s.' + c for c in _VISIT_GRAIN.split(', '))}, "
        "min(ADDRESS_SK) as ADDRESS_SK, count(*) as ADDRESS_CANDIDATES "
        f"from (select distinct {_VISIT_GRAIN} from stage) s "
        "join addresses a on s.bin is not distinct from a.BIN "
        "and s.bbl is not distinct from a.BBL and s.zipcode is not distinct from a.ZIPCODE "
        "group by all",
    ),
    "join_fact_to_fact": _with(
        _TO_J6,
        "select INSPECTION_SK, INSCPECTION_DATE, PHONE, VIOLATION_CODE_SK, ACTION_SK, "
        "CRITICAL_FLAG_SK, GRADE_SK, INSPECTION_TYPE_SK from j6",
    ),
    "star_lookup_inspections": _with([*_INSPECTION_PARTS, J4], "select * from j4"),
    "star_lookup_violations": _with(_TO_J6, "select * from j6"),
    "agg_distinct_single": _with([], "select distinct cuisine_description from stage"),
    "agg_distinct_composite": _with(
        [], "select distinct violation_code, violation_description from stage"
    ),
    "agg_first_nonnull": _with([], "select camis, min(dba) as dba from stage group by camis"),
    "agg_first_row": _with(
        [],
        "select boro, building, street, zipcode, bin, bbl, nta, latitude, longitude, "
        "census_tract, community_board, council_district from (select *, row_number() over ("
        "partition by boro, building, street, zipcode, bin, bbl, nta order by "
        "latitude nulls first, longitude nulls first, census_tract nulls first, "
        "community_board nulls first, council_district nulls first) as pick from stage) "
        "where pick = 1",
    ),
    "agg_dict_first": _with(
        [*_INSPECTION_PARTS, J4, INSPECTION_ROWS], "select * from inspection_rows"
    ),
    "agg_fact2_dedup": _with(
        _TO_VIOLATIONS, "select * exclude (pick) from violation_rows"
    ),
    "win_row_number_single": _with(
        [],
        "select camis, row_number() over (order by camis nulls first) as row_num "
        "from (select distinct camis from stage)",
    ),
    "win_row_number_multi": _with(
        [],
        "select boro, building, street, zipcode, bin, bbl, nta, row_number() over (order by "
        "boro nulls first, building nulls first, street nulls first, zipcode nulls first, "
        "bin nulls first, bbl nulls first, nta nulls first) as row_num from "
        "(select distinct boro, building, street, zipcode, bin, bbl, nta from stage)",
    ),
    "sort_asc_nulls_first": _with(
        [],
        "select distinct violation_code, violation_description from stage "
        "order by violation_code nulls first, violation_description nulls first",
    ),
    "limit_first": _with(
        [],
        "select camis, inspection_date, violation_code, violation_description, score "
        "from stage order by camis nulls first, inspection_date nulls first, "
        "violation_code nulls first, violation_description nulls first, score nulls first "
        "limit 1",
    ),
    "fn_audit_columns": _with([], f"select camis, inspection_date, {AUDIT} from stage"),
    "fn_cast_decimal": _with(
        [],
        "select camis, try_cast(latitude as decimal(38,12)) as latitude, "
        "try_cast(longitude as decimal(38,12)) as longitude from stage",
    ),
    "fn_cast_integer": _with(
        [],
        "select camis, try_cast(census_tract as integer) as census_tract, "
        "try_cast(community_board as integer) as community_board, "
        "try_cast(council_district as integer) as council_district, "
        "try_cast(street as integer) as street from stage",
    ),
    "key_window": _with(["violation_codes"], "select * from violation_codes"),
    "key_bucketed": _with(
        [],
        f"select {_VISIT_GRAIN}, cast(row_number() over (order by "
        + ", ".join(f"{c} nulls first" for c in _VISIT_GRAIN.split(", "))
        + f") as integer) as VISIT_SK from (select distinct {_VISIT_GRAIN} from stage)",
    ),
    "dim_food_places": _dim("food_places"),
    "dim_cuisine": _dim("cuisine"),
    "dim_borough": _dim("borough"),
    "dim_addresses": _dim("addresses"),
    "dim_critical_flag": _dim("critical_flag"),
    "dim_grades": _dim("grades"),
    "dim_inspection_type": _dim("inspection_type"),
    "dim_actions": _dim("actions"),
    "dim_violation_codes": _dim("violation_codes"),
    "fact_inspections": _with(_TO_INSPECTIONS, f"select *, {AUDIT} from inspections"),
    "fact_violations": _with([*_TO_VIOLATIONS, VIOLATIONS], f"select *, {AUDIT} from violations"),
    "job_dimensions": _with(list(DIMS), _summaries(_NINE)),
    "job_inspections": _with(_TO_INSPECTIONS, f"select *, {AUDIT} from inspections"),
    "job_violations": _with([*_TO_VIOLATIONS, VIOLATIONS], f"select *, {AUDIT} from violations"),
    "job_full_build": _with(
        [*dict.fromkeys([*list(DIMS), *_TO_VIOLATIONS, VIOLATIONS])], _summaries(list(_TABLES))
    ),
}
