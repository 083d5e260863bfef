"""The nine dimensions, each described by one :class:`DimensionSpec`."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.functions import audit_columns, first_non_null, first_row, try_casts
from inspectstar.operators import Lookup, assign_key
from inspectstar.scratch import Scratch


@dataclass(frozen=True)
class DimensionSpec:
    """How one dimension comes out of staging.

    ``grain`` maps the staging columns that identify a member to output names, in the order
    that numbers the members. ``row_attributes`` all come from one row of the member's
    group, ``value_attributes`` each take their own first non-null value.
    """

    table: str
    key: str
    grain: Mapping[str, str]
    row_attributes: Mapping[str, str] = field(default_factory=dict)
    value_attributes: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    drop_null_grain: bool = False

    def output_columns(self) -> tuple[str, ...]:
        return self.columns or (self.key, *self.grain.values(), *self.value_attributes.values())


def _single(table: str, key: str, column: str, output: str) -> DimensionSpec:
    return DimensionSpec(table, key, {column: output})


# Keys, columns, casts and layouts of the nine dimension tables.
DIMENSIONS = (
    DimensionSpec(
        names.FOOD_PLACES,
        "FOOD_PLACES_SK",
        grain={"camis": "CAMIS"},
        value_attributes={"dba": "DBA"},
        drop_null_grain=True,
    ),
    _single(names.CUISINE, "CUISINE_DESCRIPTION_SK", "cuisine_description", "CUISINE_DESCRIPTION"),
    _single(names.BOROUGH, "BOROUGH_SK", "boro", "BOROUGH"),
    DimensionSpec(
        names.ADDRESSES,
        "ADDRESS_SK",
        grain={
            "boro": "BOROUGH",
            "building": "BUILDING",
            "street": "STREET",
            "zipcode": "ZIPCODE",
            "bin": "BIN",
            "bbl": "BBL",
            "nta": "NTA",
        },
        row_attributes={
            "latitude": "LATITUTDE",
            "longitude": "LONGITUDE",
            "census_tract": "CENSUS_TRACT",
            "community_board": "COMMUNITY_BOARD",
            "council_district": "COUNCIL_DISTRICT",
        },
        casts={
            "LATITUTDE": names.COORDINATE,
            "LONGITUDE": names.COORDINATE,
            "CENSUS_TRACT": "int",
            "COMMUNITY_BOARD": "int",
            "COUNCIL_DISTRICT": "int",
        },
        columns=(
            "ADDRESS_SK",
            "BUILDING",
            "BBL",
            "BIN",
            "STREET",
            "ZIPCODE",
            "BOROUGH",
            "NTA",
            "LATITUTDE",
            "LONGITUDE",
            "CENSUS_TRACT",
            "COMMUNITY_BOARD",
            "COUNCIL_DISTRICT",
        ),
        partition_by=("BOROUGH",),
    ),
    _single(names.CRITICAL_FLAG, "CRITICAL_FLAG_SK", "critical_flag", "CRITICAL_FLAG"),
    _single(names.GRADES, "GRADE_SK", "grade", "GRADE"),
    _single(names.INSPECTION_TYPE, "INSPECTION_TYPE_SK", "inspection_type", "INSPECTION_TYPE"),
    _single(names.ACTIONS, "ACTION_SK", "action", "ACTION"),
    DimensionSpec(
        names.VIOLATION_CODES,
        "VIOLATION_CODE_SK",
        grain={
            "violation_code": "VIOLATION_CODE",
            "violation_description": "VIOLATION_DESCRIPTION",
        },
    ),
)

SPECS = {spec.table: spec for spec in DIMENSIONS}


def members(stage: DataFrame, spec: DimensionSpec) -> DataFrame:
    """The dimension's rows before numbering: grain and attributes under their output names."""
    columns = [*spec.grain, *spec.row_attributes, *spec.value_attributes]
    # Repeats go first, in a hash aggregate: picking a string minimum needs sorted input, and
    # this leaves the sort one row per distinct combination instead of the whole table.
    rows = stage.select(*columns)
    if spec.drop_null_grain:
        # isNotNull reaches the file scan as a filter; dropna would not.
        rows = rows.where(reduce(and_, (F.col(c).isNotNull() for c in spec.grain)))
    rows = rows.distinct()
    picks = [first_non_null(c).alias(c) for c in spec.value_attributes]
    if spec.row_attributes:
        picks.append(first_row(list(spec.row_attributes)).alias("__row"))
    if picks:
        rows = rows.groupBy(*spec.grain).agg(*picks)
    if spec.row_attributes:
        rows = rows.select("*", "__row.*").drop("__row")
    renamed = rows.withColumnsRenamed(
        {**spec.grain, **spec.row_attributes, **spec.value_attributes}
    )
    return renamed.withColumns(try_casts(spec.casts)) if spec.casts else renamed


def build_dimension(
    stage: DataFrame,
    spec: DimensionSpec,
    scratch: Scratch,
    as_of: Column | datetime.datetime | None = None,
    key_type: str = "int",
) -> DataFrame:
    """One finished dimension: members, dense key in grain order, audit columns."""
    order = list(spec.grain.values())
    keyed = assign_key(members(stage, spec), order, spec.key, scratch, key_type)
    audited = keyed.withColumns(audit_columns(as_of))
    return audited.select(*spec.output_columns(), *names.AUDIT_COLUMNS)


def dimension_lookup(table: str, dim: DataFrame) -> Lookup:
    """Find a member by its whole grain and take its key."""
    spec = SPECS[table]
    return Lookup(dim, spec.grain, (spec.key,))
