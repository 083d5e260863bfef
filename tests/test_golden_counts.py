"""Row counts of all tables and of the two star joins at three scale factors."""

from __future__ import annotations

import pytest

from inspectstar import schema as names
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import SPECS, dimension_lookup
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.plans.inspections import address_matches
from inspectstar.plans.violations import all_violations
from inspectstar.operators import match_all, star_lookup
from inspectstar.sinks import write_stage
from inspectstar.sources import read_stage
from tests.conftest import TESTDATA

SIZES = {
    "stage": (6_000, 60_000, 600_000),
    "stage without place": (287, 2_191, 20_360),
    names.FOOD_PLACES: (144, 1_448, 14_481),
    "places without name": (6, 63, 630),
    names.BOROUGH: (5, 5, 5),
    names.CUISINE: (6, 6, 6),
    names.ACTIONS: (3, 3, 3),
    names.INSPECTION_TYPE: (5, 5, 5),
    names.GRADES: (3, 3, 3),
    names.CRITICAL_FLAG: (2, 2, 2),
    names.VIOLATION_CODES: (191, 1_130, 1_600),
    names.ADDRESSES: (150, 1_499, 14_626),
    "distinct bin, bbl, zipcode": (148, 1_338, 8_602),
    "inspection star join": (5_815, 88_859, 3_663_586),
    names.INSPECTIONS: (4_180, 42_077, 422_800),
    "violation star join": (19_907, 209_416, 3_311_757),
    names.VIOLATIONS: (19_878, 209_351, 3_310_906),
}


@pytest.mark.parametrize("position, scale", list(enumerate(["0.001", "0.01", "0.1"])))
def test_counts(spark, scratch, position, scale):
    path, dims_base, facts_base = (scratch.path(p) for p in ("stage", "dims", "facts"))
    write_stage(derive_stage(spark, f"{TESTDATA}/sf{scale}"), path)
    stage = read_stage(spark, path)
    jobs.build_all(spark, stage, dims_base, facts_base)

    summaries = jobs.table_summaries(spark, jobs.stored_schemas(dims_base, facts_base))
    got = {r.table_name: r.row_count for r in summaries.collect()}

    dims = jobs.read_dimensions(spark, dims_base, SPECS)
    addresses = dims[names.ADDRESSES]
    got["stage"] = stage.count()
    got["stage without place"] = stage.where("camis is null").count()
    got["places without name"] = dims[names.FOOD_PLACES].where("DBA is null").count()
    got["distinct bin, bbl, zipcode"] = addresses.select("BIN", "BBL", "ZIPCODE").distinct().count()

    rows = stage.select("camis", "boro", "bin", "bbl", "zipcode", "cuisine_description")
    single = (names.FOOD_PLACES, names.BOROUGH, names.CUISINE)
    rows = star_lookup(rows, [dimension_lookup(t, dims[t]) for t in single], scratch)
    joined = match_all(rows, address_matches(addresses), "ADDRESS_SK", scratch)
    got["inspection star join"] = joined.count()
    inspections = spark.read.schema(jobs.inspections_schema()).parquet(
        f"{facts_base}/{names.INSPECTIONS}"
    )
    got["violation star join"] = all_violations(stage, dims, inspections, scratch).count()

    assert got == {name: sizes[position] for name, sizes in SIZES.items()}
