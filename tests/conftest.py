from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from inspectstar.operators import Limits
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import SPECS, build_dimension
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.scratch import Scratch
from inspectstar.sinks import write_stage
from inspectstar.sources import frame_of, read_stage

TESTDATA = "/root/testdata"

# Limits so low that every lookup shuffles and most keys and groups count as hot.
TINY = Limits(broadcast_bytes=0, rows_per_task=100, pairs_per_task=400)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("inspectstar-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    with Scratch(spark) as folder:
        yield folder


@pytest.fixture(scope="session")
def small_stage(spark):
    """Staging of the smallest scale factor as a stored table."""
    folder = Scratch(spark)
    path = folder.path("stage")
    write_stage(derive_stage(spark, f"{TESTDATA}/sf0.001"), path)
    yield read_stage(spark, path)
    folder.delete()


@pytest.fixture()
def built(spark, tmp_path):
    """Build all tables from hand-written records; returns a reader by table name."""

    def build(records, **options):
        stage = frame_of(spark, records)
        dims, facts = f"{tmp_path}/dims", f"{tmp_path}/facts"
        jobs.build_all(spark, stage, dims, facts, jobs.BuildOptions(**options))

        def read(table):
            base = facts if table.startswith("FCT") else dims
            return spark.read.parquet(f"{base}/{table}")

        return read

    return build


@pytest.fixture()
def dimension(spark, scratch):
    """One dimension of hand-written records, without the rest of the build."""

    def build(records, table):
        return build_dimension(frame_of(spark, records), SPECS[table], scratch)

    return build


def record(**values):
    """One staging record with every key present; override what the test is about."""
    base = {
        "camis": "1",
        "dba": "Diner",
        "boro": "Bronx",
        "building": "10",
        "street": "Main",
        "zipcode": "10001",
        "bin": "b1",
        "bbl": "l1",
        "nta": "n1",
        "latitude": "40.5",
        "longitude": "-73.5",
        "census_tract": "010300",
        "community_board": "101",
        "council_district": "1",
        "phone": "555",
        "cuisine_description": "Pizza",
        "inspection_date": "2023-01-02",
        "action": "cited",
        "inspection_type": "cycle",
        "grade": "A",
        "grade_date": "2023-01-03",
        "score": "12",
        "critical_flag": "Critical",
        "violation_code": "04A",
        "violation_description": "cold food",
        "record_date": "2023-02-01",
    }
    return {**base, **values}


def tuples(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
