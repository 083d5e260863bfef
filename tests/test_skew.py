"""Cutting hot keys must not change a single row."""

from __future__ import annotations

from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inspectstar import schema as names
from inspectstar.operators import (
    Limits,
    Lookup,
    group_pairs,
    hot_keys,
    join_groups,
    match_all,
    spread_join,
    star_lookup,
)
from inspectstar.operators.skew import _cells
from inspectstar.plans.dimensions import DIMENSIONS, build_dimension
from inspectstar.plans.inspections import (
    address_matches,
    build_inspections,
    inspection_lookups,
)
from inspectstar.plans.violations import all_violations, build_violations
from inspectstar.scratch import Scratch
from tests.conftest import TINY, tuples

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b"]))


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(KEYS, max_size=12), st.lists(KEYS, max_size=12), st.integers(1, 4))
def test_spread_join_equals_brute_force(spark, left_keys, right_keys, parts):
    left = spark.createDataFrame(list(enumerate(left_keys)), "l long, x string")
    right = spark.createDataFrame(list(enumerate(right_keys)), "r long, y string")
    hot = spark.createDataFrame(
        [(None, parts, 2), ("a", 3, parts)], "x string, left_parts int, right_parts int"
    )
    joined = spread_join(left, right, {"x": "y"}, hot, "l", "r")
    want = sorted(
        (i, j)
        for (i, a), (j, b) in product(enumerate(left_keys), enumerate(right_keys))
        if a == b
    )
    assert tuples(joined, "l", "r") == want


def test_hot_keys(spark):
    rows = spark.createDataFrame([(None,)] * 7 + [("a",)] * 3 + [("b",)], "k string")
    assert tuples(hot_keys(rows, ["k"], 2)) == [(None, 4, 1), ("a", 2, 1)]


def test_the_list_of_hot_keys_is_bounded(spark):
    """With more rows a key needs more of them to be hot."""
    rows = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert hot_keys(rows, ["k"], 2, most=10).count() == 0
    assert hot_keys(rows, ["k"], 2, most=100_000).count() == 1000


def test_cells_hold_an_even_share(spark):
    """A row of a hot key takes one part of its own side and every part of the other."""
    rows = spark.range(10_000).select("id", F.lit("hot").alias("k"))
    hot = spark.createDataFrame([("hot", 20, 3)], "k string, left_parts int, right_parts int")
    cells = _cells(rows, ["k"], hot, "id", "left_parts", "right_parts")
    sizes = cells.groupBy("__left_parts", "__right_parts").count().collect()
    assert {(r[0], r[1]) for r in sizes} == set(product(range(20), range(3)))
    assert max(r[2] for r in sizes) < 1.3 * 10_000 / 20


def test_hot_rows_spread_over_all_parts(spark, scratch):
    """A key holding most rows, all of them identical, is cut evenly."""
    rows = spark.range(1000).select(F.lit("hot").alias("k")).repartition(4)
    dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "K2 string, SK int")
    limits = Limits(broadcast_bytes=0, rows_per_task=100)
    found = star_lookup(rows, [Lookup(dim, {"k": "K2"}, ("SK",))], scratch, limits)
    assert tuples(found.distinct()) == [("hot", 1)]
    assert found.count() == 1000


def _all_tables(spark, stage, limits):
    """Both facts and their lookups under ``limits``, as sets of rows."""
    scratch = Scratch(spark)
    dims = {
        spec.table: scratch.keep(build_dimension(stage, spec, scratch), "dim")
        for spec in DIMENSIONS
    }
    inspections = scratch.keep(build_inspections(stage, dims, scratch, limits), "inspections")
    violations = build_violations(stage, dims, inspections, scratch, limits)
    rows = stage.select("camis", "boro", "bin", "bbl", "zipcode", "cuisine_description")
    resolved = star_lookup(rows, inspection_lookups(dims, scratch), scratch, limits)
    pairs = all_violations(stage, dims, inspections, scratch, limits)
    places = stage.select("camis", "bin", "bbl", "zipcode")
    addresses = match_all(places, address_matches(dims[names.ADDRESSES]), "ADDRESS_SK", scratch, limits)
    return [
        inspections.drop(*names.AUDIT_COLUMNS),
        violations.drop(*names.AUDIT_COLUMNS),
        resolved,
        pairs,
        addresses,
    ]


@pytest.fixture(scope="module")
def plain_tables(spark, small_stage):
    return [df.persist() for df in _all_tables(spark, small_stage, Limits())]


@pytest.mark.parametrize("limits", [TINY, Limits(broadcast_bytes=0)], ids=["hot", "large"])
def test_limits_change_no_result(spark, small_stage, plain_tables, limits):
    for plain, cut in zip(plain_tables, _all_tables(spark, small_stage, limits)):
        assert plain.columns == cut.columns
        cut.persist()
        assert plain.count() == cut.count()
        assert plain.exceptAll(cut).isEmpty()
        cut.unpersist()


def test_a_third_of_all_rows_in_one_group(spark, scratch):
    """One (date, phone) holds a third of the rows; its pairs are cut into cells."""
    stage = spark.range(900).select(
        F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("camis"),
        F.lit("name").alias("dba"),
        *[F.lit("x").alias(c) for c in ("boro", "building", "street", "zipcode", "bin", "bbl")],
        *[F.lit("x").alias(c) for c in ("nta", "cuisine_description", "critical_flag")],
        *[F.lit("1").alias(c) for c in ("latitude", "longitude", "census_tract")],
        *[F.lit("1").alias(c) for c in ("community_board", "council_district")],
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("phone"),
        F.lit("2023-01-01").alias("inspection_date"),
        *[F.lit("x").alias(c) for c in ("action", "inspection_type", "grade")],
        *[F.lit("x").alias(c) for c in ("grade_date", "score", "record_date")],
        (F.col("id") % 30).cast("string").alias("violation_code"),
        F.lit("text").alias("violation_description"),
    )
    stage = scratch.keep(stage, "stage")
    dims = {
        spec.table: scratch.keep(build_dimension(stage, spec, scratch), "dim")
        for spec in DIMENSIONS
    }
    inspections = scratch.keep(build_inspections(stage, dims, scratch), "inspections")
    fact = build_violations(
        stage, dims, inspections, scratch, Limits(0, rows_per_task=20, pairs_per_task=100)
    )
    hot_places = inspections.where("PHONE is null").count()
    hot_codes = stage.where("phone is null").select("violation_code").distinct().count()
    assert fact.where("PHONE is null").count() == hot_places * hot_codes
    keys = sorted(r[0] for r in fact.select("INSPECTION_VIOLATION_SK").collect())
    assert keys == list(range(1, len(keys) + 1))


def test_share_of_a_task_grows_with_the_output():
    limits = Limits()
    pairs = [0, 1, 10**6, 4 * 10**8, 10**9, 10**10, 10**12]
    shares = [limits.share(n) for n in pairs]
    assert shares[:4] == [1_000_000] * 4  # small outputs keep their many tasks
    assert shares == sorted(shares) and shares[4] == 2_500_000
    assert shares[-1] == limits.most_pairs_per_task
    # Neither fewer tasks for a larger output, nor millions of them.
    tasks = [n / share for n, share in zip(pairs, shares, strict=True)]
    assert tasks == sorted(tasks) and tasks[-1] < 32_000


def test_grown_shares_give_the_same_pairs(spark):
    """Hot groups cut to cells of the least share, and of a larger one, hold the same rows."""
    rows = spark.range(300).selectExpr("id AS l", "if(id < 200, 1, id) AS k")
    other = spark.range(200).selectExpr("id AS r", "if(id < 150, 1, id + 100) AS m")
    groups = group_pairs(rows, other, {"k": "m"})
    found = []
    for limits in (Limits(pairs_per_task=50), Limits(pairs_per_task=50, full_tasks=7, most_pairs_per_task=6_000)):
        pairs = join_groups(rows, other, {"k": "m"}, groups, "l", "r", limits)
        found.append((sorted(map(tuple, pairs.select("l", "r").collect())), pairs.rdd.getNumPartitions()))
    assert found[0][0] == found[1][0]
    assert len(found[0][0]) == 200 * 150 + 50
    assert found[1][1] < found[0][1]


def test_rows_of_many_join_tasks_are_not_copied_again(spark):
    """As many tasks as asked for; only where Spark would raise their number are they merged."""
    rows = spark.range(40).selectExpr("id AS l", "id % 7 AS k")
    other = spark.range(40).selectExpr("id AS r", "id % 7 AS m")
    groups = group_pairs(rows, other, {"k": "m"})
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for pairs_per_task, merged in ((10_000, least > 2), (1, False)):
        limits = Limits(pairs_per_task=pairs_per_task)
        pairs = join_groups(rows, other, {"k": "m"}, groups, "l", "r", limits)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert ("Coalesce" in plan) == merged
        assert pairs.rdd.getNumPartitions() == 2 if merged else pairs.rdd.getNumPartitions() >= least
        assert pairs.count() == sum((-(-(40 - i) // 7)) ** 2 for i in range(7))
