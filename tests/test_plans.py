"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from inspectstar import schema as names
from inspectstar.operators import Limits, distinct_rows
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import SPECS, build_dimension, members
from inspectstar.plans.inspections import build_inspections, inspection_rows
from inspectstar.plans.violations import build_violations, violation_rows
from inspectstar.scratch import Scratch


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def star(spark, small_stage):
    scratch = Scratch(spark)
    base = scratch.path("dims")
    jobs.write_dimensions(spark, small_stage, base)
    dims = jobs.read_dimensions(spark, base, SPECS)
    inspections = scratch.keep(build_inspections(small_stage, dims, scratch), "inspections")
    yield dims, inspections
    scratch.delete()


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_bytes=0)])
def test_no_nested_loops(spark, small_stage, star, scratch, limits):
    dims, inspections = star
    for df in (
        inspection_rows(small_stage, dims, scratch, limits),
        violation_rows(small_stage, dims, scratch, limits),
        build_violations(small_stage, dims, inspections, scratch, limits),
    ):
        plan = plan_of(df)
        assert "NestedLoop" not in plan
        assert "CartesianProduct" not in plan


def test_single_partition_only_for_partition_totals(small_stage, star, scratch):
    """One-task exchanges carry per-partition totals, never rows of a table."""
    dims, inspections = star
    for df in (
        build_dimension(small_stage, SPECS[names.ADDRESSES], scratch),
        build_inspections(small_stage, dims, scratch),
        build_violations(small_stage, dims, inspections, scratch),
    ):
        plan = plan_of(df)
        one_task = r"Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: SinglePartition"
        singles = re.findall(one_task, plan)
        assert singles
        assert all("__part" in s and "__total" in s and s.count("#") == 2 for s in singles)


@pytest.mark.parametrize("limits", [Limits(), Limits(pairs_per_task=1000)])
def test_violations_are_not_grouped_or_sorted_after_the_join(small_stage, star, scratch, limits):
    dims, inspections = star
    plan = plan_of(build_violations(small_stage, dims, inspections, scratch, limits))
    tree = plan[: plan.index("\n\n(1)")].splitlines()
    above_join = tree[: next(i for i, line in enumerate(tree) if "Join" in line)]
    assert not re.search("Aggregate|Sort|Exchange|Window", "\n".join(above_join))


def test_scans_are_pruned_and_filtered(small_stage, star, scratch):
    dims, _ = star
    plan = plan_of(inspection_rows(small_stage, dims, scratch))
    scan = re.search(r"PushedFilters: \[IsNotNull\(camis\)\]\nReadSchema: struct<(.*?)>", plan)
    assert len(scan.group(1).split(",")) == 8
    plan = plan_of(members(small_stage, SPECS[names.FOOD_PLACES]))
    assert "PushedFilters: [IsNotNull(camis)]\nReadSchema: struct<camis:string,dba:string>" in plan
    plan = plan_of(members(small_stage, SPECS[names.CUISINE]))
    assert "ReadSchema: struct<cuisine_description:string>" in plan


def test_place_dimension_has_no_self_join(small_stage):
    plan = plan_of(members(small_stage, SPECS[names.FOOD_PLACES]))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "Join" not in plan


def test_borough_folders_prune(spark, small_stage, tmp_path):
    jobs.write_dimensions(spark, small_stage, str(tmp_path), tables=[names.ADDRESSES])
    addresses = jobs.read_dimensions(spark, str(tmp_path), [names.ADDRESSES])[names.ADDRESSES]
    plan = plan_of(addresses.where("BOROUGH = 'EUROPE'"))
    assert re.search(r"PartitionFilters: \[.*BOROUGH.* = EUROPE", plan)


def test_large_outputs_fix_the_number_of_join_tasks(small_stage, star, scratch):
    """Both sides are dealt to the same tasks once, and the join adds no exchange of its own."""
    dims, inspections = star
    limits = Limits(pairs_per_task=1000)
    plan = plan_of(build_violations(small_stage, dims, inspections, scratch, limits))
    dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt == ["40", "40"]  # 19,878 pairs, 1000 per task, twice the tasks
    assert not re.search(r"hashpartitioning\(__[lr]0.*ENSURE_REQUIREMENTS", plan)


def test_distinct_rows_are_dealt_to_bounded_tasks(small_stage, scratch, monkeypatch):
    """The visits of a stored table pass an exchange of their own before they are grouped."""
    rows = small_stage.select("camis", "boro", "phone", "bin")
    want = sorted(map(repr, rows.distinct().collect()))
    for most, exchanges in ((1_000_000, 1), (500, 2)):
        monkeypatch.setattr("inspectstar.operators.skew.DISTINCT_ROWS", most)
        got = distinct_rows(rows)
        assert sorted(map(repr, got.collect())) == want
        assert len(re.findall(r"^\(\d+\) Exchange", plan_of(got), re.M)) >= exchanges
    assert re.search(r"hashpartitioning\(.*__deal.*, 12\)", plan_of(got))
