"""Dense keys and running totals against the one-task window they replace."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from inspectstar.operators import as_key, assign_key, dense_running_total, numbering, row_number
from inspectstar.scratch import Scratch
from tests.conftest import TESTDATA, tuples

ORDER = ["o_orderstatus", "o_orderdate", "o_orderkey"]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{TESTDATA}/sf0.01/orders.parquet").select(*ORDER)


@pytest.fixture()
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"

    def use(count):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        spark.conf.set(coalesce, "false")

    yield use
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset(coalesce)


@pytest.mark.parametrize("count", [1, 7, 64])
def test_row_number_equals_window(orders, scratch, partitions, count):
    partitions(count)
    got = row_number(orders, ORDER, "n", scratch)
    want = orders.withColumn("n", F.row_number().over(Window.orderBy(*ORDER)).cast("long"))
    assert got.exceptAll(want).isEmpty()
    assert got.count() == want.count()


@pytest.mark.parametrize("count", [1, 7, 64])
def test_running_total_equals_window(orders, scratch, partitions, count, monkeypatch):
    partitions(count)
    monkeypatch.setattr(numbering, "BLOCK_KEYS", 700)
    numbered = row_number(orders, ORDER, "n", scratch)
    group = F.nullif("o_orderstatus", F.lit("P")).alias("g")
    weighted = numbered.select(group, "n", (F.col("o_orderkey") % 5).alias("w"))
    order = [F.col("g").asc_nulls_first(), "n"]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = weighted.withColumn("t", F.coalesce(F.sum("w").over(earlier), F.lit(0)))
    got = dense_running_total(weighted, "g", "n", "w", "t", scratch)
    assert got.exceptAll(want).isEmpty()
    assert got.count() == want.count()


def test_many_partitions_are_really_used(spark, orders, scratch, partitions):
    partitions(16)
    row_number(orders, ORDER, "n", scratch)
    placed = spark.read.parquet(f"{scratch.root}/000-placed")
    assert placed.select(F.shiftright("__place", 33)).distinct().count() > 8


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.sets(
        st.tuples(
            st.one_of(st.none(), st.text("ab", max_size=2)),
            st.one_of(st.none(), st.integers(0, 5)),
        ),
        max_size=25,
    )
)
def test_keys_are_dense_and_nulls_first(spark, rows):
    df = spark.createDataFrame(list(rows), "a string, b int").repartition(4)
    with Scratch(spark) as scratch:
        got = {(r.a, r.b): r.k for r in assign_key(df, ["a", "b"], "k", scratch).collect()}
    ordered = sorted(
        rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)
    )
    assert got == {row: i + 1 for i, row in enumerate(ordered)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_int_keys_never_wrap(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        limit = spark.createDataFrame([(2**31 - 1,)], "n long")
        assert limit.select(as_key(F.col("n")).alias("k")).first().k == 2**31 - 1
        beyond = spark.createDataFrame([(2**31,)], "n long")
        with pytest.raises(Exception, match="bigint"):
            beyond.select(as_key(F.col("n"))).collect()
        assert beyond.select(as_key(F.col("n"), "bigint").alias("k")).first().k == 2**31
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_bigint_keys(spark, scratch):
    df = assign_key(spark.range(3), ["id"], "SK", scratch, "bigint")
    assert dict(df.dtypes)["SK"] == "bigint"
    assert tuples(df) == [(0, 1), (1, 2), (2, 3)]
