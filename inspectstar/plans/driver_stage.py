"""A staging table derived from an order-processing star schema.

Customers play the inspected places, orders the visits and line items the violations. NULL
keys, shared phones and addresses with several candidates are planted on the way. Money and
quantities pass through ``decimal(12,2)`` so that they print alike everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectstar.schema import STAGE_COLUMNS


def _text(column: Column) -> Column:
    return column.cast("string")


def _money(column: Column) -> Column:
    return _text(column.cast("decimal(12,2)"))


def _day(column: str) -> Column:
    return _text(F.col(column).cast("date"))


def _unless_divisible(divisor: int, value: Column) -> Column:
    return F.when(F.col("c_custkey") % divisor != 0, value)


def derive_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging rows of the star tables in ``sf_dir``, one per line item.

    No join is hinted: Spark broadcasts a side only if its file size allows. Unused columns
    leave the scans by pruning.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    place = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    # Places join the orders, of which there are fewer, so line items are shuffled once less.
    visits = table("orders").join(place, F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(visits, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    custkey, nation = F.col("c_custkey"), F.col("c_nationkey")
    balance = F.col("c_acctbal")
    anonymous = (F.col("l_linenumber") == 1) | (custkey % 23 == 0)
    values = {
        "camis": _unless_divisible(29, _text(custkey)),
        "dba": F.when(~anonymous, F.col("c_name")),
        "boro": F.nullif("r_name", F.lit("ASIA")),
        "building": _text(custkey % 50),
        "street": F.col("n_name"),
        "zipcode": _text(10000 + nation),
        "bin": _unless_divisible(11, _text(custkey % 40)),
        "bbl": _unless_divisible(11, _text(custkey % 13)),
        "nta": F.col("c_mktsegment"),
        "latitude": _money(balance),
        "longitude": _money(-balance),
        "census_tract": F.lpad(_text(nation * 100), 6, "0"),
        "community_board": _text(100 + nation % 5),
        "council_district": _text(nation),
        "phone": _unless_divisible(17, _text(custkey % 97)),
        "cuisine_description": F.col("p_type"),
        "inspection_date": _day("o_orderdate"),
        "action": F.col("o_orderstatus"),
        "inspection_type": F.col("o_orderpriority"),
        "grade": F.nullif("l_returnflag", F.lit("N")),
        "grade_date": _day("l_shipdate"),
        "score": _money(F.col("l_quantity")),
        "critical_flag": F.col("l_linestatus"),
        "violation_code": F.nullif("p_brand", F.lit("Brand#11")),
        "violation_description": F.col("p_name"),
        "record_date": _day("o_orderdate"),
    }
    return rows.select(*[values[name].alias(name) for name in STAGE_COLUMNS])
