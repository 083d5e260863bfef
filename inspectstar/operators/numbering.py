"""Dense numbering and running totals over a whole table, without a one-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here the table is
range-sorted in parallel and written once with each row's place: the sorted partition it
is in and its position there. A total per partition (one row per task) turns places into
global positions through a broadcast no larger than the number of sort partitions.

The order must be total. It is then independent of partition counts and of retries, and the
range sampling balances partitions even if a leading column holds one value throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspectstar.scratch import Scratch

# monotonically_increasing_id() documents its layout: partition in the upper bits, position
# within the partition in the lower 33.
_POSITION_BITS = 33

#: The largest ``int`` key.
MOST_INT_KEYS = 2**31 - 1

#: Keys of a block in ``dense_running_total``.
BLOCK_KEYS = 1_000_000

def _part() -> Column:
    return F.shiftright("__place", _POSITION_BITS)


def _position() -> Column:
    return F.col("__place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def _placed(df: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return scratch.keep(ordered.withColumn("__place", F.monotonically_increasing_id()), "placed")


def _with_offset(placed: DataFrame, amount: Column) -> DataFrame:
    """Add ``__part`` and ``__offset``: the total of ``amount`` over all earlier partitions."""
    totals = placed.groupBy(_part().alias("__part")).agg(amount.alias("__total"))
    # One row per sort partition, so this ordered window is small by construction.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset")
    )
    return placed.withColumn("__part", _part()).join(F.broadcast(offsets), "__part")


def row_number(df: DataFrame, order: Sequence[str], name: str, scratch: Scratch) -> DataFrame:
    """Add ``name``: 1..n (long) in ascending ``order``, NULLs first."""
    return _numbered(_placed(df, order, scratch), name)


def _numbered(placed: DataFrame, name: str) -> DataFrame:
    placed = _with_offset(placed, F.count(F.lit(1)))
    number = F.col("__offset") + _position() + F.lit(1)
    return placed.withColumn(name, number).drop("__place", "__part", "__offset")


def dense_running_total(
    df: DataFrame, group: str, key: str, amount: str, name: str, scratch: Scratch
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows earlier in the order (group, key).

    ``key`` is dense, so blocks of it hold about as many rows each and nothing need be sorted
    or sampled to find them; groups are few.
    """
    part = F.struct(F.col(group), F.floor(F.col(key) / BLOCK_KEYS).alias("block"))
    blocks = scratch.keep(df.withColumn("__part", part), "blocks")
    totals = blocks.groupBy("__part").agg(F.sum(amount).alias("__total"))
    # One row per block of a group: small, as above.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("__part").alias("__block"),
        F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"),
    )
    earlier = (
        Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    # Written, so that Spark broadcasts the offsets only if they are small.
    offsets = scratch.keep(offsets, "offsets")
    summed = blocks.withColumn("__within", within).join(offsets, F.col("__part") == F.col("__block"))
    total = summed.withColumn(name, F.col("__offset") + F.col("__within"))
    return total.drop("__part", "__block", "__offset", "__within")


def check_keys(count: int, key_type: str) -> None:
    """Refuse to number more rows than ``key_type`` holds, before anything is overwritten."""
    if key_type == "int" and count > MOST_INT_KEYS:
        raise ValueError(f"{count} rows are more than int keys can number: use bigint keys")


def narrowest_key(count: int) -> str:
    """The type that numbers ``count`` rows: ``int`` while they fit, else ``bigint``."""
    return "int" if count <= MOST_INT_KEYS else "bigint"


def as_key(number: Column, key_type: str = "int") -> Column:
    """A row number as a surrogate key.

    A table that outgrows ``int`` must be built with ``key_type="bigint"``. It fails here
    otherwise, even where the session would let the cast wrap around.
    """
    if key_type != "int":
        return number.cast(key_type)
    too_large = F.raise_error(F.lit("more rows than an int key can number: use bigint keys"))
    return F.when(number <= F.lit(2**31 - 1), number.cast("int")).otherwise(too_large)


def assign_key(
    df: DataFrame, order: Sequence[str], name: str, scratch: Scratch, key_type: str = "int"
) -> DataFrame:
    """Add a dense surrogate key: 1..n in ascending ``order``, NULLs first."""
    placed = _placed(df, order, scratch)
    check_keys(placed.count(), key_type)
    numbered = _numbered(placed, "__number")
    return numbered.withColumn(name, as_key(F.col("__number"), key_type)).drop("__number")
