"""Joins whose hot keys are cut into a grid of cells instead of landing in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """How much one task or one broadcast may be given.

    ``rows_per_task`` bounds the rows of one key in a lookup, ``pairs_per_task`` the output
    of one task in a many-to-many join: about 128 MB of fact rows. Both grow where more
    than ``hot_keys`` keys would exceed them, so the list of hot keys, which is broadcast,
    has a fixed size whatever the data. An output of more than ``full_tasks`` such tasks gives
    each task more, up to ``most_pairs_per_task``: its files grow before their number does.
    """

    broadcast_bytes: int = 32 * 1024 * 1024
    rows_per_task: int = 2_000_000
    pairs_per_task: int = 1_000_000
    most_pairs_per_task: int = 32_000_000
    full_tasks: int = 400
    hot_keys: int = 10_000

    def share(self, pairs: int) -> int:
        """The pairs of one task, of ``pairs`` in all."""
        wanted = min(-(-pairs // self.full_tasks), self.most_pairs_per_task)
        return max(wanted, self.pairs_per_task)


#: Rows that a task of ``distinct_rows`` takes in, about; over how many parts a key is dealt.
DISTINCT_ROWS = 1_000_000
DEALS = 16


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``rows.distinct()`` of a stored table, whose tasks hold a bounded number of rows.

    A stored table of few bytes a row has many rows in a scan's task, each of which would get its
    place in that task's hash table. The rows are dealt to smaller tasks first, by a hash of
    their values and a number from 0 to ``DEALS``, so that repeats mostly meet there and a row
    that fills the table still has several tasks. The table is counted from its footers.
    """
    tasks = -(-rows.count() // DISTINCT_ROWS)
    if tasks <= 1:
        return rows.distinct()
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(DEALS)).alias("__deal")
    dealt = rows.select("*", deal).repartition(tasks, *rows.columns, "__deal")
    return dealt.drop("__deal").distinct()


def null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality on every pair of columns, NULL matching NULL."""
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs))


def hot_keys(
    rows: DataFrame, keys: Sequence[str], rows_per_task: int, most: int = Limits.hot_keys
) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of parts to cut each into.

    Of a larger table a task gets more rows: no more than ``most`` keys can qualify, so the
    result can be broadcast. ``rows`` is a stored table, which is counted from its footers.
    """
    rows_per_task = max(rows_per_task, -(-rows.count() // most))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    parts = F.ceil(F.col("__rows") / rows_per_task).cast("int")
    hot = counted.where(F.col("__rows") > rows_per_task)
    return hot.select(*keys, parts.alias("left_parts"), F.lit(1).alias("right_parts"))


def _cells(
    df: DataFrame, keys: Sequence[str], hot: DataFrame, row_id: str, own: str, other: str
) -> DataFrame:
    """Give each row of a hot key one part of its ``own`` side and all parts of the other."""
    marks = hot.select(
        *[F.col(k).alias(f"__hot{i}") for i, k in enumerate(hot.columns[: len(keys)])],
        F.col(own).alias("__own"),
        F.col(other).alias("__other"),
    )
    is_hot = null_safe([(k, f"__hot{i}") for i, k in enumerate(keys)])
    marked = df.join(F.broadcast(marks), is_hot, "left")
    part = F.pmod(F.xxhash64(row_id), F.coalesce("__own", F.lit(1)))
    copies = F.sequence(F.lit(0), F.coalesce("__other", F.lit(1)) - 1)
    return marked.select(
        *df.columns, part.cast("int").alias(f"__{own}"), F.explode(copies).alias(f"__{other}")
    )


def _join_columns(keys: Sequence[str], prefix: str) -> dict[str, Column]:
    """Key and cell as columns that are never NULL, so that plain equality joins them."""
    columns: dict[str, Column] = {}
    for i, key in enumerate(keys):
        columns[f"{prefix}{i}"] = F.coalesce(F.col(key).cast("string"), F.lit(""))
        columns[f"{prefix}{i}_missing"] = F.col(key).isNull()
    for part in ("left_parts", "right_parts"):
        columns[f"{prefix}_{part}"] = F.col(f"__{part}")
    return columns


def _least_tasks(spark: SparkSession) -> int:
    """The number that Spark raises smaller numbers of join tasks to."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first or 0))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    hot: DataFrame,
    left_id: str,
    right_id: str,
    tasks: int | None = None,
) -> DataFrame:
    """Inner null-safe equi-join of two large sides with hot keys.

    ``hot`` names the hot keys (its first columns, in the order of ``on``) with
    ``left_parts`` and ``right_parts``. A left row goes to one left part and is copied to
    every right part, a right row the other way round, so each matching pair meets in
    exactly one cell. The parts follow a hash of ``left_id`` / ``right_id``, which should be
    unique per row; nothing is random, so a recomputed task places its rows as before.

    ``tasks`` fixes the number of join tasks. Many-to-many joins need it: left to itself
    Spark merges small cells by the size of what goes in, whatever comes out.
    The two sides must have no column name in common.
    """
    sides = []
    for df, keys, row_id, own, other, prefix in (
        (left, list(on), left_id, "left_parts", "right_parts", "__l"),
        (right, list(on.values()), right_id, "right_parts", "left_parts", "__r"),
    ):
        cells = _cells(df, keys, hot, row_id, own, other)
        columns = _join_columns(keys, prefix)
        cells = cells.withColumns(columns).drop("__left_parts", "__right_parts")
        sides.append((cells if tasks is None else cells.repartition(tasks, *columns), columns))
    (cut_left, left_columns), (cut_right, right_columns) = sides
    same = (F.col(a) == F.col(b) for a, b in zip(left_columns, right_columns))
    joined = cut_left.join(cut_right, reduce(and_, same), "inner")
    joined = joined.drop(*left_columns, *right_columns)
    if tasks is None or tasks >= _least_tasks(left.sparkSession):
        return joined
    # Spark raises a small number of tasks to that of shuffle partitions; take it back. A larger
    # number stays, and what follows the join is compiled with it: no row is copied in between.
    return joined.coalesce(tasks)


def group_pairs(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """One row per key on both sides: ``left_rows`` and ``right_rows``."""
    mine = left.groupBy(*on).agg(F.count(F.lit(1)).alias("left_rows"))
    theirs = right.groupBy(*[F.col(r).alias(f"__key{i}") for i, r in enumerate(on.values())])
    theirs = theirs.agg(F.count(F.lit(1)).alias("right_rows"))
    keys = {k: f"__key{i}" for i, k in enumerate(on)}
    return mine.join(theirs, null_safe(list(keys.items())), "inner").drop(*keys.values())


def _pairs() -> Column:
    return F.col("left_rows").cast("double") * F.col("right_rows")


def count_pairs(groups: DataFrame) -> int:
    return int(groups.agg(F.sum(_pairs())).first()[0] or 0)


def hot_groups(
    groups: DataFrame, on: Mapping[str, str], pairs: int, limits: Limits
) -> DataFrame:
    """Groups with more pairs than one task should emit, cut to cells of about that many."""
    share = max(limits.share(pairs), -(-pairs // limits.hot_keys))
    side = int(share**0.5)
    return groups.where(_pairs() > share).select(
        *on,
        F.ceil(F.col("left_rows") / side).cast("int").alias("left_parts"),
        F.ceil(F.col("right_rows") / side).cast("int").alias("right_parts"),
    )


def join_groups(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    groups: DataFrame,
    left_id: str,
    right_id: str,
    limits: Limits,
) -> DataFrame:
    """All pairs of rows with equal keys, NULL matching NULL; many to many.

    ``groups`` is the stored result of ``group_pairs``, so the size of the output is known
    beforehand. It alone sets the number of tasks, and hot groups are cut into cells.
    """
    pairs = count_pairs(groups)
    shares = math.ceil(pairs / limits.share(pairs))
    hot = hot_groups(groups, on, pairs, limits)
    # Cells fall into tasks by hash: leave some room.
    return spread_join(left, right, on, hot, left_id, right_id, tasks=max(1, 2 * shares))
