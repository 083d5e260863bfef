"""Mixing sources to target weights.

The words of every source are summed, the target words of each source follow from the
weights, and target / words is the source's repetition rate. A document is emitted
floor(rate) times, and once more if a hash of (seed, doc_id, text) falls below the
fraction, so a rerun, a retried task or another partitioning takes the same copies.

Defined results: a null text has size 0; a null source is a source of its own; a source
without words has target 0 and gives no copies; identical rows draw alike; an empty table
gives an empty mix. Only ``doc_id``, ``text`` and ``source`` are read; further columns,
whatever their names, are carried along by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspectstar.llm.common import WORD, unwrapped, wrapped
from inspectstar.scratch import Scratch

CYCLE = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """Weights by the position of a source in code point order, null last."""
    # One row per source of the mixture, so one task is enough to number them.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", F.get(weights, place % len(cycle)).alias("weight"))


def targets(totals: DataFrame, weights: DataFrame, share: float, most: float) -> DataFrame:
    """(source, source_size, target): shares by weight, none above ``most`` times its size.

    In ascending order of limit / weight, a source is at its limit exactly if its share of
    what the sources before it leave over reaches the limit; the rest share by weight.
    """
    known = weights.select(F.col("source").alias("key"), "weight")
    sources = totals.join(known, F.col("source").eqNullSafe(F.col("key"))).drop("key")
    # One row per source again.
    every = Window.partitionBy(F.lit(1))
    order = every.orderBy("limit_ratio")
    before = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        sources.withColumn("most", F.col("source_size") * F.lit(most))
        .withColumn("limit_ratio", F.col("most") / F.col("weight"))
        .withColumn("goal", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("total_weight", F.sum("weight").over(every))
        .withColumn("same_most", F.sum("most").over(Window.partitionBy("limit_ratio")))
        .withColumn("same_weight", F.sum("weight").over(Window.partitionBy("limit_ratio")))
        .withColumn("left", F.col("goal") - (F.sum("most").over(before) - F.col("same_most")))
        .withColumn(
            "open_weight",
            F.col("total_weight") - (F.sum("weight").over(before) - F.col("same_weight")),
        )
        .withColumn(
            "full", F.col("left") * F.col("weight") / F.col("open_weight") >= F.col("most")
        )
    )
    full_most = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(every)
    open_target = (F.col("goal") - full_most) * F.col("weight") / open_weight
    target = F.when(F.col("full"), F.col("most")).otherwise(open_target)
    return rows.select("source", "source_size", target.alias("target"))


def draw(
    docs: DataFrame,
    scratch: Scratch,
    weights: DataFrame | None = None,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(doc, size, source_size, target, copies): every document and how often it is taken.

    ``weights`` has (source, weight) for the sources of the mixture; without it they weigh
    5, 2, 1 in turn. Sources that it leaves out are not taken.
    """
    sized = wrapped(docs).withColumn("size", text_size(F.col("doc.text")))
    totals = (
        sized.groupBy(F.col("doc.source").alias("source"))
        .agg(F.sum("size").alias("source_size"))
        .transform(lambda df: scratch.keep(df, "source-sizes"))
    )
    weights = cycle_weights(totals) if weights is None else weights
    # Written, so that Spark knows its size and broadcasts it only if it is small.
    rates = scratch.keep(targets(totals, weights, share, most), "targets")
    identity = F.concat_ws(
        "|",
        F.lit(seed),
        F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")),
        F.coalesce(F.col("doc.text"), F.lit("")),
    )
    chance = F.conv(F.substring(F.md5(identity.cast("binary")), 1, 13), 16, 10).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = chance / F.lit(float(16**13)) < rate - F.floor(rate)
    copies = F.floor(rate) + F.when(extra, 1).otherwise(0)
    return sized.join(rates, F.col("doc.source").eqNullSafe(F.col("source")), "left").select(
        "doc",
        "size",
        "source_size",
        "target",
        F.coalesce(copies, F.lit(0)).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mixture: rows of ``docs``, each as often as it is taken."""
    drawn = draw(docs, scratch, **options).where("copies > 0")
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return unwrapped(drawn.select("doc", repeated.alias("copy")))
