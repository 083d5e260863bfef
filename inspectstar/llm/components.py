"""Connected components of an edge table, by alternating star operations.

Each round points all neighbours of a node at the smallest of them: first the larger ones,
then the smaller ones. Neighbours are never gathered; a minimum per node is aggregated and
joined back, and every round is written, so hot nodes can be split and no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspectstar.scratch import Scratch

MOST_ROUNDS = 50


def _joined(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, least): ``edges`` with the smallest b of their a."""
    least = scratch.keep(edges.groupBy("a").agg(F.min("b").alias("least")), "least")
    return edges.join(least, "a")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node."""
    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = scratch.keep(edges.distinct(), "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _joined(both, scratch).where("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        small = _joined(scratch.keep(large, "large-star"), scratch)
        pairs = F.array(
            F.struct(F.col("a"), F.col("least").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
        )
        small = small.select(F.explode(pairs).alias("e")).select("e.*").where("a != b")
        edges = scratch.keep(small.distinct(), "small-star")
        now = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
