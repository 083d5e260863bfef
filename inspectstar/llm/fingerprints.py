"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text is cut into words (a word of more than ``PIECE`` code points into pieces). Of all
runs of ``K`` words those are kept whose smallest inner run of ``S`` words, by hash, lies
at an edge. Whether a run is kept depends on its own words alone, so texts that share a
passage keep the same runs of it, wherever it stands. Anchors are (position, hash); the
fingerprint lists the hashes in order, and likeness is the Jaccard similarity of two sets
of hashes.

Defined results: null and empty texts have no anchors and the fingerprint ''; a text
without a closed syncmer has one anchor over all its words; equal texts have equal
fingerprints; two texts without anchors have likeness 1, one with and one without 0. Ids are
integers of at most 64 bits, however they are spread; rows of one id, and those without one,
follow each other by a hash of the text, null texts first. A text is cut and hashed as a
whole, at a cost in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspectstar.llm.common import let, wrapped
from inspectstar.operators import null_safe, row_number
from inspectstar.scratch import Scratch

K, S = 5, 2
PIECE = 16
#: Documents of a range of ids that one task puts in order.
RANGE_ROWS = 2048
#: A range of more than this many times as many is cut again.
UNEVEN = 4


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<pos, hash>>: the closed syncmers of ``text`` in order."""
    words = F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0)
    )
    inner = k - s + 1  # runs of s words in a run of k words

    def anchor(start: Column, hashes: Column) -> Column:
        return F.struct(start.alias("pos"), F.xxhash64(hashes).alias("hash"))

    def closed(hashes: Column, small: Column) -> Column:
        def at_edge(i: Column) -> Column:
            return F.least(F.get(small, i), F.get(small, i + (inner - 1))) <= F.array_min(
                F.slice(small, i + 1, inner)
            )

        starts = F.filter(F.sequence(F.lit(0), F.size(hashes) - k), at_edge)
        return F.transform(starts, lambda i: anchor(i, F.slice(hashes, i + 1, k)))

    def all_anchors(hashes: Column) -> Column:
        small = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - s),
            lambda i: F.xxhash64(F.slice(hashes, i + 1, s)),
        )
        whole = F.array(anchor(F.lit(0), hashes))
        return (
            F.when(F.size(hashes) == 0, F.slice(whole, 1, 0))
            .when(F.size(hashes) < k, whole)
            .otherwise(
                let(
                    let(small, lambda runs: closed(hashes, runs)),
                    lambda found: F.when(F.size(found) > 0, found).otherwise(whole),
                )
            )
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), all_anchors)


def fingerprint(hashes: Column) -> Column:
    """The hashes in order, eight hex digits each."""
    return F.array_join(
        F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h.bitwiseAND(0xFFFFFFFF)), 8, "0"))), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes, as sets."""

    def of(sets: Column) -> Column:
        left, right = sets["left"], sets["right"]
        return let(
            F.size(F.array_intersect(left, right)),
            lambda both: F.when((F.size(left) == 0) & (F.size(right) == 0), 1.0).otherwise(
                both / (F.size(left) + F.size(right) - both)
            ),
        )

    sets = F.struct(F.array_distinct(a).alias("left"), F.array_distinct(b).alias("right"))
    return let(sets, of)


def _tie(text: Column) -> Column:
    """The place of a text among the rows of one id."""
    return F.when(text.isNull(), F.lit(-(2**63))).otherwise(F.xxhash64(text))


def _cell(key: Column, low: Column, width: Column) -> Column:
    """The lowest id of the cell that ``key`` falls into; differences may exceed 63 bits."""
    key, low, width = (c.cast("decimal(20,0)") for c in (key, low, width))
    return (low + F.call_function("div", key - low, width) * width).cast("long")


def ranges(keys: DataFrame, scratch: Scratch, range_rows: int = RANGE_ROWS) -> Callable:
    """A function that adds ``range``, a number that ascends with (id, tie), to a frame.

    Its arguments are a frame, its id and its text. ``keys`` (doc_id, text) are counted in cells
    of even width first. Cells that hold too many ids are cut again between the smallest
    and the largest id they hold, until none does, and rows of a single id by their tie.
    Only identical rows can keep a range large.
    """
    span = keys.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = int(span.low or 0), int(span.high or 0)
    width = max(1, -(-(high - low + 1) * range_rows // max(span.n, 1)))
    levels: list[DataFrame] = []
    ties: list[DataFrame] = []

    def by_id(rows: DataFrame, key: Column) -> DataFrame:
        cell = _cell(key, F.lit(Decimal(low)), F.lit(Decimal(width)))
        rows = rows.withColumn("cell", cell)
        for level in levels:
            rows = rows.join(level, F.col("cell") == F.col("hot cell"), "left")
            finer = _cell(key, F.col("hot low"), F.col("hot width"))
            rows = rows.withColumn("cell", F.coalesce(finer, "cell")).drop(*level.columns)
        return rows

    def place(rows: DataFrame, key: Column, text: Column) -> DataFrame:
        rows = by_id(rows, key).withColumn("part", F.lit(0).cast("long"))
        for single in ties:
            rows = rows.join(single, F.col("cell").eqNullSafe(F.col("hot cell")), "left")
            share = (F.shiftright(_tie(text), 32) + F.lit(2**31)) * F.col("hot parts")
            part = F.when(F.col("hot parts").isNotNull(), F.shiftright(share, 32)).otherwise(F.col("part"))
            rows = rows.withColumn("part", part).drop(*single.columns)
        # One number, never null: what is dealt by it can be joined by it without a shuffle.
        cell = F.coalesce(F.col("cell").cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1)))
        number = (cell * F.lit(Decimal(2**32)) + F.col("part")).cast("decimal(38,0)")
        return rows.withColumn("range", number).drop("cell", "part")

    while True:
        sizes = by_id(keys.select("doc_id"), F.col("doc_id")).groupBy("cell").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
        )
        hot = scratch.keep(sizes.where(F.col("n") > UNEVEN * range_rows), "hot-cells")
        wide = hot.where("low < high")
        if wide.isEmpty():
            break
        ids = F.col("high").cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)") + 1
        # More than UNEVEN ranges are wanted of a cell, so its parts are narrower than itself.
        share = F.call_function("div", ids * range_rows + F.col("n") - 1, F.col("n").cast("decimal(20,0)"))
        levels.append(
            wide.select(
                F.col("cell").alias("hot cell"), F.col("low").alias("hot low"),
                F.greatest(share, F.lit(1)).alias("hot width"),
            )
        )
    if not hot.isEmpty():
        parts = F.ceil(F.col("n") / range_rows).alias("hot parts")
        ties.append(hot.select(F.col("cell").alias("hot cell"), parts))
    return place


def with_next(docs: DataFrame, scratch: Scratch, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc, hashes, next_text, next_hashes): each row and the next by doc_id, then tie.

    After the last row comes the first. Null ids come first. A task orders a range of ids
    and gets the head of the following one from a small table.
    """
    place = ranges(docs.select("doc_id", "text"), scratch, range_rows)
    texts = place(docs.select("doc_id", "text"), F.col("doc_id"), F.col("text"))

    # One row per range: its first id, and the range after it.
    here = texts.groupBy("range").agg(F.min("doc_id").alias("head"))
    numbered = scratch.keep(row_number(here, ["range"], "number", scratch), "ranges")
    before = numbered.select(
        F.col("range").alias("for range"),
        (F.col("number") % F.lit(max(numbered.count(), 1)) + 1).alias("following"),
    )
    following = numbered.join(before, F.col("number") == F.col("following"))
    following = scratch.keep(following.withColumnRenamed("range", "next range"), "following-heads")
    same = [("range", "next range"), ("doc_id", "head")]
    firsts = texts.join(following, null_safe(same))
    # min() of a struct keeps a null text as the smallest, as the order below does.
    head_texts = firsts.groupBy("for range").agg(
        F.min(F.struct(_tie(F.col("text")).alias("tie"), "text")).alias("first")
    )
    head_texts = head_texts.select("for range", F.struct("first.text").alias("head"))
    head_texts = scratch.keep(head_texts, "head-texts")

    placed = place(wrapped(docs), F.col("doc.doc_id"), F.col("doc.text"))
    dealt = placed.repartition("range").withColumn("hashes", anchors(F.col("doc.text"))["hash"])
    inside = Window.partitionBy("range").orderBy("doc.doc_id", _tie(F.col("doc.text")), "doc.text")
    led = dealt.withColumn("next", F.lead(F.struct("doc.text", "hashes")).over(inside))
    led = led.join(head_texts, F.col("range") == F.col("for range"), "left")
    last = F.col("next").isNull()
    return led.select(
        "doc",
        "hashes",
        F.when(last, F.col("head.text")).otherwise(F.col("next.text")).alias("next_text"),
        F.when(last, anchors(F.col("head.text"))["hash"])
        .otherwise(F.col("next.hashes"))
        .alias("next_hashes"),
    )
