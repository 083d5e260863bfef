"""Repeated passages: seed and extend.

Seeds are winnowed anchors: of every window of ``WIDTH`` words the run of ``SEED`` words
with the smallest hash, the leftmost of equals. Two equal windows choose the same run, so a
passage of ``WIDTH`` words that occurs twice shares at least one seed. Documents meet by
seed; a seed seen once in the corpus cannot lie in a repeat. The others are extended to
both sides, to every window that chose them, and windows are told apart by their whole word
sequence: the first occurrence stays, the words of later ones are repeats. Overlapping
windows join to maximal repeats.

Occurrences of a seed or a window are never paired with each other: a group of m copies
costs m rows, not m * m. Groups are counted and their first member is found by partial
aggregation; the join with the seeds that repeat can be split at hot seeds.

Windows are compared by a 64-bit hash of their words.

Defined results: words are kept unchanged; null and empty texts have no words; texts
shorter than a window stay whole; among rows of one doc_id those with the smaller text hash
come first; identical rows (doc_id and text) are one document and get the same result; a
null doc_id comes before all others. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.words import Words, runs, slices, within
from inspectstar.operators import row_number
from inspectstar.scratch import Scratch

WIDTH = 20
SEED = 5
#: Of an occurrence's number the bits for its position; the others number the document.
_PLACE_BITS = 27


def _chosen(hashes: np.ndarray, choices: int) -> np.ndarray:
    """For each place the position of the smallest of the ``choices`` hashes from there on."""
    n = len(hashes) - choices + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at, reach = np.arange(len(hashes)), 1

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(hashes[right] < hashes[left], right, left)

    while reach < choices:
        step = min(reach, choices - reach)
        at = better(at[: len(at) - step], at[step:])
        reach += step
    return at[:n]


class _Windows:
    """The windows of a slice: ``start`` in words, ``seed`` the position of the chosen run."""

    def __init__(self, words: Words, width: int):
        self.words, self.width = words, width
        self.hashes = words.hashes()
        self.start = within(words.offset, width)
        if len(self.start):
            self.seeds = runs(self.hashes, SEED)
            self.seed = _chosen(self.seeds, width - SEED + 1)[self.start]
        else:
            self.seeds, self.seed = np.zeros(0, dtype=np.uint64), self.start

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.offset, places, side="right") - 1

    def marked(self, lists: pa.ListArray) -> np.ndarray:
        """A mark per word of the slice at the positions listed by document."""
        marks = np.zeros(len(self.words) + 1, dtype=bool)
        first, last = self.words.piece.first, self.words.piece.last
        part = lists.slice(first, last - first)
        count = pc.list_value_length(part).fill_null(0).to_numpy(zero_copy_only=False)
        base = np.repeat(self.words.offset[:-1], count)
        marks[base + part.flatten().to_numpy(zero_copy_only=False)] = True
        return marks


def _seed_rows(width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.drop_columns(["text"])
            for piece in slices(batch.column("text")):
                windows = _Windows(piece.words(), width)
                place = np.unique(windows.seed)
                owner = windows.owner(place)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(windows.seeds[place].view(np.int64)),
                        *keys.take(pa.array(owner + piece.first)).columns,
                        pa.array((place - windows.words.offset[owner]).astype(np.int32)),
                    ],
                    names=["seed", *keys.schema.names, "pos"],
                )

    return find


def _window_rows(width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy()
            for piece in slices(batch.column("text")):
                windows = _Windows(piece.words(), width)
                start = windows.start[windows.marked(batch.column("seeds"))[windows.seed]]
                owner = windows.owner(start)
                hashes = runs(windows.hashes, width)[start] if len(start) else windows.hashes[:0]
                pos = start - windows.words.offset[owner]
                if len(pos) and pos.max() >> _PLACE_BITS:
                    raise ValueError(f"a text of more than {1 << _PLACE_BITS} words")
                place = number[owner + piece.first] << _PLACE_BITS | pos
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(place)], names=["window", "place"]
                )

    return find


def _cut(width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column("text")):
                words = piece.words()
                windows = _Windows(words, width)
                found = windows.marked(batch.column("seeds"))[windows.seed]
                first = windows.marked(batch.column("firsts"))[windows.start]
                late = windows.start[found & ~first]
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(cover, late, 1)
                np.add.at(cover, late + width, -1)
                gone = np.cumsum(cover[:-1]) > 0
                yield _result(batch, piece, words, gone)

    return cut


def _result(batch: pa.RecordBatch, piece, words: Words, gone: np.ndarray) -> pa.RecordBatch:
    owner = words.document()
    n = len(piece)
    # Kept words, each but a document's last with the sign after it, which becomes a space.
    kept = np.flatnonzero(~gone)
    data = piece.data.copy()
    edges = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edges, words.start[kept], 1)
    np.add.at(edges, words.end[kept], -1)
    taken = np.cumsum(edges[:-1]) > 0
    more = np.zeros(len(kept), dtype=bool)
    more[:-1] = owner[kept[1:]] == owner[kept[:-1]]
    gaps = words.end[kept[more]]
    data[gaps], taken[gaps] = 0x20, True
    places = np.concatenate([[0], np.cumsum(taken)])[piece.bounds]
    text = pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data[taken].tobytes())
    )
    # Maximal repeats: stretches of words that go, within a document.
    begins = gone.copy()
    begins[1:] &= ~(gone[:-1] & (owner[1:] == owner[:-1]))
    ends = gone.copy()
    ends[:-1] &= ~(gone[1:] & (owner[1:] == owner[:-1]))
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    holder = owner[begins]
    spans = pa.StructArray.from_arrays(
        [
            pa.array((begins - words.offset[holder]).astype(np.int32)),
            pa.array((ends + 1 - words.offset[holder]).astype(np.int32)),
        ],
        names=["start", "end"],
    )
    bounds = np.concatenate([[0], np.cumsum(np.bincount(holder, minlength=n))])
    rows = batch.column("doc").slice(piece.first, n)
    return pa.RecordBatch.from_arrays(
        [
            rows,
            pa.array(words.counts()),
            pa.array(np.bincount(owner[gone], minlength=n)),
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans),
            text.cast(pa.string()),
        ],
        names=["doc", "n_words", "n_removed", "repeats", "kept"],
    )


def _tag(text: Column) -> Column:
    """Tells rows of one doc_id apart."""
    return F.hash(text)


def remove_repeats(docs: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """(doc, n_words, n_removed, repeats, kept) for every row of ``docs``, its text left out.

    ``repeats`` are the maximal repeated stretches, in words; ``kept`` is the text that is
    left, words joined by one space.
    """
    texts = docs.select("doc_id", _tag(F.col("text")).alias("tag"), "text")
    key_kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tag int"
    seeds = texts.where("text is not null").mapInArrow(
        _seed_rows(width), f"seed long, {key_kind}, pos int"
    )
    counts = seeds.groupBy("seed").agg(F.count("*").alias("n"))
    # Written: both sides of the join are then plain exchanges, which Spark can split.
    repeated = scratch.keep(counts.where("n > 1").select("seed"), "repeated-seeds")
    placed = seeds.join(repeated, "seed", "left_semi")
    # As many entries as the document has seeds.
    by_document = placed.groupBy("doc_id", "tag").agg(
        F.array_distinct(F.collect_list("pos")).alias("seeds")
    )

    def joined(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
        lists = lists.select(
            F.col("doc_id").alias("list id"), F.col("tag").alias("list tag"),
            *[c for c in lists.columns if c not in ("doc_id", "tag")],
        )
        same = rows["doc_id"].eqNullSafe(lists["list id"]) & (rows["tag"] == lists["list tag"])
        return rows.join(lists, same, how).drop("list id", "list tag")

    # Documents in order, so that an occurrence is one number.
    by_document = scratch.keep(
        row_number(by_document, ["doc_id", "tag"], "number", scratch), "numbered-documents"
    )
    windows = joined(texts, by_document, "inner").drop("doc_id", "tag")
    windows = windows.mapInArrow(_window_rows(width), "window long, place long")
    firsts = windows.groupBy("window").agg(F.min("place").alias("place"))
    firsts = firsts.groupBy(F.shiftright("place", _PLACE_BITS).alias("list number")).agg(
        F.collect_list(F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")).alias("firsts")
    )
    firsts = scratch.keep(firsts, "first-windows")

    rows = wrapped(docs).select(
        F.col("doc.doc_id").alias("doc_id"),
        _tag(F.col("doc.text")).alias("tag"),
        F.col("doc").dropFields("text").alias("doc"),
        F.col("doc.text").alias("text"),
    )
    lists = by_document.join(firsts, F.col("number") == F.col("list number"), "left")
    rows = joined(rows, lists.drop("number", "list number"), "left")
    columns = (
        "n_words long, n_removed long, repeats array<struct<start:int,end:int>>, kept string"
    )
    return rows.mapInArrow(_cut(width), schema_with_doc(rows, columns))
