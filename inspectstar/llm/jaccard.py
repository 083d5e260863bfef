"""Jaccard join of the documents' word shingles, by chosen paths.

Texts with equal sets of shingles become one set. Each set is embedded in ``COORDINATES``
minhash values. A run of the join is a tree: a node samples coordinates, by a hash of its
path, and sends each set on by its values there, so two sets stay together with a
probability that grows with their similarity. A set reaches its leaves without meeting any
other; the depth grows with the logarithm of the number of sets, the number of runs follows
from the target recall. Leaves are brute forced on the minhash values, in blocks, which
links sets that may be similar. Inside the components of these links every two sets are
compared exactly, again in blocks, so links missed by the trees within a component are
found as well. A pair of blocks is a task's work; within it counts and a spanning forest
are kept, never the pairs.

Defined results: documents without words (null, empty) are similar to nothing, each its own
class; documents of fewer than ``SHINGLE`` words have one shingle of all their words; texts
are compared as they are; a class is named by its smallest doc_id, null if that is all it
has; identical rows count as copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.components import components
from inspectstar.llm.words import Slice, mix64, runs, slices, within
from inspectstar.scratch import Scratch

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
COORDINATES = 64
#: A leaf of a random tree holds about this share fewer sets at each level.
SPLIT = 24
#: Sets of a block; two blocks meet in a task.
BLOCK = 256
#: Estimates this far below the threshold are still checked exactly (over four deviations).
SLACK = 0.22

_draws = np.random.default_rng(7)
_FACTOR = _draws.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _draws.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_COORDINATE = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64))


def _shingles(piece: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(different shingles by document, offset of each document)."""
    words = piece.words()
    hashes = words.hashes()
    start = within(words.offset, width)
    owner = np.searchsorted(words.offset, start, side="right") - 1
    shingle = runs(hashes, width)[start] if len(start) else np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((words.counts() > 0) & (words.counts() < width))
    if len(short):
        first = words.offset[short]
        whole = [runs(hashes[a:b], b - a)[0] for a, b in zip(first, words.offset[short + 1], strict=True)]
        shingle = np.concatenate([shingle, np.array(whole, dtype=np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    shingle, owner = shingle[new], owner[new]
    return shingle, np.searchsorted(owner, np.arange(len(piece) + 1))


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch.column("text")):
            shingle, offset = _shingles(piece, SHINGLE)
            some = np.flatnonzero(np.diff(offset))
            if not len(some):
                continue
            values = np.zeros((len(some), COORDINATES), dtype=np.uint32)
            with np.errstate(over="ignore"):
                for i in range(COORDINATES):
                    least = np.minimum.reduceat(shingle * _FACTOR[i] + _SHIFT[i], offset[some])
                    values[:, i] = mix64(least) >> np.uint64(32)
                size = np.diff(offset)[some]
                key = np.add.reduceat(mix64(shingle), offset[some]) + mix64(size)
            keys = batch.drop_columns(["text"]).take(pa.array(some + piece.first))
            # One byte of each value is enough for an estimate.
            held = [
                pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(v.nbytes // len(v)), len(v), [None, pa.py_buffer(v.tobytes())]
                ).cast(pa.binary())
                for v in (values, values.astype(np.uint8))
            ]
            columns = [
                *keys.columns,
                pa.array(key.view(np.int64)),
                *held,
            ]
            names = [*keys.schema.names, "set_key", "values", "brief"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def tree_shape(n: int, similarity: float, recall: float) -> tuple[int, int]:
    """(depth, runs) for n sets."""
    depth = max(2, math.ceil(math.log(max(n, 2)) / math.log(SPLIT)))
    # A pair at the threshold has one shared child per node on average, about Poisson.
    stay = 1.0
    for _ in range(depth):
        stay = 1 - math.exp(-stay)
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - stay))


def _values(column: pa.Array, kind: type) -> np.ndarray:
    if not len(column):
        return np.zeros((0, COORDINATES), dtype=kind)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, COORDINATES)


def _paths(depth: int, trees: int, similarity: float) -> Callable:
    chance = np.uint64(int((1 << 64) / (similarity * COORDINATES)))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                values = _values(batch.column("values"), np.uint32)
                owner = np.repeat(np.arange(len(batch)), trees)
                path = np.tile(mix64(np.arange(1, trees + 1, dtype=np.uint64) << np.uint64(32)), len(batch))
                for _ in range(depth):
                    chosen = [np.zeros((0, 2), dtype=np.int64)]
                    for low in range(0, len(path), 20_000):
                        with np.errstate(over="ignore"):
                            lots = mix64(path[low : low + 20_000, None] + _COORDINATE[None, :])
                        chosen.append(np.argwhere(lots < chance) + [low, 0])
                    node, coordinate = np.concatenate(chosen).T
                    owner = owner[node]
                    with np.errstate(over="ignore"):
                        value = values[owner, coordinate].astype(np.uint64)
                        path = mix64(path[node] ^ mix64(_COORDINATE[coordinate] + value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(path.view(np.int64)), batch.column("set_key").take(pa.array(owner))],
                    names=["path", "set_key"],
                )

    return walk


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int) -> Iterator[pa.Table]:
    """Whole groups of equal ``keys``, some ``least`` rows at a time, from sorted rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = [table.column(k)[-1].as_py() for k in keys]
        same = np.ones(len(table), dtype=bool)
        for k, value in zip(keys, last, strict=True):
            same &= table.column(k).to_numpy() == value
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
        held, rows = rest.to_batches(), len(rest)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_ids(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(table), dtype=bool)
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _rooted(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the pairs (a, b) connect it with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            return root


def _edges(set_key: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    other = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays(
        [pa.array(set_key[other]), pa.array(set_key[root[other]])], names=["a", "b"]
    )


_LEAF = ["path", "low", "high"]


def _link_leaves(similarity: float) -> Callable:
    """Brute force within leaves: edges between sets whose minhash values may be similar."""
    least = (similarity - SLACK) * COORDINATES

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, _LEAF, 4000):
            group = _group_ids(table, _LEAF)
            values = _values(table.column("brief").combine_chunks(), np.uint8)
            first, second = [], []
            apart = 1
            here = np.arange(len(group))
            while True:
                here = here[here + apart < len(group)]
                here = here[group[here] == group[here + apart]]
                if not len(here):
                    break
                for at in range(0, len(here), 50_000):
                    i = here[at : at + 50_000]
                    alike = (values[i] == values[i + apart]).sum(axis=1) >= least
                    first.append(i[alike])
                    second.append(i[alike] + apart)
                apart += 1
            if first:
                root = _rooted(len(group), np.concatenate(first), np.concatenate(second))
                yield _edges(table.column("set_key").to_numpy(), root)

    return link


_PAIR = ["root", "low", "high"]


def _overlaps(tokens: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of n sets, given as (token, owner)."""
    token, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), dtype=np.float32)
    for low in range(0, int((count > 1).sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((n, 4096), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _check_blocks(similarity: float) -> Callable:
    """Exact links between all sets of a pair of blocks: link counts, and a forest."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _groups(batches, _PAIR, 64):
            group = _group_ids(whole, _PAIR)
            for low, high in zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(group, np.arange(group[-1] + 2))), strict=True):
                table = whole.slice(low, high - low)
                n = len(table)
                shingle, offset = [], [0]
                for piece in slices(table.column("text"), 1 << 62):
                    found, bounds = _shingles(piece, SHINGLE)
                    shingle.append(found)
                    offset = bounds
                size = np.diff(offset)
                both = _overlaps(np.concatenate(shingle), np.repeat(np.arange(n), size), n)
                union = size[:, None] + size[None, :] - both
                linked = both >= similarity * union - 1e-6
                np.fill_diagonal(linked, False)
                # In a pair of different blocks the pairs inside a block are another task's.
                block = table.column("block").to_numpy()
                if table.column("low")[0].as_py() != table.column("high")[0].as_py():
                    linked &= block[:, None] != block[None, :]
                weight = table.column("copies").to_numpy()
                key = table.column("set_key").to_numpy()
                first, second = np.nonzero(np.triu(linked))
                root = _rooted(n, first, second)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(key[root]), pa.array(linked @ weight)],
                    names=["a", "b", "links"],
                )

    return check


def _in_blocks(rows: DataFrame, size: str) -> DataFrame:
    """``rows`` dealt to all pairs (low, high) of blocks of their group that they belong to."""
    count = F.ceil(F.col(size) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_key", F.lit("block")), count).cast("int")
    dealt = rows.withColumn("blocks", count).withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        dealt.withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text): the tag tells rows of one doc_id apart."""
    return docs.select("doc_id", F.hash("text").alias("tag"), "text")


def join(
    docs: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """(doc_id, tag, class_id, head_tag, n_links, n_copies) for every row of ``docs``.

    ``class_id`` is the smallest doc_id of the class, ``head_tag`` the tag of that row;
    ``n_links`` counts the other rows that are similar, copies among them; ``n_copies`` the
    rows with the same set, itself among them.
    """
    texts = tagged(docs)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    embedded = scratch.keep(
        texts.where("text is not null").mapInArrow(
            _embed, f"doc_id {id_kind}, tag int, set_key long, values binary, brief binary"
        ),
        "embedded",
    )
    # Copies meet here, by partial aggregation.
    sets = embedded.groupBy("set_key").agg(
        F.count("*").alias("copies"),
        F.min(F.struct("doc_id", "tag")).alias("head"),
        F.min("values").alias("values"),
        F.min("brief").alias("brief"),
    )
    sets = scratch.keep(sets, "sets")

    depth, trees = tree_shape(sets.count(), similarity, recall)
    leaves = sets.select("set_key", "values").mapInArrow(
        _paths(depth, trees, similarity), "path long, set_key long"
    )
    leaves = scratch.keep(leaves, "leaves")
    sizes = leaves.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
    full = leaves.join(scratch.keep(sizes, "leaf-sizes"), "path")
    valued = _in_blocks(full, "n").join(sets.select("set_key", "brief"), "set_key")
    dealt = valued.select(*_LEAF, "set_key", "brief").repartition(*_LEAF)
    near = dealt.sortWithinPartitions(*_LEAF).mapInArrow(
        _link_leaves(similarity), "a long, b long"
    )
    candidates = scratch.keep(components(near, scratch), "candidates")

    sizes = candidates.groupBy("root").agg(F.count("*").alias("n"))
    members = candidates.join(scratch.keep(sizes, "component-sizes"), "root").join(
        sets.select(F.col("set_key").alias("node"), "copies", "head"), "node"
    )
    members = members.select(
        "root", "n", "copies", F.col("node").alias("set_key"),
        F.col("head.doc_id").alias("head id"), F.col("head.tag").alias("head tag"),
    )
    members = scratch.keep(members, "members")
    same = texts["doc_id"].eqNullSafe(members["head id"]) & (texts["tag"] == members["head tag"])
    # The members grow with the corpus: texts and members are shuffled at every size.
    held = texts.join(members.hint("merge"), same).dropDuplicates(["set_key"])
    blocks = _in_blocks(held, "n").select(*_PAIR, "block", "set_key", "copies", "text")
    checked = (
        blocks.repartition(*_PAIR)
        .sortWithinPartitions(*_PAIR)
        .mapInArrow(_check_blocks(similarity), "a long, b long, links long")
    )
    checked = scratch.keep(checked, "checked")
    links = checked.groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    classes = components(checked.select("a", "b"), scratch)
    classes = classes.withColumnsRenamed({"node": "set_key", "root": "class_key"})
    heads = (
        sets.drop("values", "brief")
        .join(classes, "set_key", "left")
        .join(links, "set_key", "left")
        .withColumn("class_key", F.coalesce("class_key", "set_key"))
    )
    heads = scratch.keep(heads, "classed-sets")
    first = heads.groupBy("class_key").agg(F.min("head").alias("first"))
    heads = heads.join(scratch.keep(first, "class-heads"), "class_key").select(
        "set_key",
        "first",
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    heads = scratch.keep(heads, "heads")
    grouped = embedded.select("doc_id", "tag", "set_key").join(heads, "set_key")
    grouped = grouped.select(
        "doc_id",
        "tag",
        F.col("first.doc_id").alias("class_id"),
        F.col("first.tag").alias("head_tag"),
        "n_links",
        F.col("copies").alias("n_copies"),
    )
    wordless = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    alone = texts.where(~wordless).select(
        "doc_id",
        "tag",
        F.col("doc_id").alias("class_id"),
        F.col("tag").alias("head_tag"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"),
    )
    return grouped.unionByName(alone)


def deduplicate(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row of ``docs`` of each class, the one with the smallest doc_id; rows without words stay."""
    found = join(docs, scratch)
    heads = found.where("n_links > 0").select(
        F.col("doc_id").alias("copy id"),
        F.col("tag").alias("copy tag"),
        (F.col("class_id").eqNullSafe(F.col("doc_id")) & (F.col("head_tag") == F.col("tag"))).alias(
            "is head"
        ),
    )
    heads = scratch.keep(heads.distinct(), "copies")
    same = docs["doc_id"].eqNullSafe(heads["copy id"]) & (F.hash(docs["text"]) == heads["copy tag"])
    # The list grows with the corpus: it is shuffled at every size, as the documents are.
    marked = docs.join(heads.hint("merge"), same, "left")
    kept = marked.where(F.coalesce(heads["is head"], F.lit(True)))
    # Identical rows of a head are copies of each other as well.
    alone = kept.where(heads["copy tag"].isNull()).select(*[docs[f"`{c}`"] for c in docs.columns])
    first = kept.where(heads["copy tag"].isNotNull()).dropDuplicates(["copy id", "copy tag"])
    return alone.unionByName(first.select(*[docs[f"`{c}`"] for c in docs.columns]))
