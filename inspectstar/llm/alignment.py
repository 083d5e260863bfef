"""Tokens of two tokenizers aligned, and how often they meet: external spill counting.

A is a byte-level vocabulary, applied to a space and the text; B a piece vocabulary that puts
the space there by itself. The bytes at which tokens of both end cut a text into groups, and
every A token of a group is linked with every B token of it. A pair's count is the number of
documents in which its ids are linked.

Documents are read in chunks. A chunk's pair-document records are radix-partitioned by their
A id; those of one radix, sorted with A as the major side, are a run: the pairs with the
chunk's counts in one zstandard stream, the documents of each pair in another. The runs are
written, and only the streams of pairs travel to be counted. A k-way heap merge reads the runs
of a radix block by block and sums each pair; as A is the major side, the pairs of an A id
come together and its highest count is known when the next begins. What the merge finds
streams back to each run in the order of its pairs, and the chunk adds it up by document.

No pair's documents ever meet in one task: a pair that every document has is one entry for
each chunk. More than ``FAN_IN`` runs of a radix are merged in groups first, the groups in
the next pass, and results come back the same way, so that a task's memory holds one block
of ``FAN_IN`` runs, and the different pairs of one radix.

Defined results: null and empty texts, and texts that the tokens of A or B do not spell, have
no tokens, zeros and ''; strings of special tokens are plain text; repeated rows are documents
of their own; an empty table gives an empty result; further columns, whatever their names,
stay inside ``doc``. A text of any length is one chunk, links of groups with many tokens are
made from their different ids in pieces of ``LINKS`` links.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.subwords import ByteLevel, PieceTable, Pieces, byte_level, sentence_pieces
from inspectstar.llm.words import Slice, slices
from inspectstar.scratch import Scratch

#: Text bytes of a chunk, entries of a block, runs merged at once, links made at once.
CHUNK_BYTES = 2_000_000
BLOCK = 4_096
FAN_IN = 1024
LINKS = 500_000
#: Radixes: one for so many text bytes, between the least and the most.
RADIX_BYTES = 64_000_000
RADIXES = (64, 4096)
#: Groups with more links are taken by their different ids.
_WIDE = 4096


class _Vocabulary:
    """The bytes of each id, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the tokens, where each ends)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.start[ids] - ends + size, size)
        return self.data[at], ends


_vocabularies: dict[int, _Vocabulary] = {}


def _vocabulary(encoder: ByteLevel | Pieces) -> _Vocabulary:
    if id(encoder) not in _vocabularies:
        _vocabularies[id(encoder)] = _Vocabulary(encoder.token_bytes())
    return _vocabularies[id(encoder)]


class _Side:
    """The tokens of one tokenizer over the texts of a slice."""

    def __init__(self, piece: Slice, encoder: ByteLevel | Pieces, table: PieceTable):
        words = _vocabulary(encoder)
        flat, size = table.distinct_ids(encoder)
        self.ids, self.offset = table.spread(flat, size)
        # Pieces that their tokens do not spell; their texts are compared as wholes.
        spelled, ends = words.spell(flat)
        stops = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], ends])[stops].tolist()
        joined = spelled.tobytes()
        odd = np.array(
            [joined[a:b] != p for a, b, p in zip(ends[:-1], ends[1:], table.distinct, strict=True)],
            dtype=bool,
        )
        self.spelled = np.ones(len(piece), dtype=bool)
        if odd.any():
            holder = np.searchsorted(table.first, np.flatnonzero(odd[table.index]), side="right") - 1
            for i in np.unique(holder):
                text = piece.data[piece.bounds[i] : piece.bounds[i + 1]].tobytes()
                ids = self.ids[self.offset[i] : self.offset[i + 1]]
                self.spelled[i] = b"".join([words.tokens[t] for t in ids]) == text
        self.words = words

    def keep(self, texts: np.ndarray) -> None:
        """Only the tokens of some texts."""
        count = np.diff(self.offset)
        self.ids = self.ids[np.repeat(texts, count)].astype(np.int64)
        self.count = np.where(texts, count, 0)
        self.offset = np.concatenate([[0], np.cumsum(self.count)])
        self.ends = np.cumsum(self.words.size[self.ids])


class Groups:
    """The groups of a slice: ``of_a`` and ``of_b`` by token, ``text`` by group."""

    def __init__(self, a: _Side, b: _Side):
        self.a, self.b = a, b
        total = int(a.ends[-1]) if len(a.ends) else 0
        meets = np.zeros(total + 1, dtype=np.uint8)
        meets[a.ends] = 1
        meets[b.ends] += 1
        cut_a, cut_b = meets[a.ends] == 2, meets[b.ends] == 2
        self.of_a, self.of_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n = int(cut_a.sum())
        self.n_a = np.bincount(self.of_a, minlength=n)
        self.n_b = np.bincount(self.of_b, minlength=n)
        self.first_a, self.first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        texts = len(a.offset) - 1
        owner = np.repeat(np.arange(texts), a.count)
        self.text = owner[cut_a]
        self.n_groups = np.bincount(self.text, minlength=texts)
        self.n_links = np.zeros(texts, dtype=np.int64)
        np.add.at(self.n_links, self.text, self.n_a * self.n_b)

    def shown(self) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        a, b = self.a, self.b
        codes = np.zeros(len(a.ids) + len(b.ids), dtype=np.int64)
        at_a = np.arange(len(a.ids)) + self.first_b[self.of_a]
        at_b = np.arange(len(b.ids)) + (self.first_a + self.n_a)[self.of_b]
        codes[at_a], codes[at_b] = a.ids * 3, b.ids * 3
        codes[at_a[self.first_a + self.n_a - 1]] += 1
        codes[at_b[self.first_b + self.n_b - 1]] += 2
        names = _names(max(len(a.words.tokens), len(b.words.tokens)))
        bounds = (a.offset + b.offset).tolist()
        return [
            "".join([names[c] for c in codes[low:high].tolist()])[:-1]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True)
        ]

    def records(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(A id, B id, text, links), a part of the groups at a time."""
        links = self.n_a * self.n_b
        narrow = np.where(links <= _WIDE, links, 0)
        part = np.cumsum(narrow) // LINKS
        edges = np.searchsorted(part, np.arange((part[-1] if len(part) else -1) + 2))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            some = np.flatnonzero(narrow[low:high]) + low
            token_a = np.arange(self.n_a[some].sum()) + np.repeat(
                self.first_a[some] - np.cumsum(self.n_a[some]) + self.n_a[some], self.n_a[some]
            )
            group = self.of_a[token_a]
            times = self.n_b[group]
            token_b = np.arange(times.sum()) + np.repeat(
                self.first_b[group] - np.cumsum(times) + times, times
            )
            yield (
                np.repeat(self.a.ids[token_a], times),
                self.b.ids[token_b],
                np.repeat(self.text[group], times),
                np.ones(len(token_b), dtype=np.int64),
            )
        for g in np.flatnonzero(links > _WIDE):
            a, n_a = np.unique(self.a.ids[self.first_a[g] :][: self.n_a[g]], return_counts=True)
            b, n_b = np.unique(self.b.ids[self.first_b[g] :][: self.n_b[g]], return_counts=True)
            step = max(1, LINKS // len(b))
            for i in range(0, len(a), step):
                own, own_n = a[i : i + step], n_a[i : i + step]
                yield (
                    np.repeat(own, len(b)),
                    np.tile(b, len(own)),
                    np.full(len(own) * len(b), self.text[g]),
                    np.repeat(own_n, len(b)) * np.tile(n_b, len(own)),
                )


_name_lists: dict[int, list[str]] = {}


def _names(ids: int) -> list[str]:
    """Ids as text, with each of the signs that may follow."""
    if ids not in _name_lists:
        _name_lists[ids] = [f"{i}{sign}" for i in range(ids) for sign in ",|;"]
    return _name_lists[ids]


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and their totals."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(amounts, first) if len(first) else amounts


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, as differences where they ascend, in the fewest bytes."""
    pack = zstandard.ZstdCompressor(level=1).compress
    out = []
    for values in arrays:
        top = int(values.max()) if len(values) else 0
        kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max)
        body = pack(values.astype(kind).tobytes())
        out.append(np.array([int(kind[2]), len(body)], dtype="<u4").tobytes() + body)
    return b"".join(out)


def _unzip(data: bytes | memoryview, place: int = 0) -> tuple[np.ndarray, int]:
    """The array at a place of what ``_zip`` made, and where the next begins."""
    width, size = np.frombuffer(data, dtype="<u4", count=2, offset=place).tolist()
    body = zstandard.ZstdDecompressor().decompress(data[place + 8 : place + 8 + size])
    return np.frombuffer(body, dtype=f"<u{width}").astype(np.int64), place + 8 + size


def _zip_pairs(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys with counts, in blocks."""
    out = []
    for i in range(0, len(keys), BLOCK):
        own = keys[i : i + BLOCK]
        out.append(_zip(np.diff(own, prepend=0), counts[i : i + BLOCK]))
    return b"".join(out)


def _blocks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, place = memoryview(data), 0
    while place < len(data):
        steps, place = _unzip(data, place)
        counts, place = _unzip(data, place)
        yield np.cumsum(steps), counts


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs with their summed counts, ascending, some at a time.

    The heap orders the runs by the last pair of the block each has open: up to the first of
    these nothing can come any more that is not open already.
    """
    readers = [_blocks(run) for run in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        block = next(readers[i], None)
        if block is None:
            held.pop(i, None)
        else:
            held[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        bound = heap[0][0]
        keys, counts = [], []
        for i, (own, n) in list(held.items()):
            stop = int(np.searchsorted(own, bound, side="right"))
            if stop:
                keys.append(own[:stop])
                counts.append(n[:stop])
                held[i] = own[stop:], n[stop:]
        while heap and heap[0][0] == bound:
            advance(heapq.heappop(heap)[1])
        yield _summed(np.concatenate(keys), np.concatenate(counts))


def counted(runs: list[bytes], side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, count, whether it is the highest of its A id), ascending, of all runs.

    A pair is A id * ``side`` + B id. An A id is settled when a larger one begins.
    """
    out, open_keys, open_counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settle(keys: np.ndarray, counts: np.ndarray) -> None:
        major = keys // side
        first = np.flatnonzero(np.concatenate([[True], major[1:] != major[:-1]]))
        highest = np.maximum.reduceat(counts, first)
        size = np.diff(np.append(first, len(keys)))
        out.append((keys, counts, counts == np.repeat(highest, size)))

    for keys, counts in merged(runs):
        keys, counts = np.concatenate([open_keys, keys]), np.concatenate([open_counts, counts])
        last = int(np.searchsorted(keys, keys[-1] // side * side))
        if last:
            settle(keys[:last], counts[:last])
        open_keys, open_counts = keys[last:], counts[last:]
    if len(open_keys):
        settle(open_keys, open_counts)
    if not out:
        return open_keys, open_counts, open_keys > 0
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pairs_of(run: bytes) -> np.ndarray:
    return np.concatenate([keys for keys, _ in _blocks(run)])


_ANSWERS = "radix int, run long, answers binary"


def _answers(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
    """For each run of the table the values of its pairs, in their order."""
    found = [
        _zip(values[np.searchsorted(keys, _pairs_of(run.as_buffer()))])
        for run in table.column("pairs")
    ]
    return pa.table(
        {
            "radix": table.column("radix"),
            "run": table.column("run"),
            "answers": pa.array(found, pa.binary()),
        }
    )


def _settle(side: int):
    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("run")
        keys, counts, best = counted([x.as_buffer() for x in table.column("pairs")], side)
        return _answers(table, keys, counts * 2 + best)

    return settle


def _premerge(table: pa.Table) -> pa.Table:
    runs = [x.as_buffer() for x in table.column("pairs")]
    body = b"".join(_zip_pairs(keys, counts) for keys, counts in merged(runs))
    return pa.table(
        {
            "radix": table.column("radix").slice(0, 1),
            "run": table.column("group").slice(0, 1),
            "pairs": pa.array([body], pa.binary()),
        }
    )


def _pass_on(table: pa.Table, above: pa.Table) -> pa.Table:
    runs = [x.as_buffer() for x in table.column("pairs")]
    keys = np.concatenate([keys for keys, _ in merged(runs)])
    values, _ = _unzip(above.column("answers")[0].as_buffer())
    return _answers(table, keys, values)


def _solved(runs: DataFrame, side: int, scratch: Scratch, fan_in: int) -> DataFrame:
    """(radix, run, answers): for each run, for each of its pairs 2 * count + (is highest)."""
    n = runs.select("run").distinct().count()
    if n <= fan_in:
        return runs.groupBy("radix").applyInArrow(_settle(side), _ANSWERS)
    group = F.pmod(F.xxhash64("run"), F.lit(-(-n // fan_in)))
    grouped = runs.withColumn("group", group)
    above = grouped.groupBy("radix", "group").applyInArrow(
        _premerge, "radix int, run long, pairs binary"
    )
    above = scratch.keep(above, "merged-runs")
    answers = _solved(above, side, scratch, fan_in)
    return grouped.groupBy("radix", "group").cogroup(answers.groupBy("radix", "run")).applyInArrow(
        _pass_on, _ANSWERS
    )


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups string"


def _padded(piece: Slice) -> Slice:
    """A space before each text but the empty ones."""
    some = np.diff(piece.bounds) > 0
    added = np.concatenate([[0], np.cumsum(some)])
    data = np.insert(piece.data, piece.bounds[:-1][some], 0x20)
    return Slice(piece.first, piece.last, data, piece.bounds + added)


def _chunks(path_a: str, path_b: str, radixes: int, digest: bool, doc_kind: pa.DataType):
    """A function for mapInArrow: (doc, text) to the rows of documents and of runs."""

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = byte_level(path_a, False), sentence_pieces(path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in map(_padded, slices(batch.column("text"), CHUNK_BYTES)):
                one = PieceTable(piece.data, piece.bounds, a_side.by_piece)
                two = one
                if a_side.by_piece != b_side.by_piece:
                    two = PieceTable(piece.data, piece.bounds, b_side.by_piece)
                a, b = _Side(piece, a_side, one), _Side(piece, b_side, two)
                good = a.spelled & b.spelled & (np.diff(piece.bounds) > 0)
                a.keep(good)
                b.keep(good)
                groups = Groups(a, b)
                shown = groups.shown()
                if digest:
                    shown = [x and hashlib.sha256(x.encode()).hexdigest() for x in shown]
                n = len(piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number)),
                        batch.column("doc").slice(piece.first, n),
                        pa.array(np.arange(n), pa.int32()),
                        pa.array(a.count),
                        pa.array(b.count),
                        pa.array(groups.n_groups),
                        pa.array(groups.n_links),
                        pa.array(shown, pa.string()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=_NAMES,
                )
                rows = _runs(groups, radixes)
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, number)),
                        pa.nulls(m, doc_kind),
                        *[pa.nulls(m, kind) for kind in _NO_COUNTS],
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.binary()),
                        pa.array([r[2] for r in rows], pa.binary()),
                    ],
                    names=_NAMES,
                )
                number += 1

    return spill


_NAMES = "run doc place n_a n_b n_groups n_links groups radix pairs documents".split()
_NO_COUNTS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _runs(groups: Groups, radixes: int) -> list[tuple[int, bytes, bytes]]:
    """(radix, pairs with counts, documents of each pair) of the records of a chunk."""
    side = len(groups.b.words.tokens)
    texts = len(groups.n_links)
    found = [
        _summed((a * side + b) * texts + text, links) for a, b, text, links in groups.records()
    ]
    if not found:
        return []
    code, links = found[0] if len(found) == 1 else _summed(
        np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    )
    key = code // texts
    text = code - key * texts
    radix = (key // side % radixes).astype(np.uint16)
    order = np.argsort(radix, kind="stable")
    key, text, links, radix = key[order], text[order], links[order], radix[order]
    edges = np.append(np.flatnonzero(np.diff(radix, prepend=-1)), len(radix))
    rows = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        own = key[low:high]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        count = np.diff(np.append(first, len(own)))
        rows.append(
            (
                int(radix[low]),
                _zip_pairs(own[first], count),
                _zip(count) + _zip(text[low:high], links[low:high] - 1),
            )
        )
    return rows


def _finish(table: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk with what the counted pairs add to each."""
    docs = table.filter(pc.is_valid(table.column("place"))).sort_by("place")
    runs = table.filter(pc.is_valid(table.column("radix"))).sort_by("radix")
    answers = answers.sort_by("radix")
    best, total = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
    if runs.column("radix").to_pylist() != answers.column("radix").to_pylist():
        raise ValueError("a run without its counts")
    for run, answer in zip(runs.column("documents"), answers.column("answers"), strict=True):
        data = run.as_buffer()
        count, place = _unzip(data)
        text, place = _unzip(data, place)
        links = _unzip(data, place)[0] + 1
        value = np.repeat(_unzip(answer.as_buffer())[0], count)
        np.add.at(best, text, links * (value & 1))
        np.add.at(total, text, links * (value >> 1))
    kept = docs.select(["doc", "n_a", "n_b", "n_groups", "n_links", "groups"])
    return kept.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))


def align(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    scratch: Scratch,
    digest: bool = False,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(doc, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) for every row of ``docs``.

    ``doc`` is the row without its text. ``groups`` is the text's groups as
    ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that. ``n_best`` is the number of
    links whose pair's count is the highest of its A id, ``count_sum`` the sum of the counts.
    """
    rows = wrapped(docs)
    rows = rows.select(
        F.col("doc").dropFields("text").alias("doc"), F.col("doc.text").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    radixes = min(max(1 << (size // RADIX_BYTES).bit_length(), RADIXES[0]), RADIXES[1])
    doc_kind = to_arrow_type(rows.schema["doc"].dataType)
    columns = StructType.fromDDL(f"place int, {_COUNTS}, radix int, pairs binary, documents binary")
    # Rows of runs have no document.
    doc = StructField("doc", rows.schema["doc"].dataType, nullable=True)
    schema = StructType([*StructType.fromDDL("run long").fields, doc, *columns.fields])
    spilled = rows.mapInArrow(
        _chunks(byte_tokenizer, piece_tokenizer, radixes, digest, doc_kind), schema
    )
    spilled = scratch.keep(spilled, "spilled-runs")
    side = sentence_pieces(piece_tokenizer).size
    runs = spilled.where("radix is not null").select("radix", "run", "pairs")
    answers = _solved(runs, side, scratch, fan_in)
    out = schema_with_doc(
        rows,
        "n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long",
    )
    held = spilled.drop("pairs").groupBy("run")
    return held.cogroup(answers.groupBy("run")).applyInArrow(_finish, out)
