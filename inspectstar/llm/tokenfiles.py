"""Token ids as compressed files that give back single documents.

A token file is Parquet written by Spark, so that a lost task leaves nothing behind and any store
that Spark reads can hold it. Each row is a block of consecutive documents:

    part, block    the file's place in the order of all documents, the block's place in it
    before         ids of the earlier documents of the part
    keys, tags     the documents' ids and hashes of their texts, in order
    low, high      the smallest and largest key: a lookup skips other blocks by them
    counts, ends   for each document its number of ids and the end of its frame in ``frames``
    width          bytes of an id: 2 where the vocabulary fits, else 4, little-endian
    dictionary     the hash of the dictionary its frames need (empty: none)
    frames         the documents' ids, each document one zstandard frame of its own

``parts`` beside them has the ids before each part, ``dictionary`` the shared zstandard
dictionary under its hash, trained on serialised id arrays. It is fitted on a bounded sample:
of the documents of at most ``SAMPLE_TEXT`` bytes the ``SAMPLE_DOCS`` first in the order of a
hash. Short documents gain most by it. All documents are written, whatever their length.

Documents are in ascending order of their key, null first, rows of one key by the hash of their
text. They are dealt to parts by ranges of (key, hash), so that a key that many rows share is
split, sorted there, encoded and written in one pass.

Defined results: null and empty texts have no ids but the end; a repeated row is a document
of its own; an empty table gives files without documents; columns other than key and text
are not stored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from inspectstar.llm.subwords import byte_level, encoded

#: Text bytes of a part, and of compressed ids of a block, about.
PART_BYTES = 256_000_000
BLOCK_BYTES = 1_000_000
#: A small table is still dealt to tasks of so many text bytes.
LEAST_PART_BYTES = 16_000_000
SAMPLE_DOCS = 1_000
SAMPLE_TEXT = 16_000
DICTIONARY_BYTES = 64_000
LEVEL = 3


def _width(path: str, end_id: int) -> int:
    return 2 if max(byte_level(path, True).size, end_id + 1) <= 1 << 16 else 4


def _documents(texts: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """The serialised ids of each text, the end id after them."""
    kind = np.dtype(f"<u{_width(path, end_id)}")
    for held in encoded(texts, byte_level(path, True)):
        n = len(held.piece)
        ids = np.empty(len(held.ids) + n, dtype=kind)
        ends = held.offset + np.arange(n + 1)
        last = ends[1:] - 1
        own = np.ones(len(ids), dtype=bool)
        own[last] = False
        ids[own], ids[last] = held.ids, end_id
        for low, high in zip(ends[:-1], ends[1:], strict=True):
            yield ids[low:high]


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()[:16] if dictionary else ""


def _trainer(path: str, end_id: int):
    def train(table: pa.Table) -> pa.Table:
        texts = table.sort_by([("place", "ascending"), ("text", "ascending")]).column("text")
        samples = [ids.tobytes() for ids in _documents(texts, path, end_id)]
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little to learn from
            dictionary = b""
        return pa.table({"hash": [_hash(dictionary)], "dictionary": pa.array([dictionary], pa.binary())})

    return train


def train(docs: DataFrame, path: str, end_id: int, text: str = "text") -> bytes:
    """A dictionary for the ids of ``docs``; empty if there is too little to learn from."""
    short = docs.select(F.col(text).alias("text")).where(
        F.octet_length("text").between(1, SAMPLE_TEXT)
    )
    sample = short.select(F.xxhash64("text").alias("place"), "text")
    sample = sample.orderBy("place", "text").limit(SAMPLE_DOCS)
    trained = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(
        _trainer(path, end_id), "hash string, dictionary binary"
    )
    row = trained.first()
    return bytes(row.dictionary) if row else b""


class _Block:
    """The documents of a block, until it is full."""

    def __init__(self) -> None:
        self.keys, self.tags, self.counts, self.frames = [], [], [], []
        self.size = 0

    def add(self, key, tag: int, count: int, frame: bytes) -> None:
        self.keys.append(key)
        self.tags.append(tag)
        self.counts.append(count)
        self.frames.append(frame)
        self.size += len(frame)


def _writer(path: str, end_id: int, dictionary: bytes, key_kind: pa.DataType):
    name = _hash(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        pack = zstandard.ZstdCompressor(level=LEVEL, **shared).compress
        width = _width(path, end_id)
        part = TaskContext.get().partitionId()
        number = before = 0
        block = _Block()

        def row() -> pa.RecordBatch:
            keys = pa.array(block.keys, key_kind)
            some = [k for k in block.keys if k is not None]
            ends = np.cumsum([len(f) for f in block.frames])
            columns = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([number], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "low": pa.array(some[:1] or [None], key_kind),
                "high": pa.array(some[-1:] or [None], key_kind),
                "keys": pa.ListArray.from_arrays([0, len(keys)], keys),
                "tags": pa.array([block.tags], pa.list_(pa.int64())),
                "counts": pa.array([block.counts], pa.list_(pa.int64())),
                "ends": pa.array([ends], pa.list_(pa.int64())),
                "width": pa.array([width], pa.int32()),
                "dictionary": pa.array([name], pa.string()),
                "frames": pa.array([b"".join(block.frames)], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            keys = batch.column("key").to_pylist()
            tags = batch.column("tag").to_pylist()
            documents = _documents(batch.column("text"), path, end_id)
            for key, tag, ids in zip(keys, tags, documents, strict=True):
                block.add(key, tag, len(ids), pack(ids.tobytes()))
                if block.size >= BLOCK_BYTES:
                    yield row()
                    number, before, block = number + 1, before + sum(block.counts), _Block()
        if block.keys:
            yield row()

    return write


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the ids of ``docs`` below ``folder``, encoded by the ``tokenizers`` file
    ``tokenizer``, ``end_id`` after each document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    at_once = min(spark.sparkContext.defaultParallelism * 4, -(-size // LEAST_PART_BYTES))
    parts = max(1, at_once, -(-size // PART_BYTES))
    dictionary = train(rows, tokenizer, end_id)
    kind = rows.schema["key"].dataType
    key_name = kind.simpleString()
    arrow_kind = to_arrow_type(kind)
    order = [F.col("key").asc_nulls_first(), F.col("tag").asc()]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = ordered.mapInArrow(
        _writer(tokenizer, end_id, dictionary, arrow_kind),
        f"part int, block int, before long, low {key_name}, high {key_name}, "
        f"keys array<{key_name}>, tags array<long>, counts array<long>, ends array<long>, "
        "width int, dictionary string, frames binary",
    )
    blocks.write.option("compression", "zstd").parquet(f"{folder}/blocks")
    shared = [(_hash(dictionary), dictionary)] if dictionary else []
    spark.createDataFrame(shared, "hash string, dictionary binary").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("ids")
    )
    # One row per part.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select(
        "part", "ids", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before")
    ).coalesce(1).write.parquet(f"{folder}/parts")


def _reader(dictionaries: dict[str, bytes], key_kind: pa.DataType, wanted: frozenset | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, zstandard.ZstdDecompressor] = {}
        for batch in batches:
            for row in batch.to_pylist():
                name = row["dictionary"]
                if name not in held:
                    shared = {}
                    if name:
                        dictionary = dictionaries[name]
                        if _hash(dictionary) != name:
                            raise ValueError("not the dictionary that the blocks were written with")
                        shared["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
                    held[name] = zstandard.ZstdDecompressor(**shared)
                unpack, kind = held[name].decompress, np.dtype(f"<u{row['width']}")
                frames = memoryview(row["frames"])
                counts, ends = np.array(row["counts"], dtype=np.int64), row["ends"]
                starts = row["part_before"] + row["before"] + np.cumsum(counts) - counts
                some = [
                    i for i, key in enumerate(row["keys"]) if wanted is None or key in wanted
                ]
                ids = [
                    np.frombuffer(
                        unpack(frames[ends[i - 1] if i else 0 : ends[i]]), dtype=kind
                    ).astype("<u4")
                    for i in some
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["keys"][i] for i in some], key_kind),
                        pa.array(starts[some], pa.int64()),
                        pa.array(counts[some], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return read


def _decoded(spark: SparkSession, folder: str, blocks: DataFrame, wanted: frozenset | None):
    dictionaries = {
        r.hash: bytes(r.dictionary)
        for r in spark.read.parquet(f"{folder}/dictionary").collect()  # one, of DICTIONARY_BYTES
    }
    parts = spark.read.parquet(f"{folder}/parts").select("part", F.col("before").alias("part_before"))
    kind = blocks.schema["low"].dataType
    key_name, arrow_kind = kind.simpleString(), to_arrow_type(kind)
    rows = blocks.join(parts, "part").select(
        "part_before", "before", "keys", "counts", "ends", "width", "dictionary", "frames"
    )
    return rows.mapInArrow(
        _reader(dictionaries, arrow_kind, wanted),
        f"doc_id {key_name}, start long, n_tokens long, ids binary",
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the files below ``folder``.

    ``start`` is the number of ids of all documents before it, ``ids`` its ids as little-endian
    unsigned 32-bit numbers, the end id included.
    """
    return _decoded(spark, folder, spark.read.parquet(f"{folder}/blocks"), None)


def lookup(spark: SparkSession, folder: str, keys: list) -> DataFrame:
    """The documents with one of some ``keys``, as ``read`` gives them.

    Blocks whose range holds none of them are skipped by the scan; of the others only the
    frames asked for are decompressed.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    wanted = sorted(set(keys))
    if not wanted:
        return _decoded(spark, folder, blocks.limit(0), frozenset())
    inside = F.lit(False)
    for key in wanted:
        inside = inside | ((F.col("low") <= F.lit(key)) & (F.col("high") >= F.lit(key)))
    return _decoded(spark, folder, blocks.where(inside), frozenset(wanted))
