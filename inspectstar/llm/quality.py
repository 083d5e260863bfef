"""Quality scores: kernel ridge regression on document statistics, calibrated.

Each text becomes a short vector of statistics. Random Fourier features approximate a
Gaussian kernel over the standardised vectors; every partition of the training rows sums
its part of the normal equations, Spark adds the parts, and the small system is solved on
the driver. Isotonic regression over a histogram of the training scores turns the ridge
score into a probability that never falls as the score rises.

Learning uses at most about ``TRAINING_ROWS`` labelled rows, the ones whose hashed id is
lowest; everything else covers all rows.

Defined results: null and empty texts have all statistics 0 and are scored like any
other; equal texts get equal scores; labels other than 0 and 1 and null ids are not
learned from; without training rows every score is 0.5; repeated rows count repeatedly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.words import Slice, distinct_counts, slices, span_hashes
from inspectstar.scratch import Scratch

TRAINING_ROWS = 500_000
FOURIER = 160
RIDGE = 1e-3
#: Width of the Gaussian kernel, in standard deviations of all statistics together.
WIDTH = 3.0
HISTOGRAM = 400
SEED = 20240607

STATISTICS = (
    "log_words", "word_bytes", "upper", "lower", "digits", "spaces", "marks", "symbols",
    "not_ascii", "distinct_words", "distinct_lines", "line_words", "symbol_words",
    "upper_words", "short_words", "stopped_words",
)

_KIND = np.full(256, 6, dtype=np.uint8)  # not ASCII
_KIND[:128] = 5  # symbols
for _code in range(128):
    _sign = chr(_code)
    if _sign.isupper():
        _KIND[_code] = 0
    elif _sign.islower():
        _KIND[_code] = 1
    elif _sign.isdigit():
        _KIND[_code] = 2
    elif _sign.isspace():
        _KIND[_code] = 3
    elif _sign in ".,;:'\"-()":
        _KIND[_code] = 4


def _statistics(piece: Slice) -> np.ndarray:
    n, data, bounds = len(piece), piece.data, piece.bounds
    out = np.zeros((n, len(STATISTICS)))
    if not len(data):
        return out
    kind = _KIND[data]
    size = np.maximum(np.diff(bounds), 1)
    some = np.flatnonzero(np.diff(bounds) > 0)
    for k in range(7):
        out[some, 2 + k] = np.add.reduceat((kind == k).astype(np.int64), bounds[some]) / size[some]
    words = piece.words()
    count, owner = words.counts(), words.document()
    per = np.maximum(count, 1)
    length = words.end - words.start
    out[:, 0] = np.log1p(count)
    out[:, 1] = np.log1p(np.bincount(owner, length, minlength=n) / per)
    out[:, 9] = distinct_counts(words.hashes(), owner, n) / per
    newline = data == 0x0A
    begin = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(newline) + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    line_owner = np.searchsorted(bounds, begin, side="right") - 1
    lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
    out[:, 10] = distinct_counts(span_hashes(data, begin, stop), line_owner, n) / lines
    out[:, 11] = np.log1p(count / lines)
    first, last = kind[words.start], kind[words.end - 1]
    for k, chosen in (
        (12, last == 5),
        (13, (first == 0) & (kind[np.minimum(words.start + 1, words.end - 1)] == 0)),
        (14, length <= 3),
        (15, last == 4),
    ):
        out[:, k] = np.bincount(owner[chosen], minlength=n) / per
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        parts = [_statistics(piece) for piece in slices(texts)]
        values = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
        places = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
        column = pa.ListArray.from_arrays(places, values.ravel())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), column], names=["doc", "stats"])


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, stats): every row of ``docs`` without its text, and the statistics of the text."""
    rows = wrapped(docs).select(
        F.col("doc").dropFields(text).alias("doc"), F.col("doc").getField(text).alias("text")
    )
    return rows.mapInArrow(_describe, schema_with_doc(rows, "stats array<double>"))


@dataclass
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _fourier((stats - self.center) / self.scale) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)


_draws = np.random.default_rng(SEED)
_FREQUENCY = _draws.normal(size=(len(STATISTICS), FOURIER)) / WIDTH
_PHASE = _draws.uniform(0, 2 * np.pi, size=FOURIER)


def _fourier(x: np.ndarray) -> np.ndarray:
    """Random features of standardised rows, with a constant in front."""
    waves = np.cos(np.clip(x, -8, 8) @ _FREQUENCY + _PHASE) * np.sqrt(2 / FOURIER)
    return np.concatenate([np.ones((len(x), 1)), waves], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def isotonic(n: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: rates of bins in ascending order that never fall."""
    blocks: list[list[float]] = []
    for size, hit in zip(n, hits, strict=True):
        blocks.append([size, hit, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    # Half a hit and half a miss keep the rates off 0 and 1.
    return np.concatenate([np.full(k, (hit + 0.5) / (size + 1)) for size, hit, k in blocks])


def fit(
    rows: DataFrame, limit: int = TRAINING_ROWS, scratch: Scratch | None = None
) -> QualityModel:
    """Learns from ``rows`` (doc_id, stats, label), label 0 or 1.

    With ``scratch`` the labelled rows and the sample of them are written once; without it,
    ``rows`` is computed for each of the three passes.
    """
    rows = rows.where("doc_id is not null and label in (0, 1)")
    if scratch is not None:
        rows = scratch.keep(rows.select("doc_id", "stats", "label"), "labelled-statistics")
    # Statistics of the statistics: a handful of numbers.
    moments = rows.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"mean{i}") for i in range(len(STATISTICS))],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"dev{i}") for i in range(len(STATISTICS))],
    ).first()
    if not moments.n:
        return QualityModel(
            np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)), np.zeros(FOURIER + 1),
            np.array([0.0]), np.array([0.5]),
        )
    center = np.array([moments[f"mean{i}"] for i in range(len(STATISTICS))])
    scale = np.array([moments[f"dev{i}"] for i in range(len(STATISTICS))])
    scale = np.where(scale > 1e-9, scale, 1.0)
    if moments.n > limit:
        share = int(limit / moments.n * (1 << 31))
        rows = rows.where(F.pmod(F.hash("doc_id"), F.lit(1 << 31)) < share)
        if scratch is not None:
            rows = scratch.keep(rows, "sampled-statistics")
    width = FOURIER + 1
    upper = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, moment = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            z = _fourier((_matrix(batch.column("stats")) - center) / scale)
            gram += z.T @ z
            moment += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        values = np.concatenate([gram[upper], moment])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values))), pa.array(values)], names=["cell", "part"]
        )

    # The sample is bounded, so a few partitions hold it, and each sends one small matrix.
    learned = rows.select("stats", "label").coalesce(32)
    parts = learned.mapInArrow(partial, "cell long, part double")
    summed = parts.groupBy("cell").agg(F.sum("part").alias("value")).toPandas()
    values = np.zeros(len(upper[0]) + width)
    values[summed["cell"].to_numpy(dtype=int)] = summed["value"]
    gram = np.zeros((width, width))
    gram[upper] = values[: len(upper[0])]
    gram = gram + np.triu(gram, 1).T
    count = gram[0, 0]
    penalty = np.full(width, RIDGE * count)
    penalty[0] = 0
    beta = np.linalg.solve(gram + np.diag(penalty + 1e-9), values[len(upper[0]) :])
    model = QualityModel(center, scale, beta, np.array([0.0]), np.array([0.5]))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column("stats")))
            step = np.clip(np.floor(raw * HISTOGRAM / 2), -HISTOGRAM, HISTOGRAM).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(step), batch.column("label").cast(pa.int64())], names=["step", "label"]
            )

    bins = learned.mapInArrow(histogram, "step long, label long").groupBy("step")
    held = bins.agg(F.count("*").alias("n"), F.sum("label").alias("hits")).orderBy("step").toPandas()
    model.knots = (held["step"].to_numpy() + 0.5) * 2 / HISTOGRAM
    model.levels = isotonic(held["n"].to_numpy(), held["hits"].to_numpy())
    return model


def score(described: DataFrame, model: QualityModel) -> DataFrame:
    """(doc, score) of the rows of ``describe``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(scores)], names=["doc", "score"]
            )

    return described.mapInArrow(predict, schema_with_doc(described, "score double"))
