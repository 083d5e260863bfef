"""Language identification with error-correcting output codes.

Every language has a codeword. One binary classifier per bit, naive Bayes over hashed
byte 1-, 2- and 3-grams, tells the languages with that bit set from the others. The
classifiers all come from one table of gram counts by language, summed on Spark over every
training row. A text gets a margin per bit; decoding weighs the logistic loss of each bit
by how well that bit separates the language in question and takes the nearest codeword. A
text whose two nearest codewords are closer than ``MARGIN`` is flagged as ambiguous.

Defined results: null text, empty text and text without a letter give ``und`` with score 0
and are ambiguous; equal texts get equal results; without training rows everything is
``und``; ties go to the first language in code point order. Rows with null text or lang
are not learned from. The model holds (languages x bins) counts and needs at most
``MOST_LANGUAGES`` languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.words import mix64, slices

UNDETERMINED = "und"
#: Bins of the hashed 2-grams and 3-grams; 1-grams have a bin each.
BINS = (1 << 12, 1 << 14)
MOST_LANGUAGES = 512
#: Grams that count as full evidence; the mean margin of a longer text is scaled by this.
EVIDENCE = 40.0
MARGIN = 0.05
SMOOTHING = 0.5
#: Text bytes whose grams are held at once.
SLICE_BYTES = 250_000

_N_BINS = 256 + sum(BINS) + 1  # the last bin takes grams that reach into the next text
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
for _code in range(128):
    if not chr(_code).isalpha():
        _FOLD[_code] = ord(" ")
_PAIR_BIN = (256 + mix64(np.arange(1 << 16)) % np.uint64(BINS[0])).astype(np.int32)


def _grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """For n = 1, 2, 3 the bin of the n-gram that starts at each byte."""
    folded = _FOLD[data].astype(np.uint32)
    yield folded.astype(np.int32)
    last = bounds[1:] - 1  # of texts that are not empty
    last = last[(last >= 0) & (np.diff(bounds) > 0)]
    after = np.append(folded[1:], 0)
    pair = _PAIR_BIN[folded << 8 | after]
    pair[last] = _N_BINS - 1
    yield pair
    third = np.append(folded[2:], [0, 0])[: len(folded)]
    code = (folded << 16 | after << 8 | third).astype(np.uint64)
    triple = (256 + BINS[0] + mix64(code) % np.uint64(BINS[1])).astype(np.int32)
    triple[last] = _N_BINS - 1
    triple[np.maximum(last - 1, 0)] = _N_BINS - 1
    yield triple


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            own = batch.column("text").filter(pa.array(langs == lang))
            total = counts.setdefault(lang, np.zeros(_N_BINS, dtype=np.int64))
            for piece in slices(own, SLICE_BYTES):
                for bins in _grams(piece.data, piece.bounds):
                    total += np.bincount(bins, minlength=_N_BINS)
    for lang, total in counts.items():
        bins = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(bins)), pa.array(bins), pa.array(total[bins])],
            names=["lang", "bin", "n"],
        )


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weight: np.ndarray  # languages x bits, rows sum to 1
    ratio: np.ndarray  # bits x bins


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 and 1: every split of up to 7 classes, else seeded random splits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        columns = [[1] + [1 if split >> i & 1 else -1 for i in range(n - 1)]
                   for split in range(2 ** (n - 1) - 1)]
        return np.array(columns, dtype=float).T
    bits = int(np.ceil(10 * np.log2(n)))
    draws = np.random.default_rng(n)
    best, apart = None, -1
    for _ in range(64):
        code = draws.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        agree = code @ code.T
        np.fill_diagonal(agree, -bits)
        nearest = code.shape[1] - agree.max()
        if nearest > apart:
            best, apart = code, nearest
    return best


def fit(rows: DataFrame) -> LanguageModel:
    """Learns from the columns ``text`` and ``lang`` of ``rows``."""
    known = rows.select("text", "lang").where("text is not null and lang is not null")
    counts = known.mapInArrow(_count_grams, "lang string, bin long, n long")
    summed = counts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    # Bounded by the parameters: at most MOST_LANGUAGES x bins rows.
    held = summed.limit(MOST_LANGUAGES * _N_BINS + 1).toPandas()
    languages = sorted(held["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.zeros((len(languages), _N_BINS))
    place = {lang: i for i, lang in enumerate(languages)}
    table[held["lang"].map(place).to_numpy(dtype=int), held["bin"].to_numpy(dtype=int)] = held["n"]
    code = codewords(len(languages))
    ratio = np.zeros((code.shape[1], _N_BINS))
    if len(languages) > 1:
        # Every language counts alike, however many rows it has.
        share = (table + SMOOTHING) / (table + SMOOTHING).sum(axis=1, keepdims=True)
        for b in range(code.shape[1]):
            ratio[b] = np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(
                share[code[:, b] < 0].mean(axis=0)
            )
        ratio[:, -1] = 0
        apart = np.maximum((share @ ratio.T) * code, 1e-9)
        weight = apart / apart.sum(axis=1, keepdims=True)
    else:
        weight = np.ones_like(code)
    return LanguageModel(languages, code, weight, ratio.astype(np.float32))


def decode(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest language, its score, lead over the second) of margins, texts x bits."""
    losses = np.stack(
        [(np.logaddexp(0, -margins * c) * w).sum(axis=1) for c, w in zip(model.code, model.weight, strict=True)],
        axis=1,
    )
    order = np.argsort(losses, axis=1, kind="stable")
    rows = np.arange(len(losses))
    best = order[:, 0]
    chance = np.exp(losses[rows, best][:, None] - losses)
    score = 1 / chance.sum(axis=1)
    if losses.shape[1] == 1:
        return best, score, np.full(len(losses), np.inf)
    return best, score, losses[rows, order[:, 1]] - losses[rows, best]


def _margins(model: LanguageModel, texts: pa.Array) -> np.ndarray:
    out = np.zeros((len(texts), len(model.ratio)))
    for piece in slices(texts, SLICE_BYTES):
        size = np.diff(piece.bounds)
        some = np.flatnonzero(size > 0)
        if not len(some):
            continue
        for bins in _grams(piece.data, piece.bounds):
            for b, ratio in enumerate(model.ratio):
                sums = np.add.reduceat(ratio[bins], piece.bounds[some], dtype=np.float64)
                out[piece.first + some, b] += sums
        out[piece.first + some] *= (np.minimum(size, EVIDENCE) / size)[some, None]
    return out


def identify(docs: DataFrame, model: LanguageModel, text: Column | None = None) -> DataFrame:
    """(doc, lang_pred, score, ambiguous) for every row of ``docs``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
            known = lettered.to_numpy(zero_copy_only=False) & bool(model.languages)
            names = np.full(len(texts), UNDETERMINED, dtype=object)
            score, lead = np.zeros(len(texts)), np.zeros(len(texts))
            if model.languages:
                best, chance, apart = decode(model, _margins(model, texts))
                names[known] = np.array(model.languages, dtype=object)[best[known]]
                score[known], lead[known] = chance[known], apart[known]
            out = [batch.column("doc"), pa.array(names, pa.string()), pa.array(score), pa.array(lead < MARGIN)]
            yield pa.RecordBatch.from_arrays(out, names=["doc", "lang_pred", "score", "ambiguous"])

    rows = wrapped(docs).withColumn("text", F.col("doc.text") if text is None else text)
    return rows.mapInArrow(predict, schema_with_doc(rows, "lang_pred string, score double, ambiguous boolean"))
