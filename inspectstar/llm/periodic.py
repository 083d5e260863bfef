"""Periodic runs in the words of a text: multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST`` words and
``TIMES`` periods long, that no neighbouring word extends with that period. Periods up to
``SCANNED`` are found by comparing the words directly with those so many places on. Longer
ones fall to scales, each for the periods above ``low`` up to ``high``: of every window of
2 * (low + 1) - high + 1 places the k-grams of ``high`` words with the smallest hash are
minimizers. Inside a run of such a period q a k-gram occurs at distances of q only, and a
window and the one q places on, both inside, have the same minimum: the run holds
neighbouring equal minimizers at distance q. These pairs, for each scale, are the seeds; each
is extended both ways by halving the distance to the first difference, with hashes of
prefixes. What is long enough is a run, and is compared word by word. A stretch found
with several periods is a run of the smallest.

Nothing is compared with more than its neighbour: the work is in proportion to the words,
times the scales, whose number is the logarithm of the longest text's words. Texts are
independent, so nothing is shuffled.

Words are told apart by 64 bits of hash.

Defined results: null and empty texts have no words and no runs, their collapsed text is empty;
a text of any length is treated as a whole, in one task's memory; equal rows get equal
results, one each; an empty table gives an empty result; further columns, whatever their
names, stay inside ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.words import Words, mix64, slices, within

LEAST = 24
TIMES = 3
#: Periods found by direct comparison.
SCANNED = 8
#: A scale's largest period, by its smallest: at most 4 / 3 of it, so that windows stay long.
_RATIO = (4, 3)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Prefixes:
    """Hashes of any stretch of a word sequence, by prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(words * _powers(_BASE, n + 1)[:n], out=self.total[1:])
        self.down = _powers(_BASE_INVERSE, n + 1)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.total[end] - self.total[start]) * self.down[start]

    def grams(self, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = self.total[size:] - self.total[:-size]
            return mix64(sums * self.down[: len(sums)])


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every ``width`` consecutive values."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = best(values[: len(values) - step], values[step:])
        reach += step
    return values


def minimizers(hashes: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the smallest of one of the ``windows``, given by their starts."""
    least = _slide(hashes, width, np.minimum)
    shown = np.zeros(len(least) + 2 * (width - 1), dtype=np.uint64)
    shown[windows + width - 1] = least[windows]
    # The largest of the minima of the windows over a place; no window: 0.
    return np.flatnonzero(_slide(shown, width, np.maximum) == hashes)


def _agreeing(
    prefixes: _Prefixes, left: np.ndarray, right: np.ndarray, most: np.ndarray, back: bool
) -> np.ndarray:
    """How many words from ``left`` and ``right`` on (or before them) agree, ``most`` at most."""
    low, high = np.zeros(len(left), dtype=np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) >> 1
        if back:
            same = prefixes.stretch(left - middle, left) == prefixes.stretch(right - middle, right)
        else:
            same = prefixes.stretch(left, left + middle) == prefixes.stretch(right, right + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _scanned(words: np.ndarray, owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(start, end, period) of the stretches with the shortest periods."""
    found = []
    for lag in range(1, min(SCANNED, len(words) - 1) + 1):
        same = np.zeros(len(words) - lag + 2, dtype=np.int8)
        same[1:-1] = (words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag])
        change = np.diff(same)
        start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        keep = stop - start + lag >= max(LEAST, TIMES * lag)
        found.append((start[keep], stop[keep] + lag, lag))
    return found


def _scale(
    prefixes: _Prefixes, offset: np.ndarray, owner: np.ndarray, low: int, high: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of stretches with periods above ``low``, up to ``high``."""
    width = 2 * (low + 1) - high + 1
    none = np.zeros(0, dtype=np.int64)
    windows = within(offset, width + high - 1)
    if not len(windows):
        return none, none, none
    hashes = prefixes.grams(high)
    place = minimizers(hashes, windows, width)
    with np.errstate(over="ignore"):
        key = hashes[place] ^ mix64(owner[place].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    place, key = place[order], key[order]
    lag = place[1:] - place[:-1]
    pair = np.flatnonzero((key[1:] == key[:-1]) & (lag > low) & (lag <= high))
    left, lag = place[pair], lag[pair]
    right = left + lag
    pair = owner[left] == owner[right]
    left, right, lag = left[pair], right[pair], lag[pair]
    document = owner[left]
    ahead = _agreeing(prefixes, left, right, offset[document + 1] - right, False)
    behind = _agreeing(prefixes, left, right, left - offset[document], True)
    start, end = left - behind, right + ahead
    keep = end - start >= np.maximum(LEAST, TIMES * lag)
    return start[keep], end[keep], lag[keep]


def find(words: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs, by start, then period.

    ``words`` are 64-bit hashes, those of text i from ``offset[i]`` to ``offset[i + 1]``.
    """
    count = np.diff(offset)
    owner = np.repeat(np.arange(len(count)), count)
    found = [(s, e, np.full(len(s), lag)) for s, e, lag in _scanned(words, owner)]
    low = SCANNED
    kept, own_words, own_offset, base = np.arange(len(count)), words, offset, None
    prefixes = None
    while True:
        long = count[kept] >= max(LEAST, TIMES * (low + 1))
        if not long.any():
            break
        if not long.all() or prefixes is None:
            # Only texts long enough for the scale take part.
            kept = kept[long]
            size = count[kept]
            own_offset = np.concatenate([[0], np.cumsum(size)])
            own = np.repeat(np.arange(len(kept)), size)
            base = offset[kept] - own_offset[:-1]
            own_words = words[np.arange(own_offset[-1]) + base[own]]
            prefixes = _Prefixes(own_words)
        high = max(low + 1, low * _RATIO[0] // _RATIO[1])
        start, end, lag = _scale(prefixes, own_offset, own, low, high)
        if len(start):
            shift = base[own[start]]
            found.append((start + shift, end + shift, lag))
        low = high
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    runs = np.unique(np.column_stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=0)
    # Of one stretch the smallest period comes first.
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    true = [np.array_equal(words[s : e - q], words[s + q : e]) for s, e, q in runs]
    runs = runs[np.array(true, dtype=bool)]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: Words, runs: np.ndarray) -> pa.Array:
    """The texts without what repeats inside runs, words joined by one space."""
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    owner = words.document()[kept]
    # A kept word takes the byte after it, but for the last of its text: that becomes a space.
    more = np.zeros(len(kept), dtype=np.int64)
    more[:-1] = owner[1:] == owner[:-1]
    size = words.end[kept] - words.start[kept] + more
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.start[kept] - ends + size, size)
    data = words.piece.data[at] if len(at) else np.zeros(0, dtype=np.uint8)
    data[ends[more > 0] - 1] = 0x20
    bounds = np.concatenate([[0], ends])[np.searchsorted(owner, np.arange(len(words.piece) + 1))]
    text = pa.LargeStringArray.from_buffers(
        len(words.piece), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes())
    )
    return text.cast(pa.string())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch.column("text")):
            words = piece.words()
            runs = find(words.hashes(), words.offset)
            holder = np.searchsorted(words.offset, runs[:, 0], side="right") - 1
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(runs[:, 0] - words.offset[holder]),
                    pa.array(runs[:, 1] - runs[:, 0]),
                    pa.array(runs[:, 2]),
                ],
                names=["start", "length", "period"],
            )
            bounds = np.searchsorted(holder, np.arange(len(piece) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").slice(piece.first, len(piece)),
                    pa.array(words.counts()),
                    pa.ListArray.from_arrays(pa.array(bounds), spans),
                    _collapsed(words, runs),
                ],
                names=["doc", "n_words", "runs", "collapsed"],
            )


def collapse(docs: DataFrame) -> DataFrame:
    """(doc, n_words, runs, collapsed) for every row of ``docs``, its text left out of ``doc``.

    ``runs`` has (start, length, period) in words, by start, then period; ``collapsed`` is the
    text of which each run keeps its first period, words joined by one space.
    """
    rows = wrapped(docs)
    rows = rows.select(
        F.col("doc").dropFields("text").alias("doc"), F.col("doc.text").alias("text")
    )
    columns = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_runs, schema_with_doc(rows, columns))


def strongest(runs: Column) -> Column:
    """Of an array of runs the one with the most periods, exactly; the first of equals."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, nothing, better)
