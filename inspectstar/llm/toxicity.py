"""Toxicity of texts whose words may be disguised.

A noisy channel turns letters into look-alikes, repeats them, or puts spaces and marks
between them. Words that show such traces, and neighbours that may be parts of one word,
become a lattice: a sign offers the letters it may stand for or itself, a repeated sign may
stand for one or two, a mark or a gap may be a word edge or nothing. Viterbi decoding under
a character model (a letter after the three before it in its word, counted over all
documents) picks the likeliest words; the literal reading is one of the paths, so it stays
where it is likelier.

Which plain words enter the lattice is decided by the same costs, for all words of a slice
at once: a word with one doubled letter, or two neighbours with one space between them, can
only be read in two ways, and is decoded if the other way is likelier. Words with further
traces are always decoded.

Features of the restored words (the word, its first 4, 5 and 6 bytes) get log odds from
labelled documents; a document's evidence is the sum over its different words of their
strongest feature, and isotonic regression on rows kept apart turns the evidence into a
probability.

Learning uses at most about ``TRAINING_ROWS`` labelled rows, those with the lowest hashed
id; the character model covers all rows.

Defined results: null and empty texts have no evidence and get the score of texts without
any; equal texts get equal scores; labels other than 0 and 1 are not learned from;
without labelled rows, or without both labels, every score is the share of label 1 (0 if
there is none). Very long texts and words are decoded whole, in time in proportion to their
length. Columns of any name are carried along in ``doc``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.common import schema_with_doc, wrapped
from inspectstar.llm.quality import isotonic
from inspectstar.llm.words import Slice, Words, mix64, slices, span_hashes
from inspectstar.scratch import Scratch

TRAINING_ROWS = 500_000
#: A feature needs this many of the toxic training rows, however many there are.
LEAST_SUPPORT = 4
#: Least log odds of a feature, less their standard error.
ODDS = 3.0
HISTOGRAM = 20  # bins per unit of evidence
PREFIXES = (4, 5, 6)

# Letters that a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou",
    "€": "e", "£": "l", "¡": "i",
}
#: What the channel asks, in nats: a letter shown as a look-alike; a look-alike that means
#: nothing; a stretched letter meant twice; a doubled letter meant once, in a word with one
#: of them or with more.
LOOK_ALIKE_COST, DROP_COST, SINGLE_COST = 1.5, 6.0, 0.5
DOUBLE_COST, DOUBLES_COST = 7.0, 3.0
#: A look-alike that means itself, digit or not.
DIGIT_COST, SIGN_COST = 2.0, 4.5
#: A gap inside a word: a mark; a space; a space between single signs; a wider gap, in addition.
MARK_COST, SPACE_COST, SPELLED_COST, WIDE_COST = 3.0, 7.0, 1.0, 4.0
CACHED_BYTES = 64  # longer chains of words are decoded each time

_SYMBOLS = 28  # a..z, other letters, word edge
_EDGE, _OTHER = 27, 26
_SYMBOL = np.full(256, _EDGE, dtype=np.uint8)
_SYMBOL[128:] = _OTHER
for _code in range(26):
    _SYMBOL[ord("a") + _code] = _SYMBOL[ord("A") + _code] = _code
_NEW_WORD = (_EDGE * _SYMBOLS + _EDGE) * _SYMBOLS + _EDGE


def _mask(signs: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[[ord(c) for c in signs]] = True
    return mask


_DISGUISE = _mask("".join(c for c in LOOK_ALIKES if ord(c) < 128))
_DIGIT = _mask("0123456789")
_JOINER = _mask("._-~*/\\")
_OPENING = _mask("\"'([{,;:*_~")
_CLOSING = _mask(".,;:!?\"')]}*_~")
_SPELLING = _mask("0123456789@$") | (_SYMBOL != _EDGE)  # what may stand alone for a letter


class Letters:
    """The bytes of a slice as symbols, one edge before each text, with their contexts."""

    def __init__(self, piece: Slice):
        owner = np.repeat(np.arange(len(piece)), np.diff(piece.bounds))
        self.at = np.arange(len(piece.data)) + owner + 1  # place of each byte
        n = len(piece.data) + len(piece) + 4
        self.symbol = np.full(n, _EDGE, dtype=np.uint8)
        self.symbol[self.at] = _SYMBOL[piece.data]
        # The three symbols before, as one number; what lies before an edge does not count.
        before = np.full((3, n), _EDGE, dtype=np.uint8)
        before[0, 1:] = self.symbol[:-1]
        for k in (1, 2):
            seen = before[k - 1] != _EDGE
            before[k, k + 1 :] = np.where(seen[k + 1 :], self.symbol[: -k - 1], _EDGE)
        self.context = (
            before[2].astype(np.int32) * _SYMBOLS + before[1]
        ) * _SYMBOLS + before[0]

    def within(self, flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many flags are set at the symbols of each span of bytes."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[self.at[end - 1] + 1] - total[self.at[start]]


def _after(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The context after ``symbol``, a letter."""
    return context % _SYMBOLS**2 * _SYMBOLS + symbol


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS**4, dtype=np.int64)
    for batch in batches:
        for piece in slices(batch.column(0)):
            letters = Letters(piece)
            total += np.bincount(
                letters.context * _SYMBOLS + letters.symbol, minlength=len(total)
            )
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Negative log probability of a symbol after the three before it, counted over all texts."""
    counted = docs.select("text").mapInArrow(_count_letters, "cell long, n long")
    held = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # 28^4 rows at most
    table = np.zeros(_SYMBOLS**4)
    table[held["cell"].to_numpy(dtype=int)] = held["n"]
    table = table.reshape((_SYMBOLS,) * 4)
    table[_EDGE, _EDGE, _EDGE, _EDGE] = 0  # gaps between words
    likely = table.sum(axis=(0, 1, 2)) + 1
    likely = likely / likely.sum()
    for axes in ((0, 1), (0,), ()):
        shares = table.sum(axis=axes) + 5 * likely
        likely = shares / shares.sum(axis=-1, keepdims=True)
    return -np.log(likely).astype(np.float32)


def _symbols(text: str) -> tuple[int, ...]:
    """``text`` as the character model sees it: bytes of letters, an edge for any other sign."""
    out: list[int] = []
    for c in text:
        out += _SYMBOL[list(c.encode())].tolist() if c.isalpha() else [_EDGE]
    return tuple(out)


@lru_cache(10_000)
def _readings(sign: str, count: int, doubled: float) -> tuple[tuple[str, float, tuple[int, ...]], ...]:
    """What ``count`` times ``sign`` may stand for: (text, cost, symbols).

    ``doubled`` is asked for a doubled letter that is meant once.
    """
    letters = sign if sign.isalpha() else LOOK_ALIKES.get(sign, "")
    own = 0.0 if sign.isalpha() else LOOK_ALIKE_COST
    once = doubled if count == 2 else 0.0
    steps = [(c, own + once) for c in letters]
    if count >= 2:
        steps += [(c + c, own + (SINGLE_COST if count > 2 else 0.0)) for c in letters]
    if not sign.isalpha():
        if letters:
            steps.append(("", DROP_COST + (WIDE_COST if count > 1 else 0.0)))
            steps.append((sign * count, (DIGIT_COST if sign.isdigit() else SIGN_COST) * count))
        else:
            steps.append(("", MARK_COST + (WIDE_COST if count > 1 else 0.0)))
            steps.append((" ", 0.0))
    return tuple((text, cost, _symbols(text)) for text, cost in steps)


def _gap(before: str, width: int, after: str) -> tuple[tuple[str, float, tuple[int, ...]], ...]:
    """What the space between two words may stand for."""
    cost = SPELLED_COST if len(before) == len(after) == 1 else SPACE_COST
    return ("", cost + (WIDE_COST if width > 1 else 0.0), ()), (" ", 0.0, (_EDGE,))


def _lattice(text: str) -> Iterator[tuple[tuple[str, float, tuple[int, ...]], ...]]:
    parts = re.split("( +)", text)
    for i, part in enumerate(parts):
        if i % 2:
            yield _gap(parts[i - 1], len(part), parts[i + 1])
        else:
            runs = [(run.group(1), len(run.group())) for run in re.finditer(r"(.)\1*", part, re.S)]
            pairs = sum(count == 2 for _, count in runs)
            for sign, count in runs:
                yield _readings(sign, count, DOUBLES_COST if pairs > 1 else DOUBLE_COST)


def _decode(text: str, costs: list[float]) -> str:
    """The likeliest words behind ``text``: Viterbi, states the last three symbols of a word."""
    paths: dict[int, tuple[float, tuple]] = {_NEW_WORD: (0.0, ())}
    for readings in _lattice(text):
        after: dict[int, tuple[float, tuple]] = {}
        for start, (base, trail) in paths.items():
            for shown, cost, symbols in readings:
                state, total = start, base + cost
                for symbol in symbols:
                    if symbol == _EDGE:
                        if state != _NEW_WORD:
                            total += costs[state * _SYMBOLS + _EDGE]
                        state = _NEW_WORD
                    else:
                        total += costs[state * _SYMBOLS + symbol]
                        state = state % _SYMBOLS**2 * _SYMBOLS + symbol
                if state not in after or total < after[state][0]:
                    after[state] = (total, (trail, shown) if shown else trail)
        paths = after
    ends = (
        (total + (costs[state * _SYMBOLS + _EDGE] if state != _NEW_WORD else 0.0), state)
        for state, (total, _) in paths.items()
    )
    shown, trail = [], paths[min(ends)[1]][1]
    while trail:
        trail, part = trail
        shown.append(part)
    return " ".join("".join(reversed(shown)).split())


def restore_word(word: str, costs: np.ndarray) -> str:
    """The likeliest reading of ``word``, or of words with spaces between them."""
    return _decode(word.lower(), costs.ravel().tolist())


@dataclass
class Restored:
    """The words of a slice without disguise: plain ones by position, others by text."""

    document: np.ndarray
    start: np.ndarray
    end: np.ndarray
    other_document: np.ndarray
    other: list[str]
    #: First and last word of the slice, and the text that replaces them.
    place: list[tuple[int, int, str]] = field(default_factory=list)


class Restorer:
    def __init__(self, costs: np.ndarray):
        self.costs = costs.ravel()

    def __getstate__(self) -> np.ndarray:
        return self.costs

    def __setstate__(self, costs: np.ndarray) -> None:
        self.costs = costs

    def _reading(self, text: str) -> str:
        if "_cache" not in self.__dict__:
            costs = self.costs.tolist()
            self._decode = lambda shown: _decode(shown, costs)
            self._cache = lru_cache(100_000)(self._decode)
        return (self._cache if len(text) <= CACHED_BYTES else self._decode)(text)

    def _cost(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return self.costs[context * _SYMBOLS + symbol]

    def _doubled(self, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
        """Flags at the second letter of a pair, and of pairs likelier to mean one letter."""
        symbol, context = letters.symbol, letters.context
        same = np.zeros(len(symbol) + 1, dtype=bool)
        same[1:-1] = (symbol[1:] == symbol[:-1]) & (symbol[1:] < _OTHER)
        pair = same[:-1] & ~same[1:]
        pair[1:] &= ~same[:-2]
        at = np.flatnonzero(pair)
        x, near, far = symbol[at], symbol[at + 1], symbol[at + 2]
        # As shown: x after x, then the two that follow; meant once: those two alone.
        shown = self._cost(context[at], x) + self._cost(context[at + 1], near)
        meant = self._cost(context[at], near)
        inner = near != _EDGE
        shown += inner * self._cost(context[at + 2], far)
        meant += inner * self._cost(_after(context[at], near), far)
        likelier = np.zeros(len(symbol), dtype=bool)
        likelier[at[shown > meant + DOUBLE_COST]] = True
        return pair, likelier

    def _joined(self, letters: Letters, end: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether one word is likelier than one that ends at ``end``, one from ``start`` on."""
        symbol, context = letters.symbol, letters.context
        edge, first = letters.at[end - 1] + 1, letters.at[start]
        shown = self._cost(context[edge], symbol[edge])
        meant, state, inner = 0.0, context[edge], True
        for k in range(3):
            letter = symbol[first + k]
            shown = shown + inner * self._cost(context[first + k], letter)
            meant = meant + inner * self._cost(state, letter)
            state, inner = _after(state, letter), inner & (letter != _EDGE)
        return shown > meant + SPACE_COST

    @staticmethod
    def _core(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words without punctuation and threefold marks at their edges; maybe empty."""
        n = len(data)
        place = np.arange(n)
        change = np.flatnonzero(data[1:] != data[:-1])
        begin = np.concatenate([[0], change + 1])
        size = np.diff(np.append(begin, n))
        run, junk = np.repeat(begin, size), np.repeat(size > 2, size)
        junk &= (_SYMBOL[data] == _EDGE) & ~_DIGIT[data]
        stop = run + np.repeat(size, size)
        opened = np.where(_OPENING[data], n, place)
        opened = np.append(np.minimum.accumulate(opened[::-1])[::-1], n)
        closed = np.maximum.accumulate(np.where(_CLOSING[data], -1, place))
        low, high = np.minimum(opened[start], end), np.maximum(closed[end - 1] + 1, start)
        for _ in range(2):  # marks, then what stood inside them
            some = low < high
            at = np.where(some & junk[np.minimum(low, n - 1)], stop[np.minimum(low, n - 1)], low)
            low = np.where(at > low, np.minimum(opened[np.minimum(at, n)], end), low)
            some = low < high
            at = np.where(some & junk[high - 1], run[high - 1], high)
            high = np.where(at < high, np.maximum(closed[np.maximum(at - 1, 0)] + 1, start), high)
        return np.minimum(low, end - 1), np.maximum(high, np.minimum(low, end - 1))

    def restore(self, piece: Slice, words: Words) -> Restored:
        """``piece`` in lower case."""
        data, start, end = piece.data, words.start, words.end
        if not len(start):
            none = np.zeros(0, dtype=np.int64)
            return Restored(none, none, none, none, [])
        letters = Letters(piece)
        owner = words.document()

        def around(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The part of each word from its first to its last flag; empty without one."""
            place = np.arange(len(data))
            following = np.minimum.accumulate(np.where(flags, place, len(data))[::-1])[::-1]
            previous = np.maximum.accumulate(np.where(flags, place, -1))
            first, last = following[start], previous[end - 1] + 1
            some = first < end
            return np.where(some, first, start), np.where(some, last, start)

        def marked(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
            return total[high] - total[low]

        letter = _SYMBOL[data] != _EDGE
        first, last = around(letter)
        lettered = last > first
        low, high = self._core(data, start, end)

        sign = _DISGUISE[data]
        # Look-alikes of several bytes.
        sign[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0xA1) | (data[1:] == 0xA3))
        sign[:-2] |= (data[:-2] == 0xE2) & (data[1:-1] == 0x82) & (data[2:] == 0xAC)
        signs = marked(sign, low, high)
        joint = np.zeros(len(data), dtype=bool)
        joint[1:-1] = _JOINER[data[1:-1]] & (letter | sign)[:-2] & (letter | sign)[2:]
        joints = marked(joint, low, high)
        numeric = marked(_DIGIT[data], low, high)
        symbol = letters.symbol
        triple = np.zeros(len(symbol), dtype=bool)
        triple[2:] = (symbol[2:] == symbol[1:-1]) & (symbol[1:-1] == symbol[:-2])
        triple &= symbol < _OTHER
        pair, likelier = self._doubled(letters)
        bare = (signs == high - low) & (signs > numeric) & (high - low >= 2)
        odd = lettered & (
            (signs > 0)
            | (joints > 0)
            | (letters.within(triple, start, end) > 0)
            | (letters.within(pair, start, end) > 1)
            | (letters.within(likelier, start, end) > 0)
        )
        odd |= bare
        # One code point that can stand for a letter.
        single = (marked((data & 0xC0) != 0x80, low, high) == 1) & _SPELLING[data[low]]

        # Gaps that may lie inside a word: nothing but spaces, and a reason on both sides.
        spaces = (high[:-1] == end[:-1]) & (low[1:] == start[1:]) & (owner[1:] == owner[:-1])
        trace = odd | single
        inside = spaces & trace[:-1] & trace[1:]
        pure = lettered & (last - first == high - low) & (marked(letter, low, high) == high - low)
        asked = np.flatnonzero(spaces & ~inside & pure[:-1] & pure[1:] & (start[1:] - end[:-1] == 1))
        inside[asked[self._joined(letters, end[asked], start[asked + 1])]] = True

        # Chains of words without an edge that is certain.
        head = np.flatnonzero(np.concatenate([[True], ~inside]))
        size = np.diff(np.append(head, len(start)))
        told = np.add.reduceat((lettered | bare).astype(np.int64), head) > 0
        chosen = ((size > 1) & told) | ((size == 1) & odd[head])
        plain = lettered & ~np.repeat(chosen, size)
        others, owners, places = [], [], []
        for a, n in zip(head[chosen].tolist(), size[chosen].tolist(), strict=True):
            parts = [data[low[a] : high[a]].tobytes().decode("utf-8", "replace")]
            for k in range(a + 1, a + n):
                parts.append(" " * min(int(start[k] - end[k - 1]), 2))
                parts.append(data[low[k] : high[k]].tobytes().decode("utf-8", "replace"))
            text = self._reading("".join(parts))
            places.append((a, a + n - 1, text))
            for word in text.split():
                others.append(word)
                owners.append(owner[a])
        return Restored(
            owner[plain], first[plain], last[plain], np.array(owners, dtype=np.int64), others, places
        )

    def features(self, texts: pa.Array) -> Iterator[tuple[Slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(slice, document, word, feature hash) of the restored words of each slice."""
        for piece in slices(texts):
            piece = piece.lowered()
            if not len(piece.data):
                yield piece, *(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64))
                continue
            found = self.restore(piece, piece.words())
            raw = [t.encode() for t in found.other]
            size = np.array([len(t) for t in raw], dtype=np.int64)
            stop = np.cumsum(size) + len(piece.data)
            data = np.concatenate([piece.data, np.frombuffer(b"".join(raw), dtype=np.uint8)])
            document = np.concatenate([found.document, found.other_document])
            start = np.concatenate([found.start, stop - size])
            end = np.concatenate([found.end, stop])
            some = end > start
            document, start, end = document[some], start[some], end[some]
            word = span_hashes(data, start, end)
            # Different words of each document.
            with np.errstate(over="ignore"):
                key = mix64(word + mix64(document.astype(np.uint64) + np.uint64(1)))
            _, once = np.unique(key, return_index=True)
            document, start, end, word = document[once], start[once], end[once], word[once]
            parts = [(document, word, word)]
            for n in PREFIXES:
                long = np.flatnonzero(end - start > n)
                prefix = span_hashes(data, start[long], start[long] + n) + np.uint64(n)
                parts.append((document[long], word[long], prefix))
            yield piece, *(np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass
class ToxicityModel:
    restorer: Restorer
    feature: np.ndarray  # sorted hashes
    odds: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def evidence(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        if not len(self.feature):
            return out
        for piece, document, word, feature in self.restorer.features(texts):
            at = np.minimum(np.searchsorted(self.feature, feature), len(self.feature) - 1)
            hit = np.flatnonzero(self.feature[at] == feature)
            # The strongest feature of each word counts.
            order = hit[np.lexsort((-self.odds[at[hit]], word[hit], document[hit]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (word[order[1:]] != word[order[:-1]]) | (
                document[order[1:]] != document[order[:-1]]
            )
            order = order[new]
            sums = np.bincount(document[order], self.odds[at[order]], minlength=len(piece))
            out[piece.first : piece.last] = sums
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        return np.interp(self.evidence(texts), self.knots, self.levels)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    costs: np.ndarray,
    scratch: Scratch,
    limit: int = TRAINING_ROWS,
) -> ToxicityModel:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label), label 0 or 1."""
    labels = labels.select("doc_id", "label").where("doc_id is not null and label in (0, 1)")
    restorer = Restorer(costs)
    total = labels.count()
    if total > limit:
        share = F.pmod(F.hash("doc_id"), F.lit(1 << 31))
        labels = labels.where(share < int(limit / total * (1 << 31)))
    # Bounded by ``limit``, so the labels go to the texts and no text is shuffled.
    labelled = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    rows = scratch.keep(labelled, "labelled")
    # Odds come from two thirds of the rows, calibration from the others.
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(3)) == 0
    learned, kept = rows.where(~apart), rows.where(apart)
    sizes = {r.label: r.n for r in learned.groupBy("label").agg(F.count("*").alias("n")).collect()}
    none = np.zeros(0)
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    constant = ToxicityModel(restorer, none.astype(np.uint64), none, np.array([0.0]), np.array([share]))
    if len(sizes) < 2:
        return constant

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").cast(pa.int64()).to_numpy()
            for piece, document, _, feature in restorer.features(batch.column("text")):
                toxic = label[piece.first : piece.last][document]
                value, at = np.unique(feature, return_inverse=True)
                hits = np.bincount(at, toxic, minlength=len(value)).astype(np.int64)
                misses = np.bincount(at, minlength=len(value)) - hits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(hits), pa.array(misses)],
                    names=["feature", "hits", "misses"],
                )

    counted = learned.select("text", "label").mapInArrow(
        gather, "feature long, hits long, misses long"
    )
    counted = counted.groupBy("feature").agg(
        F.sum("hits").alias("hits"), F.sum("misses").alias("misses")
    )
    hits, misses = F.col("hits") + 0.5, F.col("misses") + 0.5
    odds = F.log(hits / (sizes[1] + 1)) - F.log(misses / (sizes[0] + 1))
    odds -= F.sqrt(1 / hits + 1 / misses)  # less one standard error
    counted = counted.where(F.col("hits") >= LEAST_SUPPORT).select("feature", odds.alias("odds"))
    # Only features that pass are fetched; the bounded label sample bounds them.
    held = counted.where(F.col("odds") >= ODDS).toPandas()
    if not len(held):
        return constant
    feature = held["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(feature)
    feature, odds = feature[order], held["odds"].to_numpy()[order]
    model = ToxicityModel(restorer, feature, odds, np.array([0.0]), np.array([share]))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.ceil(np.minimum(model.evidence(batch.column("text")), 1000) * HISTOGRAM)
            yield pa.RecordBatch.from_arrays(
                [pa.array(step.astype(np.int64)), batch.column("label").cast(pa.int64())],
                names=["step", "label"],
            )

    bins = kept.select("text", "label").mapInArrow(histogram, "step long, label long")
    bins = bins.groupBy("step").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    held = bins.orderBy("step").toPandas()  # at most 1000 * HISTOGRAM + 1 rows
    if len(held):
        model.knots = held["step"].to_numpy() / HISTOGRAM
        model.levels = isotonic(held["n"].to_numpy(), held["hits"].to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc, evidence, score): every row of ``docs`` with its ``text`` left out of ``doc``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = model.evidence(batch.column("text"))
            scores = np.interp(evidence, model.knots, model.levels)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(evidence), pa.array(scores)],
                names=["doc", "evidence", "score"],
            )

    rows = wrapped(docs).select(
        F.col("doc").dropFields("text").alias("doc"), F.col("doc.text").alias("text")
    )
    return rows.mapInArrow(predict, schema_with_doc(rows, "evidence double, score double"))


def restore(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """(doc, restored): every row with its text in lower case, disguised words restored."""
    restorer = Restorer(costs)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for piece in slices(batch.column("text")):
                piece = piece.lowered()
                words = piece.words()
                found = restorer.restore(piece, words) if len(piece.data) else None
                parts: list[list[str]] = [[] for _ in range(len(piece))]
                ends = words.offset
                new = {a: (b, t) for a, b, t in found.place} if found else {}
                for i in range(len(piece)):
                    k = int(ends[i])
                    while k < ends[i + 1]:
                        last, text = new.get(k, (k, None))
                        parts[i].append(words.text(k) if text is None else text)
                        k = int(last) + 1
                texts += [" ".join(p) for p in parts]
            valid = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            column = pa.array(texts, pa.string(), mask=~valid)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), column], names=["doc", "restored"])

    rows = wrapped(docs).withColumn("text", F.col("doc.text"))
    return rows.mapInArrow(rewrite, schema_with_doc(rows, "restored string"))
