"""Language-model scores: a hierarchical Pitman-Yor model of the next word.

Tokens are the words in lower case (A-Z) and one end per text. A token's context is the two
words before it; before a text stand two starts. Every context is a restaurant: its parent is
that of the last word alone, all of which share the restaurant of words without context, whose
base is even over the training words and one more that stands for any unknown word. Contexts are
the words themselves: as many restaurants as there are pairs of words, at any size.

Customers are the counts of all training texts. The chain starts with one table for each dish.
A Gibbs sweep draws the number of tables of each dish anew, given its customers, the tables
of all other dishes and its parent's probability (``draw_tables``); every table sends a
customer to the parent. Restaurants are swept from the longest contexts down. The state of
a sweep is what the next one starts from: the first ``BURN_IN`` states are passed over, the
predictive probabilities of the next ``SAMPLES`` are averaged. All dishes of
a sweep see the customers and tables of the state before.

Texts are dealt to chunks by hash. A chunk sends its distinct n-grams with their training counts
to the shards of their contexts' last words, one row for each shard. A shard has all contexts that
end in its words (``_Shard``): the customers and tables of their restaurants are known there. Only the
restaurant without context spans shards: its dishes are words, dealt to the same shards by their own
hash. In a sweep a shard sends the tables of its one-word contexts, summed by word, to the words'
shards; these draw, and send back each word's customers and tables (``_Words``). Order is agreed once, so
that values travel without names. States are written after each sweep; draws are hashes of word,
restaurant and sweep, so a lost task gives the same states again. Chunks get back the words' corpus
counts and the n-grams' probabilities, rounded to a ``STEPS``-th of a decade. What goes through the
driver are two sums a sweep. Shards are stored in buckets, so that sweeps do not shuffle them.

Words are told apart by 63 bits of hash.

Defined results: null and empty texts have one token, the end; a text of any length is scored
as a whole; without training rows every token has the probability of the base; equal texts get
equal scores, each row its own; further columns, whatever their names, stay inside ``doc``.
``perplexity`` is 10 ** (-score / n_tokens).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.alignment import _unzip, _zip
from inspectstar.llm.common import schema_with_doc
from inspectstar.llm.words import Slice, mix64, slices
from inspectstar.scratch import Scratch

#: Text bytes of a chunk, about. A shard has about as many words as a chunk.
CHUNK_BYTES = 8_000_000
BLOCK = 250_000
#: Log10 probabilities travel in steps of which a decade has so many.
STEPS = 2048
BURN_IN, SAMPLES = 1, 2
SEED = 5
#: By length of the context in words: none, one, two.
DISCOUNT = (0.6, 0.7, 0.8)
STRENGTH = 1.0
#: Classes of contexts, where a chain is run on classes (``Contexts``): tokens for each, bits at most.
CLASS_TOKENS = 128
MOST_BITS = 20
#: Buckets of a stored table of shards, at most.
MOST_BUCKETS = 10_000
#: Restaurants of classes whose totals travel in one row.
ROOMS = 1 << 15
#: For more customers the Stirling numbers come from their saddle point.
EXACT = 64
GRID = 40
#: Customers are seated in blocks that grow by this share (``seat``).
GROWTH = 0.05

_END, _START = (np.int64(x >> 1) for x in mix64(np.array([77, 78], dtype=np.uint64)))


@dataclass(frozen=True)
class Contexts:
    """How many classes the words of contexts have: ``last`` bits, and ``first`` more.

    A context is the class of its last word, followed by that of its first. Scores know no classes;
    a chain of one process may have them (``_Dishes``), as its restaurants' totals are arrays.
    """

    last: int
    first: int

    @classmethod
    def of(cls, tokens: int) -> Contexts:
        bits = min(max((tokens // CLASS_TOKENS).bit_length(), 6), MOST_BITS)
        return cls(bits - bits // 3, bits // 3)

    @property
    def bits(self) -> tuple[int, int, int]:
        """By length of the context."""
        return 0, self.last, self.last + self.first

    def classes(self, words: np.ndarray, bits: int, salt: int) -> np.ndarray:
        scrambled = mix64(words.view(np.uint64) ^ np.uint64(salt))
        return (scrambled >> np.uint64(64 - bits)).astype(np.int64)


def _words(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of each document and the number of all)."""
    words = piece.lowered().words()
    n = len(piece)
    offset = words.offset + np.arange(n + 1)
    word = np.full(len(words) + n, _END)
    own = np.ones(len(word), dtype=bool)
    own[offset[1:] - 1] = False
    word[own] = (words.hashes() >> np.uint64(1)).view(np.int64)
    return word, offset


def _before(word: np.ndarray, offset: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(last word before each token, the one before that); ``start`` before a document."""
    last, before = np.full(len(word), start), np.full(len(word), start)
    last[1:], before[2:] = word[:-1], word[:-2]
    last[offset[:-1]] = before[offset[:-1]] = start
    second = offset[:-1] + 1
    before[second[second < offset[1:]]] = start
    return last, before


def _tokens(piece: Slice, contexts: Contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, first token of each document and the number of all)."""
    word, offset = _words(piece)
    last, before = _before(word, offset, _START)
    context = contexts.classes(last, contexts.last, 5) << contexts.first
    return word, context | contexts.classes(before, contexts.first, 3), offset


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each chunk, compressed: texts are most of what is shuffled."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        rows = batch.drop_columns(["chunk"]).take(pa.array(order))
        found, first = np.unique(chunk[order], return_index=True)
        blobs = []
        for low, high in zip(first, [*first[1:], len(batch)], strict=True):
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            part = pa.Table.from_batches([rows]).slice(low, high - low).combine_chunks()
            with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                writer.write_table(part)
            blobs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(blobs, pa.binary())],
            names=["chunk", "blob"],
        )


def _unpacked(table: pa.Table) -> Iterator[pa.Table]:
    for blob in table.column("blob"):
        yield pa.ipc.open_stream(blob.as_py()).read_all().combine_chunks()


def _asked(
    table: pa.Table, contexts: Contexts
) -> tuple[np.ndarray, list[tuple[pa.Table, Slice, np.ndarray, np.ndarray]]]:
    """(the words of a chunk, ascending; its slices with the code of each token and its offset).

    A code is the word's place among the words and its context.
    """
    held = [
        (rows, piece, *_tokens(piece, contexts))
        for rows in _unpacked(table)
        for piece in slices(rows.column("text"))
    ]
    item, place = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    out, first = [], 0
    for rows, piece, word, context, offset in held:
        own = place[first : first + len(word)]
        out.append((rows, piece, own << contexts.bits[2] | context, offset))
        first += len(word)
    return item, out


def _ascending(values: np.ndarray) -> np.ndarray:
    """Steps between values, which take fewer bytes."""
    return np.diff(values, prepend=0)


def _stepped(values: np.ndarray) -> np.ndarray:
    """Steps between values that may fall, as numbers from 0 on: 0, -1, 1, -2, ..."""
    steps = np.diff(values, prepend=0)
    return (steps << 1) ^ (steps >> 63)


def _unstepped(steps: np.ndarray) -> np.ndarray:
    return np.cumsum((steps >> 1) ^ -(steps & 1))


_SENT = "shard int, chunk int, words binary"


def _send_words(shards: int, contexts: Contexts):
    """Distinct words of a chunk, with their contexts and training counts, for their shards."""

    def send(table: pa.Table) -> pa.Table:
        item, held = _asked(table, contexts)
        train = [
            np.repeat(rows.column("learns").to_numpy()[piece.first : piece.last], np.diff(offset))
            for rows, piece, _, offset in held
        ]
        code, place = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
        n = np.bincount(place, np.concatenate(train), minlength=len(code)).astype(np.int64)
        word, context = code >> contexts.bits[2], code & ((1 << contexts.bits[2]) - 1)
        size = np.bincount(word, minlength=len(item))
        shard = (mix64(item.view(np.uint64)) % np.uint64(shards)).astype(np.int32)
        found = np.unique(shard)
        rows = []
        for one in found:
            own = shard == one
            pairs = own[word]
            rows.append(_zip(_ascending(item[own]), size[own], context[pairs], n[pairs]))
        return pa.table(
            {
                "shard": found,
                "chunk": np.full(len(found), table.column("chunk")[0].as_py(), dtype=np.int32),
                "words": pa.array(rows, pa.binary()),
            }
        )

    return send


def _arrays(blob: pa.Scalar, n: int) -> list[np.ndarray]:
    out, place, data = [], 0, blob.as_buffer()
    for _ in range(n):
        values, place = _unzip(data, place)
        out.append(values)
    return out


_WORDS = "dishes binary, requests binary, tokens long, kinds long"


def _gather_words(contexts: Contexts):
    """The words of a shard in blocks: their dishes, and who has asked for them."""
    bits = contexts.bits[2]

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        sent = [_arrays(blob, 4) for blob in table.column("words")]
        item, word = np.unique(
            np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True
        )
        size = np.concatenate([s[1] for s in sent])
        chunk = np.repeat(table.column("chunk").to_numpy(), [len(s[1]) for s in sent])
        code = np.repeat(word, size) << bits | np.concatenate([s[2] for s in sent])
        two, asked = np.unique(code, return_inverse=True)
        count = np.bincount(asked, np.concatenate([s[3] for s in sent]), minlength=len(two))
        count = count.astype(np.int64)
        # Requests by word, then chunk.
        order = np.argsort(word, kind="stable")
        first = np.cumsum(size) - size
        ends = np.cumsum(size[order])
        asked = asked[np.arange(len(asked)) + np.repeat(first[order] - ends + size[order], size[order])]
        word, chunk, size = word[order], chunk[order], size[order]
        ends = np.concatenate([[0], ends])
        dishes = np.searchsorted(two >> bits, np.arange(len(item) + 1))
        n = np.add.reduceat(count, dishes[:-1])
        edges = np.unique(np.searchsorted(dishes, np.arange(0, len(two), BLOCK)))
        edges = np.append(edges[edges < len(item)], len(item))
        rows = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            own = slice(dishes[low], dishes[high])
            asks = slice(*np.searchsorted(word, [low, high]))
            pairs = slice(ends[asks.start], ends[asks.stop])
            rows.append(
                (
                    _zip(_ascending(item[low:high]), n[low:high])
                    + _zip(_ascending(two[own] - (low << bits)), count[own]),
                    _zip(word[asks] - low, chunk[asks], size[asks]) + _zip(_stepped(asked[pairs] - own.start)),
                    int(n[low:high].sum()),
                    int((n[low:high] > 0).sum()),
                )
            )
        names = ["dishes", "requests", "tokens", "kinds"]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.table(columns, names=names)

    return gather


def _stirling(discount: float, customers: int, tables: int) -> np.ndarray:
    """Log generalised Stirling numbers up to so many customers and tables."""
    out = np.full((customers + 1, tables + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(1, customers + 1):
        t = np.arange(1, min(c, tables) + 1)
        with np.errstate(divide="ignore"):
            joined = out[c - 1, t] + np.log(np.maximum(c - 1 - discount * t, 0))
        out[c, t] = np.logaddexp(out[c - 1, t - 1], joined)
    return out


def _saddle(c: np.ndarray, u: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """(t, log S(c, t) - log c!) where ``u`` is 1 less the saddle point.

    S(c, t) is c! / t! times the coefficient of x ** c in ((1 - (1 - x) ** d) / d) ** t.
    """
    x = 1 - u
    t = c * (1 - u**d) / (d * x * u ** (d - 1))
    rate = c / t
    curve = np.maximum(rate * (1 + (1 - d) * x / u - rate), 1e-300)
    log = t * np.log((1 - u**d) / d) - c * np.log(x) - 0.5 * np.log(2 * np.pi * t * curve)
    return t, log - _log_gamma(t + 1)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series four places on."""
    y = x + 4
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3))


def _saddle_error(d: float) -> np.ndarray:
    """Log S less its saddle value for 1, 2, ... tables; it hardly depends on the customers."""
    c, most = 16 * EXACT, 2 * EXACT
    exact = _stirling(d, c, most)[c, 1:] - _log_gamma(np.array(c + 1.0))
    place = np.linspace(np.log(d * 0.2 / c) / (1 - d), -1e-3, 200_000)
    t, log = _saddle(np.full(len(place), float(c)), np.exp(place), d)
    return exact - np.interp(np.arange(1, most + 1), t, log)


_STIRLING = {d: _stirling(d, EXACT, EXACT) for d in DISCOUNT}
_SADDLE_ERROR = {d: _saddle_error(d) for d in DISCOUNT}


def draw_tables(
    customers: np.ndarray,
    others: np.ndarray,
    parent: np.ndarray,
    level: int,
    chance: Callable[[np.ndarray], np.ndarray],
) -> np.ndarray:
    """New numbers of tables, each given its dish's customers, the tables of the restaurant's
    ``others`` and the ``parent``'s probability of the dish.

    t tables have weight S(customers, t) * parent ** t * the product over j < t of
    (strength + discount * (others + j)), with generalised Stirling numbers S. For more than
    ``EXACT`` customers the weights are taken at ``GRID`` numbers around the likeliest one.
    ``chance`` gives even random numbers for dishes.
    """
    d = DISCOUNT[level]
    out = np.minimum(customers, 1)
    many = np.flatnonzero((customers > 1) & (customers <= EXACT))
    many = many[np.argsort(customers[many], kind="stable")]
    drawn = chance(many)
    size = customers[many]
    edges = np.flatnonzero(np.diff(size, prepend=0, append=-1))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        own, c = many[low:high], int(size[low])
        step = np.log(STRENGTH + d * (others[own][:, None] + np.arange(c)))
        weight = np.cumsum(step + np.log(parent[own])[:, None], axis=1)
        weight += _STIRLING[d][c, 1 : c + 1]
        weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        out[own] = 1 + (weight < (drawn[low:high] * weight[:, -1])[:, None]).sum(axis=1)
    large = np.flatnonzero(customers > EXACT)
    out[large] = _many_tables(customers[large], others[large], parent[large], d, chance(large))
    return out


def _falling_zero(value, low: np.ndarray, high: float) -> np.ndarray:
    """Where ``value`` turns from positive to negative between ``low`` and ``high``."""
    high = np.full(len(low), high)
    for _ in range(25):
        middle = (low + high) / 2
        above = value(middle) > 0
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _many_tables(
    customers: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, drawn: np.ndarray
) -> np.ndarray:
    """``draw_tables`` for many customers.

    At the saddle point t is a growing function of u, so that weights are known at any u
    without solving for it.
    """
    if not len(customers):
        return customers

    def tables(u: np.ndarray, c: np.ndarray) -> np.ndarray:
        return c * (1 - u**d) / (d * (1 - u) * u ** (d - 1))

    def slope(place: np.ndarray) -> np.ndarray:  # of the log weight in t, about
        u = np.exp(place)
        t = tables(u, customers)
        grown = np.log((1 - u**d) / d) + np.log(STRENGTH + d * (others + t))
        return grown + np.log(parent) - np.log(t + 0.5)

    def where(t: np.ndarray) -> np.ndarray:
        return _falling_zero(lambda at: t - tables(np.exp(at), customers), least, top)

    top = -1e-6
    least = np.log(d * 0.25 / customers) / (1 - d)
    likely = tables(np.exp(_falling_zero(slope, least, top)), customers)
    reach = 7 * np.sqrt(likely + 1) + 3
    low, high = where(np.maximum(likely - reach, 0.5)), where(np.minimum(likely + reach, customers))
    u = np.exp(low[:, None] + (high - low)[:, None] * np.linspace(0, 1, GRID))
    t, weight = _saddle(customers[:, None], u, d)
    error = _SADDLE_ERROR[d]
    weight += np.interp(t, np.arange(1, len(error) + 1), error)
    weight += t * np.log(parent[:, None] * d) + _log_gamma(STRENGTH / d + others[:, None] + t)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    # The weights are lines between the places.
    area = np.cumsum((weight[:, 1:] + weight[:, :-1]) / 2 * np.diff(t, axis=1), axis=1)
    area = np.concatenate([np.zeros((len(area), 1)), area], axis=1)
    asked = drawn * area[:, -1]
    at = np.clip((area < asked[:, None]).sum(axis=1), 1, GRID - 1)
    row = np.arange(len(area))
    span = np.maximum(area[row, at] - area[row, at - 1], 1e-300)
    share = (asked - area[row, at - 1]) / span
    out = np.rint(t[row, at - 1] + share * (t[row, at] - t[row, at - 1]))
    return np.clip(out, 1, customers).astype(np.int64)


def seat(
    customers: np.ndarray,
    opens: np.ndarray,
    draws: np.random.Generator,
    discount: float,
    slope: np.ndarray,
) -> np.ndarray:
    """New table counts of every dish, its customers seated by the restaurant rule.

    This is the rule that ``draw_tables`` inverts, from the first customer on. A customer opens
    a table with weight ``opens`` + ``slope`` * (own tables), and joins one with weight
    (seated) - ``discount`` * (own tables).
    """
    customers = customers.astype(np.int64)
    order = np.argsort(-customers, kind="stable")
    size, opens = customers[order], opens[order]
    slope = slope[order]
    new = (size > 0).astype(np.float64)
    seated, most = 1, int(size[0]) if len(size) else 0
    while seated < most:
        active = int(np.searchsorted(-size, -seated, side="left"))  # those with more customers
        step = max(1, int(seated * GROWTH))
        block = np.minimum(step, size[:active] - seated)
        weight = opens[:active] + slope[:active] * new[:active]
        chance = weight / (weight + seated - discount * new[:active])
        new[:active] += draws.binomial(block, np.clip(chance, 0, 1))
        seated += step
    out = np.zeros(len(customers))
    out[order] = new
    return out


def _even(words: np.ndarray, places: np.ndarray, number: int) -> np.ndarray:
    """Even random numbers of words at places, whose lowest 16 bits are free, in a sweep."""
    mixed = mix64(words.view(np.uint64) ^ mix64(places | np.uint64(number)) ^ np.uint64(SEED))
    return (mixed >> np.uint64(11)).astype(np.float64) / (1 << 53)


class _Dishes:
    """The dishes of some words in all classes of contexts, by length, and the chain of their tables."""

    #: Lengths of contexts that are swept here, in order.
    swept_here = (2, 1, 0)

    def __init__(self, blob: pa.Scalar, contexts: Contexts):
        steps, self.n, codes, self.count = _arrays(blob, 4)
        self.item = np.cumsum(steps)
        #: Level 2 has every word in every context that anyone asks for.
        two = np.cumsum(codes)
        first, bits = contexts.first, contexts.bits[2]
        self.room = [
            np.zeros(len(self.item), dtype=np.int64), None, two & ((1 << bits) - 1)
        ]
        one = two >> first
        new = np.concatenate([[True], one[1:] != one[:-1]])[: len(one)]
        self.up = [None, one[new] >> contexts.last, np.cumsum(new) - 1]
        self.room[1] = one[new] & ((1 << contexts.last) - 1)
        self.word = [np.arange(len(self.item)), self.up[1], two >> bits]

    def chance(self, k: int, number: int) -> Callable[[np.ndarray], np.ndarray]:
        """Even random numbers for dishes of a level in a sweep: hashes, the same on every run."""

        def draw(dishes: np.ndarray) -> np.ndarray:
            place = (self.room[k][dishes] * 3 + k).astype(np.uint64) << np.uint64(16)
            return _even(self.item[self.word[k][dishes]], place, number)

        return draw

    def start(self) -> _State:
        """One table for each dish that has customers."""
        customers, tables = [None, None, self.count], [None, None, None]
        for k in (2, 1, 0):
            tables[k] = np.minimum(customers[k], 1)
            if k:
                customers[k - 1] = self.sent(k, tables[k])
        return _State(customers, tables)

    def sent(self, k: int, tables: np.ndarray) -> np.ndarray:
        n = len(self.room[k - 1])
        return np.bincount(self.up[k], tables, minlength=n).astype(np.int64)

    def chances(self, state: _State, totals: _Totals, levels: int = 3) -> list[np.ndarray]:
        """Predictive probabilities of the first levels, given the totals of all restaurants."""
        out = [] if totals.roots is None else [totals.roots]
        for k in range(len(out), levels):
            parent = out[k - 1][self.up[k]] if k else totals.base
            guests, used = totals.guests[k][self.room[k]], totals.used[k][self.room[k]]
            own = np.maximum(state.customers[k] - DISCOUNT[k] * state.tables[k], 0)
            out.append((own + (STRENGTH + DISCOUNT[k] * used) * parent) / (STRENGTH + guests))
        return out

    def swept(self, state: _State, totals: _Totals, number: int) -> _State:
        """The state after a sweep from ``state``, whose totals are ``totals``."""
        chances = self.chances(state, totals, 2)
        customers, tables = [None, None, self.count], [None, None, None]
        for k in self.swept_here:
            # Nothing is drawn for a dish of one customer, as most are.
            tables[k] = np.minimum(customers[k], 1)
            many = np.flatnonzero(customers[k] > 1)
            parent = chances[k - 1][self.up[k][many]] if k else np.full(len(many), totals.base)
            others = np.maximum(totals.used[k][self.room[k][many]] - state.tables[k][many], 0)
            draw = self.chance(k, number)
            tables[k][many] = draw_tables(
                customers[k][many], others, parent, k, lambda at, own=many, of=draw: of(own[at])
            )
            if k:
                customers[k - 1] = self.sent(k, tables[k])
        return _State(customers, tables)

    def chain(self, totals: list[_Totals]) -> Iterator[_State]:
        """The states of the chain: the start, and one after each sweep, given the totals
        of the state before it."""
        state = self.start()
        yield state
        for number, before in enumerate(totals):
            state = self.swept(state, before, number)
            yield state


@dataclass
class _State:
    customers: list[np.ndarray]  # by level, by dish
    tables: list[np.ndarray]


class _Totals:
    """Customers and tables of every restaurant, by level, and the base probability."""

    #: Probabilities without context, where they are known.
    roots: np.ndarray | None = None

    def __init__(self, rows: pa.Table, base: float, contexts: Contexts):
        self.base = base
        self.guests = [np.zeros(1 << b) for b in contexts.bits]
        self.used = [np.zeros_like(g) for g in self.guests]
        for level, part, sums in zip(*(rows.column(c) for c in _TOTAL_COLUMNS), strict=True):
            guests, used = _arrays(sums, 2)
            own = slice(part.as_py() * ROOMS, part.as_py() * ROOMS + len(guests))
            self.guests[level.as_py()][own] = guests
            self.used[level.as_py()][own] = used


_TOTALS = "level int, part int, sums binary"
_TOTAL_COLUMNS = ["level", "part", "sums"]


def _total_rows(sums: Iterator[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    """(level, part, its customers and tables) as rows."""
    rows = [(level, part, _zip(guests, used)) for level, part, guests, used in sums]
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
    return pa.table(arrays, names=_TOTAL_COLUMNS)


class _Dealt:
    """Which of some words go to each shard, in their order."""

    def __init__(self, words: np.ndarray, shards: int):
        shard = (mix64(words.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        self.order = np.argsort(shard, kind="stable")
        self.found, self.first = np.unique(shard[self.order], return_index=True)
        self.last = np.append(self.first[1:], len(words)).astype(np.int64)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        for one, low, high in zip(self.found.tolist(), self.first, self.last, strict=True):
            yield one, self.order[low:high]

    def of(self, shard: int) -> np.ndarray:
        at = np.searchsorted(self.found, shard)
        if at == len(self.found) or self.found[at] != shard:
            return self.order[:0]
        return self.order[self.first[at] : self.last[at]]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each size, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


class _Chunk:
    """The n-grams of a chunk: distinct contexts of two words, and the words after each.

    Words are places in ``item``, which ascends. Contexts ascend by last word, then first; n-grams
    by context, then word. ``held`` are the slices with each token's n-gram and word.
    """

    def __init__(self, table: pa.Table):
        held = [
            (rows, piece, *_words(piece))
            for rows in _unpacked(table)
            for piece in slices(rows.column("text"))
        ]
        own = np.concatenate([*(h[2] for h in held), np.array([_START])])
        self.item, place = np.unique(own, return_inverse=True)
        place, start, n = place[:-1], int(place[-1]), len(self.item)
        self.start, self.word, contexts, edge = start, place, [], 0
        for _, _, word, offset in held:
            last, before = _before(place[edge : edge + len(word)], offset, start)
            contexts.append(last * n + before)
            edge += len(word)
        context, at = np.unique(np.concatenate(contexts), return_inverse=True)
        gram, self.gram = np.unique(at * n + place, return_inverse=True)
        self.last, self.before = np.divmod(context, n)
        room, self.next = np.divmod(gram, n)
        #: N-grams of each context.
        self.size = np.bincount(room, minlength=len(context))
        self.held, edge = [], 0
        for rows, piece, word, offset in held:
            own = slice(edge, edge + len(word))
            self.held.append((rows, piece, self.gram[own], place[own], offset))
            edge += len(word)

    def deal(self, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, its words, its contexts, its n-grams), as places."""
        dealt = _Dealt(self.item, shards)
        rooms = _Dealt(self.item[self.last], shards)
        first = np.cumsum(self.size) - self.size
        for one in np.union1d(dealt.found, rooms.found).tolist():
            words, own = dealt.of(one), rooms.of(one)
            yield one, words[words != self.start], own, _ranges(first[own], self.size[own])


_SENT_GRAMS = "shard int, chunk int, words binary, grams binary"


def _send_grams(shards: int):
    """Distinct words and n-grams of a chunk, with their training counts, for their shards."""

    def send(table: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        number = table.column("chunk")[0].as_py()
        train = np.concatenate(
            [
                np.repeat(rows.column("learns").to_numpy()[piece.first : piece.last], np.diff(offset))
                for rows, piece, _, _, offset in chunk.held
            ]
        )
        item = chunk.item
        n_words = np.bincount(chunk.word, train, minlength=len(item)).astype(np.int64)
        n = np.bincount(chunk.gram, train, minlength=len(chunk.next)).astype(np.int64)
        rows = []
        for one, words, rooms, grams in chunk.deal(shards):
            last, before, after = chunk.last[rooms], chunk.before[rooms], chunk.next[grams]
            used = np.unique(np.concatenate([last, before, after]))
            last, before, after = (np.searchsorted(used, x) for x in (last, before, after))
            packed = _zip(
                _ascending(item[used]), _ascending(last), _stepped(before), chunk.size[rooms],
                _stepped(after), n[grams],
            )
            rows.append((one, number, _zip(_ascending(item[words]), n_words[words]), packed))
        return _rows(rows, _SENT_GRAMS)

    return send


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    arrays = [pa.array(x, _KINDS[k]) for x, k in zip(columns, kinds, strict=True)]
    return pa.table(arrays, names=list(names))


_SHARDS = "shard int, dishes binary, asked binary, words binary, counted binary, tokens long, kinds long"


def _gather_grams(table: pa.Table) -> pa.Table:
    """A shard: the dishes of its contexts and the chunks that ask for them, its words and the chunks
    that count them."""
    table = table.sort_by("chunk")
    chunk = table.column("chunk").to_numpy()
    sent = [_arrays(blob, 2) for blob in table.column("words")]
    size = np.array([len(s[0]) for s in sent])
    word, counted = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
    n = np.bincount(counted, np.concatenate([s[1] for s in sent]), minlength=len(word)).astype(np.int64)
    words = _zip(_ascending(word), n)
    counted = _zip(chunk, size) + _zip(_stepped(counted))

    sent = [_arrays(blob, 6) for blob in table.column("grams")]
    item, place = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
    contexts, after, edge = [], [], 0
    for steps, last, before, _, own, _ in sent:
        of = place[edge : edge + len(steps)]
        contexts.append(of[np.cumsum(last)] * len(item) + of[_unstepped(before)])
        after.append(of[_unstepped(own)])
        edge += len(steps)
    context, room = np.unique(np.concatenate(contexts), return_inverse=True)
    room = np.repeat(room, np.concatenate([s[3] for s in sent]))
    two, asked = np.unique(room * len(item) + np.concatenate(after), return_inverse=True)
    count = np.bincount(asked, np.concatenate([s[5] for s in sent]), minlength=len(two))
    room, after = np.divmod(two, max(len(item), 1))
    last, before = np.divmod(context, max(len(item), 1))
    one, up = np.unique(last[room] * len(item) + after, return_inverse=True)
    ended, after = np.divmod(one, max(len(item), 1))
    dishes = _zip(
        _ascending(item), _ascending(last), _stepped(before), np.bincount(room, minlength=len(last)),
        _stepped(up), count.astype(np.int64), _ascending(ended), _stepped(after),
    )
    asked = _zip(chunk, np.array([len(s[5]) for s in sent])) + _zip(_stepped(asked))
    shard = table.column("shard")[0].as_py()
    row = (shard, dishes, asked, words, counted, int(n.sum()), int((n > 0).sum()))
    return _rows([row], _SHARDS)


class _Shard(_Dishes):
    """All contexts that end in some words: their dishes, and the chain of their tables.

    A restaurant's customers and tables are all here; of the restaurant without context, the words
    ``names`` that are served after these contexts.
    """

    swept_here = (2, 1)

    def __init__(self, blob: pa.Scalar):
        steps, last, before, size, up, self.count, ended, after = _arrays(blob, 8)
        self.item, self.last, self.before = np.cumsum(steps), np.cumsum(last), _unstepped(before)
        after = _unstepped(after)
        served = np.zeros(len(self.item), dtype=np.int64)
        served[after] = 1
        places = np.flatnonzero(served)
        self.names = self.item[places]
        up = _unstepped(up)
        self.up = [None, (np.cumsum(served) - 1)[after], up]
        self.word = [places, after, after[up]]
        rooms = np.repeat(np.arange(len(self.last)), size)
        self.room = [np.zeros(len(places), dtype=np.int64), np.cumsum(ended), rooms]

    def chance(self, k: int, number: int) -> Callable[[np.ndarray], np.ndarray]:
        def draw(dishes: np.ndarray) -> np.ndarray:
            room = self.room[k][dishes]
            place = self.item[room if k == 1 else self.last[room]].view(np.uint64)
            if k == 2:
                place = mix64(place) ^ self.item[self.before[room]].view(np.uint64)
            place = mix64(place ^ np.uint64(k)) << np.uint64(16)
            return _even(self.item[self.word[k][dishes]], place, number)

        return draw

    def state(self, tables: list[np.ndarray]) -> _State:
        return _State([None, self.sent(2, tables[2]), self.count], tables)

    def totals(self, state: _State, roots: np.ndarray | None) -> _Here:
        sizes = (0, len(self.item), len(self.last))
        sums = [
            [None, *(np.bincount(self.room[k], own[k], minlength=sizes[k]) for k in (1, 2))]
            for own in (state.customers, state.tables)
        ]
        return _Here(*sums, roots)


@dataclass
class _Here:
    """Customers and tables of a shard's restaurants, and probabilities of its words without context."""

    guests: list[np.ndarray]
    used: list[np.ndarray]
    roots: np.ndarray


@dataclass(frozen=True)
class _Root:
    """The restaurant without context: customers, tables and base probability."""

    guests: int
    used: int
    base: float

    def chances(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        own = np.maximum(customers - DISCOUNT[0] * tables, 0)
        return (own + (STRENGTH + DISCOUNT[0] * self.used) * self.base) / (STRENGTH + self.guests)


_OWN = -1
#: What is sent after a sweep: to a shard, from a shard, or the shard's own state (``_OWN``).
_MAIL = "shard int, sender int, number int, data binary, guests long, used long"


def _shard_mail(shard: int, number: int, dishes: _Shard, state: _State, shards: int) -> pa.Table:
    """A shard's state, and the customers that it sends to the words' shards."""
    rows = [(shard, _OWN, number, _zip(state.tables[2], state.tables[1]), 0, 0)]
    for one, own in _Dealt(dishes.names, shards):
        rows.append((one, shard, number, _zip(state.customers[0][own]), 0, 0))
    return _rows(rows, _MAIL)


def _open_shards(shards: int):
    """The first state: one table for each dish that has customers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column("shard"), batch.column("dishes"), strict=True):
                dishes = _Shard(blob)
                mail = _shard_mail(shard.as_py(), 0, dishes, dishes.start(), shards)
                yield from mail.to_batches()

    return run


def _opened(dishes: _Shard, mail: pa.Table, root: _Root, number: int, shards: int) -> tuple[_State, _Here]:
    """A state and its totals, as they were sent."""
    dealt = _Dealt(dishes.names, shards)
    customers, tables = (np.zeros(len(dishes.names), dtype=np.int64) for _ in range(2))
    for sender, of, data in zip(*(mail.column(c) for c in ("sender", "number", "data")), strict=True):
        if of.as_py() != number:
            continue
        if sender.as_py() == _OWN:
            two, one = _arrays(data, 2)
            state = dishes.state([None, one, two])
        else:
            own = dealt.of(sender.as_py())
            customers[own], tables[own] = _arrays(data, 2)
    return state, dishes.totals(state, root.chances(customers, tables))


def _sweep_shards(shards: int, root: _Root, number: int):
    """The state after a sweep from the state ``number``."""

    def run(left: pa.Table, mail: pa.Table) -> pa.Table:
        dishes = _Shard(left.column("dishes")[0])
        state, totals = _opened(dishes, mail, root, number, shards)
        state = dishes.swept(state, totals, number)
        return _shard_mail(left.column("shard")[0].as_py(), number + 1, dishes, state, shards)

    return run


_ASKED_WORDS = "shard int, sender int, data binary"


def _ask_words(shards: int):
    """The words that a shard serves without context, for their shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column("shard"), batch.column("dishes"), strict=True):
                names = _Shard(blob).names
                rows = [
                    (one, shard.as_py(), _zip(_ascending(names[own])))
                    for one, own in _Dealt(names, shards)
                ]
                yield from _rows(rows, _ASKED_WORDS).to_batches()

    return run


_WORD_SHARDS = "shard int, words binary, asked binary"


def _gather_words_asked(left: pa.Table, asked: pa.Table) -> pa.Table:
    """A shard's words, and which of them each shard has asked for."""
    word = np.cumsum(_arrays(left.column("words")[0], 1)[0])
    asked = asked.sort_by("sender")
    places = [np.searchsorted(word, np.cumsum(_arrays(blob, 1)[0])) for blob in asked.column("data")]
    sizes = np.array([len(p) for p in places], dtype=np.int64)
    place = np.concatenate([np.zeros(0, dtype=np.int64), *places])
    data = _zip(asked.column("sender").to_numpy(), sizes) + _zip(_stepped(place))
    return _rows([(left.column("shard")[0].as_py(), _zip(_ascending(word)), data)], _WORD_SHARDS)


class _Words:
    """A shard's words in the restaurant without context, and the shards that serve them."""

    def __init__(self, row: pa.Table):
        self.item = np.cumsum(_arrays(row.column("words")[0], 1)[0])
        sender, size, place = _arrays(row.column("asked")[0], 3)
        self.places = dict(
            zip(sender.tolist(), np.split(_unstepped(place), np.cumsum(size)[:-1]), strict=False)
        )

    def drawn(self, customers: np.ndarray, before: np.ndarray, root: _Root, number: int) -> np.ndarray:
        tables = np.minimum(customers, 1)
        many = np.flatnonzero(customers > 1)
        others = np.maximum(root.used - before[many], 0)
        place = np.zeros(1, dtype=np.uint64)
        tables[many] = draw_tables(
            customers[many], others, np.full(len(many), root.base), 0,
            lambda at: _even(self.item[many[at]], place, number),
        )
        return tables


def _sweep_words(root: _Root | None, number: int):
    """The words' state ``number``, from the customers that shards send; without ``root`` the first."""

    def run(left: pa.Table, mail: pa.Table) -> pa.Table:
        words = _Words(left)
        shard = left.column("shard")[0].as_py()
        customers = np.zeros(len(words.item), dtype=np.int64)
        before = np.zeros(len(words.item), dtype=np.int64)
        for sender, data in zip(mail.column("sender"), mail.column("data"), strict=True):
            if sender.as_py() == _OWN:
                (before,) = _arrays(data, 1)
            else:
                customers[words.places[sender.as_py()]] += _arrays(data, 1)[0]
        if root is None:
            tables = np.minimum(customers, 1)
        else:
            tables = words.drawn(customers, before, root, number - 1)
        rows = [(shard, _OWN, number, _zip(tables), int(customers.sum()), int(tables.sum()))]
        for one, own in words.places.items():
            rows.append((one, shard, number, _zip(customers[own], tables[own]), 0, 0))
        return _rows(rows, _MAIL)

    return run


_ANSWERS = "chunk int, shard int, counts binary, chances binary"


def _requests(blob: pa.Scalar) -> Iterator[tuple[int, np.ndarray]]:
    chunk, size, place = _arrays(blob, 3)
    yield from zip(chunk.tolist(), np.split(_unstepped(place), np.cumsum(size)[:-1]), strict=True)


def _answer_chunks(shards: int, roots: dict[int, _Root]):
    """For each chunk the counts of its words, and the log10 probabilities of its n-grams.

    ``roots`` are those of the states whose probabilities are averaged.
    """

    def run(left: pa.Table, mail: pa.Table) -> pa.Table:
        shard, n = left.column("shard")[0].as_py(), _arrays(left.column("words")[0], 2)[1]
        counts = {c: _zip(n[own]) for c, own in _requests(left.column("counted")[0])}
        dishes = _Shard(left.column("dishes")[0])
        chance = np.zeros(len(dishes.count))
        for number, root in roots.items():
            state, totals = _opened(dishes, mail, root, number, shards)
            chance += dishes.chances(state, totals)[2] / len(roots)
        chance = np.rint(np.log10(chance) * -STEPS).astype(np.int64)
        rows = [
            (c, shard, counts[c], _zip(chance[own])) for c, own in _requests(left.column("asked")[0])
        ]
        return _rows(rows, _ANSWERS)

    return run


def _received(known: pa.Table, chunk: _Chunk, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(count of each word of a chunk, log10 probability of each of its n-grams)."""
    n, value = np.zeros(len(chunk.item), dtype=np.int64), np.zeros(len(chunk.next))
    answers = dict(
        zip(
            known.column("shard").to_pylist(),
            zip(known.column("counts"), known.column("chances"), strict=True),
            strict=True,
        )
    )
    for one, words, _, grams in chunk.deal(shards):
        counts, chances = answers[one]
        n[words] = _arrays(counts, 1)[0]
        value[grams] = _arrays(chances, 1)[0] / -STEPS
    return n, value


@dataclass
class _Chain:
    """The chain over stored shards: what was sent after each state, by contexts and by words."""

    shards: int
    contexts: DataFrame
    words: DataFrame
    scratch: Scratch
    base: float
    by_contexts: list[DataFrame] = field(default_factory=list)
    by_words: list[DataFrame] = field(default_factory=list)
    roots: list[_Root] = field(default_factory=list)

    def _with(self, rows: DataFrame, mail: DataFrame, run: Callable, schema: str) -> DataFrame:
        return rows.groupBy("shard").cogroup(mail.groupBy("shard")).applyInArrow(run, schema)

    def mail(self, number: int) -> DataFrame:
        """What the contexts need of a state: their own tables, and the words' customers and tables."""
        own = self.by_contexts[number].where(F.col("sender") == _OWN)
        return own.unionAll(self.by_words[number].where(F.col("sender") != _OWN))

    def sweep(self) -> None:
        """One more state."""
        number = len(self.roots)
        dishes = self.contexts.select("shard", "dishes")
        if number:
            run = _sweep_shards(self.shards, self.roots[-1], number - 1)
            swept = self._with(dishes, self.mail(number - 1), run, _MAIL)
        else:
            swept = dishes.mapInArrow(_open_shards(self.shards), _MAIL)
        self.by_contexts.append(self.scratch.keep(swept, f"contexts-{number}"))
        mail = self.by_contexts[-1].where(F.col("sender") != _OWN)
        if number:
            mail = mail.unionAll(self.by_words[-1].where(F.col("sender") == _OWN))
        run = _sweep_words(self.roots[-1] if number else None, number)
        self.by_words.append(self.scratch.keep(self._with(self.words, mail, run, _MAIL), f"words-{number}"))
        sums = self.by_words[-1].agg(F.sum("guests").alias("guests"), F.sum("used").alias("used"))
        sums = sums.first()
        self.roots.append(_Root(sums.guests or 0, sums.used or 0, self.base))

    def answers(self, numbers: range) -> DataFrame:
        mail = self.mail(numbers[0])
        for number in numbers[1:]:
            mail = mail.unionAll(self.mail(number))
        roots = {number: self.roots[number] for number in numbers}
        return self._with(self.contexts, mail, _answer_chunks(self.shards, roots), _ANSWERS)


def _stored(rows: DataFrame, label: str, shards: int, scratch: Scratch) -> DataFrame:
    """A stored table in buckets by shard, which is joined by shard where it lies."""
    spark, name = rows.sparkSession, f"{label}_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("path", scratch.path(label))
    writer.bucketBy(min(shards, MOST_BUCKETS), "shard").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        # Its files stay: they are the scratch folder's.
        spark.sql(f"DROP TABLE {name}")


def score(docs: DataFrame, learns: Column, scratch: Scratch) -> DataFrame:
    """(doc, n_tokens, n_known, train_tokens, base_score, score, perplexity).

    ``learns`` marks the rows of ``docs`` to learn from. ``doc`` is the row without its text.
    """
    rows = docs.select(F.coalesce(learns, F.lit(False)).alias("learns"), F.struct("*").alias("doc"))
    rows = rows.withColumn("text", F.coalesce(F.col("doc.text"), F.lit("")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    chunk = F.pmod(F.xxhash64("doc.doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")
    texts = rows.select(chunk, "learns", "text")
    packed = texts.mapInArrow(_packed, "chunk int, blob binary")
    sent = packed.groupBy("chunk").applyInArrow(_send_grams(chunks), _SENT_GRAMS)
    gathered = sent.groupBy("shard").applyInArrow(_gather_grams, _SHARDS)
    contexts = _stored(gathered, "contexts", chunks, scratch)
    asked = contexts.select("shard", "dishes").mapInArrow(_ask_words(chunks), _ASKED_WORDS)
    words = contexts.select("shard", "words").groupBy("shard").cogroup(asked.groupBy("shard"))
    words = words.applyInArrow(_gather_words_asked, _WORD_SHARDS)
    words = _stored(words, "words", chunks, scratch)
    sums = contexts.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = sums.tokens or 0, sums.kinds or 0
    chain = _Chain(chunks, contexts, words, scratch, base=1 / (kinds + 1))
    for _ in range(1 + BURN_IN + SAMPLES):
        chain.sweep()
    answers = chain.answers(range(1 + BURN_IN, 1 + BURN_IN + SAMPLES))

    full = rows.select(chunk, "text", F.col("doc").dropFields("text").alias("doc"))
    bottom = np.log10(tokens + kinds + 1)

    def rate(table: pa.Table, known: pa.Table) -> pa.Table:
        # The chunk's words and n-grams, in the order in which it has sent them.
        held = _Chunk(table)
        n, value = _received(known, held, chunks)
        out = []
        for rows, piece, gram, word, offset in held.held:
            count = n[word]
            base_score = np.add.reduceat(np.log10(count + 1) - bottom, offset[:-1])
            sums = np.add.reduceat(value[gram], offset[:-1])
            n_tokens = np.diff(offset)
            out.append(
                pa.table(
                    {
                        "doc": rows.column("doc").slice(piece.first, len(piece)),
                        "n_tokens": n_tokens,
                        "n_known": np.add.reduceat((count > 0).astype(np.int64), offset[:-1]),
                        "train_tokens": np.full(len(piece), tokens, dtype=np.int64),
                        "base_score": base_score,
                        "score": sums,
                        "perplexity": 10 ** np.minimum(-sums / n_tokens, 300),
                    }
                )
            )
        return pa.concat_tables(out)

    schema = schema_with_doc(
        full,
        "n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "perplexity double",
    )
    packed = full.mapInArrow(_packed, "chunk int, blob binary")
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(rate, schema)
