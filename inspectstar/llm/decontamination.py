"""Benchmark decontamination that also finds re-parameterised questions.

Texts become templates: numbers, units after numbers and names are replaced by typed
placeholders, other words lose case and outer punctuation. Names are runs of capitalised
words; one that opens a sentence counts if its text also has it inside a sentence, or if
no text of the benchmark has it in lower case. Number words after a number belong to it
(twenty five, 3 million). A unit written onto its number is a word of its own, an ordinal
such as 3rd is a number. Windows of ``WIDTH`` template words of all documents are joined by
hash with those of the benchmark. A table of bits, set where the benchmark has a hash, is
asked first: only windows that may match get their slots and become rows. The table's size
is bounded; one that a huge benchmark fills lets more windows through and changes no result.
Windows that match at one distance are a passage, and count if its
slots are consistent: the values of document and benchmark must map to each other one to
one, as they do where the same question was given other numbers and names, and do not
where only the wording is alike. Of other passages only windows with equal values count.
Windows with fewer than ``LITERAL`` words that are not placeholders (or all but one of an
item's if it is shorter) are too common as templates: they match where all words are equal.

Defined results: null and empty texts match nothing; benchmark items with fewer than
``LEAST`` words are not searched for, items shorter than a window are searched as a whole;
items with a null id or text are left out; repeated rows give repeated results only if they
differ in doc_id; a text of any length is taken as a whole, by one task; of the columns only
doc_id and text, item_id and text are read, so that others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspectstar.llm.words import Words, mix64, slices, span_hashes, within
from inspectstar.scratch import Scratch

WIDTH = 12
LEAST = 5
LITERAL = 6

#: Bits of the table of benchmark windows, at most.
TABLE_BITS = 24
#: Known words that are broadcast, at most: more of them are joined with the texts' openers.
KNOWN = 2_000_000
#: Text bytes whose words are held at once: a worker needs some 100 times as many for them.
SLICE_BYTES = 250_000

# Words for numbers and units, in English, German, French and Spanish.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion"
)
TENS, ONES = NUMBERS.split()[20:28], NUMBERS.split()[1:10]
MORE_NUMBERS = (
    "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn "
    "fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig "
    "achtzig neunzig hundert tausend "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt "
    "trente quarante cinquante soixante cent mille "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince "
    "dieciséis diecisiete dieciocho diecinueve veinte treinta cuarenta cincuenta sesenta setenta "
    "ochenta noventa cien mil"
)
ORDINALS = "st nd rd th"
UNITS = (
    "mm cm m km mg g kg t ml l s ms h hr hrs min mins sec secs second seconds minute minutes "
    "hour hours day days week weeks month months year years meter meters metre metres mile miles "
    "foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces "
    "liter liters litre litres degree degrees percent dollar dollars euro euros cent cents usd "
    "eur gbp mph kmh hz khz mhz ghz kb mb gb tb w kw mw v a"
)
MORE_UNITS = (
    "sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr "
    "jahre jahren zentimeter kilometer gramm kilogramm pfund grad prozent "
    "seconde secondes heure heures jour jours semaine semaines mois an ans année années mètre "
    "mètres kilomètre kilomètres gramme grammes kilos degré degrés "
    "segundo segundos minuto minutos hora horas día días semana semanas mes meses año años metro "
    "metros kilómetro kilómetros gramo gramos kilo litro litros grado grados céntimos dólares"
)


def _hash_list(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), dtype=np.uint8)
    end = np.append(np.flatnonzero(data == 0x20), len(data))
    start = np.concatenate([[0], end[:-1] + 1])
    return np.sort(span_hashes(data, start, end))


_NUMBERS = _hash_list(
    " ".join([NUMBERS, MORE_NUMBERS, *(f"{a}-{b}" for a in TENS for b in ONES)])
)
_UNITS, _ORDINALS = _hash_list(f"{UNITS} {MORE_UNITS}"), _hash_list(ORDINALS)
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
#: By the first two bytes of a word: whether it begins with a capital.
_CAPITAL = np.zeros(1 << 16, dtype=bool)
_CAPITAL[: 1 << 15] = np.repeat(_UPPER[:128], 256)
for _code in range(0x80, 0x800):
    _CAPITAL[int.from_bytes(chr(_code).encode(), "big")] = chr(_code).isupper()
_CORE = np.zeros(256, dtype=bool)  # signs that a word may begin and end with
_CORE[128:] = True
for _code in range(128):
    _CORE[_code] = chr(_code).isalnum()
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[[ord(c) for c in ".!?:"]] = True
_NUMBER, _UNIT, _NAME = np.uint64(1), np.uint64(2), np.uint64(3)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORDS_ALONE = np.uint64(4)  # tells hashes of words from those of templates


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


@dataclass
class _Parts:
    """The words of a slice without those of punctuation alone, units split from numbers."""

    start: np.ndarray
    end: np.ndarray
    value: np.ndarray  # hash of the word itself, in lower case
    offset: np.ndarray
    number: np.ndarray
    spelled: np.ndarray  # a number in words
    unit: np.ndarray
    capital: np.ndarray  # a capital, and no other in the word
    opens: np.ndarray  # a sentence
    any_capital: np.ndarray

    def openers(self) -> np.ndarray:
        """Places of the words that are names unless they are known."""
        return np.flatnonzero(self.capital & self.opens)

    def lower(self) -> np.ndarray:
        """Hashes of the different words in lower case."""
        return np.unique(self.value[~self.number & ~self.unit & ~self.any_capital])


def _before(marked: np.ndarray) -> np.ndarray:
    """For each byte, and the end, the number of marked bytes before it."""
    total = np.zeros(len(marked) + 1, dtype=np.int32)  # a text has less than 2 GB
    np.cumsum(marked, dtype=np.int32, out=total[1:])
    return total


def _parts(words: Words) -> _Parts:
    raw = words.piece.data
    lowered = words.piece.lowered().data
    core = _CORE[raw]
    place = np.arange(len(raw), dtype=np.int32)
    following = np.minimum.accumulate(np.where(core, place, len(raw))[::-1])[::-1]
    previous = np.maximum.accumulate(np.where(core, place, -1))
    some = np.flatnonzero(following[words.start] < words.end) if len(words) else np.zeros(0, dtype=int)
    start, end = following[words.start[some]], previous[words.end[some] - 1] + 1
    offset = np.searchsorted(some, words.offset)
    digits = _before(_DIGIT[raw])
    letters = _before(core & ~_DIGIT[raw])
    # Where the letters of a word begin that has digits before its only letters.
    letter = np.minimum.accumulate(np.where(core & ~_DIGIT[raw], place, len(raw))[::-1])[::-1]
    mixed = np.flatnonzero(
        (digits[end] > digits[start]) & (letters[end] > letters[start])
    )
    cut = letter[start[mixed]]
    ends_well = (cut > start[mixed]) & (digits[end[mixed]] == digits[cut])
    mixed, cut = mixed[ends_well], cut[ends_well]
    suffix = span_hashes(lowered, cut, end[mixed])
    ordinal = np.zeros(len(some), dtype=bool)
    ordinal[mixed[_member(suffix, _ORDINALS)]] = True
    attached = _member(suffix, _UNITS) & ~ordinal[mixed]
    mixed, cut = mixed[attached], cut[attached]
    # The number takes the place of the word, its unit comes after.
    order = np.concatenate([np.arange(len(some)), mixed + 0.5])
    begin, stop = np.append(start, cut), np.append(end, end[mixed])
    number_end = previous[np.maximum(cut - 1, 0)] + 1
    stop[mixed] = number_end
    order = np.argsort(order, kind="stable")
    is_suffix = (np.arange(len(order)) >= len(some))[order]
    start, end = begin[order], stop[order]
    ordinal = np.append(ordinal, np.zeros(len(mixed), dtype=bool))[order]
    offset = offset + np.searchsorted(mixed, offset)
    value = span_hashes(lowered, start, end)
    begins = np.zeros(len(start), dtype=bool)
    begins[offset[:-1][offset[:-1] < len(start)]] = True
    # A sentence starts after a word with a closing mark, and on a new line.
    closed = np.zeros(len(start), dtype=bool)
    closing = _before(_CLOSING[raw] | (raw == 0x0A))
    if len(start) > 1:
        closed[1:] = closing[start[1:]] - closing[end[:-1]] > 0
    capitals = _before(_UPPER[raw])
    number = (digits[end] - digits[start] > 0) & (letters[end] - letters[start] == 0)
    spelled = _member(value, _NUMBERS)
    number |= spelled | ordinal
    unit = np.zeros(len(start), dtype=bool)
    unit[1:] = number[:-1] & ~begins[1:] & _member(value[1:], _UNITS)
    unit |= is_suffix
    number &= ~unit
    next_byte = raw[np.minimum(start + 1, len(raw) - 1)].astype(np.int64)
    first = _CAPITAL[raw[start].astype(np.int64) << 8 | next_byte] if len(start) else unit
    inner = capitals[end] - capitals[start] - (_UPPER[raw[start]] if len(start) else 0)
    capital = first & (inner == 0) & ~number & ~unit & (end - start > 1)
    return _Parts(
        start,
        end,
        value,
        offset,
        number,
        spelled & number,
        unit,
        capital,
        begins | closed,
        first | (inner > 0),
    )


@dataclass
class Known:
    """Words that may open a sentence without being names, by hash, sorted.

    Where more than ``KNOWN`` words are known, each text brings along those of its own openers
    (``_with_known``), and ``words`` holds those of a batch of texts.
    """

    words: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), dtype=bool)
        return _member(hashes, self.words)

    @classmethod
    def of(cls, hashes: np.ndarray) -> Known:
        return cls(np.unique(hashes.astype(np.int64).view(np.uint64)))


def _batch_known(batch: pa.RecordBatch, known: Known | None) -> Known:
    """``known``, or the known words that the batch brings along."""
    if known is not None:
        return known
    words = batch.column("known").flatten().drop_null()
    return Known.of(words.to_numpy(zero_copy_only=False))


_Words = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def template(words: Words, known: Known) -> tuple[_Words, _Words]:
    """Of the words of a slice: (template, value, is placeholder, document offset), twice.

    Words of punctuation alone are left out. ``value`` is the hash of the word itself. In the
    first a run of names is one word, as is a number with the number words after it; the
    second has every word.
    """
    parts = _parts(words)
    value, offset = parts.value, parts.offset
    inside = parts.capital & ~parts.opens
    opener = parts.openers()
    owner = np.repeat(np.arange(len(offset) - 1), np.diff(offset)).astype(np.uint64)
    with np.errstate(over="ignore"):
        own = mix64(value + mix64(owner + np.uint64(1)))
    named = ~known.has(value[opener])
    name = inside.copy()
    name[opener] = named | np.isin(own[opener], own[inside])
    kinds = np.where(
        parts.number, _NUMBER, np.where(parts.unit, _UNIT, np.where(name, _NAME, value))
    )
    slot = parts.number | parts.unit | name
    every = kinds, value, slot, offset
    # Names with nothing but one space between them are one; so are number words after a number.
    again = np.zeros(len(value), dtype=bool)
    more = (name[1:] & name[:-1]) | (parts.spelled[1:] & parts.number[:-1])
    again[1:] = more & ~parts.opens[1:] & (parts.start[1:] - parts.end[:-1] == 1)
    heads = np.flatnonzero(~again)
    if len(heads) == len(value):
        return every, every
    stop = parts.end[np.append(heads[1:], len(value)) - 1]
    value = span_hashes(words.piece.lowered().data, parts.start[heads], stop)
    return (kinds[heads], value, slot[heads], np.searchsorted(heads, offset)), every


def _lower_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch.column(0), SLICE_BYTES):
            found = _parts(piece.words()).lower()
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["word"])


def _opener_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, text) to (text_key, word): the different openers of each text."""
    for batch in batches:
        keys = batch.column("text_key").to_numpy()
        for piece in slices(batch.column("text"), SLICE_BYTES):
            parts = _parts(piece.words())
            place = parts.openers()
            owner = np.searchsorted(parts.offset, place, side="right") - 1
            found = np.unique(
                np.stack([keys[owner + piece.first], parts.value[place].view(np.int64)]), axis=1
            )
            arrays = [pa.array(column) for column in found]
            yield pa.RecordBatch.from_arrays(arrays, names=["text_key", "word"])


def _with_known(rows: DataFrame, lower: DataFrame) -> DataFrame:
    """``rows`` (text_key, text, ...) with ``known``: the text's openers that are in ``lower``."""
    texts = rows.select("text_key", "text")
    openers = texts.mapInArrow(_opener_words, "text_key long, word long").distinct()
    known = openers.join(lower, "word", "left_semi").groupBy("text_key")
    known = known.agg(F.collect_list("word").alias("known"))
    return rows.join(known, "text_key", "left").select(*rows.columns, "known")


@dataclass
class Table:
    """Which window hashes the benchmark may have: a bit for each value of their first bits.

    ``kinds`` are the (words alone, width) it has any windows of.
    """

    bits: int
    set: np.ndarray
    kinds: frozenset

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        return self.set[hashes >> np.uint64(64 - self.bits)]


def _run_hashes(values: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(width, hash of every so many consecutive values), one pass for all widths."""
    total = np.zeros(len(values), dtype=np.uint64)
    done = 0
    for width in sorted(widths):
        if width > len(values):
            return
        with np.errstate(over="ignore"):
            for i in range(done, width):
                total = total[: len(values) - i] * _BASE + values[i:]
        done = width
        yield width, mix64(total)


def _windows(widths: list[int], known: Known | None, table: Table | None) -> callable:
    """A function for mapInArrow: (key..., text, known if that is not given) to (key..., alone, width, pos, hash, slots, total).

    Windows have the hash of their template or, if that has too few literal words, of the
    words alone, a run of names taken apart. Without ``table`` the texts are the benchmark:
    those shorter than the largest width give one window of all their words. With it they are
    documents, of which only windows that it may have are returned; all of them also have
    the hash of the words alone, as those of a copy may have other placeholders.
    ``total`` is the number of the text's windows.
    """
    whole = table is None

    def chosen(found: tuple, alone: bool) -> Iterator[tuple]:
        kinds, value, slot, offset = found
        asked = [w for w in widths if whole or (alone, w) in table.kinds]
        literal = np.concatenate([[0], np.cumsum(~slot)])
        for width, hashes in _run_hashes(value if alone else kinds, asked):
            if alone:
                hashes = mix64(hashes ^ _WORDS_ALONE)
            start = within(offset, width) if whole else np.flatnonzero(table.may_have(hashes))
            if not len(start):
                continue
            owner = np.searchsorted(offset, start, side="right") - 1
            if whole and width < max(widths):
                keep = np.diff(offset)[owner] == width
            else:
                keep = start + width <= offset[owner + 1]
            enough = literal[start + width] - literal[start] >= min(LITERAL, width - 1)
            if not alone:
                keep &= enough
            elif whole:
                keep &= ~enough
            yield width, start[keep], owner[keep], hashes[start[keep]]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _batch_known(batch, known)
            keys = batch.select([c for c in batch.schema.names if c not in ("text", "known")])
            for piece in slices(batch.column("text"), SLICE_BYTES):
                found = []
                for alone, words in enumerate(template(piece.words(), own)):
                    _, value, slot, offset = words
                    slots = np.flatnonzero(slot)
                    for width, start, owner, hashes in chosen(words, bool(alone)):
                        low = count = np.zeros(len(start), dtype=np.int64)
                        if not alone:
                            low = np.searchsorted(slots, start)
                            count = np.searchsorted(slots, start + width) - low
                        ends = np.concatenate([[0], np.cumsum(count)])
                        flat = np.arange(ends[-1]) + np.repeat(low - ends[:-1], count)
                        held = pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(value[slots[flat]].view(np.int64))
                        )
                        found.append((alone, width, start - offset[owner], owner, hashes, held))
                if not found:
                    continue
                total = np.bincount(np.concatenate([f[3] for f in found]), minlength=len(piece))
                for alone, width, pos, owner, hashes, held in found:
                    rows = keys.take(pa.array(owner + piece.first))
                    n = len(pos)
                    columns = [
                        pa.array(np.full(n, alone), pa.int32()),
                        pa.array(np.full(n, width), pa.int32()),
                        pa.array(pos, pa.int32()),
                        pa.array(hashes.view(np.int64)),
                        held,
                        pa.array(total[owner], pa.int32()),
                    ]
                    names = [*rows.schema.names, *_COLUMNS]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=names)

    return cut


_COLUMNS = "alone width pos hash slots total".split()


def _table(wanted: DataFrame) -> Table:
    """The table of the benchmark's windows: as many bits as suit their number, to a bound."""
    kinds = wanted.groupBy("alone", "width").agg(F.count("*").alias("n")).collect()  # 2 * WIDTH
    n = sum(r.n for r in kinds)
    bits = min(max((n * 64).bit_length(), 12), TABLE_BITS)
    place = F.shiftrightunsigned("hash", 64 - bits)
    words = wanted.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, %d) & 63 as int))" % (64 - bits))).alias("bits")
    )
    held = np.zeros(1 << (bits - 6), dtype="<u8")
    for row in words.toLocalIterator():  # 2 ** (TABLE_BITS - 6) at most
        held[row["word"]] = np.int64(row["bits"]).astype(np.uint64)
    flags = np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)
    return Table(bits, flags, frozenset((bool(r.alone), r.width) for r in kinds))


def _template_length(known: Known | None) -> callable:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _batch_known(batch, known)
            for piece in slices(batch.column("text"), SLICE_BYTES):
                offsets = [found[3] for found in template(piece.words(), own)]
                size = np.minimum(np.concatenate([np.diff(o) for o in offsets]), WIDTH)
                yield pa.RecordBatch.from_arrays([pa.array(size)], names=["size"])

    return measure


def consistent(a: Column, b: Column) -> Column:
    """Whether the values of two equally long arrays map to each other one to one."""
    pairs = F.size(F.array_distinct(F.arrays_zip(a, b)))
    return (pairs == F.size(F.array_distinct(a))) & (pairs == F.size(F.array_distinct(b)))


def matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, item_id, windows, exact, coverage): documents and what they contain.

    ``windows`` is the number of the item's windows found, ``exact`` of those with the same
    values in all slots, ``coverage`` their share of the item. ``text_key`` is a hash of
    the document's text.
    """
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    docs = docs.where("text is not null")
    lower = items.select("text").mapInArrow(_lower_words, "word long").distinct()
    lower = scratch.keep(lower, "known-words")
    if lower.count() <= KNOWN:
        known = Known.of(lower.toPandas()["word"].to_numpy(dtype=np.int64))
    else:
        # The same words are known either way: texts learn by a join which of theirs are.
        known = None
        keyed = items.select("item_id", F.xxhash64("text").alias("text_key"), "text")
        items = scratch.keep(_with_known(keyed, lower).drop("text_key"), "items")
        docs = _with_known(docs, lower)
    # At most WIDTH different lengths.
    texts = items.drop("item_id")
    lengths = texts.mapInArrow(_template_length(known), "size long").distinct().collect()
    widths = sorted({int(r.size) for r in lengths if r.size >= LEAST} | {WIDTH})
    schema = "alone int, width int, pos int, hash long, slots array<long>, total int"
    item_kind = items.schema["item_id"].dataType.simpleString()
    wanted = items.mapInArrow(_windows(widths, known, None), f"item_id {item_kind}, {schema}")
    # Written, so that Spark knows its size: a small benchmark is broadcast, a large one shuffled.
    wanted = scratch.keep(wanted.distinct(), "benchmark-windows")
    table = _table(wanted)
    wanted = wanted.select(
        "item_id",
        F.col("pos").alias("item_pos"),
        F.col("hash").alias("item_hash"),
        F.col("slots").alias("item_slots"),
        "total",
    )
    windows = docs.mapInArrow(
        _windows(widths, known, table), f"doc_id {doc_kind}, text_key long, {schema}"
    )
    found = windows.drop("total", "alone", "width").join(wanted, F.col("hash") == F.col("item_hash"))
    found = found.where(F.size("slots") == F.size("item_slots")).withColumn(
        "exact", F.col("slots") == F.col("item_slots")
    )
    # A passage is a run of windows at one distance; it has at most the item's windows.
    passage = found.groupBy("doc_id", "text_key", "item_id", F.expr("pos - item_pos").alias("at")).agg(
        F.count("*").alias("windows"),
        F.sum(F.col("exact").cast("long")).alias("exact"),
        F.flatten(F.collect_set(F.arrays_zip("slots", "item_slots"))).alias("pairs"),
        F.max("total").alias("total"),
    )
    fits = consistent(F.col("pairs.slots"), F.col("pairs.item_slots"))
    counted = F.when(fits, F.col("windows")).otherwise(F.col("exact"))
    passage = passage.withColumn("windows", counted).where("windows > 0")
    return passage.groupBy("doc_id", "text_key", "item_id").agg(
        F.sum("windows").alias("windows"),
        F.sum("exact").alias("exact"),
        F.least(F.sum("windows") / F.max("total"), F.lit(1.0)).alias("coverage"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """(text_key): the hashes of the texts that contain something of the benchmark."""
    return scratch.keep(matches(docs, benchmark, scratch).select("text_key").distinct(), "leaks")


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that contain nothing of the benchmark."""
    leaks = contaminated(docs, benchmark, scratch).withColumnRenamed("text_key", "leak key")
    return docs.join(leaks, F.xxhash64(docs["text"]) == leaks["leak key"], "left_anti")
