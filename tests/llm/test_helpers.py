"""Numpy helpers against plain Python."""

from __future__ import annotations

import itertools
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inspectstar.llm import decontamination, jaccard, language, lm, quality, repeats, toxicity, words
from inspectstar.llm.words import runs, slices, within
from tests.llm.conftest import prose

TEXT = st.text(alphabet="ab \t\né Z.", max_size=30)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6), st.sampled_from([1, 20, 1000]))
def test_words_are_those_of_the_pattern(texts, size):
    got, hashes = [], {}
    for piece in slices(pa.array(texts, pa.string()), size):
        words = piece.words()
        for i in range(len(piece)):
            span = range(words.offset[i], words.offset[i + 1])
            got.append([words.text(k) for k in span])
        for k, h in enumerate(words.hashes()):
            assert hashes.setdefault(words.text(k), h) == h
    assert got == [_words(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=6), st.integers(1, 5))
def test_runs_stay_inside_documents(sizes, width):
    offset = np.concatenate([[0], np.cumsum(sizes)])
    want = [a + i for a, n in zip(offset, sizes, strict=False) for i in range(n - width + 1)]
    assert within(offset, width).tolist() == want
    values = np.arange(offset[-1], dtype=np.uint64) % 3
    same = {}
    for at, h in enumerate(runs(values, width)):
        assert same.setdefault(tuple(values[at : at + width]), h) == h


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_chosen_seed_is_the_leftmost_smallest(values, choices):
    hashes = np.array(values, dtype=np.uint64)
    got = repeats._chosen(hashes, choices)
    want = [
        min(range(i, i + choices), key=lambda j: (values[j], j))
        for i in range(len(values) - choices + 1)
    ]
    assert got.tolist() == want


def test_isotonic_rates_never_fall():
    rates = quality.isotonic(np.array([10, 10, 10, 10]), np.array([1, 5, 3, 9]))
    assert (np.diff(rates) >= 0).all()
    assert rates[1] == rates[2] == pytest.approx(8.5 / 21)


def test_codewords_are_apart():
    for n in (2, 4, 7, 9, 30):
        code = language.codewords(n)
        agree = code @ code.T - np.diag([code.shape[1]] * n) * 2
        assert agree.max() < code.shape[1]
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_tables_of_a_seating_lie_between_one_and_the_customers():
    draws = np.random.default_rng(0)
    customers = np.array([0, 1, 2, 50, 100_000])
    for opens in (1e-9, 1.0, 1e9):
        tables = lm.seat(customers, np.full(5, opens), draws, 0.5, np.zeros(5))
        assert (tables <= customers).all() and (tables >= np.minimum(customers, 1)).all()
    assert lm.seat(customers, np.full(5, 1e12), draws, 0.5, np.zeros(5))[3] == 50


def test_seating_follows_the_restaurant_rule():
    """Mean number of tables without discount: sum of a / (a + i)."""
    draws = np.random.default_rng(1)
    got = lm.seat(np.full(4000, 200), np.full(4000, 2.0), draws, 0.0, np.zeros(4000)).mean()
    assert got == pytest.approx(sum(2 / (2 + i) for i in range(200)), rel=0.03)


@pytest.mark.parametrize(
    ("shown", "meant"),
    [("m0r0n", "moron"), ("idiiiiot", "idiot"), ("s.c.u.m", "scum"), ("st*pid", "stupid"),
     ("1d10t", "idiot"), ("cl0wn", "clown")],
)
def test_disguised_words_are_restored(spark, shown, meant):
    text = "the moron was an idiot and the stupid clown is scum or so they say in the end"
    docs = spark.createDataFrame([(text,)] * 20, "text string")
    if not hasattr(test_disguised_words_are_restored, "costs"):
        test_disguised_words_are_restored.costs = toxicity.letter_model(docs)
    assert toxicity.restore_word(shown, test_disguised_words_are_restored.costs) == meant


SPOKEN = (
    "you are an idiot and a stupid moron said the man with the better letter to a person who "
    "is an ass in the end so they all went in to see if a way out is well known to some of us"
)


@pytest.fixture(scope="module")
def spoken(spark):
    cyrillic = "\u043e\u043d \u0441\u043a\u0430\u0437\u0430\u043b \u0438\u0434\u0438\u043e\u0442 \u0438 \u0443\u0448\u0435\u043b \u0434\u043e\u043c\u043e\u0439"
    docs = spark.createDataFrame([(SPOKEN,), (cyrillic,)] * 50, "text string")
    return toxicity.letter_model(docs)


@pytest.mark.parametrize(
    ("shown", "meant"),
    [("iiddiioott", "idiot"), ("id.iot", "idiot"), ("id iot", "idiot"), ("i_diot", "idiot"),
     ("@$$", "ass"), ("a i d i o t", "a idiot"), ("y o u i d i o t", "you idiot"),
     ("st upid person", "stupid person"), ("you are a s t u p i d person", "you are a stupid person"),
     ("m-o-r-o-n,", "moron"), ("st\u00a1d", "stid"), ("i*d*i*o*t", "idiot"),
     ("\u0438 \u0434 \u0438 \u043e \u0442", "\u0438\u0434\u0438\u043e\u0442")],
)
def test_disguises_over_word_edges(spoken, shown, meant):
    texts = pa.array([f"so {shown} in the end"])
    assert _restored(texts, spoken) == [f"so {meant} in the end"]


@pytest.mark.parametrize(
    "literal", ["better letter", "a way out", "in to see", "the man", "all went in", "see all", "$500 and 2019",
                "covid19 and 24", "| a | the |", "the end"],
)
def test_literal_readings_stay_where_they_are_likelier(spoken, literal):
    got = _restored(pa.array([literal]), spoken)
    assert got == [literal]


def _restored(texts, costs):
    restorer, out = toxicity.Restorer(costs), []
    for piece in slices(texts):
        piece = piece.lowered()
        words = piece.words()
        found = restorer.restore(piece, words)
        new = {a: (b, t) for a, b, t in found.place}
        for i in range(len(piece)):
            k, parts = int(words.offset[i]), []
            while k < words.offset[i + 1]:
                last, text = new.get(k, (k, words.text(k)))
                parts.append(text)
                k = last + 1
            out.append(" ".join(parts))
    return out


def _likelihood(path, costs):
    """The cost of one path of a lattice, step by step."""
    total, context = 0.0, [27, 27, 27]
    for _, cost, symbols in path:
        total += cost
        for symbol in symbols:
            if symbol != 27 or context != [27, 27, 27]:
                total += float(costs[context[0], context[1], context[2], symbol])
            context = [27, 27, 27] if symbol == 27 else [*context[1:], symbol]
    return total + (float(costs[(*context, 27)]) if context != [27, 27, 27] else 0.0)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aidots1@.* -\u00e9", min_size=1, max_size=7).map(str.strip).filter(bool))
def test_viterbi_finds_the_likeliest_path(spoken, text):
    paths = list(itertools.product(*toxicity._lattice(text)))
    costs = {}
    for path in paths:
        shown = " ".join("".join(step[0] for step in path).split())
        costs[shown] = min(costs.get(shown, np.inf), _likelihood(path, spoken))
    got = toxicity.restore_word(text, spoken)
    assert costs[got] == pytest.approx(min(costs.values()), abs=1e-6)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(SPOKEN.split() + ["id", "iot", "moroon", "st", "upid"]), min_size=1, max_size=8))
def test_plain_words_are_left_out_only_where_the_lattice_keeps_them(spoken, words):
    """The tests of all words at once agree with Viterbi over each word and each pair."""
    text = " ".join(words)
    piece = next(slices(pa.array([text])))
    found = toxicity.Restorer(spoken).restore(piece, piece.words())
    chosen = {k for a, b, _ in found.place for k in range(a, b + 1)}
    for k, word in enumerate(words):
        if k not in chosen:
            assert toxicity.restore_word(word, spoken) == word
            if k + 1 < len(words) and k + 1 not in chosen:
                assert toxicity.restore_word(f"{word} {words[k + 1]}", spoken) == f"{word} {words[k + 1]}"


def test_long_words_and_chains_are_decoded_whole(spoken):
    got = _restored(pa.array(["i d i o t " * 3_000, "1d10t" * 3_000, "a" * 100_000, "@" * 50_000]), spoken)
    assert got[0].split() == ["idiot"] * 3_000
    assert got[1].replace(" ", "").count("idiot") > 2_900


def test_more_runs_for_more_recall():
    depth, runs_ = jaccard.tree_shape(10_000, 0.8, 0.9)
    assert jaccard.tree_shape(10_000, 0.8, 0.999)[1] > runs_
    assert jaccard.tree_shape(10_000_000, 0.8, 0.9)[0] > depth


def _benchmark_and_texts():
    """Known words and windows of three questions, and 2 MB of texts that hold some of them."""
    questions = [prose(i, 30) for i in range(3)]
    batch = pa.RecordBatch.from_pydict({"text": questions})
    known = np.concatenate([b.column(0).to_numpy() for b in decontamination._lower_words(iter([batch]))])
    known = decontamination.Known.of(known)
    items = pa.RecordBatch.from_pydict({"item_id": [0, 1, 2], "text": questions})
    cut = decontamination._windows([decontamination.WIDTH], known, None)
    hashes = np.concatenate([b.column("hash").to_numpy() for b in cut(iter([items]))])
    flags = np.zeros(1 << 20, dtype=bool)
    flags[hashes.view(np.uint64) >> np.uint64(44)] = True
    table = decontamination.Table(20, flags, frozenset([(False, 12), (True, 12)]))
    texts = [prose(10 + i, 300) + " " + questions[i % 3] if i % 2 else prose(10 + i, 300) for i in range(800)]
    texts[5:9] = [None, "", " \n ", "Alone 3 km."]
    return known, table, pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})


def _rows(batches):
    return sorted(tuple(r.values()) for b in batches for r in b.to_pylist())


def test_windows_of_a_batch_need_little_memory_at_once(monkeypatch):
    """Executors share their memory with two workers or more: a few MB of texts may not take hundreds."""
    known, table, texts = _benchmark_and_texts()
    assert texts.nbytes > 1_900_000
    cut = decontamination._windows([decontamination.WIDTH], known, table)
    tracemalloc.start()
    try:
        got = list(cut(iter([texts])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50_000_000
    assert sum(len(b) for b in got) >= 390 * 19
    for size in (1, 10_000, 1 << 40):
        monkeypatch.setattr(decontamination, "SLICE_BYTES", size)
        assert _rows(cut(iter([texts]))) == _rows(got)


def test_grams_of_a_batch_need_little_memory_at_once(monkeypatch):
    texts = _benchmark_and_texts()[2].column("text")
    model = language.LanguageModel(
        ["de", "en", "fr"],
        language.codewords(3),
        np.ones((3, 3)) / 3,
        np.random.default_rng(0).random((3, language._N_BINS)).astype(np.float32),
    )
    rows = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], names=["lang", "text"])
    tracemalloc.start()
    try:
        got = language._margins(model, texts), _rows(language._count_grams(iter([rows])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30_000_000
    for size in (1, 10_000, 1 << 40):
        monkeypatch.setattr(language, "SLICE_BYTES", size)
        assert (language._margins(model, texts) == got[0]).all()
        assert _rows(language._count_grams(iter([rows]))) == got[1]


def test_powers_follow_the_slices(monkeypatch):
    """Workers that see small slices do not hold the powers of large ones."""
    powers = words._Powers()
    monkeypatch.setattr(words, "_powers", powers)
    text = prose(3, 200).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    first = words.span_hashes(data, np.array([0, 5]), np.array([4, 9]))
    assert len(powers.up) <= 2 * len(text)
    words.span_hashes(np.tile(data, 20), np.array([0]), np.array([4]))
    assert words.span_hashes(data, np.array([0, 5]), np.array([4, 9])).tolist() == first.tolist()
    powers.grow(words.SLICE_BYTES)
    assert len(powers.up) <= words.SLICE_BYTES + 1
