"""The language model: Gibbs sweeps against exact chains, word contexts in any script."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inspectstar.llm import lm



def _even(seed):
    draws = np.random.default_rng(seed)
    return lambda dishes: draws.random(len(dishes))


def _exact_tables(customers, others, parent, level):
    """The distribution of the tables of one dish, over all its seatings one customer at a time."""
    d = lm.DISCOUNT[level]
    states = {(1,): (lm.STRENGTH + d * others) * parent}
    for _ in range(customers - 1):
        after = {}
        for sizes, weight in states.items():
            opened = tuple(sorted((*sizes, 1)))
            share = (lm.STRENGTH + d * (others + len(sizes))) * parent
            after[opened] = after.get(opened, 0) + weight * share
            for i, n in enumerate(sizes):
                joined = tuple(sorted((*sizes[:i], n + 1, *sizes[i + 1 :])))
                after[joined] = after.get(joined, 0) + weight * (n - d)
        states = after
    out = np.zeros(customers + 1)
    for sizes, weight in states.items():
        out[len(sizes)] += weight
    return out / out.sum()


@pytest.mark.parametrize("level", [0, 1, 2])
@pytest.mark.parametrize(
    ("customers", "others", "parent"), [(2, 5, 0.01), (7, 0, 0.3), (9, 40, 0.05)]
)
def test_tables_are_drawn_from_the_conditional(level, customers, others, parent):
    n = 40_000
    drawn = lm.draw_tables(
        np.full(n, customers), np.full(n, others), np.full(n, parent), level, _even(1)
    )
    share = np.bincount(drawn, minlength=customers + 1) / n
    want = _exact_tables(customers, others, parent, level)
    assert np.abs(share - want).max() < 0.015


@pytest.mark.parametrize("level", [0, 1, 2])
@pytest.mark.parametrize(("others", "parent"), [(50, 0.2), (0, 0.5), (3, 1e-3), (5000, 1e-3), (10**6, 1e-6)])
def test_many_customers_agree_with_the_exact_rule(level, others, parent):
    """At the border between the two the means and spreads are alike."""
    n = 4_000
    asked = (np.full(n, lm.EXACT), np.full(n, others), np.full(n, parent))
    exact = lm.draw_tables(*asked, level, _even(2))
    other = lm._many_tables(*asked, lm.DISCOUNT[level], _even(3)(range(n)))
    assert other.mean() == pytest.approx(exact.mean(), rel=0.08, abs=0.1)
    assert other.std() == pytest.approx(exact.std(), rel=0.2, abs=0.15)


class _Franchise:
    """A plain franchise of restaurants of explicit tables, swept one customer at a time."""

    def __init__(self, texts, kinds, rnd):
        self.base, self.rnd = 1 / (kinds + 1), rnd
        self.rooms = {}
        self.seats = []
        for words in texts:
            for context, word in _trigrams(words):
                self.seats.append((context, word, self.add(context, word)))

    def room(self, context):
        return self.rooms.setdefault(context, {})

    def chance(self, context, word):
        if context is None:
            return self.base
        room, d = self.room(context), lm.DISCOUNT[len(context)]
        sizes = room.get(word, [])
        guests = sum(sum(t) for t in room.values())
        tables = sum(len(t) for t in room.values())
        own = sum(sizes) - d * len(sizes)
        return (own + (lm.STRENGTH + d * tables) * self.chance(_up(context), word)) / (lm.STRENGTH + guests)

    def add(self, context, word):
        if context is None:
            return
        room, d = self.room(context), lm.DISCOUNT[len(context)]
        sizes = room.setdefault(word, [])
        tables = sum(len(t) for t in room.values())
        new = (lm.STRENGTH + d * tables) * self.chance(_up(context), word)
        at = self.rnd.random() * (sum(sizes) - d * len(sizes) + new)
        for i, n in enumerate(sizes):
            at -= n - d
            if at < 0:
                sizes[i] += 1
                return
        sizes.append(1)
        self.add(_up(context), word)

    def remove(self, context, word):
        if context is None:
            return
        sizes = self.room(context)[word]
        at = self.rnd.random() * sum(sizes)
        for i, n in enumerate(sizes):
            at -= n
            if at < 0:
                break
        sizes[i] -= 1
        if not sizes[i]:
            sizes.pop(i)
            self.remove(_up(context), word)

    def sweep(self):
        for context, word, _ in self.seats:
            self.remove(context, word)
            self.add(context, word)


def _up(context):
    return context[1:] if context else None


def _trigrams(words):
    padded = ["<s>", "<s>", *words, "</s>"]
    return [((padded[i - 2], padded[i - 1]), padded[i]) for i in range(2, len(padded))]


def test_chain_agrees_with_brute_force_gibbs():
    """Averaged predictive probabilities of a small corpus, against customer-wise Gibbs."""
    rnd = random.Random(4)
    words = "a b c d e f".split()
    texts = [[rnd.choice(words[: 3 + i % 4]) for _ in range(9)] for i in range(12)]
    asked = [["a", "b", "a"], ["f", "f"], ["zz"], []]
    docs = [" ".join(t) for t in texts + asked]
    kinds = len({w for t in texts for w in t} | {"</s>"})
    franchise = _Franchise(texts, kinds, random.Random(5))
    samples = 300
    want = [[0.0] * len(_trigrams(t)) for t in asked]
    for number in range(50 + samples):
        franchise.sweep()
        if number >= 50:
            for i, t in enumerate(asked):
                for j, (context, word) in enumerate(_trigrams(t)):
                    want[i][j] += franchise.chance(context, word) / samples
    sums = [sum(math.log10(p) for p in ps) for ps in want]

    # The library's own pieces in one process; classes of 16 bits keep all contexts apart.
    contexts = lm.Contexts(8, 8)
    table = pa.table({"text": docs, "learns": [i < len(texts) for i in range(len(docs))]})
    blob = next(iter(lm._packed([table.append_column("chunk", pa.array([0] * len(docs), pa.int32())).to_batches()[0]])))
    sent = lm._send_words(1, contexts)(pa.Table.from_batches([blob]))
    (row,) = lm._gather_words(contexts)(sent).to_batches()
    dishes, totals = lm._Dishes(row.column("dishes")[0], contexts), []
    held = np.zeros(len(dishes.count))
    base = 1 / (kinds + 1)
    state = dishes.start()
    for number in range(200):
        totals = _totals_of(dishes, state, base, contexts)
        state = dishes.swept(state, totals, number)
        if number >= 40:
            held += dishes.chances(state, _totals_of(dishes, state, base, contexts))[2] / 160
    _, asked_again = lm._asked(pa.Table.from_batches([blob]), contexts)
    ((_, _, code, offset),) = asked_again
    order = np.unique(code)
    chance = dict(zip(order.tolist(), held.tolist(), strict=True))  # one chunk asks for each once
    for i, total in enumerate(sums):
        own = code[offset[len(texts) + i] : offset[len(texts) + i + 1]].tolist()
        got = sum(math.log10(chance[c]) for c in own)
        assert got == pytest.approx(total, abs=0.06 * len(own))


def _totals_of(dishes, state, base, contexts):
    rows = []
    for k in range(3):
        n = 1 << contexts.bits[k]
        guests = np.bincount(dishes.room[k], state.customers[k], minlength=n).astype(np.int64)
        used = np.bincount(dishes.room[k], state.tables[k], minlength=n).astype(np.int64)
        for i in range(0, n, lm.ROOMS):
            rows.append((k, i // lm.ROOMS, guests[i : i + lm.ROOMS], used[i : i + lm.ROOMS]))
    return lm._Totals(lm._total_rows(rows), base, contexts)


def test_replayed_chains_are_one_chain():
    """A longer replay passes through the states of the shorter one."""
    contexts = lm.Contexts(8, 8)
    docs = ["a b a b c", "a b c a b", "b c a"] * 5
    table = pa.table({"text": docs, "learns": [True] * 15, "chunk": pa.array([0] * 15, pa.int32())})
    blob = next(iter(lm._packed(table.to_batches())))
    sent = lm._send_words(1, contexts)(pa.Table.from_batches([blob]))
    (row,) = lm._gather_words(contexts)(sent).to_batches()
    block = row.column("dishes")[0]
    dishes, totals = lm._Dishes(block, contexts), []
    for _ in range(4):
        *_, state = dishes.chain(totals)
        totals.append(_totals_of(dishes, state, 0.2, contexts))
    states = [list(lm._Dishes(block, contexts).chain(totals[:n])) for n in range(4)]
    for n in range(3):
        for one, other in zip(states[n], states[n + 1], strict=False):
            assert all((a == b).all() for a, b in zip(one.tables, other.tables, strict=True))
    assert any((a != b).any() for a, b in zip(states[3][1].tables, states[3][3].tables, strict=True))


@pytest.mark.parametrize("letters", ["abcdefghij", "абвгдежзик", "αβγδεζηθικ", "東西南北春夏秋冬上下"])
def test_word_order_matters_in_any_script(frame, scratch, letters):
    rnd = random.Random(1)
    words = ["".join(rnd.choice(letters) for _ in range(5)) for _ in range(60)]
    ordered = " ".join(words)
    shuffled = list(words)
    rnd.shuffle(shuffled)
    noise = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(30)]
    docs = frame([ordered] * 60 + noise + [ordered, " ".join(shuffled)])
    scored = lm.score(docs, F.col("doc_id") < 90, scratch).collect()
    by = {r.doc.doc_id: r for r in scored}
    assert by[90].base_score == pytest.approx(by[91].base_score)
    assert by[90].score > by[91].score + 40
    assert by[90].score > by[90].base_score + 60


def test_repeated_documents_are_told_apart(frame, scratch):
    rnd = random.Random(2)
    once = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(80)) for _ in range(60)]
    fresh = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(80)) for _ in range(20)]
    docs = frame(once + once[:20] + fresh)
    by = {r.doc.doc_id: r for r in lm.score(docs, F.col("doc_id") < 60, scratch).collect()}
    seen = [by[i].score / by[i].n_tokens for i in range(60, 80)]
    unseen = [by[i].score / by[i].n_tokens for i in range(80, 100)]
    assert min(seen) > max(unseen) + 1


def test_contexts_grow_with_the_corpus():
    bits = [lm.Contexts.of(n).bits[2] for n in (0, 10**5, 10**7, 10**9, 10**13)]
    assert bits == sorted(bits) and bits[0] < bits[1] < bits[2] < bits[3] == bits[4] == lm.MOST_BITS


def test_blocks_and_chunks_change_no_score(frame, scratch, monkeypatch):
    """Draws depend on word, restaurant and sweep alone."""
    rnd = random.Random(6)
    texts = [" ".join(f"w{int(rnd.random() ** 3 * 50)}" for _ in range(70)) for _ in range(40)]
    found = []
    for chunk, block, rooms in ((24_000_000, 500_000, 1 << 15), (900, 20, 8)):
        monkeypatch.setattr(lm, "ROOMS", rooms)
        monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(lm, "BLOCK", block)
        rows = lm.score(frame(texts), F.col("doc_id") % 4 != 0, scratch).collect()
        found.append({r.doc.doc_id: (r.n_known, r.base_score, r.score) for r in rows})
    assert len(found[0]) == 40
    for i, values in found[0].items():
        assert found[1][i] == pytest.approx(values, rel=1e-4)


def test_sweeps_draw_only_for_dishes_of_several_customers(spark, frame, scratch, monkeypatch):
    contexts = lm.Contexts.of(5_000)
    item, count = np.arange(1, 41), np.arange(40) % 4
    two = np.arange(40) << contexts.bits[2]
    blob = lm._zip(lm._ascending(item), count) + lm._zip(lm._ascending(two), count)
    dishes = lm._Dishes(pa.scalar(blob, pa.binary()), contexts)
    totals = lm._Totals(lm._total_rows(iter([])), 0.01, contexts)
    seen, draw = [], lm.draw_tables
    monkeypatch.setattr(lm, "draw_tables", lambda c, *rest: seen.append(c) or draw(c, *rest))
    state = dishes.swept(dishes.start(), totals, 0)
    assert all((c > 1).all() for c in seen) and len(seen[0]) == 20
    assert (state.tables[2] <= count).all() and (state.tables[2] >= np.minimum(count, 1)).all()
