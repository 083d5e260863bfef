"""The language model's contexts: words themselves, in shards, against brute-force Gibbs."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from inspectstar.llm import lm
from tests.llm.test_lm import _Franchise, _trigrams


def test_contexts_are_words_and_not_classes(frame, scratch):
    """Words that only ever follow one other word are told from those of all other contexts."""
    n, others = 120, 8
    learned = [f"a{i} b{i}" for i in range(n)] * 6
    own = [f"a{i} b{i}" for i in range(n)]
    mixed = [f"a{i} b{(i + k) % n}" for i in range(n) for k in range(1, others + 1)]
    docs = frame(learned + own + mixed)
    scored = lm.score(docs, F.col("doc_id") < len(learned), scratch)
    by = {r.doc.doc_id - len(learned): r.score for r in scored.collect()}
    for i in range(n):
        for k in range(others):
            assert by[i] > by[n + i * others + k] + 1


class _Shards:
    """The shards of one chunk, their mail carried by hand."""

    def __init__(self, docs, learns, base, shards):
        table = pa.table({"text": docs, "learns": learns, "chunk": pa.array([0] * len(docs), pa.int32())})
        self.blob = pa.Table.from_batches(list(lm._packed(table.to_batches())))
        self.shards, self.base, self.roots, self.held = shards, base, [], []
        sent = lm._send_grams(shards)(self.blob)
        self.contexts = {s: lm._gather_grams(self.of(sent, s)) for s in set(sent["shard"].to_pylist())}
        asked = self.all(lm._ask_words(shards)(t.to_batches()) for t in self.contexts.values())
        self.words = {
            s: lm._gather_words_asked(t, self.of(asked, s)) for s, t in self.contexts.items()
        }

    def of(self, table, shard):
        return table.filter(pc.equal(table["shard"], shard))

    def all(self, parts):
        return pa.Table.from_batches([b for batches in parts for b in batches])

    def sweep(self):
        number, root = len(self.roots), self.roots[-1] if self.roots else None
        if number:
            run = lm._sweep_shards(self.shards, root, number - 1)
            mail = pa.concat_tables(run(t, self.of(self.mail, s)) for s, t in self.contexts.items())
        else:
            mail = self.all(lm._open_shards(self.shards)(t.to_batches()) for t in self.contexts.values())
        own, up = self.split(mail)
        if number:
            up = pa.concat_tables([up, self.by_words])
        run = lm._sweep_words(root, number)
        answered = pa.concat_tables(run(t, self.of(up, s)) for s, t in self.words.items())
        self.by_words, down = self.split(answered)
        self.mail = pa.concat_tables([own, down])
        guests, used = (pc.sum(self.by_words[c]).as_py() for c in ("guests", "used"))
        self.roots.append(lm._Root(guests, used, self.base))

    def split(self, mail):
        own = pc.equal(mail["sender"], lm._OWN)
        return mail.filter(own), mail.filter(pc.invert(own))

    def chances(self):
        """Of the chunk's n-grams, in the state."""
        chunk = lm._Chunk(self.blob)
        out = np.zeros(len(chunk.next))
        for one, _, _, grams in chunk.deal(self.shards):
            dishes = lm._Shard(self.contexts[one]["dishes"][0])
            number = len(self.roots) - 1
            state, totals = lm._opened(dishes, self.of(self.mail, one), self.roots[-1], number, self.shards)
            ((_, place),) = lm._requests(self.contexts[one]["asked"][0])
            out[grams] = dishes.chances(state, totals)[2][place]
        return out


@pytest.mark.parametrize("shards", [1, 3])
def test_shards_agree_with_brute_force_gibbs(shards):
    rnd = random.Random(4)
    words = "a b c d e f".split()
    texts = [[rnd.choice(words[: 3 + i % 4]) for _ in range(9)] for i in range(12)]
    asked = [["a", "b", "a"], ["f", "f"], ["zz"], []]
    docs = [" ".join(t) for t in texts + asked]
    kinds = len({w for t in texts for w in t} | {"</s>"})
    franchise, samples = _Franchise(texts, kinds, random.Random(5)), 300
    want = [0.0] * len(asked)
    chances = [[0.0] * len(_trigrams(t)) for t in asked]
    for number in range(50 + samples):
        franchise.sweep()
        if number >= 50:
            for i, t in enumerate(asked):
                for j, (context, word) in enumerate(_trigrams(t)):
                    chances[i][j] += franchise.chance(context, word) / samples
    want = [sum(map(math.log10, own)) for own in chances]

    learns = [i < len(texts) for i in range(len(docs))]
    chain = _Shards(docs, learns, 1 / (kinds + 1), shards)
    held = 0
    for number in range(200):
        chain.sweep()
        if number >= 40:
            held = held + chain.chances() / 160
    ((_, _, gram, _, offset),) = lm._Chunk(chain.blob).held
    for i, total in enumerate(want):
        own = gram[offset[len(texts) + i] : offset[len(texts) + i + 1]]
        assert np.log10(held[own]).sum() == pytest.approx(total, abs=0.06 * len(own))


def test_shards_change_no_probability():
    rnd = random.Random(6)
    texts = [" ".join(f"w{int(rnd.random() ** 3 * 50)}" for _ in range(40)) for _ in range(30)]
    found = []
    for shards in (1, 7):
        chain = _Shards(texts, [i % 4 != 0 for i in range(30)], 0.02, shards)
        for _ in range(4):
            chain.sweep()
        found.append(chain.chances())
    assert np.allclose(*found, rtol=1e-9)


def test_stored_shards_are_joined_where_they_lie(spark, scratch):
    rows = spark.range(40).selectExpr("cast(id as int) AS shard", "id AS value")
    stored = lm._stored(rows, "shards", 8, scratch)
    run = lambda left, right: left.select(["shard"])
    joined = stored.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(run, "shard int")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "Bucketed: true" in plan or "bucket" in plan.lower()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert joined.count() == 40 and not [t for t in spark.catalog.listTables() if "shards" in t.name]
