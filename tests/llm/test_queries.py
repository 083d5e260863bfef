"""The registered queries: against SQL where there is a twin, else brute force or held-out rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from inspectstar.llm import personal
from inspectstar.llm.oracles import ORACLES
from inspectstar.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tests.llm.test_operators import _brute_classes

SMALL, LARGER = f"{TESTDATA}/sf0.001", f"{TESTDATA}/sf0.01"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in sorted(rows)}


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def run(name, sf_dir=SMALL):
        if (name, sf_dir) not in held:
            held[name, sf_dir] = QUERIES[name](spark, sf_dir).collect()
        return held[name, sf_dir]

    return run


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, result, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    twin = connection.execute(ORACLES[name])
    columns = [c[0] for c in twin.description]
    want = sorted(map(repr, (tuple(r) for r in twin.fetchall())))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in result(name)) == want


def test_op2_base_is_exact_and_the_model_better(result, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*_words((t or "").translate(lower)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(count.values()), len(count)
    rows = result("op2_scores")
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in ws)
        assert r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.train_tokens) == (len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(base)
    for out in (True, False):
        chosen = [r for r in rows if r.held_out == out]
        assert sum(r.score for r in chosen) > sum(r.base_score for r in chosen)


def test_op3_edits_and_likeness(result, texts):
    following = dict(zip(texts, [*list(texts.values())[1:], next(iter(texts.values()))], strict=True))
    rows = result("op3_fingerprints")
    prints = {}
    for r in rows:
        text, after = texts[r.doc_id] or "", following[r.doc_id] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    near = sum(r.near_edited > r.near_next for r in rows)
    assert near >= 0.95 * len(rows)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
        "card": 12 <= len(digits) <= 19 and _luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def test_op5_base_spans(result, texts):
    found = 0
    for r in result("op5_personal"):
        spans = sorted(
            (m.start(), rank, m.end())
            for rank, (kind, pattern) in enumerate(PATTERNS.items())
            for m in re.finditer(pattern, texts[r.doc_id] or "")
            if _passes(kind, m.group())
        )
        named = [f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(",")) | {""}
        assert [r[f"n_{k}"] for k in PATTERNS] == [
            sum(s[1] == i for s in spans) for i in range(len(PATTERNS))
        ]
        found += len(spans)
    assert found


def _labels(spark, sf_dir, column):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", column).collect()}


def test_op6_held_out_accuracy(spark, result):
    langs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()
    langs = {r.doc_id: r.lang for r in langs}
    held = [r for r in result("op6_language", LARGER) if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize(
    ("name", "column", "least"), [("op8_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.9)]
)
def test_held_out_accuracy(spark, result, name, column, least):
    labels = _labels(spark, LARGER, column)
    rows = result(name, LARGER)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= least * len(held)


def test_op7_classes(result, texts):
    name, links = _brute_classes(texts)
    rows = result("op7_jaccard")
    assert {r.doc_id: r.class_id for r in rows} == name
    assert {r.doc_id: r.n_links for r in rows} == links


def test_op10_finds_contained_items(spark, result, texts):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    inside = {(i, item.item_id) for item in items for i, t in texts.items() if item.text in (t or "")}
    found = {(r.doc_id, r.item_id) for r in result("op10_decontamination")}
    assert inside and inside <= found
    # The rest contains most of an item word for word, in another case or layout.
    squeezed = {i: " ".join(_words((t or "").lower())) for i, t in texts.items()}
    by = {item.item_id: _words(item.text.lower()) for item in items}
    for i, item in found - inside:
        words = by[item]
        assert any(" ".join(words[k : k + 8]) in squeezed[i] for k in range(len(words) - 7))


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages)[-1] == "mixing" and len(stages) == 5
    kept = stages["language"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    lettered = {i for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids <= lettered and len(ids) >= len(lettered) - 2

    name, _ = _brute_classes(texts)
    one = stages["near_duplicates"](spark, docs, SMALL)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(name.values()))

    leaks = {r.doc_id for r in QUERIES["op10_decontamination"](spark, SMALL).collect()}
    clean = stages["decontamination"](spark, docs, SMALL)
    assert {r.doc_id for r in clean.collect()} == set(texts) - leaks

    hidden = stages["personal"](spark, docs, SMALL)
    assert hidden.columns == docs.columns
    for r in hidden.collect():
        assert not re.search(PATTERNS["email"], r.text) and r.n_chars == len(r.text)

    mixed = stages["mixing"](spark, docs, SMALL)
    taken = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert taken == {r.doc_id: r.copies for r in QUERIES["op1_mixing"](spark, SMALL).collect() if r.copies}


def test_pipeline_runs(spark):
    mixed = corpus_pipeline.run(spark, SMALL)
    assert 0 < mixed.count() < 400
    assert mixed.where(F.col("text").isNull()).count() == 0
