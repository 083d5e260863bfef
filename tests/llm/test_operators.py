"""Each operator on small tables: planted cases, odd rows, empty tables."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from inspectstar.llm import (
    decontamination,
    fingerprints,
    jaccard,
    language,
    lm,
    mixing,
    personal,
    quality,
    repeats,
    toxicity,
)
from tests.llm.conftest import odd_rows, prose

N = len(odd_rows())


# Mixing


def test_mix_repeats_by_rate(spark, frame, scratch):
    texts = [f"w{i} " * 10 for i in range(2000)]
    docs = frame(texts, source=["a" if i < 600 else None for i in range(2000)])
    sources = mixing.draw(docs, scratch).groupBy("doc.source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")
    )
    by = {r.source: r for r in sources.collect()}
    # 30,000 words are shared 5 : 2; a stops at twice its 6,000, the excess goes to null.
    assert by["a"].target == 12_000 and by["a"].taken == 12_000
    assert by[None].target == 18_000
    assert by[None].taken == pytest.approx(18_000, rel=0.1)
    mixed = mixing.mix(docs, scratch)
    assert mixed.columns == docs.columns
    again = mixing.mix(docs.repartition(7), scratch)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in again.collect())


def test_mix_odd_rows(odd, nothing, scratch):
    drawn = mixing.draw(odd, scratch).select("doc.*", "copies").collect()
    assert len(drawn) == N
    assert mixing.draw(nothing, scratch).count() == 0
    assert mixing.mix(nothing, scratch).columns == nothing.columns


def test_mix_weights_of_ones_own(spark, frame, scratch):
    docs = frame(["a b c d"] * 4, source=["x", "x", "y", "z"])
    weights = spark.createDataFrame([("x", 1.0), ("y", 1.0)], "source string, weight double")
    drawn = mixing.draw(docs, scratch, weights, share=0.5).collect()
    assert {r.doc.source: r.copies for r in drawn}["z"] == 0


# Language models


def test_lm_odd_rows(odd, nothing, scratch):
    scored = lm.score(odd, F.col("doc_id") != 2, scratch).collect()
    assert len(scored) == N
    by = {r.doc.doc_id: r for r in scored}
    assert by[2].n_tokens == by[3].n_tokens == 1
    assert by[4].n_tokens == 30_001
    assert by[1].score == by[2].score == by[3].score
    assert by[4].score == by[5].score
    assert lm.score(nothing, F.lit(True), scratch).count() == 0


def test_lm_without_training_rows_is_the_base(frame, scratch):
    docs = frame(["a b", ""])
    scored = {r.doc.doc_id: r for r in lm.score(docs, F.lit(False), scratch).collect()}
    assert scored[0].score == 0 and scored[0].n_known == 0 and scored[0].train_tokens == 0


def test_lm_probabilities_of_texts_sum_to_at_most_one(frame, scratch):
    """Texts of no word or one: disjoint events, the unknown word among them."""
    learned = ["ab ab ab cd ef", "ab cd gh", "cd ab ef ef"]
    docs = frame([*learned, "ab", "cd", "ef", "gh", "never", ""])
    scored = lm.score(docs, F.col("doc_id") < 3, scratch).collect()
    assert scored[0].train_tokens == 15
    assert 0 < sum(10**r.score for r in scored if r.doc.doc_id >= 3) <= 1


# Fingerprints


def test_syncmers_against_brute_force(frame, scratch):
    texts = [prose(i, 60) for i in range(6)]
    docs = frame(texts)
    k, s = fingerprints.K, fingerprints.S
    got = docs.select("text", fingerprints.anchors(F.col("text")).alias("a")).collect()
    spark = docs.sparkSession
    runs = {tuple(t.split()[i : i + s]) for t in texts for i in range(61 - s)}
    rows = spark.createDataFrame([(list(r),) for r in runs], "w array<string>")
    nested = F.xxhash64(F.transform("w", lambda w: F.xxhash64(w)))
    small = {tuple(r.w): r.h for r in rows.select("w", nested.alias("h")).collect()}
    for r in got:
        words = r.text.split()
        want = []
        for i in range(len(words) - k + 1):
            inner = [small[tuple(words[j : j + s])] for j in range(i, i + k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                want.append(i)
        assert [a.pos for a in r.a] == want


def test_fingerprints_odd_rows(odd, nothing, scratch):
    rows = fingerprints.with_next(odd, scratch, range_rows=2).collect()
    assert len(rows) == N
    order = sorted(rows, key=lambda r: (r.doc.doc_id is not None, r.doc.doc_id or 0, r.doc.text or ""))
    texts = [r.doc.text for r in order]
    assert [r.next_text for r in order] == texts[1:] + texts[:1]
    by = {r.doc.doc_id: r.hashes for r in rows}
    assert by[1] == by[2] == by[3] == [] and by[4] == by[5] and len(by[6]) == 1
    assert fingerprints.with_next(nothing, scratch).count() == 0


def _brute_next(rows):
    order = sorted(rows, key=lambda r: (r.doc.doc_id is not None, r.doc.doc_id or 0))
    return order, [*order[1:], order[0]]


def test_ranges_stay_even_wherever_ids_lie(spark, scratch):
    """An outlier each way, dense sources far apart, and ids that double."""
    ids = [*range(300), *(2**40 + i for i in range(300)), *(2**i for i in range(20, 63)), -(2**63), 2**63 - 1]
    docs = spark.createDataFrame([(i, prose(n, 8)) for n, i in enumerate(sorted(set(ids)))], "doc_id long, text string")
    rows = 4
    place = fingerprints.ranges(docs, scratch, rows)
    sizes = place(docs, F.col("doc_id"), F.col("text")).groupBy("range").count()
    assert max(r["count"] for r in sizes.collect()) <= fingerprints.UNEVEN * rows
    order, after = _brute_next(fingerprints.with_next(docs, scratch, rows).collect())
    assert len(order) == len(set(ids))
    assert [r.next_text for r in order] == [r.doc.text for r in after]
    assert [r.next_hashes for r in order] == [r.hashes for r in after]


def test_ranges_cut_rows_of_one_id(spark, scratch):
    """A repeated id and missing ids: every row has one successor, each row is one."""
    rows = [(i, prose(n, 8)) for n, i in enumerate([None] * 60 + [5] * 60 + [6, 7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    place = fingerprints.ranges(docs, scratch, 4)
    sizes = place(docs, F.col("doc_id"), F.col("text")).groupBy("range").count()
    assert max(r["count"] for r in sizes.collect()) <= 16
    got = fingerprints.with_next(docs, scratch, 4).collect()
    follows = {r.doc.text: r.next_text for r in got}
    assert sorted(follows.values()) == sorted(t for _, t in rows)
    start = at = follows[rows[-1][1]]
    ids = {t: i for i, t in rows}
    walk = []
    while not walk or at != start:
        walk.append(ids[at])
        at = follows[at]
    assert walk == [None] * 60 + [5] * 60 + [6, 7]


def test_likeness(spark):
    rows = spark.createDataFrame(
        [([1, 2, 3, 3], [2, 3, 4]), ([], []), ([], [1])], "a array<long>, b array<long>"
    )
    got = rows.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [0.5, 1.0, 0.0]


# Repeats


def _brute_repeats(rows, width=20):
    seen, out = set(), {}
    docs = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        out[doc_id] = " ".join(w for i, w in enumerate(words) if i not in gone)
    return out


def test_repeats_against_brute_force(frame, scratch):
    passage, other = prose(50, 25), prose(51, 40)
    texts = [prose(i, 100) for i in range(20)]
    for i in range(0, 20, 3):
        texts[i] += " " + passage + " " + prose(90 + i, 7)
    texts[5] = texts[4]
    texts[7] = other + " " + other[: len(other) // 2] + " " + other
    texts[8] = "same " * 70
    texts[9] = "same " * 21
    docs = frame(texts)
    got = {r.doc.doc_id: r for r in repeats.remove_repeats(docs, scratch).collect()}
    want = _brute_repeats(list(enumerate(texts)))
    assert {i: r.kept for i, r in got.items()} == want
    for i, r in got.items():
        assert r.n_words == len(texts[i].split())
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed


def test_repeats_odd_rows(odd, nothing, scratch):
    rows = repeats.remove_repeats(odd, scratch).collect()
    assert len(rows) == N
    by = {r.doc.doc_id: r for r in rows}
    assert by[4].n_removed == 0 and by[5].n_removed == 30_000 and by[5].kept == ""
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0
    assert repeats.remove_repeats(nothing, scratch).count() == 0


# Personal data


def test_personal_odd_texts(spark, frame, scratch):
    texts = [
        "mail a.b@c-d.org, x@y.z_q@r.s",
        "1" * 20_000 + " " + "a" * 20_000 + "@" + "+1 " * 5000,
        "1.2.3.4 256.1.1.1 1.2.3.4.5 0000000000000000000000000001.2.3.4",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 é 4111111111111111",
        "é\U0001f600 +1 (555) 123-4567 or (555) 123-4567",
        "1.1.1.1 " * 700,
        None,
        "",
    ]
    docs = frame(texts)
    found = personal.candidates(docs).select(
        "doc.doc_id", personal.named(F.col("base")).alias("base")
    )
    got = {r.doc_id: r.base for r in found.collect()}
    assert got[0] == "email:5:16,email:18:23,email:23:29"
    assert got[2] == "ip:0:7,ip:18:25,ip:28:62"
    assert got[3] == "card:0:19,card:46:62"
    assert got[4] == "phone:3:20"
    assert got[5] == ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(700))
    assert got[6] == got[7] == ""


def test_personal_adds_and_redacts(frame, scratch):
    texts = [f"call +1 (555) {100 + i}-{4000 + i} now" for i in range(60)]
    texts += [f"id {10**15 + i * 7} token 12.300.4.{i}" for i in range(60)]
    texts += [f"code x{5550000000 + i}y9 and ab(555) 101-40{i}zz" for i in range(10, 60)]
    texts += ["call (555) 123-4567 now"]
    docs = frame(texts)
    clean = personal.redact(docs, scratch)
    assert clean.columns == docs.columns
    by = {r.doc_id: r.text for r in clean.collect()}
    assert by[0] == "call <PHONE> now"
    assert by[170] == "call <PHONE> now"
    assert by[60] == texts[60]


def test_personal_written_forms_are_proposed(frame, scratch):
    forms = {
        "phone": ["06 12 34 56 78", "030 1234567", "0049 30 1234567", "(030) 123456", "06.12.34.56.78"],
        "email": ["john at example dot com", "jean (at) exemple.fr", "ana arroba ejemplo punto es"],
        "card": ["4111 1111-1111.1111", "3782.822463.10005", "4111/1111/1111/1111"],
    }
    asked = [(kind, form) for kind, several in forms.items() for form in several]
    none = ["met at 10 on 01.02.2024 10:30 with 0.123456789", "look at example.com", "call 0123"]
    texts = [f"write to {form}, please" for _, form in asked] + none
    sure = [f"call +49 30 12{i:05d} now" for i in range(40)]
    sure += [f"call +33 6 12 34 {i} 78 now" for i in range(10, 50)]
    sure += [f"no {i} and x{5550000000 + i}y" for i in range(100, 160)]
    docs = frame(texts + sure)
    found = personal.candidates(docs)
    every = F.transform("proposed", lambda c: F.struct(c["start"], c["rank"], c["end"]))
    named = found.select("doc.doc_id", personal.named(every).alias("spans")).collect()
    got = {r.doc_id: r.spans.split(",") for r in named}
    for i, (kind, form) in enumerate(asked):
        assert f"{kind}:9:{9 + len(form)}" in got[i], form
    for i in range(len(asked), len(texts)):
        assert not [c for c in got[i] if c.startswith(("email", "phone"))], texts[i]
    by = {r.doc_id: r.text for r in personal.redact(docs, scratch).collect()}
    assert by[0] == "write to <PHONE>, please"


def test_personal_context_has_weight(frame, scratch):
    """Neither view sees what its labels are computed from; the context decides as well."""
    texts = [f"host 1.2.3.{i} up" for i in range(200)] + [f"version 1.2.{300 + i}.4 out" for i in range(60)]
    texts += [f"the mail ana{i}@example.org, or else" for i in range(60)] + [f"token x{i}@build.7 set" for i in range(40)]
    texts += ["version 1.2.3.4 out", "host 1 . 2 . 3 . 4 up", "version 1 . 2 . 3 . 4 out"]
    docs = frame(texts)
    found = personal.candidates(docs)
    model = personal.fit(found, scratch)
    assert model.weights["form: speaks"] > 0.1
    assert not {"form: checked", "form: digits", "told: speaks", "told: before"} & set(model.weights)
    score = {
        (r.kind, r.speaks): r.score
        for r in model.cells.groupBy("kind", "speaks").agg(F.max("score_form").alias("score")).collect()
    }
    for kind in (0, 1):
        assert score[kind, 1] > 0.5 > score[kind, 2]
    by = {r.doc.doc_id: r.spans for r in personal.spans(found, model).collect()}
    n = len(texts)
    assert [tuple(s) for s in by[n - 2]] == [(5, 1, 18)] and by[n - 1] == []
    assert [tuple(s) for s in by[n - 3]] == [(8, 1, 15)]  # base spans stay


def _brute_clear(asked, taken):
    return sorted(a for a in asked if not any(t[0] < a[2] and a[0] < t[2] for t in taken))


def test_personal_sweep_and_redaction_against_brute_force(spark):
    draws = random.Random(5)

    def some(n):
        starts = [draws.randrange(0, 1500) for _ in range(n)]
        return sorted({(a, draws.randrange(4), a + draws.randrange(1, 40)) for a in starts})

    rows = []
    for i in range(60):
        text = "".join(draws.choice("ab é\U0001f600\n") for _ in range(draws.choice([1600, 2048, 4100])))
        rows.append((i, text, some(draws.choice([0, 1, 5, 40, 600])), some(draws.choice([0, 1, 5, 40, 600]))))
    kind = "array<struct<start:int,rank:int,end:int>>"
    docs = spark.createDataFrame(rows, f"i int, text string, asked {kind}, taken {kind}")
    got = docs.select(
        "i", personal._clear(F.col("asked"), F.col("taken")).alias("clear"),
        personal.redacted(F.col("text"), F.col("asked")).alias("redacted"),
    )
    for r in got.collect():
        _, text, asked, taken = rows[r.i]
        assert sorted(tuple(s) for s in r.clear) == _brute_clear(asked, taken)
        want, at = [], 0
        for low, rank, high in asked:
            if low >= at:
                want += [text[at:low], f"<{personal.KINDS[rank].upper()}>"]
            at = max(at, high)
        assert r.redacted == "".join(want) + text[at:]


def test_personal_many_spans_in_one_text(spark):
    n = 16_000
    docs = spark.createDataFrame([("mail a.b@example.org now " * n,)], "text string")
    spans = F.expr(f"transform(sequence(0, {n - 1}), i -> struct(25 * i + 5 as start, 0 as rank, 25 * i + 20 as end))")
    begun = time.time()
    got = docs.select(personal.redacted(F.col("text"), spans).alias("t")).first().t
    assert got == "mail <EMAIL> now " * n
    assert time.time() - begun < 20


def test_personal_odd_rows(odd, nothing, scratch):
    assert personal.redact(odd, scratch).count() == N
    assert personal.redact(nothing, scratch).count() == 0


# Language


def test_language_learns_and_flags(frame, scratch):
    en = ["the house of the king and the queen"] * 5
    de = ["das haus und der könig mit der königin"] * 5
    docs = frame(en + de, lang=["en"] * 5 + ["de"] * 5)
    model = language.fit(docs)
    asked = frame(["the king", "der könig", "12 34!", "", None, "das Haus"])
    got = {r.doc.doc_id: r for r in language.identify(asked, model).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["en", "de", "und", "und", "und", "de"]
    assert got[2].ambiguous and got[2].score == 0 and not got[0].ambiguous
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(odd, nothing, scratch):
    model = language.fit(odd)
    assert language.identify(odd, model).count() == N
    none = language.fit(nothing)
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0


# Jaccard join


def _brute_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        sets[i] = set(grams)
    links = {
        i: {j for j in sets if j != i and sets[i] and sets[j]
            and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
        for i in sets
    }
    name = {}
    for i in sorted(sets):
        if i not in name:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in name:
                    name[j] = i
                    todo += links[j]
    return name, {i: len(v) for i, v in links.items()}


def test_jaccard_against_brute_force(frame, scratch, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    texts = []
    for i in range(30):
        words = prose(i, 120).split()
        texts.append(" ".join(words))
        for j in range(4 if i % 3 == 0 else 0):
            changed = list(words)
            for at in range(j + 1):
                changed[11 + 27 * at] = f"new{j}"
            texts.append(" ".join(changed))
    texts += [texts[0]] * 30 + ["a b", "a b", "a b c", "", None, "x  y", "x y"]
    docs = frame(texts)
    got = jaccard.join(docs, scratch).collect()
    name, links = _brute_classes(dict(enumerate(texts)))
    assert {r.doc_id: r.class_id for r in got} == name
    assert {r.doc_id: r.n_links for r in got} == links
    kept = jaccard.deduplicate(docs, scratch)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(name.values()))


def test_jaccard_odd_rows(odd, nothing, scratch):
    got = jaccard.join(odd, scratch).collect()
    assert len(got) == N
    assert {r.class_id for r in got if r.doc_id in (4, 5)} == {4}
    assert [r.n_links for r in got if r.doc_id == 6] == [1, 1]
    kept = jaccard.deduplicate(odd, scratch)
    assert kept.columns == odd.columns
    assert kept.count() == N - 2
    assert jaccard.deduplicate(nothing, scratch).count() == 0


# Quality and toxicity


def test_quality_learns(spark, frame, scratch):
    good = [prose(i, 40 + i).replace("1", "") + "." for i in range(60)]
    bad = ["### " + prose(i, 40 + i).upper() + "$$$ !!!" * 5 for i in range(60)]
    docs = frame([t for pair in zip(good, bad, strict=True) for t in pair])
    described = quality.describe(docs.select("doc_id", "text"))
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).alias("label")).where("doc_id < 90")
    model = quality.fit(described.select("doc.doc_id", "stats").join(labels, "doc_id"))
    scored = quality.score(described, model).select("doc.doc_id", "score").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in scored if r.doc_id >= 90)


def test_quality_learns_from_a_sample(spark, frame, scratch):
    good = [prose(i, 40 + i % 50) + "." for i in range(300)]
    bad = ["### " + prose(i, 40 + i % 50).upper() + "$$$ !!!" * 5 for i in range(300)]
    docs = frame([t for pair in zip(good, bad, strict=True) for t in pair])
    described = quality.describe(docs.select("doc_id", "text"))
    rows = described.select("doc.doc_id", "stats", (1 - F.col("doc.doc_id") % 2).alias("label"))
    model = quality.fit(rows, limit=200, scratch=scratch)
    scored = quality.score(described, model).select("doc.doc_id", "score").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in scored)


def test_quality_odd_rows(odd, nothing):
    described = quality.describe(odd)
    rows = described.select("doc.doc_id", "stats", F.lit(1).alias("label"))
    model = quality.fit(rows)
    scores = quality.score(described, model).collect()
    assert len(scores) == N and all(0 <= r.score <= 1 for r in scores)
    none = quality.fit(rows.limit(0))
    assert {r.score for r in quality.score(described, none).collect()} == {0.5}
    assert quality.describe(nothing).count() == 0


def test_toxicity_learns_and_restores(frame, scratch):
    clean = [prose(i, 30).replace("9", "") for i in range(120)]
    clean = [re.sub("[0-9]", "", t) for t in clean]
    toxic = [t + " you stupid idiot " + t[:40] for t in clean[:40]]
    hidden = [t + s for t, s in zip(clean, [" you st*pid 1d10t", " s t u p i d idiiiiot"], strict=False)]
    docs = frame(clean[:80] + toxic + hidden + clean[80:100])
    labels = docs.select(
        "doc_id", F.col("doc_id").between(80, 119).cast("int").alias("label")
    ).where("doc_id < 120")
    costs = toxicity.letter_model(docs)
    model = toxicity.fit(docs.select("doc_id", "text"), labels, costs, scratch)
    scored = toxicity.score(docs.select("doc_id", "text"), model).select("doc.doc_id", "score")
    by = {r.doc_id: r.score for r in scored.collect()}
    assert by[120] > 0.5 and by[121] > 0.5
    assert max(by[i] for i in range(122, 142)) < 0.5
    shown = toxicity.restore(docs.where("doc_id = 120"), costs).first().restored
    assert shown.endswith("you stupid idiot")


def test_toxic_words_are_known_however_many_rows_there_are(spark, scratch):
    """A word in some 13 of 3,200 toxic rows, fewer than 0.5 % of them, and in no clean one."""
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"),
        F.expr("if(id % 5 = 0 and id < 100, 'so grobble here', concat('so here ', id % 7))").alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("label"))
    model = toxicity.fit(docs, labels, toxicity.letter_model(docs), scratch)
    asked = spark.createDataFrame([(1, "a grobble"), (2, "a house")], "doc_id long, text string")
    by = {r.doc.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert by[1].evidence > 0 == by[2].evidence and by[1].score > by[2].score


def test_toxicity_odd_rows(spark, odd, nothing, scratch):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (7, None)], "doc_id long, label int")
    costs = toxicity.letter_model(odd)
    model = toxicity.fit(odd, labels, costs, scratch)
    assert toxicity.score(odd, model).count() == N
    assert toxicity.restore(odd, costs).count() == N
    none = toxicity.fit(odd, labels.limit(0), toxicity.letter_model(nothing), scratch)
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}


# Decontamination


def test_reparameterised_questions_are_found(spark, frame, scratch):
    item = (
        "A farmer called Miller sold 12 crates of apples for 30 dollars on a rainy day, "
        "then Miller bought 12 more crates from the shop next door."
    )
    bench = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "too short")], "item_id long, text string")
    same = item.replace("Miller", "Baker").replace("12", "7").replace("30", "45")
    uneven = same.replace("7 more", "99 more").replace("then Baker", "then Cooper")
    texts = [
        "Intro words. " + item, "Other words. " + same, prose(3, 50), None, "", "too short",
        item.upper(), "Odd words. " + uneven,
    ]
    got = {r.doc_id: r for r in decontamination.matches(frame(texts), bench, scratch).collect()}
    assert set(got) >= {0, 1} and set(got) <= {0, 1, 6}
    assert got[0].item_id == 1 and got[0].coverage == 1 and got[0].exact == got[0].windows
    assert got[1].exact < got[1].windows
    kept = decontamination.decontaminate(frame(texts), bench, scratch)
    assert {2, 3, 4, 5, 7} <= {r.doc_id for r in kept.collect()}


def test_copies_of_items_with_few_literal_words_are_found(spark, frame, scratch):
    items = [
        "12 + 7 = 19 ; 30 + 4 = 34 ; 8 + 9 = 17 ; 5 + 6 = 11",
        "5 times 6 is 30",
        "Visit Paris London Rome Madrid Berlin Vienna Prague Warsaw Lisbon Athens Dublin Oslo",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"so we write {t} here" for t in items]
    texts += [texts[0].replace("19", "18").replace("34", "35").replace("17", "16"), texts[1].replace("30", "31")]
    texts += [texts[2].lower()]
    got = decontamination.matches(frame(texts), bench, scratch).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (1, 1), (2, 2), (5, 2)}
    assert all(r.exact == r.windows for r in got)


def test_names_numbers_and_units_of_every_form_are_slots(spark, frame, scratch):
    items = {
        1: "Tom has 3 red apples and buys 4 more apples today",
        2: "The box weighs 5kg and the old red box on the left side weighs 9kg",
        3: "we saw thirteen birds in the tall tree near the old mill",
        4: "they came in on the 3rd day of the long march home",
        5: "the letter that Ivan wrote to the mayor was very long indeed",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = [
        "Look here. " + items[1].replace("Tom", "Anna"),
        "Look here. " + items[1].replace("Tom", "Mary Ann"),
        "Look here. " + items[1].replace("Tom", "Élodie"),
        items[2].replace("5kg", "7kg").replace("9kg", "30 kg"),
        items[3].replace("thirteen", "nineteen"),
        items[3].replace("thirteen", "twenty-one"),
        items[4].replace("3rd", "21st"),
        items[5].replace("Ivan", "Иван Petrov"),
        "The red apples and the box on the left side of the tall tree",
    ]
    got = decontamination.matches(frame(texts), bench, scratch).collect()
    want = {(0, 1), (1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (6, 4), (7, 5)}
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.exact < r.windows for r in got)


def test_number_words_of_one_number_are_one_slot(spark, frame, scratch):
    items = {
        1: "the old farm had nine white cows and one black dog near the river",
        2: "in der alten Stadt standen zwölf kleine Häuser und sieben hohe Bäume am Fluss",
        3: "le vieux marchand a vendu quinze pommes vertes pour trente euros au marché hier",
        4: "the company sold 3 million red boxes last summer in the far north",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = [
        items[1].replace("nine", "twenty five"),
        items[2].replace("zwölf", "zwanzig").replace("sieben", "8"),
        items[3].replace("quinze", "seize").replace("trente", "quarante"),
        items[4].replace("3 million", "200"),
        items[1].replace("white cows", "brown pigs"),
    ]
    got = decontamination.matches(frame(texts), bench, scratch).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 1), (1, 2), (2, 3), (3, 4)}


def test_full_tables_change_no_match(spark, frame, scratch, monkeypatch):
    items = [(i, prose(i, 30 + i)) for i in range(12)] + [(20, "5 times 6 is 30")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [prose(50 + i, 40) + " " + prose(i, 20) for i in range(0, 24, 3)] + ["so 5 times 6 is 30"]
    found = []
    for bits, known in ((24, 2_000_000), (6, 2_000_000), (24, 0)):
        monkeypatch.setattr(decontamination, "TABLE_BITS", bits)
        monkeypatch.setattr(decontamination, "KNOWN", known)
        rows = decontamination.matches(frame(texts), bench, scratch).collect()
        found.append(sorted(tuple(r) for r in rows))
    assert found[0] == found[1] == found[2]
    assert {(r[0], r[2]) for r in found[0]} == {(0, 0), (1, 3), (2, 6), (3, 9), (8, 20)}


def test_known_words_are_exact_at_any_number(spark, frame, odd, scratch, monkeypatch):
    """Openers that the benchmark has in lower case are words, others names, however many it has."""
    filler = "".join(f"word{'abcdefghij'[i % 10] * (i // 10 + 1)} " for i in range(300))
    items = {
        1: "Peter bought seven small red apples and gave them to the old man by the door",
        2: "Large trees grow near the cold river where nine white cows stand in the shade",
        3: filler + "large",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = [
        items[1].replace("Peter", "Maria"),
        items[2].replace("Large", "Small"),
        items[2].replace("nine", "four"),
        "so they say. " + items[1].replace("seven", "12"),
    ]
    found = []
    for most in (2_000_000, 0):
        monkeypatch.setattr(decontamination, "KNOWN", most)
        # Once the words beyond KNOWN shared the bits of a table: of so few all were known.
        monkeypatch.setattr(decontamination, "KNOWN_BITS", 1, raising=False)
        rows = decontamination.matches(frame(texts).union(odd), bench, scratch).collect()
        found.append(sorted(tuple(r) for r in rows))
    assert found[0] == found[1]
    assert {(0, 1), (2, 2), (3, 1)} <= {(r[0], r[2]) for r in found[0]}


def test_decontamination_odd_rows(spark, odd, nothing, scratch):
    bench = odd.where("doc_id = 4").select(F.col("doc_id").alias("item_id"), "text")
    got = decontamination.matches(odd, bench, scratch).collect()
    assert {r.doc_id for r in got} == {4, 5}
    assert decontamination.decontaminate(odd, bench, scratch).count() == N - 2
    assert decontamination.decontaminate(odd, bench.limit(0), scratch).count() == N
    assert decontamination.decontaminate(nothing, bench, scratch).count() == 0
