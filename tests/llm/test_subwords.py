"""Token files, periodic runs and aligned tokenizers against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from inspectstar.llm import alignment, periodic, subwords, tokenfiles
from inspectstar.llm.queries import END_ID, QUERIES
from inspectstar.llm.words import mix64
from tests.conftest import TESTDATA
from tests.llm.conftest import SCHEMA, odd_rows, prose, row

SMALL = f"{TESTDATA}/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD_TEXTS = [
    "", " ", "a  b", " a", "a ", "x\n y", "x\n  y", "x  y", "a\t b  c\r\n d", "trail   ",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "it's we'll 12 ab12cd ..! (x)  é ñandú ×",
    "東京 x ́y 　 z ▁ a▁b <s> </s> <0x41>", "a\x1cb \x1d c", "İ ﬁ ½ ²", "a" * 3000,
    " a b" * 1000, "don't  can'T 's  's", "word, word. (word) word;word", "  x  y", "y\n z",
]


def _texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def _ids(texts, encoder):
    import pyarrow as pa

    held = list(subwords.encoded(pa.array(texts), encoder))
    return [h.ids[h.offset[i] : h.offset[i + 1]].tolist() for h in held for i in range(len(h.piece))]


@pytest.mark.parametrize("special", [True, False])
def test_pieces_have_the_ids_of_whole_texts(spark, special):
    texts = [*ODD_TEXTS, *[t or "" for t in _texts(spark).values()]]
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = not special
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert _ids(texts, subwords.byte_level(BYTES, special)) == want


def test_sentence_pieces_have_the_ids_of_whole_texts(spark):
    texts = [*ODD_TEXTS, *[t or "" for t in _texts(spark).values()]]
    model = SentencePieceProcessor(model_file=PIECES)
    got = _ids([" " + t for t in texts], subwords.sentence_pieces(PIECES))
    assert got == model.encode(texts, num_threads=1)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED_PARTS", 2)
    monkeypatch.setattr(subwords, "REMEMBERED_PIECES", 2)
    monkeypatch.setattr(subwords, "SLICE_BYTES", 20)
    texts = ["one two three", "four, five. six", "one two seven", None, "eight"] * 3
    whole = Tokenizer.from_file(BYTES)
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert _ids(texts, subwords.ByteLevel(BYTES, True)) == want


# Token files


def _expected_files(rows):
    """(key, start, ids) in file order, of (key, text)."""
    whole = Tokenizer.from_file(BYTES)
    out, start = [], 0
    for key, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, END_ID]
        out.append((key, start, ids))
        start += len(ids)
    return out


def test_op11_query(spark):
    want = _expected_files(sorted(_texts(spark).items()))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_token_files"](spark, SMALL).collect()}
    assert got == {
        k: (s, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for k, s, ids in want
    }


def test_token_files_round_trip_odd_rows(spark, scratch, odd, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_BYTES", 500)  # many blocks
    monkeypatch.setattr(tokenfiles, "LEAST_PART_BYTES", 50_000)  # several parts
    folder = scratch.path("files")
    tokenfiles.write(odd, folder, BYTES, END_ID)
    found = tokenfiles.read(spark, folder).collect()
    whole = Tokenizer.from_file(BYTES)
    want = Counter(
        (r[0], tuple([*whole.encode(r[1] or "", add_special_tokens=False).ids, END_ID]))
        for r in odd_rows()
    )
    got = sorted(found, key=lambda r: r.start)
    assert want == Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    one = tokenfiles.lookup(spark, folder, [6, 4, 999]).collect()
    assert Counter(r.doc_id for r in one) == {6: 2, 4: 1}
    assert {tuple(r) for r in one} <= {tuple(r) for r in found}
    assert tokenfiles.lookup(spark, folder, []).count() == 0


def test_token_files_share_a_dictionary(spark, scratch):
    folder = scratch.path("files")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tokenfiles.write(docs, folder, BYTES, END_ID)
    shared = spark.read.parquet(f"{folder}/dictionary").collect()
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert len(shared) == 1 and len(shared[0].dictionary) > 1000
    assert {r.dictionary for r in blocks.select("dictionary").distinct().collect()} == {shared[0].hash}
    assert {r.width for r in blocks.collect()} == {2}
    spark.createDataFrame([(shared[0].hash, b"x" * 5000)], "hash string, dictionary binary").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="not the dictionary"):
        tokenfiles.read(spark, folder).collect()


def test_token_files_of_text_keys_and_of_nothing(spark, scratch, nothing):
    folder = scratch.path("files")
    tokenfiles.write(nothing, folder, BYTES, END_ID)
    assert tokenfiles.read(spark, folder).count() == 0
    folder = scratch.path("files")
    docs = spark.createDataFrame([("b", "two words"), ("a", None)], "name string, body string")
    tokenfiles.write(docs, folder, BYTES, END_ID, key="name", text="body")
    got = sorted(tuple(r)[:3] for r in tokenfiles.read(spark, folder).collect())
    assert got == [("a", 0, 1), ("b", 1, 3)]
    assert [r.doc_id for r in tokenfiles.lookup(spark, folder, ["b"]).collect()] == ["b"]


# Periodic runs


def _brute_runs(ws):
    found = {}
    for q in range(1, len(ws) // 3 + 1):
        j = 0
        while j + q < len(ws):
            k = j
            while k + q < len(ws) and ws[k] == ws[k + q]:
                k += 1
            if k > j and k + q - j >= max(24, 3 * q):
                found.setdefault((j, k + q), q)
            j = k + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _repetitive(rnd):
    n = rnd.choice([0, 1, 5, 23, 24, 60, 200, 500, 900])
    kinds = rnd.choice([1, 2, 3, 50, 10**6])
    words = [rnd.randrange(kinds) for _ in range(n)]
    for _ in range(rnd.choice([0, 1, 3]) if n >= 10 else 0):
        a = rnd.randrange(n)
        p = rnd.randrange(1, max(2, (n - a) // 3 + 2))
        for i in range(a + p, min(n, a + p * rnd.choice([2, 3, 4, 7]) + rnd.randrange(3))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [_repetitive(rnd) for _ in range(60)]
    offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = mix64(np.array([w for t in texts for w in t], dtype=np.uint64))
    got = [tuple(r) for r in periodic.find(words, offset).tolist()]
    want = [(o + s, o + s + n, q) for t, o in zip(texts, offset, strict=False) for s, n, q in _brute_runs(t)]
    assert want and got == want


def _periodic_words(i, text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(ws)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = ws[:a] + [ws[a + (j - a) % p] for j in range(a, n)]
    return ws


def test_op12_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op12_runs"](spark, SMALL).collect()}
    texts = _texts(spark)
    assert set(rows) == set(texts)
    seen = 0
    for i, text in texts.items():
        ws = _periodic_words(i, text)
        runs = _brute_runs(ws)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        assert tuple(rows[i]) == (
            i, len(runs), *best, milli,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
        )
        seen += len(runs)
    assert seen


def test_runs_of_odd_rows(odd, nothing, frame):
    rows = periodic.collapse(odd).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.runs == [] for r in rows)
    long = next(r for r in rows if r.doc.doc_id == 4)
    assert long.n_words == 30_000 and long.collapsed == prose(1, 30_000)
    assert {r.collapsed for r in rows if r.doc.doc_id in (None, 1, 2, 3)} == {"", "no id here"}
    assert periodic.collapse(nothing).count() == 0
    block = prose(7, 2_000)
    far = f"start {' '.join([block] * 4)} end"
    got = periodic.collapse(frame([far, "a b " * 40])).collect()
    assert [[tuple(x) for x in r.runs] for r in got] == [[(1, 8000, 2000)], [(0, 80, 2)]]
    assert [r.collapsed for r in got] == [f"start {block} end", "a b"]


def test_strongest_run_is_exact(spark):
    runs = [(0, 30, 7), (5, 60, 14), (9, 10**9 + 1, 10**8), (20, 10**9 + 1, 10**8)]
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    best = [r[0] for r in df.select(periodic.strongest(F.col("runs"))).collect()]
    assert tuple(best[0]) == (9, 10**9 + 1, 10**8) and best[1] is None


# Aligned tokenizers


def _brute_alignment(texts):
    """(n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of each text."""
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    model = SentencePieceProcessor(model_file=PIECES)
    signs = {s: b for b, s in enumerate(subwords.byte_signs())}
    groups, documents = [], defaultdict(set)
    for i, text in enumerate(texts):
        found = []
        if text:
            a = whole.encode(" " + text, add_special_tokens=False)
            a = [(t, bytes(signs[s] for s in whole.id_to_token(t))) for t in a.ids]
            b = [
                (t, bytes([int(model.id_to_piece(t)[3:5], 16)]) if model.is_byte(t)
                 else model.id_to_piece(t).replace("▁", " ").encode())
                for t in model.encode(text)
            ]
            spelled = {b"".join(x for _, x in side) for side in (a, b)}
            if spelled == {(" " + text).encode()}:
                at = [0, 0]
                while a or b:
                    own = ([], [])
                    while not (own[0] and own[1] and at[0] == at[1]):
                        k = 0 if at[0] <= at[1] and a else 1
                        token, raw = (a, b)[k].pop(0)
                        own[k].append(token)
                        at[k] += len(raw)
                    found.append(own)
        groups.append(found)
        for xs, ys in found:
            for x in xs:
                for y in ys:
                    documents[x, y].add(i)
    count = {pair: len(d) for pair, d in documents.items()}
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for found in groups:
        links = [(x, y) for xs, ys in found for x in xs for y in ys]
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in found)
        out.append(
            (
                sum(len(xs) for xs, _ in found), sum(len(ys) for _, ys in found), len(found),
                len(links), shown, sum(count[p] == highest[p[0]] for p in links),
                sum(count[p] for p in links),
            )
        )
    return out


def test_op13_query(spark):
    texts = _texts(spark)
    want = dict(zip(texts, _brute_alignment(list(texts.values())), strict=True))
    rows = QUERIES["op13_alignment"](spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r.n_links for r in rows)
    for r in rows:
        n_a, n_b, n_groups, n_links, shown, n_best, total = want[r.doc_id]
        digest = shown and hashlib.sha256(shown.encode()).hexdigest()
        assert tuple(r)[1:] == (n_a, n_b, n_groups, n_links, n_best, total, digest)


def test_alignment_by_passes(spark, scratch, frame, monkeypatch):
    """Many chunks, merges in several passes, wide groups, links in pieces."""
    monkeypatch.setattr(alignment, "BLOCK", 7)
    texts = [*ODD_TEXTS, *[t for t in _texts(spark).values()][:60], "same words here"] * 2
    want = _brute_alignment(texts)
    docs = frame(texts).repartition(9, "doc_id")
    rows = alignment.align(docs, BYTES, PIECES, scratch, fan_in=2).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == want[r.doc.doc_id]


def test_wide_groups_and_pieces_of_links(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "_WIDE", 3)
    monkeypatch.setattr(alignment, "LINKS", 5)
    texts = [" " + t for t in ODD_TEXTS if t and "İ" not in t and "▁" not in t]
    (piece,) = alignment.slices(pa.array(texts))
    sides = []
    for encoder in (subwords.byte_level(BYTES, False), subwords.sentence_pieces(PIECES)):
        side = alignment._Side(piece, encoder, subwords.PieceTable(piece.data, piece.bounds, True))
        assert side.spelled.all()
        side.keep(side.spelled)
        sides.append(side)
    groups = alignment.Groups(*sides)
    found = Counter()
    for a, b, text, links in groups.records():
        for key, n in zip(zip(a.tolist(), b.tolist(), text.tolist(), strict=True), links.tolist(), strict=True):
            found[key] += n
    want = Counter()
    for g in range(len(groups.text)):
        for x in sides[0].ids[groups.of_a == g].tolist():
            for y in sides[1].ids[groups.of_b == g].tolist():
                want[x, y, int(groups.text[g])] += 1
    assert want and found == want


def test_merge_counts_and_maxima(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 3)
    rnd = random.Random(3)
    runs = [Counter(rnd.randrange(60) for _ in range(rnd.randrange(40))) for _ in range(9)]
    packed = []
    for run in runs:
        keys = np.array(sorted(run), dtype=np.int64)
        packed.append(alignment._zip_pairs(keys, np.array([run[k] for k in keys.tolist()], dtype=np.int64)))
    total = sum(runs, Counter())
    keys, counts, best = alignment.counted(packed, 8)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == total
    assert keys.tolist() == sorted(total)
    for k, n, b in zip(keys.tolist(), counts.tolist(), best.tolist(), strict=True):
        assert b == (n == max(total[j] for j in total if j // 8 == k // 8))


def test_alignment_of_odd_rows(scratch, odd, nothing):
    rows = alignment.align(odd, BYTES, PIECES, scratch).collect()
    want = _brute_alignment([r[1] for r in odd_rows()])
    assert Counter(tuple(r)[1:] for r in rows) == Counter(want)
    assert alignment.align(nothing, BYTES, PIECES, scratch).count() == 0


def test_rows_keep_their_columns(spark, scratch):
    docs = spark.createDataFrame([row(1, "a few words")], SCHEMA)
    for out in (periodic.collapse(docs), alignment.align(docs, BYTES, PIECES, scratch)):
        assert out.select("doc.*").columns == [c for c in docs.columns if c != "text"]
