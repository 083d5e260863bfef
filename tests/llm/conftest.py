from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use for columns of their own.
    "doc string, tag string, chunk string, size string, copies string, part string, "
    "hash string, text_key string, label string, score string, `head id` string"
)
EXTRA = ("x",) * 11


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


WORDS = "amber birch cedar dune ember fjord glade heath inlet jetty knoll larch mesa notch oasis".split()


def prose(seed, n):
    """n words, hardly any five in a row twice."""
    state, out = seed + 1, []
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(state >> 33) % len(WORDS)] + str((state >> 50) % 97))
    return " ".join(out)


def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated texts."""
    long = prose(1, 30_000)
    return [
        (None,) * 16,
        row(None, "no id here"),
        row(1, None, None, None),
        row(2, ""),
        row(3, " \t\n "),
        row(4, long),
        row(5, long, source="b"),
        row(6, "tiny", None),
        row(6, "tiny", None),
        row(7, "!?!"),
        row(8, "é ü 東京 \U0001f600 x y"),
        row(-9, "x" * 50_000, source=None),
    ]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def frame(spark):
    def build(texts, **columns):
        rows = [
            row(i, t, **{k: v[i] for k, v in columns.items()}) for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return build
