"""Personal data: candidate spans, boosted trees, calibrated thresholds. DataFrame only.

Generators propose spans of four kinds. The base patterns of a kind give its sure spans; looser
patterns propose more. There are two views of a candidate, and each is the other's teacher:
boosted trees over the context (neighbouring signs, keywords) learn from candidates whose
format passes or fails the kind's check (address parts, Luhn sum, number of digits, top
domain), and boosted trees over the format (length, grouping, signs, check) learn from
candidates whose keywords speak for or against the kind. So no label is computed from a feature
that its trees see. A number inside a longer word is no proposal. All features are small
classes, so the trees learn from a table of feature combinations, counted over all texts, whose
size does not depend on the corpus. Per view and kind, the lowest score whose labelled rows
from there on are right at the rate ``PRECISION`` is the threshold; proposals above both that
touch no base span are added. A view without a labelled row of a kind does not vote on it.

Positions are code points, end exclusive. Matching takes time in proportion to a text's
length: patterns use possessive quantifiers and start only where a run of signs starts.
Spans are compared in one sweep over their order, and texts are cut by blocks, so many
spans in a long text cost little more than each of them alone.

Defined results: null and empty texts have no spans; within a kind matches do not
overlap, of different kinds they may; a kind without labelled rows gets no added spans;
equal texts have equal spans; repeated rows count each time. Further columns, whatever their
names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspectstar.llm.common import let, unwrapped, wrapped
from inspectstar.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
TREES, DEPTH = 12, 3
SEED = 11

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# Each is the kind's pattern, written so that no text can make matching slow or deep: \G is
# the end of the match before, the only other place where a run of signs can start.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# How @ and the dots of an address are written out in the corpus' languages.
_AT_WORD, _DOT_WORD = "(?:at|arobase|arroba|klammeraffe)", "(?:dot|point|punkt|punto)"
_AT = rf"[\x20]?(?:\({_AT_WORD}\)|\[{_AT_WORD}\]|\{{{_AT_WORD}\}})[\x20]?"
_SPELLED_DOT = (
    rf"(?:[\x20]?(?:\({_DOT_WORD}\)|\[{_DOT_WORD}\]|\{{{_DOT_WORD}\}})[\x20]?|[\x20]{_DOT_WORD}[\x20])"
)
_DOT = rf"(?:\.|{_SPELLED_DOT})"
_BETWEEN = r"[\x20 ‐-–()./_-]{0,3}+"
_DATE = r"[0-9]{2}[./-][0-9]{2}[./-][0-9]{4}(?![0-9])"
#: Proposals beyond the base patterns. A bare word for @ needs a word for a dot after it.
LOOSE = {
    "email": rf"(?i)(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:{_AT}{_HOST}++(?:{_DOT}{_HOST}++)++"
    rf"|[\x20]{_AT_WORD}[\x20]{_HOST}++{_SPELLED_DOT}{_HOST}++(?:{_DOT}{_HOST}++)*+)",
    "ip": r"(?<![0-9A-Za-z])[0-9]{1,3}+(?:[\x20]?\.[\x20]?[0-9]{1,3}+){3}(?![0-9A-Za-z])",
    # 12 to 19 digits, 8 to 15 with a leading 0 or bracket; dates and decimals are no phones.
    "card": rf"(?<![0-9A-Za-z])[0-9](?:{_BETWEEN}[0-9]){{11,18}}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
    rf"|(?<![0-9A-Za-z+])(?<![0-9][./-])(?:(?!0[.,]|{_DATE})0(?:{_BETWEEN}[0-9]){{7,14}}+"
    rf"|\([0-9]{{2,5}}+\)(?:{_BETWEEN}[0-9]){{5,10}}+)(?![0-9A-Za-z])",
}
#: Of a sign that any match of the generator needs; others are not searched.
NEEDED = {
    "email": rf"(?i)[@(\[{{]|[\x20]{_AT_WORD}[\x20]",
    "ip": r"[0-9]",
    "card": r"[0-9]",
    "phone": r"[0-9]",
}
# Words before a span that speak of its kind, and words that speak against.
FOR = r"(?i)(mail|contact|tel|phone|call|fax|mobile|card|visa|pay|host|server|ip|addr)[a-z]*\W*$"
AGAINST = r"(?i)(version|release|id|token|key|hash|order|no|nr|isbn|serial|license|section)\W*$"
_TOP_DOMAIN = r"(?i)(?:\.|[)\]} ])[a-z]{2,24}$"
_CHUNK = 256  # array entries
_BLOCK = 1024  # code points
_LOWEST = -(2**31) + 1

#: The two views; the kind belongs to both.
FORMAT = ("kind", "digits", "groups", "sign", "checked")
CONTEXT = ("kind", "before", "after", "speaks")
FEATURES = (*FORMAT, *CONTEXT[1:])


def _running(values: Column, join: Callable[[Column, Column], Column], base: int) -> Column:
    """For each entry what ``join`` makes of ``base`` and the entries before it.

    In chunks, to keep copying small.
    """

    def joined(part: Column, first: Column) -> Column:
        start = F.struct(first.cast("int").alias("sum"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(
            part,
            start,
            lambda acc, x: F.struct(
                join(acc["sum"], x).alias("sum"), F.array_append(acc["all"], acc["sum"]).alias("all")
            ),
            lambda acc: acc["all"],
        )

    def chunked(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(_CHUNK))
        chunks = F.transform(places, lambda at: F.slice(whole, at + 1, _CHUNK))
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(base), join))
        return F.flatten(F.zip_with(chunks, joined(totals, F.lit(base)), joined))

    return let(values, chunked)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _furthest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _located(text: Column, pattern: str, needed: str) -> Column:
    """array<struct<start, end, value, before, after>> of the matches of ``pattern``."""
    empty = F.array().cast(
        "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    )

    def locate(found: Column) -> Column:
        gaps, values = found["gaps"], found["values"]
        lengths = F.transform(
            values, lambda v, i: F.char_length(F.get(gaps, i)) + F.char_length(v)
        )

        def span(value: Column, i: Column, before: Column) -> Column:
            gap = F.get(gaps, i)
            start = before + F.char_length(gap)
            # What follows is the next gap, or the next match if there is none between.
            return F.struct(
                start.alias("start"),
                (start + F.char_length(value)).alias("end"),
                value.alias("value"),
                F.right(gap, F.lit(24)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(2)).alias("after"),
            )

        return let(
            _running(lengths, _add, 0),
            lambda sums: F.transform(values, lambda v, i: span(v, i, F.get(sums, i))),
        )

    def search(t: Column) -> Column:
        values = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return let(
            values,
            lambda v: F.when(F.size(v) == 0, empty).otherwise(
                let(F.struct(F.split(t, pattern, -1).alias("gaps"), v.alias("values")), locate)
            ),
        )

    return F.when(text.rlike(needed), search(text)).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern is sure."""
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False)))
    if kind == "card":
        return let(
            _digits(value),
            lambda d: F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False),
        )
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _checked(kind: str, value: Column) -> Column:
    """Whether a candidate of any form has the format of its kind."""
    if kind == "ip":
        return _passes(kind, F.replace(value, F.lit(" "), F.lit("")))
    return value.rlike(_TOP_DOMAIN) if kind == "email" else _passes(kind, value)


def _features(kind: str, span: Column) -> list[Column]:
    """The classes of a candidate; none of them takes more than a few values."""
    value, before, after = span["value"], span["before"], span["after"]
    digits = _digits(value)
    groups = F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)))
    sides = [
        F.when(side == "", 0)
        .when(side.rlike(pattern.format(r"\s")), 1)
        .when(side.rlike(pattern.format("[A-Za-z0-9]")), 2)
        .otherwise(3)
        for side, pattern in ((before, "{}$"), (after, "^{}"))
    ]
    checked = _checked(kind, value).cast("int")
    return [
        F.lit(KINDS.index(kind)).alias("kind"),
        F.least(F.length(digits), F.lit(20)).alias("digits"),
        F.least(groups, F.lit(6)).alias("groups"),
        F.when(value.contains("("), 3)
        .when(value.contains("-"), 2)
        .when(value.contains(" "), 1)
        .otherwise(0)
        .alias("sign"),
        sides[0].alias("before"),
        sides[1].alias("after"),
        F.when(before.rlike(FOR), 1).when(before.rlike(AGAINST), 2).otherwise(0).alias("speaks"),
        checked.alias("checked"),
    ]


def _candidates(kind: str, text: Column, loose: bool) -> Column:
    """array<struct<start, end, rank, sure, proposal, form, told, features>> of one generator.

    form: whether the check of the kind passes, null for proposals, whose form is not the
    base one; told: what the keywords say, null if nothing.
    """
    pattern = LOOSE[kind] if loose else BASE[kind]
    located = _located(text, pattern, NEEDED[kind])

    def described(span: Column) -> Column:
        sure = F.lit(False) if loose else _passes(kind, span["value"])
        inside = span["before"].rlike("[A-Za-z0-9]$") | span["after"].rlike("^[A-Za-z0-9]")
        inside &= (F.length(_digits(span["value"])) > 0) & F.lit(kind != "email")
        features = F.struct(*_features(kind, span))
        told = F.when(features["speaks"] == 2, 0).when(features["speaks"] == 1, 1)
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("rank"),
            sure.alias("sure"),
            (F.lit(loose) & ~inside).alias("proposal"),
            F.when(F.lit(not loose), features["checked"]).alias("form"),
            told.cast("int").alias("told"),
            features.alias("features"),
        )

    return F.transform(located, described)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc, base, proposed): the rows of ``docs`` with sure spans and with all candidates."""
    text = F.col("doc.text")
    found = [_candidates(kind, text, loose) for kind in KINDS for loose in (False, True)]
    rows = wrapped(docs).withColumn("proposed", F.concat(*found))
    sure = F.filter(F.col("proposed"), lambda c: c["sure"])
    spans = F.transform(sure, lambda c: F.struct(c["start"], c["rank"], c["end"]))
    return rows.withColumn("base", F.array_sort(spans))


@dataclass
class PersonalModel:
    #: Feature combinations whose proposals are taken; as many as feature classes at most.
    accepted: list[str]
    #: Feature combinations with the score of each view.
    cells: DataFrame
    #: The weight of each feature in the trees of its view.
    weights: dict[str, float] = field(default_factory=dict)


def _key(features: Column) -> Column:
    return F.concat_ws(".", *[features[name].cast("string") for name in FEATURES])


def _viewed(
    cells: DataFrame, view: tuple[str, ...], label: str, precision: float
) -> tuple[DataFrame, dict[str, float]]:
    """``cells`` with ``score_<label>`` and ``passes_<label>`` (null: no vote), and weights.

    Learns from the counts ``n_<label>`` of labelled rows and ``hits_<label>`` among them.
    """
    n, hits, score = f"n_{label}", f"hits_{label}", f"score_{label}"
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col(hits).cast("double").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (F.col(n) - F.col(hits)).cast("double").alias("weight")),
            )
        ).alias("side"),
        *view,
    )
    # One row for each combination of this view's classes.
    sides = sides.groupBy(F.col("side.label").alias("label"), *view).agg(
        F.sum("side.weight").alias("weight")
    )
    sides = sides.where("weight > 0").orderBy("label", *view)
    weights = {}
    if sides.agg(F.count_distinct("label")).first()[0] < 2:
        scored = cells.withColumn(score, F.lit(0.5))
    else:
        inputs = VectorAssembler(inputCols=list(view), outputCol="inputs")
        trees = GBTClassifier(
            featuresCol="inputs", labelCol="label", weightCol="weight", maxIter=TREES,
            maxDepth=DEPTH, maxBins=64, seed=SEED,
        ).fit(inputs.transform(sides).coalesce(1))
        weights = dict(zip(view, trees.featureImportances.toArray().tolist(), strict=True))
        scored = trees.transform(inputs.transform(cells)).select(
            *cells.columns, F.round(vector_to_array("probability")[1], 9).alias(score)
        )
    # Calibration: from the highest score down, the rate of hits among labelled rows.
    kind = Window.partitionBy("kind")
    above = kind.orderBy(F.col(score).desc())
    # Null while none is labelled.
    rate = F.try_divide(F.sum(hits).over(above), F.sum(n).over(above))
    rated = scored.withColumn("rate", rate)
    least = F.min(F.when((F.col("rate") >= precision) & (F.col(n) > 0), F.col(score))).over(kind)
    votes = F.sum(n).over(kind) > 0
    passes = F.when(votes, F.coalesce(F.col(score) >= least, F.lit(False)))
    return rated.withColumn(f"passes_{label}", passes).drop("rate"), weights


def fit(found: DataFrame, scratch: Scratch, precision: float = PRECISION) -> PersonalModel:
    """Learns from the rows of ``candidates`` which proposals to take."""
    exploded = found.select(F.explode("proposed").alias("c")).select(
        "c.proposal", "c.form", "c.told", "c.features.*"
    )
    cells = exploded.groupBy(*FEATURES).agg(
        F.count(F.when(F.col("proposal"), 1)).alias("seen"),
        *[
            counted.alias(f"{name}_{label}")
            for label in ("form", "told")
            for name, counted in (
                ("n", F.count(label)), ("hits", F.coalesce(F.sum(label), F.lit(0)))
            )
        ],
    )
    cells = scratch.keep(cells, "feature-cells")
    weights: dict[str, float] = {}
    for view, label in ((CONTEXT, "form"), (FORMAT, "told")):
        cells, learned = _viewed(cells, view, label, precision)
        weights |= {f"{label}: {name}": weight for name, weight in learned.items()}
    cells = scratch.keep(cells, "scored-cells")
    votes = F.array_compact(F.array("passes_form", "passes_told"))
    taken = cells.where((F.col("seen") > 0) & (F.size(votes) > 0) & F.forall(votes, lambda v: v))
    keys = taken.select(_key(F.struct(*FEATURES)).alias("key")).collect()
    return PersonalModel(sorted(r.key for r in keys), cells, weights)


def _clear(asked: Column, taken: Column) -> Column:
    """The spans of ``asked`` that overlap none of ``taken``, in one sweep in order of start."""

    def events(found: Column, asks: int) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(s["start"], F.lit(asks).alias("asks"), s["rank"], s["end"]),
        )

    def sweep(every: Column) -> Column:
        ends = F.transform(every, lambda s: F.when(s["asks"] == 0, s["end"]).otherwise(_LOWEST))
        starts = F.transform(
            F.reverse(every), lambda s: F.when(s["asks"] == 0, -s["start"]).otherwise(_LOWEST)
        )
        # The furthest end before each event and the nearest start behind it.
        sides = F.zip_with(
            _running(ends, _furthest, _LOWEST),
            F.reverse(_running(starts, _furthest, _LOWEST)),
            lambda left, right: F.struct(left.alias("left"), right.alias("right")),
        )
        judged = F.zip_with(
            every,
            sides,
            lambda s, side: F.struct(
                s.alias("span"),
                (
                    (s["asks"] == 1) & (side["left"] <= s["start"]) & (side["right"] <= -s["end"])
                ).alias("free"),
            ),
        )
        return F.transform(
            F.filter(judged, lambda j: j["free"]),
            lambda j: F.struct(j["span"]["start"], j["span"]["rank"], j["span"]["end"]),
        )

    return F.when(F.size(asked) == 0, asked).otherwise(
        let(F.array_sort(F.concat(events(asked, 1), events(taken, 0))), sweep)
    )


def spans(found: DataFrame, model: PersonalModel) -> DataFrame:
    """(doc, base, spans): sure spans, and all spans, sorted by start, kind and end.

    Entries are struct<start, rank, end>; rank is the position in ``KINDS``. An added span
    overlaps neither a base span nor an added one of a kind listed before.
    """
    taken = F.array(*[F.lit(key) for key in model.accepted]).cast("array<string>")
    if not model.accepted:
        return found.select("doc", "base", F.col("base").alias("spans"))
    asked = F.transform(
        F.filter(
            F.col("proposed"), lambda c: c["proposal"] & F.array_contains(taken, _key(c["features"]))
        ),
        lambda c: F.struct(c["start"], c["rank"], c["end"]),
    )
    rows = found.select("doc", "base", asked.alias("asked"))
    rows = rows.select("doc", "base", _clear(F.col("asked"), F.col("base")).alias("added"))

    def of(test: Callable[[Column], Column]) -> Column:
        return F.filter(F.col("added"), lambda s: test(s["rank"]))

    apart = [of(lambda rank: rank == 0)]
    for kind in range(1, len(KINDS)):
        apart.append(
            _clear(of(lambda rank, k=kind: rank == k), of(lambda rank, k=kind: rank < k))
        )
    every = F.array_sort(F.concat("base", *apart))
    return rows.select(
        "doc", "base", F.when(F.size("added") == 0, F.col("base")).otherwise(every).alias("spans")
    )


def count_kind(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter(found, lambda s: s["rank"] == rank)).cast("long")


def named(found: Column) -> Column:
    """The spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])
        ),
        ",",
    )


def detect(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, base, spans) of every row of ``docs``, learned from these rows themselves."""
    found = candidates(docs)
    return spans(found, fit(found, scratch))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with each stretch that spans cover replaced by the kind of its first span.

    ``found`` in order of start.
    """
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def cut(blocks: Column, low: Column, high: Column) -> Column:
        """Code points ``low`` to ``high``: two parts of blocks and whole ones between."""
        first, last = F.floor(low / _BLOCK).cast("int"), F.floor(high / _BLOCK).cast("int")
        head = F.coalesce(F.get(blocks, first), F.lit(""))
        tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), high % _BLOCK)
        whole = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        after = F.substring(head, low % _BLOCK + 1, F.lit(_BLOCK))
        return F.when(
            first == last, F.substring(head, low % _BLOCK + 1, high - low)
        ).otherwise(F.concat(after, whole, tail))

    def rewritten(parts: Column) -> Column:
        stretches = F.filter(
            F.zip_with(
                parts["found"],
                _running(F.transform(parts["found"], lambda s: s["end"]), _furthest, 0),
                lambda s, reach: F.struct(s.alias("span"), reach.alias("reach")),
            ),
            lambda s: s["span"]["start"] >= s["reach"],
        )
        pieces = F.transform(
            stretches,
            lambda s: F.concat(
                cut(parts["blocks"], s["reach"], s["span"]["start"]),
                F.get(kinds, s["span"]["rank"]),
            ),
        )
        furthest = F.array_max(F.transform(parts["found"], lambda s: s["end"]))
        return F.concat(
            F.array_join(pieces, ""), cut(parts["blocks"], furthest, parts["size"])
        )

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    parts = F.struct(
        blocks.alias("blocks"), found.alias("found"), F.char_length(text).alias("size")
    )
    return F.when(F.size(found) == 0, text).otherwise(let(parts, rewritten))


def redact(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` with personal data in ``text`` replaced by its kind."""
    found = detect(docs, scratch)
    text = redacted(F.col("doc.text"), F.col("spans"))
    return unwrapped(found.withColumn("doc", F.col("doc").withField("text", text)))
