"""One query per operator: the operator over its whole table, reduced to digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectstar.llm import (
    alignment,
    decontamination,
    fingerprints,
    jaccard,
    language,
    lm,
    mixing,
    periodic,
    personal,
    quality,
    repeats,
    tokenfiles,
    toxicity,
)
from inspectstar.llm.common import WORD, fold, table
from inspectstar.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(table(spark, sf_dir, "documents"), Scratch(spark))
    taken = F.col("size") * F.col("copies")
    return drawn.select(
        "doc.doc_id", "size", "source_size", "target", taken.alias("taken"), "copies"
    )


def op2_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = lm.score(docs, ~held_out, Scratch(spark))
    return scored.select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "perplexity",
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    rows = fingerprints.with_next(docs, Scratch(spark))
    n_chars = F.char_length("doc.text")
    cut = F.floor(n_chars / 4).cast("int")
    kept = F.substring(F.col("doc.text"), F.lit(1), n_chars - cut)
    edited = rows.withColumn(
        "edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), cut))
    )
    edited = edited.withColumn("edited_hashes", fingerprints.anchors(F.col("edited"))["hash"])
    return edited.select(
        "doc.doc_id",
        n_chars.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("hashes")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        fingerprints.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.remove_repeats(docs, Scratch(spark))
    kept = F.sha2(F.col("kept").cast("binary"), 256)
    return found.select("doc.doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op5_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.detect(docs, Scratch(spark))
    counts = [
        personal.count_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in personal.KINDS
    ]
    base = personal.named(F.col("base")).cast("binary")
    return found.select(
        "doc.doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        personal.named(F.col("spans")).alias("spans"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 5) == 0).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )


def _labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """(doc_id, label) of the rows to learn from."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    return labels.select("doc_id", F.col(label).alias("label")).where("label is not null")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark)
    described = scratch.keep(quality.describe(docs), "statistics")
    rows = described.select("doc.doc_id", "stats")
    labelled = rows.join(_labelled(spark, sf_dir, "quality"), "doc_id")
    model = quality.fit(labelled, scratch=scratch)
    return quality.score(described, model).select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _labelled(spark, sf_dir, "toxic")
    model = toxicity.fit(docs, labels, toxicity.letter_model(docs), Scratch(spark))
    return toxicity.score(docs, model).select(
        "doc.doc_id",
        (fold(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence",
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark)
    )
    return found.drop("text_key")


#: The end of a document in the token files.
END_ID = 2


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = Scratch(spark).path("token-files")
    tokenfiles.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    found = tokenfiles.read(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """The texts of which the query plants runs, by the crc32 of the id."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    chosen = docs.select("doc_id", "text", key.alias("key")).withColumn(
        "words", F.when(F.col("key") % 10 == 0, words)
    )
    n, g = F.size("words"), F.floor(F.col("key") / 10)
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    head = F.slice("words", F.lit(1), F.col("start"))
    block = F.slice("words", F.col("start") + 1, F.col("period"))
    times = F.ceil((n - F.col("start")) / F.col("period")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), n - F.col("start"))
    planted = F.col("key").isNotNull() & (F.size("words") > 0)
    numbered = chosen.withColumns(
        {"start": F.when(planted, start), "period": F.when(planted, period)}
    )
    text = F.when(planted, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return numbered.select("doc_id", text.alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _made_periodic(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.collapse(docs)
    best = periodic.strongest(F.col("runs"))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    found = found.withColumns({"best": best, "listed": F.array_join(lines, "")})
    return found.select(
        "doc.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        Scratch(spark),
        digest=True,
    )
    return found.select(
        "doc.doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_scores": op2_scores,
    "op3_fingerprints": op3_fingerprints,
    "op4_repeats": op4_repeats,
    "op5_personal": op5_personal,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_token_files": op11_token_files,
    "op12_runs": op12_runs,
    "op13_alignment": op13_alignment,
}
