"""From raw documents to a training mixture: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns and reads it again as the documents of the next. All stages but the last keep the
columns of ``documents``; the mixture repeats rows.

language          drops texts without a determined language: null, empty, without a letter,
                  or with two codewords equally near. If no row has a language to learn
                  from, nothing is dropped.
near_duplicates   keeps one row, the one with the smallest doc_id, of each group of texts
                  whose five-word shingles have a Jaccard similarity of 0.8 or more.
decontamination   drops texts that contain a passage of ``benchmark``, also with other
                  numbers, units or names.
personal          replaces personal data by its kind; ``n_chars`` follows the new text.
mixing            repeats or leaves out rows so that sources meet their target weights.

Empty documents give an empty result; null sources are a source; further columns, whatever
their names, are carried along. SQL cannot express the learned stages, so there is no
ORACLE_SQL; the tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectstar.llm import decontamination, jaccard, mixing, personal
from inspectstar.llm import language as languages
from inspectstar.llm.common import table
from inspectstar.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = languages.fit(docs)
    if not model.languages:
        return docs
    return languages.identify(docs, model).where("not ambiguous").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs, Scratch(spark))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), Scratch(spark))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal.redact(docs, Scratch(spark))
    if "n_chars" not in clean.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    n_chars = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, Scratch(spark))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal", redacted),
    ("mixing", mixed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
