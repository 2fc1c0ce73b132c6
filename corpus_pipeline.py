"""The training-data pipeline: language, boilerplate lines, near-duplicates, mixing, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``docs``. Each result is written as Parquet and read as the next
stage's ``docs``. Null ids, sources and languages, null or empty texts, repeated rows, empty tables and
extra columns have the results that the operators' docstrings define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm import jaccard, langid, line_dedup, mixing, packing
from auditlake.llm.common import prepare, staged, table

TOKENIZER = "word_bpe_49k.json"
END_OF_TEXT = 49407
MIN_SCORE = 0.5
# No SQL can express the classifier, the packing or the tokenizer.
ORACLE_SQL = None


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns; ``n_chars``, where there is one, follows the text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with ``lang`` set to it.

    Texts that are null, have no letter or score under MIN_SCORE go, and those in none of the learned
    languages: their trigrams fit the predicted one far worse than its training texts do."""
    prepare(spark)
    trained = ~langid.held_out()
    model = langid.train(docs.where(trained))
    judged = langid.judged(docs, model, langid.bands(docs.where(trained), model), trained)
    told = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE) & F.col("fits"))
    kind = docs.schema["lang"].dataType
    return told.withColumn("lang", F.col("lang_pred").cast(kind)).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many sources and texts share; one of nothing else is empty."""
    prepare(spark)
    return _with_length(line_dedup.line_dedup(docs, everywhere=True), docs.columns)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    prepare(spark)
    return jaccard.one_per_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document comes once for each pass that takes it."""
    prepare(spark)
    return _with_length(mixing.mixed_documents(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in training sequences."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_OF_TEXT)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", duplicate_stage),
    ("source_mix", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
