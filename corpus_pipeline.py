"""A training corpus from `documents`: language, exact and near copies, source weights, packed sequences.

Every stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import exact_dedup, language_id, mixing, packing, simhash
from claimflow.llm.common import save


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as a language, in the language their text reads as; those without letters go.

    The label that came with a document is what the classifier learns from, and stays only where the classifier does not
    know it: without any labelled text there is nothing to learn from, and only texts without letters go. Nothing is
    measured on held-out documents here, so their labels are learned from as well.
    """
    model = language_id.fit(docs)
    classify = language_id.classifier(model, spark=spark)
    guessed = docs.withColumn("__guess", classify(F.col("text")))
    has_letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    known = F.when(F.col("__guess.lang_pred") != language_id.UNKNOWN, F.col("__guess.lang_pred"))
    learned = F.col("lang").isNull() | F.col("lang").isin(model.languages if model else [])
    lang = F.when(learned, F.coalesce(known, "lang")).otherwise(F.col("lang"))
    return guessed.where(has_letters).withColumn("lang", lang).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest doc_id; null counts as empty."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked: over three words, two bits differing at most."""
    return simhash.drop_near_copies(docs, words=simhash.SHINGLE_WORDS, budget=simhash.BUDGET)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks; null is a source of its own."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of several lengths."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The classifier, XXH64 fingerprints and seeded draws are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
