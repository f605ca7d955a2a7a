"""The pipeline's stages: (spark, docs, sf_dir) -> documents.

Each keeps the columns of its input but the last, which adds token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.llm import bpe, labelled, mixing, pii, simhash, toxicity
from chronomart.llm.common import fresh, table, word_count
from chronomart.llm.queries import PSEUDONYM_KEY, THRESHOLD, TOXIC_FOLDS, TOXIC_HELD_OUT, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject; learnt from the labelled ones among them."""
    fold = labelled.remainder(F.col("doc_id"), TOXIC_FOLDS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold != TOXIC_HELD_OUT)
    (score,) = fresh(docs, "toxicity")
    return toxicity.scored(docs, model, score).filter(F.col(score) < THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in the place of personal data; ``n_chars`` follows where it was the text's length."""
    (before,) = fresh(docs, "before")
    new = pii.pseudonymize(docs.withColumn(before, F.length("text")), PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_chars") == F.col(before), F.length("text")).otherwise(F.col("n_chars"))
        new = new.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return new.drop(before)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that their sources have the wanted shares of words.

    Columns of the documents that are named like the mixer's keep their values.
    """
    clashing = [c for c in docs.columns if c.lower() in mixing.COLUMNS]
    aside = dict(zip(clashing, fresh(docs, *(f"own_{c}" for c in clashing)), strict=True))
    kept = docs.withColumnsRenamed(aside)
    (words,) = fresh(kept, "words")
    counted = kept.withColumn(words, word_count(F.col("text")))
    mixed = mixing.repeat(mixing.mix(counted, F.col(words)), kept.columns)
    return mixed.withColumnsRenamed({new: old for old, new in aside.items()})


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return bpe.encode(docs, vocabulary())
