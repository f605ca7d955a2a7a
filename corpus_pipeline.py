"""A training corpus from raw documents, stage by stage.

Each stage gets the documents that its predecessor kept and returns documents;
``run`` writes every stage's result to the shared folder and reads it back, so
that a lost executor costs no more than its part of one stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronomart.llm import stages
from chronomart.sources.storage import shared_folder

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("simhash_near_dedup", stages.drop_near_copies),
    ("pii", stages.pseudonymize),
    ("mix_sources", stages.mix_sources),
    ("byte_bpe", stages.encode),
]

#: SQL has neither the learned scores nor the keyed permutations of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
