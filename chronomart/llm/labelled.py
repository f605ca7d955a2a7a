"""Labelled rows that a classifier may learn from: a bounded sample, by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A classifier is fitted on this many labelled rows at most, the first in order of a hash of their doc_id.
SAMPLE_ROWS = 20_000


def remainder(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def sample(labels: DataFrame, label: str, learnt: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of up to ``rows`` documents for which ``learnt`` holds; 1 if at least half of a document's labels say so."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learnt)
    one = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of a sample with their label; the sample is bounded, so it is broadcast."""
    return docs.join(F.broadcast(labels), "doc_id")
