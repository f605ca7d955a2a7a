"""What several text operators share: inputs, words, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.sources.storage import shared_folder

#: A word of a text, in Java's and Python's notation alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters that a Python worker turns to arrays at a time.
BLOCK_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that do not occur among the columns of ``df``, one for each wish."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as files in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def bucketed(df: DataFrame, buckets: int, *keys: str) -> DataFrame:
    """``df`` written once to the shared folder with equal keys together: grouping by ``keys`` needs no exchange."""
    spark = df.sparkSession
    name = f"cm_bucketed_{uuid.uuid4().hex[:16]}"
    writer = df.write.option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}")
    writer.bucketBy(buckets, *keys).format("parquet").saveAsTable(name)
    return spark.table(name)


def blocks(batches: Iterable[pa.RecordBatch], text: str, chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of ``batches`` with about ``chars`` bytes of text each; a longer text stands alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
