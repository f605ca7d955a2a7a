"""Statistics of a text's form, for learned scores.

Counted on whole texts in Python workers (bytes and words of one text at a time,
no state between texts).  Shares of an empty text are 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import text_of

NAMES = (
    "words", "word_bytes", "longest_word", "upper", "digits", "marks", "bars", "shouts", "stops", "commas", "lines",
    "beyond_ascii", "distinct_words", "commonest_word", "repeated_words", "distinct_lines", "longest_line", "marked_words",
    "short_words", "capital_words",
)
UPPER, LOWER, DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
MARKS = np.frombuffer(b"#$%&*+<=>@\\^_`{}~", np.uint8)
ENDS = frozenset(b"#$%&*!|")


def statistics(text: bytes) -> list[float]:
    """One number for each of ``NAMES``."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    n, letters = len(words), max(1, int(counts[UPPER].sum() + counts[LOWER].sum()))
    often = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    sizes = list(map(len, words))
    return [
        float(n),
        sum(sizes) / n,
        float(max(sizes)),
        int(counts[UPPER].sum()) / letters,
        int(counts[DIGIT].sum()) / len(text),
        int(counts[MARKS].sum()) / n,
        int(counts[ord("|")]) / n,
        int(counts[ord("!")]) / n,
        int(counts[ord(".")]) / n,
        int(counts[ord(",")]) / n,
        len(lines) / n,
        int(counts[128:].sum()) / len(text),
        len(often) / n,
        max(often.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        max(map(len, lines)) / len(text),
        sum(w[-1] in ENDS for w in words) / n,
        sum(s <= 3 for s in sizes) / n,
        sum(65 <= w[0] <= 90 for w in words) / n,
    ]


def _with_statistics(text: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([statistics(t) for t in batch.column(text).cast(pa.binary()).to_pylist()]).reshape(-1, len(NAMES))
            columns = [pa.array(values[:, i]) for i in range(len(NAMES))]
            kept = [i for i in range(batch.num_columns) if i != text]
            names = [batch.schema.names[i] for i in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *columns], [*names, *NAMES])

    return run


def with_statistics(df: DataFrame, kept: list[str], text: str = "text") -> DataFrame:
    """Columns ``kept`` of ``df`` and the statistics of its texts; a null text counts as empty."""
    fields = [df.schema[c] for c in kept] + [T.StructField(n, T.DoubleType()) for n in NAMES]
    rows = df.select(*[F.col(c) for c in kept], text_of(text).alias("_text"))
    return rows.mapInArrow(_with_statistics(len(kept)), T.StructType(fields))
