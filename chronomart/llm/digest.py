"""Quartile bucket digests: fingerprints of documents that compare by degree.

The bytes of a text are read as triplets (three from each window of four bytes),
hashed into 128 buckets and counted.  A digest holds for each bucket the quartile
its count falls into, the length on a logarithmic scale, and how the quartiles
relate.  Two digests differ by the steps between their quartiles (opposite ends
count double) and between their lengths and ratios; the difference is bounded at
what unrelated texts reach, which makes a likeness from 0 to 1.

``compare_neighbours`` fingerprints each document, an edited copy and its
successor in descending ``doc_id``.  Documents are dealt into ranges of ids of
limited size; the first row of a range is also sent to the range before, so that
every document meets its successor in one pass over sorted rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 128
#: Bytes of text in a range of ids, and the most ranges; beyond, ranges grow.
RANGE_BYTES = 8 << 20
MOST_RANGES = 100_000
#: Multipliers of the three bytes of a triplet, by the place of its last two in the window.
TRIPLETS = ((1, 2, 0x9E3779B1), (1, 3, 0x85EBCA77), (2, 3, 0xC2B2AE3D))
#: A length step is a tenth more; steps and ratios count up to these differences.
MOST_STEPS = 24
MOST_RATIO = 8
#: Unrelated texts: quartiles of 128 buckets differ by 1.625 on average.
BOUND = 208 + MOST_STEPS + 2 * MOST_RATIO


def digest(text: bytes) -> bytes:
    """34 bytes: length step, two quartile ratios, and 2 bits for each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) >= 4:
        for i, j, salt in TRIPLETS:
            last = len(b) - 3
            mixed = (b[:last] | b[i : i + last] << np.uint32(8) | b[j : j + last] << np.uint32(16)) * np.uint32(salt)
            counts += np.bincount((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(25), minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * i // 4 - 1]) for i in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    step = min(255, round(np.log(len(text)) / np.log(1.1))) if text else 0
    ratios = (min(15, 16 * q1 // q3), min(15, 16 * q2 // q3)) if q3 else (0, 0)
    return bytes([step, ratios[0] << 4 | ratios[1]]) + packed.astype(np.uint8).tobytes()


#: Steps between two bytes of four quartiles each.
_CODES = np.array([[byte >> s & 3 for s in (0, 2, 4, 6)] for byte in range(256)])
_APART = np.abs(_CODES[:, None, :] - _CODES[None, :, :])
STEPS = np.where(_APART == 3, 6, _APART).sum(axis=2).astype(np.int32)


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for digests as different as those of unrelated texts, or more."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    difference = int(STEPS[x[2:], y[2:]].sum())
    difference += min(MOST_STEPS, abs(a[0] - b[0]))
    difference += min(MOST_RATIO, abs((a[1] >> 4) - (b[1] >> 4))) + min(MOST_RATIO, abs((a[1] & 15) - (b[1] & 15)))
    return 1.0 - min(BOUND, difference) / BOUND


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many from the start of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, away, doc_id, text) in order; each row that is not away is compared with the one after it."""
    before = None
    for batch in batches:
        rows = []
        columns = (batch.column(i).to_pylist() for i in range(4))
        for part, away, doc_id, text in zip(*columns, strict=True):
            own = digest(text.encode())
            if before and before[0] == part and not before[1]:
                _, _, last_id, last_text, last = before
                changed = edited(last_text, text).encode()
                after = digest(changed)
                rows.append(
                    (last_id, len(last_text), hashlib.sha256(changed).hexdigest(), last.hex(), after.hex(),
                     likeness(last, after), likeness(last, own))
                )
            before = part, away, doc_id, text, own
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT)


def ranges(ids: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Upper bounds of ``parts`` ranges of ``at``, and for the first id of each range the range that precedes it.

    ``at`` is the doc_id, or the least one where that is null.  The driver holds
    two numbers per range.
    """
    cuts = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", F.lit(cuts), 10 * parts).alias("at")).first()["at"] if cuts else []
    bounds = np.unique(np.array(found or [], np.int64))
    firsts = ids.groupBy(part_of(bounds)("at").alias("part")).agg(F.max("doc_id").alias("first")).collect()
    order = sorted((r["part"], r["first"]) for r in firsts if r["first"] is not None)
    # The range after part k (its ids are smaller) is the one before it in order; the last is followed by the first.
    first = np.array([f for _, f in order], np.int64)
    precedes = np.array([order[(i + 1) % len(order)][0] for i in range(len(order))], np.int32)
    return bounds, first, precedes


# A batch with a null reaches pandas as float64, which rounds ids: both take numbers without nulls.


def part_of(bounds: np.ndarray):  # noqa: ANN201
    @F.pandas_udf("int")
    def part(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(np.int64)).astype(np.int32))

    return part


def parts_of(bounds: np.ndarray, first: np.ndarray, precedes: np.ndarray):  # noqa: ANN201
    @F.pandas_udf("array<int>")
    def parts(at: pd.Series, known: pd.Series) -> pd.Series:
        ids = at.to_numpy(np.int64)
        own = np.searchsorted(bounds, ids)
        place = np.minimum(np.searchsorted(first, ids), max(0, len(first) - 1))
        also = (first[place] == ids) & known.to_numpy(bool)
        return pd.Series([[o, p] if a else [o] for o, p, a in zip(own.tolist(), precedes[place].tolist(), also, strict=True)])

    return parts


def compare_neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The next document is the one with the next smaller doc_id, after the last the
    first; equal ids are ordered by text, null ids come last.  A null text is
    empty.  A single document is its own successor.  Equal texts have equal
    fingerprints; texts under four bytes have no triplets.
    """
    body: Column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("least")).first()
    if size["least"] is None:  # nothing to order by: at most rows without an id
        spread = rows.withColumn("part", F.lit(0)).withColumn("away", F.lit(0))
        spread = spread.union(spread.orderBy("text").limit(1).withColumn("away", F.lit(1)))
        parts = 1
    else:
        parts = int(min(MOST_RANGES, max(1, -(-size["bytes"] // RANGE_BYTES))))
        # Null ids come last, so they are in the range of the least id.
        at = F.coalesce("doc_id", F.lit(size["least"]).cast("long"))
        bounds, first, precedes = ranges(rows.select("doc_id", at.alias("at")), parts)
        lists = parts_of(bounds, first, precedes)(at, F.col("doc_id").isNotNull())
        spread = rows.select("doc_id", "text", F.posexplode(lists).alias("away", "part"))
    return (
        spread.select("part", "away", "doc_id", "text")
        .repartition(parts, "part")
        .sortWithinPartitions("part", "away", F.desc_nulls_last("doc_id"), "text")
        .mapInArrow(_neighbours, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    )
