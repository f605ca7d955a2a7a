"""Scalar helpers: null-safe text, row hashes, exact percentages, month keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# The change-detection hash joins tracked values with this
# separator and shows a missing value as this sentinel.
HASH_SEPARATOR = "|"
HASH_NULL = "~"


def text(*parts: Column | str) -> Column:
    """Concatenate, a missing part counting as the empty string."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(c, F.lit("")) for c in columns])


def row_hash(*tracked: Column, charset: str = "UTF-8") -> Column:
    """SHA-256 (32 bytes) of the tracked values.

    ``charset="UTF-16LE"`` hashes the same bytes as engines whose national
    character type is UTF-16.
    """
    values = [F.coalesce(c.cast("string"), F.lit(HASH_NULL)) for c in tracked]
    joined = F.concat_ws(HASH_SEPARATOR, *values)
    return F.unhex(F.sha2(F.encode(joined, charset), 256))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def quotient(numerator: Column, denominator: Column, scale: int, factor: int = 1) -> Column:
    """Ratio of two integer sums, rounded half up to ``scale`` places, NULL on zero.

    The division is carried out in ``decimal(38, 15)``, so the rounding never
    sees a value that was rounded to a tie before.
    """
    top = F.lit(factor).cast("decimal(4,0)") * numerator.cast("decimal(18,0)")
    bottom = F.nullif(denominator.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return (top / bottom).cast(f"decimal(18,{scale})")


def percentage(part: Column, whole: Column, scale: int) -> Column:
    return quotient(part, whole, scale, factor=100)


def month_date(month_key: Column) -> Column:
    """First day of the month behind a yyyymm key."""
    return F.to_date(month_key.cast("string"), "yyyyMM")


def utc_now() -> Column:
    """Audit timestamp with second precision."""
    return F.date_trunc("second", F.current_timestamp())


def new_batch_id() -> str:
    return str(uuid.uuid4())
