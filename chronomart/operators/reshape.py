"""Wide snapshot -> one row per client and month -> monthly attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.functions import classify
from chronomart.functions.values import row_hash
from chronomart.operators import joins
from chronomart.sources import seeds
from chronomart.sources.seeds import Calendar, Month

# Measures of the snapshot: name in the long form -> column of ordinal i.
MEASURES = {"pay_code": "pay_{}", "bill_amount": "bill_amt{}", "payment_amount": "pay_amt{}"}
TRACKED = ("risk_tier", "limit_bal")
TYPE1 = ("age", "age_band")


def unpivot(
    wide: DataFrame,
    months: Sequence[Month],
    keep: Sequence[str],
    measures: dict[str, str] = MEASURES,
) -> DataFrame:
    """One row per input row and month, in a single pass over the input."""
    cells = [
        ", ".join([str(m.key), *[pattern.format(m.ordinal) for pattern in measures.values()]])
        for m in months
    ]
    names = ", ".join(["date_key", *measures])
    return wide.selectExpr(*keep, f"stack({len(months)}, {', '.join(cells)}) AS ({names})")


def resolve_codes(stg: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Replace sex, education and marriage codes by their surrogate keys.

    A client with an unknown code drops out, which the fact row count reports.
    """
    spark = spark or stg.sparkSession
    for dim, code, name in [
        (seeds.dim_sex(spark), "sex", "sex"),
        (seeds.dim_education(spark), "education", "education"),
        (seeds.dim_marriage(spark), "marriage", "marriage"),
    ]:
        stg = joins.lookup(stg, dim, code, f"{name}_code", f"{name}_key")
    return stg


def with_bands(months: DataFrame) -> DataFrame:
    return months.withColumns(
        {
            "age_band": classify.age_band("age"),
            "risk_tier": classify.risk_tier("pay_code", "bill_amount", "limit_bal"),
        }
    )


def with_hash(snapshot: DataFrame, tracked: Sequence[str] = TRACKED, charset: str = "UTF-8") -> DataFrame:
    return snapshot.withColumn("row_hash", row_hash(*[F.col(c) for c in tracked], charset=charset))


SNAPSHOT_KEYS = ["client_id", "limit_bal", "sex_key", "education_key", "marriage_key", "age"]


def snapshot(stg: DataFrame, calendar: Calendar, date_key: int | None = None) -> DataFrame:
    """Monthly client snapshot with band, tier and hash: all observed months, or one."""
    months = calendar.observed if date_key is None else [calendar.observed_month(date_key)]
    codes = {k: v for k, v in MEASURES.items() if k != "payment_amount"}
    long = unpivot(resolve_codes(stg), months, SNAPSHOT_KEYS, codes)
    return with_hash(with_bands(long)).select(
        "date_key", *SNAPSHOT_KEYS, "age_band", "risk_tier", "row_hash"
    )
