"""Bands, tiers and verdicts as Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds that results must reproduce.
AGE_BANDS = [(30, "20-29"), (40, "30-39"), (50, "40-49"), (60, "50-59")]
AGE_BAND_LAST = "60+"
TIERS = ["LOW", "MEDIUM", "HIGH"]
HIGH_FROM_CODE = 2
MEDIUM_CODE = 1
MEDIUM_ABOVE_USE = Decimal("0.90")
USE_BANDS = [
    (Decimal("0.1"), "0-10%"),
    (Decimal("0.3"), "10-30%"),
    (Decimal("0.6"), "30-60%"),
    (Decimal("0.9"), "60-90%"),
]
USE_BAND_LAST = "90%+"
USE_BAND_NO_LIMIT = "無額度"


def _banded(bands: list[tuple], last: str, below: str) -> str:
    cases = " ".join(f"WHEN {below.format(upper=upper)} THEN '{label}'" for upper, label in bands)
    return f"{cases} ELSE '{last}'"


def age_band(age: str) -> Column:
    """Ten-year band of a column; an unknown age lands in the last band."""
    return F.expr(f"CASE {_banded(AGE_BANDS, AGE_BAND_LAST, age + ' < {upper}')} END")


def risk_tier_sql(pay_code: str, bill: str, limit: str) -> str:
    """HIGH / MEDIUM / LOW from the month's payment code and credit use.

    Use is compared as ``bill > limit * 0.90``, which is exact in decimals and
    needs no division.
    """
    overused = f"{limit} > 0 AND {bill} > {limit} * {MEDIUM_ABOVE_USE}"
    return (
        f"CASE WHEN {pay_code} >= {HIGH_FROM_CODE} THEN 'HIGH' "
        f"WHEN {pay_code} = {MEDIUM_CODE} OR ({overused}) THEN 'MEDIUM' ELSE 'LOW' END"
    )


def risk_tier(pay_code: str, bill: str, limit: str) -> Column:
    return F.expr(risk_tier_sql(pay_code, bill, limit))


def use_band(total_bill: str, total_limit: str) -> Column:
    """Band of ``total_bill / total_limit``, compared by cross-multiplying."""
    bill = f"IF({total_limit} < 0, -{total_bill}, {total_bill})"
    below = f"{bill} < abs({total_limit}) * {{upper}}"
    return F.expr(
        f"CASE WHEN {total_limit} = 0 THEN '{USE_BAND_NO_LIMIT}' "
        f"{_banded(USE_BANDS, USE_BAND_LAST, below)} END"
    )


def use_band_order(band: Column) -> Column:
    """Business order of the use bands; the no-limit band comes last."""
    return ranked(band, [label for _, label in USE_BANDS] + [USE_BAND_LAST])


def ranked(value: Column, order: list[str]) -> Column:
    """1-based position of ``value`` in ``order``; anything else comes after."""
    position = F.array_position(F.lit(order), value)
    return F.when(position > 0, position).otherwise(len(order) + 1).cast("int")


def verdict(severity: Column, rows_failed: Column) -> Column:
    """PASS without failures, FAIL for ERROR rules, WARN for all others."""
    return (
        F.when(rows_failed == 0, "PASS").when(severity == "ERROR", "FAIL").otherwise("WARN")
    )
