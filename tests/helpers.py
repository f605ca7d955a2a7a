"""Small inputs and a plain-Python account of what a monthly load does."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from chronomart import schemas
from chronomart.sources import staging

BATCH = "00000000-0000-0000-0000-00000000000a"


def client(client_id: int, pays=(0,) * 6, bills=(0,) * 6, paid=(0,) * 6, **attributes) -> dict:
    """A source row; the tuples run from the oldest month to the newest."""
    row = {
        "client_id": client_id,
        "limit_bal": Decimal("1000.00"),
        "sex": 1,
        "education": 1,
        "marriage": 1,
        "age": 35,
        "default": 0,
    }
    for i in range(1, 7):
        row[f"pay_{i}"] = pays[6 - i]
        row[f"bill_amt{i}"] = Decimal(bills[6 - i]).quantize(Decimal("0.01"))
        row[f"pay_amt{i}"] = Decimal(paid[6 - i]).quantize(Decimal("0.01"))
    return row | attributes


def source(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in schemas.SOURCE.names) for r in rows], schemas.SOURCE)


def staged(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return staging.stage(source(spark, rows), BATCH)


def month_by_month(snapshots: list[dict], calendar) -> list[tuple]:
    """Versions from loading the months one after the other.

    ``snapshots``: client_id, date_key, tier, limit, age.  Returns rows
    (client_id, version, tier, limit, age, valid_from, valid_to).
    """
    versions: dict[int, list[dict]] = {}
    for m in calendar.observed:
        for s in (s for s in snapshots if s["date_key"] == m.key):
            history = versions.setdefault(s["client_id"], [])
            current = history[-1] if history else None
            if current and (current["tier"], current["limit"]) == (s["tier"], s["limit"]):
                current["age"] = s["age"]
                continue
            if current:
                current["to"] = calendar.closing(m.key)
            history.append(
                {"tier": s["tier"], "limit": s["limit"], "age": s["age"], "from": m.key, "to": schemas.OPEN_END}
            )
    return sorted(
        (c, i, v["tier"], v["limit"], v["age"], v["from"], v["to"])
        for c, history in versions.items()
        for i, v in enumerate(history, start=1)
    )
