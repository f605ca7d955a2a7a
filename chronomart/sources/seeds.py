"""Calendar, code dimensions and the quality-rule registry.

All of them are constants of at most twelve rows (the calendar: one row per
month), built as inline ``VALUES``.  Their size is fixed by this module, so the
dimensions carry a broadcast hint wherever they are joined.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart import schemas

# Code dimensions.  (key, code, description[, documented])
SEX = [(1, 1, "男"), (2, 2, "女")]

EDUCATION = [
    (1, 1, "研究所", True),
    (2, 2, "大學", True),
    (3, 3, "高中", True),
    (4, 4, "其他", True),
    (5, 0, "未定義碼值 0", False),
    (6, 5, "未定義碼值 5", False),
    (7, 6, "未定義碼值 6", False),
]

MARRIAGE = [
    (1, 1, "已婚", True),
    (2, 2, "單身", True),
    (3, 3, "其他", True),
    (4, 0, "未定義碼值 0", False),
]

# Fixed values: (key, code, documented meaning, common reading, delinquent, months late)
PAYMENT_STATUS = [
    (1, -2, None, "當期無消費（推論）", False, None),
    (2, -1, "按時繳款", "按時繳清", False, None),
    (3, 0, None, "使用循環信用（推論）", False, None),
    (4, 1, "延遲 1 個月", "延遲 1 個月", True, 1),
    (5, 2, "延遲 2 個月", "延遲 2 個月", True, 2),
    (6, 3, "延遲 3 個月", "延遲 3 個月", True, 3),
    (7, 4, "延遲 4 個月", "延遲 4 個月", True, 4),
    (8, 5, "延遲 5 個月", "延遲 5 個月", True, 5),
    (9, 6, "延遲 6 個月", "延遲 6 個月", True, 6),
    (10, 7, "延遲 7 個月", "延遲 7 個月", True, 7),
    (11, 8, "延遲 8 個月", "延遲 8 個月", True, 8),
    (12, 9, "延遲 9 個月以上", "延遲 9 個月以上", True, 9),
]

# Fixed values: (rule id, code, target, severity, description)
QUALITY_RULES = [
    (1, "STG_ROWCOUNT", "stg.credit_clients", "ERROR",
     "暫存區載入筆數需等於來源筆數，落差代表擷取階段掉資料"),
    (2, "STG_PK_UNIQUE", "stg.credit_clients", "ERROR", "client_id 在單一批次內必須唯一"),
    (3, "DIM_EDU_UNDOCUMENTED", "dw.dim_customer", "WARN",
     "教育程度落在官方文件未定義的碼值（0/5/6）"),
    (4, "DIM_MAR_UNDOCUMENTED", "dw.dim_customer", "WARN",
     "婚姻狀況落在官方文件未定義的碼值（0）"),
    (5, "FACT_GRAIN", "dw.fact_monthly_statement", "ERROR",
     "事實表粒度必須為「客戶×月份」唯一，重複即為 ETL 重跑造成的重複載入"),
    (6, "FACT_ORPHAN_FK", "dw.fact_monthly_statement", "ERROR",
     "事實列的 customer_sk 必須存在於維度表（孤兒鍵）"),
    (7, "FACT_ROWCOUNT", "dw.fact_monthly_statement", "ERROR",
     "事實筆數需等於 客戶數 × 月份數，落差代表攤平階段掉列"),
    (8, "SCD2_NO_OVERLAP", "dw.dim_customer", "ERROR",
     "同一客戶的版本有效期間不得重疊，重疊會讓事實表關聯到兩個版本"),
    (9, "SCD2_ONE_CURRENT", "dw.dim_customer", "ERROR", "同一客戶恰有一筆 is_current=1"),
    (10, "FACT_NEG_PAYMENT", "dw.fact_monthly_statement", "WARN",
     "繳款金額為負；來源確實存在，多為退款或調整，保留但標記"),
    (11, "FACT_BILL_OVER_LIMIT", "dw.fact_monthly_statement", "WARN",
     "帳單金額超過信用額度；可能為超額動用或額度調降，需業務確認"),
    (12, "OUTCOME_COVERAGE", "dw.fact_default_outcome", "ERROR", "每位客戶都應有一筆違約結果"),
]

# Fixed value: the oldest observed month; the outcome month follows the newest.
FIRST_MONTH = 200504


class UnknownPeriod(ValueError):
    """A month key that the calendar does not hold."""


@dataclass(frozen=True)
class Month:
    key: int
    ordinal: int  # 1 = newest observed month; the outcome month has the highest

    @property
    def year(self) -> int:
        return self.key // 100

    @property
    def month(self) -> int:
        return self.key % 100

    @property
    def end(self) -> date:
        following = date(self.year + self.month // 12, self.month % 12 + 1, 1)
        return following - timedelta(days=1)

    def row(self) -> tuple:
        return (
            self.key,
            self.year,
            self.month,
            f"{self.year}年{self.month}月",
            (self.month + 2) // 3,
            self.end,
            self.ordinal,
        )


class Calendar:
    """The known months.  Small and known when a plan is made, so plain Python."""

    def __init__(self, months: Iterable[Month], observed: int = schemas.MONTHS):
        self.months = sorted(months, key=lambda m: m.key)
        self.keys = [m.key for m in self.months]
        # oldest first: month order is a correctness condition of Type 2 loads
        self.observed = [m for m in self.months if 1 <= m.ordinal <= observed]
        self.outcome = next((m for m in self.months if m.ordinal == observed + 1), None)

    @classmethod
    def starting(cls, first: int = FIRST_MONTH, observed: int = schemas.MONTHS) -> Calendar:
        """``observed`` consecutive months plus the outcome month."""
        start = first // 100 * 12 + first % 100 - 1
        keys = [(n // 12) * 100 + n % 12 + 1 for n in range(start, start + observed + 1)]
        ordinals = [*range(observed, 0, -1), observed + 1]
        return cls([Month(k, o) for k, o in zip(keys, ordinals)], observed)

    def month(self, key: int) -> Month:
        for m in self.months:
            if m.key == key:
                return m
        raise UnknownPeriod(f"date_key {key} is not in the calendar")

    def observed_month(self, key: int) -> Month:
        month = self.month(key)
        if month not in self.observed:
            raise UnknownPeriod(f"date_key {key} is not an observed month")
        return month

    def previous(self, key: int) -> int | None:
        """Latest month before ``key``; taken from the calendar, not by arithmetic."""
        return max((k for k in self.keys if k < key), default=None)

    def closing(self, key: int) -> int:
        """Last valid month of a version that a change in month ``key`` ends."""
        previous = self.previous(key)
        return key if previous is None else previous


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def inline_table(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A constant table as a local relation with the declared types, broadcast in joins."""
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    names = ", ".join(schema.names)
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    return F.broadcast(spark.sql(f"SELECT {casts} FROM VALUES {values} AS seed({names})"))


@lru_cache(maxsize=8)
def dim_date(spark: SparkSession, calendar: Calendar | None = None) -> DataFrame:
    months = (calendar or Calendar.starting()).months
    return inline_table(spark, schemas.DIM_DATE, [m.row() for m in months])


@lru_cache(maxsize=8)
def dim_sex(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.DIM_SEX, SEX)


@lru_cache(maxsize=8)
def dim_education(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.DIM_EDUCATION, EDUCATION)


@lru_cache(maxsize=8)
def dim_marriage(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.DIM_MARRIAGE, MARRIAGE)


@lru_cache(maxsize=8)
def dim_payment_status(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.DIM_PAYMENT_STATUS, PAYMENT_STATUS)


@lru_cache(maxsize=8)
def quality_rule(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.QUALITY_RULE, QUALITY_RULES)


def all_seeds(spark: SparkSession, calendar: Calendar | None = None) -> dict[str, DataFrame]:
    return {
        "dim_date": dim_date(spark, calendar),
        "dim_sex": dim_sex(spark),
        "dim_education": dim_education(spark),
        "dim_marriage": dim_marriage(spark),
        "dim_payment_status": dim_payment_status(spark),
        "quality_rule": quality_rule(spark),
    }
