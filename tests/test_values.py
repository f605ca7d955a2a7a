import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chronomart.functions import classify, values
from chronomart.sources import seeds


def column(spark, expr, **given):
    """Value of a Column expression over one row of literals."""
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()])
    return frame.select(expr).first()[0]


def rows(spark, ddl, data, expr):
    return [r[0] for r in spark.createDataFrame(data, ddl).select(expr).collect()]


def test_age_band_edges(spark):
    ages = [20, 29, 30, 39, 40, 49, 50, 59, 60, None]
    found = rows(spark, "age smallint", [(a,) for a in ages], classify.age_band("age"))
    assert found == ["20-29", "20-29", "30-39", "30-39", "40-49", "40-49", "50-59", "50-59", "60+", "60+"]


def test_risk_tier_edges(spark):
    cases = [
        (2, "0", "100", "HIGH"),
        (9, "0", None, "HIGH"),
        (1, "0", "100", "MEDIUM"),
        (0, "90.00", "100.00", "LOW"),  # exactly 0.90 is not over
        (0, "90.01", "100.00", "MEDIUM"),
        (0, "900000000.90", "999999999.99", "MEDIUM"),  # over by a hair
        (0, "50", "0", "LOW"),
        (0, "50", "-10", "LOW"),
        (None, "95", "100", "MEDIUM"),
        (None, "10", "100", "LOW"),
        (-2, None, "100", "LOW"),
    ]
    data = [(c, None if b is None else Decimal(b), None if x is None else Decimal(x)) for c, b, x, _ in cases]
    found = rows(
        spark, "code smallint, bill decimal(18,2), lim decimal(12,2)", data,
        classify.risk_tier("code", "bill", "lim"),
    )
    assert found == [c[3] for c in cases]


def test_use_band_edges(spark):
    cases = [
        ("5", "0", "無額度"), ("9.99", "100", "0-10%"), ("10", "100", "10-30%"), ("29.99", "100", "10-30%"),
        ("30", "100", "30-60%"), ("60", "100", "60-90%"), ("89.99", "100", "60-90%"), ("90", "100", "90%+"),
        ("-5", "100", "0-10%"), ("5", "-100", "0-10%"), ("-95", "-100", "90%+"),
    ]
    found = rows(
        spark, "b decimal(24,2), l decimal(22,2)", [(Decimal(b), Decimal(x)) for b, x, _ in cases],
        classify.use_band("b", "l"),
    )
    assert found == [c[2] for c in cases]


def test_verdict(spark):
    data = [("ERROR", 0), ("ERROR", 1), ("WARN", 3), ("INFO", 1)]
    found = rows(spark, "s string, n bigint", data, classify.verdict(F.col("s"), F.col("n")))
    assert found == ["PASS", "FAIL", "WARN", "WARN"]


@pytest.mark.parametrize("charset, codec", [("UTF-8", "utf-8"), ("UTF-16LE", "utf-16-le")])
def test_row_hash(spark, charset, codec):
    data = [("HIGH", Decimal("20000.00")), (None, Decimal("1.50")), ("LOW", None)]
    found = rows(
        spark, "tier string, lim decimal(12,2)", data,
        values.row_hash(F.col("tier"), F.col("lim"), charset=charset),
    )
    texts = ["HIGH|20000.00", "~|1.50", "LOW|~"]
    assert [bytes(h) for h in found] == [hashlib.sha256(t.encode(codec)).digest() for t in texts]


def test_text_is_null_safe(spark):
    assert column(spark, values.text("a", F.col("x"), "b"), x=F.lit(None).cast("int")) == "ab"


def test_percentages_round_half_up(spark):
    data = [(1, 8), (1, 3), (2, 3), (1, 16), (0, 5), (1, 0)]
    found = rows(
        spark, "n bigint, d bigint", data, values.percentage(F.col("n"), F.col("d"), 1)
    )
    assert found == [Decimal(x) for x in ("12.5", "33.3", "66.7", "6.3", "0.0")] + [None]


def test_guarded_ratio(spark):
    data = [(Decimal(5), Decimal(2)), (Decimal(5), Decimal(0)), (Decimal(5), Decimal(-1))]
    found = rows(
        spark, "n decimal(18,2), d decimal(12,2)", data, values.guarded_ratio(F.col("n"), F.col("d"))
    )
    assert found == [Decimal("2.5"), None, None]


def test_month_date(spark):
    assert column(spark, values.month_date(F.col("k")), k=200502) == date(2005, 2, 1)


def test_calendar_rows_follow_the_rule(spark):
    months = {r.date_key: r for r in seeds.dim_date(spark).collect()}
    assert sorted(months) == [200504, 200505, 200506, 200507, 200508, 200509, 200510]
    assert [months[k].source_month_ix for k in sorted(months)] == [6, 5, 4, 3, 2, 1, 7]
    assert months[200506].month_end_date == date(2005, 6, 30)
    assert months[200506].quarter_num == 2 and months[200510].quarter_num == 4
    assert months[200509].month_name_zh == "2005年9月"


def test_previous_period_crosses_the_year():
    calendar = seeds.Calendar.starting(200510)
    assert calendar.previous(200601) == 200512
    assert calendar.previous(200510) is None
    assert calendar.closing(200510) == 200510 and calendar.closing(200601) == 200512


def test_unknown_period_is_refused():
    calendar = seeds.Calendar.starting()
    with pytest.raises(seeds.UnknownPeriod):
        calendar.month(200503)
    with pytest.raises(seeds.UnknownPeriod):
        calendar.observed_month(200510)  # the outcome month has no measures


def test_seeds_have_declared_types(spark):
    from chronomart.schemas import TABLES

    for name, df in seeds.all_seeds(spark).items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in TABLES[name].schema
        ]
    severities = [r.severity for r in seeds.quality_rule(spark).collect()]
    assert severities.count("ERROR") == 8 and severities.count("WARN") == 4
