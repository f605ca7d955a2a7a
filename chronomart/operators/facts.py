"""Fact rows: monthly statements and the one-per-client outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.operators import joins, reshape, scd2
from chronomart.schemas import FACT_DEFAULT_OUTCOME, FACT_MONTHLY_STATEMENT, MONTH_SPAN
from chronomart.sources import seeds
from chronomart.sources.seeds import Calendar


def _as_statements(months: DataFrame) -> DataFrame:
    """Client months with ``customer_sk`` -> statement facts.

    A month with an unknown or missing payment code drops out, which the fact
    row count reports.
    """
    coded = joins.lookup(
        months,
        seeds.dim_payment_status(months.sparkSession),
        "pay_code",
        "pay_status_code",
        "pay_status_key",
    )
    full = coded.withColumns(
        {
            "statement_sk": F.col("client_id") * MONTH_SPAN + F.col("date_key"),
            "credit_limit": F.col("limit_bal"),
        }
    )
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_MONTHLY_STATEMENT])


def statements_from_staging(stg: DataFrame, calendar: Calendar) -> DataFrame:
    """All months at once.  The version comes with the month, so nothing is joined or shuffled."""
    months = scd2.client_months(stg, calendar)
    return _as_statements(
        months.withColumn(
            "customer_sk", scd2.surrogate_key(F.col("client_id"), F.col("version_num"))
        )
    )


def statements(
    stg: DataFrame, dim_customer: DataFrame, calendar: Calendar, months: int | Sequence[int] | None = None
) -> DataFrame:
    """Months joined to the stored version valid in each: all observed months, or those given.

    For one month the interval is tested on the dimension before the join; for
    later months only versions that were still valid then are read.
    """
    keep = ["client_id", "limit_bal", "load_batch_id"]
    months = [months] if isinstance(months, int) else months
    if months is None:
        long = reshape.unpivot(stg, calendar.observed, keep)
        return _as_statements(joins.point_in_time(long, dim_customer, ["customer_sk"]))
    long = reshape.unpivot(stg, [calendar.observed_month(m) for m in months], keep)
    if len(months) > 1:
        later = dim_customer.filter(F.col("valid_to_date") >= min(months))
        return _as_statements(joins.point_in_time(long, later, ["customer_sk"]))
    valid = joins.versions_at(dim_customer, months[0]).select("client_id", "customer_sk")
    return _as_statements(long.join(valid, "client_id"))


def outcomes(stg: DataFrame, dim_customer: DataFrame, calendar: Calendar) -> DataFrame:
    """One outcome per client, on its current version, in the outcome month."""
    current = joins.current_versions(dim_customer).select("client_id", "customer_sk")
    return stg.join(current, "client_id").select(
        F.col("client_id").alias("outcome_sk"),
        "customer_sk",
        F.lit(calendar.outcome.key).alias("date_key"),
        "client_id",
        F.col("default_next_month").alias("is_default"),
        "load_batch_id",
    ).select(*FACT_DEFAULT_OUTCOME.names)
