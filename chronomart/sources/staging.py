"""Staging: the wide snapshot, one row per client, typed and stamped."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart import schemas
from chronomart.functions.values import utc_now

# Years of the order history that play the observed months, and
# the batch id of that stand-in source.
OUTCOME_YEAR = 2001
HISTORY_BATCH = "00000000-0000-0000-0000-000000000001"
HISTORY_SOURCE = "order history"


def stage(source: DataFrame, batch_id: str) -> DataFrame:
    """Project the source columns in order, cast them and stamp the batch."""
    typed = [
        f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schemas.STG_CREDIT_CLIENTS
        if f.name in schemas.SOURCE.names
    ]
    outcome = "CAST(CAST(default AS int) AS boolean) AS default_next_month"
    return source.selectExpr(*typed, outcome).withColumns(
        {"load_batch_id": F.lit(batch_id), "loaded_at": utc_now()}
    )


def batch(stg: DataFrame, batch_id: str) -> DataFrame:
    return stg.filter(F.col("load_batch_id") == batch_id)


def yearly_totals(orders: DataFrame, years: dict[str, int]) -> DataFrame:
    """One row per client: total, late and paid-off counts, billed and paid amounts of each year.

    ``years`` maps a suffix of the columns to its year; an order of any other
    year is an error, since no month would show it.  Orders are reduced map-side
    to one row per task and client and exchanged once, so a client with a large
    share of all orders does not fill a task.  Amounts are summed in whole cents:
    exact like decimals, at the price of a long addition.  Years without orders
    are null.
    """
    year = F.year("o_orderdate")
    inside = F.when(year.isin(list(years.values())), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("order outside the calendar: "), F.coalesce(F.col("o_orderdate").cast("string"), F.lit("no date")))).cast("boolean")
    )
    cents = (F.col("o_totalprice").cast("decimal(14,2)") * 100).cast("bigint")
    status = F.col("o_orderstatus")
    paid = (
        F.when(status == "F", cents)
        .when((status == "O") & (F.col("o_orderpriority") == "1-URGENT"), -cents)
        .otherwise(0)
    )

    def amount(total: Column) -> Column:
        return (total.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")

    rows = orders.filter(inside).select(
        (F.col("o_custkey") + 1).alias("client_id"),
        year.alias("yr"),
        F.lit(1).cast("bigint").alias("n"),
        (status == "P").cast("bigint").alias("late"),
        (status == "F").cast("bigint").alias("paid_off"),
        cents.alias("bill"),
        paid.alias("paid"),
    )
    totals = []
    for suffix, y in years.items():
        for name in ("n", "late", "paid_off", "bill", "paid"):
            total = F.sum(F.when(F.col("yr") == y, F.col(name)))
            totals.append((amount(total) if name in ("bill", "paid") else total).alias(f"{name}{suffix}"))
    return rows.groupBy("client_id").agg(*totals)


def source_from_order_history(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Source snapshot derived from customers and their yearly orders.

    Each year of orders plays one month; the year after them gives the outcome.
    """
    years = {f"_{i}": OUTCOME_YEAR - i for i in range(1, schemas.MONTHS + 1)} | {"_after": OUTCOME_YEAR}
    history = yearly_totals(orders, years)
    clients = customer.selectExpr(
        "c_custkey + 1 AS client_id",
        "CAST(greatest(CAST(c_acctbal AS decimal(12,2)), 0) * 200 AS decimal(12,2)) AS limit_bal",
        "CAST(1 + c_custkey % 2 AS smallint) AS sex",
        "CAST(c_nationkey % 7 AS smallint) AS education",
        "CAST(c_custkey div 2 % 4 AS smallint) AS marriage",
        "CAST(21 + c_custkey * 7 % 50 AS smallint) AS age",
    )
    ordinals = range(1, schemas.MONTHS + 1)
    return clients.join(history, "client_id", "left").selectExpr(
        "client_id",
        *schemas.ATTRIBUTE_COLUMNS,
        *[
            f"CAST(CASE WHEN n_{i} IS NULL THEN -2 WHEN late_{i} = 0 AND paid_off_{i} = 0 THEN -1 "
            f"ELSE least(late_{i}, 9) END AS smallint) AS pay_{i}"
            for i in ordinals
        ],
        *[f"coalesce(bill_{i}, CAST(0 AS decimal(18,2))) AS bill_amt{i}" for i in ordinals],
        *[f"coalesce(paid_{i}, CAST(0 AS decimal(18,2))) AS pay_amt{i}" for i in ordinals],
        "CAST(coalesce(late_after, 0) > 0 AS smallint) AS default",
    )
