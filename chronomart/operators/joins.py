"""Lookups, point-in-time joins, star joins, orphans and overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronomart.functions.values import guarded_ratio


def lookup(df: DataFrame, dim: DataFrame, code: str, dim_code: str, key: str) -> DataFrame:
    """Inner join ``df.code`` to a constant dimension, adding its ``key``.

    The dimension is one of the inline tables, which are broadcast; large code
    tables belong into a plain join.
    """
    side = dim.select(F.col(dim_code).alias("_code"), F.col(key))
    return df.join(side, F.col(code) == F.col("_code"), "inner").drop("_code")


def valid_at(period: Column, start: Column, end: Column) -> Column:
    """Closed interval: both ends belong to the version."""
    return period.between(start, end)


def point_in_time(
    fact: DataFrame, dim: DataFrame, columns: Sequence[str], key: str = "client_id", period: str = "date_key"
) -> DataFrame:
    """Join each row to the version that was valid in its period.

    The only equi key is the natural key, so both sides stay co-located when
    they are bucketed by it; the interval is checked as a residual condition.
    A hot key on the fact side is split at run time by the adaptive skew join,
    since a key has at most one version per period on the other side.
    """
    f, d = fact.alias("f"), dim.alias("d")
    on = (F.col(f"f.{key}") == F.col(f"d.{key}")) & valid_at(
        F.col(f"f.{period}"), F.col("d.valid_from_date"), F.col("d.valid_to_date")
    )
    return f.join(d, on, "inner").select("f.*", *[F.col(f"d.{c}") for c in columns])


def versions_at(dim: DataFrame, period: int) -> DataFrame:
    """Versions valid in one literal period (filters the dimension before any join)."""
    return dim.filter(valid_at(F.lit(period), F.col("valid_from_date"), F.col("valid_to_date")))


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def without_current(snapshot: DataFrame, dim: DataFrame, key: str = "client_id") -> DataFrame:
    """Snapshot rows whose client has no current version."""
    return snapshot.join(current_versions(dim).select(key), key, "left_anti")


def fact_to_version(fact: DataFrame, dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Join facts to the version their surrogate key names.

    A statement takes both its client and its surrogate key from one version,
    so the client is the join key (co-located by bucketing) and the surrogate
    key is compared as a closed range, which keeps it out of the hash keys and
    the exchange out of the plan.
    """
    f, d = fact.alias("f"), dim.alias("d")
    on = (F.col("f.client_id") == F.col("d.client_id")) & F.col("d.customer_sk").between(
        F.col("f.customer_sk"), F.col("f.customer_sk")
    )
    return f.join(d, on, "inner").select("f.*", *[F.col(f"d.{c}") for c in columns])


def statement_star(
    fact: DataFrame,
    dim_customer: DataFrame,
    dims: dict[str, DataFrame],
    outcome: DataFrame,
) -> DataFrame:
    """Denormalised star: one row per client and month.

    The outcome flag repeats on every month of a client; count it from the
    outcome fact, never from here.
    """
    versions = fact_to_version(
        fact, dim_customer, ["risk_tier", "age_band", "education_key", "marriage_key", "sex_key"]
    )
    flags = outcome.select("client_id", "is_default")
    return (
        versions.join(flags, "client_id", "left")
        .join(dims["dim_date"].select("date_key", "year_num", "month_num"), "date_key")
        .join(dims["dim_education"], "education_key")
        .withColumnRenamed("is_documented", "education_is_documented")
        .join(dims["dim_marriage"].select("marriage_key", "marriage_desc"), "marriage_key")
        .join(dims["dim_sex"].select("sex_key", "sex_desc"), "sex_key")
        .join(
            dims["dim_payment_status"].select(
                "pay_status_key", F.col("common_reading").alias("payment_status"), "is_delinquent"
            ),
            "pay_status_key",
        )
        .select(
            "client_id",
            "date_key",
            "year_num",
            "month_num",
            "risk_tier",
            "age_band",
            "education_desc",
            "education_is_documented",
            "marriage_desc",
            "sex_desc",
            "payment_status",
            "is_delinquent",
            "bill_amount",
            "payment_amount",
            "credit_limit",
            guarded_ratio(F.col("bill_amount"), F.col("credit_limit")).alias("utilization"),
            "is_default",
        )
    )


def orphan_totals(child: DataFrame, parent: DataFrame, key: str, owner: str = "client_id") -> DataFrame:
    """One row: rows checked, and rows whose key names no row of ``parent`` with the same owner.

    This is the pair that :func:`fact_to_version` joins by, so a row it would
    lose is counted here.  Children are counted per owner and key first; the
    owner alone is the join key, so tables bucketed by it are not exchanged, and
    the key is compared as a closed range.
    """
    references = child.groupBy(owner, key).agg(F.count("*").alias("references")).alias("c")
    known = parent.groupBy(owner, key).agg(F.lit(True).alias("known")).alias("p")
    on = (F.col(f"c.{owner}") == F.col(f"p.{owner}")) & F.col(f"p.{key}").between(
        F.col(f"c.{key}"), F.col(f"c.{key}")
    )
    return references.join(known, on, "left").agg(
        F.coalesce(F.sum("references"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("references"))), F.lit(0)).alias("rows_failed"),
    )


def overlap_counts(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Per key, its intervals and the number of pairs of closed intervals that overlap.

    Intervals are first counted per distinct (key, start, end), which bounds a
    key by the number of distinct period pairs however many rows it has.  A
    running sum over interval starts and ends then counts pairs without
    forming them: an interval that starts at p overlaps those that started
    before p and have not ended before p, and those that start at p too.

    An interval that ends before it starts overlaps exactly the regular ones
    that hold both its ends; these faulty shapes (normally none) are joined to
    the regular shapes of their key, where a hot key can be split.
    """
    per_key = Window.partitionBy(key)
    counted = (
        df.select(F.col(key), F.col(start).alias("s"), F.col(end).alias("e"))
        .groupBy(key, "s", "e")
        .agg(F.count("*").alias("n"))
    )
    faulty = counted.filter("s > e").select(
        F.col(key).alias("f_key"), F.col("s").alias("f_s"), F.col("e").alias("f_e"), F.col("n").alias("f_n")
    )
    holds = (F.col(key) == F.col("f_key")) & (F.col("s") <= F.col("f_e")) & (F.col("f_s") <= F.col("e"))
    held = (
        counted.filter("s <= e")
        .join(faulty, holds)
        .groupBy(key)
        .agg(F.sum(F.col("n") * F.col("f_n")).alias("held"))
    )
    shapes = counted.withColumn("regular", F.col("s") <= F.col("e"))
    none = F.lit(0).cast("bigint")

    def event(at: str, started: Column, ended: Column, intervals: Column) -> Column:
        return F.struct(
            F.col(at).alias("p"),
            started.alias("started"),
            ended.alias("ended"),
            intervals.alias("intervals"),
        )

    def if_regular(value: Column) -> Column:
        return F.when(F.col("regular"), value).otherwise(none)

    n = F.col("n")
    events = (
        shapes.select(
            key,
            F.inline(
                F.array(
                    event("s", if_regular(n), none, n),
                    event("e", none, if_regular(n), none),
                )
            ),
        )
        .groupBy(key, "p")
        .agg(*[F.sum(c).alias(c) for c in ("started", "ended", "intervals")])
    )
    before = per_key.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.coalesce(F.sum(F.col("started") - F.col("ended")).over(before), none)
    together = F.expr("started * (started - 1) div 2")
    return (
        events.withColumn("open_before", open_before)
        .groupBy(key)
        .agg(
            F.sum("intervals").alias("intervals"),
            F.sum(F.col("started") * F.col("open_before") + together).alias("overlapping_pairs"),
        )
        .join(held, key, "left")
        .withColumn("overlapping_pairs", F.col("overlapping_pairs") + F.coalesce("held", none))
        .drop("held")
    )
