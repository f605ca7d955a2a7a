"""Analysis queries and extracts over the star.

Facts meet the customer dimension co-located by client; constant dimensions are
joined after an aggregation that leaves a few rows per code.  Ratios are always
sums divided by sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronomart.functions import classify
from chronomart.functions.values import month_date, percentage, quotient
from chronomart.operators import joins
from chronomart.sources import seeds
from chronomart.sources.files import write_single_csv
from chronomart.sources.seeds import Calendar

# Report headings of the four analysis questions.
REPORT_HEADINGS = {
    "tier_migration_pct": {
        "prev_tier": "前月等級",
        "risk_tier": "本月等級",
        "customer_months": "客戶月數",
        "pct_of_prev": "佔前月百分比",
    },
    "default_rate_by_tier": {
        "risk_tier": "風險等級",
        "customers": "客戶數",
        "defaults": "違約數",
        "default_pct": "違約率百分比",
    },
    "default_rate_by_band": {
        "use_band": "使用率區間",
        "customers": "客戶數",
        "default_pct": "違約率百分比",
    },
    "delinquency_trend": {
        "date_key": "月份",
        "accounts": "帳戶數",
        "late_accounts": "逾期帳戶數",
        "late_pct": "逾期率百分比",
        "mean_months_late": "逾期者平均月數",
    },
}


def with_headings(df: DataFrame, query: str) -> DataFrame:
    return df.withColumnsRenamed(REPORT_HEADINGS[query])


def _tier_order(column: str) -> Column:
    return classify.ranked(F.col(column), classify.TIERS)


def report_order(query: str) -> list[Column]:
    """The order of a report's rows, complete: no two rows share a place."""
    return {
        "tier_migration_pct": [_tier_order("prev_tier"), _tier_order("risk_tier")],
        "default_rate_by_tier": [F.desc("default_pct"), _tier_order("risk_tier")],
        "default_rate_by_band": [classify.use_band_order(F.col("use_band")), F.col("use_band")],
        "delinquency_trend": [F.col("date_key")],
    }[query]


def with_places(report: DataFrame, query: str) -> DataFrame:
    """The report with each row's place in its own order.

    A report has a row for each tier, band or month however large its input is,
    so its places are numbered in one task.
    """
    return report.withColumn("place", F.row_number().over(Window.orderBy(*report_order(query))))


# ── analysis questions ───────────────────────────────────────────────────────


def monthly_tiers(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Each statement's tier next to the client's previous statement's tier.

    The previous statement need not be of the previous month if the client
    missed one.
    """
    by_client = Window.partitionBy("client_id").orderBy("date_key")
    months = joins.fact_to_version(
        fact.select("client_id", "date_key", "customer_sk"), dim, ["risk_tier"]
    )
    return months.withColumn("prev_tier", F.lag("risk_tier").over(by_client))


def tier_migration(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Extract: previous tier x current tier."""
    return (
        monthly_tiers(fact, dim)
        .filter(F.col("prev_tier").isNotNull())
        .groupBy("prev_tier", F.col("risk_tier").alias("curr_tier"))
        .agg(F.count("*").alias("customer_months"))
    )


def tier_migration_pct(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Where did last month's tier go: counts and share of the previous tier."""
    of_prev = Window.partitionBy("prev_tier")
    months = F.col("customer_months")
    return (
        tier_migration(fact, dim)
        .withColumnRenamed("curr_tier", "risk_tier")
        .withColumn("pct_of_prev", percentage(months, F.sum(months).over(of_prev), 1))
        .orderBy(*report_order("tier_migration_pct"))
    )


def default_rate_by_tier(outcome: DataFrame, dim: DataFrame, period: int) -> DataFrame:
    """Default rate by the tier valid in one literal month."""
    tiers = joins.versions_at(dim, period).select("client_id", "risk_tier")
    return (
        outcome.select("client_id", "is_default")
        .join(tiers, "client_id")
        .groupBy("risk_tier")
        .agg(F.count("*").alias("customers"), F.sum(F.col("is_default").cast("int")).alias("defaults"))
        .withColumn("default_pct", percentage(F.col("defaults"), F.col("customers"), 2))
        .orderBy(*report_order("default_rate_by_tier"))
    )


def default_rate_by_band(fact: DataFrame, outcome: DataFrame) -> DataFrame:
    """Default rate by credit use, total bill over total limit per client."""
    use = fact.groupBy("client_id").agg(
        F.sum("bill_amount").alias("bill"), F.sum("credit_limit").alias("limit")
    )
    return (
        use.select("client_id", classify.use_band("bill", "limit").alias("use_band"))
        .join(outcome.select("client_id", "is_default"), "client_id")
        .groupBy("use_band")
        .agg(F.count("*").alias("customers"), F.sum(F.col("is_default").cast("int")).alias("defaults"))
        .orderBy(*report_order("default_rate_by_band"))
        .select(
            "use_band",
            "customers",
            percentage(F.col("defaults"), F.col("customers"), 2).alias("default_pct"),
        )
    )


def delinquency_trend(fact: DataFrame) -> DataFrame:
    """Late accounts per month and how many months the late ones are behind."""
    per_status = fact.groupBy("date_key", "pay_status_key").agg(F.count("*").alias("n"))
    late, n = F.col("is_delinquent"), F.col("n")
    return (
        per_status.join(seeds.dim_payment_status(fact.sparkSession), "pay_status_key")
        .groupBy("date_key")
        .agg(
            F.sum(n).alias("accounts"),
            F.sum(F.when(late, n).otherwise(0)).alias("late_accounts"),
            F.sum(F.when(late, n * F.col("delinquent_months"))).alias("months_late"),
        )
        .select(
            "date_key",
            "accounts",
            "late_accounts",
            percentage(F.col("late_accounts"), F.col("accounts"), 2).alias("late_pct"),
            quotient(F.col("months_late"), F.col("late_accounts"), 2).alias("mean_months_late"),
        )
        .orderBy(*report_order("delinquency_trend"))
    )


# ── extracts: numerators and denominators, no ratios ─────────────────────────


def risk_tier_by_month(fact: DataFrame, dim: DataFrame, calendar: Calendar) -> DataFrame:
    """Tier x month.  Amounts lose their cents row by row before they are summed."""
    spark = fact.sparkSession
    tiers = joins.fact_to_version(
        fact.select(
            "client_id", "customer_sk", "date_key", "pay_status_key", "bill_amount", "credit_limit"
        ),
        dim,
        ["risk_tier"],
    )
    per_status = tiers.groupBy("date_key", "risk_tier", "pay_status_key").agg(
        F.count("*").alias("n"),
        F.sum(F.col("bill_amount").cast("bigint")).alias("bills"),
        F.sum(F.col("credit_limit").cast("bigint")).alias("limits"),
    )
    return (
        per_status.join(seeds.dim_payment_status(spark), "pay_status_key")
        .join(seeds.dim_date(spark, calendar), "date_key")
        .groupBy(F.col("date_key").alias("month_key"), "year_num", "month_num", "risk_tier")
        .agg(
            F.sum("n").alias("customer_months"),
            F.sum("bills").alias("bill_amount_sum"),
            F.sum("limits").alias("credit_limit_sum"),
            F.sum(F.when(F.col("is_delinquent"), F.col("n")).otherwise(0)).alias("delinquent_months"),
        )
    )


def default_by_tier(outcome: DataFrame, dim: DataFrame) -> DataFrame:
    """Tier of the current version x defaults."""
    return (
        joins.fact_to_version(
            outcome.select("client_id", "customer_sk", "is_default"),
            joins.current_versions(dim),
            ["risk_tier"],
        )
        .groupBy("risk_tier")
        .agg(F.count("*").alias("customers"), F.sum(F.col("is_default").cast("int")).alias("defaults"))
    )


def version_counts(dim: DataFrame) -> DataFrame:
    """How many clients have how many versions."""
    return (
        dim.groupBy("client_id")
        .agg(F.count("*").alias("versions"))
        .groupBy("versions")
        .agg(F.count("*").alias("customers"))
    )


def quality_results(report: DataFrame) -> DataFrame:
    return report.select(
        "load_batch_id", "rule_code", "severity", "verdict", "rows_checked", "rows_failed"
    )


def extracts(tables: dict[str, DataFrame], report: DataFrame, calendar: Calendar) -> dict[str, DataFrame]:
    """The five extracts by name, each of one grain."""
    fact, dim, outcome = (
        tables[n] for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome")
    )
    return {
        "risk_tier_by_month": risk_tier_by_month(fact, dim, calendar),
        "tier_migration": tier_migration(fact, dim),
        "default_by_tier": default_by_tier(outcome, dim),
        "version_counts": version_counts(dim),
        "quality_results": quality_results(report),
    }


def extract_order(name: str) -> list[Column]:
    """The order of an extract's rows in its file."""
    return {
        "risk_tier_by_month": [F.col("month_key"), _tier_order("risk_tier")],
        "tier_migration": [_tier_order("prev_tier"), _tier_order("curr_tier")],
        "default_by_tier": [_tier_order("risk_tier")],
        "version_counts": [F.col("versions")],
        "quality_results": [F.col("load_batch_id"), F.col("rule_code")],
    }[name]


def export(frames: dict[str, DataFrame], path: str, order: Callable[[str], list[Column]] = extract_order) -> None:
    """Write every frame as one CSV file below ``path``, its rows in their order."""
    for name, df in frames.items():
        write_single_csv(df, f"{path}/{name}.csv", order(name))


# ── calculated fields on the extracts ────────────────────────────────────────


def bi_trend(by_month: DataFrame) -> DataFrame:
    """Delinquency rate and credit use per tier and month."""
    return by_month.select(
        month_date(F.col("month_key")).alias("month_date"),
        "risk_tier",
        quotient(F.col("delinquent_months"), F.col("customer_months"), 6).alias("delinquency_rate"),
        quotient(F.col("bill_amount_sum"), F.col("credit_limit_sum"), 6).alias("utilization"),
    )


def bi_overall_trend(by_month: DataFrame) -> DataFrame:
    """The same rates over all tiers: sums first, then the division."""
    totals = by_month.groupBy("month_key").agg(
        *[
            F.sum(c).alias(c)
            for c in ("customer_months", "bill_amount_sum", "credit_limit_sum", "delinquent_months")
        ]
    )
    return bi_trend(totals.withColumn("risk_tier", F.lit("ALL")))


def bi_migration_share(migration: DataFrame) -> DataFrame:
    """Share of each current tier within its previous tier."""
    months = F.col("customer_months")
    total = F.sum(months).over(Window.partitionBy("prev_tier"))
    return migration.select(
        "prev_tier", "curr_tier", quotient(months, total, 6).alias("migration_share")
    )


def bi_default_rate(by_tier: DataFrame) -> DataFrame:
    return by_tier.select(
        "risk_tier", quotient(F.col("defaults"), F.col("customers"), 6).alias("default_rate")
    )


# ── histories ────────────────────────────────────────────────────────────────


def version_timeline(fact: DataFrame, dim: DataFrame, client_id: int | None = None) -> DataFrame:
    """Which version every statement hit; of one client if given."""
    if client_id is not None:
        fact, dim = (df.filter(F.col("client_id") == client_id) for df in (fact, dim))
    hits = joins.fact_to_version(
        fact.select("client_id", "date_key", "customer_sk", "pay_status_key"),
        dim,
        ["version_num", "risk_tier", "valid_from_date", "valid_to_date"],
    )
    readings = seeds.dim_payment_status(fact.sparkSession).select("pay_status_key", "common_reading")
    return hits.join(readings, "pay_status_key").select(
        "client_id",
        "date_key",
        "version_num",
        "risk_tier",
        "valid_from_date",
        "valid_to_date",
        F.col("common_reading").alias("payment_status"),
    )


def load_progress(fact: DataFrame, dim: DataFrame, calendar: Calendar) -> DataFrame:
    """Facts per observed month and versions opened up to it."""
    spark = fact.sparkSession
    months = seeds.dim_date(spark, calendar).filter(
        F.col("date_key").isin([m.key for m in calendar.observed])
    )
    facts = fact.groupBy("date_key").agg(F.count("*").alias("facts"))
    opened = dim.groupBy(F.col("valid_from_date").alias("date_key")).agg(F.count("*").alias("opened"))
    so_far = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    return (
        months.select("date_key")
        .join(facts, "date_key", "left")
        .join(opened, "date_key", "left")
        .select(
            "date_key",
            F.coalesce("facts", F.lit(0)).alias("facts"),
            F.coalesce(F.sum("opened").over(so_far), F.lit(0)).alias("versions"),
        )
    )
