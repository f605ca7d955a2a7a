"""Registered queries: name -> function of (session, folder of the input tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chronomart.functions import classify
from chronomart.functions.values import month_date, new_batch_id
from chronomart.operators import audit, facts, joins, quality, reshape, scd2
from chronomart.plans import marts, star, warehouse
from chronomart.schemas import VERSION_SPAN
from chronomart.sources import files, seeds, staging
from chronomart.sources.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

CALENDAR = seeds.Calendar.starting()
LATEST = CALENDAR.observed[-1].key


def registered(query: Query) -> Query:
    """Register under the function's name, results in types any engine can compare."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(spark, sf_dir))

    REGISTRY[query.__name__] = run
    return query


def portable(df: DataFrame) -> DataFrame:
    """Integers as bigint, flags as 0/1, decimals as double, hashes and dates as text."""
    columns = []
    for f in df.schema:
        c, kind = F.col(f.name), f.dataType
        if isinstance(kind, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif isinstance(kind, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.BinaryType):
            c = F.lower(F.hex(c))
        elif isinstance(kind, (T.DateType, T.TimestampType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    loaded = star.warehouse(spark, sf_dir)
    return (
        loaded.table("fact_monthly_statement"),
        loaded.table("dim_customer"),
        loaded.table("fact_default_outcome"),
    )


def _stored_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.warehouse(spark, sf_dir).table("credit_clients")


# ── staging, unpivot, snapshot ───────────────────────────────────────────────


@registered
def stage_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.staged(spark, sf_dir).drop("loaded_at")


@registered
def csv_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source written as CSV, read back with the declared schema and staged."""
    path = f"{shared_folder(spark)}/chronomart/csv/{new_batch_id()}"
    files.write_csv(star.source(spark, sf_dir), path)
    return staging.stage(files.read_snapshot_csv(spark, path), staging.HISTORY_BATCH).drop("loaded_at")


@registered
def row_number_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered 1..n by falling balance."""
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return files.number_rows(customers, "client_id", [F.desc("c_acctbal"), F.col("c_custkey")])


@registered
def file_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances written to CSV files in order of the customers, then numbered in file order."""
    path = f"{shared_folder(spark)}/chronomart/csv/{new_batch_id()}"
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    files.write_csv(customers.orderBy("c_custkey").select("c_acctbal"), path)
    rows = files.fixed_splits(spark, path).read.schema("c_acctbal double").option("header", True).csv(path)
    return files.number_file_rows(rows, "client_id")


@registered
def unpivot_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.unpivot(star.staged(spark, sf_dir), CALENDAR.observed, ["client_id"])


@registered
def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.staged(spark, sf_dir).select(
        "client_id", "age", classify.age_band("age").alias("age_band")
    )


@registered
def risk_tier_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.snapshot(star.staged(spark, sf_dir), CALENDAR).drop("row_hash")


@registered
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.snapshot(star.staged(spark, sf_dir), CALENDAR).select(
        "client_id", "date_key", "row_hash"
    )


@registered
def prev_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that occur in the orders, each with the one before it that occurs."""
    at = F.col("o_orderdate")
    months = (
        star.table(spark, sf_dir, "orders")
        .groupBy((F.year(at) * 100 + F.month(at)).alias("date_key"))
        .agg(F.count("*").alias("orders"))
    )
    by_month = Window.orderBy("date_key")  # one row per month of the order history
    first_day = month_date(F.col("date_key"))
    return months.select(
        "date_key",
        "orders",
        F.lag("date_key").over(by_month).alias("prev_date_key"),
        F.last_day(first_day).alias("month_end_date"),
        F.quarter(first_day).alias("quarter_num"),
    )


# ── Type 2 dimension ─────────────────────────────────────────────────────────


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapped snapshots: months with orders only, clients one year older each month."""
    stg = _stored_staging(spark, sf_dir)
    months = reshape.unpivot(
        reshape.resolve_codes(stg), CALENDAR.observed, reshape.SNAPSHOT_KEYS
    ).filter("pay_code <> -2")
    elapsed = (F.col("date_key") - CALENDAR.observed[0].key).cast("smallint")
    aged = months.withColumn("age", (F.col("age") + elapsed).cast("smallint"))
    return reshape.with_hash(reshape.with_bands(aged)).select(
        "date_key", *reshape.SNAPSHOT_KEYS, "age_band", "risk_tier", "row_hash"
    )


@registered
def scd2_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.build_from_staging(star.staged(spark, sf_dir), CALENDAR)


@registered
def scd2_build_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.as_dimension(scd2.build(_activity(spark, sf_dir), CALENDAR))


@registered
def scd2_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages are overwritten on the open version only, so each version keeps its last one."""
    return scd2.build(_activity(spark, sf_dir), CALENDAR).select(
        "client_id", "version_num", "valid_from_date", "valid_to_date", "age", "age_band"
    )


@registered
def scd2_apply_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One more month on the dimension as it stood before that month."""
    _, dim, _ = _star(spark, sf_dir)
    month = CALENDAR.observed[-2].key
    before = scd2.rewind(dim.drop("created_at"), month, CALENDAR)
    snapshot = reshape.snapshot(_stored_staging(spark, sf_dir), CALENDAR, month)
    return scd2.apply(before, snapshot, month, CALENDAR)


@registered
def scd2_apply_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month onto gapped history: new, changed, unchanged and absent clients at once."""
    activity = _activity(spark, sf_dir)
    month = CALENDAR.observed[2].key
    before = scd2.as_dimension(scd2.build(activity.filter(F.col("date_key") < month), CALENDAR))
    snapshot = activity.filter(F.col("date_key") == month)
    return scd2.apply(before, snapshot, month, CALENDAR)


@registered
def scd2_rewind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as it stood before a month, Type 1 values derived again."""
    activity = _activity(spark, sf_dir)
    dim = scd2.as_dimension(scd2.build(activity, CALENDAR))
    return scd2.rewind(dim, CALENDAR.observed[3].key, CALENDAR, activity)


@registered
def scd2_corrected_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest month loaded again with the limits of one education group doubled."""
    _, dim, _ = _star(spark, sf_dir)
    stg = _stored_staging(spark, sf_dir)
    raised = (F.col("limit_bal") * 2).cast("decimal(12,2)")
    corrected = stg.withColumn(
        "limit_bal", F.when(F.col("education") == 1, raised).otherwise(F.col("limit_bal"))
    )
    before = scd2.rewind(dim.drop("created_at"), LATEST, CALENDAR)
    return scd2.apply(before, reshape.snapshot(corrected, CALENDAR, LATEST), LATEST, CALENDAR)


@registered
def monthly_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts with their version after a whole batch loaded the latest month again, corrected."""
    wh = star.load(spark, sf_dir)  # a warehouse of its own: the batch changes it
    rows = star.source(spark, sf_dir)
    raised = (F.col("limit_bal") * 2).cast("decimal(12,2)")
    corrected = rows.withColumn(
        "limit_bal", F.when(F.col("education") == 1, raised).otherwise(F.col("limit_bal"))
    )
    wh.monthly_refresh(corrected, staging.HISTORY_SOURCE, LATEST, star.source_rows(spark, sf_dir))
    columns = ["fact", "client_id", "date_key", "customer_sk", "credit_limit", "risk_tier"]
    found = [
        joins.fact_to_version(wh.table(table), wh.table("dim_customer"), ["risk_tier"])
        .withColumns({"fact": F.lit(kind), "credit_limit": limit})
        .select(*columns)
        for kind, table, limit in [
            ("statement", "fact_monthly_statement", F.col("credit_limit")),
            ("outcome", "fact_default_outcome", F.lit(None).cast("decimal(18,2)")),
        ]
    ]
    return found[0].unionByName(found[1])


# ── facts and joins ──────────────────────────────────────────────────────────


@registered
def fact_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements joined to the stored version valid in their month."""
    _, dim, _ = _star(spark, sf_dir)
    return facts.statements(_stored_staging(spark, sf_dir), dim, CALENDAR)


@registered
def fact_statement_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statements from the input tables, versions found on the way."""
    return facts.statements_from_staging(star.staged(spark, sf_dir), CALENDAR)


@registered
def fact_statement_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month's statements, as the monthly load writes them."""
    _, dim, _ = _star(spark, sf_dir)
    return facts.statements(_stored_staging(spark, sf_dir), dim, CALENDAR, [CALENDAR.observed[1].key])


@registered
def fact_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, _ = _star(spark, sf_dir)
    return facts.outcomes(_stored_staging(spark, sf_dir), dim, CALENDAR)


@registered
def point_in_time_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, outcome = _star(spark, sf_dir)
    versions = joins.versions_at(dim, CALENDAR.observed[2].key)
    return outcome.select("client_id", "is_default").join(
        versions.select("client_id", "version_num", "risk_tier"), "client_id"
    )


@registered
def current_version_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, outcome = _star(spark, sf_dir)
    current = joins.current_versions(dim).select("client_id", "version_num", "risk_tier")
    return outcome.select("client_id", "is_default").join(current, "client_id")


@registered
def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, outcome = _star(spark, sf_dir)
    view = joins.statement_star(fact, dim, seeds.all_seeds(spark, CALENDAR), outcome)
    return view.withColumn("utilization", F.round("utilization", 6))


@registered
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements against a dimension that lost its HIGH versions."""
    fact, dim, _ = _star(spark, sf_dir)
    return joins.orphan_totals(fact, dim.filter("risk_tier <> 'HIGH'"), "customer_sk")


@registered
def new_clients_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients first seen in the second month."""
    activity = _activity(spark, sf_dir)
    month = CALENDAR.observed[1].key
    before = scd2.as_dimension(scd2.build(activity.filter(F.col("date_key") < month), CALENDAR))
    snapshot = activity.filter(F.col("date_key") == month)
    return joins.without_current(snapshot, before).select("client_id", "risk_tier", "row_hash")


@registered
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer that are open at the same time, each for 90 days."""
    day = F.to_date("o_orderdate")
    spans = star.table(spark, sf_dir, "orders").select(
        "o_custkey", day.alias("opened"), F.date_add(day, 90).alias("closed")
    )
    return joins.overlap_counts(spans, "o_custkey", "opened", "closed")


# ── quality ──────────────────────────────────────────────────────────────────


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = star.warehouse(spark, sf_dir)
    rows, observed = star.source_rows(spark, sf_dir), loaded.observed(staging.HISTORY_BATCH)
    return quality.report(quality.run(loaded.tables(), staging.HISTORY_BATCH, rows, CALENDAR, observed))


@registered
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@registered
def quality_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on faulty copies of the tables, in which every ERROR rule fails.

    Clients staged twice, statements doubled, statements with the key of the next
    client, a second open version, outcomes left out.
    """
    wh = star.warehouse(spark, sf_dir)
    tables = wh.tables()

    def some(df: DataFrame, digit: int) -> DataFrame:
        return df.filter(F.col("client_id") % 10 == digit)

    stg, fact, dim = (tables[n] for n in ("credit_clients", "fact_monthly_statement", "dim_customer"))
    twice = some(fact, 1).filter(F.col("date_key") == CALENDAR.observed[1].key)
    foreign = F.when(F.col("client_id") % 10 == 2, F.col("customer_sk") + VERSION_SPAN).otherwise(F.col("customer_sk"))
    second = some(dim, 3).filter("is_current").withColumns(
        {"customer_sk": F.col("customer_sk") + 50, "version_num": F.col("version_num") + 50}
    )
    dirty = tables | {
        "credit_clients": stg.unionByName(some(stg, 0)),
        "fact_monthly_statement": fact.unionByName(twice).withColumn("customer_sk", foreign),
        "dim_customer": dim.unionByName(second),
        "fact_default_outcome": tables["fact_default_outcome"].filter(F.col("client_id") % 10 != 4),
    }
    results = quality.run(dirty, staging.HISTORY_BATCH, star.source_rows(spark, sf_dir), CALENDAR)
    return quality.report(results)


@registered
def quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract of the stored results."""
    loaded = star.audited(spark, sf_dir)
    return marts.quality_results(quality.report(loaded.quality_results(staging.HISTORY_BATCH)))


@registered
def quality_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate_counts(_report(spark, sf_dir))


@registered
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that share order and line number."""
    return audit.duplicate_keys(
        star.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@registered
def undocumented_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, _ = _star(spark, sf_dir)
    return quality.undocumented_codes(dim)


@registered
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.warehouse(spark, sf_dir).constraints()


@registered
def distinct_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions and distinct clients per tier."""
    _, dim, _ = _star(spark, sf_dir)
    return dim.groupBy("risk_tier").agg(
        F.count("*").alias("versions"), F.count_distinct("client_id").alias("clients")
    )


# ── marts ────────────────────────────────────────────────────────────────────


@registered
def tier_migration_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.with_places(marts.tier_migration_pct(fact, dim), "tier_migration_pct")


@registered
def default_rate_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, outcome = _star(spark, sf_dir)
    return marts.with_places(marts.default_rate_by_tier(outcome, dim, LATEST), "default_rate_by_tier")


@registered
def default_rate_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _, outcome = _star(spark, sf_dir)
    return marts.with_places(marts.default_rate_by_band(fact, outcome), "default_rate_by_band")


@registered
def delinquency_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.with_places(marts.delinquency_trend(_star(spark, sf_dir)[0]), "delinquency_trend")


@registered
def risk_tier_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.risk_tier_by_month(fact, dim, CALENDAR)


@registered
def tier_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.tier_migration(fact, dim)


@registered
def default_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, outcome = _star(spark, sf_dir)
    return marts.default_by_tier(outcome, dim)


@registered
def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.version_counts(_star(spark, sf_dir)[1])


@registered
def version_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.version_timeline(fact, dim)


@registered
def load_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.load_progress(fact, dim, CALENDAR)


@registered
def bi_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    by_month = marts.risk_tier_by_month(fact, dim, CALENDAR)
    return marts.bi_trend(by_month)


@registered
def bi_overall_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.bi_overall_trend(marts.risk_tier_by_month(fact, dim, CALENDAR))


@registered
def bi_migration_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return marts.bi_migration_share(marts.tier_migration(fact, dim))


@registered
def bi_default_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dim, outcome = _star(spark, sf_dir)
    return marts.bi_default_rate(marts.default_by_tier(outcome, dim))


# ── catalog ──────────────────────────────────────────────────────────────────


@registered
def code_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim, _ = _star(spark, sf_dir)
    return warehouse.code_listing(fact, dim)


@registered
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.audited(spark, sf_dir).row_counts()


@registered
def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.audited(spark, sf_dir).data_dictionary()


@registered
def batch_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final states of two batches, of which the second announces a row too many."""
    wh, rows = star.fresh_warehouse(spark, sf_dir), star.source_rows(spark, sf_dir)
    source = star.source(spark, sf_dir)
    wh.full_refresh(source, staging.HISTORY_SOURCE, rows, staging.HISTORY_BATCH)
    try:
        wh.full_refresh(source, "one row short", rows + 1)
    except quality.QualityGateError:
        pass  # that is the state to be shown
    return wh.batches().select(
        "source_name",
        "source_rows",
        "status",
        "message",
        (F.col("finished_at") >= F.col("started_at")).alias("is_finished"),
    )
