"""Slowly changing dimension, Type 2, with Type 1 columns on the open version.

Three ways to the same rows:

``versioned_months``  full load from the wide snapshot.  All months of a client
                      sit in one row, so versions are found without a shuffle.
``build``             full load from long, possibly gapped monthly snapshots.
``apply``             one month onto a stored dimension; ``rewind`` first makes
                      a corrected re-run possible.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronomart.functions import classify
from chronomart.functions.values import row_hash, utc_now
from chronomart.operators import joins, reshape
from chronomart.schemas import DIM_CUSTOMER, OPEN_END, VERSION_SPAN, struct
from chronomart.sources.seeds import Calendar, Month, inline_table

DIM_COLUMNS = [c for c in DIM_CUSTOMER.names if c != "created_at"]


def surrogate_key(client: Column, version: Column) -> Column:
    """Unique, larger for later versions of a client, and the same on every rebuild."""
    return client.cast("bigint") * VERSION_SPAN + version


def closing_periods(spark: SparkSession, calendar: Calendar) -> DataFrame:
    """Constant table: a month, and the last valid month of a version it ends."""
    schema = struct(("date_key", "int", False), ("closes_at", "int", False))
    return inline_table(spark, schema, [(k, calendar.closing(k)) for k in calendar.keys])


def as_dimension(versions: DataFrame) -> DataFrame:
    """Complete version rows to the declared dimension columns and types."""
    full = versions.withColumns(
        {
            "customer_sk": surrogate_key(F.col("client_id"), F.col("version_num")),
            "is_current": F.col("valid_to_date") == OPEN_END,
        }
    )
    return full.select(*[F.col(c).cast(DIM_CUSTOMER[c].dataType).alias(c) for c in DIM_COLUMNS])


def stamped(dim: DataFrame) -> DataFrame:
    return dim.withColumn("created_at", utc_now())


# ── full load from the wide snapshot ─────────────────────────────────────────


def versioned_months(
    wide: DataFrame,
    calendar: Calendar,
    per_month: Callable[[Month], dict[str, str]],
    tracked: Sequence[str],
    keep: Sequence[str],
) -> DataFrame:
    """One row per client and month with its version, found inside the wide row.

    ``per_month`` gives the month's columns as SQL and ``tracked`` names those
    whose change opens a version (a column that does not vary by month cannot
    change within a row).  Adds ``date_key``, ``version_num``, ``opens`` (the
    month opens its version) and ``valid_to_date``.  No shuffle.
    """
    months = calendar.observed
    steps = range(len(months))
    cells = [per_month(m) for m in months]
    names = list(cells[0])

    def opens(i: int) -> str:
        changed = [f"NOT _m{i}_{n} <=> _m{i - 1}_{n}" for n in tracked if n in names]
        return f"{' OR '.join(changed) if i else 'true'} AS _o{i}"

    def version(i: int) -> str:
        return " + ".join(f"int(_o{j})" for j in range(i + 1)) + f" AS _v{i}"

    def valid_to(i: int) -> str:
        closing = [f"WHEN _o{j} THEN {calendar.closing(months[j].key)}" for j in steps if j > i]
        return f"CASE {' '.join(closing)} ELSE {OPEN_END} END" if closing else str(OPEN_END)

    row = [
        ", ".join([str(m.key), f"_v{i}", f"_o{i}", valid_to(i), *[f"_m{i}_{n}" for n in names]])
        for i, m in enumerate(months)
    ]
    return (
        wide.selectExpr(*keep, *[f"{c} AS _m{i}_{n}" for i in steps for n, c in cells[i].items()])
        .selectExpr("*", *[opens(i) for i in steps])
        .selectExpr("*", *[version(i) for i in steps])
        .selectExpr(
            *keep,
            f"stack({len(months)}, {', '.join(row)}) "
            f"AS (date_key, version_num, opens, valid_to_date, {', '.join(names)})",
        )
    )


def _month_columns(m: Month) -> dict[str, str]:
    columns = {n: pattern.format(m.ordinal) for n, pattern in reshape.MEASURES.items()}
    tier = classify.risk_tier_sql(columns["pay_code"], columns["bill_amount"], "limit_bal")
    return {"risk_tier": tier} | columns


def client_months(stg: DataFrame, calendar: Calendar) -> DataFrame:
    """Versioned client months of the staged snapshot, with tier and measures."""
    return versioned_months(
        reshape.resolve_codes(stg),
        calendar,
        _month_columns,
        reshape.TRACKED,
        keep=[*reshape.SNAPSHOT_KEYS, "load_batch_id"],
    )


def build_from_staging(stg: DataFrame, calendar: Calendar) -> DataFrame:
    """The whole customer dimension from the staged snapshot, without a shuffle."""
    opened = client_months(stg, calendar).filter("opens")
    return as_dimension(
        opened.withColumns(
            {
                "age_band": classify.age_band("age"),
                "row_hash": row_hash(*[F.col(c) for c in reshape.TRACKED]),
            }
        ).withColumnRenamed("date_key", "valid_from_date")
    )


# ── full load from long snapshots ────────────────────────────────────────────


def build(
    snapshots: DataFrame,
    calendar: Calendar,
    key: str = "client_id",
    period: str = "date_key",
    tracked: Sequence[str] = reshape.TRACKED,
    type1: Sequence[str] = reshape.TYPE1,
) -> DataFrame:
    """Versions from monthly snapshots; a client may miss months.

    ``snapshots`` holds at most one row per client and month, so a client has
    at most as many rows as there are months; a second row of a month is an
    error.  Type 1 columns take the latest value of a version's span, all other
    columns that of the month that opened it.  Every step is a window over the
    same client order: one shuffle, one sort.
    """
    by_client = Window.partitionBy(key).orderBy(period)
    upto = by_client.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values, latest = F.struct(*tracked), F.struct(*type1)
    before = F.lag(F.struct(F.col(period).alias("at"), values.alias("values"))).over(by_client)
    opens = (
        F.when(F.col("_before").isNull(), True)
        .when(
            F.col("_before.at") == F.col(period),
            F.raise_error(F.lit("a client has two snapshots of one month")).cast("boolean"),
        )
        .otherwise(~values.eqNullSafe(F.col("_before.values")))
    )
    numbered = (
        snapshots.withColumn("_before", before)
        .withColumn("_opens", opens)
        .withColumns(
            {
                "version_num": F.sum(F.col("_opens").cast("int")).over(upto),
                "_ends": F.coalesce(F.lead("_opens").over(by_client), F.lit(True)),
            }
        )
    )
    # Only the first and last month of a span are left: a span of one month is
    # followed by the next opening, any other by its own last month.
    edges = numbered.filter("_opens OR _ends").withColumns(
        {
            "_latest": F.when(F.col("_ends"), latest).otherwise(F.lead(latest).over(by_client)),
            "_next": F.when(F.col("_ends"), F.lead(period, 1).over(by_client)).otherwise(
                F.lead(period, 2).over(by_client)
            ),
        }
    )
    closes = closing_periods(snapshots.sparkSession, calendar).withColumnRenamed("date_key", "_at")
    carried = [c for c in snapshots.columns if c not in (key, period, *type1)]
    return (
        edges.filter("_opens")
        .join(closes, F.col("_next") == F.col("_at"), "left")
        .select(
            key,
            F.col("version_num"),
            F.col(period).alias("valid_from_date"),
            F.coalesce("closes_at", F.lit(OPEN_END)).alias("valid_to_date"),
            *carried,
            "_latest.*",
        )
    )


# ── one month at a time ──────────────────────────────────────────────────────


def apply(
    dim: DataFrame,
    snapshot: DataFrame,
    date_key: int,
    calendar: Calendar,
    type1: Sequence[str] = reshape.TYPE1,
) -> DataFrame:
    """The dimension after one month's snapshot.

    Only current versions meet the snapshot; closed versions pass through
    unread by the join.  A changed client yields its closed version and its
    new one from the same joined row.  A client without a current version gets
    one, numbered after the highest number that ``dim`` holds for it.
    """
    calendar.observed_month(date_key)
    columns = [n for n in DIM_CUSTOMER.names if n in dim.columns]
    last = dim.groupBy("client_id").agg(F.max("version_num").alias("_last"))
    c, s = joins.current_versions(dim).alias("c"), snapshot.join(last, "client_id", "left").alias("s")
    known, seen = F.col("c.client_id").isNotNull(), F.col("s.client_id").isNotNull()
    changed = seen & known & (F.col("c.row_hash") != F.col("s.row_hash"))

    def typed(values: dict[str, Column]) -> Column:
        return F.struct(*[values[n].cast(DIM_CUSTOMER[n].dataType).alias(n) for n in columns])

    kept = {n: F.col(f"c.{n}") for n in columns}
    kept["is_current"] = ~changed
    kept["valid_to_date"] = F.when(changed, calendar.closing(date_key)).otherwise(F.col("c.valid_to_date"))
    for n in type1:
        kept[n] = F.when(seen & ~changed, F.col(f"s.{n}")).otherwise(F.col(f"c.{n}"))

    version = F.coalesce(F.col("s._last"), F.lit(0)) + 1
    generated = {
        "customer_sk": surrogate_key(F.col("s.client_id"), version),
        "version_num": version,
        "valid_from_date": F.lit(date_key),
        "valid_to_date": F.lit(OPEN_END),
        "is_current": F.lit(True),
        "created_at": utc_now(),
    }
    opened = {n: generated[n] if n in generated else F.col(f"s.{n}") for n in columns}

    rows = F.array_compact(
        F.array(F.when(known, typed(kept)), F.when(seen & (~known | changed), typed(opened)))
    )
    met = c.join(s, F.col("c.client_id") == F.col("s.client_id"), "full_outer")
    closed = dim.filter(~F.col("is_current")).select(*columns)
    return closed.unionByName(met.select(F.inline(rows)))


def extend(
    dim: DataFrame,
    stg: DataFrame,
    months: Sequence[int],
    calendar: Calendar,
    type1: Sequence[str] = reshape.TYPE1,
    only_open: bool = False,
) -> DataFrame:
    """The dimension after several consecutive months of the wide snapshot, in one pass.

    The same as :func:`apply` for one month after the other.  ``dim`` is the
    dimension before the first of them (see :func:`rewind`).  All months of a
    client sit in one row next to its current version, so versions are found
    inside that row; tables bucketed by client are not exchanged.  ``only_open``
    says that ``dim`` holds current versions alone, so that it is read once.
    """
    columns = [n for n in DIM_CUSTOMER.names if n in dim.columns]
    at = [calendar.observed_month(m) for m in months]
    steps = range(len(at))
    wide = reshape.resolve_codes(stg).withColumn("age_band", classify.age_band("age"))
    tiers = {f"_t{i}": F.expr(_month_columns(m)["risk_tier"]) for i, m in enumerate(at)}
    wide = wide.select(*reshape.SNAPSHOT_KEYS, "age_band", *[t.alias(n) for n, t in tiers.items()])
    if only_open:
        c, s, last_version = dim.alias("c"), wide.alias("s"), F.col("c.version_num")
    else:
        last = dim.groupBy("client_id").agg(F.max("version_num").alias("_last"))
        c, s = joins.current_versions(dim).alias("c"), wide.join(last, "client_id", "left").alias("s")
        last_version = F.col("s._last")
    known, seen = F.col("c.client_id").isNotNull(), F.col("s.client_id").isNotNull()

    def hashed(i: int) -> Column:
        tracked = {"risk_tier": F.col(f"s._t{i}")}
        return row_hash(*[tracked.get(n, F.col(f"s.{n}")) for n in reshape.TRACKED])

    opens = {"_o0": seen & (~known | (F.col("c.row_hash") != hashed(0)))}
    opens |= {f"_o{i}": seen & (F.col(f"s._t{i}") != F.col(f"s._t{i - 1}")) for i in steps if i}
    met = c.join(s, F.col("c.client_id") == F.col("s.client_id"), "full_outer").withColumns(opens)

    def closes(from_step: int, otherwise: Column) -> Column:
        """Last valid month of a version that the next opening from a step on ends."""
        ends = [F.when(F.col(f"_o{j}"), calendar.closing(at[j].key)) for j in steps if j >= from_step]
        return F.coalesce(*ends, otherwise)

    def typed(values: dict[str, Column]) -> Column:
        values["is_current"] = values["valid_to_date"] == OPEN_END
        return F.struct(*[values[n].cast(DIM_CUSTOMER[n].dataType).alias(n) for n in columns])

    kept = {n: F.col(f"c.{n}") for n in columns}
    kept["valid_to_date"] = closes(0, F.col("c.valid_to_date"))
    for n in type1:  # the first month overwrites them unless it opens a version of its own
        kept[n] = F.when(seen & ~F.col("_o0"), F.col(f"s.{n}")).otherwise(F.col(f"c.{n}"))

    rows = [F.when(known, typed(kept))]
    version = F.coalesce(last_version, F.lit(0))
    for i, m in enumerate(at):
        version = version + F.col(f"_o{i}").cast("int")
        opened = {n: F.col(f"s.{n}") for n in columns if n in wide.columns}
        opened |= {
            "customer_sk": surrogate_key(F.col("s.client_id"), version),
            "version_num": version,
            "valid_from_date": F.lit(m.key),
            "valid_to_date": closes(i + 1, F.lit(OPEN_END)),
            "risk_tier": F.col(f"s._t{i}"),
            "row_hash": hashed(i),
            "created_at": utc_now(),
        }
        rows.append(F.when(F.col(f"_o{i}"), typed(opened)))
    found = met.select(F.inline(F.array_compact(F.array(*rows))))
    return found if only_open else dim.filter(~F.col("is_current")).select(*columns).unionByName(found)


def rewind(
    dim: DataFrame, date_key: int, calendar: Calendar, snapshots: DataFrame | None = None
) -> DataFrame:
    """The dimension as it stood before ``date_key`` was loaded.

    Versions opened in or after the month go; those the month or a later one
    closed are open again.  Type 1 values that later months overwrote are gone
    from the dimension: pass the monthly ``snapshots`` to derive them again.
    """
    calendar.observed_month(date_key)
    previous = calendar.previous(date_key)
    columns = [n for n in DIM_CUSTOMER.names if n in dim.columns]
    before = dim.filter(F.col("valid_from_date") < date_key).select(*columns)
    if previous is None:
        return before
    reopened = F.col("valid_to_date") >= previous
    restored = before.withColumns(
        {
            "is_current": F.col("is_current") | reopened,
            "valid_to_date": F.when(reopened, OPEN_END).otherwise(F.col("valid_to_date")),
        }
    )
    if snapshots is None:
        return restored
    type1 = list(reshape.TYPE1)
    latest = (
        snapshots.filter(F.col("date_key") <= previous)
        .groupBy("client_id")
        .agg(F.max_by(F.struct(*type1), "date_key").alias("_latest"))
    )
    values = {
        n: F.when(
            F.col("is_current") & F.col("_latest").isNotNull(), F.col(f"_latest.{n}")
        ).otherwise(F.col(n))
        for n in type1
    }
    return restored.join(latest, "client_id", "left").withColumns(values).select(*columns)
