"""Loading a warehouse: stage, dimension, facts, audit, gate, publish.

Every load writes new table versions next to the published ones.  A numbered
record makes them visible, and only after the audits passed; of two writers that
started from one state the second is refused.  Earlier states stay readable for
a stated time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.values import new_batch_id, utc_now
from chronomart.operators import audit, facts, quality, reshape, scd2
from chronomart.schemas import LOAD_BATCH, QUALITY_RESULT, TABLES, struct
from chronomart.sources import seeds, staging
from chronomart.sources.publish import FIRST, PublishConflict, Records, State
from chronomart.sources.seeds import Calendar
from chronomart.sources.shared_files import SharedFiles
from chronomart.sources.storage import PARTITIONS, SLICE, Layout, Version

STORED = ["credit_clients", "dim_customer", "fact_monthly_statement", "fact_default_outcome"]
#: How long a state stays readable after a newer one was published.
RETENTION = timedelta(hours=24)
#: Small files of the batch log that are left before a publish folds them.
FOLD_FILES = 16


def _together(*steps: Callable[[], object]) -> list[object]:
    """Run independent steps side by side; an error of any is raised once all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


class _SeveralTypes(T.DataType):
    """Shown for a column that files hold in different types."""

    def __init__(self, names: list[str]):
        self.names = names

    def simpleString(self) -> str:  # noqa: N802
        return " / ".join(self.names)


class Warehouse:
    """One writer's or reader's view: the state it started from, and the versions that it has written since."""

    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        calendar: Calendar | None = None,
        retention: timedelta = RETENTION,
    ):
        self.spark = spark
        self.layout = layout
        self.calendar = calendar or Calendar.starting()
        self.retention = retention
        self.versions: dict[str, Version] = {}
        self.state: State | None = None
        self.staged: quality.StagedTotals | None = None
        self._written: list[tuple[str, Version]] = []

    @classmethod
    def open(
        cls, spark: SparkSession, root: str, calendar: Calendar | None = None, retention: timedelta = RETENTION
    ) -> Warehouse:
        """The last published state of the warehouse under ``root``."""
        state = Records(spark, root).last()
        if state is None:
            raise FileNotFoundError(f"no published state under {root}")
        warehouse = cls(spark, Layout(root, state.buckets), calendar, retention)
        warehouse.state, warehouse.versions = state, dict(state.versions)
        return warehouse

    @property
    def number(self) -> int:
        """The published state that this one started from."""
        return self.state.number if self.state else FIRST

    # ── tables ───────────────────────────────────────────────────────────

    def table(self, name: str) -> DataFrame:
        if name in self.versions:
            return self.layout.read(self.spark, name, self.versions[name])
        if name == "load_batch":
            return self.batches()
        if name == "quality_result":
            return self.quality_results()
        return seeds.all_seeds(self.spark, self.calendar)[name]

    def tables(self) -> dict[str, DataFrame]:
        """Seed dimensions and stored tables."""
        constant = seeds.all_seeds(self.spark, self.calendar)
        return constant | {name: self.table(name) for name in self.versions}

    def counts(self) -> dict[str, int]:
        """Rows of the stored tables, as counted while they were written."""
        return {name: version.rows for name, version in self.versions.items()}

    def _keep(self, name: str, version: Version) -> DataFrame:
        self.versions[name] = version
        self._written.append((name, version))
        return self.table(name)

    def _months_of(self, name: str) -> list[int]:
        return [m.key for m in self.calendar.observed] if name == "fact_monthly_statement" else []

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        return self._keep(name, self.layout.write(df, name, self._months_of(name)))

    # ── loads ────────────────────────────────────────────────────────────

    def stage(self, source: DataFrame, batch_id: str) -> DataFrame:
        """Full replace of staging, placed by client once for everything that follows."""
        staged = staging.stage(source, batch_id)
        self.staged = None
        return self._store(self.layout.by_client(staged), "credit_clients")

    def require_unique_clients(self, batch_id: str) -> None:
        """Refuse a batch that holds a client twice before anything is joined by client.

        Read as plain files: a bucketed read would bring all rows of a repeated
        client into one task, whereas here they are counted where they lie.  The
        rules on staging use these totals again.
        """
        files = self.layout.path("credit_clients", self.versions["credit_clients"])
        stg = self.spark.read.schema(TABLES["credit_clients"].schema).parquet(files)
        self.staged = quality.staged_totals(staging.batch(stg, batch_id))
        if self.staged.surplus:
            raise audit.ConstraintError([f"credit_clients.client_id UNIQUE: {self.staged.surplus}"])

    def load_all(self, batch_id: str) -> None:
        """All observed months at once from staging, without a further shuffle.

        Dimension and statements do not need each other, so they are written
        side by side.
        """
        self.require_unique_clients(batch_id)
        stg = staging.batch(self.table("credit_clients"), batch_id)
        dim = scd2.stamped(scd2.build_from_staging(stg, self.calendar))
        statements = facts.statements_from_staging(stg, self.calendar)
        _together(
            lambda: self._store(dim, "dim_customer"),
            lambda: self._store(statements, "fact_monthly_statement"),
        )
        self.load_outcomes(batch_id)

    def load_months(self, batch_id: str, first: int | None = None, one_by_one: bool = False) -> None:
        """The months from ``first`` (default: the oldest) on, dimension before facts.

        The dimension is wound back to before ``first``, so months that were
        loaded before may be loaded again with corrected data.  All of these
        months are found in one pass over the snapshot; ``one_by_one`` loads each
        by itself, oldest first.  The outcomes follow the dimension's new versions.
        """
        self.require_unique_clients(batch_id)
        months = [m.key for m in self.calendar.observed]
        first = months[0] if first is None else self.calendar.observed_month(first).key
        months = months[months.index(first) :]
        stg = staging.batch(self.table("credit_clients"), batch_id)
        spans = [[m] for m in months] if one_by_one else [months]
        for span in spans[:-1]:
            self._load_dimension(stg, span)
            self._load_statements(stg, span)
        self._load_dimension(stg, spans[-1])
        # Statements and outcomes follow the dimension, but not each other.
        _together(lambda: self._load_statements(stg, spans[-1]), lambda: self.load_outcomes(batch_id))

    def _load_dimension(self, stg: DataFrame, span: list[int]) -> None:
        """Rewrite the slices in which a client's versions change; carry all others.

        Versions that ended before the month that precedes ``span`` are not read.
        The rest is compared with what the snapshot makes of it by a digest for
        each slice, and only slices that differ are written.
        """
        previous = self.calendar.previous(span[0])
        base = self.versions.get("dim_customer") if previous else None
        if base is None:
            nothing = scd2.build_from_staging(stg, self.calendar).filter(F.lit(False))
            self._store(scd2.stamped(scd2.extend(nothing, stg, span, self.calendar)), "dim_customer")
            return

        def after(slices: list[int] | None = None) -> DataFrame:
            dim = self.layout.read(self.spark, "dim_customer", base, slices)
            # Wound back, all of these versions are open.
            before = scd2.rewind(dim.filter(F.col("valid_to_date") >= previous), span[0], self.calendar)
            rows = stg if slices is None else stg.filter(self.layout.slice_of().isin(slices))
            return scd2.extend(before, rows, span, self.calendar, only_open=True)

        old, new = self.table("dim_customer").filter(F.col("valid_to_date") >= previous), after()
        changed, replaced = self._changed_slices(old, new)
        if not changed:
            rows = None
        else:
            rows = new if len(changed) == self.layout.slices else after(changed)
        version = self.layout.write_changes(
            rows,
            "dim_customer",
            base,
            carry=lambda part: int(part["valid_to_date"]) < previous or int(part[SLICE]) not in changed,
            replaced=replaced,
            spark=self.spark,
        )
        self._keep("dim_customer", version)

    def _changed_slices(self, old: DataFrame, new: DataFrame) -> tuple[list[int], int]:
        """The slices whose versions differ, and the rows that they hold in ``old``.

        A slice's digest is a count and two sums over hashes of whole rows,
        whatever their order; ``old`` counts against ``new``, so equal slices come
        to nothing.  The time stamp of a row is left out: it changes nothing by itself.
        """
        row = [F.col(c) for c in scd2.DIM_COLUMNS]

        def hashes(df: DataFrame, sign: int) -> DataFrame:
            return df.select(
                self.layout.slice_of().alias("slice"),
                F.lit(sign).alias("sign"),
                F.xxhash64(*row).alias("hash"),
                F.xxhash64(F.lit("xor"), *row).alias("other"),
            )

        found = (
            hashes(old, -1)
            .unionByName(hashes(new, 1))
            .groupBy("slice")
            .agg(
                F.count_if(F.col("sign") < 0).alias("old_rows"),
                F.sum("sign").alias("more"),
                F.sum(F.col("sign") * F.col("hash").cast("decimal(20,0)")).alias("sum"),
                F.bit_xor("other").alias("xor"),
            )
            .filter("more <> 0 OR sum <> 0 OR xor <> 0")
            .collect()  # one row for each slice at most
        )
        return sorted(r["slice"] for r in found), sum(r["old_rows"] for r in found)

    def _load_statements(self, stg: DataFrame, span: list[int]) -> None:
        """The statements of the months in ``span``; those of other months are carried."""
        name = "fact_monthly_statement"
        statements = facts.statements(stg, self.table("dim_customer"), self.calendar, span)
        if name not in self.versions:
            self._store(statements, name)
            return
        version = self.layout.write_changes(
            statements,
            name,
            self.versions[name],
            carry=lambda part: int(part["date_key"]) not in span,
            months=span,
        )
        self._keep(name, version)

    def load_outcomes(self, batch_id: str) -> None:
        """Full replace of the outcome fact."""
        stg = staging.batch(self.table("credit_clients"), batch_id)
        outcomes = facts.outcomes(stg, self.table("dim_customer"), self.calendar)
        self._store(outcomes, "fact_default_outcome")

    # ── audit, gate, publish ─────────────────────────────────────────────

    def check(self, batch_id: str, expected_rows: int) -> DataFrame:
        """Run the rules and store their results, replacing earlier ones of the batch.

        Row counts come from the writes of this batch, not from another scan.
        """
        results = quality.run(self.tables(), batch_id, expected_rows, self.calendar, self.observed(batch_id))
        self.layout.replace_batch(quality.as_stored(results), "quality_result")
        return quality.report(self.quality_results(batch_id))

    def observed(self, batch_id: str) -> quality.Observed:
        """What the writes counted; staging only if its totals are those of ``batch_id``."""
        counts = self.counts()
        staged = self.staged if self.staged and self.staged.batch_id == batch_id else None
        return quality.Observed(staged, counts.get("fact_monthly_statement"), counts.get("fact_default_outcome"))

    def constraints(self, covered: audit.Covered = frozenset()) -> DataFrame:
        return audit.audit(self.tables(), STORED, covered)

    def row_counts(self) -> DataFrame:
        """Rows per table, named ``layer.table``: counted on write, or of the constant tables and logs."""
        others = {n: df for n, df in self.tables().items() if n not in self.versions}
        others |= {n: self.table(n) for n in ("quality_result", "load_batch")}
        stored = [(f"{TABLES[n].layer}.{n}", rows) for n, rows in self.counts().items()]
        schema = struct(("table_name", "string", False), ("row_count", "bigint", False))
        return seeds.inline_table(self.spark, schema, stored).unionByName(table_row_counts(others))

    # ── catalog ──────────────────────────────────────────────────────────

    def stored_schema(self, name: str) -> T.StructType:
        """Columns of a stored table: types and nullability from its files, of folder columns from the catalog.

        One footer is read for each version whose files the table refers to: the
        files of one version were written by one job.  A column that has several
        types shows them all.
        """
        version, layout = self.versions[name], self.layout
        self.table(name)  # registers it
        catalog = self.spark.table(layout.catalog_name(name, version)).schema
        folders = PARTITIONS.get(name, [])
        prefix = f"{layout.root}/{name}/"
        versions = {version.id} | {f.removeprefix(prefix).split("/")[0] for f in version.carried.values()}
        of_folders = {c.name: c.nullable for c in self.spark.catalog.listColumns(layout.catalog_name(name, version))}
        files = [s for v in sorted(versions) for s in [layout.file_schema(self.spark, f"{prefix}{v}")] if s is not None]
        fields = []
        for f in catalog:
            if f.name == SLICE:
                continue
            if f.name in folders or not files:
                fields.append(T.StructField(f.name, f.dataType, of_folders[f.name]))
                continue
            own = [s[f.name] for s in files if f.name in s.names]
            kinds = {o.dataType.simpleString(): o.dataType for o in own}
            if len(kinds) == 1:
                fields.append(T.StructField(f.name, own[0].dataType, any(o.nullable for o in own)))
            elif kinds:
                fields.append(T.StructField(f.name, _SeveralTypes(sorted(kinds)), any(o.nullable for o in own)))
        known = {f.name for f in catalog}
        fields += [o for o in (files[-1] if files else []) if o.name not in known]
        order = {n: i for i, n in enumerate(TABLES[name].schema.names)}
        return T.StructType(sorted(fields, key=lambda f: order.get(f.name, len(order))))

    def schemas(self) -> dict[str, T.StructType]:
        """Columns of all tables as they are: stored tables and logs from their files, constant ones from their rows."""
        found = {}
        for name, df in self.tables().items():
            found[name] = self.stored_schema(name) if name in self.versions else df.schema
        for name in ("quality_result", "load_batch"):
            schema = self.layout.log_schema(self.spark, name)
            declared = TABLES[name].schema
            # Results lie in folders by batch, so their files lack that column.
            found[name] = T.StructType([schema[f.name] if f.name in schema.names else f for f in declared]) if schema else declared
        return found

    def data_dictionary(self) -> DataFrame:
        """Every column with type, nullability, key role and reference, and its table's rows."""
        columns = seeds.inline_table(self.spark, DICTIONARY, dictionary_rows(self.schemas()))
        return columns.join(self.row_counts(), "table_name")

    def drift(self) -> DataFrame:
        """Columns whose stored form differs from their declaration."""
        return self.spark.createDataFrame(drift_rows(self.schemas()), DRIFT)

    def publish(self) -> None:
        """Make the current table versions the ones :meth:`open` finds, unless another writer came first."""
        folded, covered = self._fold_log()
        state = State(self.number + 1, self.layout.buckets, dict(self.versions), folded, covered)
        self.state = Records(self.spark, self.layout.root).publish(state)

    def full_refresh(
        self,
        source: DataFrame,
        source_name: str,
        source_rows: int | None = None,
        batch_id: str | None = None,
        by_month: bool = False,
    ) -> DataFrame:
        """Stage, load, audit, gate and publish; returns the quality report."""

        def load(batch_id: str) -> None:
            if by_month:
                self.versions.pop("dim_customer", None)
                self.versions.pop("fact_monthly_statement", None)
                self.load_months(batch_id, one_by_one=True)
            else:
                self.load_all(batch_id)

        return self._run(load, source, source_name, source_rows, batch_id)

    def monthly_refresh(
        self,
        source: DataFrame,
        source_name: str,
        first: int,
        source_rows: int | None = None,
        batch_id: str | None = None,
    ) -> DataFrame:
        """A whole batch that loads the months from ``first`` on, again or for the first time.

        ``source`` is the whole snapshot with corrected data.
        """

        def load(batch_id: str) -> None:
            self.load_months(batch_id, first)

        return self._run(load, source, source_name, source_rows, batch_id)

    def _run(
        self,
        load: Callable[[str], None],
        source: DataFrame,
        source_name: str,
        source_rows: int | None,
        batch_id: str | None,
    ) -> DataFrame:
        """One batch around ``load``.

        It ends as SUCCEEDED only behind the gate and as FAILED on any error, in
        which case the published state stays as it was and the batch's own
        table versions are removed.  Without ``source_rows`` the rows that the
        source delivers are counted on their way into staging.
        """
        batch_id = batch_id or new_batch_id()
        records = Records(self.spark, self.layout.root)
        if self.state is None:
            self.state = records.last()  # a full refresh may start from any state
        before, self._written = dict(self.versions), []
        self.log_batch(batch_id, source_name, source_rows, "RUNNING")
        try:
            if records.last_number() != self.number:
                raise PublishConflict(f"state {self.number} is not the last one any more: open the warehouse again")
            delivered = Observation(f"source-{batch_id}")
            self.stage(source.observe(delivered, F.count(F.lit(1)).alias("rows")), batch_id)
            source_rows = delivered.get["rows"] if source_rows is None else source_rows
            load(batch_id)
            constraints = self.constraints(audit.COVERED_BY_RULES)
            report, _ = _together(
                lambda: self.check(batch_id, source_rows), lambda: audit.enforce(constraints)
            )
            quality.gate(report)
            self.publish()
        except Exception as error:
            self.versions = before
            for name, version in self._written:
                self.layout.drop(self.spark, name, version)
            self.log_batch(batch_id, source_name, source_rows, "FAILED", str(error))
            raise
        self.log_batch(batch_id, source_name, source_rows, "SUCCEEDED")
        self.clean()
        return report

    def clean(self) -> None:
        """Remove what no readable state refers to.

        A state stays readable for ``retention`` after a newer one was
        published, and so do its tables.  Versions that were never published are
        removed after that time too: they may belong to a writer at work.
        """
        records = Records(self.spark, self.layout.root)
        readable, older = records.readable(self.retention)
        written_before = (datetime.now(timezone.utc) - self.retention).timestamp()
        records.forget(older)
        states = [self.versions, *(s.versions for s in readable)]
        for name in STORED:
            kept = [state[name] for state in states if name in state]
            self.layout.drop_others(self.spark, name, kept, written_before)

    # ── logs ─────────────────────────────────────────────────────────────

    def log_batch(
        self, batch_id: str, source_name: str, source_rows: int, status: str, message: str | None = None
    ) -> None:
        values = {
            "load_batch_id": F.lit(batch_id),
            "started_at": utc_now(),
            "finished_at": F.lit(None) if status == "RUNNING" else utc_now(),
            "source_name": F.lit(source_name),
            "source_rows": F.lit(source_rows),
            "status": F.lit(status),
            "message": F.lit(message),
        }
        row = self.spark.range(1).select(
            *[values[f.name].cast(f.dataType).alias(f.name) for f in LOAD_BATCH]
        )
        self.layout.append_log(row, "load_batch")

    def _batch_log(self) -> DataFrame:
        """All rows of the batch log: those folded by the last publish, and the small files after it."""
        log = self.layout.read_log(self.spark, "load_batch", LOAD_BATCH)
        if self.state is None or self.state.folded is None:
            return log
        # Files that were folded may still lie there; a row that is read twice changes no state.
        folded = self.spark.read.schema(LOAD_BATCH).parquet(f"{self.layout.log_path('load_batch_folded')}/{self.state.folded}")
        return log.unionByName(folded)

    def _fold_log(self) -> tuple[str | None, list[str]]:
        """Write the batches' states as one file if many small ones have gathered.

        The next record names it, so it counts once that is published.  Small
        files are deleted one publish after they were folded: whoever has opened
        the state before still reads them.
        """
        files, last = SharedFiles(self.spark), self.state
        for path in last.covered if last else []:
            files.delete(path)
        loose = self.layout.log_files(self.spark, "load_batch")
        if len(loose) < FOLD_FILES:
            return (last.folded if last else None), []
        name = new_batch_id()
        folder = self.layout.log_path("load_batch_folded")
        self.batches().coalesce(1).write.parquet(f"{folder}/{name}")
        return name, loose

    def batches(self) -> DataFrame:
        """One row per batch: its first start and its latest state."""
        later = [n for n in LOAD_BATCH.names if n not in ("load_batch_id", "started_at")]
        ended = F.col("finished_at").isNotNull()
        return (
            self._batch_log()
            .groupBy("load_batch_id")
            .agg(
                F.min("started_at").alias("started_at"),
                F.max_by(F.struct(*later), F.struct(ended, "started_at")).alias("last"),
            )
            .select("load_batch_id", "started_at", "last.*")
            .select(*LOAD_BATCH.names)
        )

    def quality_results(self, batch_id: str | None = None) -> DataFrame:
        stored = self.layout.read_log(self.spark, "quality_result", QUALITY_RESULT)
        return stored if batch_id is None else staging.batch(stored, batch_id)


# ── catalog reports ──────────────────────────────────────────────────────────


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, named ``layer.table``."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(f"{TABLES[name].layer}.{name}").alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


DICTIONARY = struct(
    ("table_name", "string", False),
    ("column_id", "int", False),
    ("column_name", "string", False),
    ("data_type", "string", False),
    ("nullable", "string", False),
    ("key_role", "string", False),
    ("reference", "string", False),
)


def dictionary_rows(found: dict[str, T.StructType]) -> list[tuple]:
    """Columns as the tables have them; keys and references, which no file holds, as declared."""
    rows = []
    for name, schema in found.items():
        spec = TABLES[name]
        for position, f in enumerate(schema, start=1):
            reference = spec.foreign_keys.get(f.name)
            is_key = f.name in spec.primary_key
            role = "PK" if is_key else "FK" if reference else ""
            rows.append(
                (
                    f"{spec.layer}.{name}",
                    position,
                    f.name,
                    f.dataType.simpleString(),
                    "是" if f.nullable else "否",
                    role,
                    f"dw.{reference}" if reference and spec.layer == "dw" else
                    f"dq.{reference}" if reference else "",
                )
            )
    return rows


DRIFT = struct(
    ("table_name", "string", False),
    ("column_name", "string", False),
    ("declared", "string", True),
    ("stored", "string", True),
)


def drift_rows(found: dict[str, T.StructType]) -> list[tuple]:
    """Columns that are not as declared: of another type or nullability, missing or undeclared."""

    def described(schema: T.StructType) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() + ("" if f.nullable else " not null") for f in schema}

    rows = []
    for name, schema in found.items():
        declared, stored = described(TABLES[name].schema), described(schema)
        for column in [*declared, *(c for c in stored if c not in declared)]:
            if declared.get(column) != stored.get(column):
                rows.append((f"{TABLES[name].layer}.{name}", column, declared.get(column), stored.get(column)))
    return rows


# Texts of the code listings.
NOT_IN_DOCUMENTATION = "（文件未定義）"


def code_listing(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Every code of the code dimensions with its meaning and the rows that carry it."""
    spark = fact.sparkSession
    used = fact.groupBy("pay_status_key").agg(F.count("*").alias("n"))
    payment = (
        seeds.dim_payment_status(spark)
        .join(used, "pay_status_key", "left")
        .select(
            F.lit("dim_payment_status").alias("dimension"),
            F.col("pay_status_code").alias("code"),
            F.coalesce("documented_desc", F.lit(NOT_IN_DOCUMENTATION)).alias("meaning"),
            F.col("common_reading").alias("remark"),
            F.coalesce("n", F.lit(0)).alias("used_by"),
        )
    )
    current = dim_customer.filter("is_current")
    listings = [payment]
    for name, dim in [
        ("education", seeds.dim_education(spark)),
        ("marriage", seeds.dim_marriage(spark)),
    ]:
        used = current.groupBy(f"{name}_key").agg(F.count("*").alias("n"))
        listings.append(
            dim.join(used, f"{name}_key", "left").select(
                F.lit(f"dim_{name}").alias("dimension"),
                F.col(f"{name}_code").alias("code"),
                F.col(f"{name}_desc").alias("meaning"),
                F.when(F.col("is_documented"), "是").otherwise("否").alias("remark"),
                F.coalesce("n", F.lit(0)).alias("used_by"),
            )
        )
    return reduce(DataFrame.unionByName, listings)
