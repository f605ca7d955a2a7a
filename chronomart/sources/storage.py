"""Where tables live and how they are laid out.

Tables are Parquet in the shared folder the session names in
``spark.checkpoint.dir``.  Tables that carry a client are bucketed by
``client_id`` so that joins, windows and aggregates per client find their rows
co-located.  Statements are partitioned by month, and the customer dimension by
its current flag and the month a version ended, so month, current-version and
point-in-time filters prune whole folders.

The dimension's folders are cut once more into slices of clients, groups of whole
buckets, so that a load can leave alone the clients that it does not change.

A new version of a partitioned table writes only the partitions that change;
the others are carried over by pointing the new version at the files in place.
Rows are counted while they are written (observed metrics), so nothing has to be
read again to know a table's size.  A null in a declared NOT NULL column ends the
write with an error.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronomart.schemas import TABLES
from chronomart.sources.shared_files import SharedFiles

CLIENT = "client_id"
SLICE = "client_slice"  # a stored column of the dimension only, not part of its schema
PARTITIONS = {
    "dim_customer": ["is_current", "valid_to_date", SLICE],
    "fact_monthly_statement": ["date_key"],
}
MOST_SLICES = 256
BUCKETED = {
    "credit_clients",
    "dim_customer",
    "fact_monthly_statement",
    "fact_default_outcome",
}
BUCKET_BYTES = 1 << 30  # input behind one bucket: its staged clients make a file of about 100 MB
SPREAD_BYTES = 4 << 20  # smaller inputs are spread over the cores in pieces of this size
MAX_BUCKETS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only where nothing is set
    (a local session) a fresh temporary folder is chosen and set.
    """
    set_by_code = spark.sparkContext.getCheckpointDir()
    if set_by_code:
        return set_by_code.rstrip("/")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="chronomart-")
    spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def bucket_count(input_bytes: int, cores: int) -> int:
    """Buckets for an input: of limited size, but enough of them to use the cores."""
    by_size = math.ceil(input_bytes / BUCKET_BYTES)
    by_cores = min(cores, math.ceil(input_bytes / SPREAD_BYTES))
    return max(1, min(MAX_BUCKETS, max(by_size, by_cores)))


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths`` (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def _partition(spec: str) -> str:
    """``a=1/b=2`` -> ``a = '1', b = '2'``."""
    return ", ".join("{} = '{}'".format(*part.split("=")) for part in spec.split("/"))


@dataclass(frozen=True)
class Version:
    """One stored, immutable state of a table.

    ``carried`` names the partitions whose files belong to an earlier version
    (partition -> folder); all others are below the version's own folder.
    ``rows`` was counted while the table was written, ``month_rows`` by month
    for the statements.
    """

    id: str = field(default_factory=lambda: uuid.uuid4().hex[:16])
    carried: dict[str, str] = field(default_factory=dict)
    rows: int = 0
    month_rows: dict[str, int] = field(default_factory=dict)


def as_declared(f: StructField) -> Column:
    """A column as nullable as it is declared, so that files show the declaration and not a planner's inference.

    A null in a column that is declared NOT NULL is an error.
    """
    if f.nullable:
        # Never false, but the planner cannot know: the result may be null.
        return F.when(F.spark_partition_id() >= 0, F.col(f.name)).alias(f.name)
    missing = F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)
    # The literal is never reached; it tells the planner that the result is not null.
    kind = f.dataType.simpleString()
    never = {"string": "''", "binary": "X''", "boolean": "false", "date": "DATE'1970-01-01'", "timestamp": "TIMESTAMP'1970-01-01'"}
    return F.coalesce(F.col(f.name), missing, F.expr(f"CAST({never.get(kind, '0')} AS {kind})")).alias(f.name)


@dataclass(frozen=True)
class Layout:
    """Paths, catalog names and bucket count of one warehouse."""

    root: str
    buckets: int = 1

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = 1) -> Layout:
        return cls(f"{shared_folder(spark)}/chronomart/{uuid.uuid4().hex}", buckets)

    def path(self, table: str, version: Version) -> str:
        return f"{self.root}/{table}/{version.id}"

    def catalog_name(self, table: str, version: Version) -> str:
        return f"cm_{table}_{version.id}"

    def by_client(self, df: DataFrame) -> DataFrame:
        """Place rows by client, one task per bucket.

        A rebalance lets the adaptive planner split a partition that is too
        large (a bucket may consist of several files) and join small ones.
        """
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return df.hint("rebalance", self.buckets, CLIENT)
        return df.repartition(self.buckets, CLIENT)

    @property
    def slices(self) -> int:
        return min(self.buckets, MOST_SLICES)

    def slice_of(self, client: str = CLIENT) -> Column:
        """The slice of a client: a bucket lies in one slice as a whole."""
        bucket = F.pmod(F.hash(client), F.lit(self.buckets))  # as tables are bucketed
        return F.pmod(bucket, F.lit(self.slices)).cast("int")

    def write(self, df: DataFrame, table: str, months: Iterable[int] = ()) -> Version:
        """Write ``df`` as a new version of ``table``; rows are counted, in all and of each of ``months``.

        Rows keep the placement they arrive with: a task writes one file per
        bucket and folder it holds rows of.
        """
        version = Version()
        self._create(df.sparkSession, table, version)
        return self._insert(df, table, version, months)

    def write_changes(
        self,
        df: DataFrame | None,
        table: str,
        base: Version,
        carry: Callable[[dict[str, str]], bool],
        months: Iterable[int] = (),
        replaced: int = 0,
        spark: SparkSession | None = None,
    ) -> Version:
        """A new version from changed rows ``df`` and the ``base`` partitions to ``carry``.

        ``df`` holds all rows of the partitions that are not carried (None: there
        are none), and ``replaced`` says how many rows those held before.
        """
        spark = df.sparkSession if df is not None else spark
        kept = {
            spec: folder
            for spec, folder in self.partitions(spark, table, base).items()
            if carry(dict(part.split("=") for part in spec.split("/")))
        }
        version = Version(carried=kept)
        self._create(spark, table, version)
        if df is not None:
            version = self._insert(df, table, version, months)
        self._add(spark, self.catalog_name(table, version), kept)
        own_months = set(version.month_rows)
        month_rows = {m: n for m, n in base.month_rows.items() if m not in own_months} | version.month_rows
        rows = sum(month_rows.values()) if month_rows else base.rows - replaced + version.rows
        return replace(version, rows=rows, month_rows=month_rows)

    def _insert(self, df: DataFrame, table: str, version: Version, months: Iterable[int]) -> Version:
        spark, name = df.sparkSession, self.catalog_name(table, version)
        columns = {f.name: as_declared(f) for f in TABLES[table].schema}
        if SLICE in PARTITIONS.get(table, []):
            columns[SLICE] = self.slice_of()
        rows = df.select(*[columns[c].alias(c) for c in spark.table(name).columns])
        counted = Observation(f"{name}-rows")
        of_month = {m: F.count_if(F.col("date_key") == m).alias(f"rows_{m}") for m in months}
        observed = rows.observe(counted, F.count(F.lit(1)).alias("rows"), *of_month.values())
        observed.write.option("compression", "zstd").insertInto(name)
        found = counted.get
        return replace(version, rows=found["rows"], month_rows={str(m): found[f"rows_{m}"] for m in of_month})

    def partitions(self, spark: SparkSession, table: str, version: Version) -> dict[str, str]:
        """Folder of every partition (one per month, or per month a version ended)."""
        self.read(spark, table, version)
        own = self.path(table, version)
        specs = spark.sql(f"SHOW PARTITIONS {self.catalog_name(table, version)}").collect()
        return {spec: version.carried.get(spec, f"{own}/{spec}") for (spec,) in specs}

    def read(
        self, spark: SparkSession, table: str, version: Version, slices: Iterable[int] | None = None
    ) -> DataFrame:
        """A stored version with its declared column order; registered if the catalog lacks it.

        With ``slices`` only those of a sliced table are read.
        """
        name = self.catalog_name(table, version)
        if not spark.catalog.tableExists(name):
            self._create(spark, table, version)
            if table in PARTITIONS:
                spark.catalog.recoverPartitions(name)
                self._add(spark, name, version.carried)
        rows = spark.table(name)
        if slices is not None:
            rows = rows.filter(F.col(SLICE).isin(list(slices)))
        return rows.select(*TABLES[table].schema.names)

    def file_schema(self, spark: SparkSession, folder: str) -> StructType | None:
        """The columns that the files below a folder were written with, from the footer of one of them."""
        files = SharedFiles(spark)
        entries = [e for e in files.entries(folder) if not e.name.startswith(("_", "."))]
        for entry in entries:
            if not entry.is_folder:
                return files.parquet_schema(entry.path)
        for entry in entries:
            found = self.file_schema(spark, entry.path)
            if found is not None:
                return found
        return None

    def _create(self, spark: SparkSession, table: str, version: Version) -> None:
        folders = PARTITIONS.get(table, [])
        fields = [f"{f.name} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in TABLES[table].schema]
        columns = ", ".join([*fields, *([f"{SLICE} int NOT NULL"] if SLICE in folders else [])])
        partitioned = f"PARTITIONED BY ({', '.join(folders)})" if folders else ""
        clustered = f"CLUSTERED BY ({CLIENT}) INTO {self.buckets} BUCKETS" if table in BUCKETED else ""
        spark.sql(
            f"CREATE TABLE {self.catalog_name(table, version)} ({columns}) USING parquet "
            f"{partitioned} {clustered} LOCATION '{self.path(table, version)}'"
        )

    @staticmethod
    def _add(spark: SparkSession, name: str, folders: dict[str, str]) -> None:
        parts = " ".join(
            f"PARTITION ({_partition(spec)}) LOCATION '{folder}'" for spec, folder in folders.items()
        )
        if parts:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")

    # Clean-up.

    def drop_others(self, spark: SparkSession, table: str, kept: Iterable[Version], unless_after: float) -> None:
        """Drop the table's versions but ``kept`` and those written after a time (seconds since 1970).

        Of a dropped version the partitions stay that ``kept`` carry.  A version
        that is nowhere published may be the work of another writer, hence the
        time.  The driver lists one folder per version and partition.
        """
        prefix = f"{self.root}/{table}"
        used = {self.path(table, v) for v in kept}
        carried = {folder for v in kept for folder in v.carried.values()}
        for entry in SharedFiles(spark).entries(prefix):
            if entry.is_folder and entry.path not in used and entry.modified <= unless_after:
                self._drop(spark, table, Version(entry.name), carried)

    def drop(self, spark: SparkSession, table: str, version: Version) -> None:
        """Drop a version that nothing else refers to."""
        self._drop(spark, table, version, set())

    def _drop(self, spark: SparkSession, table: str, version: Version, carried: set[str]) -> None:
        files, folder = SharedFiles(spark), self.path(table, version)
        spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(table, version)}")
        if not any(c.startswith(f"{folder}/") for c in carried):
            files.delete(folder)
            return
        # Partition folders lie as deep as the table has partition columns; those carried elsewhere stay.
        parts = [folder]
        for _ in PARTITIONS[table]:
            parts = [e.path for p in parts for e in files.entries(p) if e.is_folder]
        for part in parts:
            if part not in carried:
                files.delete(part)

    # Small logs: append-only, so a row is either there or not.

    def log_path(self, log: str) -> str:
        return f"{self.root}/log/{log}"

    def append_log(self, df: DataFrame, log: str) -> None:
        """Add ``df`` (a few rows) to a log as one file.

        Written in a folder of its own and moved, since two writers that append
        to one folder remove each other's temporary files.
        """
        files, own = SharedFiles(df.sparkSession), uuid.uuid4().hex
        beside = f"{self.log_path('writing')}/{own}"
        df.select(*[as_declared(f) for f in TABLES[log].schema]).coalesce(1).write.parquet(beside)
        (part,) = [e.path for e in files.entries(beside) if e.name.endswith(".parquet") and not e.name.startswith(".")]
        files.move(part, f"{self.log_path(log)}/{own}.parquet")
        files.delete(beside)

    def read_log(self, spark: SparkSession, log: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(self.log_path(log))

    def log_files(self, spark: SparkSession, log: str) -> list[str]:
        """The data files of a log, as paths."""
        entries = SharedFiles(spark).entries(self.log_path(log))
        return [e.path for e in entries if not e.is_folder and not e.name.startswith(("_", "."))]

    def log_schema(self, spark: SparkSession, log: str) -> StructType | None:
        """The columns of a log as its files have them; a column is nullable if it is in any of them.

        Logs are folded, so there are a few files; of results in folders one is read.
        """
        files = SharedFiles(spark)
        schemas = [files.parquet_schema(path) for path in self.log_files(spark, log)]
        if not schemas:
            return self.file_schema(spark, self.log_path(log))
        nullable = {f.name for s in schemas for f in s if f.nullable}
        return StructType([StructField(f.name, f.dataType, f.name in nullable) for f in schemas[-1]])

    def replace_batch(self, df: DataFrame, log: str) -> None:
        """Replace the rows of the batches in ``df``, keeping all other batches."""
        (
            df.select(*[as_declared(f) for f in TABLES[log].schema])
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_batch_id")
            .parquet(self.log_path(log))
        )
