"""CSV snapshots in and out, row-number keys, parameterised reads."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chronomart import schemas
from chronomart.sources import shared_files, storage

BROADCAST_ROWS = 200_000  # at most some ten megabytes of block or partition starts


def fixed_splits(spark: SparkSession, *paths: str) -> SparkSession:
    """A session in which files below ``paths`` are always cut into the same splits.

    Splits follow settings and the number of cores at the time of a scan.  Frames
    that are read in this session keep the values of now, whatever the caller's
    session or the cluster does later.  Splits are so large that the blocks of
    files stay below ``BROADCAST_ROWS``.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    split = own.conf.get("spark.sql.files.maxPartitionBytes")
    configured = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split))
    least = math.ceil(storage.input_bytes(spark, *paths) / (BROADCAST_ROWS // 2))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(configured, least)))
    own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def read_snapshot_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.SOURCE, key: str = "client_id"
) -> DataFrame:
    """Source snapshot with a header line; a missing key column is numbered in file order.

    All files must have the same columns in the same order; others are refused.
    """
    written = spark.read.option("header", True).csv(path).columns
    header = [written[0].lstrip("\ufeff"), *written[1:]]
    by_name = {f.name: f for f in schema}
    unknown = [c for c in header if c not in by_name]
    if unknown:
        raise ValueError(f"columns not in the declared schema: {unknown}")
    declared = T.StructType([T.StructField(c, by_name[c].dataType, True) for c in header])
    session = spark if key in header else fixed_splits(spark, path)
    reader = session.read.schema(declared).option("header", True).option("mode", "FAILFAST")
    raw = reader.option("enforceSchema", False).csv(path)
    if key not in header:
        raw = number_file_rows(raw, key)
    return raw.select(*schema.names)


def _starts(groups: DataFrame, order: list[str]) -> DataFrame:
    """``groups`` (with ``_rows`` and ``_first``) and the rows before each, less its ``_first``, as ``_shift``.

    A prefix sum in two levels: ranges of groups are summed where they lie, one
    total for each range goes through a running sum, and each range continues
    from there.
    """
    ranged = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_range", F.spark_partition_id()).checkpoint()
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = ranged.groupBy("_range").agg(F.sum("_rows").alias("_sum")).select(
        "_range", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("_before") + F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    return ranged.join(before, "_range").withColumn("_shift", earlier - F.col("_first")).drop("_range", "_before")


def _number(within: DataFrame, groups: list[str], order: list[str], key: str, columns: list[str]) -> DataFrame:
    """Number rows that carry ``_row``, rising inside each of the ``groups``, which come in ``order``.

    Only one row per group (a block of a file or a partition) is counted and
    moved.  Starts are broadcast when they are few enough.  A row whose group was
    not counted is an error: its scan was cut otherwise than the count's.
    """
    counted = within.groupBy(*groups).agg(F.count("*").alias("_rows"), F.min("_row").alias("_first")).checkpoint()
    starts = _starts(counted, order).select(*groups, "_shift").checkpoint()
    side = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    other = F.raise_error(F.lit("files were cut into other splits than when their rows were counted")).cast("bigint")
    shift = F.coalesce(F.col("_shift"), other)
    return within.join(side, groups, "left").select((F.col("_row") + shift + 1).alias(key), *columns)


def number_file_rows(df: DataFrame, key: str) -> DataFrame:
    """Add ``key`` = 1, 2, 3 ... in file order to a frame read straight from files.

    Two scans with equal splits, one to count the rows of each block, one to
    number them; no row is copied.  Read ``df`` in a session of
    :func:`fixed_splits`; in any other, splits that change in between are an error.
    """
    storage.shared_folder(df.sparkSession)
    within = df.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_length": F.col("_metadata.file_block_length"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    return _number(within, ["_part", "_file", "_start", "_length"], ["_file", "_start"], key, df.columns)


def number_rows(df: DataFrame, key: str, order_by: list[str | Column]) -> DataFrame:
    """Add ``key`` = 1, 2, 3 ... in the given order, without a single-task sort.

    The range-sorted rows are checkpointed, so that counting and numbering see
    the same partitions.
    """
    storage.shared_folder(df.sparkSession)
    ordered = df.orderBy(*order_by).checkpoint()
    within = ordered.withColumns(
        {"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
    )
    return _number(within, ["_part"], ["_part"], key, df.columns)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with a header taken from the result's own columns (no BOM), for data of any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def csv_line(df: DataFrame) -> Column:
    """A row as a line of CSV: fields with a comma, quote or line break are quoted, nulls are empty."""
    fields = []
    for f in df.schema:
        value = F.col(f"`{f.name}`").cast("string")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise TypeError(f"{f.name}: cast {f.dataType.simpleString()} to text or decimal first")
        if isinstance(f.dataType, T.BooleanType):
            value = F.initcap(value)
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        value = F.coalesce(F.when(value.rlike('[",\\r\\n]'), quoted).otherwise(value), F.lit(""))
        if len(df.columns) == 1:  # a line without any character would be no row
            value = F.when(value == "", '""').otherwise(value)
        fields.append(value)
    return F.concat_ws(",", *fields)


def write_single_csv(df: DataFrame, path: str, order_by: list[str | Column]) -> None:
    """One CSV file in a stated order, UTF-8 with a byte-order mark, one header first.

    Rows are sorted and written as parts by Spark; the parts are then joined in
    their order on the shared file system, a buffer at a time.
    """
    spark = df.sparkSession
    shared, parts = shared_files.SharedFiles(spark), f"{path}.parts-{uuid.uuid4().hex}"
    header = spark.range(1).select(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    (first,) = header.select(csv_line(header)).first()
    lines = df.orderBy(*order_by).select(csv_line(df).alias("value"))
    lines.write.option("lineSep", "\r\n").text(parts)
    try:
        found = [e.path for e in shared.entries(parts) if e.name.startswith("part-")]
        shared.join(found, path, f"\ufeff{first}\r\n".encode())
    finally:
        shared.delete(parts)


def query(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """Parameterised read; parameters are bound by name (``:name``)."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def scalar(spark: SparkSession, sql: str, **params: object) -> object:
    row = query(spark, sql, **params).first()
    return None if row is None else row[0]
