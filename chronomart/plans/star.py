"""The warehouse behind the registered queries, loaded from the order history.

The star is loaded once per session and input, into the shared folder, and the
queries then read the stored tables.  The input files' count, size and latest
change identify the input, so changed files are loaded again.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.plans.warehouse import Warehouse
from chronomart.sources import staging
from chronomart.sources.storage import Layout, bucket_count

_loaded: dict[tuple, Warehouse] = {}
_audited: set[str] = set()  # roots of loaded warehouses whose rules have run
_loading = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.source_from_order_history(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged snapshot as a plan over the input tables, nothing stored."""
    return staging.stage(source(spark, sf_dir), staging.HISTORY_BATCH)


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """File count, bytes and latest change of the input tables (contents are not read)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{sf_dir}/{name}.parquet" for name in ("customer", "orders")])
    )
    return tuple(
        files.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string")).first()
    )


def fresh_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """An empty warehouse laid out for the size of the input."""
    _, size, _ = input_state(spark, sf_dir)
    buckets = bucket_count(size or 0, spark.sparkContext.defaultParallelism)
    return Warehouse(spark, Layout.fresh(spark, buckets))


def load(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Stage and load a fresh warehouse (audits are run separately)."""
    loaded = fresh_warehouse(spark, sf_dir)
    loaded.stage(source(spark, sf_dir), staging.HISTORY_BATCH)
    loaded.load_all(staging.HISTORY_BATCH)
    return loaded


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The loaded warehouse of this session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, *input_state(spark, sf_dir))
    with _loading:
        if key not in _loaded:
            _loaded[key] = load(spark, sf_dir)
        return _loaded[key]


def source_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows the source delivers: one per customer, counted from file footers."""
    return table(spark, sf_dir, "customer").count()


def audited(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The same warehouse with its batch logged and its rule results stored."""
    loaded = warehouse(spark, sf_dir)
    if loaded.layout.root not in _audited:
        rows = source_rows(spark, sf_dir)
        loaded.log_batch(staging.HISTORY_BATCH, staging.HISTORY_SOURCE, rows, "RUNNING")
        loaded.check(staging.HISTORY_BATCH, rows)
        loaded.log_batch(staging.HISTORY_BATCH, staging.HISTORY_SOURCE, rows, "SUCCEEDED")
        _audited.add(loaded.layout.root)
    return loaded
