"""Command line: load a warehouse, write its extracts and its data dictionary.

    python -m chronomart load       --source clients.csv --root /shared/wh
    python -m chronomart load       --source clients.csv --root /shared/wh --first 200507
    python -m chronomart extract    --root /shared/wh --out /shared/extract
    python -m chronomart dictionary --root /shared/wh --out /shared/dictionary
    python -m chronomart snapshot   --tables /data/tables --out /shared/source

``load`` ends with exit code 1 if a rule of severity ERROR fails.  With
``--first`` it loads the months from that one on again, into a warehouse that
exists.  ``--buckets`` follows the size of the source if it is not given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chronomart.operators import quality
from chronomart.plans import marts, star, warehouse
from chronomart.sources import files, storage


def load(spark: SparkSession, options: argparse.Namespace) -> int:
    root = options.root.rstrip("/")
    rows = files.read_snapshot_csv(spark, options.source)
    try:
        if options.first:
            wh = warehouse.Warehouse.open(spark, root)
            report = wh.monthly_refresh(rows, options.source, options.first)
        else:
            size = storage.input_bytes(spark, options.source)
            buckets = options.buckets or storage.bucket_count(size, spark.sparkContext.defaultParallelism)
            wh = warehouse.Warehouse(spark, storage.Layout(root, buckets))
            report = wh.full_refresh(rows, options.source, by_month=options.by_month)
    except quality.QualityGateError as failure:
        print(failure)
        return 1
    columns = ["rule_code", "severity", "verdict", "rows_checked", "rows_failed", "sample_detail"]
    quality.in_report_order(report).select(*columns).show(truncate=False)
    return 0


def extract(spark: SparkSession, options: argparse.Namespace) -> int:
    wh = warehouse.Warehouse.open(spark, options.root.rstrip("/"))
    report = quality.report(wh.quality_results())
    marts.export(marts.extracts(wh.tables(), report, wh.calendar), options.out)
    return 0


def dictionary(spark: SparkSession, options: argparse.Namespace) -> int:
    """Columns and codes; also the columns that are not stored as declared, which are printed as well."""
    wh = warehouse.Warehouse.open(spark, options.root.rstrip("/"))
    codes = warehouse.code_listing(wh.table("fact_monthly_statement"), wh.table("dim_customer"))
    drift = wh.drift()
    order = {
        "columns": [F.col("table_name"), F.col("column_id")],
        "codes": [F.col("dimension"), F.col("code")],
        "drift": [F.col("table_name"), F.col("column_name")],
    }
    marts.export({"columns": wh.data_dictionary(), "codes": codes, "drift": drift}, options.out, order.__getitem__)
    for row in drift.collect():  # a few columns at most
        print(f"{row.table_name}.{row.column_name}: declared {row.declared}, stored {row.stored}")
    return 0


def snapshot(spark: SparkSession, options: argparse.Namespace) -> int:
    files.write_csv(star.source(spark, options.tables), options.out)
    return 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chronomart")
    commands = parser.add_subparsers(required=True)
    for command, needs in [
        (load, ["source", "root"]),
        (extract, ["root", "out"]),
        (dictionary, ["root", "out"]),
        (snapshot, ["tables", "out"]),
    ]:
        sub = commands.add_parser(command.__name__)
        for option in needs:
            sub.add_argument(f"--{option}", required=True)
        sub.set_defaults(run=command)
        if command is load:
            sub.add_argument("--buckets", type=int)
            sub.add_argument("--first", type=int)
            sub.add_argument("--by-month", action="store_true")
    options = parser.parse_args(arguments)
    return options.run(SparkSession.builder.appName("chronomart").getOrCreate(), options)


if __name__ == "__main__":
    raise SystemExit(main())
