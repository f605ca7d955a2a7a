"""Time the load and the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)

``full_refresh`` is the whole pipeline: stage, dimension, facts, twelve rules,
constraint audits, gate, publish; ``full_refresh_cold`` is its first run in the
session, with all class loading and compilation.  Every query is timed from building its plan
to its last row; queries on the star read the tables that ``load_star`` wrote.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from chronomart.plans import star
from chronomart.plans.queries import REGISTRY
from chronomart.sources import staging

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "stage_clients",
    "unpivot_months",
    "risk_tier_snapshot",
    "scd2_build",
    "scd2_build_gapped",
    "scd2_apply_month",
    "scd2_corrected_month",
    "fact_statement",
    "fact_statement_single_pass",
    "fact_outcome",
    "star_view",
    "overlap_pairs",
    "quality_report",
    "constraint_audit",
    "dup_keys",
    "tier_migration_pct",
    "default_rate_by_tier",
    "default_rate_by_band",
    "delinquency_trend",
    "risk_tier_by_month",
    "tier_migration",
    "default_by_tier",
    "version_counts",
    "version_timeline",
    "load_progress",
    "bi_ratios",
    "row_number_key",
    "csv_snapshot",
    "monthly_reload",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("chronomart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def full_refresh(spark: SparkSession) -> None:
    rows = star.source_rows(spark, SF_DIR)
    star.fresh_warehouse(spark, SF_DIR).full_refresh(
        star.source(spark, SF_DIR), staging.HISTORY_SOURCE, rows
    )


def main() -> None:
    spark = session()
    star.table(spark, SF_DIR, "customer").count()  # start-up of the session is not measured
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("full_refresh_cold", lambda: full_refresh(spark))
    timed("full_refresh", lambda: full_refresh(spark))
    timed("load_star", lambda: star.warehouse(spark, SF_DIR))
    for name in HEADLINES:
        timed(name, lambda: REGISTRY[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "full refresh and headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
