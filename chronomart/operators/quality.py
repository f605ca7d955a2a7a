"""The twelve batch rules, their report and the gate.

Rules that read the same table share one pass over it; every pass ends in one
row that is turned into one result row per rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.functions import classify
from chronomart.functions.values import guarded_ratio, utc_now
from chronomart.operators import joins
from chronomart.schemas import QUALITY_RESULT
from chronomart.sources import seeds
from chronomart.sources.seeds import Calendar
from chronomart.sources.staging import batch


class QualityGateError(RuntimeError):
    """At least one ERROR rule failed."""

    def __init__(self, failed: list[str]):
        super().__init__("ERROR rules failed: " + ", ".join(failed))
        self.failed = failed


@dataclass(frozen=True)
class StagedTotals:
    """A batch's rows in staging, the rows beyond one of each client, and the clients that are repeated."""

    batch_id: str | None
    rows: int
    surplus: int
    repeated: int


@dataclass(frozen=True)
class Observed:
    """Counts that were taken while tables were written; None where there are none."""

    staged: StagedTotals | None = None
    facts: int | None = None
    outcomes: int | None = None


def _per_client(rows: DataFrame) -> DataFrame:
    counted = rows.groupBy("client_id").agg(F.count("*").alias("n"), F.max("load_batch_id").alias("batch"))
    return counted.selectExpr(
        "coalesce(sum(n), 0) AS staged", "sum(n - 1) AS surplus", "count_if(n > 1) AS repeated", "max(batch) AS batch"
    )


def staged_totals(rows: DataFrame) -> StagedTotals:
    """The totals of one batch's rows, by one pass."""
    found = _per_client(rows).first()
    return StagedTotals(found["batch"], found["staged"], found["surplus"] or 0, found["repeated"])


def _results(totals: DataFrame, *rules: tuple[int, str, str, str]) -> DataFrame:
    """One-row ``totals`` -> (rule_id, rows_checked, rows_failed, sample_detail) rows.

    Counts and detail are given as SQL over ``totals``; a missing total counts 0.
    """
    cells = ", ".join(
        f"{rule_id}, bigint(coalesce({checked}, 0)), bigint(coalesce({failed}, 0)), "
        f"{detail}"
        for rule_id, checked, failed, detail in rules
    )
    names = "rule_id, rows_checked, rows_failed, sample_detail"
    return totals.selectExpr(f"stack({len(rules)}, {cells}) AS ({names})")


# The details below are fixed texts.


def staging_rules(
    stg: DataFrame, batch_id: str, expected_rows: int, staged: StagedTotals | None = None
) -> DataFrame:
    """Row count and repeated clients; without a scan if the totals are known."""
    if staged is None:
        totals = _per_client(batch(stg, batch_id))
    else:
        values = f"{staged.rows}L AS staged, {staged.surplus}L AS surplus, {staged.repeated}L AS repeated"
        totals = stg.sparkSession.sql(f"SELECT {values}")
    return _results(
        totals,
        (1, "staged", f"abs(staged - {expected_rows})",
         f"concat('來源 {expected_rows} 列，暫存區 ', staged, ' 列')"),
        (2, "staged", "surplus", "concat('重複 client_id 數：', repeated)"),
    )


def undocumented_codes(dim_customer: DataFrame) -> DataFrame:
    """Current versions per education code, with the marriage counts of the same pass."""
    spark = dim_customer.sparkSession
    education = seeds.dim_education(spark).select(
        "education_key", "education_code", F.col("is_documented").alias("education_documented")
    )
    marriage = seeds.dim_marriage(spark).select(
        "marriage_key", F.col("is_documented").alias("marriage_documented")
    )
    per_key = (
        joins.current_versions(dim_customer)
        .groupBy("education_key", "marriage_key")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_key.join(education, "education_key", "left")
        .join(marriage, "marriage_key", "left")
        .groupBy("education_code", "education_documented")
        .agg(
            F.sum("n").alias("customers"),
            F.expr("sum(n) FILTER (WHERE marriage_documented IS NOT NULL)").alias("with_marriage"),
            F.expr("sum(n) FILTER (WHERE NOT marriage_documented)").alias("marriage_undocumented"),
        )
    )


def code_rules(dim_customer: DataFrame) -> DataFrame:
    totals = undocumented_codes(dim_customer).selectExpr(
        "sum(customers) FILTER (WHERE education_code IS NOT NULL) AS with_education",
        "sum(customers) FILTER (WHERE NOT education_documented) AS education_undocumented",
        "listagg(IF(education_documented, NULL, concat('碼', education_code, '=', customers, '筆')), '　') "
        "WITHIN GROUP (ORDER BY education_code) AS labels",
        "sum(with_marriage) AS with_marriage",
        "coalesce(sum(marriage_undocumented), 0) AS marriage_undocumented",
    )
    return _results(
        totals,
        (3, "with_education", "education_undocumented",
         "concat('未定義碼值分布：', coalesce(labels, ''))"),
        (4, "with_marriage", "marriage_undocumented",
         "concat('未定義碼值筆數：', marriage_undocumented)"),
    )


def fact_rules(fact: DataFrame, expected_rows: int, months: int, rows: int | None = None) -> DataFrame:
    """Grain, negative payments and bills over the limit in one pass; the row count too, unless it is known."""
    per_grain = fact.groupBy("client_id", "date_key").agg(
        F.count("*").alias("n"),
        F.expr("count_if(payment_amount < 0)").alias("negative"),
        F.min("payment_amount").alias("lowest"),
        F.expr("count_if(bill_amount > credit_limit)").alias("over"),
        F.max(guarded_ratio(F.col("bill_amount"), F.col("credit_limit"))).alias("use"),
    )
    totals = per_grain.selectExpr(
        "coalesce(sum(n), 0) AS facts",
        "sum(n - 1) AS surplus",
        "count_if(n > 1) AS repeated",
        "sum(negative) AS negative",
        "min(lowest) AS lowest",
        "sum(over) AS over",
        "max(use) AS use",
    )
    expected = expected_rows * months
    counted = "facts" if rows is None else f"{rows}L"
    return _results(
        totals,
        (5, "facts", "surplus", "concat('違反粒度的組合數：', repeated)"),
        (7, counted, f"abs({counted} - {expected})", f"concat('預期 {expected} 列，實際 ', {counted}, ' 列')"),
        (10, "facts", "negative", "concat('最小繳款金額：', coalesce(string(lowest), ''))"),
        (11, "facts", "over",
         "concat('最大超額比：', coalesce(string(CAST(round(use, 2) AS decimal(38,15))), ''))"),
    )


def orphan_rules(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    totals = joins.orphan_totals(fact, dim_customer, "customer_sk")
    return _results(totals, (6, "rows_checked", "rows_failed", "'孤兒 customer_sk 筆數'"))


def version_rules(dim_customer: DataFrame) -> DataFrame:
    pairs = joins.overlap_counts(
        dim_customer, "client_id", "valid_from_date", "valid_to_date"
    ).selectExpr("sum(intervals) AS versions", "coalesce(sum(overlapping_pairs), 0) AS pairs")
    current = (
        dim_customer.groupBy("client_id")
        .agg(F.count_if("is_current").alias("current"))
        .selectExpr("count(client_id) AS clients", "count_if(current <> 1) AS bad")
    )
    return _results(pairs, (8, "versions", "pairs", "concat('重疊版本組數：', pairs)")).unionByName(
        _results(current, (9, "clients", "bad", "concat('當前版本數 <> 1 的客戶數：', bad)"))
    )


def outcome_rules(outcome: DataFrame, expected_rows: int, rows: int | None = None) -> DataFrame:
    known = None if rows is None else outcome.sparkSession.sql(f"SELECT {rows}L AS outcomes")
    return _results(
        outcome.selectExpr("count(*) AS outcomes") if known is None else known,
        (12, str(expected_rows), f"abs({expected_rows} - outcomes)", "concat('違約結果列數：', outcomes)"),
    )


def run(
    tables: dict[str, DataFrame],
    batch_id: str,
    expected_rows: int,
    calendar: Calendar,
    observed: Observed = Observed(),
) -> DataFrame:
    """All rules for one batch: rule_id, load_batch_id, rows_checked, rows_failed, sample_detail.

    The rules that reconcile counts (staging, statements, outcomes) take them
    from ``observed`` where they were taken on write; else they scan.
    """
    fact, dim = tables["fact_monthly_statement"], tables["dim_customer"]
    parts = [
        staging_rules(tables["credit_clients"], batch_id, expected_rows, observed.staged),
        code_rules(dim),
        fact_rules(fact, expected_rows, len(calendar.observed), observed.facts),
        orphan_rules(fact, dim),
        version_rules(dim),
        outcome_rules(tables["fact_default_outcome"], expected_rows, observed.outcomes),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("load_batch_id", F.lit(batch_id))


def as_stored(results: DataFrame) -> DataFrame:
    """Complete rule results to the declared result table."""
    return results.withColumns(
        {"result_id": F.xxhash64("load_batch_id", "rule_id"), "checked_at": utc_now()}
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUALITY_RESULT])


def report(results: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Results with their rule's texts and the verdict."""
    rules = seeds.quality_rule(results.sparkSession) if rules is None else rules
    stamped = ["checked_at"] if "checked_at" in results.columns else []
    return (
        results.join(rules, "rule_id")
        .withColumn("verdict", classify.verdict(F.col("severity"), F.col("rows_failed")))
        .select(
            "rule_code",
            "severity",
            "target_object",
            "rows_checked",
            "rows_failed",
            "verdict",
            "sample_detail",
            "load_batch_id",
            *stamped,
            "description",
        )
    )


def in_report_order(report_rows: DataFrame) -> DataFrame:
    return report_rows.orderBy(
        classify.ranked(F.col("verdict"), ["FAIL", "WARN", "PASS"]), "rule_code"
    )


def gate_counts(report_rows: DataFrame) -> DataFrame:
    """Verdicts per severity and whether the batch passes the gate."""
    return report_rows.agg(
        *[
            F.count_if(F.col("verdict") == v).alias(f"{v.lower()}_rules")
            for v in ("PASS", "WARN", "FAIL")
        ],
        *[
            F.count_if(F.col("severity") == s).alias(f"{s.lower()}_severity")
            for s in ("ERROR", "WARN", "INFO")
        ],
    ).withColumn("gate_open", (F.col("fail_rules") == 0).cast("int"))


def gate(report_rows: DataFrame) -> None:
    """Raise if an ERROR rule failed; WARN passes.  Reads at most one row per rule."""
    failed = [r[0] for r in report_rows.filter("verdict = 'FAIL'").select("rule_code").collect()]
    if failed:
        raise QualityGateError(sorted(failed))
