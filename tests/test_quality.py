import random
from decimal import Decimal

import pytest
from helpers import BATCH, client, staged
from pyspark.sql import functions as F

from chronomart.operators import audit, facts, joins, quality, scd2
from chronomart.schemas import DIM_CUSTOMER
from chronomart.sources import seeds
from chronomart.sources.seeds import Calendar

CALENDAR = Calendar.starting()


def star(spark, clients):
    stg = staged(spark, clients)
    dim = scd2.build_from_staging(stg, CALENDAR)
    return seeds.all_seeds(spark, CALENDAR) | {
        "credit_clients": stg,
        "dim_customer": dim,
        "fact_monthly_statement": facts.statements_from_staging(stg, CALENDAR),
        "fact_default_outcome": facts.outcomes(stg, dim, CALENDAR),
    }


def failed(tables, expected):
    rows = quality.run(tables, BATCH, expected, CALENDAR).collect()
    return {r.rule_id: (r.rows_checked, r.rows_failed, r.sample_detail) for r in rows}


CLEAN = [client(i, pays=(0, 0, 2, 2, 0, 0), bills=(100,) * 6, paid=(10,) * 6) for i in range(1, 5)]


def test_clean_batch_passes(spark):
    tables = star(spark, CLEAN)
    found = failed(tables, 4)
    assert sorted(found) == list(range(1, 13))
    assert all(bad == 0 for _, bad, _ in found.values())
    assert found[1] == (4, 0, "來源 4 列，暫存區 4 列")
    assert found[3] == (4, 0, "未定義碼值分布：")
    assert found[7] == (24, 0, "預期 24 列，實際 24 列")
    assert found[10][2] == "最小繳款金額：10.00"
    assert found[11] == (24, 0, "最大超額比：0.100000000000000")
    report = quality.report(quality.run(tables, BATCH, 4, CALENDAR))
    quality.gate(report)
    assert quality.gate_counts(report).first().asDict() == {
        "pass_rules": 12, "warn_rules": 0, "fail_rules": 0,
        "error_severity": 8, "warn_severity": 4, "info_severity": 0, "gate_open": 1,
    }


def test_missing_rows(spark):
    found = failed(star(spark, CLEAN[:3]), 4)
    assert [found[r][1] for r in (1, 7, 12)] == [1, 6, 1]


def test_source_problems_warn(spark):
    clients = [
        client(1, education=5), client(2, education=0), client(3, education=5, marriage=0),
        client(4, bills=(0, 0, 0, 0, 0, 1500), paid=(0, 0, 0, 0, 0, -7)),
    ]
    tables = star(spark, clients)
    found = failed(tables, 4)
    assert found[3] == (4, 3, "未定義碼值分布：碼0=1筆　碼5=2筆")
    assert found[4] == (4, 1, "未定義碼值筆數：1")
    assert found[10] == (24, 1, "最小繳款金額：-7.00")
    assert found[11] == (24, 1, "最大超額比：1.500000000000000")
    report = quality.report(quality.run(tables, BATCH, 4, CALENDAR))
    verdicts = {r.rule_code: r.verdict for r in report.collect()}
    assert sorted(c for c, v in verdicts.items() if v == "WARN") == [
        "DIM_EDU_UNDOCUMENTED", "DIM_MAR_UNDOCUMENTED", "FACT_BILL_OVER_LIMIT", "FACT_NEG_PAYMENT",
    ]
    quality.gate(report)  # warnings pass
    ordered = [r.verdict for r in quality.in_report_order(report).collect()]
    assert ordered == ["WARN"] * 4 + ["PASS"] * 8


def test_duplicate_clients_and_facts(spark):
    tables = star(spark, CLEAN)
    stg, fact = tables["credit_clients"], tables["fact_monthly_statement"]
    tables["credit_clients"] = stg.unionByName(stg.filter("client_id <= 2")).unionByName(
        stg.filter("client_id = 1")
    )
    tables["fact_monthly_statement"] = fact.unionByName(fact.filter("client_id = 1 AND date_key = 200504"))
    found = failed(tables, 4)
    assert found[2] == (7, 3, "重複 client_id 數：2")
    assert found[5] == (25, 1, "違反粒度的組合數：1")
    report = quality.report(quality.run(tables, BATCH, 4, CALENDAR))
    with pytest.raises(quality.QualityGateError) as caught:
        quality.gate(report)
    assert {"STG_PK_UNIQUE", "FACT_GRAIN"} <= set(caught.value.failed)


def test_orphan_facts(spark):
    tables = star(spark, CLEAN)
    tables["fact_monthly_statement"] = tables["fact_monthly_statement"].withColumn(
        "customer_sk", F.when(F.col("date_key") == 200505, F.lit(-1)).otherwise(F.col("customer_sk"))
    )
    assert failed(tables, 4)[6][:2] == (24, 4)


def test_facts_with_the_key_of_another_client_are_orphans(spark):
    tables = star(spark, CLEAN)
    fact, dim = tables["fact_monthly_statement"], tables["dim_customer"]
    other = dim.agg(F.max("customer_sk")).first()[0]
    owner = dim.filter(F.col("customer_sk") == other).first().client_id
    victim = fact.filter(F.col("client_id") != owner).agg(F.min("client_id")).first()[0]
    wrong = fact.withColumn("customer_sk", F.when(F.col("client_id") == victim, F.lit(other)).otherwise(F.col("customer_sk")))
    lost = fact.count() - joins.fact_to_version(wrong, dim, ["risk_tier"]).count()
    tables["fact_monthly_statement"] = wrong
    assert lost > 0 and failed(tables, 4)[6][:2] == (24, lost)
    rows = audit.audit(tables, ["fact_monthly_statement"]).filter("kind = 'FOREIGN KEY' AND constrained = 'customer_sk'")
    assert rows.first().rows_failed == lost


def versions(spark, spans):
    """A dimension of given (client, version, from, to, current)."""
    rows = [
        (c * 65536 + v, c, Decimal("1.00"), 1, 1, 1, 30, "30-39", "LOW", a, b, cur, v, b"x" * 32)
        for c, v, a, b, cur in spans
    ]
    schema = type(DIM_CUSTOMER)(DIM_CUSTOMER.fields[:-1])
    return spark.createDataFrame(rows, schema)


def test_overlap_counts_pairs_and_current_versions(spark):
    dim = versions(
        spark,
        [
            (1, 1, 200504, 200506, False), (1, 2, 200506, 999912, True),
            (2, 1, 200504, 200508, False), (2, 2, 200505, 200508, False), (2, 3, 200506, 999912, True),
            (3, 1, 200504, 999912, True), (3, 2, 200504, 999912, True),
            (4, 1, 200504, 200505, False),
        ],
    )
    rows = {r.rule_id: r for r in quality.version_rules(dim).collect()}
    assert (rows[8].rows_checked, rows[8].rows_failed) == (8, 1 + 3 + 1)
    assert (rows[9].rows_checked, rows[9].rows_failed) == (4, 2)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlap_counts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    spans = [(rng.choice([0, 0, 0, 1, 2]), rng.randint(1, 9), rng.randint(1, 9)) for _ in range(60)]
    frame = spark.createDataFrame(spans, "k int, s int, e int")
    got = {
        r.k: (r.intervals, r.overlapping_pairs) for r in joins.overlap_counts(frame, "k", "s", "e").collect()
    }
    for k in {x[0] for x in spans}:
        mine = [x for x in spans if x[0] == k]
        pairs = sum(
            a[1] <= b[2] and b[1] <= a[2] for i, a in enumerate(mine) for b in mine[i + 1 :]
        )
        assert got[k] == (len(mine), pairs)


def test_empty_input_counts_zero(spark):
    tables = {
        n: df.filter("false") if n in ("credit_clients", "dim_customer", "fact_monthly_statement", "fact_default_outcome") else df
        for n, df in star(spark, CLEAN).items()
    }
    found = failed(tables, 0)
    assert all((checked, bad) == (0, 0) for checked, bad, _ in found.values())
    assert found[10][2] == "最小繳款金額："


def test_info_rule_with_failures_warns(spark):
    rules = seeds.quality_rule(spark).withColumn("severity", F.lit("INFO"))
    report = quality.report(quality.run(star(spark, CLEAN[:3]), BATCH, 4, CALENDAR), rules)
    assert {r.verdict for r in report.collect()} == {"PASS", "WARN"}


def test_constraints_hold_and_each_kind_is_caught(spark):
    tables = star(spark, CLEAN)
    tables["dim_customer"] = scd2.stamped(tables["dim_customer"])
    stored = ["dim_customer", "fact_monthly_statement", "fact_default_outcome"]
    audit.enforce(audit.audit(tables, stored))

    dim = tables["dim_customer"]
    broken = (
        dim.unionByName(dim.filter("client_id = 1"))  # every uniqueness
        .withColumn("sex_key", F.when(F.col("client_id") == 2, 9).otherwise(F.col("sex_key")).cast("smallint"))
        .withColumn("age", F.when(F.col("client_id") != 3, F.col("age")))
        .withColumn("customer_sk", F.col("customer_sk") + F.when(F.col("client_id") == 4, 7).otherwise(0))
    )
    rows = audit.audit_table(
        audit.TABLES["dim_customer"], tables | {"dim_customer": broken}
    ).filter("rows_failed > 0")
    kinds = {(r.kind, r.constrained) for r in rows.collect()}
    assert kinds == {
        ("PRIMARY KEY", "client_id,version_num"), ("UNIQUE", "client_id,valid_from_date"),
        ("UNIQUE CURRENT", "client_id"), ("FOREIGN KEY", "sex_key"), ("NOT NULL", "age"),
        ("KEY FORMULA", "customer_sk"),
    }
    with pytest.raises(audit.ConstraintError, match="customer_sk"):
        audit.enforce(audit.audit(tables | {"dim_customer": broken}, stored))


def test_check_constraint(spark):
    rules = seeds.quality_rule(spark).withColumn(
        "severity", F.when(F.col("rule_id") == 1, "FATAL").otherwise(F.col("severity"))
    )
    rows = audit.audit({"quality_rule": rules}).filter("rows_failed > 0").collect()
    assert [(r.kind, r.constrained, r.rows_failed) for r in rows] == [("CHECK", "severity", 1)]


def test_a_table_is_scanned_once_besides_its_references(spark, tmp_path):
    tables = star(spark, CLEAN)
    tables["dim_customer"] = scd2.stamped(tables["dim_customer"])
    for name in ("credit_clients", "dim_customer", "fact_monthly_statement", "fact_default_outcome"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    names = ["credit_clients", "dim_customer", "fact_monthly_statement", "fact_default_outcome"]
    plan = audit.audit(tables, names)._jdf.queryExecution().executedPlan().toString()
    # two facts refer to the dimension: each is read once more, and the dimension with each
    assert plan.count("FileScan") == 4 + 2 * 2
    assert audit.audit(tables, names).filter("rows_failed > 0").count() == 0
