import re
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from helpers import client, source
from pyspark.sql import functions as F

from chronomart import schemas
from chronomart.functions.values import new_batch_id
from chronomart.operators import audit, facts, joins, quality, scd2
from chronomart.plans import marts, star, warehouse
from chronomart.sources import publish, seeds, shared_files, staging
from chronomart.sources.storage import Layout

SMALL = "/root/testdata/sf0.001"
STORED = ["dim_customer", "fact_monthly_statement", "fact_default_outcome"]


@pytest.fixture(scope="module")
def loaded(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 4))
    wh.full_refresh(star.source(spark, SMALL), staging.HISTORY_SOURCE, 150, staging.HISTORY_BATCH)
    return wh


@pytest.fixture(scope="module")
def monthly(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 4))
    wh.full_refresh(
        star.source(spark, SMALL), staging.HISTORY_SOURCE, 150, staging.HISTORY_BATCH, by_month=True
    )
    return wh


def contents(wh):
    found = {}
    for name in STORED:
        rows = wh.table(name).drop("created_at").collect()
        found[name] = sorted(tuple(r) for r in rows)
    return found


def test_monthly_load_equals_full_load(loaded, monthly):
    assert contents(monthly) == contents(loaded)


def test_expected_volumes(loaded):
    assert {n: len(rows) for n, rows in contents(loaded).items()} == {
        "dim_customer": 555, "fact_monthly_statement": 900, "fact_default_outcome": 150,
    }
    progress = marts.load_progress(
        loaded.table("fact_monthly_statement"), loaded.table("dim_customer"), loaded.calendar
    )
    assert [r.versions for r in progress.orderBy("date_key").collect()] == [150, 232, 317, 404, 480, 555]


def test_reload_from_a_month_is_idempotent(spark, monthly):
    before = contents(monthly)
    wh = warehouse.Warehouse.open(spark, monthly.layout.root)
    old = dict(wh.versions)
    wh.load_months(staging.HISTORY_BATCH, 200507)
    assert wh.versions["dim_customer"] != old["dim_customer"]
    assert contents(wh) == before
    now, then = (
        w.layout.partitions(spark, "fact_monthly_statement", w.versions["fact_monthly_statement"])
        for w in (wh, monthly)
    )
    same = {spec for spec in now if now[spec] == then[spec]}
    assert same == {"date_key=200504", "date_key=200505", "date_key=200506"}
    assert contents(monthly) == before  # the published versions are untouched


def test_corrected_months_are_rebuilt(spark):
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0), bills=(100,) * 6) for i in range(1, 9)]
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    batch_id = new_batch_id()
    wh.full_refresh(source(spark, rows), "small", batch_id=batch_id)

    corrected = [r | {"pay_3": 0} if r["client_id"] <= 3 else r for r in rows]
    again = new_batch_id()
    report = wh.monthly_refresh(source(spark, corrected), "small", 200507, batch_id=again)
    assert report.filter("verdict = 'FAIL'").count() == 0
    audit.enforce(wh.constraints())
    assert {r.load_batch_id: r.status for r in wh.batches().collect()} == {batch_id: "SUCCEEDED", again: "SUCCEEDED"}
    assert warehouse.Warehouse.open(spark, wh.layout.root).versions == wh.versions

    fresh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    fresh.full_refresh(source(spark, corrected), "small", batch_id=again)
    found, expected = contents(wh), contents(fresh)
    batch = fresh.table("fact_monthly_statement").columns.index("load_batch_id")
    old = {r for r in found["fact_monthly_statement"] if r[batch] == batch_id}
    assert len(old) == 8 * 3  # the months before the correction keep their batch
    for state in (found, expected):
        state["fact_monthly_statement"] = sorted(r[:batch] + r[batch + 1 :] for r in state["fact_monthly_statement"])
    assert found == expected


def test_orphan_outcomes_close_the_gate(spark, monkeypatch):
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0), bills=(100,) * 6) for i in range(1, 9)]
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    wh.full_refresh(source(spark, rows), "small")
    published = dict(wh.versions)
    corrected = [r | {"pay_3": 0, "pay_4": 0} if r["client_id"] <= 3 else r for r in rows]
    monkeypatch.setattr(wh, "load_outcomes", lambda batch_id: None)
    with pytest.raises(audit.ConstraintError, match="fact_default_outcome.customer_sk FOREIGN KEY: 3"):
        wh.monthly_refresh(source(spark, corrected), "small", 200506, batch_id="late")
    assert wh.versions == published
    assert {r.status for r in wh.batches().filter("load_batch_id = 'late'").collect()} == {"FAILED"}


def version_folders(wh):
    return {n: {p.name for p in Path(wh.layout.root.removeprefix("file:"), n).iterdir()} for n in warehouse.STORED}


def test_versions_without_a_reader_are_removed(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2), retention=timedelta(0))
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0)) for i in range(1, 5)]
    wh.full_refresh(source(spark, rows), "good")
    kept = {n: {v.id} for n, v in wh.versions.items()}
    for batch in ("short", "shorter"):
        with pytest.raises(quality.QualityGateError):
            wh.full_refresh(source(spark, rows), batch, source_rows=5, batch_id=batch)
    assert version_folders(wh) == kept
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("cm_")}
    for name, version in wh.versions.items():
        assert [n for n in names if n.startswith(f"cm_{name}_") and n in {
            wh.layout.catalog_name(name, v) for v in [version]}]
    # Carried months stay where they lie; what a later version replaced goes.
    wh.monthly_refresh(source(spark, rows), "again", 200508)
    wh.monthly_refresh(source(spark, rows), "again", 200509)
    again = warehouse.Warehouse.open(spark, wh.layout.root)
    assert {n: len(x) for n, x in contents(again).items()} == {
        "dim_customer": 12, "fact_monthly_statement": 24, "fact_default_outcome": 4,
    }
    assert len(version_folders(wh)["credit_clients"]) == len(version_folders(wh)["fact_default_outcome"]) == 1


def test_a_reader_of_the_previous_state_finishes(spark):
    """Queries of a state that was opened before two refreshes still find their files."""
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0)) for i in range(1, 9)]
    wh.full_refresh(source(spark, rows), "first")
    reader = warehouse.Warehouse.open(spark.newSession(), wh.layout.root)
    opened = reader.table("dim_customer").filter("is_current").select("client_id")  # planned, not yet read
    wh.full_refresh(source(spark, rows[:4]), "second")
    wh.monthly_refresh(source(spark, rows[:4]), "third", 200508)
    assert opened.count() == 8
    assert {n: len(x) for n, x in contents(reader).items()} == {
        "dim_customer": 24, "fact_monthly_statement": 48, "fact_default_outcome": 8,
    }
    assert reader.batches().count() == 3  # logs are shared
    assert contents(warehouse.Warehouse.open(spark, wh.layout.root)) == contents(wh)

    # Once the stated time is over, the next load removes what only old states refer to.
    wh.retention = timedelta(0)
    wh.monthly_refresh(source(spark, rows[:4]), "fourth", 200508)
    assert not version_folders(wh)["fact_default_outcome"] & {reader.versions["fact_default_outcome"].id}
    assert publish.Records(spark, wh.layout.root).numbers() == [4]


def test_of_two_writers_the_second_is_refused(spark, monkeypatch):
    first = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    rows = [client(i) for i in range(1, 7)]
    first.full_refresh(source(spark, rows), "start")
    root = first.layout.root
    one, two = (warehouse.Warehouse.open(s, root) for s in (spark, spark.newSession()))
    met = threading.Barrier(2)
    original = publish.Records.publish

    def both_at_once(self, state):
        met.wait(60)  # both have written and audited their tables from the same state
        return original(self, state)

    monkeypatch.setattr(publish.Records, "publish", both_at_once)
    failures = {}

    def run(wh, name, n):
        try:
            wh.full_refresh(source(wh.spark, rows[:n]), name, batch_id=name)
        except publish.PublishConflict as error:
            failures[name] = str(error)

    threads = [threading.Thread(target=run, args=a) for a in ((one, "one", 4), (two, "two", 5))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(failures) == 1
    (loser,) = failures
    winner = {"one": one, "two": two}[{"one": "two", "two": "one"}[loser]]
    final = warehouse.Warehouse.open(spark, root)
    assert final.versions == winner.versions and final.number == 2
    assert len(contents(final)["fact_default_outcome"]) == (4 if loser == "two" else 5)
    assert {r.load_batch_id: r.status for r in final.batches().filter("source_name <> 'start'").collect()} == {
        loser: "FAILED", {"one": "two", "two": "one"}[loser]: "SUCCEEDED",
    }
    # The loser has to open the warehouse again; a batch from its old state ends before any work.
    monkeypatch.undo()
    late = {"one": one, "two": two}[loser]
    with pytest.raises(publish.PublishConflict, match="open the warehouse again"):
        late.full_refresh(source(late.spark, rows), "late")
    again = warehouse.Warehouse.open(spark, root)
    again.full_refresh(source(spark, rows), "again")
    assert again.number == 3


def test_a_record_is_created_once(spark, tmp_path):
    files = shared_files.SharedFiles(spark)
    path = f"{tmp_path}/records/000000000001.json"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(files.create(path, f"writer {i}"))) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 11 + [True]
    assert files.read(path).startswith("writer ")
    assert [e.name for e in files.entries(f"{tmp_path}/records") if not e.name.endswith(".crc")] == ["000000000001.json"]


def test_only_slices_with_changed_clients_are_written(spark):
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0), bills=(100,) * 6) for i in range(1, 201)]
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 16))
    wh.full_refresh(source(spark, rows), "start")
    before, old = contents(wh), wh.versions["dim_customer"]

    def load(name, some, first):
        wh.stage(source(spark, some), name)
        wh.load_months(name, first)

    # Nothing changes: not a file is written, every partition is carried.
    load("same", rows, 200508)
    same = wh.versions["dim_customer"]
    assert not list(Path(wh.layout.path("dim_customer", same).removeprefix("file:")).rglob("*.parquet"))
    assert contents(wh)["dim_customer"] == before["dim_customer"] and same.rows == old.rows == 600

    # Three clients get another tier in August: their slices are written, no others.
    corrected = [r | {"pay_2": 2} if r["client_id"] <= 3 else r for r in rows]
    load("late", corrected, 200508)
    new = wh.versions["dim_customer"]
    slices = {r[0] for r in spark.range(1, 4).select(wh.layout.slice_of("id")).collect()}
    files = list(Path(wh.layout.path("dim_customer", new).removeprefix("file:")).rglob("*.parquet"))
    assert {f.parent.name for f in files} == {f"client_slice={s}" for s in slices}
    # One bucket to a slice; versions that are open, or that end in July or August.
    assert len(files) <= len(slices) * 3
    carried = [spec for spec in new.carried if "valid_to_date=200505" not in spec]  # ended too early to be affected
    assert len({spec.rsplit("=")[-1] for spec in carried}) == 16 - len(slices)

    # The same rows as a load of everything, and a Type 1 change alone is a change.
    aged = [r | {"age": 60} if r["client_id"] == 9 else r for r in corrected]
    load("aged", aged, 200509)
    ages = wh.table("dim_customer").filter("client_id = 9 AND is_current").select("age", "age_band").collect()
    assert [tuple(r) for r in ages] == [(60, "60+")]
    fresh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    fresh.stage(source(spark, corrected), "fresh")
    fresh.load_all("fresh")
    drop_ages = lambda found: [r[:6] + r[8:] for r in found["dim_customer"]]
    assert drop_ages(contents(wh)) == drop_ages(contents(fresh))
    assert wh.versions["dim_customer"].rows == wh.table("dim_customer").count()


def test_clients_that_come_and_go_change_their_slices(spark):
    rows = [client(i, pays=(0, 0, 2, 2, 0, 0)) for i in range(1, 41)]
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 8))
    wh.full_refresh(source(spark, rows[:30]), "start")
    wh.stage(source(spark, rows[5:]), "others")  # five left, ten are new: the gate would count missing statements
    wh.load_months("others", 200509)
    dim = wh.table("dim_customer")
    new = dim.filter("client_id > 30").collect()
    assert len(new) == 10 and all((r.version_num, r.valid_from_date) == (1, 200509) for r in new)
    gone = dim.filter("client_id <= 5 AND is_current").collect()
    assert len(gone) == 5 and all(r.valid_from_date == 200508 for r in gone)
    assert wh.counts() == {n: wh.table(n).count() for n in warehouse.STORED}


def test_published_state_is_found_again(spark, loaded):
    again = warehouse.Warehouse.open(spark, loaded.layout.root)
    assert again.versions == loaded.versions and again.layout.buckets == 4
    assert contents(again) == contents(loaded)


def test_published_state_is_found_by_a_session_without_the_catalog(spark, monthly):
    for name, version in monthly.versions.items():
        spark.sql(f"DROP TABLE {monthly.layout.catalog_name(name, version)}")  # files stay
    again = warehouse.Warehouse.open(spark, monthly.layout.root)
    assert {n: len(rows) for n, rows in contents(again).items()} == {
        "dim_customer": 555, "fact_monthly_statement": 900, "fact_default_outcome": 150,
    }


def test_batch_log_and_results(loaded):
    (batch,) = loaded.batches().collect()
    assert (batch.status, batch.source_rows) == ("SUCCEEDED", 150)
    assert batch.finished_at >= batch.started_at
    assert loaded.quality_results(staging.HISTORY_BATCH).count() == 12
    loaded.check(staging.HISTORY_BATCH, 150)  # replaces, does not add
    assert loaded.quality_results(staging.HISTORY_BATCH).count() == 12
    loaded.check("another", 0)
    assert loaded.quality_results().count() == 24


def test_failed_batch_is_logged_and_not_published(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    good = [client(i) for i in range(1, 5)]
    wh.full_refresh(source(spark, good), "good")
    published = dict(wh.versions)

    with pytest.raises(quality.QualityGateError):
        wh.full_refresh(source(spark, good), "short", source_rows=5, batch_id="short")
    with pytest.raises(audit.ConstraintError):
        wh.full_refresh(source(spark, [*good, client(1)]), "twice", batch_id="twice")
    assert wh.versions == published
    assert warehouse.Warehouse.open(spark, wh.layout.root).versions == published
    status = {r.source_name: r.status for r in wh.batches().collect()}
    assert status == {"good": "SUCCEEDED", "short": "FAILED", "twice": "FAILED"}
    messages = {r.source_name: r.message for r in wh.batches().collect()}
    assert "FACT_ROWCOUNT" in messages["short"] and "client_id" in messages["twice"]


def test_repeated_client_is_refused_before_any_join(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    rows = [client(1) for _ in range(50)] + [client(i) for i in range(2, 100)]
    wh.stage(source(spark, rows), "b")
    for load in (wh.load_all, wh.load_months):
        with pytest.raises(audit.ConstraintError, match="client_id UNIQUE: 49"):
            load("b")
    assert set(wh.versions) == {"credit_clients"}


def test_identities(loaded):
    fact, dim, outcome = (loaded.table(n) for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome"))
    counts = marts.version_counts(dim).collect()
    assert sum(r.versions * r.customers for r in counts) == 555
    assert sum(r.customers for r in counts) == 150
    migration = marts.tier_migration(fact, dim).collect()
    assert sum(r.customer_months for r in migration) == 150 * 5
    by_month = marts.risk_tier_by_month(fact, dim, loaded.calendar).collect()
    per_month = {}
    for r in by_month:
        per_month[r.month_key] = per_month.get(r.month_key, 0) + r.customer_months
    assert set(per_month.values()) == {150} and len(per_month) == 6
    for r in by_month:
        if r.risk_tier == "HIGH":
            assert r.delinquent_months == r.customer_months
        if r.risk_tier == "LOW":
            assert r.delinquent_months == 0
    literal = {(r.risk_tier, r.customers, r.defaults) for r in marts.default_rate_by_tier(outcome, dim, 200509).collect()}
    current = {tuple(r) for r in marts.default_by_tier(outcome, dim).collect()}
    assert literal == current == {("HIGH", 14, 4), ("MEDIUM", 55, 13), ("LOW", 81, 16)}
    shares = marts.bi_migration_share(marts.tier_migration(fact, dim)).collect()
    for tier in ("LOW", "MEDIUM", "HIGH"):
        assert abs(sum(r.migration_share for r in shares if r.prev_tier == tier) - 1) < Decimal("0.00001")


def test_known_answers(loaded):
    fact, dim, outcome = (loaded.table(n) for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome"))
    matrix = [tuple(r) for r in marts.tier_migration_pct(fact, dim).collect()]
    assert [(a, b, n, float(p)) for a, b, n, p in matrix] == [
        ("LOW", "LOW", 192, 52.2), ("LOW", "MEDIUM", 142, 38.6), ("LOW", "HIGH", 34, 9.2),
        ("MEDIUM", "LOW", 155, 47.8), ("MEDIUM", "MEDIUM", 148, 45.7), ("MEDIUM", "HIGH", 21, 6.5),
        ("HIGH", "LOW", 26, 44.8), ("HIGH", "MEDIUM", 27, 46.6), ("HIGH", "HIGH", 5, 8.6),
    ]
    bands = [(r.use_band, r.customers, float(r.default_pct)) for r in marts.default_rate_by_band(fact, outcome).collect()]
    assert bands == [
        ("0-10%", 3, 0.0), ("10-30%", 51, 13.73), ("30-60%", 37, 29.73),
        ("60-90%", 11, 36.36), ("90%+", 37, 29.73), ("無額度", 11, 0.0),
    ]
    trend = [(r.late_accounts, float(r.late_pct), float(r.mean_months_late)) for r in marts.delinquency_trend(fact).collect()]
    assert trend == [(61, 40.67, 1.26), (65, 43.33, 1.20), (65, 43.33, 1.20), (64, 42.67, 1.23), (56, 37.33, 1.20), (59, 39.33, 1.27)]
    headed = marts.with_headings(marts.tier_migration_pct(fact, dim), "tier_migration_pct")
    assert headed.columns == ["前月等級", "本月等級", "客戶月數", "佔前月百分比"]


def test_reports_come_in_their_order(loaded):
    fact, dim, outcome = (loaded.table(n) for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome"))
    rates = [float(r.default_pct) for r in marts.default_rate_by_tier(outcome, dim, 200509).collect()]
    assert rates == sorted(rates, reverse=True) and len(set(rates)) == 3
    months = [r.date_key for r in marts.delinquency_trend(fact).collect()]
    assert months == sorted(months) and len(months) == 6


def test_timeline_of_one_client(loaded):
    fact, dim = loaded.table("fact_monthly_statement"), loaded.table("dim_customer")
    rows = marts.version_timeline(fact, dim, client_id=1).orderBy("date_key").collect()
    assert len(rows) == 6
    assert all(r.valid_from_date <= r.date_key <= r.valid_to_date for r in rows)


def test_no_late_account_gives_no_mean(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 1))
    wh.stage(source(spark, [client(1), client(2)]), "b")
    wh.load_all("b")
    trend = marts.delinquency_trend(wh.table("fact_monthly_statement")).collect()
    assert [(r.late_accounts, r.mean_months_late) for r in trend] == [(0, None)] * 6


# ── plans ────────────────────────────────────────────────────────────────────


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_load_from_staging_does_not_shuffle(loaded):
    stg = loaded.table("credit_clients")
    for df in (
        scd2.build_from_staging(stg, loaded.calendar),
        facts.statements_from_staging(stg, loaded.calendar),
    ):
        text = plan(df)
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
        assert len(re.findall("FileScan", text)) == 1


def test_client_joins_and_windows_are_co_located(spark, loaded):
    stg, fact, dim, outcome = (
        loaded.table(n) for n in ("credit_clients", "fact_monthly_statement", "dim_customer", "fact_default_outcome")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {
            "point in time": plan(facts.statements(stg, dim, loaded.calendar).select("customer_sk", "client_id")),
            "tiers": plan(marts.monthly_tiers(fact, dim)),
            "outcome": plan(joins.fact_to_version(outcome, joins.current_versions(dim), ["risk_tier"])),
            "orphans": plan(joins.orphan_totals(fact, dim, "customer_sk")),
            "apply": plan(scd2.apply(dim, stg.transform(lambda d: snapshot(d, loaded.calendar)), 200509, loaded.calendar)),
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name, text in plans.items():
        assert not re.search(r"Exchange hashpartitioning\((client_id|customer_sk)", text), name


def snapshot(stg, calendar):
    from chronomart.operators import reshape

    return reshape.snapshot(stg, calendar, 200509)


def test_filters_prune_partitions(loaded):
    dim, fact = loaded.table("dim_customer"), loaded.table("fact_monthly_statement")
    assert re.search(r"PartitionFilters: \[[^\]]*is_current", plan(joins.current_versions(dim)))
    assert re.search(r"PartitionFilters: \[[^\]]*valid_to_date", plan(joins.versions_at(dim, 200507)))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key", plan(fact.filter(F.col("date_key") == 200507)))


def test_fact_reports_read_only_their_columns(loaded):
    text = plan(marts.delinquency_trend(loaded.table("fact_monthly_statement")))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "pay_status_key:smallint"


def test_constant_dimensions_are_broadcast(spark, loaded):
    fact, dim, outcome = (loaded.table(n) for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.statement_star(fact, dim, seeds.all_seeds(spark, loaded.calendar), outcome))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 5 and "BroadcastNestedLoopJoin" not in text


def test_unpivot_scans_once(spark):
    from chronomart.operators import reshape

    text = plan(reshape.unpivot(star.staged(spark, SMALL), seeds.Calendar.starting().observed, ["client_id"]))
    assert len(re.findall(r"FileScan parquet \[o_", text)) == 1


def test_hot_customer_is_reduced_before_the_shuffle(spark):
    text = plan(star.staged(spark, SMALL))
    # partial aggregation sits below the first exchange of the orders
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*HashAggregate\([^\n]*partial_sum", text)
    assert len(re.findall("Exchange hashpartitioning", text)) == 1  # customers meet them by broadcast here


# ── counts taken on write ────────────────────────────────────────────────────


def test_counts_of_a_batch_come_from_its_writes(spark, loaded, monthly):
    for wh in (loaded, monthly):
        assert wh.counts() == {n: wh.table(n).count() for n in warehouse.STORED}
        assert warehouse.Warehouse.open(spark, wh.layout.root).counts() == wh.counts()
        observed = wh.observed(staging.HISTORY_BATCH)
        run = lambda **known: quality.run(wh.tables(), staging.HISTORY_BATCH, 150, wh.calendar, **known)
        scanned, known = run(), run(observed=observed)
        assert sorted(map(tuple, known.collect())) == sorted(map(tuple, scanned.collect()))
        tables = {n: wh.layout.catalog_name(n, wh.versions[n]) for n in warehouse.STORED}
        scans = lambda df, n: plan(df).count(f"{tables[n]}[")
        assert scans(scanned, "credit_clients") and scans(scanned, "fact_default_outcome")
        assert not scans(known, "credit_clients") and not scans(known, "fact_default_outcome")
        counts = wh.row_counts()
        assert not any(scans(counts, n) for n in warehouse.STORED)
        assert {r.table_name: r.row_count for r in counts.collect()} == {
            r.table_name: r.row_count
            for r in warehouse.table_row_counts(wh.tables() | {n: wh.table(n) for n in ("quality_result", "load_batch")}).collect()
        }


def test_counts_of_another_batch_are_not_taken(loaded):
    assert loaded.observed("another").staged is None
    rows = quality.run(loaded.tables(), "another", 150, loaded.calendar, loaded.observed("another")).collect()
    assert {r.rule_id: r.rows_failed for r in rows}[1] == 150


def test_source_is_counted_on_its_way_into_staging(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    wh.full_refresh(source(spark, [client(i) for i in range(1, 6)]), "counted")
    (batch,) = wh.batches().collect()
    assert (batch.status, batch.source_rows) == ("SUCCEEDED", 5)


def test_null_in_a_required_column_ends_the_write(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    with pytest.raises(Exception, match="age must not be null"):
        wh.full_refresh(source(spark, [client(1, age=None)]), "null", batch_id="null")
    assert [r.status for r in wh.batches().collect()] == ["FAILED"]


# ── batch log ────────────────────────────────────────────────────────────────


def test_a_hundred_batches_are_folded(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 1))
    rows = source(spark, [client(1)])
    wh.full_refresh(rows, "first", batch_id="batch")

    def run(i):
        wh.log_batch(f"b{i}", f"source {i}", i, "RUNNING")
        wh.log_batch(f"b{i}", f"source {i}", i, "FAILED" if i % 3 else "SUCCEEDED", "no" if i % 3 else None)

    with ThreadPoolExecutor(8) as pool:  # writers do not disturb each other
        list(pool.map(run, range(100)))
    wanted = {(f"b{i}", i, "FAILED" if i % 3 else "SUCCEEDED") for i in range(100)} | {("batch", 1, "SUCCEEDED")}
    states = lambda w: {(r.load_batch_id, r.source_rows, r.status) for r in w.batches().collect()}
    assert states(wh) == wanted
    assert len(wh.layout.log_files(spark, "load_batch")) == 202
    reader = warehouse.Warehouse.open(spark, wh.layout.root)
    wh.publish()
    assert states(wh) == wanted and states(reader) == wanted
    assert wh.state.folded and len(wh.state.covered) == 202
    wh.publish()  # a publish later the folded files are gone
    assert wh.layout.log_files(spark, "load_batch") == []
    assert states(warehouse.Warehouse.open(spark, wh.layout.root)) == wanted
    wh.full_refresh(rows, "last", batch_id="last")
    assert states(warehouse.Warehouse.open(spark, wh.layout.root)) == wanted | {("last", 1, "SUCCEEDED")}


# ── catalog ──────────────────────────────────────────────────────────────────


def test_dictionary_shows_what_is_stored(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 2))
    wh.full_refresh(source(spark, [client(i) for i in range(1, 5)]), "start")
    found = wh.schemas()
    assert {n: [(f.name, f.dataType, f.nullable) for f in s] for n, s in found.items()} == {
        n: [(f.name, f.dataType, f.nullable) for f in t.schema] for n, t in schemas.TABLES.items()
    }
    assert wh.drift().count() == 0

    # Someone writes the outcomes anew: one column of another type, one nullable, one missing, one more.
    path = wh.layout.path("fact_default_outcome", wh.versions["fact_default_outcome"])
    rows = wh.table("fact_default_outcome").collect()
    odd = spark.createDataFrame(
        [(r.outcome_sk, r.customer_sk, str(r.date_key), r.client_id, r.is_default, "x") for r in rows],
        "outcome_sk long not null, customer_sk long, date_key string not null, client_id long not null, "
        "is_default boolean not null, colour string",
    )
    odd.write.mode("overwrite").parquet(path)
    assert [tuple(r) for r in wh.drift().orderBy("column_name").collect()] == [
        ("dw.fact_default_outcome", "colour", None, "string"),
        ("dw.fact_default_outcome", "customer_sk", "bigint not null", "bigint"),
        ("dw.fact_default_outcome", "date_key", "int not null", "string not null"),
        ("dw.fact_default_outcome", "load_batch_id", "string not null", None),
    ]
    shown = {r.column_name: (r.data_type, r.nullable, r.key_role) for r in wh.data_dictionary().filter(
        "table_name = 'dw.fact_default_outcome'").collect()}
    assert shown["date_key"] == ("string", "否", "FK") and shown["customer_sk"] == ("bigint", "是", "FK")
    assert "colour" in shown and "load_batch_id" not in shown


def test_months_written_in_different_types_are_reported(spark):
    wh = warehouse.Warehouse(spark, Layout.fresh(spark, 1))
    rows = [client(i) for i in range(1, 4)]
    wh.full_refresh(source(spark, rows), "start")
    wh.monthly_refresh(source(spark, rows), "again", 200509)
    version = wh.versions["fact_monthly_statement"]
    month = f"{wh.layout.path('fact_monthly_statement', version)}/date_key=200509"
    spark.read.parquet(month).withColumn("bill_amount", F.col("bill_amount").cast("double")).checkpoint().write.mode(
        "overwrite").parquet(month)
    (row,) = wh.drift().filter("column_name = 'bill_amount'").collect()
    assert (row.declared, row.stored) == ("decimal(18,2) not null", "decimal(18,2) / double")


def test_reports_number_their_own_order(loaded):
    fact, dim, outcome = (loaded.table(n) for n in ("fact_monthly_statement", "dim_customer", "fact_default_outcome"))
    reports = {
        "tier_migration_pct": marts.tier_migration_pct(fact, dim),
        "default_rate_by_tier": marts.default_rate_by_tier(outcome, dim, 200509),
        "default_rate_by_band": marts.default_rate_by_band(fact, outcome),
        "delinquency_trend": marts.delinquency_trend(fact),
    }
    for name, report in reports.items():
        placed = marts.with_places(report, name).orderBy("place").collect()
        assert [r.place for r in placed] == list(range(1, len(placed) + 1))
        assert [tuple(r)[:-1] for r in placed] == [tuple(r) for r in report.collect()]
