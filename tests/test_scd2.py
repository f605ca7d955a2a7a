import random
from decimal import Decimal

import pytest
from helpers import client, month_by_month, staged
from pyspark.sql import functions as F

from chronomart.operators import facts, joins, reshape, scd2
from chronomart.sources.seeds import Calendar

CALENDAR = Calendar.starting()
MONTHS = [m.key for m in CALENDAR.observed]


def long_snapshots(spark, rows):
    """Snapshot rows from dicts of client_id, date_key, tier, limit, age."""
    data = [(r["date_key"], r["client_id"], r["limit"], 1, 1, 1, r["age"], r["tier"]) for r in rows]
    frame = spark.createDataFrame(
        data,
        "date_key int, client_id bigint, limit_bal decimal(12,2), sex_key smallint, "
        "education_key smallint, marriage_key smallint, age smallint, risk_tier string",
    )
    from chronomart.functions import classify

    return reshape.with_hash(frame.withColumn("age_band", classify.age_band("age")))


def random_history(seed, clients=60, keep=0.75):
    rng = random.Random(seed)
    return [
        {
            "client_id": c,
            "date_key": m,
            "tier": rng.choice(["LOW", "LOW", "MEDIUM", "HIGH"]),
            "limit": Decimal(rng.choice([100, 100, 100, 200])).quantize(Decimal("0.01")),
            "age": 30 + c % 20 + i,
        }
        for c in range(1, clients + 1)
        for i, m in enumerate(MONTHS)
        if rng.random() < keep
    ]


def as_tuples(dim):
    rows = dim.select(
        "client_id", "version_num", "risk_tier", "limit_bal", "age", "valid_from_date", "valid_to_date"
    ).collect()
    return sorted(tuple(r) for r in rows)


def rows_of(dim):
    return sorted(tuple(r) for r in dim.select(*scd2.DIM_COLUMNS).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_month_by_month(spark, seed):
    history = random_history(seed)
    built = scd2.as_dimension(scd2.build(long_snapshots(spark, history), CALENDAR))
    assert as_tuples(built) == month_by_month(history, CALENDAR)


def test_applied_months_equal_the_full_build(spark):
    history = random_history(3, clients=25)
    snapshots = long_snapshots(spark, history).persist()
    dim = scd2.as_dimension(scd2.build(snapshots, CALENDAR)).filter("false")
    for m in MONTHS[:4]:
        dim = scd2.apply(dim, snapshots.filter(F.col("date_key") == m), m, CALENDAR)
    expected = month_by_month([h for h in history if h["date_key"] <= MONTHS[3]], CALENDAR)
    assert as_tuples(dim) == expected


def test_wide_and_long_builds_agree(spark):
    rng = random.Random(4)
    rows = [
        client(
            i,
            pays=[rng.choice([-2, -1, 0, 1, 2, None]) for _ in range(6)],
            bills=[rng.choice([0, 500, 901, 2000]) for _ in range(6)],
            education=rng.choice([0, 1, 5, 6]),
            age=rng.randint(21, 70),
        )
        for i in range(1, 80)
    ]
    stg = staged(spark, rows)
    wide = scd2.build_from_staging(stg, CALENDAR)
    long = scd2.as_dimension(scd2.build(reshape.snapshot(stg, CALENDAR), CALENDAR))
    assert rows_of(wide) == rows_of(long)
    single_pass = facts.statements_from_staging(stg, CALENDAR)
    joined = facts.statements(stg, wide, CALENDAR)
    assert single_pass.exceptAll(joined).count() == 0 and joined.exceptAll(single_pass).count() == 0
    month = facts.statements(stg, wide, CALENDAR, MONTHS[2])
    assert month.exceptAll(joined.filter(F.col("date_key") == MONTHS[2])).count() == 0


@pytest.mark.parametrize("first", [0, 1, 3, 5])
def test_several_months_at_once_equal_one_after_the_other(spark, first):
    """Changed, unchanged, new and absent clients, other ages, on a history of earlier months."""
    rng = random.Random(first)
    pick = lambda values: [rng.choice(values) for _ in range(6)]
    old = [client(i, pays=pick([0, 1, 2]), bills=pick([0, 950]), age=rng.randint(25, 65)) for i in range(1, 61)]
    new = [r | {"age": r["age"] + rng.choice([0, 5]), "limit_bal": r["limit_bal"] * rng.choice([1, 1, 2])} for r in old[10:]]
    new += [client(i, pays=pick([0, 1, 2]), bills=pick([0, 950])) for i in range(61, 71)]
    stg, months = staged(spark, new), MONTHS[first:]
    dim = scd2.build_from_staging(staged(spark, old), CALENDAR)
    before = scd2.rewind(dim, months[0], CALENDAR)
    step = before
    for m in months:
        step = scd2.apply(step, reshape.snapshot(stg, CALENDAR, m), m, CALENDAR).checkpoint()
    assert rows_of(scd2.extend(before, stg, months, CALENDAR)) == rows_of(step)
    if first:  # closed versions stay as they are, and open ones need no others
        is_open = F.col("valid_to_date") >= CALENDAR.previous(months[0])
        only = scd2.extend(scd2.rewind(dim.filter(is_open), months[0], CALENDAR), stg, months, CALENDAR, only_open=True)
        assert rows_of(only.unionByName(dim.filter(~is_open))) == rows_of(step)


def test_two_snapshots_of_one_month_are_an_error(spark):
    twice = random_history(5, clients=3, keep=1.0)
    twice.append(dict(twice[0]))
    with pytest.raises(Exception, match="two snapshots of one month"):
        scd2.build(long_snapshots(spark, twice), CALENDAR).collect()


def test_absent_client_closes_before_the_change(spark):
    history = [
        {"client_id": 1, "date_key": MONTHS[0], "tier": "LOW", "limit": Decimal("1.00"), "age": 30},
        {"client_id": 1, "date_key": MONTHS[3], "tier": "HIGH", "limit": Decimal("1.00"), "age": 31},
    ]
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, history), CALENDAR))
    spans = [(r[5], r[6]) for r in as_tuples(dim)]
    assert spans == [(MONTHS[0], MONTHS[2]), (MONTHS[3], 999912)]


def test_limit_change_opens_a_version_and_age_does_not(spark):
    history = [
        {"client_id": 1, "date_key": m, "tier": "LOW", "limit": Decimal(limit), "age": age}
        for m, limit, age in zip(MONTHS, ["1.00", "1.00", "2.00", "2.00"], [29, 30, 31, 32])
    ]
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, history), CALENDAR))
    assert [(r[1], r[4]) for r in as_tuples(dim)] == [(1, 30), (2, 32)]


def test_change_across_the_year_end(spark):
    calendar = Calendar.starting(200511)
    keys = [m.key for m in calendar.observed]
    assert keys[1:3] == [200512, 200601]
    history = [
        {"client_id": 1, "date_key": 200512, "tier": "LOW", "limit": Decimal("1.00"), "age": 30},
        {"client_id": 1, "date_key": 200601, "tier": "HIGH", "limit": Decimal("1.00"), "age": 30},
    ]
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, history), calendar))
    assert [(r[5], r[6]) for r in as_tuples(dim)] == [(200512, 200512), (200601, 999912)]


def test_same_month_again_changes_nothing(spark):
    history = random_history(6, clients=30)
    snapshots = long_snapshots(spark, history)
    upto = [h for h in history if h["date_key"] <= MONTHS[2]]
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, upto), CALENDAR))
    again = scd2.apply(dim, snapshots.filter(F.col("date_key") == MONTHS[2]), MONTHS[2], CALENDAR)
    assert rows_of(again) == rows_of(dim)


def test_client_with_closed_versions_only_goes_on_counting(spark):
    history = random_history(8, clients=5, keep=1.0)
    snapshots = long_snapshots(spark, history)
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, [h for h in history if h["date_key"] <= MONTHS[3]]), CALENDAR))
    closed = dim.withColumns({"is_current": F.lit(False), "valid_to_date": F.lit(MONTHS[3])})
    again = scd2.apply(closed, snapshots.filter(F.col("date_key") == MONTHS[4]), MONTHS[4], CALENDAR).collect()
    last = {r.client_id: r.n for r in closed.groupBy("client_id").agg(F.max("version_num").alias("n")).collect()}
    opened = {r.client_id: r.version_num for r in again if r.is_current}
    assert opened == {c: n + 1 for c, n in last.items()}
    assert len({r.customer_sk for r in again}) == len(again)


def test_rewind_restores_every_earlier_state(spark):
    history = random_history(7, clients=30)
    snapshots = long_snapshots(spark, history).persist()
    dim = scd2.as_dimension(scd2.build(snapshots, CALENDAR))
    for m in MONTHS[1::2]:
        earlier = [h for h in history if h["date_key"] < m]
        rewound = scd2.rewind(dim, m, CALENDAR, snapshots)
        assert as_tuples(rewound) == month_by_month(earlier, CALENDAR)
    assert scd2.rewind(dim, MONTHS[0], CALENDAR).count() == 0


def test_corrected_month_replaces_the_first_load(spark):
    history = random_history(8, clients=30)
    dim = scd2.as_dimension(scd2.build(long_snapshots(spark, history), CALENDAR))
    last = MONTHS[-1]
    corrected = [
        h | {"tier": "HIGH"} if h["date_key"] == last and h["client_id"] < 10 else h for h in history
    ]
    snapshots = long_snapshots(spark, corrected)
    before = scd2.rewind(dim, last, CALENDAR, snapshots)
    after = scd2.apply(before, snapshots.filter(F.col("date_key") == last), last, CALENDAR)
    assert as_tuples(after) == month_by_month(corrected, CALENDAR)


def test_unknown_codes_drop_rows(spark):
    stg = staged(
        spark, [client(1), client(2, education=9), client(3, pays=(0, 0, None, 0, 0, 12))]
    )
    dim = scd2.build_from_staging(stg, CALENDAR)
    assert {r.client_id for r in dim.collect()} == {1, 3}
    fact = facts.statements_from_staging(stg, CALENDAR)
    assert {r.client_id: r["count"] for r in fact.groupBy("client_id").count().collect()} == {1: 6, 3: 4}


def test_keys_are_stable_and_rise_with_versions(spark):
    stg = staged(spark, [client(1, pays=(0, 2, 0, 2, 0, 2)), client(2)])
    dim = scd2.build_from_staging(stg, CALENDAR).orderBy("customer_sk").collect()
    assert [r.customer_sk for r in dim] == [65536 + v for v in range(1, 7)] + [131073]
    assert [r.version_num for r in dim] == [1, 2, 3, 4, 5, 6, 1]


def test_literal_and_current_versions(spark):
    dim = scd2.build_from_staging(staged(spark, [client(1, pays=(0, 2, 2, 0, 0, 0))]), CALENDAR)
    assert [r.risk_tier for r in joins.versions_at(dim, MONTHS[2]).collect()] == ["HIGH"]
    assert [r.version_num for r in joins.current_versions(dim).collect()] == [3]
    newcomers = spark.createDataFrame([(1,), (2,)], "client_id bigint")
    assert [r.client_id for r in joins.without_current(newcomers, dim).collect()] == [2]
