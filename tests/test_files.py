import csv
from datetime import date
from decimal import Decimal

import pytest
from helpers import client, source, staged
from pyspark.sql import functions as F

from chronomart import schemas
from chronomart.sources import files, staging, storage

CLIENTS = [client(i, pays=(i % 3,) * 6, bills=(i,) * 6) for i in range(1, 41)]


def test_csv_round_trip(spark, tmp_path):
    frame = source(spark, CLIENTS)
    files.write_csv(frame.repartition(3), str(tmp_path / "out"))
    back = files.read_snapshot_csv(spark, str(tmp_path / "out"))
    assert back.schema.names == schemas.SOURCE.names
    assert back.exceptAll(frame).count() == 0 and frame.exceptAll(back).count() == 0


def test_missing_key_is_numbered_in_file_order(spark, tmp_path):
    names = schemas.SOURCE.names[1:]
    for part in range(3):
        lines = [",".join(names)]
        for c in CLIENTS[part * 10 : part * 10 + 10]:
            lines.append(",".join(str(c[n]) for n in names))
        text = "\n".join(lines) + "\n"
        (tmp_path / f"part-{part}.csv").write_text("﻿" + text if part == 0 else text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # several blocks per file
    try:
        got = files.read_snapshot_csv(spark, str(tmp_path)).select("client_id", "bill_amt1").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.client_id, r.bill_amt1) for r in got) == [
        (i, Decimal(i).quantize(Decimal("0.01"))) for i in range(1, 31)
    ]


def test_numbers_survive_other_splits(spark, tmp_path):
    names = schemas.SOURCE.names[1:]
    lines = [",".join(names)] + [",".join(str(c[n]) for n in names) for c in CLIENTS * 50]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = files.read_snapshot_csv(spark, str(tmp_path)).select("client_id", "bill_amt1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # between planning and reading
        got = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.client_id, int(r.bill_amt1)) for r in got) == [(i + 1, i % 40 + 1) for i in range(2000)]


def csv_of(tmp_path, n):
    names = schemas.SOURCE.names[1:]
    lines = [",".join(names)] + [",".join(str(c[n]) for n in names) for c in CLIENTS * (n // 40)]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_numbering_reads_the_files_and_copies_no_row(spark, tmp_path):
    numbered = files.read_snapshot_csv(spark, csv_of(tmp_path, 400))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    # Only block starts come from stored rows.
    assert "bill_amt1" in plan and not [x for x in plan.splitlines() if "ExistingRDD" in x and "bill_amt1" in x]


def test_other_splits_outside_a_fixed_session_are_an_error(spark, tmp_path):
    path = csv_of(tmp_path, 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = spark.read.schema("limit_bal string").option("header", True).csv(path)
        assert sorted(r.n for r in files.number_file_rows(rows, "n").collect()) == list(range(1, 2001))
        numbered = files.number_file_rows(rows, "n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")  # between counting and numbering
        with pytest.raises(Exception, match="other splits"):
            numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fixed_splits_bound_the_blocks(spark, tmp_path, monkeypatch):
    path = csv_of(tmp_path, 2000)
    monkeypatch.setattr(files, "BROADCAST_ROWS", 8)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        own = files.fixed_splits(spark, path)
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        rows = own.read.schema("limit_bal string").option("header", True).csv(path)
        assert rows.rdd.getNumPartitions() <= 8
        assert sorted(r.n for r in files.number_file_rows(rows, "n").collect()) == list(range(1, 2001))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def python_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(rows)
    return path.read_bytes()


def test_single_file_equals_a_python_writer(spark, tmp_path):
    rows = [
        (3, "無額度", Decimal("1.50"), date(2005, 4, 1), True),
        (1, 'a "quoted", field', Decimal("-0.01"), None, False),
        (2, "line\nbreak\rand more", None, date(2005, 5, 1), None),
        (5, "", Decimal("100.00"), date(2005, 6, 1), True),
        (4, None, Decimal("0.00"), date(2005, 7, 1), True),
        (6, " spaces , \t", Decimal("7.00"), date(2005, 8, 1), False),
    ]
    frame = spark.createDataFrame(rows, "`k,1` int, text string, amount decimal(18,2), day date, flag boolean").repartition(4)
    files.write_single_csv(frame, f"{tmp_path}/out.csv", ["`k,1`"])
    expected = python_csv(tmp_path / "python.csv", frame.columns, sorted(rows))
    assert (tmp_path / "out.csv").read_bytes() == expected
    files.write_single_csv(frame.limit(0), f"{tmp_path}/out.csv", ["`k,1`"])  # replaces it
    assert (tmp_path / "out.csv").read_bytes() == python_csv(tmp_path / "python.csv", frame.columns, [])
    one = spark.createDataFrame([("",), (None,), ("b",)], "only string")
    files.write_single_csv(one, f"{tmp_path}/one.csv", [F.col("only").asc_nulls_first()])
    assert (tmp_path / "one.csv").read_bytes() == python_csv(tmp_path / "python.csv", ["only"], [(None,), ("",), ("b",)])
    assert not [p for p in tmp_path.iterdir() if "parts" in p.name]


def test_single_file_keeps_the_order_of_many_parts(spark, tmp_path):
    frame = spark.range(0, 5000, 1, 9).select((F.col("id") * 7919 % 5000).alias("v"))
    files.write_single_csv(frame, f"{tmp_path}/out.csv", [F.desc("v")])
    assert (tmp_path / "out.csv").read_bytes() == python_csv(tmp_path / "python.csv", ["v"], [(4999 - i,) for i in range(5000)])
    with pytest.raises(TypeError, match="cast double"):
        files.write_single_csv(frame.select(F.col("v").cast("double")), f"{tmp_path}/bad.csv", ["v"])


def test_files_with_other_column_orders_are_refused(spark, tmp_path):
    names = schemas.SOURCE.names
    for part in range(2):
        order = list(names)
        if part:
            a, b = order.index("sex"), order.index("education")
            order[a], order[b] = order[b], order[a]
        row = [str(CLIENTS[part][n]) for n in order]
        (tmp_path / f"part-{part}.csv").write_text(",".join(order) + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_snapshot_csv(spark, str(tmp_path)).collect()


def test_orders_outside_the_calendar_are_an_error(spark):
    orders = spark.createDataFrame(
        [(1, "F", 10.0, date(2002, 1, 1), "1-URGENT")],
        "o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
    )
    customer = spark.createDataFrame([(1, 5.0, 3)], "c_custkey long, c_acctbal double, c_nationkey int")
    with pytest.raises(Exception, match="order outside the calendar: 2002-01-01"):
        staging.source_from_order_history(customer, orders).collect()
    inside = orders.withColumn("o_orderdate", F.lit(date(2001, 1, 1)))
    assert staging.source_from_order_history(customer, inside).count() == 1


def test_malformed_value_fails(spark, tmp_path):
    names = schemas.SOURCE.names
    row = [str(CLIENTS[0][n]) for n in names]
    row[names.index("age")] = "unknown"
    (tmp_path / "bad.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_snapshot_csv(spark, str(tmp_path)).collect()


def test_undeclared_column_is_refused(spark, tmp_path):
    (tmp_path / "odd.csv").write_text("client_id,colour\n1,red\n")
    with pytest.raises(ValueError, match="colour"):
        files.read_snapshot_csv(spark, str(tmp_path))


@pytest.mark.parametrize("broadcast", [0, files.BROADCAST_ROWS])
def test_rows_numbered_in_given_order(spark, monkeypatch, broadcast):
    monkeypatch.setattr(files, "BROADCAST_ROWS", broadcast)
    frame = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    got = files.number_rows(frame, "n", [F.desc("v")]).collect()
    assert sorted((r.n, r.v) for r in got) == [(i + 1, 999 - i) for i in range(1000)]


def test_staging_is_typed_and_stamped(spark):
    stg = staged(spark, [client(1, default=1), client(2)])
    assert [(f.name, f.dataType) for f in stg.schema] == [
        (f.name, f.dataType) for f in schemas.STG_CREDIT_CLIENTS
    ]
    flags = {r.client_id: r.default_next_month for r in stg.collect()}
    assert flags == {1: True, 2: False}
    assert staging.batch(stg, "other").count() == 0


def test_parameterised_read(spark):
    assert files.scalar(spark, "SELECT max(id) FROM range(10) WHERE id < :top", top=7) == 6
    assert files.scalar(spark, "SELECT 1 WHERE false") is None


def test_bucket_count_follows_input_size():
    assert storage.bucket_count(0, 8) == 1
    assert storage.bucket_count(3 << 20, 8) == 1
    assert storage.bucket_count(1 << 30, 8) == 8
    assert storage.bucket_count(100 << 40, 8000) == storage.MAX_BUCKETS
