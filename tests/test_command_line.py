import csv
from pathlib import Path

from helpers import client, source

from chronomart.__main__ import main
from chronomart.sources import files


def rows(folder: Path) -> list[dict]:
    with open(f"{folder}.csv", encoding="utf-8-sig", newline="") as f:
        return list(csv.DictReader(f))


def test_load_extract_and_dictionary(spark, tmp_path):
    clients = [client(i, pays=(0, 0, 2, 2, 0, 0), bills=(100,) * 6) for i in range(1, 6)]
    files.write_csv(source(spark, clients), f"{tmp_path}/source")
    root = f"{tmp_path}/wh"
    assert main(["load", "--source", f"{tmp_path}/source", "--root", root, "--buckets", "2"]) == 0
    assert main(["extract", "--root", root, "--out", f"{tmp_path}/extract"]) == 0
    assert main(["dictionary", "--root", root, "--out", f"{tmp_path}/dictionary"]) == 0
    assert {p.name for p in (tmp_path / "extract").iterdir() if p.suffix == ".csv"} == {
        f"{n}.csv" for n in ("risk_tier_by_month", "tier_migration", "default_by_tier", "version_counts", "quality_results")
    }
    months = [(r["month_key"], r["risk_tier"]) for r in rows(tmp_path / "extract" / "risk_tier_by_month")]
    assert months == sorted(months, key=lambda r: (r[0], ["LOW", "MEDIUM", "HIGH"].index(r[1])))
    assert rows(tmp_path / "dictionary" / "drift") == []
    assert rows(tmp_path / "extract" / "version_counts") == [{"versions": "3", "customers": "5"}]
    assert len(rows(tmp_path / "extract" / "quality_results")) == 12
    columns = rows(tmp_path / "dictionary" / "columns")
    assert {r["table_name"]: r["row_count"] for r in columns}["dw.fact_monthly_statement"] == "30"
    codes = rows(tmp_path / "dictionary" / "codes")
    assert sum(int(r["used_by"]) for r in codes if r["dimension"] == "dim_payment_status") == 30


def test_failing_gate_ends_with_one(spark, tmp_path):
    clients = [client(1), client(2, education=9)]  # the unknown code drops a client
    files.write_csv(source(spark, clients), f"{tmp_path}/source")
    assert main(["load", "--source", f"{tmp_path}/source", "--root", f"{tmp_path}/wh"]) == 1


def test_snapshot_of_the_order_history(spark, tmp_path):
    assert main(["snapshot", "--tables", "/root/testdata/sf0.001", "--out", f"{tmp_path}/out"]) == 0
    assert files.read_snapshot_csv(spark, f"{tmp_path}/out").count() == 150
