"""Compare registered queries with their SQL on one folder of input tables.

    python tests/oracle_compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs first."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    theirs_names = sorted(d[0] for d in result.description)
    if names != theirs_names:
        return f"columns {names} / {theirs_names}"
    order = [[d[0] for d in result.description].index(n) for n in names]
    theirs = _sorted([tuple(r[i] for i in order) for r in result.fetchall()])
    ours = _sorted([tuple(r) for r in spark_df.select(*names).collect()])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}\n  {a}\n  {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from conftest import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session()
    con = connection(folder)
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in oracle:
            continue
        start = time.time()
        found = difference(query(spark, folder), con, oracle[name])
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s", found or "", flush=True)
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
