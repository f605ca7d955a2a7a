"""Declared constraints as audits: keys, references, required and allowed values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.operators import joins
from chronomart.schemas import TABLES, Table

Covered = frozenset[tuple[str, str, str]]

# Constraints that a batch rule of severity ERROR checks as well.
COVERED_BY_RULES: Covered = frozenset(
    {
        ("fact_monthly_statement", "UNIQUE", "client_id,date_key"),
        ("fact_monthly_statement", "FOREIGN KEY", "customer_sk"),
        ("dim_customer", "UNIQUE CURRENT", "client_id"),
    }
)

COLUMNS = ["table_name", "kind", "constrained", "rows_checked", "rows_failed"]


class ConstraintError(RuntimeError):
    def __init__(self, violations: list[str]):
        super().__init__("constraints violated: " + "; ".join(violations))
        self.violations = violations


def _rows(totals: DataFrame, table: str, rows: list[tuple[str, str, str, str]]) -> DataFrame:
    """One-row ``totals`` -> result rows from (kind, constrained, checked, failed), counts as SQL."""
    cells = ", ".join(
        f"'{table}', '{kind}', '{constrained}', "
        f"bigint(coalesce({checked}, 0)), bigint(coalesce({failed}, 0))"
        for kind, constrained, checked, failed in rows
    )
    return totals.selectExpr(f"stack({len(rows)}, {cells}) AS ({', '.join(COLUMNS)})")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their surplus rows."""
    return (
        df.groupBy(*keys)
        .agg((F.count("*") - 1).alias("surplus"))
        .filter(F.col("surplus") > 0)
    )


def check_unique(df: DataFrame, table: str, keys: list[str], kind: str = "UNIQUE") -> DataFrame:
    totals = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .selectExpr("sum(n) AS n", "sum(n - 1) AS surplus")
    )
    return _rows(totals, table, [(kind, ",".join(keys), "n", "surplus")])


def check_reference(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null ``column`` names no version of their own client in ``parent``."""
    totals = joins.orphan_totals(
        child.filter(F.col(column).isNotNull()), parent.withColumnRenamed(key, column), column
    )
    return _rows(totals, table, [("FOREIGN KEY", column, "rows_checked", "rows_failed")])


def _surplus(rest: list[str], condition: str) -> str:
    """SQL for the surplus rows of one owner: rows meeting ``condition`` beyond one per value of ``rest``."""
    rows = f"count_if({condition})"
    if not rest:
        return f"greatest({rows} - 1, 0)"
    values = ", ".join(f"'{c}', {c}" for c in rest)
    return f"{rows} - size(collect_set(IF({condition}, named_struct({values}), NULL)))"


def audit_table(spec: Table, tables: dict[str, DataFrame], covered: Covered = frozenset()) -> DataFrame:
    """Declared constraints of one table that are not ``covered`` elsewhere.

    One pass counts everything but references to another stored table: row
    conditions and codes without an entry row by row, and duplicate keys per
    owner, the first column of all keys.  A table bucketed by its owner is not
    exchanged.  The distinct rest of the keys of one owner (its versions or
    months) is held in a set.

    A generated primary key is checked against its formula row by row; it is
    then unique exactly if the columns it is made of are.
    """
    df = tables[spec.name]
    parts: list[DataFrame] = []

    def wanted(kind: str, constrained: str) -> bool:
        return (spec.name, kind, constrained) not in covered

    # Per owner: name -> SQL.  Results: (kind, constrained, checked, failed) over their sums.
    counts = {"n": "count(*)"}
    results: list[tuple[str, str, str, str]] = []

    def count(kind: str, constrained: str, failed: str, checked: str = "n") -> None:
        counts[f"bad_{len(results)}"] = failed
        results.append((kind, constrained, checked, f"bad_{len(results)}"))

    for c in spec.not_null:
        count("NOT NULL", c, f"count_if({c} IS NULL)")
    for c, allowed in spec.checks.items():
        count("CHECK", c, f"count_if({c} NOT IN ({', '.join(repr(v) for v in allowed)}))")
    if spec.key_formula:
        (pk,) = spec.primary_key
        count("KEY FORMULA", pk, f"count_if({pk} <> {spec.key_formula})")

    primary = spec.key_from or spec.primary_key
    keys = [("PRIMARY KEY", primary, "true")] if primary and primary not in spec.unique else []
    keys += [("UNIQUE", k, "true") for k in spec.unique if wanted("UNIQUE", ",".join(k))]
    keys += [
        ("UNIQUE CURRENT", k, "is_current") for k in spec.current_unique if wanted("UNIQUE CURRENT", ",".join(k))
    ]
    owner = keys[0][1][0] if keys else None
    for kind, columns, condition in keys:
        if owner not in columns:  # only in constant tables
            parts.append(check_unique(df.filter(condition), spec.name, list(columns), kind))
            continue
        name = f"rows_{len(results)}"
        counts[name] = f"count_if({condition})"
        count(kind, ",".join(columns), _surplus([c for c in columns if c != owner], condition), name)

    for column, reference in spec.foreign_keys.items():
        parent, key = reference.split(".")
        if parent not in tables or not wanted("FOREIGN KEY", column):
            continue
        if parent == "dim_customer":
            parts.append(check_reference(df, spec.name, column, tables[parent], key))
            continue
        # Constant dimensions: a few rows each.
        known = tables[parent].select(F.col(key).alias("_key"), F.lit(True).alias(f"known_{column}"))
        df = df.join(F.broadcast(known), F.col(column) == F.col("_key"), "left").drop("_key")
        counts[f"rows_{len(results)}"] = f"count({column})"
        count(
            "FOREIGN KEY", column, f"count_if({column} IS NOT NULL AND known_{column} IS NULL)",
            f"rows_{len(results)}",
        )

    per_owner = df.groupBy(*([owner] if owner else [])).agg(
        *[F.expr(sql).alias(name) for name, sql in counts.items()]
    )
    totals = per_owner.selectExpr(*[f"sum({name}) AS {name}" for name in counts])
    return reduce(DataFrame.unionByName, [_rows(totals, spec.name, results), *parts])


def audit(
    tables: dict[str, DataFrame], names: list[str] | None = None, covered: Covered = frozenset()
) -> DataFrame:
    """Constraint audits of the named tables (default: all that are given)."""
    parts = [audit_table(TABLES[n], tables, covered) for n in (names or tables)]
    return reduce(DataFrame.unionByName, parts)


def enforce(audit_rows: DataFrame) -> None:
    """Raise if any declared constraint is violated (one row per constraint is read)."""
    bad = audit_rows.filter("rows_failed > 0").collect()
    if bad:
        raise ConstraintError(
            [f"{r.table_name}.{r.constrained} {r.kind}: {r.rows_failed}" for r in bad]
        )
