"""The registered queries as SQL over the input tables, for a second engine.

Written on their own: long form first instead of a wide snapshot, change points
by self-join instead of windows, overlaps by pairs, percentages by integer
rounding.
"""

from __future__ import annotations

import re

from chronomart.plans import expected

BATCH = "'00000000-0000-0000-0000-000000000001'"

# Clients, their yearly orders and the six months they play.
MONTHS = """
cust AS (
  SELECT c_custkey + 1 AS client_id,
         CAST(greatest(CAST(c_acctbal AS DECIMAL(12,2)), 0) * 200 AS DECIMAL(12,2)) AS limit_bal,
         1 + c_custkey % 2 AS sex, c_nationkey % 7 AS education,
         (c_custkey // 2) % 4 AS marriage, 21 + (c_custkey * 7) % 50 AS age
  FROM customer),
cal(date_key, ordinal, yr) AS (
  VALUES (200504, 6, 1995), (200505, 5, 1996), (200506, 4, 1997),
         (200507, 3, 1998), (200508, 2, 1999), (200509, 1, 2000)),
hist AS (
  SELECT o_custkey + 1 AS client_id, year(o_orderdate) AS yr, count(*) AS n,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS np,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS nf,
         sum(CAST(o_totalprice AS DECIMAL(14,2))) AS bill,
         sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(14,2))
                  WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
                  THEN -CAST(o_totalprice AS DECIMAL(14,2)) ELSE 0 END) AS paid
  FROM orders GROUP BY ALL),
cm AS (
  SELECT c.*, cal.date_key, cal.ordinal,
         CASE WHEN h.n IS NULL THEN -2 WHEN h.np = 0 AND h.nf = 0 THEN -1
              WHEN h.np > 9 THEN 9 ELSE h.np END AS pay_code,
         coalesce(h.bill, 0) AS bill, coalesce(h.paid, 0) AS paid
  FROM cust c CROSS JOIN cal LEFT JOIN hist h ON h.client_id = c.client_id AND h.yr = cal.yr),
late AS (
  SELECT c.client_id, coalesce(h.np, 0) > 0 AS is_default
  FROM cust c LEFT JOIN hist h ON h.client_id = c.client_id AND h.yr = 2001)"""

BAND = """CASE WHEN {age} BETWEEN 30 AND 39 THEN '30-39' WHEN {age} BETWEEN 40 AND 49 THEN '40-49'
  WHEN {age} BETWEEN 50 AND 59 THEN '50-59' WHEN {age} >= 60 THEN '60+' ELSE '20-29' END"""

TIER = """CASE WHEN pay_code > 1 THEN 'HIGH'
  WHEN pay_code = 1 OR (limit_bal > 0 AND bill * 10 > limit_bal * 9) THEN 'MEDIUM' ELSE 'LOW' END"""

KEYS = """sex AS sex_key,
  CASE education WHEN 0 THEN 5 WHEN 5 THEN 6 WHEN 6 THEN 7 ELSE education END AS education_key,
  CASE marriage WHEN 0 THEN 4 ELSE marriage END AS marriage_key"""

HASH = "sha256({tier} || '|' || CAST({limit} AS VARCHAR))"


def versions(snapshots: str, prefix: str = "") -> str:
    """CTEs for the versions of ``snapshots`` (client_id, date_key, risk_tier, limit_bal, ...)."""
    p = prefix
    return f"""
{p}prev AS (
  SELECT s.*, (SELECT max(x.date_key) FROM {snapshots} x
               WHERE x.client_id = s.client_id AND x.date_key < s.date_key) AS prev_key
  FROM {snapshots} s),
{p}chg AS (
  SELECT s.* FROM {p}prev s LEFT JOIN {snapshots} q
    ON q.client_id = s.client_id AND q.date_key = s.prev_key
  WHERE q.client_id IS NULL OR q.risk_tier <> s.risk_tier OR q.limit_bal <> s.limit_bal),
{p}span AS (
  SELECT c.client_id, c.date_key, min(n.date_key) AS next_key
  FROM {p}chg c LEFT JOIN {p}chg n ON n.client_id = c.client_id AND n.date_key > c.date_key
  GROUP BY ALL),
{p}num AS (
  SELECT c.client_id, c.date_key, count(*) AS version_num
  FROM {p}chg c JOIN {p}chg e ON e.client_id = c.client_id AND e.date_key <= c.date_key
  GROUP BY ALL),
{p}latest AS (
  SELECT n.client_id, n.date_key, max(s.date_key) AS last_key
  FROM {p}span n JOIN {snapshots} s ON s.client_id = n.client_id AND s.date_key >= n.date_key
    AND (n.next_key IS NULL OR s.date_key < n.next_key)
  GROUP BY ALL),
{p}dim AS (
  SELECT c.client_id * 65536 + num.version_num AS customer_sk, c.client_id, c.limit_bal,
         c.sex_key, c.education_key, c.marriage_key, t.age, t.age_band, c.risk_tier,
         c.date_key AS valid_from_date,
         CASE WHEN span.next_key IS NULL THEN 999912 ELSE span.next_key - 1 END AS valid_to_date,
         span.next_key IS NULL AS is_current, num.version_num,
         {HASH.format(tier="c.risk_tier", limit="c.limit_bal")} AS row_hash
  FROM {p}chg c
  JOIN {p}span span ON span.client_id = c.client_id AND span.date_key = c.date_key
  JOIN {p}num num ON num.client_id = c.client_id AND num.date_key = c.date_key
  JOIN {p}latest l ON l.client_id = c.client_id AND l.date_key = c.date_key
  JOIN {snapshots} t ON t.client_id = c.client_id AND t.date_key = l.last_key)"""


SNAP = f""",
snap AS (
  SELECT client_id, date_key, limit_bal, {KEYS}, age, {BAND.format(age="age")} AS age_band,
         {TIER} AS risk_tier, pay_code, bill, paid FROM cm)"""

STAR = (
    MONTHS
    + SNAP
    + ","
    + versions("snap")
    + """,
fact AS (
  SELECT s.client_id * 1000000 + s.date_key AS statement_sk, d.customer_sk, s.date_key,
         s.pay_code + 3 AS pay_status_key, s.client_id, s.bill AS bill_amount,
         s.paid AS payment_amount, s.limit_bal AS credit_limit, s.pay_code
  FROM snap s JOIN dim d ON d.client_id = s.client_id
    AND s.date_key >= d.valid_from_date AND s.date_key <= d.valid_to_date),
outcome AS (
  SELECT l.client_id AS outcome_sk, d.customer_sk, 200510 AS date_key, l.client_id, l.is_default
  FROM late l JOIN dim d ON d.client_id = l.client_id AND d.is_current)"""
)

# Months with orders only; clients one year older with every month.
ACTIVITY = (
    MONTHS
    + f""",
act AS (
  SELECT client_id, date_key, limit_bal, {KEYS}, age + date_key - 200504 AS age,
         {BAND.format(age="(age + date_key - 200504)")} AS age_band, {TIER} AS risk_tier
  FROM cm WHERE pay_code <> -2)"""
)

DIM_SELECT = """SELECT CAST(customer_sk AS BIGINT) AS customer_sk, client_id,
  CAST(limit_bal AS DOUBLE) AS limit_bal, CAST(sex_key AS BIGINT) AS sex_key,
  CAST(education_key AS BIGINT) AS education_key, CAST(marriage_key AS BIGINT) AS marriage_key,
  CAST(age AS BIGINT) AS age, age_band, risk_tier, CAST(valid_from_date AS BIGINT) AS valid_from_date,
  CAST(valid_to_date AS BIGINT) AS valid_to_date, CAST(is_current AS BIGINT) AS is_current,
  CAST(version_num AS BIGINT) AS version_num, row_hash FROM {dim}"""

FACT_SELECT = f"""SELECT statement_sk, CAST(customer_sk AS BIGINT) AS customer_sk,
  CAST(date_key AS BIGINT) AS date_key, CAST(pay_status_key AS BIGINT) AS pay_status_key, client_id,
  CAST(bill_amount AS DOUBLE) AS bill_amount, CAST(payment_amount AS DOUBLE) AS payment_amount,
  CAST(credit_limit AS DOUBLE) AS credit_limit, {BATCH} AS load_batch_id FROM fact"""

SNAP_SELECT = """SELECT CAST(date_key AS BIGINT) AS date_key, client_id,
  CAST(limit_bal AS DOUBLE) AS limit_bal, CAST(sex_key AS BIGINT) AS sex_key,
  CAST(education_key AS BIGINT) AS education_key, CAST(marriage_key AS BIGINT) AS marriage_key,
  CAST(age AS BIGINT) AS age, age_band, risk_tier FROM snap"""


def _wide() -> str:
    cells = []
    for name, value, kind in [("pay_", "pay_code", "BIGINT"), ("bill_amt", "bill", "DOUBLE"), ("pay_amt", "paid", "DOUBLE")]:
        for i in range(1, 7):
            cells.append(
                f"CAST(max(CASE WHEN ordinal = {i} THEN {value} END) AS {kind}) AS {name}{i}"
            )
    return f"""WITH {MONTHS}
SELECT cm.client_id, CAST(max(limit_bal) AS DOUBLE) AS limit_bal, CAST(max(sex) AS BIGINT) AS sex,
  CAST(max(education) AS BIGINT) AS education, CAST(max(marriage) AS BIGINT) AS marriage,
  CAST(max(age) AS BIGINT) AS age, {", ".join(cells)},
  CAST(bool_or(is_default) AS BIGINT) AS default_next_month, {BATCH} AS load_batch_id
FROM cm JOIN late ON late.client_id = cm.client_id GROUP BY cm.client_id"""


def _ratio(n: str, d: str, places: int, factor: int = 1) -> str:
    """Half-up ratio in integers."""
    unit = factor * 10**places
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return f"CAST((2 * {unit} * {n} + {d}) // (2 * {d}) AS DOUBLE) / {10**places}"


def _values(rows: list[tuple]) -> str:
    def literal(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    return ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


PAYMENT = f"pay(pay_status_key, code, documented, reading, late, months) AS (VALUES {_values(expected.PAYMENT_STATUS)})"
EDUCATION = f"edu(education_key, code, label, documented) AS (VALUES {_values(expected.EDUCATION)})"
MARRIAGE = f"mar(marriage_key, code, label, documented) AS (VALUES {_values(expected.MARRIAGE)})"
SEX = f"sx(sex_key, code, label) AS (VALUES {_values(expected.SEX)})"
RULES = f"rules(rule_id, rule_code, target_object, severity, description) AS (VALUES {_values(expected.QUALITY_RULES)})"

MIGRATION = """,
moves AS (
  SELECT p.risk_tier AS prev_tier, s.risk_tier AS curr_tier, count(*) AS n
  FROM snap s JOIN snap p ON p.client_id = s.client_id AND p.date_key = s.date_key - 1 GROUP BY ALL)"""

BY_MONTH = f""", {PAYMENT},
bym AS (
  SELECT f.date_key AS month_key, d.risk_tier, count(*) AS customer_months,
         sum(CAST(trunc(f.bill_amount) AS BIGINT)) AS bills,
         sum(CAST(trunc(f.credit_limit) AS BIGINT)) AS limits, count(*) FILTER (WHERE p.late) AS late
  FROM fact f JOIN dim d ON d.customer_sk = f.customer_sk
  JOIN pay p ON p.pay_status_key = f.pay_status_key GROUP BY ALL)"""

CENTS = "CAST({x} * 100 AS HUGEINT)"

RESULTS = f""", {EDUCATION}, {MARRIAGE}, {RULES},
stg AS (SELECT count(*) AS n, count(DISTINCT client_id) AS clients FROM cust),
src AS (SELECT count(*) AS n FROM customer),
over_limit AS (
  SELECT max((2 * {CENTS.format(x="bill_amount")} * 100 + {CENTS.format(x="credit_limit")})
         // (2 * {CENTS.format(x="credit_limit")})) AS hundredths
  FROM fact WHERE credit_limit > 0),
pairs AS (
  SELECT count(*) AS n FROM dim a JOIN dim b ON b.client_id = a.client_id
    AND b.customer_sk > a.customer_sk AND a.valid_from_date <= b.valid_to_date
    AND b.valid_from_date <= a.valid_to_date),
edu_now AS (
  SELECT e.code, e.documented, count(*) AS n FROM dim d
  JOIN edu e ON e.education_key = d.education_key WHERE d.is_current GROUP BY ALL),
mar_now AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE NOT m.documented) AS bad FROM dim d
  JOIN mar m ON m.marriage_key = d.marriage_key WHERE d.is_current),
results(rule_id, rows_checked, rows_failed, sample_detail) AS (
  SELECT 1, stg.n, abs(stg.n - src.n), '來源 ' || src.n || ' 列，暫存區 ' || stg.n || ' 列' FROM stg, src
  UNION ALL SELECT 2, n, n - clients, '重複 client_id 數：' || (n - clients) FROM stg
  UNION ALL SELECT 3, sum(n), coalesce(sum(n) FILTER (WHERE NOT documented), 0), '未定義碼值分布：' ||
    coalesce(string_agg('碼' || code || '=' || n || '筆', '　' ORDER BY code) FILTER (WHERE NOT documented), '') FROM edu_now
  UNION ALL SELECT 4, n, bad, '未定義碼值筆數：' || bad FROM mar_now
  UNION ALL SELECT 5, count(*), count(*) - count(DISTINCT statement_sk), '違反粒度的組合數：' || (count(*) - count(DISTINCT statement_sk)) FROM fact
  UNION ALL SELECT 6, count(*), count(*) FILTER (WHERE NOT EXISTS (
    SELECT 1 FROM dim d WHERE d.customer_sk = fact.customer_sk AND d.client_id = fact.client_id)), '孤兒 customer_sk 筆數' FROM fact
  UNION ALL SELECT 7, count(*), abs(count(*) - 6 * (SELECT n FROM src)), '預期 ' || 6 * (SELECT n FROM src) || ' 列，實際 ' || count(*) || ' 列' FROM fact
  UNION ALL SELECT 8, (SELECT count(*) FROM dim), n, '重疊版本組數：' || n FROM pairs
  UNION ALL SELECT 9, count(*), count(*) FILTER (WHERE c <> 1), '當前版本數 <> 1 的客戶數：' || count(*) FILTER (WHERE c <> 1)
    FROM (SELECT client_id, count(*) FILTER (WHERE is_current) AS c FROM dim GROUP BY client_id)
  UNION ALL SELECT 10, count(*), count(*) FILTER (WHERE payment_amount < 0), '最小繳款金額：' || CAST(CAST(min(payment_amount) AS DECIMAL(14,2)) AS VARCHAR) FROM fact
  UNION ALL SELECT 11, count(*), count(*) FILTER (WHERE bill_amount > credit_limit), '最大超額比：' ||
    (SELECT (hundredths // 100) || '.' || lpad(CAST(hundredths % 100 AS VARCHAR), 2, '0') || '0000000000000' FROM over_limit) FROM fact
  UNION ALL SELECT 12, (SELECT n FROM src), abs((SELECT n FROM src) - count(*)), '違約結果列數：' || count(*) FROM outcome),
report AS (
  SELECT r.rule_code, r.severity, r.target_object, CAST(x.rows_checked AS BIGINT) AS rows_checked,
         CAST(x.rows_failed AS BIGINT) AS rows_failed,
         CASE WHEN x.rows_failed = 0 THEN 'PASS' WHEN r.severity = 'ERROR' THEN 'FAIL' ELSE 'WARN' END AS verdict,
         x.sample_detail, {BATCH} AS load_batch_id, r.description
  FROM results x JOIN rules r ON r.rule_id = x.rule_id)"""


# The same rules over faulty copies of the tables.
DIRTY = """,
dirty_cust AS (SELECT * FROM cust UNION ALL SELECT * FROM cust WHERE client_id % 10 = 0),
dirty_fact AS (
  SELECT * REPLACE (CASE WHEN client_id % 10 = 2 THEN customer_sk + 65536 ELSE customer_sk END AS customer_sk)
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE client_id % 10 = 1 AND date_key = 200505)),
dirty_dim AS (
  SELECT * FROM dim UNION ALL
  SELECT * REPLACE (customer_sk + 50 AS customer_sk, version_num + 50 AS version_num)
  FROM dim WHERE client_id % 10 = 3 AND is_current),
dirty_outcome AS (SELECT * FROM outcome WHERE client_id % 10 <> 4)""" + re.sub(
    r"\b(FROM|JOIN) (cust|fact|dim|outcome)\b", r"\1 dirty_\2", RESULTS
).replace("= fact.", "= dirty_fact.")


def _constraint_audit() -> str:
    frames = {
        "credit_clients": "(SELECT client_id, '' AS load_batch_id, '' AS loaded_at FROM cust)",
        "dim_customer": "(SELECT *, '' AS created_at FROM dim)",
        "fact_monthly_statement": "(SELECT *, '' AS load_batch_id FROM fact)",
        "fact_default_outcome": "(SELECT *, '' AS load_batch_id FROM outcome)",
    }
    parents = {
        "dim_customer.customer_sk": "SELECT customer_sk FROM dim",
        "dim_sex.sex_key": "SELECT sex_key FROM sx",
        "dim_education.education_key": "SELECT education_key FROM edu",
        "dim_marriage.marriage_key": "SELECT marriage_key FROM mar",
        "dim_payment_status.pay_status_key": "SELECT pay_status_key FROM pay",
        "dim_date.date_key": "SELECT unnest([200504, 200505, 200506, 200507, 200508, 200509, 200510])",
    }
    rows = []

    def add(table: str, kind: str, constrained: str, checked: str, failed: str, where: str = "TRUE") -> None:
        rows.append(
            f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{constrained}' AS constrained, "
            f"{checked} AS rows_checked, CAST({failed} AS BIGINT) AS rows_failed "
            f"FROM {frames[table]} WHERE {where}"
        )

    for name, kind, columns, detail in expected.CONSTRAINTS:
        if kind == "NOT NULL":
            add(name, kind, columns, "count(*)", f"count(*) - count({columns})")
        elif kind == "KEY FORMULA":
            add(name, kind, columns, "count(*)", f"count(*) FILTER (WHERE {columns} <> {detail})")
        elif kind == "PRIMARY KEY":
            add(name, kind, columns, "count(*)", f"count(*) - count(DISTINCT {detail})")
        elif kind == "FOREIGN KEY":
            add(name, kind, columns, f"count({columns})",
                f"count(*) FILTER (WHERE {columns} NOT IN ({parents[detail]}))")
        else:
            distinct = f"count(*) - count(DISTINCT ({columns}))"
            add(name, kind, columns, "count(*)", distinct, "is_current" if kind == "UNIQUE CURRENT" else "TRUE")
    return f"WITH {STAR}, {PAYMENT}, {EDUCATION}, {MARRIAGE}, {SEX} " + " UNION ALL ".join(rows)


def _table_counts() -> str:
    layer = {row[0].split(".")[1]: row[0].split(".")[0] for row in expected.DICTIONARY}
    counts = {
        "credit_clients": "FROM cust", "dim_customer": "FROM dim",
        "fact_monthly_statement": "FROM fact", "fact_default_outcome": "FROM outcome",
    }
    fixed = {
        "dim_date": 7, "dim_sex": 2, "dim_education": 7, "dim_marriage": 4, "dim_payment_status": 12,
        "quality_rule": 12, "quality_result": 12, "load_batch": 1,
    }
    rows = [
        f"SELECT '{layer[n]}.{n}' AS table_name, count(*) AS row_count {source}"
        for n, source in counts.items()
    ] + [
        f"SELECT '{layer[n]}.{n}' AS table_name, CAST({k} AS BIGINT) AS row_count"
        for n, k in fixed.items()
    ]
    return " UNION ALL ".join(rows)


def _dictionary() -> str:
    return f"""WITH {STAR}, counts AS ({_table_counts()}),
dict(table_name, column_id, column_name, data_type, nullable, key_role, reference) AS (
  VALUES {_values(expected.DICTIONARY)})
SELECT d.table_name, CAST(column_id AS BIGINT) AS column_id, column_name, data_type, nullable,
  key_role, reference, row_count FROM dict d JOIN counts c ON c.table_name = d.table_name"""


_APPLIED = versions("(SELECT * FROM snap WHERE date_key <= 200508)")
_CORRECTED = f""",
snap2 AS (
  SELECT * REPLACE (CAST(CASE WHEN education_key = 1 AND date_key = 200509 THEN limit_bal * 2
                    ELSE limit_bal END AS DECIMAL(12,2)) AS limit_bal) FROM snap),
snap3 AS (SELECT * REPLACE ({TIER} AS risk_tier) FROM snap2)"""

_TIER = "CASE {} WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END"

ORACLE: dict[str, str] = {
    "stage_clients": _wide(),
    "csv_snapshot": _wide(),
    "row_number_key": """SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS client_id,
  c_custkey, c_acctbal FROM customer""",
    "unpivot_months": f"""WITH {MONTHS} SELECT client_id, CAST(date_key AS BIGINT) AS date_key,
  CAST(pay_code AS BIGINT) AS pay_code, CAST(bill AS DOUBLE) AS bill_amount,
  CAST(paid AS DOUBLE) AS payment_amount FROM cm""",
    "age_band": f"""SELECT c_custkey + 1 AS client_id, CAST(age AS BIGINT) AS age, {BAND.format(age="age")} AS age_band
FROM (SELECT c_custkey, 21 + (c_custkey * 7) % 50 AS age FROM customer)""",
    "risk_tier_snapshot": f"WITH {MONTHS}{SNAP} {SNAP_SELECT}",
    "row_hash": f"""WITH {MONTHS}{SNAP} SELECT client_id, CAST(date_key AS BIGINT) AS date_key,
  {HASH.format(tier="risk_tier", limit="limit_bal")} AS row_hash FROM snap""",
    "prev_period": """WITH m AS (
  SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS date_key, count(*) AS orders,
         max(CAST(last_day(o_orderdate) AS VARCHAR)) AS month_end_date,
         CAST(max(quarter(o_orderdate)) AS BIGINT) AS quarter_num FROM orders GROUP BY 1)
SELECT m.date_key, m.orders, (SELECT max(p.date_key) FROM m p WHERE p.date_key < m.date_key) AS prev_date_key,
  m.month_end_date, m.quarter_num FROM m""",
    "scd2_build": f"WITH {STAR} {DIM_SELECT.format(dim='dim')}",
    "scd2_build_gapped": f"WITH {ACTIVITY}, {versions('act')} {DIM_SELECT.format(dim='dim')}",
    "scd2_type1": f"""WITH {ACTIVITY}, {versions('act')}
SELECT client_id, CAST(version_num AS BIGINT) AS version_num, CAST(valid_from_date AS BIGINT) AS valid_from_date,
  CAST(valid_to_date AS BIGINT) AS valid_to_date, CAST(age AS BIGINT) AS age, age_band FROM dim""",
    "scd2_apply_month": f"WITH {MONTHS}{SNAP}, {_APPLIED} {DIM_SELECT.format(dim='dim')}",
    "scd2_apply_gapped": f"""WITH {ACTIVITY}, {versions('(SELECT * FROM act WHERE date_key <= 200506)')}
{DIM_SELECT.format(dim='dim')}""",
    "scd2_rewind": f"""WITH {ACTIVITY}, {versions('(SELECT * FROM act WHERE date_key < 200507)')}
{DIM_SELECT.format(dim='dim')}""",
    "scd2_corrected_month": f"WITH {MONTHS}{SNAP}{_CORRECTED}, {versions('snap3')} {DIM_SELECT.format(dim='dim')}",
    "monthly_reload": f"""WITH {MONTHS}{SNAP}{_CORRECTED}, {versions('snap3')}
SELECT 'statement' AS fact, s.client_id, CAST(s.date_key AS BIGINT) AS date_key, CAST(d.customer_sk AS BIGINT) AS customer_sk,
  CAST(s.limit_bal AS DOUBLE) AS credit_limit, d.risk_tier
FROM snap3 s JOIN dim d ON d.client_id = s.client_id AND s.date_key BETWEEN d.valid_from_date AND d.valid_to_date
UNION ALL
SELECT 'outcome', l.client_id, 200510, CAST(d.customer_sk AS BIGINT), NULL, d.risk_tier
FROM late l JOIN dim d ON d.client_id = l.client_id AND d.is_current""",
    "file_row_number": "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS client_id, c_acctbal FROM customer",
    "fact_statement": f"WITH {STAR} {FACT_SELECT}",
    "fact_statement_single_pass": f"WITH {STAR} {FACT_SELECT}",
    "fact_statement_month": f"WITH {STAR} {FACT_SELECT} WHERE date_key = 200505",
    "fact_outcome": f"""WITH {STAR} SELECT outcome_sk, CAST(customer_sk AS BIGINT) AS customer_sk,
  CAST(date_key AS BIGINT) AS date_key, client_id, CAST(is_default AS BIGINT) AS is_default,
  {BATCH} AS load_batch_id FROM outcome""",
    "point_in_time_literal": f"""WITH {STAR} SELECT o.client_id, CAST(o.is_default AS BIGINT) AS is_default,
  CAST(d.version_num AS BIGINT) AS version_num, d.risk_tier
FROM outcome o JOIN dim d ON d.client_id = o.client_id AND 200506 BETWEEN d.valid_from_date AND d.valid_to_date""",
    "current_version_join": f"""WITH {STAR} SELECT o.client_id, CAST(o.is_default AS BIGINT) AS is_default,
  CAST(d.version_num AS BIGINT) AS version_num, d.risk_tier
FROM outcome o JOIN dim d ON d.client_id = o.client_id AND d.is_current""",
    "star_view": f"""WITH {STAR}, {PAYMENT}, {EDUCATION}, {MARRIAGE}, {SEX}
SELECT f.client_id, CAST(f.date_key AS BIGINT) AS date_key, CAST(f.date_key // 100 AS BIGINT) AS year_num,
  CAST(f.date_key % 100 AS BIGINT) AS month_num, d.risk_tier, d.age_band, e.label AS education_desc,
  CAST(e.documented AS BIGINT) AS education_is_documented, m.label AS marriage_desc, s.label AS sex_desc,
  p.reading AS payment_status, CAST(p.late AS BIGINT) AS is_delinquent,
  CAST(f.bill_amount AS DOUBLE) AS bill_amount, CAST(f.payment_amount AS DOUBLE) AS payment_amount,
  CAST(f.credit_limit AS DOUBLE) AS credit_limit,
  CASE WHEN f.credit_limit > 0 THEN {_ratio("f.bill_amount * 100", "f.credit_limit * 100", 6)} END AS utilization,
  CAST(o.is_default AS BIGINT) AS is_default
FROM fact f JOIN dim d ON d.customer_sk = f.customer_sk JOIN edu e ON e.education_key = d.education_key
JOIN mar m ON m.marriage_key = d.marriage_key JOIN sx s ON s.sex_key = d.sex_key
JOIN pay p ON p.pay_status_key = f.pay_status_key LEFT JOIN outcome o ON o.client_id = f.client_id""",
    "orphan_facts": f"""WITH {STAR} SELECT count(*) AS rows_checked,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.customer_sk = fact.customer_sk AND d.risk_tier <> 'HIGH')) AS rows_failed
FROM fact""",
    "new_clients_anti": f"""WITH {ACTIVITY} SELECT client_id, risk_tier,
  {HASH.format(tier="risk_tier", limit="limit_bal")} AS row_hash FROM act
WHERE date_key = 200505 AND client_id NOT IN (SELECT client_id FROM act WHERE date_key < 200505)""",
    "overlap_pairs": """WITH s AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS opened, CAST(o_orderdate AS DATE) + 90 AS closed FROM orders),
pairs AS (
  SELECT a.o_custkey, count(*) AS n FROM s a JOIN s b ON b.o_custkey = a.o_custkey
    AND b.o_orderkey > a.o_orderkey AND a.opened <= b.closed AND b.opened <= a.closed GROUP BY 1)
SELECT s.o_custkey, count(*) AS intervals, coalesce(max(pairs.n), 0) AS overlapping_pairs
FROM s LEFT JOIN pairs ON pairs.o_custkey = s.o_custkey GROUP BY 1""",
    "quality_report": f"WITH {STAR}{RESULTS} SELECT * FROM report",
    "quality_report_dirty": f"WITH {STAR}{DIRTY} SELECT * FROM report",
    "quality_results": f"""WITH {STAR}{RESULTS}
SELECT load_batch_id, rule_code, severity, verdict, rows_checked, rows_failed FROM report""",
    "quality_gate_counts": f"""WITH {STAR}{RESULTS}
SELECT count(*) FILTER (WHERE verdict = 'PASS') AS pass_rules, count(*) FILTER (WHERE verdict = 'WARN') AS warn_rules,
  count(*) FILTER (WHERE verdict = 'FAIL') AS fail_rules, count(*) FILTER (WHERE severity = 'ERROR') AS error_severity,
  count(*) FILTER (WHERE severity = 'WARN') AS warn_severity, count(*) FILTER (WHERE severity = 'INFO') AS info_severity,
  CAST(count(*) FILTER (WHERE verdict = 'FAIL') = 0 AS BIGINT) AS gate_open FROM report""",
    "dup_keys": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) - 1 AS surplus
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "undocumented_codes": f"""WITH {STAR}, {EDUCATION}, {MARRIAGE}
SELECT CAST(e.code AS BIGINT) AS education_code, CAST(e.documented AS BIGINT) AS education_documented,
  count(*) AS customers, count(*) AS with_marriage,
  CAST(sum(CASE WHEN NOT m.documented THEN 1 END) AS BIGINT) AS marriage_undocumented
FROM dim d JOIN edu e ON e.education_key = d.education_key JOIN mar m ON m.marriage_key = d.marriage_key
WHERE d.is_current GROUP BY e.code, e.documented""",
    "constraint_audit": _constraint_audit(),
    "distinct_clients": f"""WITH {STAR} SELECT risk_tier, count(*) AS versions,
  count(DISTINCT client_id) AS clients FROM dim GROUP BY risk_tier""",
    "tier_migration_pct": f"""WITH {MONTHS}{SNAP}{MIGRATION}
SELECT m.prev_tier, m.curr_tier AS risk_tier, m.n AS customer_months, {_ratio("m.n", "t.total", 1, 100)} AS pct_of_prev,
  row_number() OVER (ORDER BY {_TIER.format("m.prev_tier")}, {_TIER.format("m.curr_tier")}) AS place
FROM moves m JOIN (SELECT prev_tier, sum(n) AS total FROM moves GROUP BY 1) t ON t.prev_tier = m.prev_tier""",
    "tier_migration": f"""WITH {MONTHS}{SNAP}{MIGRATION}
SELECT prev_tier, curr_tier, n AS customer_months FROM moves""",
    "default_rate_by_tier": f"""WITH {MONTHS}{SNAP}
SELECT risk_tier, count(*) AS customers, count(*) FILTER (WHERE is_default) AS defaults,
  {_ratio("count(*) FILTER (WHERE is_default)", "count(*)", 2, 100)} AS default_pct,
  row_number() OVER (ORDER BY {_ratio("count(*) FILTER (WHERE is_default)", "count(*)", 2, 100)} DESC, {_TIER.format("risk_tier")}) AS place
FROM snap JOIN late ON late.client_id = snap.client_id WHERE date_key = 200509 GROUP BY risk_tier""",
    "default_by_tier": f"""WITH {STAR} SELECT d.risk_tier, count(*) AS customers,
  count(*) FILTER (WHERE o.is_default) AS defaults
FROM outcome o JOIN dim d ON d.customer_sk = o.customer_sk WHERE d.is_current GROUP BY 1""",
    "default_rate_by_band": f"""WITH {MONTHS},
u AS (SELECT client_id, sum(bill) AS b, sum(limit_bal) AS l FROM cm GROUP BY 1),
g AS (SELECT client_id, CASE WHEN l = 0 THEN '無額度' WHEN b * 10 >= l * 9 THEN '90%+'
  WHEN b * 10 >= l * 6 THEN '60-90%' WHEN b * 10 >= l * 3 THEN '30-60%'
  WHEN b * 10 >= l THEN '10-30%' ELSE '0-10%' END AS use_band FROM u)
SELECT use_band, count(*) AS customers, {_ratio("count(*) FILTER (WHERE is_default)", "count(*)", 2, 100)} AS default_pct,
  row_number() OVER (ORDER BY CASE use_band WHEN '0-10%' THEN 1 WHEN '10-30%' THEN 2 WHEN '30-60%' THEN 3
    WHEN '60-90%' THEN 4 WHEN '90%+' THEN 5 ELSE 6 END) AS place
FROM g JOIN late ON late.client_id = g.client_id GROUP BY use_band""",
    "delinquency_trend": f"""WITH {MONTHS}
SELECT CAST(date_key AS BIGINT) AS date_key, count(*) AS accounts,
  count(*) FILTER (WHERE pay_code >= 1) AS late_accounts,
  {_ratio("count(*) FILTER (WHERE pay_code >= 1)", "count(*)", 2, 100)} AS late_pct,
  {_ratio("sum(pay_code) FILTER (WHERE pay_code >= 1)", "nullif(count(*) FILTER (WHERE pay_code >= 1), 0)", 2)} AS mean_months_late,
  row_number() OVER (ORDER BY date_key) AS place
FROM cm GROUP BY date_key""",
    "risk_tier_by_month": f"""WITH {STAR}{BY_MONTH}
SELECT CAST(month_key AS BIGINT) AS month_key, CAST(month_key // 100 AS BIGINT) AS year_num,
  CAST(month_key % 100 AS BIGINT) AS month_num, risk_tier, customer_months,
  CAST(bills AS BIGINT) AS bill_amount_sum, CAST(limits AS BIGINT) AS credit_limit_sum,
  late AS delinquent_months FROM bym""",
    "version_counts": f"""WITH {STAR} SELECT versions, count(*) AS customers
FROM (SELECT client_id, count(*) AS versions FROM dim GROUP BY 1) GROUP BY 1""",
    "version_timeline": f"""WITH {STAR}, {PAYMENT}
SELECT f.client_id, CAST(f.date_key AS BIGINT) AS date_key, CAST(d.version_num AS BIGINT) AS version_num,
  d.risk_tier, CAST(d.valid_from_date AS BIGINT) AS valid_from_date, CAST(d.valid_to_date AS BIGINT) AS valid_to_date,
  p.reading AS payment_status
FROM fact f JOIN dim d ON d.customer_sk = f.customer_sk JOIN pay p ON p.pay_status_key = f.pay_status_key""",
    "load_progress": f"""WITH {STAR}
SELECT CAST(cal.date_key AS BIGINT) AS date_key,
  (SELECT count(*) FROM fact f WHERE f.date_key = cal.date_key) AS facts,
  (SELECT count(*) FROM dim d WHERE d.valid_from_date <= cal.date_key) AS versions FROM cal""",
    "bi_ratios": f"""WITH {STAR}{BY_MONTH}
SELECT (month_key // 100) || '-' || lpad(CAST(month_key % 100 AS VARCHAR), 2, '0') || '-01' AS month_date, risk_tier,
  {_ratio("late", "customer_months", 6)} AS delinquency_rate, {_ratio("bills", "nullif(limits, 0)", 6)} AS utilization FROM bym""",
    "bi_overall_trend": f"""WITH {STAR}{BY_MONTH}
SELECT (month_key // 100) || '-' || lpad(CAST(month_key % 100 AS VARCHAR), 2, '0') || '-01' AS month_date, 'ALL' AS risk_tier,
  {_ratio("sum(late)", "sum(customer_months)", 6)} AS delinquency_rate,
  {_ratio("sum(bills)", "nullif(sum(limits), 0)", 6)} AS utilization FROM bym GROUP BY month_key""",
    "bi_migration_share": f"""WITH {MONTHS}{SNAP}{MIGRATION}
SELECT m.prev_tier, m.curr_tier, {_ratio("m.n", "t.total", 6)} AS migration_share
FROM moves m JOIN (SELECT prev_tier, sum(n) AS total FROM moves GROUP BY 1) t ON t.prev_tier = m.prev_tier""",
    "bi_default_rate": f"""WITH {STAR} SELECT d.risk_tier,
  {_ratio("count(*) FILTER (WHERE o.is_default)", "count(*)", 6)} AS default_rate
FROM outcome o JOIN dim d ON d.customer_sk = o.customer_sk AND d.is_current GROUP BY 1""",
    "code_listing": f"""WITH {STAR}, {PAYMENT}, {EDUCATION}, {MARRIAGE}
SELECT 'dim_payment_status' AS dimension, CAST(code AS BIGINT) AS code, coalesce(documented, '（文件未定義）') AS meaning,
  reading AS remark, (SELECT count(*) FROM fact f WHERE f.pay_status_key = pay.pay_status_key) AS used_by FROM pay
UNION ALL SELECT 'dim_education', code, label, CASE WHEN documented THEN '是' ELSE '否' END,
  (SELECT count(*) FROM dim d WHERE d.is_current AND d.education_key = edu.education_key) FROM edu
UNION ALL SELECT 'dim_marriage', code, label, CASE WHEN documented THEN '是' ELSE '否' END,
  (SELECT count(*) FROM dim d WHERE d.is_current AND d.marriage_key = mar.marriage_key) FROM mar""",
    "table_row_counts": f"WITH {STAR} {_table_counts()}",
    "data_dictionary": _dictionary(),
    "batch_states": """SELECT 'order history' AS source_name, count(*) AS source_rows, 'SUCCEEDED' AS status,
  CAST(NULL AS VARCHAR) AS message, CAST(1 AS BIGINT) AS is_finished FROM customer
UNION ALL
SELECT 'one row short', count(*) + 1, 'FAILED',
  'ERROR rules failed: FACT_ROWCOUNT, OUTCOME_COVERAGE, STG_ROWCOUNT', 1 FROM customer""",
}
