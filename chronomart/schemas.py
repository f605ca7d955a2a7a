"""Declared schemas and key metadata of the warehouse tables.

``client_id`` is a bigint and amounts are decimal(18,2): at the intended volumes
a 32-bit key would run out, and so would fourteen digits for a client that holds
a large share of all amounts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONTHS = 6
OPEN_END = 999912  # fixed value: valid_to_date of a version that is still open

# Generated keys: a client's versions and months are numbered within these spans.
VERSION_SPAN = 65_536
MONTH_SPAN = 1_000_000

ATTRIBUTE_COLUMNS = ["limit_bal", "sex", "education", "marriage", "age"]
PAY_COLUMNS = [f"pay_{i}" for i in range(1, MONTHS + 1)]
BILL_COLUMNS = [f"bill_amt{i}" for i in range(1, MONTHS + 1)]
PAID_COLUMNS = [f"pay_amt{i}" for i in range(1, MONTHS + 1)]


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(18,2)": T.DecimalType(18, 2),
}


def struct(*columns: tuple[str, str, bool]) -> T.StructType:
    """Schema from (name, type, nullable), usable before a session exists."""
    return T.StructType([T.StructField(name, _TYPES[kind], nullable) for name, kind, nullable in columns])


SOURCE = struct(
    ("client_id", "bigint", False),
    ("limit_bal", "decimal(12,2)", True),
    ("sex", "smallint", True),
    ("education", "smallint", True),
    ("marriage", "smallint", True),
    ("age", "smallint", True),
    *[(c, "smallint", True) for c in PAY_COLUMNS],
    *[(c, "decimal(18,2)", True) for c in BILL_COLUMNS],
    *[(c, "decimal(18,2)", True) for c in PAID_COLUMNS],
    ("default", "smallint", True),
)

STG_CREDIT_CLIENTS = T.StructType(
    SOURCE.fields[:-1]
    + struct(
        ("default_next_month", "boolean", True),
        ("load_batch_id", "string", False),
        ("loaded_at", "timestamp", False),
    ).fields
)

DIM_DATE = struct(
    ("date_key", "int", False),
    ("year_num", "smallint", False),
    ("month_num", "smallint", False),
    ("month_name_zh", "string", False),
    ("quarter_num", "smallint", False),
    ("month_end_date", "date", False),
    ("source_month_ix", "smallint", False),
)

DIM_SEX = struct(
    ("sex_key", "smallint", False), ("sex_code", "smallint", False), ("sex_desc", "string", False)
)

DIM_EDUCATION = struct(
    ("education_key", "smallint", False),
    ("education_code", "smallint", False),
    ("education_desc", "string", False),
    ("is_documented", "boolean", False),
)

DIM_MARRIAGE = struct(
    ("marriage_key", "smallint", False),
    ("marriage_code", "smallint", False),
    ("marriage_desc", "string", False),
    ("is_documented", "boolean", False),
)

DIM_PAYMENT_STATUS = struct(
    ("pay_status_key", "smallint", False),
    ("pay_status_code", "smallint", False),
    ("documented_desc", "string", True),
    ("common_reading", "string", False),
    ("is_delinquent", "boolean", False),
    ("delinquent_months", "smallint", True),
)

DIM_CUSTOMER = struct(
    ("customer_sk", "bigint", False),
    ("client_id", "bigint", False),
    ("limit_bal", "decimal(12,2)", False),
    ("sex_key", "smallint", False),
    ("education_key", "smallint", False),
    ("marriage_key", "smallint", False),
    ("age", "smallint", False),
    ("age_band", "string", False),
    ("risk_tier", "string", False),
    ("valid_from_date", "int", False),
    ("valid_to_date", "int", False),
    ("is_current", "boolean", False),
    ("version_num", "smallint", False),
    ("row_hash", "binary", False),
    ("created_at", "timestamp", False),
)

FACT_MONTHLY_STATEMENT = struct(
    ("statement_sk", "bigint", False),
    ("customer_sk", "bigint", False),
    ("date_key", "int", False),
    ("pay_status_key", "smallint", False),
    ("client_id", "bigint", False),
    ("bill_amount", "decimal(18,2)", False),
    ("payment_amount", "decimal(18,2)", False),
    ("credit_limit", "decimal(12,2)", False),
    ("load_batch_id", "string", False),
)

FACT_DEFAULT_OUTCOME = struct(
    ("outcome_sk", "bigint", False),
    ("customer_sk", "bigint", False),
    ("date_key", "int", False),
    ("client_id", "bigint", False),
    ("is_default", "boolean", False),
    ("load_batch_id", "string", False),
)

QUALITY_RULE = struct(
    ("rule_id", "int", False),
    ("rule_code", "string", False),
    ("target_object", "string", False),
    ("severity", "string", False),
    ("description", "string", False),
)

QUALITY_RESULT = struct(
    ("result_id", "bigint", False),
    ("rule_id", "int", False),
    ("load_batch_id", "string", False),
    ("checked_at", "timestamp", False),
    ("rows_checked", "bigint", False),
    ("rows_failed", "bigint", False),
    ("sample_detail", "string", True),
)

LOAD_BATCH = struct(
    ("load_batch_id", "string", False),
    ("started_at", "timestamp", False),
    ("finished_at", "timestamp", True),
    ("source_name", "string", False),
    ("source_rows", "bigint", True),
    ("status", "string", False),
    ("message", "string", True),
)


@dataclass(frozen=True)
class Table:
    """One warehouse table: its layer, schema and declared keys.

    ``current_unique`` lists keys that must be unique among current versions,
    ``checks`` maps a column to its allowed values.  A generated primary key is
    a function of other columns: ``key_formula`` of ``key_from``.
    """

    layer: str
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    current_unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)
    checks: dict[str, tuple[str, ...]] = field(default_factory=dict)
    key_from: tuple[str, ...] = ()
    key_formula: str = ""

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


SEVERITIES = ("ERROR", "WARN", "INFO")
BATCH_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED")

TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table("stg", "credit_clients", STG_CREDIT_CLIENTS),
        Table("dw", "dim_date", DIM_DATE, ("date_key",), (("source_month_ix",),)),
        Table("dw", "dim_sex", DIM_SEX, ("sex_key",), (("sex_code",),)),
        Table("dw", "dim_education", DIM_EDUCATION, ("education_key",), (("education_code",),)),
        Table("dw", "dim_marriage", DIM_MARRIAGE, ("marriage_key",), (("marriage_code",),)),
        Table(
            "dw", "dim_payment_status", DIM_PAYMENT_STATUS, ("pay_status_key",), (("pay_status_code",),)
        ),
        Table(
            "dw",
            "dim_customer",
            DIM_CUSTOMER,
            ("customer_sk",),
            (("client_id", "valid_from_date"),),
            (("client_id",),),
            {
                "sex_key": "dim_sex.sex_key",
                "education_key": "dim_education.education_key",
                "marriage_key": "dim_marriage.marriage_key",
            },
            key_from=("client_id", "version_num"),
            key_formula=f"client_id * {VERSION_SPAN} + version_num",
        ),
        Table(
            "dw",
            "fact_monthly_statement",
            FACT_MONTHLY_STATEMENT,
            ("statement_sk",),
            (("client_id", "date_key"),),
            foreign_keys={
                "customer_sk": "dim_customer.customer_sk",
                "date_key": "dim_date.date_key",
                "pay_status_key": "dim_payment_status.pay_status_key",
            },
            key_from=("client_id", "date_key"),
            key_formula=f"client_id * {MONTH_SPAN} + date_key",
        ),
        Table(
            "dw",
            "fact_default_outcome",
            FACT_DEFAULT_OUTCOME,
            ("outcome_sk",),
            (("client_id",),),
            foreign_keys={
                "customer_sk": "dim_customer.customer_sk",
                "date_key": "dim_date.date_key",
            },
            key_from=("client_id",),
            key_formula="client_id",
        ),
        Table(
            "dq", "quality_rule", QUALITY_RULE, ("rule_id",), (("rule_code",),),
            checks={"severity": SEVERITIES},
        ),
        Table(
            "dq", "quality_result", QUALITY_RESULT, ("result_id",),
            foreign_keys={"rule_id": "quality_rule.rule_id"},
        ),
        Table(
            "dq", "load_batch", LOAD_BATCH, ("load_batch_id",), checks={"status": BATCH_STATUSES}
        ),
    ]
}
