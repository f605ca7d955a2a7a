"""Expected contents of constant tables, written out for the SQL counterparts.

These are fixed values: they state what the library must produce and are not
derived from it.
"""

# key, code, documented meaning, common reading, late, months late
PAYMENT_STATUS = [
    (1, -2, None, '當期無消費（推論）', False, None),
    (2, -1, '按時繳款', '按時繳清', False, None),
    (3, 0, None, '使用循環信用（推論）', False, None),
    (4, 1, '延遲 1 個月', '延遲 1 個月', True, 1),
    (5, 2, '延遲 2 個月', '延遲 2 個月', True, 2),
    (6, 3, '延遲 3 個月', '延遲 3 個月', True, 3),
    (7, 4, '延遲 4 個月', '延遲 4 個月', True, 4),
    (8, 5, '延遲 5 個月', '延遲 5 個月', True, 5),
    (9, 6, '延遲 6 個月', '延遲 6 個月', True, 6),
    (10, 7, '延遲 7 個月', '延遲 7 個月', True, 7),
    (11, 8, '延遲 8 個月', '延遲 8 個月', True, 8),
    (12, 9, '延遲 9 個月以上', '延遲 9 個月以上', True, 9),
]

# key, code, label, documented
EDUCATION = [
    (1, 1, '研究所', True),
    (2, 2, '大學', True),
    (3, 3, '高中', True),
    (4, 4, '其他', True),
    (5, 0, '未定義碼值 0', False),
    (6, 5, '未定義碼值 5', False),
    (7, 6, '未定義碼值 6', False),
]

# key, code, label, documented
MARRIAGE = [
    (1, 1, '已婚', True),
    (2, 2, '單身', True),
    (3, 3, '其他', True),
    (4, 0, '未定義碼值 0', False),
]

# key, code, label
SEX = [
    (1, 1, '男'),
    (2, 2, '女'),
]

# id, code, target, severity, description
QUALITY_RULES = [
    (1, 'STG_ROWCOUNT', 'stg.credit_clients', 'ERROR', '暫存區載入筆數需等於來源筆數，落差代表擷取階段掉資料'),
    (2, 'STG_PK_UNIQUE', 'stg.credit_clients', 'ERROR', 'client_id 在單一批次內必須唯一'),
    (3, 'DIM_EDU_UNDOCUMENTED', 'dw.dim_customer', 'WARN', '教育程度落在官方文件未定義的碼值（0/5/6）'),
    (4, 'DIM_MAR_UNDOCUMENTED', 'dw.dim_customer', 'WARN', '婚姻狀況落在官方文件未定義的碼值（0）'),
    (5, 'FACT_GRAIN', 'dw.fact_monthly_statement', 'ERROR', '事實表粒度必須為「客戶×月份」唯一，重複即為 ETL 重跑造成的重複載入'),
    (6, 'FACT_ORPHAN_FK', 'dw.fact_monthly_statement', 'ERROR', '事實列的 customer_sk 必須存在於維度表（孤兒鍵）'),
    (7, 'FACT_ROWCOUNT', 'dw.fact_monthly_statement', 'ERROR', '事實筆數需等於 客戶數 × 月份數，落差代表攤平階段掉列'),
    (8, 'SCD2_NO_OVERLAP', 'dw.dim_customer', 'ERROR', '同一客戶的版本有效期間不得重疊，重疊會讓事實表關聯到兩個版本'),
    (9, 'SCD2_ONE_CURRENT', 'dw.dim_customer', 'ERROR', '同一客戶恰有一筆 is_current=1'),
    (10, 'FACT_NEG_PAYMENT', 'dw.fact_monthly_statement', 'WARN', '繳款金額為負；來源確實存在，多為退款或調整，保留但標記'),
    (11, 'FACT_BILL_OVER_LIMIT', 'dw.fact_monthly_statement', 'WARN', '帳單金額超過信用額度；可能為超額動用或額度調降，需業務確認'),
    (12, 'OUTCOME_COVERAGE', 'dw.fact_default_outcome', 'ERROR', '每位客戶都應有一筆違約結果'),
]

# table, position, column, type, nullable, key role, reference
DICTIONARY = [
    ('stg.credit_clients', 1, 'client_id', 'bigint', '否', '', ''),
    ('stg.credit_clients', 2, 'limit_bal', 'decimal(12,2)', '是', '', ''),
    ('stg.credit_clients', 3, 'sex', 'smallint', '是', '', ''),
    ('stg.credit_clients', 4, 'education', 'smallint', '是', '', ''),
    ('stg.credit_clients', 5, 'marriage', 'smallint', '是', '', ''),
    ('stg.credit_clients', 6, 'age', 'smallint', '是', '', ''),
    ('stg.credit_clients', 7, 'pay_1', 'smallint', '是', '', ''),
    ('stg.credit_clients', 8, 'pay_2', 'smallint', '是', '', ''),
    ('stg.credit_clients', 9, 'pay_3', 'smallint', '是', '', ''),
    ('stg.credit_clients', 10, 'pay_4', 'smallint', '是', '', ''),
    ('stg.credit_clients', 11, 'pay_5', 'smallint', '是', '', ''),
    ('stg.credit_clients', 12, 'pay_6', 'smallint', '是', '', ''),
    ('stg.credit_clients', 13, 'bill_amt1', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 14, 'bill_amt2', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 15, 'bill_amt3', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 16, 'bill_amt4', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 17, 'bill_amt5', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 18, 'bill_amt6', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 19, 'pay_amt1', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 20, 'pay_amt2', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 21, 'pay_amt3', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 22, 'pay_amt4', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 23, 'pay_amt5', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 24, 'pay_amt6', 'decimal(18,2)', '是', '', ''),
    ('stg.credit_clients', 25, 'default_next_month', 'boolean', '是', '', ''),
    ('stg.credit_clients', 26, 'load_batch_id', 'string', '否', '', ''),
    ('stg.credit_clients', 27, 'loaded_at', 'timestamp', '否', '', ''),
    ('dw.dim_date', 1, 'date_key', 'int', '否', 'PK', ''),
    ('dw.dim_date', 2, 'year_num', 'smallint', '否', '', ''),
    ('dw.dim_date', 3, 'month_num', 'smallint', '否', '', ''),
    ('dw.dim_date', 4, 'month_name_zh', 'string', '否', '', ''),
    ('dw.dim_date', 5, 'quarter_num', 'smallint', '否', '', ''),
    ('dw.dim_date', 6, 'month_end_date', 'date', '否', '', ''),
    ('dw.dim_date', 7, 'source_month_ix', 'smallint', '否', '', ''),
    ('dw.dim_sex', 1, 'sex_key', 'smallint', '否', 'PK', ''),
    ('dw.dim_sex', 2, 'sex_code', 'smallint', '否', '', ''),
    ('dw.dim_sex', 3, 'sex_desc', 'string', '否', '', ''),
    ('dw.dim_education', 1, 'education_key', 'smallint', '否', 'PK', ''),
    ('dw.dim_education', 2, 'education_code', 'smallint', '否', '', ''),
    ('dw.dim_education', 3, 'education_desc', 'string', '否', '', ''),
    ('dw.dim_education', 4, 'is_documented', 'boolean', '否', '', ''),
    ('dw.dim_marriage', 1, 'marriage_key', 'smallint', '否', 'PK', ''),
    ('dw.dim_marriage', 2, 'marriage_code', 'smallint', '否', '', ''),
    ('dw.dim_marriage', 3, 'marriage_desc', 'string', '否', '', ''),
    ('dw.dim_marriage', 4, 'is_documented', 'boolean', '否', '', ''),
    ('dw.dim_payment_status', 1, 'pay_status_key', 'smallint', '否', 'PK', ''),
    ('dw.dim_payment_status', 2, 'pay_status_code', 'smallint', '否', '', ''),
    ('dw.dim_payment_status', 3, 'documented_desc', 'string', '是', '', ''),
    ('dw.dim_payment_status', 4, 'common_reading', 'string', '否', '', ''),
    ('dw.dim_payment_status', 5, 'is_delinquent', 'boolean', '否', '', ''),
    ('dw.dim_payment_status', 6, 'delinquent_months', 'smallint', '是', '', ''),
    ('dw.dim_customer', 1, 'customer_sk', 'bigint', '否', 'PK', ''),
    ('dw.dim_customer', 2, 'client_id', 'bigint', '否', '', ''),
    ('dw.dim_customer', 3, 'limit_bal', 'decimal(12,2)', '否', '', ''),
    ('dw.dim_customer', 4, 'sex_key', 'smallint', '否', 'FK', 'dw.dim_sex.sex_key'),
    ('dw.dim_customer', 5, 'education_key', 'smallint', '否', 'FK', 'dw.dim_education.education_key'),
    ('dw.dim_customer', 6, 'marriage_key', 'smallint', '否', 'FK', 'dw.dim_marriage.marriage_key'),
    ('dw.dim_customer', 7, 'age', 'smallint', '否', '', ''),
    ('dw.dim_customer', 8, 'age_band', 'string', '否', '', ''),
    ('dw.dim_customer', 9, 'risk_tier', 'string', '否', '', ''),
    ('dw.dim_customer', 10, 'valid_from_date', 'int', '否', '', ''),
    ('dw.dim_customer', 11, 'valid_to_date', 'int', '否', '', ''),
    ('dw.dim_customer', 12, 'is_current', 'boolean', '否', '', ''),
    ('dw.dim_customer', 13, 'version_num', 'smallint', '否', '', ''),
    ('dw.dim_customer', 14, 'row_hash', 'binary', '否', '', ''),
    ('dw.dim_customer', 15, 'created_at', 'timestamp', '否', '', ''),
    ('dw.fact_monthly_statement', 1, 'statement_sk', 'bigint', '否', 'PK', ''),
    ('dw.fact_monthly_statement', 2, 'customer_sk', 'bigint', '否', 'FK', 'dw.dim_customer.customer_sk'),
    ('dw.fact_monthly_statement', 3, 'date_key', 'int', '否', 'FK', 'dw.dim_date.date_key'),
    ('dw.fact_monthly_statement', 4, 'pay_status_key', 'smallint', '否', 'FK', 'dw.dim_payment_status.pay_status_key'),
    ('dw.fact_monthly_statement', 5, 'client_id', 'bigint', '否', '', ''),
    ('dw.fact_monthly_statement', 6, 'bill_amount', 'decimal(18,2)', '否', '', ''),
    ('dw.fact_monthly_statement', 7, 'payment_amount', 'decimal(18,2)', '否', '', ''),
    ('dw.fact_monthly_statement', 8, 'credit_limit', 'decimal(12,2)', '否', '', ''),
    ('dw.fact_monthly_statement', 9, 'load_batch_id', 'string', '否', '', ''),
    ('dw.fact_default_outcome', 1, 'outcome_sk', 'bigint', '否', 'PK', ''),
    ('dw.fact_default_outcome', 2, 'customer_sk', 'bigint', '否', 'FK', 'dw.dim_customer.customer_sk'),
    ('dw.fact_default_outcome', 3, 'date_key', 'int', '否', 'FK', 'dw.dim_date.date_key'),
    ('dw.fact_default_outcome', 4, 'client_id', 'bigint', '否', '', ''),
    ('dw.fact_default_outcome', 5, 'is_default', 'boolean', '否', '', ''),
    ('dw.fact_default_outcome', 6, 'load_batch_id', 'string', '否', '', ''),
    ('dq.quality_rule', 1, 'rule_id', 'int', '否', 'PK', ''),
    ('dq.quality_rule', 2, 'rule_code', 'string', '否', '', ''),
    ('dq.quality_rule', 3, 'target_object', 'string', '否', '', ''),
    ('dq.quality_rule', 4, 'severity', 'string', '否', '', ''),
    ('dq.quality_rule', 5, 'description', 'string', '否', '', ''),
    ('dq.quality_result', 1, 'result_id', 'bigint', '否', 'PK', ''),
    ('dq.quality_result', 2, 'rule_id', 'int', '否', 'FK', 'dq.quality_rule.rule_id'),
    ('dq.quality_result', 3, 'load_batch_id', 'string', '否', '', ''),
    ('dq.quality_result', 4, 'checked_at', 'timestamp', '否', '', ''),
    ('dq.quality_result', 5, 'rows_checked', 'bigint', '否', '', ''),
    ('dq.quality_result', 6, 'rows_failed', 'bigint', '否', '', ''),
    ('dq.quality_result', 7, 'sample_detail', 'string', '是', '', ''),
    ('dq.load_batch', 1, 'load_batch_id', 'string', '否', 'PK', ''),
    ('dq.load_batch', 2, 'started_at', 'timestamp', '否', '', ''),
    ('dq.load_batch', 3, 'finished_at', 'timestamp', '是', '', ''),
    ('dq.load_batch', 4, 'source_name', 'string', '否', '', ''),
    ('dq.load_batch', 5, 'source_rows', 'bigint', '是', '', ''),
    ('dq.load_batch', 6, 'status', 'string', '否', '', ''),
    ('dq.load_batch', 7, 'message', 'string', '是', '', ''),
]

# table, kind, columns, formula or key or reference
CONSTRAINTS = [
    ('credit_clients', 'NOT NULL', 'client_id', ''),
    ('credit_clients', 'NOT NULL', 'load_batch_id', ''),
    ('credit_clients', 'NOT NULL', 'loaded_at', ''),
    ('dim_customer', 'NOT NULL', 'customer_sk', ''),
    ('dim_customer', 'NOT NULL', 'client_id', ''),
    ('dim_customer', 'NOT NULL', 'limit_bal', ''),
    ('dim_customer', 'NOT NULL', 'sex_key', ''),
    ('dim_customer', 'NOT NULL', 'education_key', ''),
    ('dim_customer', 'NOT NULL', 'marriage_key', ''),
    ('dim_customer', 'NOT NULL', 'age', ''),
    ('dim_customer', 'NOT NULL', 'age_band', ''),
    ('dim_customer', 'NOT NULL', 'risk_tier', ''),
    ('dim_customer', 'NOT NULL', 'valid_from_date', ''),
    ('dim_customer', 'NOT NULL', 'valid_to_date', ''),
    ('dim_customer', 'NOT NULL', 'is_current', ''),
    ('dim_customer', 'NOT NULL', 'version_num', ''),
    ('dim_customer', 'NOT NULL', 'row_hash', ''),
    ('dim_customer', 'NOT NULL', 'created_at', ''),
    ('dim_customer', 'KEY FORMULA', 'customer_sk', 'client_id * 65536 + version_num'),
    ('dim_customer', 'PRIMARY KEY', 'client_id,version_num', 'customer_sk'),
    ('dim_customer', 'UNIQUE', 'client_id,valid_from_date', ''),
    ('dim_customer', 'UNIQUE CURRENT', 'client_id', ''),
    ('dim_customer', 'FOREIGN KEY', 'sex_key', 'dim_sex.sex_key'),
    ('dim_customer', 'FOREIGN KEY', 'education_key', 'dim_education.education_key'),
    ('dim_customer', 'FOREIGN KEY', 'marriage_key', 'dim_marriage.marriage_key'),
    ('fact_monthly_statement', 'NOT NULL', 'statement_sk', ''),
    ('fact_monthly_statement', 'NOT NULL', 'customer_sk', ''),
    ('fact_monthly_statement', 'NOT NULL', 'date_key', ''),
    ('fact_monthly_statement', 'NOT NULL', 'pay_status_key', ''),
    ('fact_monthly_statement', 'NOT NULL', 'client_id', ''),
    ('fact_monthly_statement', 'NOT NULL', 'bill_amount', ''),
    ('fact_monthly_statement', 'NOT NULL', 'payment_amount', ''),
    ('fact_monthly_statement', 'NOT NULL', 'credit_limit', ''),
    ('fact_monthly_statement', 'NOT NULL', 'load_batch_id', ''),
    ('fact_monthly_statement', 'KEY FORMULA', 'statement_sk', 'client_id * 1000000 + date_key'),
    ('fact_monthly_statement', 'UNIQUE', 'client_id,date_key', ''),
    ('fact_monthly_statement', 'FOREIGN KEY', 'customer_sk', 'dim_customer.customer_sk'),
    ('fact_monthly_statement', 'FOREIGN KEY', 'date_key', 'dim_date.date_key'),
    ('fact_monthly_statement', 'FOREIGN KEY', 'pay_status_key', 'dim_payment_status.pay_status_key'),
    ('fact_default_outcome', 'NOT NULL', 'outcome_sk', ''),
    ('fact_default_outcome', 'NOT NULL', 'customer_sk', ''),
    ('fact_default_outcome', 'NOT NULL', 'date_key', ''),
    ('fact_default_outcome', 'NOT NULL', 'client_id', ''),
    ('fact_default_outcome', 'NOT NULL', 'is_default', ''),
    ('fact_default_outcome', 'NOT NULL', 'load_batch_id', ''),
    ('fact_default_outcome', 'KEY FORMULA', 'outcome_sk', 'client_id'),
    ('fact_default_outcome', 'UNIQUE', 'client_id', ''),
    ('fact_default_outcome', 'FOREIGN KEY', 'customer_sk', 'dim_customer.customer_sk'),
    ('fact_default_outcome', 'FOREIGN KEY', 'date_key', 'dim_date.date_key'),
]
