"""Plain SQL for every registered query, over the whole tables.

Written from the rules, not from the Spark code: joins where Spark computes keys,
windows where Spark ranks in two passes, one statement per check.
"""

from __future__ import annotations

from tallyhouse.fixed_values import GOLD_TABLES, QUALITY_CHECKS, RECONCILIATION_COLUMNS, RISK_CATEGORIES

_RAW = """
tx_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'M' || lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS merchant_id,
         CAST(o_orderdate AS DATE) AS "date",
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS amount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'EUR' WHEN '2-HIGH' THEN 'GBP' ELSE 'USD' END AS currency,
         CASE WHEN o_orderstatus = 'F' THEN 'settled'
              WHEN o_orderstatus = 'P' THEN 'pending'
              WHEN o_orderkey % 5 = 0 THEN 'failed'
              ELSE 'completed' END AS status
  FROM orders),
rf_raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS refund_id,
         CAST(l_orderkey + CASE WHEN l_orderkey % 101 = 0 THEN 100000000 ELSE 0 END AS VARCHAR) AS transaction_id,
         'M' || lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS merchant_id,
         CAST(l_shipdate AS DATE) AS "date",
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS refund_amount,
         CASE l_linenumber WHEN 1 THEN 'fraud_suspected' WHEN 2 THEN 'defective_item' WHEN 3 THEN 'item_not_received'
                           WHEN 4 THEN 'customer_request' WHEN 5 THEN 'goodwill' WHEN 6 THEN 'duplicate__charge' END AS reason
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R'),
cb_raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS chargeback_id,
         CAST(l_orderkey AS VARCHAR) AS transaction_id,
         'M' || lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS merchant_id,
         CAST(l_shipdate AS DATE) AS "date",
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS chargeback_amount,
         '10.' || l_linenumber AS reason_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'A' AND l_linestatus = 'F')"""

_SILVER = (
    _RAW
    + """,
tx AS (
  SELECT *, "date" AS transaction_date FROM tx_raw WHERE transaction_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY "date" DESC NULLS LAST, amount DESC NULLS LAST, currency, merchant_id, status) = 1),
rf AS (
  SELECT *, "date" AS refund_date FROM rf_raw WHERE refund_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY refund_id
    ORDER BY "date" DESC NULLS LAST, refund_amount DESC NULLS LAST, transaction_id NULLS FIRST) = 1),
cb AS (
  SELECT *, "date" AS chargeback_date FROM cb_raw WHERE chargeback_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY chargeback_id
    ORDER BY "date" DESC NULLS LAST, chargeback_amount DESC NULLS LAST, transaction_id NULLS FIRST) = 1),
rf_sum AS (
  SELECT transaction_id, CAST(sum(CAST(refund_amount AS DECIMAL(18,2))) AS DOUBLE) AS refund_amount,
         max(refund_date) AS refund_date, count(refund_id) AS refund_count
  FROM rf GROUP BY transaction_id),
cb_sum AS (
  SELECT transaction_id, CAST(sum(CAST(chargeback_amount AS DECIMAL(18,2))) AS DOUBLE) AS chargeback_amount,
         max(chargeback_date) AS chargeback_date, count(chargeback_id) AS chargeback_count
  FROM cb GROUP BY transaction_id),
base AS (
  SELECT tx.transaction_id, tx.amount AS txn_amount, tx.transaction_date, rf_sum.refund_amount, rf_sum.refund_date,
         cb_sum.chargeback_amount, cb_sum.chargeback_date
  FROM tx LEFT JOIN rf_sum ON tx.transaction_id = rf_sum.transaction_id
          LEFT JOIN cb_sum ON tx.transaction_id = cb_sum.transaction_id)"""
)

_GOLD = (
    _SILVER
    + """,
bounds AS (
  SELECT min(d) AS min_d, max(d) AS max_d
  FROM (SELECT transaction_date AS d FROM tx UNION ALL SELECT refund_date FROM rf UNION ALL SELECT chargeback_date FROM cb)),
days AS (SELECT CAST(unnest(generate_series(min_d, max_d, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) AS quarter_name,
         CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name, strftime(d, '%b') AS month_abbr,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
         CAST(day(d) AS INTEGER) AS day_of_month, CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
         strftime(d, '%Y-%m') AS year_month
  FROM days),
dim_merchant AS (
  SELECT CAST(row_number() OVER (ORDER BY merchant_id) AS INTEGER) AS merchant_key, merchant_id, merchant_id AS merchant_name,
         'Unknown' AS merchant_category, 'Active' AS status
  FROM (SELECT DISTINCT merchant_id FROM tx WHERE merchant_id IS NOT NULL)),
dim_currency AS (
  SELECT CAST(row_number() OVER (ORDER BY currency) AS INTEGER) AS currency_key, currency AS currency_code,
         CASE WHEN currency = 'USD' THEN 'US Dollar' ELSE currency END AS currency_name, 2 AS decimal_places
  FROM (SELECT DISTINCT currency FROM tx WHERE currency IS NOT NULL)),
dim_transaction_status AS (
  SELECT CAST(row_number() OVER (ORDER BY status) AS INTEGER) AS status_key, status AS status_code,
         upper(status[1]) || lower(status[2:]) AS status_name,
         CASE WHEN status IN ('settled', 'completed') THEN 'SUCCESS' WHEN status IN ('failed', 'voided') THEN 'FAILURE'
              ELSE 'IN_PROGRESS' END AS status_category
  FROM (SELECT DISTINCT status FROM tx WHERE status IS NOT NULL)),
dim_refund_reason AS (
  SELECT CAST(row_number() OVER (ORDER BY reason) AS INTEGER) AS refund_reason_key, reason AS reason_code,
         replace(array_to_string(list_transform(string_split(replace(reason, '_', ' '), ' '),
                                                lambda w: upper(w[1]) || lower(w[2:])), ' '), '  ', ' ') AS reason_name,
         CASE WHEN contains(lower(reason), 'fraud') THEN 'HIGH_RISK'
              WHEN reason IN ('defective_item', 'item_not_received') THEN 'PRODUCT'
              WHEN reason IN ('customer_request', 'goodwill') THEN 'CUSTOMER' ELSE 'OPERATIONAL' END AS reason_category
  FROM (SELECT DISTINCT reason FROM rf WHERE reason IS NOT NULL)),
dim_chargeback_reason AS (
  SELECT CAST(row_number() OVER (ORDER BY reason_code) AS INTEGER) AS chargeback_reason_key, reason_code,
         reason_code AS reason_name, 'CARD_NETWORK' AS source_system
  FROM (SELECT DISTINCT reason_code FROM cb WHERE reason_code IS NOT NULL)),
measured AS (
  SELECT tx.*, CAST(coalesce(amount, 0) AS DECIMAL(18,2)) AS gross,
         CAST(coalesce(refund_amount, 0) AS DECIMAL(18,2)) AS refunded,
         CAST(coalesce(chargeback_amount, 0) AS DECIMAL(18,2)) AS charged_back,
         coalesce(refund_count, 0) AS refund_count, coalesce(chargeback_count, 0) AS chargeback_count
  FROM tx LEFT JOIN rf_sum ON tx.transaction_id = rf_sum.transaction_id
          LEFT JOIN cb_sum ON tx.transaction_id = cb_sum.transaction_id),
fact_transaction AS (
  SELECT row_number() OVER (ORDER BY f.transaction_id) AS transaction_key, f.transaction_id, d.date_key, m.merchant_key,
         c.currency_key, s.status_key, f.transaction_date,
         CAST(gross AS DOUBLE) AS gross_amount, CAST(refunded AS DOUBLE) AS refund_amount,
         CAST(charged_back AS DOUBLE) AS chargeback_amount, CAST(gross - refunded - charged_back AS DOUBLE) AS net_amount,
         CAST(refund_count AS INTEGER) AS refund_count, CAST(chargeback_count AS INTEGER) AS chargeback_count,
         CASE WHEN refunded > 0 THEN 1 ELSE 0 END AS has_refund, CASE WHEN charged_back > 0 THEN 1 ELSE 0 END AS has_chargeback,
         CASE WHEN amount IS NULL THEN 'INVALID_AMOUNT' WHEN charged_back > 0 THEN 'CHARGEBACK'
              WHEN refunded > gross * 0.5 THEN 'HIGH_REFUND' WHEN f.status IN ('failed', 'voided') THEN 'FAILED'
              ELSE 'NORMAL' END AS risk_category,
         'CARDS' AS source_system
  FROM measured f
  LEFT JOIN dim_date d ON f.transaction_date = d.full_date
  LEFT JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  LEFT JOIN dim_currency c ON f.currency = c.currency_code
  LEFT JOIN dim_transaction_status s ON f.status = s.status_code),
fact_refund AS (
  SELECT row_number() OVER (ORDER BY f.refund_id) AS refund_key, f.refund_id, f.transaction_id, d.date_key AS refund_date_key,
         m.merchant_key, 1 AS currency_key, r.refund_reason_key, f.refund_date, f.refund_amount,
         f.reason AS refund_reason_raw, 'CARDS' AS source_system
  FROM rf f
  LEFT JOIN dim_date d ON f.refund_date = d.full_date
  LEFT JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  LEFT JOIN dim_refund_reason r ON f.reason = r.reason_code),
fact_chargeback AS (
  SELECT row_number() OVER (ORDER BY f.chargeback_id) AS chargeback_key, f.chargeback_id, f.transaction_id,
         d.date_key AS chargeback_date_key, m.merchant_key, 1 AS currency_key, r.chargeback_reason_key, f.chargeback_date,
         f.chargeback_amount, f.reason_code, 'CARDS' AS source_system
  FROM cb f
  LEFT JOIN dim_date d ON f.chargeback_date = d.full_date
  LEFT JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  LEFT JOIN dim_chargeback_reason r ON f.reason_code = r.reason_code)"""
)


def _raw(select: str) -> str:
    return f"WITH {_RAW}\n{select}"


def _silver(select: str) -> str:
    return f"WITH {_SILVER}\n{select}"


def _gold(select: str) -> str:
    return f"WITH {_GOLD}\n{select}"


def _money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


_SUMS = (
    f"{_money('f.gross_amount')} AS revenue, {_money('f.refund_amount')} AS refunds, "
    f"{_money('f.chargeback_amount')} AS chargebacks, {_money('f.net_amount')} AS net_revenue"
)

_CHECK_SQL = {
    "transactions_uniqueness": "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT transaction_id FROM tx)) FROM tx",
    "refunds_uniqueness": "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT refund_id FROM rf)) FROM rf",
    "chargebacks_uniqueness": "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT chargeback_id FROM cb)) FROM cb",
    "refunds_referential_integrity": "SELECT count(*) FROM rf ANTI JOIN tx ON rf.transaction_id = tx.transaction_id",
    "chargebacks_referential_integrity": "SELECT count(*) FROM cb ANTI JOIN tx ON cb.transaction_id = tx.transaction_id",
    "refund_amount_rule": "SELECT count(*) FROM rf JOIN tx ON rf.transaction_id = tx.transaction_id WHERE refund_amount > amount",
    "chargeback_amount_rule": "SELECT count(*) FROM cb JOIN tx ON cb.transaction_id = tx.transaction_id WHERE chargeback_amount > amount",
    "refund_date_rule": "SELECT count(*) FROM rf JOIN tx ON rf.transaction_id = tx.transaction_id WHERE refund_date < transaction_date",
    "chargeback_date_rule": "SELECT count(*) FROM cb JOIN tx ON cb.transaction_id = tx.transaction_id WHERE chargeback_date < transaction_date",
    "transaction_amount_not_null": "SELECT count(*) FROM tx WHERE amount IS NULL",
    "positive_amounts_rule": "SELECT (SELECT count(*) FROM tx WHERE amount IS NULL OR amount <= 0)"
    " + (SELECT count(*) FROM rf WHERE refund_amount <= 0) + (SELECT count(*) FROM cb WHERE chargeback_amount <= 0)",
    "reconciled_total_amounts_rule": "SELECT count(*) FROM base WHERE CAST(coalesce(refund_amount, 0) AS DECIMAL(18,2))"
    " + CAST(coalesce(chargeback_amount, 0) AS DECIMAL(18,2)) > CAST(txn_amount AS DECIMAL(18,2))",
    "reconciliation_row_count_integrity": "SELECT abs((SELECT count(*) FROM base) - (SELECT count(*) FROM tx))",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_REPORT = "\nUNION ALL ".join(
    f"SELECT {_quoted(name)} AS name, {_quoted(QUALITY_CHECKS[name])} AS description,"
    f" CAST(m AS BIGINT) AS metric_value, CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({sql}) q(m)"
    for name, sql in _CHECK_SQL.items()
)

_RAW_UNIQUENESS = "\nUNION ALL ".join(
    f"SELECT '{entity}_uniqueness' AS name, CAST(m AS BIGINT) AS metric_value,"
    f" CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END AS status"
    f" FROM (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {raw})) FROM {raw}) q(m)"
    for entity, key, raw in (
        ("transactions", "transaction_id", "tx_raw"),
        ("refunds", "refund_id", "rf_raw"),
        ("chargebacks", "chargeback_id", "cb_raw"),
    )
)

_BASE_TYPES = ("string", "double", "date", "double", "date", "double", "date")
_PROFILE = "\nUNION ALL ".join(
    f"SELECT {place} AS position, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count,"
    f" count(*) - count({name}) AS null_count FROM base"
    for place, (name, kind) in enumerate(zip(RECONCILIATION_COLUMNS, _BASE_TYPES, strict=True), 1)
)


def _violation_sql() -> str:
    parts = []

    def count(table: str, rule: str, column: str, sql: str) -> None:
        parts.append(
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name,"
            f" CAST(({sql}) AS BIGINT) AS violations"
        )

    for table, fields in GOLD_TABLES.items():
        key = fields[0].name
        count(table, "primary_key", key, f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) FROM {table}")
        for field in fields:
            name = f'"{field.name}"'
            if field.required:
                count(table, "not_null", field.name, f"SELECT count(*) FROM {table} WHERE {name} IS NULL")
            if field.length:
                count(table, "max_length", field.name, f"SELECT count(*) FROM {table} WHERE length({name}) > {field.length}")
            if field.kind == "double":
                count(table, "precision", field.name, f"SELECT count(*) FROM {table} WHERE abs(round({name}, 2)) >= 1e16")
            if field.references:
                target = GOLD_TABLES[field.references][0].name
                count(
                    table,
                    "foreign_key",
                    field.name,
                    f"SELECT count(*) FROM {table} WHERE {name} IS NOT NULL"
                    f" AND {name} NOT IN (SELECT {target} FROM {field.references})",
                )
    return "\nUNION ALL ".join(parts)


_RISK_COLUMNS = ", ".join(
    f"count(*) FILTER (WHERE f.risk_category = '{name}') AS {name.lower()}" for name in RISK_CATEGORIES
)


def _rates(alias: str) -> str:
    return f"round(100.0 * CAST(sum(f.{alias}) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2)"


_MERCHANT_RISK = f"""
SELECT m.merchant_id, count(*) AS total_txns, {_money('f.gross_amount')} AS total_revenue,
       {_money('f.refund_amount')} AS total_refunds, {_money('f.chargeback_amount')} AS total_chargebacks,
       {_money('f.net_amount')} AS net_revenue, {_rates('has_refund')} AS refund_rate_pct,
       {_rates('has_chargeback')} AS chargeback_rate_pct,
       CAST(sum(CASE WHEN f.risk_category = 'CHARGEBACK' THEN 1 ELSE 0 END) AS BIGINT) AS chargeback_txns
FROM fact_transaction f JOIN dim_merchant m ON f.merchant_key = m.merchant_key
GROUP BY m.merchant_id"""

_REFUND_RULE = "FROM rf JOIN tx ON rf.transaction_id = tx.transaction_id"
_CHARGEBACK_RULE = "FROM cb JOIN tx ON cb.transaction_id = tx.transaction_id"
_REFUND_COLUMNS = "rf.refund_id, rf.transaction_id, refund_amount, refund_date, amount, transaction_date"
_CHARGEBACK_COLUMNS = "cb.chargeback_id, cb.transaction_id, chargeback_amount, chargeback_date, amount, transaction_date"

ORACLE: dict[str, str] = {
    "scan_transactions": _raw("SELECT * FROM tx_raw"),
    "scan_bronze_union": "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,"
    " CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders",
    "audit_columns": _raw(
        "SELECT *, TIMESTAMP '2024-02-01 06:30:00' AS load_timestamp, 'run-0001' AS pipeline_run_id,"
        " 'CARDS' AS source_system FROM tx_raw"
    ),
    "incremental_slice_orders": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-15'"
    " OR (o_orderdate = TIMESTAMP '1998-06-15' AND o_orderkey > 7000)",
    "incremental_slice_events": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-16 12:00:00'"
    " OR (ts = TIMESTAMP '2024-01-16 12:00:00' AND event_id > 5000)",
    "incremental_slice_null_watermarks": "SELECT * REPLACE (CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS o_orderdate)"
    " FROM orders WHERE o_orderkey % 50 = 0 OR o_orderdate > TIMESTAMP '1998-06-15'"
    " OR (o_orderdate = TIMESTAMP '1998-06-15' AND o_orderkey > 7000)",
    "checkpoint_orders": "SELECT 'orders' AS entity, 'o_orderdate' AS watermark_column, 'o_orderkey' AS primary_key,"
    " o_orderdate AS last_watermark, o_orderkey AS last_key FROM orders WHERE o_orderdate IS NOT NULL"
    " ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
    "checkpoint_events": "SELECT 'events' AS entity, 'ts' AS watermark_column, 'event_id' AS primary_key,"
    " ts AS last_watermark, event_id AS last_key FROM events WHERE ts IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT 1",
    "audit_total_records": _raw(
        "SELECT CAST((SELECT count(*) FROM tx_raw) + (SELECT count(*) FROM rf_raw) AS BIGINT) AS total_records"
    ),
    "stream_events_ingest": "SELECT * FROM events",
    "stream_events_dedup": "SELECT * FROM events",
    "stream_events_raw": "SELECT * FROM events",
    "standardize_transactions": _raw('SELECT *, "date" AS transaction_date FROM tx_raw'),
    "standardize_refunds": _raw('SELECT *, "date" AS refund_date FROM rf_raw'),
    "standardize_chargebacks": _raw('SELECT *, "date" AS chargeback_date FROM cb_raw'),
    "dedup_transactions": _silver("SELECT * FROM tx"),
    "dedup_updated_transactions": _raw(
        "SELECT transaction_id, merchant_id, \"date\", currency, \"date\" AS transaction_date,"
        " CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN CAST(floor(amount / 2) AS DOUBLE) ELSE amount END AS amount,"
        " CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN 'settled' ELSE status END AS status,"
        " CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN 'run-0002' ELSE 'run-0001' END AS pipeline_run_id FROM tx_raw"
    ),
    "dedup_refunds": _silver("SELECT * FROM rf"),
    "dedup_chargebacks": _silver("SELECT * FROM cb"),
    "refund_agg": _silver("SELECT transaction_id, refund_amount, refund_date FROM rf_sum"),
    "chargeback_agg": _silver("SELECT transaction_id, chargeback_amount, chargeback_date FROM cb_sum"),
    "refund_counts": _silver("SELECT transaction_id, refund_amount, refund_count FROM rf_sum"),
    "chargeback_counts": _silver("SELECT transaction_id, chargeback_amount, chargeback_count FROM cb_sum"),
    "reconciliation_base": _silver("SELECT * FROM base"),
    "profile_reconciliation_base": _silver(_PROFILE),
    "dq_report": _silver(_REPORT),
    "dq_summary": _silver(
        f"SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,"
        f" count(*) FILTER (WHERE status = 'FAIL') AS failed,"
        f" CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({_REPORT}) r"
    ),
    "dq_raw_uniqueness": _raw(_RAW_UNIQUENESS),
    "orphan_refunds": _silver(
        "SELECT refund_id, transaction_id, refund_amount FROM rf"
        " WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = rf.transaction_id)"
    ),
    "orphan_chargebacks": _silver(
        "SELECT chargeback_id, transaction_id, chargeback_amount FROM cb"
        " WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = cb.transaction_id)"
    ),
    "rule_refund_amount": _silver(f"SELECT {_REFUND_COLUMNS} {_REFUND_RULE} WHERE refund_amount > amount"),
    "rule_chargeback_amount": _silver(f"SELECT {_CHARGEBACK_COLUMNS} {_CHARGEBACK_RULE} WHERE chargeback_amount > amount"),
    "rule_refund_date": _silver(f"SELECT {_REFUND_COLUMNS} {_REFUND_RULE} WHERE refund_date < transaction_date"),
    "rule_chargeback_date": _silver(f"SELECT {_CHARGEBACK_COLUMNS} {_CHARGEBACK_RULE} WHERE chargeback_date < transaction_date"),
    "rule_reconciled_total": _silver(
        "SELECT * FROM base WHERE CAST(coalesce(refund_amount, 0) AS DECIMAL(18,2))"
        " + CAST(coalesce(chargeback_amount, 0) AS DECIMAL(18,2)) > CAST(txn_amount AS DECIMAL(18,2))"
    ),
    "implausible_dates": _silver(
        "\nUNION ALL ".join(
            f"SELECT '{entity}' AS entity, count(*) FILTER (WHERE {day} < DATE '1900-01-01' OR {day} > DATE '2001-06-30') AS metric_value"
            f" FROM {table}"
            for entity, day, table in (
                ("transactions", "transaction_date", "tx"),
                ("refunds", "refund_date", "rf"),
                ("chargebacks", "chargeback_date", "cb"),
            )
        )
    ),
    "date_bounds": _gold("SELECT * FROM bounds"),
    **{name: _gold(f"SELECT * FROM {name}") for name in GOLD_TABLES},
    "surrogate_key_orders": "SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS order_key,"
    " CAST(o_orderkey AS VARCHAR) AS order_id FROM orders",
    "lookup_merchant_key": _gold(
        "SELECT refund_id, rf.merchant_id, merchant_key FROM rf LEFT JOIN dim_merchant m ON rf.merchant_id = m.merchant_id"
    ),
    "lookup_date_key": _gold(
        "SELECT refund_id, refund_date, date_key FROM rf LEFT JOIN dim_date d ON rf.refund_date = d.full_date"
    ),
    "contract_fact_refund": _gold(
        "SELECT " + ", ".join(f"{f.name} AS {f.name.upper()}" for f in GOLD_TABLES["fact_refund"]) + " FROM fact_refund"
    ),
    "refreshed_fact_transaction": _gold(
        "SELECT f.* EXCLUDE (transaction_key, merchant_key, currency_key, status_key), m.merchant_id AS dim_merchant_code,"
        " c.currency_code AS dim_currency_code, s.status_code AS dim_transaction_status_code FROM fact_transaction f"
        " LEFT JOIN dim_merchant m USING (merchant_key) LEFT JOIN dim_currency c USING (currency_key)"
        " LEFT JOIN dim_transaction_status s USING (status_key)"
    ),
    "refreshed_fact_refund": _gold(
        "SELECT f.* EXCLUDE (refund_key, merchant_key, refund_reason_key), m.merchant_id AS dim_merchant_code,"
        " r.reason_code AS dim_refund_reason_code FROM fact_refund f"
        " LEFT JOIN dim_merchant m USING (merchant_key) LEFT JOIN dim_refund_reason r USING (refund_reason_key)"
    ),
    "refreshed_transaction_keys": _silver(
        "SELECT transaction_id, row_number() OVER (ORDER BY coalesce(transaction_date < DATE '1997-07-01', false) DESC, transaction_id)"
        " AS transaction_key FROM tx"
    ),
    "contract_fact_transaction": _gold(
        "SELECT " + ", ".join(f"{f.name} AS {f.name.upper()}" for f in GOLD_TABLES["fact_transaction"]) + " FROM fact_transaction"
    ),
    "contract_fact_transaction_decimal": _gold(
        "SELECT "
        + ", ".join(
            f"CAST({f.name} AS DECIMAL(18,2)) AS {f.name.upper()}" if f.kind == "double" else f"{f.name} AS {f.name.upper()}"
            for f in GOLD_TABLES["fact_transaction"]
        )
        + " FROM fact_transaction"
    ),
    "contract_violations": _gold(_violation_sql()),
    "row_counts": _gold(
        " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in GOLD_TABLES)
    ),
    "risk_summary": _gold(
        f"SELECT f.risk_category, count(*) AS txn_count, {_money('f.net_amount')} AS net_revenue"
        " FROM fact_transaction f GROUP BY f.risk_category"
    ),
    "vw_executive_summary": _gold(
        f"""SELECT d.full_date, d."year", d."month", d.year_month, m.merchant_id, {_SUMS}, count(*) AS txn_count,
       CAST(sum(f.has_refund) AS BIGINT) AS txn_with_refund, CAST(sum(f.has_chargeback) AS BIGINT) AS txn_with_chargeback
FROM fact_transaction f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_merchant m ON f.merchant_key = m.merchant_key
GROUP BY 1, 2, 3, 4, 5"""
    ),
    "vw_merchant_risk": _gold(_MERCHANT_RISK),
    "bi_kpis": _gold(
        f"SELECT {_SUMS}, count(*) AS total_transactions,"
        " CAST(sum(f.has_refund) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS refund_rate,"
        " CAST(sum(f.has_chargeback) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS chargeback_rate FROM fact_transaction f"
    ),
    "bi_revenue_trend": _gold(
        f"SELECT d.full_date, {_money('f.gross_amount')} AS revenue, {_money('f.net_amount')} AS net_revenue"
        " FROM fact_transaction f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.full_date"
    ),
    "bi_merchant_performance": _gold(
        "SELECT merchant_id, total_revenue AS revenue, net_revenue, total_refunds AS refunds,"
        f" total_chargebacks AS chargebacks, refund_rate_pct, chargeback_rate_pct FROM ({_MERCHANT_RISK}) r"
    ),
    "bi_risk_by_merchant": _gold(
        f"SELECT m.merchant_id, {_RISK_COLUMNS} FROM fact_transaction f"
        " JOIN dim_merchant m ON f.merchant_key = m.merchant_key GROUP BY m.merchant_id"
    ),
    "bi_chargeback_reasons": _gold(
        f"SELECT r.reason_code, r.reason_name, count(*) AS chargeback_count, {_money('f.chargeback_amount')} AS chargeback_amount"
        " FROM fact_chargeback f JOIN dim_chargeback_reason r ON f.chargeback_reason_key = r.chargeback_reason_key GROUP BY 1, 2"
    ),
    "bi_chargeback_trend": _gold(
        f"SELECT d.full_date, count(*) AS chargeback_count, {_money('f.chargeback_amount')} AS chargeback_amount"
        " FROM fact_chargeback f JOIN dim_date d ON f.chargeback_date_key = d.date_key GROUP BY d.full_date"
    ),
    "bi_top_risk_merchants": _gold(
        "SELECT merchant_id, chargeback_rate_pct, chargeback_txns, total_txns"
        f" FROM ({_MERCHANT_RISK}) r ORDER BY chargeback_rate_pct DESC, merchant_id LIMIT 10"
    ),
    "bi_operational_metrics": _gold(
        f"SELECT d.full_date, count(*) AS txn_count, {_money('f.gross_amount')} / CAST(count(f.gross_amount) AS DOUBLE) AS avg_amount"
        " FROM fact_transaction f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.full_date"
    ),
    "bi_status_breakdown": _gold(
        f"SELECT s.status_code, s.status_name, s.status_category, count(*) AS txn_count,"
        f" {_money('f.gross_amount')} AS revenue, {_money('f.net_amount')} AS net_revenue"
        " FROM fact_transaction f JOIN dim_transaction_status s ON f.status_key = s.status_key GROUP BY 1, 2, 3"
    ),
    "bi_refund_vs_chargeback": _gold(
        """, r AS (SELECT refund_date_key AS k, count(*) AS n FROM fact_refund GROUP BY 1),
c AS (SELECT chargeback_date_key AS k, count(*) AS n FROM fact_chargeback GROUP BY 1)
SELECT d.full_date, coalesce(r.n, 0) AS refund_count, coalesce(c.n, 0) AS chargeback_count
FROM r FULL JOIN c ON r.k = c.k JOIN dim_date d ON coalesce(r.k, c.k) = d.date_key"""
    ),
    "bi_sliced_summary": _gold(
        f"""SELECT m.merchant_id, f.risk_category, count(*) AS txn_count, {_SUMS}
FROM fact_transaction f
JOIN dim_date d ON f.date_key = d.date_key
JOIN dim_merchant m ON f.merchant_key = m.merchant_key
JOIN dim_transaction_status s ON f.status_key = s.status_key
WHERE d.full_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND m.merchant_id IN ('M003', 'M007', 'M011', 'M019', 'M023', 'M031', 'M042')
  AND s.status_code IN ('settled', 'completed') AND f.risk_category IN ('NORMAL', 'HIGH_REFUND', 'CHARGEBACK')
GROUP BY 1, 2"""
    ),
}
