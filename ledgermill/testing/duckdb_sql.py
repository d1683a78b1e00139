"""DuckDB statements for the registered queries, written against the test tables as views.

Each named part is one common table expression; a statement pulls in the parts it mentions.
"""

from __future__ import annotations

import re

from ledgermill.testing.bindings import AS_OF, T0, T1

# Fixed values, stated here on their own: the risk codes, and the codes of the test transactions in order.
RISK_MCC_ROWS = (
    (5411, "Grocery", 15), (5812, "Restaurants", 20), (4111, "Transport", 25), (6011, "ATM Cash", 55),
    (6012, "Financial Institution", 40), (7995, "Gambling", 95), (7801, "Online Gaming", 85),
    (4829, "Wire Transfer", 75), (5944, "Jewelry", 60), (5732, "Electronics", 45),
)
BINDING_MCC = (5411, 5812, 4111, 6011, 6012, 7995, 7801, 4829, 5944, 5732, 5999, 5541, 4900)


def _ts(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


_T0, _T1, _NOW = _ts(T0), _ts(T1), _ts(AS_OF)
_CODES = ", ".join(f"'{c}'" for c in BINDING_MCC)
_SEED = ", ".join(f"({code}, '{name}', {weight})" for code, name, weight in RISK_MCC_ROWS)
_PERSON = """
    cast(c_custkey AS INTEGER) AS customer_id, concat(' ', c_name, ' ') AS full_name,
    CASE WHEN c_custkey % 10 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN NULL
         ELSE concat(' 77', lpad(cast(c_custkey AS VARCHAR), 9, '0')) END AS phone,
    CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 8 = 0 THEN NULL
         ELSE concat('u', cast(c_custkey AS VARCHAR), '@example.com ') END AS email,
    DATE '1980-01-01' AS birth_date, n_name AS city"""
_PERSON_TAIL = """
    DATE '2020-01-01' AS registration_date,
    CASE WHEN c_custkey % 5 = 0 THEN 'blocked' ELSE 'active' END AS status,
    'crm_db' AS source_system"""


def _text(column: str) -> str:
    return f"nullif(trim({column}, ' '), '') AS {column}"


def _newest(rows: str, key: str, columns: str, version: str = "bronze_loaded_at") -> str:
    """Top row per key and source system, ties ranked by all remaining columns."""
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in [version, *columns.split(",")])
    return f"""SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY {key}, source_system ORDER BY {order}) AS place FROM ({rows}) x
    ) y WHERE place = 1"""


def _customer_dim(raw: str) -> str:
    rows = f"""SELECT customer_id, trim(full_name, ' ') AS full_name,
        sha256(nullif(trim(phone, ' '), '')) AS phone_hash, sha256(nullif(trim(email, ' '), '')) AS email_hash,
        birth_date, {_text('city')}, {_text('segment')}, registration_date, {_text('status')},
        source_system, load_dttm AS bronze_loaded_at FROM {raw} WHERE customer_id > 0"""
    order = "full_name, phone_hash, email_hash, birth_date, city, segment, registration_date, status"
    return f"SELECT *, {_NOW} AS updated_at FROM ({_newest(rows, 'customer_id', order)}) z"


def _silver(rows: str, key: str, order: str) -> str:
    return f"SELECT *, {_NOW} AS updated_at FROM ({_newest(rows, key, order)}) z"


PARTS: dict[str, str] = {
    # -- raw shapes
    "crm_customers_raw": f"""
        SELECT {_PERSON}, c_mktsegment AS segment, {_PERSON_TAIL}, {_T0} AS load_dttm
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT {_PERSON}, 'PREMIUM' AS segment, {_PERSON_TAIL}, {_T1} AS load_dttm
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0""",
    "core_accounts_raw": f"""
        SELECT concat('ACC', cast(o_orderkey AS VARCHAR)) AS account_id, cast(o_custkey AS INTEGER) AS customer_id,
            o_orderpriority AS product_type,
            CASE o_orderstatus WHEN 'F' THEN 'KZT' WHEN 'O' THEN 'USD' ELSE 'EUR' END AS currency,
            cast(cast(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 1 END
                 AS DECIMAL(18,2)) AS balance,
            cast(o_orderdate AS DATE) AS opened_date, cast(NULL AS DATE) AS closed_date, 'active' AS status,
            'core_banking_db' AS source_system, {_T0} AS load_dttm
        FROM orders""",
    "card_cards_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS card_id, concat('ACC', cast(l_orderkey AS VARCHAR)) AS account_id,
            cast(NULL AS VARCHAR) AS card_pan_hash, l_returnflag AS card_product, cast(NULL AS DATE) AS expiry_date,
            cast(NULL AS VARCHAR) AS embossed_name, l_linestatus AS card_status,
            cast(l_shipdate AS DATE) AS issue_date, 'card_processing_db' AS source_system, l_shipdate AS load_dttm
        FROM lineitem""",
    "payments_transactions_raw": f"""
        SELECT l_orderkey * 10 + l_linenumber AS trx_id, concat('ACC', cast(l_orderkey AS VARCHAR)) AS account_id,
            cast(o_custkey AS INTEGER) AS customer_id, l_orderkey * 10 + l_linenumber AS card_id,
            CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END AS trx_datetime, 'debit' AS trx_type,
            cast(l_extendedprice AS DECIMAL(18,2)) AS amount, 'KZT' AS currency, l_returnflag AS channel,
            list_extract([{_CODES}], cast(l_partkey % {len(BINDING_MCC)} AS INTEGER) + 1) AS merchant_category_code,
            concat(' S', cast(l_suppkey AS VARCHAR)) AS counterparty_name, l_linestatus AS status,
            CASE WHEN l_partkey % 34 = 0 THEN NULL ELSE cast(l_shipdate AS DATE) END AS posting_date,
            'transactions_db' AS source_system, l_shipdate AS load_dttm
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "mobile_app_sessions_raw": f"""
        SELECT concat(cast(user_id AS VARCHAR), '-', cast(cast(ts AS DATE) AS VARCHAR)) AS session_id,
            cast(user_id AS INTEGER) AS customer_id, min(ts) AS login_time, max(ts) AS logout_time,
            ' ios ' AS device_type, '' AS app_version, cast(NULL AS VARCHAR) AS ip_address,
            cast(NULL AS VARCHAR) AS os_version, min(event_id) % 4 = 0 AS is_new_device,
            'mobile_app_db' AS source_system, {_T1} AS load_dttm
        FROM events GROUP BY user_id, cast(ts AS DATE)""",
    "mobile_app_events_raw": f"""
        SELECT event_id, concat(cast(user_id AS VARCHAR), '-', cast(cast(ts AS DATE) AS VARCHAR)) AS session_id,
            cast(user_id AS INTEGER) AS customer_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS event_time,
            event_type, props AS event_data_raw, event_type <> 'error' AS is_successful,
            CASE WHEN event_type = 'error' THEN ' declined ' ELSE '' END AS error_message,
            'mobile_app_db' AS source_system, {_T1} AS load_dttm
        FROM events""",
    "load_audit": """
        SELECT cast(event_id AS VARCHAR) AS run_id, event_type AS mapping_name,
            CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'success' END AS status,
            event_id % 1000 AS rows_loaded, ts AS started_at
        FROM events""",
    "load_state": """
        SELECT o_orderpriority AS mapping_name, cast(o_orderkey AS VARCHAR) AS watermark_value,
            'int' AS watermark_type, o_orderdate AS updated_at
        FROM orders""",
    "risk_mcc_codes": f"SELECT * FROM (VALUES {_SEED}) AS s(mcc_code, mcc_category, risk_weight)",
    # -- silver
    "dim_customer": _customer_dim("crm_customers_raw"),
    "dim_account": _silver(
        f"""SELECT account_id, customer_id, {_text('product_type')}, {_text('currency')}, balance, opened_date,
            closed_date, {_text('status')}, source_system, load_dttm AS bronze_loaded_at
        FROM core_accounts_raw WHERE customer_id > 0 AND account_id <> ''""",
        "account_id",
        "customer_id, product_type, currency, balance, opened_date, closed_date, status",
    ),
    "dim_card": _silver(
        f"""SELECT card_id, account_id, card_pan_hash, {_text('card_product')}, expiry_date,
            {_text('embossed_name')}, {_text('card_status')}, issue_date, source_system,
            load_dttm AS bronze_loaded_at
        FROM card_cards_raw WHERE account_id <> '' AND card_id > 0""",
        "card_id",
        "account_id, card_pan_hash, card_product, expiry_date, embossed_name, card_status, issue_date",
    ),
    "fact_transaction": _silver(
        f"""SELECT trx_id, account_id, customer_id, card_id, moment AS trx_datetime, cast(moment AS DATE) AS trx_date,
            {_text('trx_type')}, amount, {_text('currency')}, {_text('channel')}, merchant_category_code,
            {_text('counterparty_name')}, {_text('status')}, posting_date, source_system,
            load_dttm AS bronze_loaded_at
        FROM (SELECT *, coalesce(trx_datetime, cast(posting_date AS TIMESTAMP)) AS moment
              FROM payments_transactions_raw) p
        WHERE moment IS NOT NULL AND trx_id > 0 AND customer_id > 0 AND account_id <> ''""",
        "trx_id",
        "account_id, customer_id, card_id, trx_datetime, trx_date, trx_type, amount, currency, channel, "
        "merchant_category_code, counterparty_name, status, posting_date",
    ),
    "fact_app_session": _silver(
        f"""SELECT session_id, customer_id, login_time, logout_time,
            cast(coalesce(login_time, load_dttm) AS DATE) AS session_date, {_text('device_type')},
            {_text('app_version')}, {_text('ip_address')}, {_text('os_version')}, is_new_device, source_system,
            load_dttm AS bronze_loaded_at
        FROM mobile_app_sessions_raw WHERE customer_id > 0 AND session_id <> ''""",
        "session_id",
        "customer_id, login_time, logout_time, session_date, device_type, app_version, ip_address, os_version, "
        "is_new_device",
    ),
    "fact_app_event": _silver(
        f"""SELECT event_id, session_id, customer_id, event_time,
            cast(coalesce(event_time, load_dttm) AS DATE) AS event_date, {_text('event_type')}, event_data_raw,
            is_successful, {_text('error_message')}, source_system, load_dttm AS bronze_loaded_at
        FROM mobile_app_events_raw WHERE customer_id > 0 AND event_id > 0 AND session_id <> ''""",
        "event_id",
        "session_id, customer_id, event_time, event_date, event_type, event_data_raw, is_successful, error_message",
    ),
    # -- customer history: one state per run, then the versions each key goes through
    "state_1": _customer_dim(f"(SELECT * FROM crm_customers_raw WHERE load_dttm = {_T0} AND city <> 'NATION_7')"),
    "state_2": _customer_dim("(SELECT * FROM crm_customers_raw WHERE city <> 'NATION_3')"),
    "states": f"""
        SELECT 1 AS run, {_T0} AS run_ts, * REPLACE ({_T0} AS updated_at) FROM state_1 UNION ALL
        SELECT 2 AS run, {_T1} AS run_ts, * REPLACE ({_T1} AS updated_at) FROM state_2 UNION ALL
        SELECT 3 AS run, {_NOW} AS run_ts, * FROM dim_customer""",
    "steps": """
        SELECT *, lag(run) OVER k AS seen_run, lag(full_name) OVER k AS was_name, lag(segment) OVER k AS was_segment,
            lag(status) OVER k AS was_status, lag(city) OVER k AS was_city,
            lead(run) OVER k AS next_run
        FROM states WINDOW k AS (PARTITION BY customer_id ORDER BY run)""",
    "starts": """
        SELECT * FROM steps WHERE seen_run IS DISTINCT FROM run - 1 OR was_name IS DISTINCT FROM full_name
            OR was_segment IS DISTINCT FROM segment OR was_status IS DISTINCT FROM status
            OR was_city IS DISTINCT FROM city""",
    "ends": f"""
        SELECT customer_id, run, run_ts FROM starts UNION ALL
        SELECT customer_id, run + 1, CASE run WHEN 1 THEN {_T1} ELSE {_NOW} END FROM steps
        WHERE run < 3 AND next_run IS DISTINCT FROM run + 1""",
    "customer_scd2": """
        SELECT s.customer_id, full_name, phone_hash, email_hash, birth_date, city, segment, registration_date, status,
            source_system, bronze_loaded_at, updated_at,
            md5(concat(cast(s.customer_id AS VARCHAR), '|', strftime(s.run_ts, '%Y-%m-%d %H:%M:%S'))) AS scd_id,
            s.run_ts AS scd_updated_at, s.run_ts AS valid_from,
            (SELECT min(e.run_ts) FROM ends e WHERE e.customer_id = s.customer_id AND e.run > s.run) AS valid_to
        FROM starts s""",
    # -- gold
    "account_metrics": """
        SELECT a.customer_id, count(*) AS account_count, cast(sum(a.balance) AS DECIMAL(38,2)) AS total_balance,
            count(DISTINCT k.card_id) AS card_count
        FROM dim_account a LEFT JOIN dim_card k ON k.account_id = a.account_id GROUP BY a.customer_id""",
    "trx_metrics": """
        SELECT customer_id, count(*) AS trx_count, cast(sum(amount) AS DECIMAL(38,2)) AS trx_amount_total,
            max(amount) AS trx_amount_max, max(trx_datetime) AS last_trx_datetime
        FROM fact_transaction GROUP BY customer_id""",
    "session_metrics": """
        SELECT customer_id, count(*) AS session_count, max(login_time) AS last_login_time,
            count(*) FILTER (WHERE is_new_device) AS new_device_session_count
        FROM fact_app_session GROUP BY customer_id""",
    "event_metrics": """
        SELECT customer_id, count(*) FILTER (WHERE NOT is_successful) AS failed_event_count
        FROM fact_app_event GROUP BY customer_id""",
    "ids": """
        SELECT customer_id FROM account_metrics UNION SELECT customer_id FROM trx_metrics
        UNION SELECT customer_id FROM session_metrics UNION SELECT customer_id FROM event_metrics""",
    # zero padding lifts a negative total, unless the customer occurs in accounts only
    "customer_metrics": """
        SELECT i.customer_id, coalesce(account_count, 0) AS account_count, coalesce(card_count, 0) AS card_count,
            cast(CASE WHEN t.customer_id IS NULL AND s.customer_id IS NULL AND e.customer_id IS NULL
                 THEN total_balance ELSE greatest(coalesce(total_balance, 0), 0) END
                 AS DECIMAL(38,2)) AS total_balance,
            coalesce(trx_count, 0) AS trx_count,
            cast(CASE WHEN a.customer_id IS NULL AND s.customer_id IS NULL AND e.customer_id IS NULL
                 THEN trx_amount_total ELSE greatest(coalesce(trx_amount_total, 0), 0) END
                 AS DECIMAL(38,2)) AS trx_amount_total,
            cast(CASE WHEN a.customer_id IS NULL AND s.customer_id IS NULL AND e.customer_id IS NULL
                 THEN trx_amount_max ELSE greatest(coalesce(trx_amount_max, 0), 0) END
                 AS DECIMAL(18,2)) AS trx_amount_max,
            last_trx_datetime, coalesce(session_count, 0) AS session_count, last_login_time,
            coalesce(new_device_session_count, 0) AS new_device_session_count,
            coalesce(failed_event_count, 0) AS failed_event_count
        FROM ids i
        LEFT JOIN account_metrics a ON a.customer_id = i.customer_id
        LEFT JOIN trx_metrics t ON t.customer_id = i.customer_id
        LEFT JOIN session_metrics s ON s.customer_id = i.customer_id
        LEFT JOIN event_metrics e ON e.customer_id = i.customer_id""",
    "customer_360": f"""
        SELECT c.customer_id, full_name, segment, city, status, coalesce(account_count, 0) AS account_count,
            coalesce(card_count, 0) AS card_count, cast(coalesce(total_balance, 0) AS DECIMAL(38,2)) AS total_balance,
            coalesce(trx_count, 0) AS trx_count,
            cast(coalesce(trx_amount_total, 0) AS DECIMAL(38,2)) AS trx_amount_total,
            cast(coalesce(trx_amount_max, 0) AS DECIMAL(18,2)) AS trx_amount_max, last_trx_datetime,
            coalesce(session_count, 0) AS session_count, last_login_time,
            coalesce(new_device_session_count, 0) AS new_device_session_count,
            coalesce(failed_event_count, 0) AS failed_event_count, {_NOW} AS refreshed_at
        FROM dim_customer c LEFT JOIN customer_metrics m ON m.customer_id = c.customer_id""",
    "daily_transaction_summary": f"""
        SELECT customer_id, trx_date, count(*) AS trx_count, cast(sum(amount) AS DECIMAL(38,2)) AS trx_amount_total,
            max(amount) AS trx_amount_max, count(DISTINCT channel) AS unique_channels,
            count(DISTINCT merchant_category_code) AS unique_mcc, {_NOW} AS refreshed_at
        FROM fact_transaction GROUP BY customer_id, trx_date""",
    "mcc_risk_enriched_transactions": f"""
        SELECT trx_id, customer_id, trx_date, trx_datetime, amount, currency, channel, merchant_category_code,
            coalesce(mcc_category, 'Unknown') AS mcc_category,
            cast(coalesce(risk_weight, 30) AS INTEGER) AS mcc_risk_weight,
            cast(amount AS DOUBLE) * (cast(coalesce(risk_weight, 30) AS DOUBLE) / 100.0) AS risk_weighted_amount,
            {_NOW} AS refreshed_at
        FROM fact_transaction LEFT JOIN risk_mcc_codes ON cast(mcc_code AS VARCHAR) = merchant_category_code""",
    "pipeline_operations_dashboard": f"""
        SELECT 'bronze' AS layer, mapping_name, last_status, last_rows_loaded, last_run_at, failed_runs_7d,
            CASE WHEN last_status = 'success' THEN 'healthy' ELSE 'degraded' END AS pipeline_health,
            {_NOW} AS refreshed_at
        FROM (SELECT mapping_name, arg_max(status, started_at) AS last_status,
                  arg_max(rows_loaded, started_at) AS last_rows_loaded, max(started_at) AS last_run_at,
                  count(*) FILTER (WHERE status = 'failed') AS failed_runs_7d
              FROM load_audit WHERE started_at >= {_NOW} - INTERVAL 7 DAY GROUP BY mapping_name) r""",
    "latest_status": """
        SELECT mapping_name, arg_max(status, started_at) AS last_status FROM load_audit GROUP BY mapping_name""",
    "keys": """
        SELECT * FROM (VALUES ('dim_customer', 'customer_id'), ('dim_account', 'account_id'), ('dim_card', 'card_id'),
            ('fact_transaction', 'trx_id'), ('fact_app_session', 'session_id'), ('fact_app_event', 'event_id')) AS x(t, k)""",
    # -- loads
    "mark": """
        SELECT cast(watermark_value AS BIGINT) AS high FROM load_state WHERE mapping_name = '1-URGENT'
        ORDER BY updated_at DESC, cast(watermark_value AS BIGINT) DESC LIMIT 1""",
}

_RAW_TARGETS = (
    "crm_customers_raw", "core_accounts_raw", "card_cards_raw",
    "payments_transactions_raw", "mobile_app_sessions_raw", "mobile_app_events_raw",
)
_SILVER_TABLES = ("dim_customer", "dim_account", "dim_card", "fact_transaction", "fact_app_session", "fact_app_event")
_GOLD_TABLES = ("customer_360", "daily_transaction_summary", "mcc_risk_enriched_transactions")
_SOURCE_COLUMNS = "* EXCLUDE (source_system, load_dttm)"


def _counts() -> str:
    stored = [("bronze", t) for t in _RAW_TARGETS] + [("silver", t) for t in _SILVER_TABLES]
    stored += [("gold", t) for t in _GOLD_TABLES]
    counts = [f"SELECT '{layer}.{t}' AS table_name, count(*) AS n_rows FROM {t}" for layer, t in stored]
    # the first snapshot opens one version per customer
    counts.append("SELECT 'silver.customer_scd2' AS table_name, count(*) AS n_rows FROM dim_customer")
    return " UNION ALL ".join(counts)


def _rows_of(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {part}" for name, part in tables.items())


_LINE_BREAKS = """
    SELECT customer_id, concat(full_name, chr(10), '"the, second"', chr(10), 'line') AS full_name, segment, city, status
    FROM crm_customers_raw"""

STATEMENTS: dict[str, str] = {
    **{name: f"SELECT * FROM {name}" for name in (*_SILVER_TABLES, "customer_scd2", *_GOLD_TABLES)},
    "pipeline_operations_dashboard": "SELECT * FROM pipeline_operations_dashboard",
    "account_metrics": "SELECT * FROM account_metrics",
    "customer_metrics": "SELECT * FROM customer_metrics",
    "customer_360_per_account": """
        SELECT c.* EXCLUDE (account_count, total_balance), coalesce(n, 0) AS account_count,
            cast(CASE WHEN trx_count = 0 AND session_count = 0 AND e.customer_id IS NULL
                 THEN coalesce(b, 0) ELSE greatest(coalesce(b, 0), 0) END AS DECIMAL(38,2)) AS total_balance
        FROM customer_360 c
        LEFT JOIN event_metrics e ON e.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_id, count(*) AS n, sum(balance) AS b FROM dim_account GROUP BY customer_id) a
            ON a.customer_id = c.customer_id""",
    "replacing_collapse": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY load_dttm DESC) AS place
            FROM crm_customers_raw) x WHERE place = 1""",
    "latest_watermark": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY mapping_name ORDER BY updated_at DESC, watermark_value DESC)
                AS place FROM load_state) x WHERE place = 1""",
    "newest_state_row": """
        SELECT * FROM load_state WHERE mapping_name = '1-URGENT'
        ORDER BY updated_at DESC, cast(watermark_value AS BIGINT) DESC LIMIT 1""",
    "incremental_slice": "SELECT * FROM payments_transactions_raw WHERE trx_id > (SELECT high FROM mark)",
    "anti_join_slice": """
        SELECT account_id, customer_id, product_type, currency, balance, opened_date, closed_date, status
        FROM core_accounts_raw a WHERE NOT EXISTS (SELECT 1 FROM card_cards_raw k WHERE k.account_id = a.account_id)""",
    "load_observation": """
        SELECT 1 AS attempt, 'transactions' AS mapping_name, 'bronze.payments_transactions_raw' AS target_table,
            'incremental' AS load_mode, 'success' AS status, count(*) AS rows_loaded,
            cast(NULL AS VARCHAR) AS last_watermark, cast(max(trx_id) AS VARCHAR) AS new_watermark
        FROM payments_transactions_raw
        UNION ALL
        SELECT 2, 'transactions', 'bronze.payments_transactions_raw', 'incremental', 'success', 0,
            cast(max(trx_id) AS VARCHAR), cast(max(trx_id) AS VARCHAR) FROM payments_transactions_raw
        UNION ALL
        SELECT 3, 'transactions', 'bronze.payments_transactions_raw', 'full_refresh', 'success', count(*),
            NULL, cast(max(trx_id) AS VARCHAR) FROM payments_transactions_raw""",
    "bronze_load": f"""
        SELECT {_SOURCE_COLUMNS} REPLACE (date_trunc('second', event_time) AS event_time),
            source_system FROM mobile_app_events_raw""",
    "incremental_load": "SELECT * EXCLUDE (load_dttm) FROM payments_transactions_raw",
    "csv_extract_load": f"""
        SELECT {_SOURCE_COLUMNS} REPLACE (date_trunc('second', event_time) AS event_time),
            source_system FROM mobile_app_events_raw""",
    "stored_fact_transaction": "SELECT * FROM fact_transaction",
    "stored_customer_history": "SELECT * FROM customer_scd2",
    "warehouse_build": _counts(),
    "dq_unique": """
        SELECT card_id, count(*) AS n_records FROM card_cards_raw
        WHERE card_id IS NOT NULL GROUP BY card_id HAVING count(*) > 1""",
    "dq_not_null": "SELECT trx_id, account_id, amount FROM payments_transactions_raw WHERE trx_datetime IS NULL",
    "dq_negative_amounts": """
        SELECT trx_id, amount FROM (
            SELECT trx_id, cast(amount - 50000 AS DECIMAL(18,2)) AS amount FROM fact_transaction) r
        WHERE amount < 0""",
    "dq_table_not_empty": "SELECT count(*) > 0 AS ok FROM dim_customer",
    "dq_pii_hash_shape": """
        SELECT count(*) = 0 AS ok FROM dim_customer
        WHERE (phone_hash IS NOT NULL AND length(phone_hash) <> 64)
           OR (email_hash IS NOT NULL AND length(email_hash) <> 64)""",
    "dq_audit_healthy": "SELECT count(*) = 0 AS ok FROM latest_status WHERE last_status = 'failed'",
    "failing_mappings": "SELECT * FROM latest_status WHERE last_status = 'failed'",
    "verification_report": """
        SELECT 'bronze.crm_customers_raw not empty' AS "check", (SELECT count(*) > 0 FROM crm_customers_raw) AS ok
        UNION ALL SELECT 'silver.dim_customer not empty', (SELECT count(*) > 0 FROM dim_customer)
        UNION ALL SELECT 'gold.customer_360 not empty', false
        UNION ALL SELECT 'PII hashing', (SELECT count(*) = 0 FROM dim_customer
            WHERE length(phone_hash) <> 64 OR length(email_hash) <> 64)
        UNION ALL SELECT 'bronze audit healthy', false""",
    "failed_load_audit": """
        SELECT 'cards' AS mapping_name, 'success' AS status, count(*) AS rows_loaded,
            cast(max(card_id) AS VARCHAR) AS new_watermark, cast(NULL AS VARCHAR) AS error_message FROM card_cards_raw
        UNION ALL SELECT 'transactions', 'failed', 0, NULL, left('source is down: ' || repeat('no answer, ', 200), 1000)""",
    "source_freshness": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name,
            CASE WHEN count(*) > 0 THEN {_NOW} - INTERVAL {hours} HOUR END AS max_loaded_at,
            CASE WHEN count(*) > 0 THEN '{status}' ELSE 'error' END AS freshness_status FROM {t}"""
        for t, (hours, status) in zip(_RAW_TARGETS, 2 * ((12, "pass"), (48, "warn"), (100, "error")))
    ),
    "mapping_named_twice": "SELECT count(*) AS n_rows, cast(1 AS BIGINT) AS n_loads FROM card_cards_raw",
    "selected_build": _rows_of({"silver.dim_customer": "dim_customer", "silver.dim_card": "dim_card", "silver.customer_scd2": "dim_customer", "reference.risk_mcc_codes": "risk_mcc_codes"}),
    "gate_before_gold": _rows_of({**{f"silver.{t}": t for t in _SILVER_TABLES}, "silver.customer_scd2": "dim_customer", "reference.risk_mcc_codes": "risk_mcc_codes"}),
    # loads keep whole seconds
    "stored_customer_360": "SELECT * REPLACE (date_trunc('second', last_login_time) AS last_login_time) FROM customer_360",
    "sliced_daily_summary": "SELECT * FROM daily_transaction_summary",
    "mcc_risk_large_reference": "SELECT * FROM mcc_risk_enriched_transactions",
    "mcc_risk_hot_code": f"""
        SELECT trx_id, customer_id, trx_date, trx_datetime, amount, currency, channel, code AS merchant_category_code,
            coalesce(mcc_category, 'Unknown') AS mcc_category, cast(coalesce(risk_weight, 30) AS INTEGER) AS mcc_risk_weight,
            cast(amount AS DOUBLE) * (cast(coalesce(risk_weight, 30) AS DOUBLE) / 100.0) AS risk_weighted_amount,
            {_NOW} AS refreshed_at
        FROM (SELECT *, CASE WHEN trx_id % 3 = 0 THEN '5411' WHEN trx_id % 10 = 1 THEN NULL ELSE merchant_category_code END AS code
              FROM fact_transaction) f LEFT JOIN risk_mcc_codes ON cast(mcc_code AS VARCHAR) = code""",
    "sliced_customer_360": "SELECT * FROM customer_360",
    "sliced_customer_history": "SELECT * FROM customer_scd2",
    "sliced_tests": """
        SELECT 'silver.' || t || ' ' || k || ' unique' AS "check", t <> 'dim_card' AS ok FROM keys
        UNION ALL SELECT 'silver.' || t || ' ' || k || ' not null', true FROM keys
        UNION ALL SELECT 'silver.fact_transaction without negative amounts', (SELECT count(*) = 0 FROM fact_transaction WHERE amount < 50000)""",
    "stored_day_order": "SELECT cast(0 AS BIGINT) AS n_out_of_order, count(*) > 0 AS a_day_is_in_two_files_at_most FROM fact_transaction",
    "csv_line_breaks": _LINE_BREAKS,
    "csv_line_breaks_in_one_file": _LINE_BREAKS,
    "tied_marks": """
        SELECT mapping_name, watermark_value, watermark_type, date_trunc('year', updated_at) AS updated_at
        FROM load_state WHERE mapping_name = '1-URGENT'
        ORDER BY date_trunc('year', updated_at) DESC, cast(watermark_value AS BIGINT) DESC LIMIT 1""",
}


def statement(name: str) -> str:
    """A self-contained SELECT: the statement behind the parts it needs, in order of definition."""
    needed: set[str] = set()
    todo = [STATEMENTS[name]]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        fresh = (words & PARTS.keys()) - needed
        needed |= fresh
        todo += [PARTS[part] for part in fresh]
    parts = ",\n".join(f"{part} AS ({PARTS[part]})" for part in PARTS if part in needed)
    return f"WITH {parts}\n{STATEMENTS[name]}"
