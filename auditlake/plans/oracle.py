"""The same results in standard SQL for an independent engine.

``TABLES`` holds named subqueries that mirror the bindings and layers, written apart from the
DataFrame code. ``QUERIES`` holds one final SELECT per registered query; ``oracle_sql`` puts the
subqueries it needs in front of it.
"""

from __future__ import annotations

import re

# Output forms: times with microseconds, dates, and money as the text or double Spark returns.
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def t(column: str, alias: str | None = None) -> str:
    return f"{TS.format(column)} AS {alias or column}"


def d(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {alias or column}"


def n(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {alias or column}"


def i(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS BIGINT) AS {alias or column}"


def a(column: str, alias: str | None = None) -> str:
    return f"array_to_string({column}, ',') AS {alias or column}"


KNOWN_TYPES = "('CASH_OUT', 'PAYMENT', 'CASH_IN', 'TRANSFER', 'DEBIT')"
STRICT = (
    "CASE WHEN regexp_full_match(event_ts, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z') "
    "THEN try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') END"
)


def feed(status: str) -> str:
    return f"""
SELECT 'E' || event_id AS event_id,
    CASE m WHEN 4 THEN '10:30' WHEN 24 THEN strftime(ts, '%Y-%m-%d') WHEN 44 THEN '2024-02-30T10:00:00Z'
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_ts,
    CASE WHEN m = 3 THEN 'REFUND' WHEN event_type = 'click' THEN 'TRANSFER' WHEN event_type = 'error' THEN 'CASH_OUT'
        WHEN event_type = 'purchase' THEN 'PAYMENT' WHEN event_type = 'signup' THEN 'CASH_IN'
        WHEN event_type = 'view' THEN 'DEBIT' END AS type,
    CASE WHEN m = 1 THEN NULL WHEN m = 2 THEN -val ELSE val END AS amount,
    CASE WHEN m <> 21 THEN 'CG' || user_id END AS customer_id,
    CASE WHEN event_type IN ('purchase', 'view') THEN 'MG' ELSE 'CG' END || k AS counterparty_id,
    CAST(CASE WHEN event_id % 50 = 0 THEN val ELSE val * 2 END AS DECIMAL(18, 2)) AS origin_balance_before,
    CAST(CASE WHEN event_id % 50 = 0 THEN val ELSE val * 2 END - val AS DECIMAL(18, 2)) AS origin_balance_after,
    {status} AS status,
    CASE WHEN k < 10 THEN 'LIMIT' END AS decline_reason,
    CASE WHEN event_id % 71 <> 0 THEN CAST(k % 10 = 0 AS INT) END AS is_fraud,
    'generator-v1' AS source_system,
    CASE WHEN day >= DATE '2024-01-16' THEN CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'web' END END AS channel,
    day AS feed_date,
    CAST(day AS TIMESTAMP) + INTERVAL 24 HOUR AS _source_modified_at,
    CAST(day AS TIMESTAMP) + INTERVAL 30 HOUR + to_hours(copy) AS _ingested_at
FROM e CROSS JOIN (VALUES (0), (1)) AS c(copy)
WHERE copy = 0 OR m IN (10, 11)"""


def mapped_feed(source: str) -> str:
    return f"""
SELECT event_id, parsed_ts AS event_ts, CAST(parsed_ts AS DATE) AS event_date, type AS txn_type, amount, customer_id,
    counterparty_id,
    CASE WHEN counterparty_id LIKE 'M%' THEN 'merchant' WHEN counterparty_id LIKE 'C%' THEN 'customer' END AS counterparty_kind,
    origin_balance_before, origin_balance_after,
    CAST(NULL AS DECIMAL(18, 2)) AS dest_balance_before, CAST(NULL AS DECIMAL(18, 2)) AS dest_balance_after,
    status, 'source_system' AS status_source, decline_reason, is_fraud = 1 AS is_fraud, amount = 0 AS is_zero_amount,
    channel, source_system, event_ts AS event_ts_raw,
    [x FOR x IN [
        CASE WHEN event_id IS NULL OR customer_id IS NULL OR amount IS NULL OR type IS NULL OR event_ts IS NULL
            OR status IS NULL THEN 'NULL_REQUIRED_FIELD' END,
        CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END,
        CASE WHEN type NOT IN {KNOWN_TYPES} THEN 'UNKNOWN_TYPE' END,
        CASE WHEN event_ts IS NOT NULL AND parsed_ts IS NULL THEN 'BAD_TIMESTAMP' END,
        CASE WHEN status NOT IN ('APPROVED', 'DECLINED') THEN 'UNKNOWN_STATUS' END
    ] IF x IS NOT NULL] AS failed_checks,
    _ingested_at, feed_date
FROM (SELECT *, {STRICT} AS parsed_ts FROM {source})"""


def versions(events: str, key: str, at: str, ties: str, tracked: tuple[str, ...], others: tuple[str, ...] = ()) -> str:
    lags = ", ".join(f"lag({c}) OVER w AS before_{c}" for c in tracked)
    moved = " OR ".join(f"{c} IS DISTINCT FROM before_{c}" for c in tracked)
    shown = ", ".join(
        [f"arg_min({c}, {at}) AS {c}" for c in tracked] + [f"arg_max({c}, {at}) AS {c}" for c in others]
    )
    return f"""
SELECT *, lead(start_at) OVER (PARTITION BY {key} ORDER BY start_at) AS end_at FROM (
    SELECT {key}, version_no, min({at}) AS start_at, {shown} FROM (
        SELECT *, sum(CASE WHEN rn = 1 OR {moved} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY {at}) AS version_no
        FROM (
            SELECT *, {lags}, row_number() OVER w AS rn FROM (
                SELECT * FROM {events}
                QUALIFY row_number() OVER (PARTITION BY {key}, {at} ORDER BY {ties}) = 1
            ) WINDOW w AS (PARTITION BY {key} ORDER BY {at})
        )
    ) GROUP BY {key}, version_no
)"""


OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
STATUS = "CASE WHEN k < 10 THEN 'DECLINED' ELSE 'APPROVED' END"

TABLES: dict[str, str] = {
    "e": """
SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(event_id % 100 AS INT) AS m,
    CAST(value AS DECIMAL(18, 2)) AS val, CAST(ts AS DATE) AS day FROM events""",
    "raw_feed": feed(STATUS),
    "raw_feed_s": feed(f"CASE WHEN m = 5 THEN 'PENDING' ELSE {STATUS} END"),
    "li": """
SELECT *, l_linenumber % 5 AS kind, CAST(l_quantity AS INT) AS qty,
    CASE l_linenumber % 5 WHEN 0 THEN 'CASH_IN' WHEN 1 THEN 'CASH_OUT' WHEN 2 THEN 'TRANSFER' WHEN 3 THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
    CAST(CASE WHEN l_partkey % 500 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END AS DECIMAL(18, 2)) AS amount
FROM lineitem""",
    "raw_history": """
SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 24 + l_suppkey % 24 + 1 AS INT) AS step,
    type, amount, 'C' || l_orderkey AS nameOrig,
    CAST(CASE WHEN qty = 1 THEN amount ELSE amount + qty END AS DECIMAL(18, 2)) AS oldbalanceOrg,
    CAST(CASE WHEN qty = 1 THEN 0 ELSE qty END AS DECIMAL(18, 2)) AS newbalanceOrig,
    CASE WHEN kind = 3 THEN 'M' || l_suppkey ELSE 'C' || l_partkey END AS nameDest,
    CAST(CASE WHEN kind = 3 THEN 0 ELSE qty * 100 END AS DECIMAL(18, 2)) AS oldbalanceDest,
    CAST(CASE WHEN kind = 3 THEN 0 ELSE qty * 100 + amount END AS DECIMAL(18, 2)) AS newbalanceDest,
    CAST(kind IN (1, 2) AND l_returnflag = 'R' AS INT) AS isFraud,
    CAST(kind = 2 AND l_returnflag = 'R' AND qty = 50 AS INT) AS isFlaggedFraud
FROM li""",
    "parties": """
SELECT DISTINCT p, num FROM (
    SELECT 'CG' AS p, user_id AS num FROM e UNION ALL SELECT 'CG', k FROM e UNION ALL SELECT 'MG', k FROM e)""",
    "raw_profile": """
SELECT p || num AS customer_id, CASE p WHEN 'MG' THEN 'merchant' ELSE 'customer' END AS entity_type,
    CASE p WHEN 'MG' THEN 'retail' ELSE 'S' || (num % 4) END AS segment, 'R' || (num % 10) AS region,
    TIMESTAMP '2023-12-31 00:00:00' AS changed_at, DATE '2024-01-01' AS day, FALSE AS late
FROM parties
UNION ALL
SELECT 'CG' || user_id, 'customer', 'S' || (k % 4), 'R' || (k % 10), date_trunc('second', ts), day, event_id % 10 = 3
FROM e WHERE event_type = 'signup'""",
    "manifests": """
SELECT day AS feed_date, count(*) AS clean_rows, count(*) + count(*) FILTER (m IN (10, 11)) AS rows_written,
    count(*) FILTER (event_type = 'signup' AND event_id % 10 <> 3)
        + CASE WHEN day = DATE '2024-01-01' THEN (SELECT count(*) FROM parties) ELSE 0 END AS profile_rows,
    count(*) FILTER (m IN (1, 21)) AS null_field, count(*) FILTER (m = 2) AS bad_amount,
    count(*) FILTER (m = 3) AS unknown_type, count(*) FILTER (m IN (4, 24, 44)) AS bad_timestamp,
    count(*) FILTER (m IN (10, 11)) AS duplicates
FROM e GROUP BY day""",
    "measured": f"""
SELECT feed_date, count(*) AS bronze_rows, count(DISTINCT event_id) AS distinct_events,
    count(*) FILTER (event_id IS NULL OR customer_id IS NULL OR amount IS NULL OR type IS NULL OR event_ts IS NULL OR status IS NULL) AS null_field,
    count(*) FILTER (amount < 0) AS bad_amount, count(*) FILTER (type NOT IN {KNOWN_TYPES}) AS unknown_type,
    count(*) FILTER (event_ts IS NOT NULL AND {STRICT} IS NULL) AS bad_timestamp
FROM raw_feed GROUP BY feed_date""",
    "holidays": """
SELECT list_extract(['england-and-wales', 'scotland', 'northern-ireland'], CAST(n_regionkey % 3 + 1 AS INT)) AS division,
    n_name || suffix AS title, CAST(start AS DATE) + CAST(n_nationkey AS INT) AS holiday_date
FROM nation CROSS JOIN (VALUES ('2024-01-01', ''), ('1996-06-01', ' SUMMER')) AS s(start, suffix)
WHERE n_nationkey % 5 <> 4""",
    "feed_mapped": mapped_feed("raw_feed"),
    "feed_tagged": mapped_feed("raw_feed_s"),
    "history_mapped": f"""
SELECT 'P' || left(sha256(concat_ws('|', step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
        oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud)), 24) AS event_id,
    ts AS event_ts, CAST(ts AS DATE) AS event_date, type AS txn_type, amount, nameOrig AS customer_id,
    nameDest AS counterparty_id,
    CASE WHEN nameDest LIKE 'M%' THEN 'merchant' WHEN nameDest LIKE 'C%' THEN 'customer' END AS counterparty_kind,
    oldbalanceOrg AS origin_balance_before, newbalanceOrig AS origin_balance_after,
    CASE WHEN nameDest NOT LIKE 'M%' THEN oldbalanceDest END AS dest_balance_before,
    CASE WHEN nameDest NOT LIKE 'M%' THEN newbalanceDest END AS dest_balance_after,
    CASE WHEN isFlaggedFraud = 1 THEN 'DECLINED' ELSE 'APPROVED' END AS status,
    'derived_paysim_rule' AS status_source,
    CASE WHEN isFlaggedFraud = 1 THEN 'PAYSIM_FLAGGED' END AS decline_reason,
    isFraud = 1 AS is_fraud, amount = 0 AS is_zero_amount, CAST(NULL AS VARCHAR) AS channel, 'paysim' AS source_system,
    CAST(NULL AS VARCHAR) AS event_ts_raw,
    [x FOR x IN [CASE WHEN nameOrig IS NULL OR amount IS NULL OR type IS NULL OR step IS NULL THEN 'NULL_REQUIRED_FIELD' END,
        CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END,
        CASE WHEN type NOT IN {KNOWN_TYPES} THEN 'UNKNOWN_TYPE' END] IF x IS NOT NULL] AS failed_checks,
    TIMESTAMP '2024-02-01 01:00:00' AS _ingested_at, CAST(NULL AS DATE) AS feed_date
FROM (SELECT *, TIMESTAMP '1995-01-01 00:00:00' + to_hours(step - 1) AS ts FROM raw_history)""",
    "unified": """
SELECT u.*, u.event_date IS NOT NULL AND u.event_date IN (
    SELECT holiday_date FROM holidays WHERE division = 'england-and-wales') AS is_bank_holiday
FROM (SELECT * FROM feed_mapped UNION ALL BY NAME SELECT * FROM history_mapped) AS u""",
    "transactions": """
SELECT * FROM unified WHERE len(failed_checks) = 0
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at DESC) = 1""",
    "rejected": "SELECT * FROM unified WHERE len(failed_checks) > 0",
    "customer_versions": versions(
        "raw_profile", "customer_id", "changed_at", "entity_type DESC, region DESC, segment DESC",
        ("segment", "region"), ("entity_type",),
    ),
    "dim_cust": f"""
SELECT customer_id || '@' || CAST(start_at AS VARCHAR) AS customer_key, customer_id, entity_type, segment, region,
    start_at AS valid_from, coalesce(end_at, {OPEN}) AS valid_to, end_at IS NULL AS is_current FROM customer_versions
UNION ALL
SELECT '-1', 'UNKNOWN', 'unknown', 'Unknown', 'Unknown', TIMESTAMP '1970-01-01 00:00:00', {OPEN}, TRUE""",
    "types": """
SELECT * FROM (VALUES (1, 'CASH_IN', 'cash', FALSE), (2, 'CASH_OUT', 'cash', TRUE), (3, 'PAYMENT', 'payment', FALSE),
    (4, 'TRANSFER', 'transfer', TRUE), (5, 'DEBIT', 'payment', FALSE)) AS v(type_key, type_name, category, can_be_fraud)""",
    "cal": """
SELECT CAST(strftime(c, '%Y%m%d') AS INT) AS date_key, c AS calendar_date, year(c) AS calendar_year,
    c IN (SELECT holiday_date FROM holidays WHERE division = 'england-and-wales') AS is_bank_holiday_eaw
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS c)""",
    "base": """
SELECT *, hour(event_ts) AS hour_of_day,
    CASE WHEN amount < 10 THEN 1 WHEN amount < 100 THEN 2 WHEN amount < 1000 THEN 3 WHEN amount < 10000 THEN 4
        WHEN amount < 100000 THEN 5 ELSE 6 END AS amount_band_sort,
    sum(CASE WHEN txn_type = 'TRANSFER' THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY event_ts
        RANGE BETWEEN INTERVAL 360 MINUTE PRECEDING AND INTERVAL 360 MINUTE FOLLOWING) AS near_bound,
    sum(CASE WHEN txn_type = 'TRANSFER' THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY event_ts
        RANGE BETWEEN INTERVAL 15 MINUTE PRECEDING AND INTERVAL 15 MINUTE FOLLOWING) AS near_default
FROM transactions""",
    "fact": """
SELECT b.*, CAST(strftime(b.event_ts, '%Y%m%d') AS INT) AS date_key, ty.type_key,
    CASE WHEN hour_of_day < 6 THEN 'night' WHEN hour_of_day < 12 THEN 'morning' WHEN hour_of_day < 18 THEN 'afternoon'
        ELSE 'evening' END AS day_part,
    list_extract(['0 to 9.99', '10 to 99.99', '100 to 999.99', '1,000 to 9,999.99', '10,000 to 99,999.99',
        '100,000 and over'], amount_band_sort) AS amount_band,
    status = 'DECLINED' AS is_declined,
    txn_type IN ('TRANSFER', 'CASH_OUT') AND amount > 0 AND amount = origin_balance_before AS flag_balance_drain,
    txn_type = 'TRANSFER' AND hour_of_day BETWEEN 1 AND 4 AND amount >= 50 AS flag_night_high_value,
    txn_type = 'TRANSFER' AND near_bound >= 3 AS flag_burst,
    txn_type = 'TRANSFER' AND near_default >= 5 AS flag_burst_default,
    status_source = 'derived_paysim_rule' AND status = 'DECLINED' AS flag_source_rule
FROM base AS b LEFT JOIN types AS ty ON b.txn_type = ty.type_name""",
    "keyed": """
SELECT f.*, oc.valid_from AS origin_from, cp.valid_from AS counterparty_from,
    coalesce(oc.customer_key, '-1') AS origin_customer_key, coalesce(cp.customer_key, '-1') AS counterparty_key
FROM fact AS f
LEFT JOIN dim_cust AS oc ON f.customer_id = oc.customer_id AND f.event_ts >= oc.valid_from AND f.event_ts < oc.valid_to
LEFT JOIN dim_cust AS cp ON f.counterparty_id = cp.customer_id AND f.event_ts >= cp.valid_from AND f.event_ts < cp.valid_to""",
    "kpi": """
SELECT f.date_key, c.calendar_date, c.is_bank_holiday_eaw, f.source_system, count(*) AS txn_count, sum(amount) AS txn_value,
    count(*) FILTER (NOT is_declined) AS approved_count, sum(CASE WHEN is_declined THEN 0 ELSE amount END) AS approved_value,
    count(*) FILTER (is_declined) AS declined_count, count(*) FILTER (NOT is_declined) / count(*) AS approval_rate,
    count(*) FILTER (is_fraud) AS fraud_count, sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS fraud_value,
    count(*) FILTER (is_fraud) / count(*) AS fraud_rate,
    count(*) FILTER (is_fraud AND NOT is_declined) AS fraud_missed_count,
    sum(CASE WHEN is_fraud AND NOT is_declined THEN amount ELSE 0 END) AS fraud_missed_value,
    count(*) FILTER (is_fraud AND is_declined) / nullif(count(*) FILTER (is_fraud), 0) AS fraud_catch_rate
FROM fact AS f JOIN cal AS c ON f.date_key = c.date_key GROUP BY ALL""",
    "rules": """
SELECT source_system, rule_name, count(*) FILTER (flagged) AS flagged_count, count(*) FILTER (flagged AND is_fraud) AS fraud_caught,
    count(*) FILTER (is_fraud) AS fraud_total,
    count(*) FILTER (flagged AND is_fraud) / nullif(count(*) FILTER (flagged), 0) AS precision_rate,
    count(*) FILTER (flagged AND is_fraud) / nullif(count(*) FILTER (is_fraud), 0) AS recall_rate
FROM (
    SELECT source_system, is_fraud, 'source_rule' AS rule_name, flag_source_rule AS flagged FROM fact
    UNION ALL SELECT source_system, is_fraud, 'balance_drain', flag_balance_drain FROM fact
    UNION ALL SELECT source_system, is_fraud, 'night_high_value', flag_night_high_value FROM fact
    UNION ALL SELECT source_system, is_fraud, 'burst', flag_burst FROM fact
    UNION ALL SELECT source_system, is_fraud, 'any_of_our_rules', flag_balance_drain OR flag_night_high_value OR flag_burst FROM fact
) GROUP BY ALL""",
}


def unusual(role: str, burst: str, night: str, frequent: int, transfers: int, senders: int) -> str:
    if role == "sender":
        return f"""
SELECT * FROM (
    SELECT date_key, customer_id AS entity_id, 'sender' AS entity_role, count(*) AS txn_count, sum(amount) AS total_amount,
        count(*) FILTER (is_fraud) AS fraud_count,
        [x FOR x IN [CASE WHEN count(*) >= {frequent} THEN 'HIGH_FREQUENCY' END, CASE WHEN bool_or({burst}) THEN 'BURST' END,
            CASE WHEN bool_or(flag_balance_drain) THEN 'BALANCE_DRAIN' END] IF x IS NOT NULL] AS flag_reasons
    FROM fact GROUP BY date_key, customer_id) WHERE len(flag_reasons) > 0"""
    return f"""
SELECT date_key, counterparty_id AS entity_id, 'recipient' AS entity_role, count(*) AS txn_count, sum(amount) AS total_amount,
    count(*) FILTER (is_fraud) AS fraud_count, ['HUB_RECIPIENT'] AS flag_reasons
FROM fact WHERE txn_type = 'TRANSFER' GROUP BY date_key, counterparty_id
HAVING count(*) >= {transfers} AND count(DISTINCT customer_id) >= {senders}"""


TABLES["senders"] = unusual("sender", "flag_burst", "", 8, 2, 2)
TABLES["recipients"] = unusual("recipient", "flag_burst", "", 8, 2, 2)
TABLES["senders_default"] = unusual("sender", "flag_burst_default", "", 8, 5, 5)
TABLES["recipients_default"] = unusual("recipient", "flag_burst_default", "", 8, 5, 5)
TABLES["orders_profile"] = """
SELECT o_custkey AS customer_id, 'customer' AS entity_type, o_orderpriority AS segment, o_orderstatus AS region,
    o_orderdate AS changed_at, o_orderkey FROM orders"""
TABLES["order_versions"] = versions(
    "orders_profile", "customer_id", "changed_at", "o_orderkey DESC", ("segment", "region"), ("entity_type",)
)
TABLES["order_segments"] = versions(
    "orders_profile", "customer_id", "changed_at", "o_orderkey DESC", ("segment",), ("entity_type", "region")
)
TABLES["signups"] = """
SELECT user_id AS customer_id, 'customer' AS entity_type, 'S' || (k % 4) AS segment, 'R' || (k % 10) AS region,
    ts AS changed_at, event_id FROM e WHERE event_type = 'signup'"""
TABLES["signups_on_time"] = "SELECT * FROM signups WHERE event_id % 10 <> 3"
TABLES["signup_versions"] = versions(
    "signups", "customer_id", "changed_at", "event_id DESC", ("segment", "region"), ("entity_type",)
)
TABLES["on_time_versions"] = versions(
    "signups_on_time", "customer_id", "changed_at", "event_id DESC", ("segment", "region"), ("entity_type",)
)
TABLES["order_events"] = """
SELECT o_orderkey, list_extract(['england-and-wales', 'scotland', 'northern-ireland'], CAST(o_orderkey % 3 + 1 AS INT)) AS division,
    o_orderpriority || suffix AS title, 'order ' || o_orderkey AS notes, o_orderkey % 2 = 0 AS bunting,
    CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS loaded_at, CAST(o_orderdate AS DATE) + days AS holiday_date
FROM orders CROSS JOIN (VALUES (0, ''), (7, ' +7')) AS s(days, suffix)"""
TABLES["order_holidays"] = """
SELECT * FROM order_events WHERE loaded_at = (SELECT max(loaded_at) FROM order_events)
QUALIFY row_number() OVER (PARTITION BY division, holiday_date, title
    ORDER BY loaded_at DESC, notes DESC NULLS LAST, bunting DESC NULLS LAST) = 1"""
TABLES["day_checks"] = """
SELECT m.feed_date, suite, check_name, expected, actual, expected = actual AS passed
FROM measured AS m JOIN manifests AS f ON m.feed_date = f.feed_date
CROSS JOIN LATERAL (VALUES ('rows', 'lines', f.rows_written, m.bronze_rows), ('rows', 'no duplicates', f.clean_rows, m.bronze_rows),
    ('defects', 'nulls', f.null_field, m.null_field)) AS c(suite, check_name, expected, actual)"""
TABLES["totals"] = """
SELECT (SELECT count(*) FROM keyed WHERE source_system = 'paysim') AS history_rows_gold,
    (SELECT count(*) FROM raw_history) AS history_rows_bronze,
    (SELECT coalesce(sum(amount), 0) FROM keyed WHERE source_system = 'paysim') AS history_amount_gold,
    (SELECT coalesce(sum(amount), 0) FROM raw_history) AS history_amount_bronze,
    (SELECT count(*) FILTER (is_fraud) FROM keyed WHERE source_system = 'paysim') AS history_fraud_gold,
    (SELECT coalesce(sum(isFraud), 0) FROM raw_history) AS history_fraud_bronze,
    (SELECT count(DISTINCT event_id) FROM raw_feed) AS bronze_generated_events,
    (SELECT coalesce(sum(x), 0) FROM (SELECT max(amount) AS x FROM raw_feed GROUP BY event_id)) AS bronze_generated_amount,
    (SELECT count(*) FILTER (event_id IS NULL) FROM raw_feed) AS bronze_null_id_rows,
    (SELECT count(*) FROM keyed WHERE source_system = 'generator-v1') AS gold_generated_rows,
    (SELECT coalesce(sum(amount), 0) FROM keyed WHERE source_system = 'generator-v1') AS gold_generated_amount,
    (SELECT count(DISTINCT event_id) FROM rejected) AS quarantined_events,
    (SELECT coalesce(sum(x), 0) FROM (SELECT first(amount ORDER BY _ingested_at) AS x FROM rejected GROUP BY event_id)) AS quarantined_amount,
    (SELECT count(*) FROM transactions) AS silver_rows,
    (SELECT count(*) FROM keyed) AS fact_rows,
    (SELECT count(DISTINCT event_id) FROM keyed) AS fact_distinct_events,
    (SELECT coalesce(sum(amount), 0) FROM keyed) AS fact_value_total,
    (SELECT count(*) FROM keyed AS f ANTI JOIN cal AS c ON f.date_key = c.date_key) AS orphan_date_keys,
    (SELECT count(*) FROM keyed AS f ANTI JOIN types AS y ON f.type_key = y.type_key) AS orphan_type_keys,
    (SELECT count(*) FROM keyed AS f ANTI JOIN dim_cust AS y ON f.origin_customer_key = y.customer_key) AS orphan_origin_keys,
    (SELECT count(*) FROM keyed AS f ANTI JOIN dim_cust AS y ON f.counterparty_key = y.customer_key) AS orphan_counterparty_keys,
    (SELECT count(*) FROM keyed WHERE source_system = 'generator-v1' AND (origin_customer_key = '-1' OR counterparty_key = '-1'))
        AS generated_unknown_customer_rows,
    (SELECT coalesce(sum(txn_count), 0) FROM kpi) AS kpi_txn_total,
    (SELECT coalesce(sum(txn_value), 0) FROM kpi) AS kpi_value_total,
    (SELECT count(*) FROM dim_cust WHERE is_current AND customer_key <> '-1') AS current_versions,
    (SELECT count(DISTINCT customer_id) FROM dim_cust WHERE customer_key <> '-1') AS distinct_customers,
    (SELECT count(*) FROM dim_cust WHERE customer_key <> '-1') AS dim_versions,
    (SELECT count(*) FROM raw_profile) AS profile_events"""

TOTALS_MONEY = (
    "history_amount_gold", "history_amount_bronze", "bronze_generated_amount", "gold_generated_amount",
    "quarantined_amount", "fact_value_total", "kpi_value_total",
)
TOTALS_COUNTS = (
    "history_rows_gold", "history_rows_bronze", "history_fraud_gold", "history_fraud_bronze", "bronze_generated_events",
    "bronze_null_id_rows", "gold_generated_rows", "quarantined_events", "silver_rows", "fact_rows", "fact_distinct_events",
    "orphan_date_keys", "orphan_type_keys", "orphan_origin_keys", "orphan_counterparty_keys",
    "generated_unknown_customer_rows", "kpi_txn_total", "current_versions", "distinct_customers", "dim_versions", "profile_events",
)

QUERIES: dict[str, str] = {}

FRAUD = f"{i('count(*)', 'txn_count')}, {n('sum(amount)', 'txn_value')}"
FRAUD_TAIL = (
    f"{i('count(*) FILTER (is_fraud)', 'fraud_count')}, {n('sum(CASE WHEN is_fraud THEN amount ELSE 0 END)', 'fraud_value')}, "
    "count(*) FILTER (is_fraud) / count(*) AS fraud_rate"
)
QUERIES["kpi_daily"] = f"""
SELECT {i('date_key')}, {d('calendar_date')}, is_bank_holiday_eaw, source_system, txn_count, {n('txn_value')}, approved_count,
    {n('approved_value')}, declined_count, approval_rate, fraud_count, {n('fraud_value')}, fraud_rate, fraud_missed_count,
    {n('fraud_missed_value')}, fraud_catch_rate FROM kpi"""
QUERIES["kpi_by_type"] = f"""
SELECT {i('type_key')}, txn_type AS type_name, source_system, {FRAUD},
    CAST(CAST(round(sum(amount) / count(*), 6) AS DECIMAL(22, 6)) AS DOUBLE) AS avg_amount, {FRAUD_TAIL}
FROM fact GROUP BY type_key, txn_type, source_system"""
QUERIES["kpi_by_band"] = f"""
SELECT {i('amount_band_sort')}, amount_band, source_system, {FRAUD}, {FRAUD_TAIL}
FROM fact GROUP BY amount_band_sort, amount_band, source_system"""
QUERIES["kpi_by_hour"] = f"""
SELECT {i('hour_of_day')}, day_part, source_system, {FRAUD}, {FRAUD_TAIL} FROM fact GROUP BY hour_of_day, day_part, source_system"""
QUERIES["rule_effectiveness"] = "SELECT * FROM rules"
UNUSUAL = f"{i('date_key')}, entity_id, entity_role, txn_count, {n('total_amount')}, fraud_count, {a('flag_reasons')}"
QUERIES["unusual_senders"] = f"SELECT {UNUSUAL} FROM senders"
QUERIES["unusual_recipients"] = f"SELECT {UNUSUAL} FROM recipients"
QUERIES["unusual_activity"] = f"SELECT {UNUSUAL} FROM (SELECT * FROM senders UNION ALL SELECT * FROM recipients)"
QUERIES["unusual_activity_default"] = (
    f"SELECT {UNUSUAL} FROM (SELECT * FROM senders_default UNION ALL SELECT * FROM recipients_default)"
)
QUERIES["fact_transactions"] = f"""
SELECT event_id, {t('event_ts')}, {i('date_key')}, {i('hour_of_day')}, {i('type_key')}, customer_id, counterparty_id, {n('amount')},
    {i('amount_band_sort')}, {n('origin_balance_before')}, {n('origin_balance_after')}, status, status_source, decline_reason,
    is_fraud, is_zero_amount, channel, source_system, day_part, amount_band, is_declined, flag_balance_drain, flag_night_high_value, flag_burst, flag_source_rule,
    {t('origin_from')}, {t('counterparty_from')} FROM keyed"""
for name, minutes in (("count_within", 360), ("count_within_default", 15)):
    QUERIES[name] = f"""
SELECT event_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts
    RANGE BETWEEN INTERVAL {minutes} MINUTE PRECEDING AND INTERVAL {minutes} MINUTE FOLLOWING) AS BIGINT) AS clicks_nearby FROM events"""
QUERIES["unify_sources"] = f"""
SELECT event_id, {t('event_ts')}, {d('event_date')}, txn_type, {n('amount')}, customer_id, counterparty_id, counterparty_kind,
    {n('origin_balance_before')}, {n('origin_balance_after')}, {n('dest_balance_before')}, {n('dest_balance_after')}, status,
    status_source, decline_reason, is_fraud, is_zero_amount, is_bank_holiday, channel, source_system, event_ts_raw,
    {a('failed_checks')}, {t('_ingested_at')} FROM unified"""
QUERIES["content_ids"] = """
SELECT o_orderkey, 'O' || left(sha256(concat_ws('|', length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey,
    CASE WHEN o_orderkey % 3 <> 0 THEN length(o_orderpriority) || ':' || o_orderpriority ELSE '~' END,
    length(o_orderstatus) || ':' || o_orderstatus)), 16) AS order_id FROM orders"""
QUERIES["strict_timestamps"] = f"SELECT event_id, event_ts, {t(STRICT, 'parsed')} FROM raw_feed"
QUERIES["tag_failures"] = f"SELECT event_id, {a('failed_checks')}, {t('_ingested_at')} FROM feed_tagged"
QUERIES["split_valid"] = f"""
SELECT event_id, {t('event_ts')}, {n('amount')}, status FROM feed_tagged WHERE len(failed_checks) = 0"""
QUERIES["quarantine"] = f"""
SELECT event_id, {a('failed_checks')}, event_ts_raw, txn_type, CAST(amount AS DOUBLE) AS amount, customer_id, status,
    CAST(is_fraud AS VARCHAR) AS is_fraud, CAST(12 AS BIGINT) AS n_fields FROM feed_tagged WHERE len(failed_checks) > 0"""
QUERIES["expectations_drop"] = f"""
SELECT event_id, {n('amount')}, {t('_ingested_at')} FROM raw_feed WHERE amount > 0 AND customer_id IS NOT NULL"""
QUERIES["expectations_stream"] = f"""
WITH kept AS (SELECT count(*) AS published_rows, {n('sum(amount)', 'published_amount')} FROM raw_feed WHERE amount > 0 AND customer_id IS NOT NULL),
told AS (SELECT count(*) AS n, count(*) FILTER (coalesce(amount, 0) <= 0) AS a, count(*) FILTER (customer_id IS NULL) AS c,
    count(*) FILTER (is_fraud IS NULL) AS f FROM raw_feed)
SELECT v.expectation, n - v.failed AS passed_records, v.failed AS failed_records, TRUE AS several_batches, published_rows, published_amount
FROM told CROSS JOIN LATERAL (VALUES ('positive_amount', a), ('known_customer', c), ('has_label', f), ('named_source', 0)) AS v(expectation, failed)
CROSS JOIN kept"""
QUERIES["unlisted_fields"] = """
SELECT 'channel' AS name, count(*) AS row_count FROM events WHERE day(ts) >= 16 AND event_type IS NOT NULL HAVING count(*) > 0"""
QUERIES["check_results"] = f"""
SELECT {t('CAST(feed_date AS TIMESTAMP)', 'run_at')}, 'run-1' AS run_id, suite, check_name, CAST(expected AS VARCHAR) AS expected,
    CAST(actual AS VARCHAR) AS actual, passed FROM day_checks"""
TALLY = "count(*) AS checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed"
QUERIES["check_scorecard"] = f"""
SELECT suite, {t('CAST(feed_date AS TIMESTAMP)', 'run_at')}, {TALLY} FROM day_checks
WHERE feed_date = (SELECT max(feed_date) FROM day_checks) GROUP BY suite, feed_date"""
QUERIES["check_history"] = f"SELECT {t('CAST(feed_date AS TIMESTAMP)', 'run_at')}, {TALLY} FROM day_checks GROUP BY feed_date"
QUERIES["expectation_scorecard"] = f"""
SELECT 'feed' AS dataset, expectation, bronze_rows - bad AS passed_records, bad AS failed_records,
    {t('CAST(feed_date AS TIMESTAMP)', 'run_at')}, bad / bronze_rows AS failure_rate
FROM measured CROSS JOIN LATERAL (VALUES ('null_field', null_field), ('bad_amount', bad_amount), ('unknown_type', unknown_type),
    ('bad_timestamp', bad_timestamp)) AS v(expectation, bad)
WHERE feed_date = (SELECT max(feed_date) FROM measured)"""
QUERIES["latest_expectations"] = """
SELECT strftime(feed_date + 1, '%Y-%m-%d') AS update_id, 'feed' AS dataset, expectation, bronze_rows - bad AS passed_records,
    bad AS failed_records
FROM measured CROSS JOIN LATERAL (VALUES ('null_field', null_field), ('bad_amount', bad_amount), ('unknown_type', unknown_type),
    ('bad_timestamp', bad_timestamp)) AS v(expectation, bad)
WHERE feed_date = (SELECT max(feed_date) FROM measured)"""
QUERIES["quarantine_summary"] = f"""
SELECT reason, {d('feed_date')}, count(*) AS quarantined_rows, count(*) FILTER (is_fraud) AS hidden_fraud_rows
FROM (SELECT unnest(failed_checks) AS reason, feed_date, is_fraud FROM feed_tagged) GROUP BY reason, feed_date"""
QUERIES["measure_defects"] = f"""
SELECT {d('feed_date')}, bronze_rows, distinct_events, null_field, bad_amount, unknown_type, bad_timestamp FROM measured"""
QUERIES["manifest_compare"] = """
SELECT count(*) FILTER (m.bronze_rows <> f.rows_written) AS days_rows_differ,
    count(*) FILTER (m.distinct_events <> f.clean_rows) AS days_events_differ,
    count(*) FILTER (m.bronze_rows <> f.clean_rows) AS days_with_duplicates,
    count(*) FILTER (m.null_field <> f.null_field) AS days_nulls_differ
FROM measured AS m JOIN manifests AS f ON m.feed_date = f.feed_date"""
# An edit of one row must show, if that row is there.
QUERIES["fingerprint_native"] = """
SELECT count(*) AS row_count, TRUE AS same_when_reordered, bool_or(l_orderkey = 1 AND l_linenumber = 1) AS other_when_edited FROM lineitem"""
QUERIES["fingerprint"] = """
SELECT count(*) AS row_count, CAST(sum(CAST(('0x' || left(sha256(concat_ws('|', '=' || step, '=' || type, '=' || amount, '=' || nameOrig,
    '=' || nameDest, '=' || oldbalanceOrg, '=' || isFraud, '~')), 15)) AS HUGEINT)) AS VARCHAR) AS content_hash FROM raw_history"""
LINE_TIES = "l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC"
for name in ("scd1_lineitem", "scd1_stream", "scd1_maintained"):
    QUERIES[name] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, {i('l_linenumber')}, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, {t('l_shipdate')}
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LINE_TIES}) = 1"""
QUERIES["split_stream"] = f"""
SELECT CASE WHEN len(failed_checks) = 0 THEN 'clean' ELSE 'quarantine' END AS sink, source_system, {a('failed_checks', 'reasons')},
    count(*) AS row_count, {n('sum(amount)', 'amount')}
FROM (SELECT * FROM feed_tagged UNION ALL BY NAME SELECT * FROM history_mapped) GROUP BY ALL"""
SCD2 = f"customer_id, segment, region, entity_type, {t('start_at')}, {t('end_at')}"
for name in ("scd2_orders_profile", "scd2_maintained"):
    QUERIES[name] = f"SELECT {SCD2} FROM order_versions"
QUERIES["scd1_maintained_batches"] = """
SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS row_count, TRUE AS several_batches, TRUE AS left_files_alone FROM lineitem"""
QUERIES["scd2_untracked"] = f"SELECT {SCD2} FROM order_segments"
QUERIES["scd2_stream"] = f"SELECT {SCD2} FROM signup_versions"
QUERIES["dim_customer"] = f"""
SELECT customer_id, entity_type, segment, region, {t('valid_from')}, {t('valid_to')}, is_current FROM dim_cust"""
for name in ("pit_join_lineitem", "pit_join_linear"):
    QUERIES[name] = f"""
SELECT l.l_orderkey, {i('l.l_linenumber', 'l_linenumber')}, l.l_partkey, {t('l.l_shipdate', 'l_shipdate')}, l.l_extendedprice, o.o_custkey,
    {t('v.start_at', 'version_from')}
FROM lineitem AS l JOIN orders AS o ON l.l_orderkey = o.o_orderkey
LEFT JOIN order_versions AS v ON o.o_custkey = v.customer_id AND l.l_shipdate >= v.start_at AND l.l_shipdate < coalesce(v.end_at, {OPEN})"""

QUERIES["pit_join_overlapping"] = f"""
WITH terms AS (SELECT o_custkey, o_orderkey AS term, o_orderdate AS valid_from,
    CASE WHEN o_orderkey % 50 <> 7 THEN o_orderdate + to_days(CAST(o_orderkey % 500 AS INTEGER)) END AS valid_to FROM orders)
SELECT l.l_orderkey, {i('l.l_linenumber', 'l_linenumber')}, l.l_partkey, {t('l.l_shipdate', 'l_shipdate')}, l.l_extendedprice, o.o_custkey,
    coalesce((SELECT arg_max(term, (valid_from, term)) FROM terms AS v
        WHERE v.o_custkey = o.o_custkey AND l.l_shipdate >= v.valid_from AND (v.valid_to IS NULL OR l.l_shipdate < v.valid_to)), -1) AS term
FROM lineitem AS l JOIN orders AS o ON l.l_orderkey = o.o_orderkey"""


def signup_pit(key: str, table: str, alias: str) -> str:
    return (
        f"LEFT JOIN {table} AS {alias} ON e.{key} = {alias}.customer_id AND e.ts >= {alias}.start_at "
        f"AND e.ts < coalesce({alias}.end_at, {OPEN})"
    )


QUERIES["pit_join_both_roles"] = f"""
SELECT e.event_id, e.user_id, {t('e.ts', 'ts')}, CAST(e.k AS BIGINT) AS k, coalesce(epoch_us(s.start_at), -1) AS sender_version,
    coalesce(epoch_us(r.start_at), -1) AS recipient_version
FROM e {signup_pit('user_id', 'signup_versions', 's')} {signup_pit('k', 'signup_versions', 'r')}"""
QUERIES["late_change_diff"] = f"""
SELECT * FROM (
    SELECT e.event_id, e.user_id, coalesce(epoch_us(b.start_at), -1) AS before_version, coalesce(epoch_us(a.start_at), -1) AS after_version
    FROM e {signup_pit('user_id', 'on_time_versions', 'b')} {signup_pit('user_id', 'signup_versions', 'a')})
WHERE before_version <> after_version"""
QUERIES["asof_recompute"] = """
SELECT e.event_id, arg_max(s.segment, s.changed_at) AS expected_segment, arg_max(s.region, s.changed_at) AS expected_region
FROM e JOIN signups AS s ON e.user_id = s.customer_id AND e.ts >= s.changed_at GROUP BY e.event_id"""
QUERIES["derivations_agree"] = f"""
WITH recomputed AS (
    SELECT e.event_id, arg_max(s.segment, s.changed_at) AS segment, arg_max(s.region, s.changed_at) AS region
    FROM e JOIN signups AS s ON e.user_id = s.customer_id AND e.ts >= s.changed_at GROUP BY e.event_id),
versioned AS (
    SELECT e.event_id, s.segment, s.region
    FROM e JOIN signup_versions AS s ON e.user_id = s.customer_id AND e.ts >= s.start_at AND e.ts < coalesce(s.end_at, {OPEN}))
SELECT count(*) FILTER (r.segment <> v.segment OR r.region <> v.region) AS mismatches,
    (SELECT count(*) FROM recomputed) AS recomputed, (SELECT count(*) FROM versioned) AS versioned
FROM recomputed AS r JOIN versioned AS v USING (event_id)"""
QUERIES["scd2_integrity"] = """
WITH damaged AS (
    SELECT customer_id, valid_from, is_current, customer_key,
        CASE WHEN day(valid_from) = 10 THEN valid_from - INTERVAL 1 DAY ELSE valid_to END AS valid_to
    FROM dim_cust WHERE customer_key <> '-1'),
linked AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS next_from FROM damaged)
SELECT count(*) FILTER (next_from IS NOT NULL AND valid_to <> next_from) AS gaps_or_overlaps,
    count(*) FILTER (valid_to <= valid_from) AS inverted_ranges,
    (SELECT count(*) FROM (SELECT customer_id FROM damaged GROUP BY customer_id HAVING count(*) FILTER (is_current) <> 1)) AS not_one_current
FROM linked"""
QUERIES["dim_date"] = f"""
WITH h AS (SELECT holiday_date, max(title) FILTER (division = 'england-and-wales') AS eaw, max(title) FILTER (division = 'scotland') AS sco,
    max(title) FILTER (division = 'northern-ireland') AS ni FROM order_holidays GROUP BY holiday_date),
c AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS c FROM orders)
SELECT CAST(strftime(c, '%Y%m%d') AS BIGINT) AS date_key, {d('c', 'calendar_date')}, eaw AS bank_holiday_name_eaw,
    year(c) AS calendar_year, month(c) AS calendar_month, monthname(c) AS month_name, day(c) AS day_of_month, dayname(c) AS day_name,
    weekofyear(c) AS iso_week, dayofweek(c) IN (0, 6) AS is_weekend, eaw IS NOT NULL AS is_bank_holiday_eaw,
    sco IS NOT NULL AS is_bank_holiday_scotland, ni IS NOT NULL AS is_bank_holiday_ni
FROM c LEFT JOIN h ON c = h.holiday_date"""
QUERIES["type_lookup"] = f"""
SELECT f.type, {i('y.type_key', 'type_key')}, y.category, y.can_be_fraud, count(*) AS row_count
FROM raw_feed AS f LEFT JOIN types AS y ON f.type = y.type_name GROUP BY ALL"""
HOLIDAY_ROWS = f"division, title, notes, bunting, {t('loaded_at')}, {d('holiday_date')}"
QUERIES["payload_to_rows"] = f"SELECT {HOLIDAY_ROWS} FROM order_events"
QUERIES["snapshot_replace"] = f"SELECT {HOLIDAY_ROWS} FROM order_holidays"
QUERIES["holiday_flag"] = f"SELECT {d('event_date')}, is_bank_holiday, count(*) AS row_count FROM unified GROUP BY ALL"
QUERIES["holiday_flag_stream"] = f"""
SELECT {d('event_date')}, is_bank_holiday, count(*) AS row_count FROM unified WHERE source_system = 'generator-v1' GROUP BY ALL"""
QUERIES["holiday_versions"] = f"""
WITH days AS (
    SELECT event_date, CASE WHEN CAST(right(event_id, 1) AS INT) % 2 = 1 THEN 2 ELSE 1 END AS side_version,
        event_date IS NOT NULL AND event_date IN (SELECT holiday_date FROM holidays WHERE division = 'england-and-wales') AS holiday_now
    FROM ({mapped_feed('raw_feed')}))
SELECT how, {d('event_date')}, CAST(side_version AS BIGINT) AS side_version,
    holiday_now AND (side_version = 2 OR day(event_date) % 2 = 1) AS is_bank_holiday, holiday_now, count(*) AS row_count
FROM days, (VALUES ('stored'), ('derived again')) AS h(how) GROUP BY ALL"""
QUERIES["orphans"] = """
SELECT l_partkey AS fk_value, count(*) AS fact_rows FROM lineitem ANTI JOIN events ON l_partkey = user_id GROUP BY l_partkey"""
QUERIES["overlap"] = "SELECT count(*) AS overlap FROM lineitem JOIN events ON l_partkey = user_id"
QUERIES["control_totals"] = (
    "SELECT " + ", ".join([*map(n, TOTALS_MONEY), *map(i, TOTALS_COUNTS)]) + " FROM totals"
)
CONSTRAINTS = (
    ("paysim_rows_match", "fail", "history_rows_gold = history_rows_bronze"),
    ("paysim_amount_matches", "fail", "history_amount_gold = history_amount_bronze"),
    ("paysim_fraud_matches", "fail", "history_fraud_gold = history_fraud_bronze"),
    ("generated_events_accounted_for", "fail", "bronze_generated_events = gold_generated_rows + quarantined_events"),
    ("generated_amount_accounted_for", "fail", "bronze_generated_amount = gold_generated_amount + quarantined_amount"),
    ("fact_equals_silver", "fail", "fact_rows = silver_rows"),
    ("fact_event_id_unique", "fail", "fact_rows = fact_distinct_events"),
    (
        "no_orphan_keys",
        "fail",
        "orphan_date_keys + orphan_type_keys + orphan_origin_keys + orphan_counterparty_keys = 0",
    ),
    ("generated_customers_resolved", "fail", "generated_unknown_customer_rows = 0"),
    ("kpi_daily_matches_fact", "fail", "kpi_txn_total = fact_rows AND kpi_value_total = fact_value_total"),
    ("one_current_version_per_customer", "fail", "current_versions = distinct_customers"),
    ("versions_match_profile_events", "warn", "dim_versions = profile_events"),
)
QUERIES["reconcile_constraints"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"constraint\", '{action}' AS action, {cond} AS passed FROM totals" for name, action, cond in CONSTRAINTS
)

VALID = "CAST(sum(clean_rows - null_field - bad_amount - unknown_type - bad_timestamp) AS BIGINT)"
SHIPPED = "date_trunc('day', l_shipdate) + to_hours(CAST(l_suppkey % 24 AS INT))"
HOLIDAY_LINES = """(SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) IN (
    SELECT CAST(start AS DATE) + CAST(n_nationkey AS INT) FROM nation, (VALUES ('2024-01-01'), ('1996-06-01')) AS s(start)
    WHERE n_regionkey % 3 = 0 AND n_nationkey % 5 <> 4))"""


def days_differ(left: str, right: str, measured: str = "measured") -> str:
    return f"(SELECT count(*) FROM {measured} AS m JOIN manifests AS f ON m.feed_date = f.feed_date WHERE m.{left} <> f.{right})"


def reason_rows(code: str) -> str:
    return f"(SELECT count(*) FROM rejected WHERE list_contains(failed_checks, '{code}'))"


TX = "(SELECT count(*) FROM transactions WHERE {0})"
FACT = "(SELECT count(*) FROM keyed WHERE {0})"
PIT = """(SELECT count(*) FROM (SELECT f.event_id, arg_max(p.segment, p.changed_at) AS s, arg_max(p.region, p.changed_at) AS r
    FROM keyed AS f JOIN raw_profile AS p ON f.customer_id = p.customer_id AND f.event_ts >= p.changed_at
    WHERE f.source_system = 'generator-v1' GROUP BY f.event_id) AS o
    JOIN keyed AS f ON o.event_id = f.event_id JOIN dim_cust AS c ON f.origin_customer_key = c.customer_key
    WHERE o.s <> c.segment OR o.r <> c.region)"""
TABLES["profile_days"] = "SELECT day AS feed_date, count(*) AS bronze_rows FROM raw_profile WHERE NOT late GROUP BY day"
TABLES["silver_days"] = """
SELECT event_date AS feed_date, count(*) AS silver_rows FROM transactions WHERE source_system = 'generator-v1' GROUP BY event_date"""
TABLES["links"] = """
SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS next_from FROM dim_cust WHERE customer_key <> '-1'"""
KNOWN = "(SELECT count(*) FROM lineitem WHERE {0})"
CHECKS = (
    ("bronze", "paysim: row count equals the source file", KNOWN.format("TRUE"), "(SELECT count(*) FROM raw_history)"),
    ("bronze", "paysim: fraud rows equal the source", KNOWN.format("l_linenumber % 5 IN (1, 2) AND l_returnflag = 'R'"),
     "(SELECT sum(isFraud) FROM raw_history)"),
    ("bronze", "paysim: flagged rows equal the source",
     KNOWN.format("l_linenumber % 5 = 2 AND l_returnflag = 'R' AND l_quantity = 50"), "(SELECT sum(isFlaggedFraud) FROM raw_history)"),
    ("bronze", "paysim: rows rescued by the contract", "0", "0"),
    ("bronze", "paysim: money values rejected as null", "0", "(SELECT count(*) FROM raw_history WHERE amount IS NULL OR oldbalanceOrg IS NULL)"),
    ("bronze", "transactions: days loaded equal days in the manifests", "(SELECT count(*) FROM manifests)", "(SELECT count(*) FROM measured)"),
    ("bronze", "transactions: days whose line count differs from the manifest", "0", days_differ("bronze_rows", "rows_written")),
    ("bronze", "transactions: days whose distinct events differ from the manifest", "0", days_differ("distinct_events", "clean_rows")),
    ("bronze", "transactions: days whose null defects differ from the manifest", "0", days_differ("null_field", "null_field")),
    ("bronze", "transactions: days whose bad amounts differ from the manifest", "0", days_differ("bad_amount", "bad_amount")),
    ("bronze", "transactions: days whose unknown types differ from the manifest", "0", days_differ("unknown_type", "unknown_type")),
    ("bronze", "transactions: days whose bad timestamps differ from the manifest", "0", days_differ("bad_timestamp", "bad_timestamp")),
    ("bronze", "transactions: rows rescued by the contract", "0", "0"),
    ("bronze", "customer profile: total rows equal the manifests plus the late files",
     "(SELECT sum(profile_rows) FROM manifests) + (SELECT count(*) FROM raw_profile WHERE late)", "(SELECT count(*) FROM raw_profile)"),
    ("bronze", "customer profile: late-arriving rows equal the landing files", "(SELECT count(*) FROM raw_profile WHERE late)",
     "(SELECT count(*) FROM raw_profile WHERE late)"),
    ("bronze", "customer profile: days whose row count differs from the manifest", "0", days_differ("bronze_rows", "profile_rows", "profile_days")),
    ("bronze", "customer profile: rows rescued by the contract", "0", "0"),
    ("bronze", "bank holidays: payloads landed", "2", "2"),
    ("bronze", "bank holidays: regions parsed from the payload", "3", "(SELECT count(DISTINCT n_regionkey % 3) FROM nation)"),
    ("silver", "silver: total rows equal PaySim rows plus valid generated rows",
     f"(SELECT count(*) FROM raw_history) + (SELECT {VALID} FROM manifests)", TX.format("TRUE")),
    ("silver", "silver: PaySim rows equal bronze", "(SELECT count(*) FROM raw_history)", TX.format("source_system = 'paysim'")),
    ("silver", "silver: days loaded equal days in the manifests", "(SELECT count(*) FROM manifests)", "(SELECT count(*) FROM silver_days)"),
    ("silver", "silver: days whose valid rows differ from the manifest", "0",
     "(SELECT count(*) FROM silver_days AS s JOIN manifests AS f ON s.feed_date = f.feed_date WHERE s.silver_rows <> f.clean_rows - f.null_field - f.bad_amount - f.unknown_type - f.bad_timestamp)"),
    ("silver", "silver: event_id is unique", "0", "(SELECT count(*) - count(DISTINCT event_id) FROM transactions)"),
    ("silver", "silver and quarantine share no event_id", "0",
     "(SELECT count(*) FROM transactions AS s JOIN rejected AS q ON s.event_id = q.event_id)"),
    ("silver", "quarantine: rows equal the injected defects",
     "(SELECT sum(null_field + bad_amount + unknown_type + bad_timestamp) FROM manifests)", "(SELECT count(*) FROM rejected)"),
    ("silver", "quarantine: NULL_REQUIRED_FIELD rows equal the manifests", "(SELECT sum(null_field) FROM manifests)", reason_rows("NULL_REQUIRED_FIELD")),
    ("silver", "quarantine: NEGATIVE_AMOUNT rows equal the manifests", "(SELECT sum(bad_amount) FROM manifests)", reason_rows("NEGATIVE_AMOUNT")),
    ("silver", "quarantine: UNKNOWN_TYPE rows equal the manifests", "(SELECT sum(unknown_type) FROM manifests)", reason_rows("UNKNOWN_TYPE")),
    ("silver", "quarantine: BAD_TIMESTAMP rows equal the manifests", "(SELECT sum(bad_timestamp) FROM manifests)", reason_rows("BAD_TIMESTAMP")),
    ("silver", "quarantine: UNKNOWN_STATUS rows (the generator injects none)", "0", reason_rows("UNKNOWN_STATUS")),
    ("silver", "quarantine: rows with more than one reason", "0", "(SELECT count(*) FROM rejected WHERE len(failed_checks) > 1)"),
    ("silver", "quarantine: rows without a raw record", "0", "0"),
    ("silver", "duplicates removed equal the manifests", "(SELECT sum(duplicates) FROM manifests)",
     "(SELECT count(*) FROM raw_feed) - " + TX.format("source_system = 'generator-v1'") + " - (SELECT count(*) FROM rejected)"),
    ("silver", "paysim: declined rows equal the flagged rows", "(SELECT sum(isFlaggedFraud) FROM raw_history)",
     TX.format("source_system = 'paysim' AND status = 'DECLINED'")),
    ("silver", "paysim: zero-amount rows are kept and flagged", "(SELECT count(*) FROM raw_history WHERE amount = 0)",
     TX.format("source_system = 'paysim' AND is_zero_amount")),
    ("silver", "paysim: merchant destination balances are NULL, not zero", "0",
     TX.format("source_system = 'paysim' AND counterparty_kind = 'merchant' AND dest_balance_before IS NOT NULL")),
    ("silver", "paysim: first event time is the anchor", "1",
     f"(SELECT CAST(min(event_ts) = (SELECT min({SHIPPED}) FROM lineitem) AS INT) FROM transactions WHERE source_system = 'paysim')"),
    ("silver", "paysim: last event time is step the last", "1",
     f"(SELECT CAST(max(event_ts) = (SELECT max({SHIPPED}) FROM lineitem) AS INT) FROM transactions WHERE source_system = 'paysim')"),
    ("silver", "paysim: bank holiday rows equal the rows on 1 June", HOLIDAY_LINES,
     TX.format("source_system = 'paysim' AND is_bank_holiday")),
    ("silver", "status is derived for PaySim only", "0", TX.format("status_source = 'derived_paysim_rule' AND source_system <> 'paysim'")),
    ("silver", "customer profile: rows equal bronze", "(SELECT count(*) FROM raw_profile)", "(SELECT count(*) FROM raw_profile)"),
    ("silver", "bank holidays: regions", "3", "(SELECT count(DISTINCT division) FROM holidays)"),
    ("silver", "bank holidays: duplicate holidays", "0", "(SELECT count(*) - count(DISTINCT (division, holiday_date, title)) FROM holidays)"),
    ("silver", "bank holidays: England and Wales has the 1996 summer bank holiday", "1",
     "(SELECT count(*) FROM holidays WHERE division = 'england-and-wales' AND holiday_date = DATE '1996-06-01')"),
    ("gold", "scd2: versions with a gap or overlap before the next one", "0",
     "(SELECT count(*) FROM links WHERE next_from IS NOT NULL AND valid_to <> next_from)"),
    ("gold", "scd2: versions that end before they start", "0", "(SELECT count(*) FROM links WHERE valid_to <= valid_from)"),
    ("gold", "scd2: customers without exactly one current version", "0",
     "(SELECT count(*) FROM (SELECT customer_id FROM links GROUP BY customer_id HAVING count(*) FILTER (is_current) <> 1))"),
    ("gold", "scd2: generated facts with no as-of match", "0",
     FACT.format("source_system = 'generator-v1' AND origin_customer_key <> '-1' AND customer_id NOT IN (SELECT customer_id FROM raw_profile)")),
    ("gold", "scd2: point-in-time mismatches (segment or region)", "0", PIT),
    ("gold", "scd2: history is used (some facts point at an older version)", "1",
     "(SELECT CAST(count(*) > 0 AS INT) FROM keyed AS f JOIN dim_cust AS c ON f.origin_customer_key = c.customer_key WHERE f.source_system = 'generator-v1' AND NOT c.is_current)"),
    ("gold", "dim_customer: Unknown member rows", "1", "(SELECT count(*) FROM dim_cust WHERE customer_key = '-1')"),
    ("gold", "dim_date: calendar days", "10958", "(SELECT count(*) FROM cal)"),
    ("gold", "dim_date: England and Wales bank holidays in 1996", "(SELECT count(*) FROM nation WHERE n_regionkey % 3 = 0 AND n_nationkey % 5 <> 4)", "(SELECT count(*) FROM cal WHERE is_bank_holiday_eaw AND calendar_year = 1996)"),
    ("gold", "dim_date: 1 June is the England and Wales summer bank holiday", "1",
     "(SELECT count(*) FROM cal WHERE date_key = 19960601 AND is_bank_holiday_eaw)"),
    ("gold", "dim_type: rows", "5", "(SELECT count(*) FROM types)"),
    ("gold", "fact: Unknown customers outside PaySim", "0", FACT.format("source_system <> 'paysim' AND origin_customer_key = '-1'")),
    ("gold", "fact: PaySim rows with a known customer", "0", FACT.format("source_system = 'paysim' AND origin_customer_key <> '-1'")),
    ("gold", "fact: rows without an amount band", "0", FACT.format("amount_band IS NULL")),
    ("gold", "landing file: PaySim rows equal gold", "(SELECT count(*) FROM raw_history)", FACT.format("source_system = 'paysim'")),
    ("gold", "landing file: PaySim total amount equals gold, to the cent", "(SELECT sum(amount) FROM raw_history)",
     "(SELECT sum(amount) FROM keyed WHERE source_system = 'paysim')"),
    ("gold", "landing files: generated events are in gold or quarantine", "(SELECT count(DISTINCT event_id) FROM raw_feed)",
     FACT.format("source_system = 'generator-v1'") + " + (SELECT count(DISTINCT event_id) FROM rejected)"),
    ("gold", "kpi_daily: one row per date and source", "0", "(SELECT count(*) - count(DISTINCT (date_key, source_system)) FROM kpi)"),
    ("gold", "kpi_daily: rates outside 0 to 1", "0",
     "(SELECT count(*) FROM kpi WHERE approval_rate NOT BETWEEN 0 AND 1 OR fraud_rate NOT BETWEEN 0 AND 1)"),
    ("gold", "rules: PaySim balance-drain flags equal the profile",
     KNOWN.format("l_linenumber % 5 IN (1, 2) AND l_quantity = 1 AND l_partkey % 500 <> 0"), FACT.format("source_system = 'paysim' AND flag_balance_drain")),
    ("gold", "rules: PaySim source-rule flags equal the profile",
     KNOWN.format("l_linenumber % 5 = 2 AND l_returnflag = 'R' AND l_quantity = 50"), FACT.format("source_system = 'paysim' AND flag_source_rule")),
    ("gold", "unusual_activity: rows without a reason", "0",
     "(SELECT count(*) FROM (SELECT * FROM senders UNION ALL SELECT * FROM recipients) WHERE len(flag_reasons) = 0)"),
)
QUERIES["check_suites"] = (
    "SELECT suite, check_name, expected, actual, coalesce(expected = actual, FALSE) AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{suite}_reconciliation' AS suite, '{name}' AS check_name, {n(expected, 'expected')}, {n(actual, 'actual')}"
        for suite, name, expected, actual in CHECKS
    )
    + ")"
)

QUERIES["validate_payloads"] = """
SELECT o_orderkey, CASE o_orderkey % 11 WHEN 5 THEN 'INVALID_JSON' WHEN 1 THEN 'MISSING_DIVISION' WHEN 2 THEN 'NO_EVENTS'
    WHEN 7 THEN 'NO_EVENTS' WHEN 3 THEN 'MISSING_FIELD' WHEN 4 THEN 'BAD_DATE' WHEN 9 THEN 'BAD_DATE' END AS reason FROM orders"""


def line_scan(table: str, key: str, text: str, patterns: tuple[str, ...]) -> str:
    hits = " + ".join(f"CAST(regexp_matches(line, '(?i){p}') AS BIGINT)" for p in patterns)
    ends = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{0085}\x{2028}\x{2029}]"
    return f"""
SELECT {key.split(' AS ')[-1]}, line_no, n_patterns FROM (
    SELECT *, {hits} AS n_patterns FROM (
        SELECT {key}, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no
        FROM (SELECT *, string_split_regex({text}, '{ends}') AS lines FROM {table})))
WHERE n_patterns > 0"""


QUERIES["scan_lines"] = line_scan(
    "documents", "doc_id", "text",
    (r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}", r"(/home/|/users/)[a-z0-9._-]+", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"),
)
QUERIES["scan_lines_pages"] = line_scan("pages", "page_id", "html", (r"https?://[a-z0-9.-]+", "<script>"))
QUERIES["scan_lines_conversations"] = line_scan(
    "conversations", "conv_id || '-' || turn AS turn_id", "text", (r"(^|[ ,.])le([ ,.]|$)", r"(^|[ ,.])the([ ,.]|$)", "[0-9]{2,}")
)
PROFILE_TEXTS = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE m WHEN 7 THEN 'n/a' WHEN 8 THEN val || '55' WHEN 9 THEN ' ' ELSE CAST(val AS VARCHAR) END AS amount,
    CASE WHEN m <> 3 THEN event_type END AS event_type, CASE WHEN m = 4 THEN '' ELSE props END AS props FROM e"""
TABLES["profile_texts"] = PROFILE_TEXTS


def column_profile(name: str, numeric: bool) -> str:
    number = f"try_cast({name} AS DECIMAL(28, 10))"
    low, high = (
        (f"CAST(CAST(min({number}) AS DOUBLE) AS VARCHAR)", f"CAST(CAST(max({number}) AS DOUBLE) AS VARCHAR)")
        if numeric
        else (f"min({name})", f"max({name})")
    )
    unparsable = f"count(*) FILTER (trim({name}) <> '' AND {number} IS NULL)" if numeric else "CAST(NULL AS BIGINT)"
    lossy = f"count(*) FILTER ({number} <> round({number}, 2))" if numeric else "CAST(NULL AS BIGINT)"
    return f"""
SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS nulls, count(*) FILTER (trim({name}) = '') AS blanks,
    {unparsable} AS unparsable, {lossy} AS lossy, {low} AS min_value, {high} AS max_value, count(*) AS row_count FROM profile_texts"""


QUERIES["profile_columns"] = " UNION ALL ".join(
    column_profile(c, c == "amount") for c in ("event_id", "amount", "event_type", "props")
)
QUERIES["profile_counts"] = """
SELECT dimension, value, count(*) AS row_count FROM (
    SELECT 'type' AS dimension, type AS value FROM raw_history
    UNION ALL SELECT 'hour', CAST((step - 1) % 24 AS VARCHAR) FROM raw_history
    UNION ALL SELECT 'day', CAST((step - 1) // 24 AS VARCHAR) FROM raw_history
    UNION ALL SELECT 'recipient', left(nameDest, 1) FROM raw_history) GROUP BY ALL"""
QUERIES["profile_distinct"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
)
QUERIES["duplicate_rows"] = "SELECT CAST(count(*) FILTER (m IN (10, 11)) AS BIGINT) AS duplicate_rows FROM e"
TABLES["line_texts"] = """
SELECT l_partkey * 10 + l_linenumber AS key, CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount,
    l_shipdate, l_returnflag AS flag FROM lineitem"""
for name in ("read_contract", "read_contract_stream"):
    QUERIES[name] = f"""
SELECT CASE WHEN key % 13 <> 5 THEN CAST(quantity AS BIGINT) END AS quantity, flag, key % 17 = 4 AS no_amount,
    CASE WHEN key % 19 <> 1 THEN strftime(l_shipdate, '%Y-%m-%d') END AS ship_day,
    CASE WHEN key % 13 = 5 THEN 'many' END AS rescued_quantity, CASE WHEN key % 17 = 4 THEN '12,50' END AS rescued_amount,
    key % 19 = 1 AS shipped_rescued, count(*) AS row_count,
    {n("sum(CASE WHEN key % 17 = 4 THEN NULL WHEN key % 17 = 3 THEN 10102842.03 ELSE amount END)", 'amount')}
FROM line_texts GROUP BY ALL"""
for name in ("read_evolving", "read_evolving_stream"):
    QUERIES[name] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
    CASE WHEN day(ts) < 16 OR event_id % 20 <> 0 THEN CAST(val AS DOUBLE) END AS value, user_id,
    CASE WHEN day(ts) >= 16 THEN event_type END AS channel, CASE WHEN day(ts) >= 16 AND event_id % 20 = 0 THEN 'lots' END AS rescued_value
FROM e"""
QUERIES["clustered_layout"] = f"""
SELECT {i('date_key')}, count(*) AS row_count, {n('sum(amount)', 'amount')} FROM fact
WHERE date_key BETWEEN 19970101 AND 19971231 AND type_key = 4 GROUP BY date_key"""
QUERIES["read_payloads"] = f"""
SELECT division, count(*) AS holidays, {d('min(holiday_date)', 'first_day')} FROM (
    SELECT n_regionkey, CAST(start AS DATE) + CAST(n_nationkey AS INT) AS holiday_date,
        ['england-and-wales', 'scotland', 'northern-ireland'][n_regionkey % 3 + 1] AS division
    FROM nation, (VALUES ('2024-01-01'), ('1996-06-01')) AS s(start), (VALUES (1), (2)) AS delivery(n)
    WHERE n = 1 OR n_nationkey % 5 <> 4) GROUP BY division"""
QUERIES["audit_columns"] = """
SELECT count(*) AS row_count, count(*) AS with_file, count(*) AS with_file_time, count(*) AS with_read_time FROM lineitem"""
QUERIES["rerun_without_new_files"] = "SELECT count(*) AS row_count FROM lineitem"
QUERIES["rebuild"] = "SELECT count(*) AS row_count, TRUE AS same_as_batch FROM feed_tagged WHERE len(failed_checks) = 0"
QUERIES["rebuild_layers"] = """
SELECT layer, row_count, TRUE AS same_as_batch, 'unified,clean,fact,by_type' AS derived_first, CAST(0 AS BIGINT) AS derived_again FROM (
    SELECT 'unified' AS layer, count(*) AS row_count FROM unified UNION ALL SELECT 'clean', count(*) FROM transactions
    UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'by_type', count(DISTINCT (type_key, source_system)) FROM fact)"""
QUERIES["separate_flows"] = f"""
SELECT 'feed' AS flow, count(*) AS row_count, {n('sum(amount)', 'amount')}, TRUE AS several_batches FROM feed_tagged
UNION ALL SELECT 'history', count(*), {n('sum(amount)', 'amount')}, TRUE FROM history_mapped"""
QUERIES["quality_tables"] = QUERIES["check_scorecard"]
QUERIES["recomputed_table"] = """
SELECT o_orderpriority, count(*) AS orders, CAST(2 AS BIGINT) AS version FROM orders GROUP BY o_orderpriority"""
QUERIES["layout_report"] = """
SELECT count(*) AS row_count, TRUE AS files_fit, TRUE AS files_skipped, TRUE AS bytes_fit FROM fact
WHERE date_key BETWEEN 19970101 AND 19971231 AND type_key = 4"""
LAYOUT_FILTERS = """(VALUES ('one day', 19970310, 19970310, 0, 99), ('one week and type', 19970310, 19970316, 4, 4),
    ('one type', 0, 99999999, 4, 4), ('everything', 0, 99999999, 0, 99)) AS f(filter, d0, d1, t0, t1)"""
QUERIES["curve_layout"] = f"""
SELECT filter, count(event_id) AS row_count, {n('sum(amount)', 'amount')}, filter <> 'everything' AS skips_files
FROM {LAYOUT_FILTERS} LEFT JOIN fact ON date_key BETWEEN d0 AND d1 AND type_key BETWEEN t0 AND t1 GROUP BY filter"""
QUERIES["layout_pruning"] = f"""
SELECT layout, filter, count(event_id) AS row_count, TRUE AS holds_all,
    CASE filter WHEN 'everything' THEN FALSE WHEN 'one type' THEN layout = 'curve' ELSE layout <> 'plain' END AS skips_files
FROM (VALUES ('plain'), ('partitioned'), ('clustered'), ('curve')) AS l(layout), {LAYOUT_FILTERS}
LEFT JOIN fact ON date_key BETWEEN d0 AND d1 AND type_key BETWEEN t0 AND t1 GROUP BY ALL"""
QUERIES["scan_documents"] = """
SELECT doc_id, pos AS line_no, CAST(starts_with(lower(line), 'the ') AS BIGINT) + CAST(ends_with(lower(line), 'and.') AS BIGINT)
    + CAST(line = '' AS BIGINT) AS n_patterns
FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
WHERE starts_with(lower(line), 'the ') OR ends_with(lower(line), 'and.') OR line = ''"""
FEED = "source_system = 'generator-v1'"
QUERIES["metric_tiles"] = f"""
SELECT {i('sum(txn_count)', 'transactions')}, sum(fraud_count) / sum(txn_count) AS fraud_rate, sum(approved_count) / sum(txn_count) AS approval_rate,
    {n('sum(fraud_missed_value)', 'fraud_missed_value')} FROM kpi WHERE {FEED}"""
QUERIES["metric_trend"] = f"""
SELECT {d('calendar_date', 'day')}, sum(fraud_count) / sum(txn_count) AS fraud_rate FROM kpi WHERE {FEED} GROUP BY calendar_date"""
QUERIES["metric_by_type"] = f"SELECT txn_type AS type_name, count(*) FILTER (is_fraud) / count(*) AS fraud_rate FROM fact WHERE {FEED} GROUP BY txn_type"
QUERIES["metric_by_hour"] = f"""
SELECT {i('hour_of_day')}, count(*) FILTER (is_fraud) / count(*) AS fraud_rate FROM fact WHERE {FEED} GROUP BY hour_of_day"""
QUERIES["metric_rules"] = f"""
SELECT rule_name, flagged_count, fraud_caught, fraud_total, precision_rate, recall_rate FROM rules WHERE {FEED}"""
QUERIES["metric_range"] = f"""
SELECT source_system, is_bank_holiday_eaw, {i('sum(txn_count)', 'transactions')}, {n('sum(txn_value)', 'value')},
    sum(approved_count) / sum(txn_count) AS approval_rate FROM kpi WHERE date_key BETWEEN 19960101 AND 20240115 GROUP BY ALL"""
STAR = f"""{i('count(*)', 'transactions')}, count(*) FILTER (is_fraud) AS fraud_count, count(*) FILTER (is_fraud) / count(*) AS fraud_rate,
    count(*) FILTER (NOT is_declined) / count(*) AS approval_rate,
    {n('sum(amount) FILTER (is_fraud AND NOT is_declined)', 'fraud_missed_value')},
    count(*) FILTER (is_fraud AND is_declined) / nullif(count(*) FILTER (is_fraud), 0) AS fraud_catch_rate,
    count(*) FILTER (flag_balance_drain AND is_fraud) / nullif(count(*) FILTER (flag_balance_drain), 0) AS balance_drain_precision"""
QUERIES["star_metrics_sender"] = f"""
SELECT c.segment, c.region, {STAR} FROM keyed AS f LEFT JOIN dim_cust AS c ON f.origin_customer_key = c.customer_key
WHERE {FEED} GROUP BY c.segment, c.region"""
QUERIES["star_metrics_recipient"] = f"""
SELECT c.segment, f.txn_type AS type_name, {STAR} FROM keyed AS f LEFT JOIN dim_cust AS c ON f.counterparty_key = c.customer_key
WHERE {FEED} GROUP BY c.segment, f.txn_type"""
QUERIES["star_metrics_calendar"] = f"""
SELECT {i('c.calendar_year', 'calendar_year')}, day_part, source_system, {STAR} FROM fact AS f LEFT JOIN cal AS c ON f.date_key = c.date_key GROUP BY ALL"""
QUERIES["with_previous_day"] = f"""
WITH k AS (SELECT * FROM kpi)
SELECT {d('k.calendar_date', 'calendar_date')}, k.source_system, k.fraud_rate, p.fraud_rate AS previous_fraud_rate, p.txn_count AS previous_txn_count
FROM k LEFT JOIN k AS p ON k.calendar_date = p.calendar_date + 1 AND k.source_system = p.source_system"""
QUERIES["newest_orders"] = f"""
SELECT o_orderkey, {t('o_orderdate')}, o_totalprice FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 1"""

# Rules of every table as (table, name, condition) for the expectation report.
DATASET_TABLES = {
    "bronze.bank_holidays_raw": "(VALUES ('x'), ('y')) AS p(payload)",
    "bronze.customer_profile_changes": "(SELECT *, NULL AS _rescued_data FROM raw_profile)",
    "bronze.history_transactions": "(SELECT *, NULL AS _rescued_data FROM raw_history)",
    "bronze.transactions_daily": "(SELECT *, NULL AS _rescued_data FROM raw_feed)",
    "silver.bank_holidays": "holidays",
    "silver.customer_profile_events": "raw_profile",
    "silver.transactions": "transactions",
    "silver.transactions_quarantine": "(SELECT *, '{}' AS raw_record FROM rejected)",
    "gold.dim_customer": "dim_cust",
    "gold.dim_date": "cal",
    "gold.dim_type": "types",
    "gold.fact_transactions": "keyed",
    "gold.kpi_daily": "kpi",
    "gold.reconciliation": "totals",
    "gold.unusual_activity": "(SELECT * FROM senders UNION ALL SELECT * FROM recipients)",
}


# Names and conditions of the expectations, as the data model fixes them, in this engine's SQL.
CONDITIONS = {
    "bronze.bank_holidays_raw": (
        ('payload_present', 'payload IS NOT NULL AND length(payload) > 0'),
    ),
    "bronze.customer_profile_changes": (
        ('no_contract_violations', '_rescued_data IS NULL'),
    ),
    "bronze.history_transactions": (
        ('no_contract_violations', '_rescued_data IS NULL'),
    ),
    "bronze.transactions_daily": (
        ('no_contract_violations', '_rescued_data IS NULL'),
    ),
    "silver.bank_holidays": (
        ('holiday_date_present', 'holiday_date IS NOT NULL'),
        ('known_division', "division IN ('england-and-wales', 'scotland', 'northern-ireland')"),
        ('title_present', 'title IS NOT NULL AND length(title) > 0'),
    ),
    "silver.customer_profile_events": (
        ('customer_id_present', 'customer_id IS NOT NULL'),
        ('changed_at_present', 'changed_at IS NOT NULL'),
        ('known_entity_type', "entity_type IN ('customer', 'merchant')"),
        ('id_prefix_matches_type', "(entity_type = 'customer' AND customer_id LIKE 'CG%') OR (entity_type = 'merchant' AND customer_id LIKE 'MG%')"),
        ('segment_present', 'segment IS NOT NULL'),
        ('region_present', 'region IS NOT NULL'),
    ),
    "silver.transactions": (
        ('event_id_present', 'event_id IS NOT NULL'),
        ('event_ts_present', 'event_ts IS NOT NULL'),
        ('customer_present', 'customer_id IS NOT NULL'),
        ('amount_not_negative', 'amount IS NOT NULL AND amount >= 0'),
        ('known_type', "txn_type IN ('CASH_OUT', 'PAYMENT', 'CASH_IN', 'TRANSFER', 'DEBIT')"),
        ('known_status', "status IN ('APPROVED', 'DECLINED')"),
        ('decline_has_reason', "status = 'APPROVED' OR decline_reason IS NOT NULL"),
        ('counterparty_present', 'counterparty_id IS NOT NULL'),
        ('event_date_in_range', "event_date BETWEEN DATE '1996-01-01' AND DATE '2024-01-20'"),
    ),
    "silver.transactions_quarantine": (
        ('has_reason', 'len(failed_checks) > 0'),
        ('has_event_id', 'event_id IS NOT NULL'),
        ('has_raw_record', 'raw_record IS NOT NULL'),
    ),
    "gold.dim_customer": (
        ('customer_key_present', 'customer_key IS NOT NULL'),
        ('customer_id_present', 'customer_id IS NOT NULL'),
        ('valid_range', 'valid_from < valid_to'),
        ('known_entity_type', "entity_type IN ('customer', 'merchant', 'unknown')"),
    ),
    "gold.dim_date": (
        ('date_key_present', 'date_key IS NOT NULL'),
        ('date_key_matches_date', "date_key = CAST(strftime(calendar_date, '%Y%m%d') AS INT)"),
    ),
    "gold.dim_type": (
        ('type_key_present', 'type_key IS NOT NULL'),
        ('type_name_unique_looking', 'type_name IS NOT NULL AND length(type_name) > 0'),
    ),
    "gold.fact_transactions": (
        ('event_id_present', 'event_id IS NOT NULL'),
        ('date_key_present', 'date_key IS NOT NULL'),
        ('type_key_present', 'type_key IS NOT NULL'),
        ('origin_customer_key_present', 'origin_customer_key IS NOT NULL'),
        ('counterparty_key_present', 'counterparty_key IS NOT NULL'),
        ('amount_not_negative', 'amount >= 0'),
    ),
    "gold.kpi_daily": (
        ('approval_rate_valid', 'approval_rate BETWEEN 0 AND 1'),
        ('fraud_rate_valid', 'fraud_rate BETWEEN 0 AND 1'),
    ),
    "gold.reconciliation": (
        ('paysim_rows_match', 'history_rows_gold = history_rows_bronze'),
        ('paysim_amount_matches', 'history_amount_gold = history_amount_bronze'),
        ('paysim_fraud_matches', 'history_fraud_gold = history_fraud_bronze'),
        ('generated_events_accounted_for', 'bronze_generated_events = gold_generated_rows + quarantined_events'),
        ('generated_amount_accounted_for', 'bronze_generated_amount = gold_generated_amount + quarantined_amount'),
        ('fact_equals_silver', 'fact_rows = silver_rows'),
        ('fact_event_id_unique', 'fact_rows = fact_distinct_events'),
        ('no_orphan_keys', 'orphan_date_keys = 0 AND orphan_type_keys = 0 AND orphan_origin_keys = 0 AND orphan_counterparty_keys = 0'),
        ('generated_customers_resolved', 'generated_unknown_customer_rows = 0'),
        ('kpi_daily_matches_fact', 'kpi_txn_total = fact_rows AND kpi_value_total = fact_value_total'),
        ('one_current_version_per_customer', 'current_versions = distinct_customers'),
        ('versions_match_profile_events', 'dim_versions = profile_events'),
    ),
    "gold.unusual_activity": (
        ('has_reason', 'len(flag_reasons) > 0'),
    ),
}


def expectations_report() -> str:
    return " UNION ALL ".join(
        f"SELECT 'update-1' AS update_id, '{dataset}' AS dataset, '{name}' AS expectation, "
        f"count(*) FILTER (coalesce({condition}, FALSE)) AS passed_records, "
        f"count(*) FILTER (NOT coalesce({condition}, FALSE)) AS failed_records FROM {DATASET_TABLES[dataset]}"
        for dataset, rules in CONDITIONS.items()
        for name, condition in rules
    )


QUERIES["expectations_report"] = expectations_report()


def needed(sql: str, found: dict[str, None]) -> None:
    """Subqueries a text refers to, each after the ones it builds on."""
    for name in TABLES:
        if name not in found and re.search(rf"(?<![\w.'@]){name}(?![\w'(])", sql):
            needed(TABLES[name], found)
            found[name] = None


def compose(sql: str) -> str:
    found: dict[str, None] = {}
    needed(sql, found)
    if not found:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in found)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in QUERIES.items()}
