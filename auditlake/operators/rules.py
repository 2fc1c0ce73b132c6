"""The expectations of every table. Conditions and names are fixed values of the data model."""

from __future__ import annotations

from auditlake.operators.quality import FAIL, WARN, Expectation

_NO_RESCUE = (("no_contract_violations", "_rescued_data IS NULL", WARN),)

_TABLES = {
    "bronze.bank_holidays_raw": (
        ("payload_present", "payload IS NOT NULL AND length(payload) > 0", WARN),
    ),
    "bronze.customer_profile_changes": _NO_RESCUE,
    "bronze.history_transactions": _NO_RESCUE,
    "bronze.transactions_daily": _NO_RESCUE,
    "silver.bank_holidays": (
        ("holiday_date_present", "holiday_date IS NOT NULL", FAIL),
        ("known_division", "division IN ('england-and-wales', 'scotland', 'northern-ireland')", FAIL),
        ("title_present", "title IS NOT NULL AND length(title) > 0", WARN),
    ),
    "silver.customer_profile_events": (
        ("customer_id_present", "customer_id IS NOT NULL", FAIL),
        ("changed_at_present", "changed_at IS NOT NULL", FAIL),
        ("known_entity_type", "entity_type IN ('customer', 'merchant')", WARN),
        (
            "id_prefix_matches_type",
            "(entity_type = 'customer' AND customer_id LIKE 'CG%')"
            " OR (entity_type = 'merchant' AND customer_id LIKE 'MG%')",
            WARN,
        ),
        ("segment_present", "segment IS NOT NULL", WARN),
        ("region_present", "region IS NOT NULL", WARN),
    ),
    "silver.transactions": (
        ("event_id_present", "event_id IS NOT NULL", FAIL),
        ("event_ts_present", "event_ts IS NOT NULL", FAIL),
        ("customer_present", "customer_id IS NOT NULL", FAIL),
        ("amount_not_negative", "amount IS NOT NULL AND amount >= 0", FAIL),
        ("known_type", "txn_type IN ('CASH_OUT', 'PAYMENT', 'CASH_IN', 'TRANSFER', 'DEBIT')", FAIL),
        ("known_status", "status IN ('APPROVED', 'DECLINED')", FAIL),
        ("decline_has_reason", "status = 'APPROVED' OR decline_reason IS NOT NULL", WARN),
        ("counterparty_present", "counterparty_id IS NOT NULL", WARN),
        ("event_date_in_range", "event_date BETWEEN DATE '{first_day}' AND DATE '{last_day}'", WARN),
    ),
    "silver.transactions_quarantine": (
        ("has_reason", "size(failed_checks) > 0", FAIL),
        ("has_event_id", "event_id IS NOT NULL", WARN),
        ("has_raw_record", "raw_record IS NOT NULL", WARN),
    ),
    "gold.dim_customer": (
        ("customer_key_present", "customer_key IS NOT NULL", FAIL),
        ("customer_id_present", "customer_id IS NOT NULL", FAIL),
        ("valid_range", "valid_from < valid_to", FAIL),
        ("known_entity_type", "entity_type IN ('customer', 'merchant', 'unknown')", WARN),
    ),
    "gold.dim_date": (
        ("date_key_present", "date_key IS NOT NULL", FAIL),
        (
            "date_key_matches_date",
            "date_key = CAST(date_format(calendar_date, 'yyyyMMdd') AS INT)",
            FAIL,
        ),
    ),
    "gold.dim_type": (
        ("type_key_present", "type_key IS NOT NULL", FAIL),
        ("type_name_unique_looking", "type_name IS NOT NULL AND length(type_name) > 0", WARN),
    ),
    "gold.fact_transactions": (
        ("event_id_present", "event_id IS NOT NULL", FAIL),
        ("date_key_present", "date_key IS NOT NULL", FAIL),
        ("type_key_present", "type_key IS NOT NULL", FAIL),
        ("origin_customer_key_present", "origin_customer_key IS NOT NULL", FAIL),
        ("counterparty_key_present", "counterparty_key IS NOT NULL", FAIL),
        ("amount_not_negative", "amount >= 0", FAIL),
    ),
    "gold.kpi_daily": (
        ("approval_rate_valid", "approval_rate BETWEEN 0 AND 1", WARN),
        ("fraud_rate_valid", "fraud_rate BETWEEN 0 AND 1", WARN),
    ),
    "gold.reconciliation": (
        ("{history}_rows_match", "history_rows_gold = history_rows_bronze", FAIL),
        ("{history}_amount_matches", "history_amount_gold = history_amount_bronze", FAIL),
        ("{history}_fraud_matches", "history_fraud_gold = history_fraud_bronze", FAIL),
        (
            "generated_events_accounted_for",
            "bronze_generated_events = gold_generated_rows + quarantined_events",
            FAIL,
        ),
        (
            "generated_amount_accounted_for",
            "bronze_generated_amount = gold_generated_amount + quarantined_amount",
            FAIL,
        ),
        ("fact_equals_silver", "fact_rows = silver_rows", FAIL),
        ("fact_event_id_unique", "fact_rows = fact_distinct_events", FAIL),
        (
            "no_orphan_keys",
            "orphan_date_keys = 0 AND orphan_type_keys = 0"
            " AND orphan_origin_keys = 0 AND orphan_counterparty_keys = 0",
            FAIL,
        ),
        ("generated_customers_resolved", "generated_unknown_customer_rows = 0", FAIL),
        (
            "kpi_daily_matches_fact",
            "kpi_txn_total = fact_rows AND kpi_value_total = fact_value_total",
            FAIL,
        ),
        ("one_current_version_per_customer", "current_versions = distinct_customers", FAIL),
        ("versions_match_profile_events", "dim_versions = profile_events", WARN),
    ),
    "gold.unusual_activity": (("has_reason", "size(flag_reasons) > 0", FAIL),),
}

DATASETS = tuple(_TABLES)
FIRST_DAY, LAST_DAY = "2026-08-20", "2028-12-31"
HISTORY_LABEL = "history"


def expectations(
    dataset: str,
    first_day: str = FIRST_DAY,
    last_day: str = LAST_DAY,
    history: str = HISTORY_LABEL,
) -> list[Expectation]:
    """Rules of one table; the accepted days and the history source's label are parameters."""
    return [
        Expectation(
            name.format(history=history),
            condition.format(first_day=first_day, last_day=last_day),
            action,
        )
        for name, condition, action in _TABLES[dataset]
    ]
