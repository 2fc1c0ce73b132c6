"""The vocabulary, edges, labels, codes and schemas of the data model.

They are part of the results, so they are stated here once, as they are.
"""

# Domains
TXN_TYPES = ("CASH_OUT", "PAYMENT", "CASH_IN", "TRANSFER", "DEBIT")
STATUSES = ("APPROVED", "DECLINED")
ENTITY_TYPES = ("customer", "merchant")
DIVISIONS = ("england-and-wales", "scotland", "northern-ireland")
HEADLINE_DIVISION = "england-and-wales"
EVENT_FIELDS = ("title", "date", "notes", "bunting")

# Sources
FEED_SOURCE = "generator-v1"
HISTORY_SOURCE = "paysim"
FEED_STATUS_SOURCE = "source_system"
HISTORY_STATUS_SOURCE = "derived_paysim_rule"
HISTORY_DECLINE_REASON = "PAYSIM_FLAGGED"
HISTORY_ANCHOR = "2026-08-20 00:00:00"
HISTORY_ID_PREFIX = "P"
HISTORY_ID_DIGITS = 24

# Reason codes, in the order they are reported
NULL_REQUIRED_FIELD = "NULL_REQUIRED_FIELD"
NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
UNKNOWN_TYPE = "UNKNOWN_TYPE"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
UNKNOWN_STATUS = "UNKNOWN_STATUS"

# The one accepted timestamp text
STRICT_TS_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
PROFILE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Amount bands and day parts
BAND_EDGES = (10, 100, 1000, 10000, 100000)
BAND_LABELS = (
    "0 to 9.99",
    "10 to 99.99",
    "100 to 999.99",
    "1,000 to 9,999.99",
    "10,000 to 99,999.99",
    "100,000 and over",
)
DAY_PART_EDGES = ((6, "night"), (12, "morning"), (18, "afternoon"))
LAST_DAY_PART = "evening"

# Dimensions
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_KEY = -1
UNKNOWN_START = "1970-01-01 00:00:00"
CALENDAR_START = "2026-01-01"
CALENDAR_END = "2028-12-31"
TYPE_ROWS = (
    (1, "CASH_IN", "cash", "Cash paid into an account", False),
    (2, "CASH_OUT", "cash", "Cash withdrawn from an account", True),
    (3, "PAYMENT", "payment", "Payment to a merchant", False),
    (4, "TRANSFER", "transfer", "Transfer between accounts", True),
    (5, "DEBIT", "payment", "Debit from an account", False),
)

# Rule thresholds
NIGHT_HOURS = (1, 4)
NIGHT_AMOUNT = 1000
BURST_MINUTES = 15
BURST_COUNT = 5
FREQUENT_PER_DAY = 8
HUB_TRANSFERS = 5
HUB_SENDERS = 5

# Payload schema
PAYLOAD_DDL = (
    "MAP<STRING, STRUCT<division: STRING, events: ARRAY<STRUCT<"
    "title: STRING, date: STRING, notes: STRING, bunting: BOOLEAN>>>>"
)

# Contracts
FEED_DDL = (
    "event_id STRING, event_ts STRING, type STRING, amount DECIMAL(18,2), customer_id STRING, "
    "counterparty_id STRING, origin_balance_before DECIMAL(18,2), "
    "origin_balance_after DECIMAL(18,2), status STRING, decline_reason STRING, is_fraud INT, "
    "source_system STRING"
)
HISTORY_DDL = (
    "step INT, type STRING, amount DECIMAL(18,2), nameOrig STRING, oldbalanceOrg DECIMAL(18,2), "
    "newbalanceOrig DECIMAL(18,2), nameDest STRING, oldbalanceDest DECIMAL(18,2), "
    "newbalanceDest DECIMAL(18,2), isFraud INT, isFlaggedFraud INT"
)
PROFILE_DDL = (
    "customer_id STRING, entity_type STRING, segment STRING, region STRING, changed_at TIMESTAMP"
)
UNIFIED_DDL = (
    "event_id STRING, event_ts TIMESTAMP, event_date DATE, txn_type STRING, amount DECIMAL(18,2), "
    "customer_id STRING, counterparty_id STRING, counterparty_kind STRING, "
    "origin_balance_before DECIMAL(18,2), origin_balance_after DECIMAL(18,2), "
    "dest_balance_before DECIMAL(18,2), dest_balance_after DECIMAL(18,2), status STRING, "
    "status_source STRING, decline_reason STRING, is_fraud BOOLEAN, is_zero_amount BOOLEAN, "
    "is_bank_holiday BOOLEAN, channel STRING, source_system STRING, event_ts_raw STRING, "
    "failed_checks ARRAY<STRING>, _source_file STRING, _ingested_at TIMESTAMP"
)
CHECK_RESULTS_DDL = (
    "run_at TIMESTAMP, run_id STRING, suite STRING, check_name STRING, expected STRING, "
    "actual STRING, passed BOOLEAN"
)
EXPECTATION_RESULTS_DDL = (
    "run_at TIMESTAMP, run_id STRING, update_id STRING, dataset STRING, expectation STRING, "
    "passed_records BIGINT, failed_records BIGINT"
)
