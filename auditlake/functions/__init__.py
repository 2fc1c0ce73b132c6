"""Column expressions: parsing, ids, flags, bands, ratios. All of them are Spark built-ins."""

from auditlake.functions.flags import (
    amount_band,
    band_sort,
    day_part,
    derive_status,
    rule_balance_drain,
    rule_night_high_value,
    rule_source,
)
from auditlake.functions.numbers import count_true, ratio, sum_where
from auditlake.functions.parse import (
    content_id,
    entity_kind,
    feed_date,
    is_late_file,
    null_if_merchant,
    reason_list,
    step_to_ts,
    strict_ts,
    surrogate_key,
)

__all__ = [
    "amount_band",
    "band_sort",
    "content_id",
    "count_true",
    "day_part",
    "derive_status",
    "entity_kind",
    "feed_date",
    "is_late_file",
    "null_if_merchant",
    "ratio",
    "reason_list",
    "rule_balance_drain",
    "rule_night_high_value",
    "rule_source",
    "step_to_ts",
    "strict_ts",
    "sum_where",
    "surrogate_key",
]
