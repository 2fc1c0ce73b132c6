"""Text and time parsing, identifiers, and reason lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake import constants as K


def strict_ts(text: Column) -> Column:
    """Timestamp from the one documented text form; every other text is NULL.

    Spark's own parser also reads a bare year, a date or a time of day, and dates the latter with
    the day of the run.
    """
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return F.when(text.rlike(K.STRICT_TS_PATTERN), parsed)


def step_to_ts(step: Column, anchor: str = K.HISTORY_ANCHOR) -> Column:
    """Hour counter (1 = the anchor itself) to a timestamp."""
    return F.timestamp_add("HOUR", step - 1, F.lit(anchor).cast("timestamp"))


def feed_date(path: Column, prefix: str) -> Column:
    """Date that follows ``prefix`` in a file path."""
    return F.to_date(F.left(F.substring_index(path, prefix, -1), F.lit(10)))


def is_late_file(path: Column, suffix: str = "_late.csv") -> Column:
    return F.endswith(path, F.lit(suffix))


def entity_kind(identifier: Column) -> Column:
    """Kind of party by the first letter of its id."""
    first = F.left(identifier, F.lit(1))
    return F.when(first == "M", "merchant").when(first == "C", "customer")


def null_if_merchant(identifier: Column, value: Column) -> Column:
    """Merchant balances are written as 0 but are not known."""
    return F.when(F.coalesce(F.left(identifier, F.lit(1)) == "M", F.lit(False)), None).otherwise(
        value
    )


def content_id(
    columns: list[Column],
    prefix: str = K.HISTORY_ID_PREFIX,
    digits: int = K.HISTORY_ID_DIGITS,
    null_safe: bool = False,
) -> Column:
    """Id made of a row's own content: prefix + leading hex digits of a SHA-256.

    The default form skips NULLs, so rows that differ only in which column is NULL can share an id;
    ``null_safe`` writes NULLs out and escapes the separator.
    """
    texts = [c.cast("string") for c in columns]
    if null_safe:
        texts = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~"))
            for t in texts
        ]
    return F.concat(F.lit(prefix), F.left(F.sha2(F.concat_ws("|", *texts), 256), F.lit(digits)))


def surrogate_key(business_key: Column, start: Column) -> Column:
    """Key of one version: a hash, so a rebuild gives the same keys and needs no shuffle."""
    return F.xxhash64(business_key, start.cast("string"))


def reason_list(rules: list[tuple[str, Column]]) -> Column:
    """Codes of the rules that hold, in the given order; NULL counts as not holding."""
    # Blanks removed by value: unlike a lambda filter, this stays inside generated code.
    fired = F.array(*[F.when(cond, F.lit(code)).otherwise(F.lit("")) for code, cond in rules])
    return F.array_remove(fired, "")
