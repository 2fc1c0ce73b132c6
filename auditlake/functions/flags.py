"""Row flags, bands and detection rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlake import constants as K


def band_sort(amount: Column, edges: Sequence[float] = K.BAND_EDGES) -> Column:
    """1-based band of an amount; a lower edge belongs to the band above it."""
    result = F.lit(len(edges) + 1)
    for position, edge in reversed(list(enumerate(edges, start=1))):
        result = F.when(amount < F.lit(edge), position).otherwise(result)
    return result


def amount_band(sort: Column, labels: Sequence[str] = K.BAND_LABELS) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in labels]), sort)


def day_part(hour: Column) -> Column:
    result = F.lit(K.LAST_DAY_PART)
    for before, name in reversed(K.DAY_PART_EDGES):
        result = F.when(hour < before, name).otherwise(result)
    return result


def derive_status(flag: Column) -> tuple[Column, Column]:
    """Status and decline reason for a source that only has a 0/1 flag."""
    declined = flag == 1
    status = F.when(declined, "DECLINED").otherwise("APPROVED")
    return status, F.when(declined, K.HISTORY_DECLINE_REASON)


def rule_balance_drain(txn_type: Column, amount: Column, balance_before: Column) -> Column:
    """A transfer or cash-out that moves the whole balance."""
    return txn_type.isin("TRANSFER", "CASH_OUT") & (amount > 0) & (amount == balance_before)


def rule_night_high_value(
    txn_type: Column,
    hour: Column,
    amount: Column,
    threshold: float = K.NIGHT_AMOUNT,
    hours: tuple[int, int] = K.NIGHT_HOURS,
) -> Column:
    return (txn_type == "TRANSFER") & hour.between(*hours) & (amount >= threshold)


def rule_source(status_source: Column, status: Column) -> Column:
    """The source's own rule, known through the status derived from it."""
    return (status_source == K.HISTORY_STATUS_SOURCE) & (status == "DECLINED")
