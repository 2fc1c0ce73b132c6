"""Named measures evaluated at any grain, over the KPI tables or over the star."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlake.functions import count_true, ratio


@dataclass(frozen=True)
class Measure:
    """A sum, or a ratio of sums that is NULL on a zero denominator; never a mean of rates."""

    name: str
    numerator: str
    denominator: str | None = None

    @property
    def column(self) -> Column:
        total = F.sum(self.numerator)
        if self.denominator is not None:
            total = ratio(total.cast("double"), F.sum(self.denominator).cast("double"))
        return total.alias(self.name)


TRANSACTIONS = Measure("transactions", "txn_count")
VALUE = Measure("value", "txn_value")
FRAUD_RATE = Measure("fraud_rate", "fraud_count", "txn_count")
APPROVAL_RATE = Measure("approval_rate", "approved_count", "txn_count")
FRAUD_MISSED_VALUE = Measure("fraud_missed_value", "fraud_missed_value")


def filtered(df: DataFrame, filters: dict[str, object] | None) -> DataFrame:
    """Apply the filters whose column the frame has: a value, or a (low, high) range."""
    for name, wanted in (filters or {}).items():
        if name not in df.columns:
            continue
        column = F.col(name)
        df = df.where(column.between(*wanted) if isinstance(wanted, tuple) else column == wanted)
    return df


def metric_query(
    df: DataFrame,
    dims: list[str | Column],
    measures: list[Measure],
    filters: dict[str, object] | None = None,
) -> DataFrame:
    return filtered(df, filters).groupBy(*dims).agg(*[m.column for m in measures])


def tiles(daily: DataFrame, filters: dict[str, object] | None = None) -> DataFrame:
    """Grand totals shown as tiles."""
    return metric_query(daily, [], [TRANSACTIONS, FRAUD_RATE, APPROVAL_RATE, FRAUD_MISSED_VALUE], filters)


def trend(daily: DataFrame, measure: Measure, filters: dict[str, object] | None = None) -> DataFrame:
    """One measure per day."""
    day = F.to_date(F.date_trunc("day", "calendar_date")).alias("day")
    return metric_query(daily, [day], [measure], filters).orderBy("day")


def by_type(kpi: DataFrame, filters: dict[str, object] | None = None) -> DataFrame:
    return metric_query(kpi, ["type_name"], [FRAUD_RATE], filters)


def by_hour(kpi: DataFrame, filters: dict[str, object] | None = None) -> DataFrame:
    return metric_query(kpi, ["hour_of_day"], [FRAUD_RATE], filters).orderBy("hour_of_day")


def rule_table(rules: DataFrame, filters: dict[str, object] | None = None) -> DataFrame:
    columns = ["rule_name", "flagged_count", "fraud_caught", "fraud_total", "precision_rate", "recall_rate"]
    return filtered(rules, filters).select(*columns).orderBy("rule_name")


ROLE_KEYS = {"sender": "origin_customer_key", "recipient": "counterparty_key"}
TYPE_COLUMNS = ("type_name", "category")
CUSTOMER_COLUMNS = ("segment", "region", "entity_type")


def star_metrics(
    fact: DataFrame,
    by: list[str],
    dim_customer: DataFrame | None = None,
    dim_date: DataFrame | None = None,
    dim_type: DataFrame | None = None,
    role: str = "sender",
    filters: dict[str, object] | None = None,
) -> DataFrame:
    """Business measures sliced by fact or dimension columns; ``role`` picks the customer key.

    The fact is summed per dimension key first. Only those sums meet the dimensions, so a key that
    most rows share (such as Unknown) is a single row by then.
    """
    customer_key = ROLE_KEYS[role]
    joins = []
    if any(c in CUSTOMER_COLUMNS for c in by):
        joins.append((dim_customer, customer_key, "customer_key", CUSTOMER_COLUMNS))
    if any(c in TYPE_COLUMNS for c in by):
        joins.append((dim_type, "type_key", "type_key", TYPE_COLUMNS))
    if dim_date is not None and any(c in dim_date.columns and c not in fact.columns for c in by):
        joins.append((dim_date, "date_key", "date_key", tuple(c for c in by if c in dim_date.columns)))
    joined_columns = {c for *_, columns in joins for c in columns}
    keys = list(dict.fromkeys([k for _, k, _, _ in joins] + [c for c in by if c not in joined_columns]))

    fraud, declined, drain = F.col("is_fraud"), F.col("is_declined"), F.col("flag_balance_drain")
    missed = fraud & ~declined
    sums = filtered(fact, filters).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        count_true(fraud).alias("n_fraud"),
        count_true(~declined).alias("n_approved"),
        count_true(fraud & declined).alias("n_caught"),
        F.sum(F.when(missed, F.col("amount"))).alias("missed_value"),
        count_true(drain).alias("n_drain"),
        count_true(drain & fraud).alias("n_drain_fraud"),
    )
    for number, (dim, fk, pk, columns) in enumerate(joins):
        wanted = [c for c in columns if c in by]
        right = dim.select(F.col(pk).alias(f"_pk{number}"), *wanted)
        sums = sums.join(right, F.col(fk) == F.col(f"_pk{number}"), "left")
    total = {c: F.sum(c) for c in ("n", "n_fraud", "n_approved", "n_caught", "n_drain", "n_drain_fraud")}
    return sums.groupBy(*by).agg(
        total["n"].alias("transactions"),
        total["n_fraud"].alias("fraud_count"),
        ratio(total["n_fraud"], total["n"]).alias("fraud_rate"),
        ratio(total["n_approved"], total["n"]).alias("approval_rate"),
        F.sum("missed_value").alias("fraud_missed_value"),
        ratio(total["n_caught"], total["n_fraud"]).alias("fraud_catch_rate"),
        ratio(total["n_drain_fraud"], total["n_drain"]).alias("balance_drain_precision"),
    )


def with_previous_day(
    daily: DataFrame, columns: list[str], day: str = "calendar_date", by: list[str] = ()
) -> DataFrame:
    """Add ``previous_<column>``: the value one calendar day earlier, NULL when that day is missing.

    One row per ``by`` and day is expected, so a window holds as many rows as there are days.
    """
    in_order = W.partitionBy(*by).orderBy(day)
    is_next = F.lag(day).over(in_order) == F.date_sub(F.col(day), 1)
    return daily.withColumns(
        {f"previous_{c}": F.when(is_next, F.lag(c).over(in_order)) for c in columns}
    )
