"""KPI tables, rule effectiveness and unusual activity over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.functions import count_true, ratio, reason_list, sum_where


def _volume() -> list[Column]:
    return [F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("txn_value")]


def _fraud() -> list[Column]:
    fraud = F.col("is_fraud")
    return [
        count_true(fraud).alias("fraud_count"),
        sum_where(fraud, F.col("amount")).alias("fraud_value"),
        ratio(count_true(fraud), F.count(F.lit(1))).alias("fraud_rate"),
    ]


def kpi_daily(fact: DataFrame, dim_date: DataFrame, holiday: str = "is_bank_holiday_eaw") -> DataFrame:
    """Volume, value, approval and fraud per day and source. Sources are never mixed.

    The fact is aggregated before the calendar join. A NULL ``is_declined`` is not an approval in
    the counts, but its amount is not a decline either, so it stays in the approved value.
    """
    declined, fraud, amount = F.col("is_declined"), F.col("is_fraud"), F.col("amount")
    rows = F.count(F.lit(1))
    daily = fact.groupBy("date_key", "source_system").agg(
        *_volume(),
        count_true(~declined).alias("approved_count"),
        F.sum(F.when(declined, F.lit(0)).otherwise(amount)).alias("approved_value"),
        count_true(declined).alias("declined_count"),
        ratio(count_true(~declined), rows).alias("approval_rate"),
        *_fraud(),
        count_true(fraud & ~declined).alias("fraud_missed_count"),
        sum_where(fraud & ~declined, amount).alias("fraud_missed_value"),
        ratio(count_true(fraud & declined), count_true(fraud)).alias("fraud_catch_rate"),
    )
    days = dim_date.select("date_key", "calendar_date", holiday)
    measures = [c for c in daily.columns if c not in ("date_key", "source_system")]
    return daily.join(days, "date_key").select(
        "date_key", "calendar_date", holiday, "source_system", *measures
    )


def kpi_by_type(fact: DataFrame, dim_type: DataFrame) -> DataFrame:
    by_key = fact.groupBy("type_key", "source_system").agg(
        *_volume(), F.avg("amount").alias("avg_amount"), *_fraud()
    )
    named = by_key.join(dim_type.select("type_key", "type_name"), "type_key")
    measures = [c for c in by_key.columns if c not in ("type_key", "source_system")]
    return named.select("type_key", "type_name", "source_system", *measures)


def kpi_by_band(fact: DataFrame) -> DataFrame:
    return fact.groupBy("amount_band_sort", "amount_band", "source_system").agg(*_volume(), *_fraud())


def kpi_by_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hour_of_day", "day_part", "source_system").agg(*_volume(), *_fraud())


def rule_flags() -> dict[str, Column]:
    """The measured rules; the combined one leaves out the source's own rule."""
    drain, night, burst = (
        F.col("flag_balance_drain"),
        F.col("flag_night_high_value"),
        F.col("flag_burst"),
    )
    return {
        "source_rule": F.col("flag_source_rule"),
        "balance_drain": drain,
        "night_high_value": night,
        "burst": burst,
        "any_of_our_rules": drain | night | burst,
    }


def rule_effectiveness(fact: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Precision and recall of each rule per source.

    All rules are counted side by side in one aggregation; only its small result is turned into
    one row per rule.
    """
    rules = rule_flags() if rules is None else rules
    counts = fact.groupBy("source_system").agg(
        count_true(F.col("is_fraud")).alias("fraud_total"),
        *[count_true(flag).alias(f"flagged_{name}") for name, flag in rules.items()],
        *[count_true(flag & F.col("is_fraud")).alias(f"caught_{name}") for name, flag in rules.items()],
    )
    per_rule = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("rule_name"),
                    F.col(f"flagged_{name}").alias("flagged_count"),
                    F.col(f"caught_{name}").alias("fraud_caught"),
                )
                for name in rules
            ]
        )
    )
    rows = counts.select("source_system", "fraud_total", per_rule.alias("r"))
    return rows.select(
        "source_system",
        "r.rule_name",
        "r.flagged_count",
        "r.fraud_caught",
        "fraud_total",
        ratio(F.col("r.fraud_caught"), F.col("r.flagged_count")).alias("precision_rate"),
        ratio(F.col("r.fraud_caught"), F.col("fraud_total")).alias("recall_rate"),
    )


def _flagged_days(days: DataFrame, role: str, rules: list[tuple[str, Column]]) -> DataFrame:
    return days.select(
        "date_key",
        "entity_id",
        F.lit(role).alias("entity_role"),
        "txn_count",
        "total_amount",
        "fraud_count",
        reason_list(rules).alias("flag_reasons"),
    ).where(F.size("flag_reasons") > 0)


def unusual_senders(fact: DataFrame, frequent: int = K.FREQUENT_PER_DAY) -> DataFrame:
    """Sender-days with many transactions, a burst, or a drained balance."""
    days = fact.groupBy("date_key", F.col("customer_id").alias("entity_id")).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        count_true(F.col("is_fraud")).alias("fraud_count"),
        F.bool_or("flag_burst").alias("has_burst"),
        F.bool_or("flag_balance_drain").alias("has_drain"),
    )
    return _flagged_days(
        days,
        "sender",
        [
            ("HIGH_FREQUENCY", F.col("txn_count") >= frequent),
            ("BURST", F.col("has_burst")),
            ("BALANCE_DRAIN", F.col("has_drain")),
        ],
    )


def unusual_recipients(
    fact: DataFrame,
    dim_type: DataFrame,
    transfers: int = K.HUB_TRANSFERS,
    senders: int = K.HUB_SENDERS,
) -> DataFrame:
    """Recipient-days with many transfers from many senders.

    Rows are first reduced to one per recipient, day and sender, so a hub that receives much of
    the data is spread over its senders before it is counted.
    """
    transfer = dim_type.where(F.col("type_name") == "TRANSFER").select("type_key")
    pairs = (
        fact.join(transfer, "type_key")
        .groupBy("date_key", F.col("counterparty_id").alias("entity_id"), "customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("amount"),
            count_true(F.col("is_fraud")).alias("fraud"),
        )
    )
    days = pairs.groupBy("date_key", "entity_id").agg(
        F.sum("n").alias("txn_count"),
        F.sum("amount").cast("decimal(28,2)").alias("total_amount"),
        F.sum("fraud").alias("fraud_count"),
        F.count("customer_id").alias("distinct_senders"),
    )
    hub = (F.col("txn_count") >= transfers) & (F.col("distinct_senders") >= senders)
    return _flagged_days(days, "recipient", [("HUB_RECIPIENT", hub)])


def unusual_activity(
    fact: DataFrame,
    dim_type: DataFrame,
    frequent: int = K.FREQUENT_PER_DAY,
    transfers: int = K.HUB_TRANSFERS,
    senders: int = K.HUB_SENDERS,
) -> DataFrame:
    """Sender and recipient days that any rule flags."""
    return unusual_senders(fact, frequent).unionByName(
        unusual_recipients(fact, dim_type, transfers, senders)
    )
