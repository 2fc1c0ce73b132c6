"""From raw tables to the common schema: mapping, reasons, split, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditlake import constants as K
from auditlake.functions import (
    content_id,
    derive_status,
    entity_kind,
    null_if_merchant,
    reason_list,
    step_to_ts,
    strict_ts,
)


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def unknown_value(column: str, domain: tuple[str, ...]) -> Column:
    """Present but outside the domain; exact match, so case and spaces count."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*domain)


def feed_rules() -> list[tuple[str, Column]]:
    """Reasons to set a feed row aside. Expects ``parsed_ts`` next to the raw columns."""
    required = ["event_id", "customer_id", "amount", "type", "event_ts", "status"]
    return [
        (K.NULL_REQUIRED_FIELD, any_null(required)),
        (K.NEGATIVE_AMOUNT, F.col("amount") < 0),
        (K.UNKNOWN_TYPE, unknown_value("type", K.TXN_TYPES)),
        (K.BAD_TIMESTAMP, F.col("event_ts").isNotNull() & F.col("parsed_ts").isNull()),
        (K.UNKNOWN_STATUS, unknown_value("status", K.STATUSES)),
    ]


def history_rules() -> list[tuple[str, Column]]:
    return [
        (K.NULL_REQUIRED_FIELD, any_null(["nameOrig", "amount", "type", "step"])),
        (K.NEGATIVE_AMOUNT, F.col("amount") < 0),
        (K.UNKNOWN_TYPE, unknown_value("type", K.TXN_TYPES)),
    ]


def tag_failures(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("failed_checks", reason_list(rules))


def map_feed(raw: DataFrame) -> DataFrame:
    """Feed rows in the common schema; balances of the recipient are not in this feed."""
    tagged = tag_failures(raw.withColumn("parsed_ts", strict_ts(F.col("event_ts"))), feed_rules())
    channel = F.col("channel") if "channel" in raw.columns else F.lit(None).cast("string")
    return tagged.select(
        "event_id",
        F.col("parsed_ts").alias("event_ts"),
        F.to_date("parsed_ts").alias("event_date"),
        F.col("type").alias("txn_type"),
        "amount",
        "customer_id",
        "counterparty_id",
        entity_kind(F.col("counterparty_id")).alias("counterparty_kind"),
        "origin_balance_before",
        "origin_balance_after",
        "status",
        F.lit(K.FEED_STATUS_SOURCE).alias("status_source"),
        "decline_reason",
        (F.col("is_fraud") == 1).alias("is_fraud"),
        (F.col("amount") == 0).alias("is_zero_amount"),
        channel.alias("channel"),
        "source_system",
        F.col("event_ts").alias("event_ts_raw"),
        "failed_checks",
        "_source_file",
        "_ingested_at",
    )


def map_history(
    raw: DataFrame, anchor: str = K.HISTORY_ANCHOR, source: str = K.HISTORY_SOURCE
) -> DataFrame:
    """History rows in the common schema: id, time and status are derived."""
    columns = [f.name for f in StructType.fromDDL(K.HISTORY_DDL)]
    tagged = tag_failures(raw.withColumn("ts", step_to_ts(F.col("step"), anchor)), history_rules())
    recipient = F.col("nameDest")
    status, decline_reason = derive_status(F.col("isFlaggedFraud"))
    return tagged.select(
        content_id([F.col(c) for c in columns]).alias("event_id"),
        F.col("ts").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
        F.col("type").alias("txn_type"),
        "amount",
        F.col("nameOrig").alias("customer_id"),
        recipient.alias("counterparty_id"),
        entity_kind(recipient).alias("counterparty_kind"),
        F.col("oldbalanceOrg").alias("origin_balance_before"),
        F.col("newbalanceOrig").alias("origin_balance_after"),
        null_if_merchant(recipient, F.col("oldbalanceDest")).alias("dest_balance_before"),
        null_if_merchant(recipient, F.col("newbalanceDest")).alias("dest_balance_after"),
        status.alias("status"),
        F.lit(K.HISTORY_STATUS_SOURCE).alias("status_source"),
        decline_reason.alias("decline_reason"),
        (F.col("isFraud") == 1).alias("is_fraud"),
        (F.col("amount") == 0).alias("is_zero_amount"),
        F.lit(source).alias("source_system"),
        "failed_checks",
        "_source_file",
        "_ingested_at",
    )


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the declared columns, in order and type; a column the frame lacks is NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(ddl)
        ]
    )


def unify(frames: list[DataFrame], ddl: str = K.UNIFIED_DDL) -> DataFrame:
    """Several flows into one table, matched by column name. Works on streams too."""
    return reduce(DataFrame.unionByName, [conform(frame, ddl) for frame in frames])


def split_valid(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("failed_checks") == 0)


RAW_RECORD = (
    "event_id",
    "event_ts_raw",
    "txn_type",
    "amount",
    "customer_id",
    "counterparty_id",
    "origin_balance_before",
    "origin_balance_after",
    "status",
    "decline_reason",
    "is_fraud",
    "channel",
)


def quarantine(tagged: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows with a reason, their original values kept as JSON with the NULLs written out."""
    return tagged.where(F.size("failed_checks") > 0).select(
        "event_id",
        "failed_checks",
        "source_system",
        "_source_file",
        "_ingested_at",
        (F.current_timestamp() if at is None else at).alias("quarantined_at"),
        F.to_json(F.struct(*RAW_RECORD), {"ignoreNullFields": "false"}).alias("raw_record"),
    )


def profile_events(raw: DataFrame) -> DataFrame:
    """Typed change events without the rescue and modified-time columns."""
    return raw.select(
        "customer_id",
        "entity_type",
        "segment",
        "region",
        "changed_at",
        "_source_file",
        "_ingested_at",
    )
