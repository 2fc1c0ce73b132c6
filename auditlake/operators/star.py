"""Star schema: calendar dimension and the transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.functions import (
    amount_band,
    band_sort,
    day_part,
    rule_balance_drain,
    rule_night_high_value,
    rule_source,
)
from auditlake.operators.joins import lookup, pit_join
from auditlake.operators.keyed import crowded_points, if_few

REGIONS = {"eaw": "england-and-wales", "scotland": "scotland", "ni": "northern-ireland"}


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def calendar_attributes(days: DataFrame) -> DataFrame:
    """Derived columns of ``calendar_date``; Saturday and Sunday are the weekend."""
    day = F.col("calendar_date")
    return days.withColumns(
        {
            "date_key": date_key(day),
            "calendar_year": F.year(day),
            "calendar_month": F.month(day),
            "month_name": F.date_format(day, "MMMM"),
            "day_of_month": F.day(day),
            "day_name": F.date_format(day, "EEEE"),
            "iso_week": F.weekofyear(day),
            "is_weekend": F.dayofweek(day).isin(1, 7),
        }
    )


def pivot_regions(holidays: DataFrame, regions: dict[str, str] = REGIONS) -> DataFrame:
    """One row per holiday date with one name column per region."""
    return holidays.groupBy("holiday_date").agg(
        *[
            F.max(F.when(F.col("division") == division, F.col("title"))).alias(f"{short}_name")
            for short, division in regions.items()
        ]
    )


def dim_date(
    days: DataFrame, holidays: DataFrame, regions: dict[str, str] = REGIONS, headline: str = "eaw"
) -> DataFrame:
    """Calendar with holiday flags per region; the headline region also gives the name."""
    names = pivot_regions(holidays, regions)
    joined = calendar_attributes(days).join(
        names, F.col("calendar_date") == F.col("holiday_date"), "left"
    )
    return joined.select(
        "date_key",
        "calendar_date",
        F.col(f"{headline}_name").alias(f"bank_holiday_name_{headline}"),
        "calendar_year",
        "calendar_month",
        "month_name",
        "day_of_month",
        "day_name",
        "iso_week",
        "is_weekend",
        *[
            F.col(f"{short}_name").isNotNull().alias(f"is_bank_holiday_{short}")
            for short in regions
        ],
    )


def burst_flag(
    tx: DataFrame,
    minutes: int = K.BURST_MINUTES,
    threshold: int = K.BURST_COUNT,
    staged: bool = False,
) -> DataFrame:
    """Add ``flag_burst``: a transfer with enough transfers of its customer close in time.

    The crowded moments are found first from the transfers alone, and they are few. ``staged``
    finds them right away and writes them to the scratch folder; the wide rows are then joined to
    them without a shuffle unless they are too many for a broadcast.
    """
    crowded = crowded_points(
        tx, "customer_id", "event_ts", F.col("txn_type") == "TRANSFER",
        minutes * 60, minutes * 60, threshold,
    ).select(F.col("customer_id").alias("_c_id"), F.col("event_ts").alias("_c_ts"))
    if staged:
        few = if_few(crowded, "crowded")
        crowded = crowded if few is None else few
    match = (F.col("customer_id") == F.col("_c_id")) & (F.col("event_ts") == F.col("_c_ts"))
    flag = (F.col("txn_type") == "TRANSFER") & F.col("_c_id").isNotNull()
    return tx.join(crowded, match, "left").withColumn("flag_burst", flag).drop("_c_id", "_c_ts")


def fact_transactions(
    tx: DataFrame,
    dim_type: DataFrame,
    dim_customer: DataFrame | None = None,
    burst_minutes: int = K.BURST_MINUTES,
    burst_count: int = K.BURST_COUNT,
    night_amount: float = K.NIGHT_AMOUNT,
    staged: bool = False,
) -> DataFrame:
    """One row per transaction with keys, bands and rule flags.

    ``dim_customer`` adds the two customer keys (version valid at event time, -1 when unknown);
    leave it out where no customer key is read. ``staged`` gathers crowded moments and known customers
    first, so that the wide rows need no shuffle for them.
    """
    hour = F.hour("event_ts")
    sort = band_sort(F.col("amount"))
    flagged = burst_flag(tx, burst_minutes, burst_count, staged)
    keyed = lookup(flagged, dim_type, "txn_type", "type_name", ["type_key"])
    fact = keyed.select(
        "event_id",
        "event_ts",
        date_key(F.col("event_ts")).alias("date_key"),
        hour.alias("hour_of_day"),
        "type_key",
        "customer_id",
        "counterparty_id",
        "amount",
        sort.alias("amount_band_sort"),
        "origin_balance_before",
        "origin_balance_after",
        "status",
        "status_source",
        "decline_reason",
        "is_fraud",
        "is_zero_amount",
        "channel",
        "source_system",
        day_part(hour).alias("day_part"),
        amount_band(sort).alias("amount_band"),
        (F.col("status") == "DECLINED").alias("is_declined"),
        rule_balance_drain(
            F.col("txn_type"), F.col("amount"), F.col("origin_balance_before")
        ).alias("flag_balance_drain"),
        rule_night_high_value(F.col("txn_type"), hour, F.col("amount"), night_amount).alias(
            "flag_night_high_value"
        ),
        "flag_burst",
        rule_source(F.col("status_source"), F.col("status")).alias("flag_source_rule"),
    )
    if dim_customer is None:
        return fact
    sent = pit_join(fact, dim_customer, "customer_id", "event_ts", "origin_customer_key", few_known=staged)
    return pit_join(sent, dim_customer, "counterparty_id", "event_ts", "counterparty_key", few_known=staged)
