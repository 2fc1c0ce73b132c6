"""Control totals that hold the star schema against the raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.functions import count_true
from auditlake.operators.joins import orphan_count
from auditlake.operators.keyed import first_by, repeated, with_repeated
from auditlake.operators.rules import expectations

# What the control totals read.
TABLES = (
    "feed", "history", "profile_events", "transactions", "quarantine", "fact", "dim_customer", "dim_date", "dim_type", "kpi_daily"
)


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Put one-row frames with different columns side by side, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def zero_sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def feed_totals(feed: DataFrame) -> DataFrame:
    """Distinct raw events and their amount, each event once; NULL ids are counted apart."""
    per_event = feed.groupBy("event_id").agg(F.max("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    return per_event.agg(
        F.count("event_id").alias("bronze_generated_events"),
        zero_sum(F.col("amount")).alias("bronze_generated_amount"),
        zero_sum(F.when(F.col("event_id").isNull(), F.col("n"))).alias("bronze_null_id_rows"),
    )


def quarantine_totals(quarantined: DataFrame) -> DataFrame:
    """Distinct quarantined events and the amount each had when first set aside."""
    first = first_by(quarantined, ["event_id"], ["quarantined_at", "_ingested_at", "raw_record"])
    amount = F.from_json("raw_record", "amount DECIMAL(18,2)")["amount"]  # exact to the cent
    return first.agg(
        F.count("event_id").alias("quarantined_events"),
        zero_sum(amount).alias("quarantined_amount"),
    )


def fact_totals(fact: DataFrame, feed_source: str, history_source: str) -> DataFrame:
    """Everything the fact alone can tell. Only rows whose event id comes again are shuffled to count the ids."""
    feed = F.col("source_system") == feed_source
    history = F.col("source_system") == history_source
    unknown = (F.col("origin_customer_key") == K.UNKNOWN_KEY) | (
        F.col("counterparty_key") == K.UNKNOWN_KEY
    )
    amount = F.col("amount")
    money = lambda value: zero_sum(value).cast("decimal(38,2)")
    totals = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count("event_id").alias("_ids"),
        money(amount).alias("fact_value_total"),
        count_true(history).alias("history_rows_gold"),
        money(F.when(history, amount)).alias("history_amount_gold"),
        count_true(history & F.col("is_fraud")).alias("history_fraud_gold"),
        count_true(feed).alias("gold_generated_rows"),
        money(F.when(feed, amount)).alias("gold_generated_amount"),
        count_true(feed & unknown).alias("generated_unknown_customer_rows"),
    )
    again = repeated(fact, ["event_id"])
    more = fact if again is None else with_repeated(fact, ["event_id"], again, "left_semi")
    per_id = more.groupBy("event_id").agg(F.count("event_id").alias("n"))
    excess = per_id.agg((zero_sum(F.col("n")) - F.count("event_id")).alias("_excess"))
    counted = one_row([totals, excess])
    distinct = (F.col("_ids") - F.col("_excess")).alias("fact_distinct_events")
    return counted.select("fact_rows", distinct, *[c for c in counted.columns if c not in ("fact_rows", "_ids", "_excess")])


def control_totals(
    tables: dict[str, DataFrame],
    feed_source: str = K.FEED_SOURCE,
    history_source: str = K.HISTORY_SOURCE,
) -> DataFrame:
    """One row of totals. Each table is aggregated once; only one-row frames are combined.

    ``tables``: feed, history, profile_events, transactions, quarantine, fact, dim_customer,
    dim_date, dim_type, kpi_daily.
    """
    fact, dim = tables["fact"], tables["dim_customer"]
    known = F.col("customer_key") != K.UNKNOWN_KEY
    history = tables["history"].agg(
        F.count(F.lit(1)).alias("history_rows_bronze"),
        zero_sum(F.col("amount")).alias("history_amount_bronze"),
        zero_sum(F.col("isFraud")).alias("history_fraud_bronze"),
    )
    per_customer = dim.where(known).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("versions"), count_true(F.col("is_current")).alias("current")
    )
    versions = per_customer.agg(
        zero_sum(F.col("current")).alias("current_versions"),
        F.count("customer_id").alias("distinct_customers"),
        zero_sum(F.col("versions")).alias("dim_versions"),
    )
    kpi = tables["kpi_daily"].agg(
        zero_sum(F.col("txn_count")).alias("kpi_txn_total"),
        zero_sum(F.col("txn_value")).alias("kpi_value_total"),
    )
    return one_row(
        [
            fact_totals(fact, feed_source, history_source),
            history,
            feed_totals(tables["feed"]),
            quarantine_totals(tables["quarantine"]),
            tables["transactions"].agg(F.count(F.lit(1)).alias("silver_rows")),
            orphan_count(fact, tables["dim_date"], "date_key", "date_key", "orphan_date_keys"),
            orphan_count(fact, tables["dim_type"], "type_key", "type_key", "orphan_type_keys"),
            orphan_count(fact, dim, "origin_customer_key", "customer_key", "orphan_origin_keys"),
            orphan_count(fact, dim, "counterparty_key", "customer_key", "orphan_counterparty_keys"),
            kpi,
            versions,
            tables["profile_events"].agg(F.count(F.lit(1)).alias("profile_events")),
        ]
    )


def constraint_results(totals: DataFrame, history: str = K.HISTORY_SOURCE) -> DataFrame:
    """One row per constraint: name, action, whether it holds."""
    rules = expectations("gold.reconciliation", history=history)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("constraint"),
                    F.lit(rule.action).alias("action"),
                    rule.holds.alias("passed"),
                )
                for rule in rules
            ]
        )
    )
    return totals.select(rows.alias("r")).select("r.*")


def reconcile(tables: dict[str, DataFrame], **sources: str) -> tuple[DataFrame, DataFrame]:
    """The control totals and the constraints over them."""
    totals = control_totals(tables, **sources)
    return totals, constraint_results(totals)
