"""Row expectations with actions, their metrics, check history, scorecards, fingerprints."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.functions import feed_date
from auditlake.operators.joins import latest_snapshot

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    """A named predicate that must be true for each row. False and NULL are violations."""

    name: str
    condition: str
    action: str = WARN

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationFailed(RuntimeError):
    """A rule with the FAIL action was violated; nothing has been published."""

    def __init__(self, dataset: str, violations: dict[str, int]):
        self.dataset, self.violations = dataset, violations
        listed = ", ".join(f"{name} ({rows} rows)" for name, rows in violations.items())
        super().__init__(f"{dataset}: violated expectations: {listed}")


def _failed_counts(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(~rule.holds).alias(f"failed_{i}") for i, rule in enumerate(rules)]


def expectation_metrics(
    df: DataFrame, rules: Sequence[Expectation], dataset: str, update_id: str
) -> DataFrame:
    """Passed and failed records per rule, all rules in one aggregation."""
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *_failed_counts(rules))
    per_rule = F.explode(
        F.array(
            *[
                F.struct(F.lit(rule.name).alias("name"), F.col(f"failed_{i}").alias("failed"))
                for i, rule in enumerate(rules)
            ]
        )
    )
    return totals.select("rows", per_rule.alias("r")).select(
        F.lit(update_id).alias("update_id"),
        F.lit(dataset).alias("dataset"),
        F.col("r.name").alias("expectation"),
        (F.col("rows") - F.col("r.failed")).alias("passed_records"),
        F.col("r.failed").alias("failed_records"),
    )


def drop_violations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows that satisfy every rule whose action is DROP."""
    for rule in rules:
        if rule.action == DROP:
            df = df.where(rule.holds)
    return df


def enforce(metrics: DataFrame, rules: Sequence[Expectation], dataset: str) -> None:
    """Raise when a FAIL rule has violations."""
    hard = [rule.name for rule in rules if rule.action == FAIL]
    rows = metrics.where(F.col("expectation").isin(hard) & (F.col("failed_records") > 0)).collect()
    if rows:
        raise ExpectationFailed(dataset, {r["expectation"]: r["failed_records"] for r in rows})


def expect(
    df: DataFrame, rules: Sequence[Expectation], dataset: str, update_id: str
) -> tuple[DataFrame, DataFrame]:
    """Check a frame and return (rows to publish, metrics); raises on a FAIL violation."""
    metrics = expectation_metrics(df, rules, dataset, update_id)
    enforce(metrics, rules, dataset)
    return drop_violations(df, rules), metrics


METRIC_DDL = "update_id STRING, dataset STRING, expectation STRING, passed_records BIGINT, failed_records BIGINT"


def counted_write(df: DataFrame, rules: Sequence[Expectation], dataset: str, update_id: str, path: str) -> list[tuple]:
    """Write the rows that no DROP rule refuses and count all rules in the same pass; one tuple per rule."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_failed_counts(rules))
    drop_violations(observed, rules).write.mode("overwrite").parquet(path)
    counts = seen.get
    return [
        (update_id, dataset, r.name, counts["rows"] - counts[f"failed_{i}"], counts[f"failed_{i}"])
        for i, r in enumerate(rules)
    ]


def refuse_broken(rules: Sequence[Expectation], dataset: str, metrics: list[tuple]) -> None:
    """Raise if a FAIL rule has violations."""
    broken = {r.name: n[4] for r, n in zip(rules, metrics) if r.action == FAIL and n[4]}
    if broken:
        raise ExpectationFailed(dataset, broken)


def audited_write(
    df: DataFrame, rules: Sequence[Expectation], dataset: str, update_id: str, staging: str, target: str
) -> DataFrame:
    """Write, audit, publish. The rules are counted while the rows are written to a folder of the update
    under ``staging``, in the same pass. Unless a FAIL rule was violated, one row in the pointer table
    ``target`` then names that folder, so nothing is written twice and a failure leaves the old version
    in place. ``read_audited`` reads what was published last. Returns the metrics."""
    spark = df.sparkSession
    version = f"{staging.rstrip('/')}/{dataset}-{update_id}-{uuid.uuid4().hex}"
    metrics = counted_write(df, rules, dataset, update_id, version)
    refuse_broken(rules, dataset, metrics)
    pointer = spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(update_id).alias("update_id"), F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
    )
    pointer.coalesce(1).write.mode("append").parquet(target)
    return spark.createDataFrame(metrics, METRIC_DDL)


def read_audited(spark, target: str, dataset: str) -> DataFrame:
    """The rows of a dataset as published last."""
    published = spark.read.parquet(target).where(F.col("dataset") == dataset)
    newest = published.orderBy(F.desc("published_at"), F.desc("update_id")).first()
    if newest is None:
        raise LookupError(f"{dataset} has not been published")
    return spark.read.parquet(newest["version"])


def latest_expectations(metrics: DataFrame, at: str = "update_at") -> DataFrame:
    """Metrics of the newest update, summed over its flows."""
    return (
        latest_snapshot(metrics, at)
        .groupBy("update_id", "dataset", "expectation")
        .agg(
            F.sum("passed_records").alias("passed_records"),
            F.sum("failed_records").alias("failed_records"),
        )
    )


def plain_text(value: Column) -> Column:
    """Number as text; whole decimals lose their fraction part."""
    text = value.cast("string")
    return F.regexp_replace(text, r"\.0+$", "")


def result_rows(checks: DataFrame, run_at: Column, run_id: str | None) -> DataFrame:
    """Check rows as history rows, all stamped with the same run."""
    return checks.select(
        run_at.cast("timestamp").alias("run_at"),
        F.lit(run_id).cast("string").alias("run_id"),
        "suite",
        "check_name",
        plain_text(F.col("expected")).alias("expected"),
        plain_text(F.col("actual")).alias("actual"),
        "passed",
    )


# The scorecards, for frames here and for the views of the history tables alike.
_TALLY = "count(*) AS checks, count_if(passed) AS passed, count_if(NOT passed) AS failed"
_NEWEST = "run_at = (SELECT max(run_at) FROM {results})"
CHECK_SCORECARD = f"SELECT suite, run_at, {_TALLY} FROM {{results}} WHERE {_NEWEST} GROUP BY suite, run_at"
CHECK_HISTORY = f"SELECT run_at, {_TALLY} FROM {{results}} GROUP BY run_at"
EXPECTATION_SCORECARD = (
    "SELECT dataset, expectation, passed_records, failed_records, run_at, "
    f"try_divide(failed_records, passed_records + failed_records) AS failure_rate FROM {{results}} WHERE {_NEWEST}"
)


def check_scorecard(results: DataFrame) -> DataFrame:
    """The newest run, one row per suite."""
    return results.sparkSession.sql(CHECK_SCORECARD, results=results)


def check_history(results: DataFrame) -> DataFrame:
    """One row per run."""
    return results.sparkSession.sql(CHECK_HISTORY, results=results)


def expectation_scorecard(results: DataFrame) -> DataFrame:
    """The newest expectation results with the share of failed rows, NULL when nothing ran."""
    return results.sparkSession.sql(EXPECTATION_SCORECARD, results=results)


def fingerprint(df: DataFrame, cols: Sequence[str], method: str = "xxhash64") -> DataFrame:
    """Row count and a hash that depends on the rows' content but not on their order.

    NULLs are told apart from every value. ``sha256`` gives a value any engine can recompute.
    """
    if method == "xxhash64":
        mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
        row_hash = F.xxhash64(*cols, mask)
    else:
        text = F.concat_ws(
            "|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
        )
        row_hash = F.conv(F.left(F.sha2(text, 256), F.lit(15)), 16, 10)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_hash.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("content_hash"),
    )


def quarantine_summary(quarantined: DataFrame, prefix: str = "transactions_") -> DataFrame:
    """Quarantined rows per reason and feed day, with the fraud hidden among them."""
    fraud = F.get_json_object("raw_record", "$.is_fraud") == "true"
    reasons = quarantined.select(
        F.explode("failed_checks").alias("reason"),
        feed_date(F.col("_source_file"), prefix).alias("feed_date"),
        fraud.alias("hidden_fraud"),
    )
    return reasons.groupBy("reason", "feed_date").agg(
        F.count(F.lit(1)).alias("quarantined_rows"),
        F.count_if("hidden_fraud").alias("hidden_fraud_rows"),
    )


def measure_defects(feed: DataFrame, rules: dict[str, Column], prefix: str = "transactions_") -> DataFrame:
    """Rows, distinct events and defect classes per feed day, to hold against the manifests.

    Distinct ids are counted through one row per (day, id), so no task holds a day's ids.
    """
    per_event = feed.groupBy(
        feed_date(F.col("_source_file"), prefix).alias("feed_date"), "event_id"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(cond).alias(name) for name, cond in rules.items()],
    )
    return per_event.groupBy("feed_date").agg(
        F.sum("n").alias("bronze_rows"),
        F.count("event_id").alias("distinct_events"),
        *[F.sum(name).alias(name) for name in rules],
    )


def defect_rules() -> dict[str, Column]:
    """Defect classes of the feed, by the same strict parsing the split uses."""
    from auditlake.functions import strict_ts
    from auditlake.operators.shape import any_null, unknown_value

    return {
        "null_field": any_null(["event_id", "customer_id", "amount", "type", "event_ts", "status"]),
        "bad_amount": F.col("amount") < 0,
        "unknown_type": unknown_value("type", K.TXN_TYPES),
        "bad_timestamp": F.col("event_ts").isNotNull() & strict_ts(F.col("event_ts")).isNull(),
    }
