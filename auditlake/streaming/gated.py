"""Expectations on a stream: every micro-batch is counted, filtered and let through, or stops the stream.

A table is a folder: ``rows`` holds a folder per attempt of a batch, ``metrics`` the counts of each batch,
``published`` one row per batch that was let through, naming its rows. The row is written last. A batch that
breaks a FAIL rule raises before that, so the stream stops, its checkpoint stays where it was, and nothing
of the batch is visible; when the cause is mended the next run takes the same batch again. A retried batch
overwrites its own metrics and pointer, so counts and rows land once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditlake.operators.quality import METRIC_DDL, Expectation, counted_write, refuse_broken
from auditlake.streaming.runs import BATCH, run_batches


def expect_stream(changes: DataFrame, rules: Sequence[Expectation], dataset: str, target: str, checkpoint: str) -> None:
    """Take what is new through the rules and stop; raises if a FAIL rule is broken."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = f"{target}/rows/{batch_id}-{uuid.uuid4().hex}"
        metrics = counted_write(batch, rules, dataset, str(batch_id), version)
        # Counted before the verdict, so that a batch that stops the stream tells why.
        spark.createDataFrame(metrics, METRIC_DDL).coalesce(1).write.mode("overwrite").parquet(f"{target}/metrics/{BATCH}={batch_id}")
        refuse_broken(rules, dataset, metrics)
        pointer = spark.range(1).select(F.lit(version).alias("version"))
        pointer.write.mode("overwrite").parquet(f"{target}/published/{BATCH}={batch_id}")

    run_batches(changes, handle, checkpoint)


def batch_metrics(spark: SparkSession, target: str) -> DataFrame:
    """Counts per rule and batch; ``published`` tells whether the batch was let through."""
    counted = spark.read.schema(f"{METRIC_DDL}, {BATCH} INT").parquet(f"{target}/metrics")
    let = _published(spark, target).select(BATCH, F.lit(True).alias("_let"))
    return counted.join(let, BATCH, "left").withColumn("published", F.col("_let").isNotNull()).drop("_let")


def _published(spark: SparkSession, target: str) -> DataFrame:
    schema = f"version STRING, {BATCH} INT"
    try:
        return spark.read.schema(schema).parquet(f"{target}/published")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def read_published(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows of all batches that were let through."""
    versions = [r["version"] for r in _published(spark, target).collect()]  # one per batch
    return spark.read.schema(schema).parquet(*versions) if versions else spark.createDataFrame([], schema)
