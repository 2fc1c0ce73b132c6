"""Upserts and version history that are kept resolved: reading them costs no merge.

``runs.scd1_stream`` and ``runs.scd2_stream`` only append, and readers resolve what has been stored. Here a
micro-batch resolves the keys it brings, in the files that can hold them (see ``sources.ranged``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampType

from auditlake.operators.cdc import scd1, scd2
from auditlake.session import stage
from auditlake.sources import ranged
from auditlake.streaming.runs import run_batches

IS_VERSION = "_is_version"


def scd1_maintained(
    changes: DataFrame, keys: list[str], sequence: str, target: str, checkpoint: str,
    tie_break: list[str] | None = None, rows_per_file: int = ranged.ROWS_PER_FILE,
) -> None:
    """Keyed upsert: after every micro-batch the table holds one row per key, the highest sequence."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, target, keys, sequence, tie_break, rows_per_file)

    run_batches(changes, handle, checkpoint)


def upsert(
    batch: DataFrame, batch_id: int, target: str, keys: list[str], sequence: str,
    tie_break: list[str] | None = None, rows_per_file: int = ranged.ROWS_PER_FILE,
) -> None:
    """One batch of ``scd1_maintained``."""
    # The slot follows from the key, so it may stand beside it; the tie-break must not see it.
    ties = tie_break if tie_break is not None else [c for c in sorted(batch.columns) if c not in (*keys, sequence)]

    def merge(rows: DataFrame, by: list[str]) -> DataFrame:
        return scd1(rows, by, sequence, tie_break=ties)

    winners = scd1(batch, keys, sequence, tie_break=ties)
    ranged.keep_up(winners, batch_id, target, keys, merge, batch.schema, rows_per_file=rows_per_file)


def scd1_maintained_current(spark: SparkSession, target: str, schema: StructType, except_cols: list[str] = ()) -> DataFrame:
    return ranged.read(spark, target, schema).drop(*except_cols)


def _history_schema(schema: StructType) -> StructType:
    times = [StructField(name, TimestampType()) for name in ("start_at", "end_at")]
    return StructType([*schema.fields, *times, StructField(IS_VERSION, BooleanType())])


def scd2_maintained(
    changes: DataFrame, keys: list[str], sequence: str, track: list[str], target: str, checkpoint: str,
    tie_break: list[str] | None = None, rows_per_file: int = ranged.ROWS_PER_FILE,
) -> None:
    """Version history: a micro-batch, in any order, cuts the versions of its own keys again."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        recut(batch, batch_id, target, keys, sequence, track, tie_break, rows_per_file)

    run_batches(changes, handle, checkpoint)


def recut(
    batch: DataFrame, batch_id: int, target: str, keys: list[str], sequence: str, track: list[str],
    tie_break: list[str] | None = None, rows_per_file: int = ranged.ROWS_PER_FILE,
) -> None:
    """One batch of ``scd2_maintained``.

    The table holds two kinds of rows side by side: moments (one event per key and time, since a late event may
    split any version) and the versions cut from them. Events without a time are left out, as in ``scd2``.
    """
    events = batch.columns
    ties = tie_break if tie_break is not None else [c for c in sorted(events) if c not in (*keys, sequence)]

    def merge(rows: DataFrame, by: list[str]) -> DataFrame:
        moments = scd1(rows.where(~F.col(IS_VERSION)).drop("start_at", "end_at", IS_VERSION), [*by, sequence], sequence, tie_break=ties)
        moments = stage(moments, "moments")  # read three times
        versions = scd2(moments, by, sequence, track, tie_break=ties).withColumn(IS_VERSION, F.lit(True))
        return versions.unionByName(moments.withColumn(IS_VERSION, F.lit(False)), allowMissingColumns=True)

    schema = _history_schema(batch.schema)
    arrived = scd1(batch.where(F.col(sequence).isNotNull()), [*keys, sequence], sequence, tie_break=ties)
    none = F.lit(None).cast("timestamp")
    arrived = arrived.withColumns({"start_at": none, "end_at": none, IS_VERSION: F.lit(False)})
    ranged.keep_up(arrived, batch_id, target, keys, merge, schema, (IS_VERSION, sequence), rows_per_file)


def scd2_maintained_current(
    spark: SparkSession, target: str, schema: StructType, sequence: str, except_cols: list[str] = ()
) -> DataFrame:
    """The versions as they stand: a filter, without a shuffle."""
    stored = ranged.read(spark, target, _history_schema(schema))
    return stored.where(IS_VERSION).drop(sequence, IS_VERSION, *except_cols)
