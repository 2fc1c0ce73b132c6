"""Structured Streaming runs: read what is new, then stop.

Sinks that need more than an append write one folder per micro-batch. A batch that is retried
overwrites its own folder, so a lost run never duplicates rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructType, TimestampType

from auditlake.operators import shape
from auditlake.operators.cdc import scd1, scd2
from auditlake.operators.keyed import join_null_safe
from auditlake.sources.files import RESCUE, UNLISTED, parse_json_lines, read_lines, unlisted_names, with_unlisted

BATCH = "batch_id"
BUCKET = "key_bucket"


def run_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that is new to a parquet folder and stop. Files are read exactly once."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every new micro-batch to a function and stop."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields]).add(BATCH, IntegerType()))
    return reader.parquet(path)


def scd1_stream(
    changes: DataFrame, keys: list[str], sequence: str, target: str, checkpoint: str,
    tie_break: list[str] | None = None,
) -> None:
    """Keyed upsert without a rewrite of the target: each micro-batch adds its winners only.

    ``scd1_current`` resolves them, so a run costs what arrived, not what has been stored, and no
    state grows with the number of keys. ``scd1_compact`` folds what has been stored.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(scd1(batch, keys, sequence, tie_break=tie_break), target, batch_id)

    run_batches(changes, handle, checkpoint)


def scd1_current(
    spark: SparkSession, target: str, schema: StructType, keys: list[str], sequence: str,
    except_cols: list[str] = (), tie_break: list[str] | None = None,
) -> DataFrame:
    """Current row per key over all micro-batches."""
    stored = read_batches(spark, target, schema).drop(BATCH)
    return scd1(stored, keys, sequence, except_cols, tie_break)


def scd1_compact(
    spark: SparkSession, target: str, compacted: str, schema: StructType, keys: list[str], sequence: str,
    tie_break: list[str] | None = None,
) -> str:
    """Write the winners of all stored micro-batches as batch -1 of a new target, and return it.

    Run it between two runs of the stream; the next run, with the same checkpoint, goes on in the
    new target. The old one stays until its owner removes it.
    """
    winners = scd1_current(spark, target, schema, keys, sequence, tie_break=tie_break)
    write_batch(winners, compacted, -1)
    return compacted


def scd2_stream(
    changes: DataFrame, keys: list[str], sequence: str, track: list[str], target: str, checkpoint: str,
    tie_break: list[str] | None = None, buckets: int = 64,
) -> None:
    """Version history from a stream, with events in any order. A NULL key is a key.

    A micro-batch adds its events to the log, which is stored by key bucket; nothing stored is read.
    ``scd2_current`` cuts the versions from the log. Give ``buckets`` the number of buckets that
    keeps one in reach of a task; ``scd2_compact`` folds the log bucket by bucket.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Rebalanced rather than repartitioned: a bucket with a hot key is split over several files.
        arrived = batch.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", BUCKET)
        path = f"{target}/{BATCH}={batch_id}"
        arrived.write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    run_batches(changes, handle, checkpoint)


def _bucket(keys: list[str], buckets: int):
    # A NULL leaves a hash as it is, so NULLs are hashed too.
    return F.pmod(F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), F.lit(buckets)).cast("int")


def scd2_log(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All stored events, with their batch and bucket."""
    return read_batches(spark, target, StructType([*schema.fields]).add(BUCKET, IntegerType()))


def scd2_current(
    spark: SparkSession, target: str, schema: StructType, keys: list[str], sequence: str, track: list[str],
    except_cols: list[str] = (), tie_break: list[str] | None = None,
) -> DataFrame:
    """The version history of every key. A filter on the bucket column prunes the log."""
    log = scd2_log(spark, target, schema).drop(BATCH, BUCKET)
    return scd2(log, keys, sequence, track, except_cols, tie_break)


def scd2_touched(
    spark: SparkSession, target: str, schema: StructType, keys: list[str], sequence: str, track: list[str],
    since: int, except_cols: list[str] = (), tie_break: list[str] | None = None,
) -> DataFrame:
    """The history of the keys with events in micro-batch ``since`` or later, cut from their whole log."""
    log = scd2_log(spark, target, schema)
    touched = log.where(F.col(BATCH) >= since).select(*keys).distinct()
    mine = join_null_safe(log, touched, keys, "left_semi").drop(BATCH, BUCKET)
    return scd2(mine, keys, sequence, track, except_cols, tie_break)


def scd2_compact(
    spark: SparkSession, target: str, compacted: str, schema: StructType, keys: list[str], sequence: str,
    tie_break: list[str] | None = None, buckets: int = 64,
) -> str:
    """Write the log as batch -1 of a new target, one event per key and time, and return it.

    Later events may split any version, so the log keeps every moment; repeated deliveries and
    overruled events of one moment go. See ``scd1_compact`` for how a stream goes on.
    """
    log = scd2_log(spark, target, schema).drop(BATCH, BUCKET)
    moments = scd1(log, [*keys, sequence], sequence, tie_break=tie_break)
    folded = moments.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", BUCKET)
    folded.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{compacted}/{BATCH}=-1")
    return compacted


def split_stream(tagged: DataFrame, clean: str, rejected: str, checkpoint: str, at=None) -> None:
    """One stream into two sinks: rows without a reason, and the quarantine."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Read twice rather than kept: the second pass derives the other columns of the few rejected rows only.
        write_batch(shape.split_valid(batch).drop("failed_checks"), clean, batch_id)
        write_batch(shape.quarantine(batch, at), rejected, batch_id)

    run_batches(tagged, handle, checkpoint)


def ingest_evolving(
    spark: SparkSession, path: str, hints: str, target: str, checkpoint: str,
    glob: str = "*.jsonl", max_files: int | None = None, **options: str,
) -> None:
    """JSON lines with schema hints into a table that takes new fields as they appear.

    Unlisted fields are one column of the table, so a new one changes no schema, never stops the stream, and
    a micro-batch is one pass over its lines: it is parsed once and appended.
    """
    lines = read_lines(spark, path, glob, streaming=True, max_files=max_files, **options)
    run_available(parse_json_lines(lines, hints), target, checkpoint)


def evolved_columns(spark: SparkSession, target: str, hints: str) -> list[str]:
    """Fields beyond the hints that the table holds now, for a reader that wants them all."""
    return sorted(r["name"] for r in unlisted_names(read_evolved(spark, target, hints)).collect())


def read_evolved(spark: SparkSession, target: str, hints: str, names: list[str] = ()) -> DataFrame:
    """The evolving table; the unlisted fields named become columns, rows without them show NULL."""
    fields = StructType.fromDDL(hints)
    fields = fields.add(UNLISTED, MapType(StringType(), StringType())).add(RESCUE, StringType()).add("_source_file", StringType())
    fields = fields.add("_source_modified_at", TimestampType()).add("_ingested_at", TimestampType())
    return with_unlisted(spark.read.schema(fields).parquet(target), list(names))


def rebuild(spark: SparkSession, root: str, layers: dict[str, Callable[[dict[str, str], str, str], None]]) -> dict[str, str]:
    """Derive every layer again from its sources, with fresh checkpoints, and return their folders.

    ``layers`` maps a name to a function of (folders of the layers before it, target, checkpoint), in
    order. Each rebuild has a folder of its own; readers of the old one are not disturbed.
    """
    base = f"{root.rstrip('/')}/rebuild-{uuid.uuid4().hex}"
    folders: dict[str, str] = {}
    for name, derive in layers.items():
        target = f"{base}/{name}"
        derive(dict(folders), target, f"{base}/_checkpoints/{name}")
        folders[name] = target
    return folders
