"""Tables that are kept up by key: files know their key range, a batch rewrites only those it can change.

A table is a folder. ``data`` holds files of rows, ``files`` one listing per batch (each file with its least
and greatest key and its rows), ``state`` one row per batch: the listing it left and what it cost. The newest
row of ``state`` is the table. Nothing that is listed is ever changed, so readers keep what they have begun
to read and a batch that is retried starts from the state before it and leaves the same rows.

Files whose ranges touch form a slot; slots are in key order and apart. A key belongs to the last slot that
starts at or before it. A batch rewrites the slots one of whose ranges holds a key of the batch; keys between
slots become new files. One stream writes a table, with growing batch numbers.

Batches whose keys lie close together touch few files; one with keys all over touches all of them and costs
a rewrite, so such a stream should come in few large batches. A key with very many rows spreads over several
files of one slot, which are rewritten together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from auditlake.operators.keyed import SLICE, join_null_safe, last_known
from auditlake.session import stage

SLOT = "_slot"
ROWS_PER_FILE = 5_000_000
FIGURES = ("files_stored", "files_rewritten", "files_now", "rows_arrived", "rows_read", "rows_written", "rows_now")
STATE_DDL = "files STRING, " + ", ".join(f"{f} BIGINT" for f in FIGURES) + ", batch_id BIGINT"
Merge = Callable[[DataFrame, list[str]], DataFrame]


def states(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per batch: its listing, files and rows before and after, and what the batch read and wrote."""
    try:
        return spark.read.schema(STATE_DDL).parquet(f"{root}/state")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def state(spark: SparkSession, root: str, before: int | None = None) -> Row | None:
    """The newest state, or the newest one of the batches before a given one."""
    known = states(spark, root)
    if known is None:
        return None
    if before is not None:
        known = known.where(F.col("batch_id") < before)
    return known.orderBy(F.desc("batch_id")).first()


def listing(spark: SparkSession, at: Row, keys: list[str], schema: StructType) -> DataFrame:
    """The files of a state: path, least and greatest key, rows, slot."""
    key = StructType([schema[k] for k in keys])
    fields = StructType().add("file", "string").add("low", key).add("high", key).add("row_count", "long").add(SLOT, "long")
    return spark.read.schema(fields).parquet(at["files"])


def read(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as of its newest state."""
    newest = state(spark, root)
    if newest is None:
        return spark.createDataFrame([], schema)
    listed = spark.read.schema("file STRING").parquet(newest["files"]).collect()  # as many as Spark lists itself
    return spark.read.schema(schema).parquet(*[r["file"] for r in listed])


def _placed(points: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys with the slot of each and whether one of its ranges holds it."""
    slots = files.groupBy(SLOT).agg(F.min("low").alias("_k"), F.max("high").alias("_high"))
    asked = points.select(F.struct(*keys).alias("_k")).distinct().withColumn("_asks", F.lit(True))
    both = slots.withColumn("_asks", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    ranges = stage(both.repartitionByRange("_k").withColumn(SLICE, F.spark_partition_id()), "key-ranges")
    start = F.when(~F.col("_asks"), F.struct(F.col(SLOT).alias("slot"), F.col("_high").alias("high")))
    found = last_known(ranges, [], ["_k", "_asks"], {"_at": (start, True)}).where("_asks")
    inside = F.coalesce(F.col("_k") <= F.col("_at.high"), F.lit(False))
    return found.select(
        *[F.col(f"_k.{c}").alias(c) for c in keys], F.coalesce("_at.slot", F.lit(-1)).alias(SLOT), inside.alias("_inside")
    )


def _listing(files: DataFrame) -> DataFrame:
    """Number the slots: a file that starts beyond all ranges before it opens one. One row per file here."""
    earlier = W.orderBy("low", "high", "file").rowsBetween(W.unboundedPreceding, -1)
    upto = W.orderBy("low", "high", "file").rowsBetween(W.unboundedPreceding, 0)
    opens = F.coalesce(F.col("low") > F.max("high").over(earlier), F.lit(True))
    return files.withColumn("_opens", opens.cast("long")).withColumn(SLOT, F.sum("_opens").over(upto)).drop("_opens")


def keep_up(
    batch: DataFrame,
    batch_id: int,
    root: str,
    keys: list[str],
    merge: Merge,
    schema: StructType,
    spread: tuple[str, ...] = (),
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Bring the table up to date with a batch.

    ``merge`` gets all stored and new rows of the batch's keys, with the columns of ``schema``, and the names
    of the columns that make a key; it returns the rows to store for them. Other keys' rows are copied as they
    are. ``batch`` must have the columns of ``schema``. ``spread`` names columns after the keys to cut files by.
    """
    spark = batch.sparkSession
    columns = [f.name for f in schema.fields]
    arrived = stage(batch.select(*columns), "arrived")
    rows_arrived = arrived.count()
    if not rows_arrived:
        return
    before = state(spark, root, before=batch_id)
    touched, kept, rows = [], None, arrived.withColumn(SLOT, F.lit(-1).cast("long"))
    if before is not None:
        stored_files = listing(spark, before, keys, schema)
        placed = stage(_placed(arrived, stored_files, keys), "placed")
        slots = placed.where("_inside").select(SLOT).distinct()
        touched = stored_files.join(slots, SLOT, "left_semi").select("file", "row_count").collect()
        # Sorted keys take next to no bytes in a file, which Spark would take for a side small enough to broadcast.
        placed = placed.hint("merge")
        rows = join_null_safe(arrived, placed.drop("_inside"), keys)
    if touched:
        stored = spark.read.schema(schema).parquet(*[r["file"] for r in touched])
        where = stored_files.select(F.col("file").alias("_file"), SLOT)
        stored = stored.withColumn("_file", F.col("_metadata.file_path")).join(where, "_file").drop("_file")
        flagged = join_null_safe(stored, placed.select(*keys, F.lit(True).alias("_mine")), keys)
        kept = flagged.where(F.col("_mine").isNull()).drop("_mine")
        rows = flagged.where("_mine").drop("_mine").unionByName(rows)
    result = merge(rows, [*keys, SLOT]).select(*columns, SLOT)
    if kept is not None:
        result = result.unionByName(kept)
    rows_read = sum(r["row_count"] for r in touched)
    name = uuid.uuid4().hex
    ranges = max(1, -(-(rows_read + rows_arrived) // rows_per_file))
    result.repartitionByRange(ranges, SLOT, *keys, *spread).write.partitionBy(SLOT).parquet(f"{root}/data/{name}")

    written = spark.read.schema(schema).parquet(f"{root}/data/{name}")
    files = written.select(F.col("_metadata.file_path").alias("file"), F.struct(*keys).alias("_k")).groupBy("file").agg(
        F.min("_k").alias("low"), F.max("_k").alias("high"), F.count(F.lit(1)).alias("row_count")
    )
    if before is not None:
        files = stored_files.join(slots, SLOT, "left_anti").drop(SLOT).unionByName(files)
    _listing(files).write.parquet(f"{root}/files/{name}")
    now = spark.read.schema("row_count BIGINT").parquet(f"{root}/files/{name}")
    files_now, rows_now = now.agg(F.count(F.lit(1)), F.sum("row_count")).first()
    rows_before = before["rows_now"] if before else 0
    figures = (
        before["files_now"] if before else 0, len(touched), files_now, rows_arrived, rows_read,
        rows_now - (rows_before - rows_read), rows_now,
    )
    row = spark.range(1).select(
        F.lit(f"{root}/files/{name}").alias("files"), *[F.lit(v).cast("long").alias(k) for k, v in zip(FIGURES, figures)]
    )
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")
