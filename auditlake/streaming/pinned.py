"""A static side that changes between micro-batches: each batch records the version it saw, replay joins the same.

The side is a folder: ``rows`` holds its versions, each written once, ``versions`` one row per version naming
its folder, written last. A streamed table is a folder too: ``used`` holds, per micro-batch, the version it took
and the files its rows came from, ``rows`` the flagged rows, a folder per batch. The version is settled before
any row is written, and a retried batch takes the one it had settled on. A source file belongs to one batch only, so file and version are enough to derive the
stored rows again, whatever the batches of the replay are. One writer publishes versions, one stream writes a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructType

from auditlake.streaming.runs import BATCH, run_batches

VERSION = "side_version"
NOTHING = 0  # the version before the first one: no rows


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per published version and its folder."""
    return _read(spark, f"{root}/versions", f"folder STRING, {VERSION} INT")


def newest_version(spark: SparkSession, root: str) -> int:
    return versions(spark, root).agg(F.coalesce(F.max(VERSION), F.lit(NOTHING))).first()[0]


def publish_side(df: DataFrame, root: str) -> int:
    """Publish ``df`` as the next version and return its number; a failed attempt leaves no version."""
    spark = df.sparkSession
    number = newest_version(spark, root) + 1
    folder = f"{root}/rows/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    spark.range(1).select(F.lit(folder).alias("folder")).coalesce(1).write.parquet(f"{root}/versions/{VERSION}={number}")
    return number


def read_side(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The side as of a version, the newest one if none is named."""
    at = newest_version(spark, root) if version is None else version
    if at == NOTHING:
        return spark.createDataFrame([], schema)
    named = versions(spark, root).where(F.col(VERSION) == at).first()
    if named is None:
        raise ValueError(f"{root} has no version {at}")
    return spark.read.schema(schema).parquet(named["folder"])


def with_match(rows: DataFrame, side: DataFrame, column: str, side_column: str, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``out``: whether ``side`` has the row's value (for the same ``by`` columns). Never adds a row; NULL matches nothing.

    The side's distinct values are few beside the rows; Spark's size check settles how they are joined.
    """
    known = side.select(F.col(side_column).alias("_value"), *[F.col(c).alias(f"_by_{c}") for c in by]).distinct()
    same = F.col(column) == F.col("_value")
    for c in by:
        same &= F.col(c) == F.col(f"_by_{c}")
    joined = rows.drop(out).join(known, same, "left")
    return joined.withColumn(out, F.col("_value").isNotNull()).drop("_value", *[f"_by_{c}" for c in by])


def _used(spark: SparkSession, target: str) -> DataFrame:
    return _read(spark, f"{target}/used", f"file STRING, {VERSION} INT, {BATCH} INT")


def flag_stream(
    changes: DataFrame, root: str, side_schema: StructType, column: str, side_column: str, out: str,
    target: str, checkpoint: str, file_col: str = "_source_file",
) -> None:
    """Flag what is new against the side as it is now, and record which version that was.

    ``file_col`` names the file each row came from.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        settled = _used(spark, target).where(F.col(BATCH) == batch_id).select(VERSION).first()
        version = settled[VERSION] if settled else newest_version(spark, root)
        if settled is None:
            seen = batch.select(F.col(file_col).alias("file")).distinct().withColumn(VERSION, F.lit(version))
            seen.write.mode("overwrite").parquet(f"{target}/used/{BATCH}={batch_id}")
        flagged = with_match(batch, read_side(spark, root, side_schema, version), column, side_column, out)
        flagged.withColumn(VERSION, F.lit(version)).write.mode("overwrite").parquet(f"{target}/rows/{BATCH}={batch_id}")

    run_batches(changes, handle, checkpoint)


def read_flagged(spark: SparkSession, target: str, schema: StructType, out: str) -> DataFrame:
    """The stored rows with their flag, the version they were flagged by and their batch."""
    stored = StructType([f for f in schema.fields if f.name != out]).add(out, BooleanType())
    return _read(spark, f"{target}/rows", stored.add(VERSION, IntegerType()).add(BATCH, IntegerType()))


def replay(
    rows: DataFrame, root: str, side_schema: StructType, column: str, side_column: str, out: str,
    target: str, file_col: str = "_source_file",
) -> DataFrame:
    """Flag all source rows again as the stream did, each by the version its file was taken with.

    Rows of files that the stream has not taken yet get the newest version.
    """
    spark = rows.sparkSession
    now = newest_version(spark, root)
    used = _used(spark, target).groupBy(F.col("file").alias("_file")).agg(F.min(VERSION).alias("_version"))
    known = rows.join(used, F.col(file_col) == F.col("_file"), "left")
    known = known.withColumn(VERSION, F.coalesce("_version", F.lit(now))).drop("_file", "_version")
    numbers = [r[VERSION] for r in versions(spark, root).select(VERSION).collect()]  # one per published version
    sides = spark.createDataFrame([], StructType([*side_schema.fields]).add(VERSION, IntegerType()))
    for number in numbers:
        sides = sides.unionByName(read_side(spark, root, side_schema, number).withColumn(VERSION, F.lit(number)))
    return with_match(known, sides, column, side_column, out, by=(VERSION,))
