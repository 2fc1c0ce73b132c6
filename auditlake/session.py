"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Can only be set when a session is made: call-site capture doubles the time it takes to build a
# wide plan from Python.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", app: str = "auditlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables and checkpoints, under spark.checkpoint.dir.

    The folder must be reachable by every executor, so only a local session may fall back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="auditlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df, label: str):
    """Write a frame to the scratch folder and read it back: shorter lineage, known size."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
