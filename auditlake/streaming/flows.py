"""Several flows into one table, each a stream of its own.

A flow has its own checkpoint and its own folders of the table, one per micro-batch. So one can be added,
stopped or sent again without the others, and a flow added later takes in its own source from the start while
the others go on where they were. A micro-batch that is retried overwrites its own folder.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from auditlake.operators.shape import conform
from auditlake.streaming.runs import BATCH, write_batch

FLOW = "flow"


def _by_name(df: DataFrame, ddl: str, flow: str) -> DataFrame:
    """The table's columns by name. What the flow lacks is NULL; what the table lacks is an error, not lost."""
    unknown = sorted(set(df.columns) - set(StructType.fromDDL(ddl).names))
    if unknown:
        raise ValueError(f"flow {flow} has columns that the table has not: {', '.join(unknown)}")
    return conform(df, ddl)


def run_flows(flows: Mapping[str, DataFrame], ddl: str, target: str, checkpoints: str) -> None:
    """Append what is new in every flow, side by side, and stop.

    A flow that fails stops alone; the others finish, then its error is raised.
    """
    for name in flows:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
            raise ValueError(f"{name!r} cannot name a folder")
    ready = {name: _by_name(df, ddl, name) for name, df in flows.items()}
    started = [
        df.writeStream.queryName(f"{name}-{target[-8:]}")
        .foreachBatch(lambda batch, batch_id, name=name: write_batch(batch, f"{target}/{FLOW}={name}", batch_id))
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .trigger(availableNow=True)
        .start()
        for name, df in ready.items()
    ]
    errors = []
    for query in started:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001
            errors.append(error)
    if errors:
        raise errors[0]


def read_flows(spark: SparkSession, target: str, ddl: str) -> DataFrame:
    """The table, with the flow and the micro-batch of every row."""
    schema = StructType([*StructType.fromDDL(ddl), StructField(FLOW, StringType()), StructField(BATCH, IntegerType())])
    try:
        return spark.read.schema(schema).parquet(target)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise
