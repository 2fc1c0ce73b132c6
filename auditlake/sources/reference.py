"""Reference tables that are generated rather than read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake import constants as K


def dim_type(spark: SparkSession) -> DataFrame:
    """The transaction types: a fixed table of five rows, planned as a local relation."""
    rows = ", ".join(
        f"({key}, '{name}', '{category}', '{description}', {can_be_fraud})"
        for key, name, category, description, can_be_fraud in K.TYPE_ROWS
    )
    names = "type_key, type_name, category, description, can_be_fraud"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")


def calendar(spark: SparkSession, start: str = K.CALENDAR_START, end: str = K.CALENDAR_END) -> DataFrame:
    """One row per day from start to end, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("calendar_date"))


def calendar_over(dates: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of a column."""
    bounds = dates.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = F.sequence(F.to_date("first"), F.to_date("last"), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("calendar_date"))
