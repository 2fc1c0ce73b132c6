"""Landed files: fixed contracts with per-field rescue, whole payloads, ad-hoc scans.

The same functions serve batch and streaming reads; only the reader differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

RESCUE = "_rescued_data"
UNLISTED = "_unlisted"


def with_audit(df: DataFrame) -> DataFrame:
    """Where and when a row came from. The frame must be a file read."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
        F.current_timestamp().alias("_ingested_at"),
    )


def try_parse(text: Column, field: StructField, timestamp_format: str | None, tz: str | None) -> Column:
    """The text as the field's type, NULL when it does not fit. Scientific notation is a number."""
    if isinstance(field.dataType, StringType):
        return text
    if isinstance(field.dataType, TimestampType) and timestamp_format:
        parsed = F.try_to_timestamp(text, F.lit(timestamp_format))
        return F.to_utc_timestamp(parsed, tz) if tz and tz != "UTC" else parsed
    if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
        return text.try_cast(field.dataType)
    return F.trim(text).try_cast(field.dataType)


def _rescued_json(misfits: dict[str, Column]) -> Column:
    """JSON of the values that are not NULL, NULL when there are none."""
    pairs = F.create_map(*[x for name, value in misfits.items() for x in (F.lit(name), value)])
    kept = F.map_filter(pairs, lambda _, value: value.isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(kept))


def rescue(
    df: DataFrame,
    ddl: str,
    timestamp_format: str | None = None,
    tz: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Type all-string columns. A value that does not fit becomes NULL and is kept, by column
    name, in ``_rescued_data`` (NULL when the whole row fits). Rows are never lost."""
    fields = StructType.fromDDL(ddl).fields
    typed = [
        try_parse(F.col(f.name), f, timestamp_format, tz).alias(f"_t_{f.name}") for f in fields
    ]
    wide = df.select("*", *typed)
    misfits = {
        f.name: F.when(F.col(f.name).isNotNull() & F.col(f"_t_{f.name}").isNull(), F.col(f.name))
        for f in fields
    }
    rescued = _rescued_json(misfits)
    return wide.select(
        *[F.col(f"_t_{f.name}").alias(f.name) for f in fields], rescued.alias(RESCUE), *keep
    )


def _reader(spark: SparkSession, streaming: bool, max_files: int | None = None):
    if not streaming:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def read_contract(
    spark: SparkSession,
    path: str,
    ddl: str,
    glob: str = "*.csv",
    streaming: bool = False,
    timestamp_format: str | None = None,
    tz: str | None = None,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """CSV files with a header and a fixed typed contract; only files that match ``glob``.

    A header that does not name the contract's columns in order is an error, not shifted data.
    """
    names = [f.name for f in StructType.fromDDL(ddl).fields]
    texts = StructType([StructField(n, StringType()) for n in names])
    raw = (
        _reader(spark, streaming, max_files)
        .format("csv")
        .schema(texts)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", glob)
        .options(**options)
        .load(path)
    )
    audit = ("_source_file", "_source_modified_at", "_ingested_at")
    return rescue(with_audit(raw), ddl, timestamp_format, tz, keep=audit)


def read_lines(
    spark: SparkSession, path: str, glob: str = "*.jsonl", streaming: bool = False, max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Text lines with audit columns: the schema-free first stage of an evolving JSON source."""
    reader = _reader(spark, streaming, max_files).format("text").option("pathGlobFilter", glob)
    raw = reader.options(**options).load(path)
    return with_audit(raw)


def read_payloads(
    spark: SparkSession, path: str, glob: str = "*.json", streaming: bool = False
) -> DataFrame:
    """Each file as one row, exactly as received."""
    raw = (
        _reader(spark, streaming)
        .format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return with_audit(raw.select(F.col("value").alias("payload"), "_metadata")).drop("_metadata")


def parse_json_lines(lines: DataFrame, hints: str, value: str = "value") -> DataFrame:
    """JSON lines typed by the hints. Every line is parsed once; misfits are rescued.

    Fields that the hints do not list stay in one column, ``_unlisted``, a map of their texts (objects as
    JSON). So new fields never change the schema; ``with_unlisted`` makes columns of those asked for.
    """
    fields = StructType.fromDDL(hints).fields
    raw = lines.withColumn("_raw", F.from_json(value, "MAP<STRING, STRING>"))
    typed = {f.name: try_parse(F.col("_raw")[f.name], f, None, None) for f in fields}
    wide = raw.withColumns({f"_t_{name}": column for name, column in typed.items()})
    misfits = {f.name: F.when(F.col(f"_t_{f.name}").isNull(), F.col("_raw")[f.name]) for f in fields}
    not_json = F.when(F.col("_raw").isNull(), F.col(value))
    listed = F.lit([f.name for f in fields])
    return wide.select(
        *[F.col(f"_t_{f.name}").alias(f.name) for f in fields],
        F.map_filter("_raw", lambda name, _: ~F.array_contains(listed, name)).alias(UNLISTED),
        _rescued_json({**misfits, "_line": not_json}).alias(RESCUE),
        *[c for c in lines.columns if c != value],
    )


def with_unlisted(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns of the given fields beyond the hints, as text, NULL where a row has none, before the rescue
    column; the others stay in ``_unlisted``."""
    at = df.columns.index(RESCUE)
    found = [F.col(UNLISTED)[name].alias(name) for name in names]
    return df.select(*df.columns[:at], *found, *df.columns[at:])


def unlisted_names(df: DataFrame) -> DataFrame:
    """The fields beyond the hints: ``name`` and the rows that have it."""
    return df.select(F.explode(F.map_keys(UNLISTED)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("row_count"))


def read_evolving(spark: SparkSession, path: str, hints: str, glob: str = "*.jsonl", names: list[str] = ()) -> DataFrame:
    """Batch read of JSON lines with schema hints; the unlisted fields named become columns."""
    return with_unlisted(parse_json_lines(read_lines(spark, path, glob), hints), list(names))


def scan_files(spark: SparkSession, path: str, fmt: str, ddl: str | None = None, **options) -> DataFrame:
    """Ad-hoc batch scan with the file path, e.g. multi-line manifests or text-only CSV columns."""
    reader = spark.read.format(fmt).options(**options)
    if ddl:
        reader = reader.schema(ddl)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("file_path"))
