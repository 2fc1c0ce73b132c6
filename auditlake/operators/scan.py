"""Scans over document tables: payload contracts, identifiers in texts, data profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake import constants as K

INVALID_JSON = "INVALID_JSON"
MISSING_DIVISION = "MISSING_DIVISION"
NO_EVENTS = "NO_EVENTS"
MISSING_FIELD = "MISSING_FIELD"
BAD_DATE = "BAD_DATE"

# Line ends that count: every one that Unicode text splitting knows.
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
# Case does not matter, and letters, digits and word edges are those of Unicode.
FLAGS = "(?iU)"
DEFAULT_PATTERNS = (
    r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}",
    r"(/home/|/users/)[a-z0-9._-]+",
    r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
)


def validate_payloads(
    df: DataFrame,
    id_col: str,
    payload: str,
    divisions: tuple[str, ...] = K.DIVISIONS,
    fields: tuple[str, ...] = K.EVENT_FIELDS,
) -> DataFrame:
    """First contract breach of each payload, NULL when it is sound.

    Breaches in order: not a JSON object, a required region missing, a region without events, an
    event without a required field, an event whose date is not an ISO date.
    """
    regions = F.from_json(payload, "MAP<STRING, STRUCT<events: ARRAY<MAP<STRING, STRING>>>>")
    parsed = df.select(
        F.col(id_col),
        F.try_parse_json(payload).isNotNull().alias("_is_json"),
        F.from_json(payload, "MAP<STRING, STRING>").alias("_keys"),
        regions.alias("_regions"),
    )
    present = F.map_keys("_keys")
    missing = reduce(lambda a, b: a | b, [~F.array_contains(present, d) for d in divisions])
    events = [F.col("_regions")[d]["events"] for d in divisions]
    empty = reduce(lambda a, b: a | b, [F.coalesce(F.size(e) <= 0, F.lit(True)) for e in events])

    def some_event(test) -> Column:
        return reduce(lambda a, b: a | b, [F.exists(e, test) for e in events])

    def lacks_field(event: Column) -> Column:
        return reduce(lambda a, b: a | b, [~F.map_contains_key(event, f) for f in fields])

    def bad_date(event: Column) -> Column:
        iso = event["date"].rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
        return ~F.coalesce(iso & F.try_to_date(event["date"], "yyyy-MM-dd").isNotNull(), F.lit(False))

    reason = (
        F.when(~F.col("_is_json") | F.col("_keys").isNull(), INVALID_JSON)
        .when(missing, MISSING_DIVISION)
        .when(empty, NO_EVENTS)
        .when(some_event(lacks_field), MISSING_FIELD)
        .when(some_event(bad_date), BAD_DATE)
    )
    return parsed.select(id_col, reason.alias("reason"))


def scan_lines(
    df: DataFrame, id_col: str, text: str, patterns: tuple[str, ...] = DEFAULT_PATTERNS
) -> DataFrame:
    """Numbers of the lines where a pattern matches, with how many do. The match is not shown.

    Texts are split first, so ``^`` and ``$`` are the ends of a line.
    """
    any_pattern = FLAGS + "|".join(f"(?:{p})" for p in patterns)
    lines = (
        df.select(id_col, F.posexplode(F.split(text, LINE_END)).alias("_position", "_line"))
        .where(F.col("_line").rlike(any_pattern))
    )
    hits = reduce(
        lambda a, b: a + b, [F.col("_line").rlike(FLAGS + p).cast("int") for p in patterns]
    )
    return lines.select(
        id_col, (F.col("_position") + 1).alias("line_no"), hits.alias("n_patterns")
    ).where(F.col("n_patterns") > 0)


def profile_columns(
    df: DataFrame, numeric_text: tuple[str, ...] = (), scale: int = 2
) -> DataFrame:
    """Per column: NULLs, blanks, unparsable numbers, numbers with more than ``scale`` decimals,
    smallest and largest value as text. One pass over the data."""
    metrics = []
    for name in df.columns:
        text = F.col(name).cast("string")
        as_decimal = text.try_cast("decimal(38,10)")
        is_number = name in numeric_text
        unparsable = text.isNotNull() & (F.trim(text) != "") & as_decimal.isNull()
        lossy = as_decimal != F.round(as_decimal, scale)
        low = F.min(as_decimal).cast("double").cast("string") if is_number else F.min(text)
        high = F.max(as_decimal).cast("double").cast("string") if is_number else F.max(text)
        metrics.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(text.isNull()).alias("nulls"),
                F.count_if(F.trim(text) == "").alias("blanks"),
                (F.count_if(unparsable) if is_number else F.lit(None).cast("bigint")).alias("unparsable"),
                (F.count_if(lossy) if is_number else F.lit(None).cast("bigint")).alias("lossy"),
                low.alias("min_value"),
                high.alias("max_value"),
            )
        )
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *[m.alias(f"_m{i}") for i, m in enumerate(metrics)])
    per_column = F.explode(F.array(*[F.col(f"_m{i}") for i in range(len(metrics))]))
    return totals.select("row_count", per_column.alias("m")).select("m.*", "row_count")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate rows beyond the first of each."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def profile_counts(df: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Rows per value for each of several groupings, e.g. per type, hour or day.

    Each row is expanded to one (dimension, value) pair a grouping, then counted in one shuffle.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), value.cast("string").alias("value"))
            for name, value in by.items()
        ]
    )
    exploded = df.select(F.explode(pairs).alias("p")).select("p.*")
    return exploded.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("row_count"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct values per column: distinct (column, value) pairs, then a count."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    return distinct.groupBy("column_name").agg(F.count("value").alias("distinct_values"))
