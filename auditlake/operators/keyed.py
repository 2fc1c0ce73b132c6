"""Per-key ordered operations that stay spread out when one key holds much of the data.

A window over a key puts all of that key's rows in one task. So every key is cut into time slices that
are processed apart; what a slice needs from its neighbours comes from one summary row per key and
slice, joined back null-safe. Callers first reduce to one row per key and time, so many rows at one
moment are summed up in their own tasks. Callers may keep keys of few rows (``LIGHT_ROWS``) whole: these are
ordered in one shuffle, and only the rows of heavier keys are sliced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlake.session import stage

# So many narrow rows fit a broadcast; more are shuffled.
FEW_ROWS = 2_000_000
# Rows of one key that a task may order at once; a key with more is cut into slices.
LIGHT_ROWS = 10_000
SLICE_SECONDS = 86_400
SLICE = "_slice"


def with_slice(df: DataFrame, ts: str, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``_slice``, the number of the time slice of each row."""
    number = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000))
    return df.withColumn(SLICE, number)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on columns of the same names; a NULL key is a key like others."""
    renamed = right.withColumnsRenamed({c: f"_s{i}" for i, c in enumerate(keys)})
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(keys)]
    )
    return left.join(renamed, match, how).drop(*[f"_s{i}" for i in range(len(keys))])


def last_known(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[Column, bool]],
    backward: bool = False,
) -> DataFrame:
    """For each row, the nearest non-NULL value at or before it within its key.

    ``values`` maps a new column to (value, inclusive): inclusive looks at the row itself too.
    ``backward`` looks at the rows after it instead. ``df`` must carry ``_slice``, which grows with
    the order.
    """
    sort = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
    names = list(values)
    given = df.columns
    valued = df.withColumns({f"_v_{n}": value for n, (value, _) in values.items()})

    position = F.struct(*[F.col(c) for c in order])
    ends = F.min_by if backward else F.max_by
    last_of = {
        n: ends(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), position)) for n in names
    }
    summary = valued.groupBy(*keys, SLICE).agg(*[v.alias(f"_end_{n}") for n, v in last_of.items()])
    slice_sort = F.col(SLICE).desc() if backward else F.col(SLICE).asc()
    earlier = W.partitionBy(*keys).orderBy(slice_sort).rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        SLICE,
        *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_from_{n}") for n in names],
    )

    window = W.partitionBy(*keys, SLICE).orderBy(*sort)
    result = {
        n: F.coalesce(
            F.last(f"_v_{n}", ignorenulls=True).over(
                window.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
            ),
            F.col(f"_from_{n}"),
        )
        for n, (_, inclusive) in values.items()
    }
    return join_null_safe(valued, carried, [*keys, SLICE]).withColumns(result).select(*given, *names)


def if_few(df: DataFrame, label: str, most: int | None = None) -> DataFrame | None:
    """A narrow frame written once and marked for broadcast, or None if it holds more than ``most`` rows."""
    kept = stage(df, label)
    return F.broadcast(kept) if kept.count() <= (FEW_ROWS if most is None else most) else None


def heavy(df: DataFrame) -> DataFrame | None:
    """Values (``_again``) of the only column that more than ``LIGHT_ROWS`` rows hold, or None without any.

    They are counted right away, and marked for broadcast unless they are many.
    """
    counts = df.toDF("_again").groupBy("_again").agg(F.count(F.lit(1)).alias("_n"))
    kept = stage(counts.where(F.col("_n") > LIGHT_ROWS).select("_again"), "heavy")
    found = kept.count()
    if not found:
        return None
    return F.broadcast(kept) if found <= FEW_ROWS else kept


def repeated(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Hashes (``_again``) that more than one row's key has, marked for broadcast; None if they are many.

    Only hashes are shuffled. A key whose hash is not among them is certainly on one row; NULL is a key.
    """
    hashes = df.select(F.xxhash64(*keys).alias("_again")).groupBy("_again").agg(F.count(F.lit(1)).alias("_n"))
    return if_few(hashes.where("_n > 1").select("_again"), "repeated")


def with_repeated(df: DataFrame, keys: list[str], again: DataFrame, how: str) -> DataFrame:
    """The rows whose key's hash comes again ("left_semi"), or the others ("left_anti"); none is shuffled."""
    hashed = df.withColumn("_key_hash", F.xxhash64(*keys))
    return hashed.join(again, F.col("_key_hash") == F.col("_again"), how).drop("_key_hash")


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order. Each task keeps one row a key before the shuffle."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return latest_by(df, keys, [F.col(c).asc() for c in order])


def total_order(df: DataFrame, leading: list[Column], exclude: list[str]) -> list[Column]:
    """The leading order, made deterministic by every other sortable column, highest first."""
    rest = [
        F.col(f.name).desc_nulls_last()
        for f in sorted(df.schema.fields, key=lambda f: f.name)
        if f.name not in exclude and f.dataType.typeName() not in ("map", "variant")
    ]
    return [*leading, *rest]


def _points(
    df: DataFrame, key: str, ts: str, condition: Column, before: int, after: int
) -> DataFrame:
    """Counts around every distinct (key, ts): columns key, ts, _nearby.

    Rows are first summed to distinct points. A point goes to its own time bucket and, when it
    counts, to the buckets whose points can see it, so a window never spans more than one bucket.
    """
    width = 4 * max(before + after, 1) * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    summed = df.groupBy(key, ts).agg(F.sum(F.when(condition, 1).otherwise(0)).alias("_n"))
    at = summed.withColumn("_at", micros).withColumn("_home", F.floor(F.col("_at") / width))
    first = F.floor((F.col("_at") - after * 1_000_000) / width)
    last = F.floor((F.col("_at") + before * 1_000_000) / width)
    seen_from = F.when(F.col("_n") > 0, F.sequence(first, last)).otherwise(
        F.array(F.col("_home"))
    )
    spread = at.withColumn("_bucket", F.explode(seen_from))
    around = (
        W.partitionBy(key, "_bucket")
        .orderBy("_at")
        .rangeBetween(-before * 1_000_000, after * 1_000_000)
    )
    return (
        spread.withColumn("_nearby", F.sum("_n").over(around))
        .where(F.col("_bucket") == F.col("_home"))
        .select(key, ts, "_nearby")
    )


def count_within(
    df: DataFrame, key: str, ts: str, condition: Column, before: int, after: int, name: str
) -> DataFrame:
    """For every row, how many rows of its key meet ``condition`` from ``before`` seconds earlier
    to ``after`` seconds later, both ends included."""
    points = _points(df, key, ts, condition, before, after).select(
        F.col(key).alias("_p_key"), F.col(ts).alias("_p_ts"), F.col("_nearby").alias(name)
    )
    match = F.col(key).eqNullSafe(F.col("_p_key")) & F.col(ts).eqNullSafe(F.col("_p_ts"))
    return df.join(points, match, "left").drop("_p_key", "_p_ts")


def crowded_points(
    df: DataFrame, key: str, ts: str, condition: Column, before: int, after: int, threshold: int
) -> DataFrame:
    """The distinct (key, ts) of rows that meet ``condition`` and see at least ``threshold`` such
    rows around them. Only those rows are read, and few points survive the threshold."""
    points = _points(df.where(condition), key, ts, F.lit(True), before, after)
    return points.where(F.col("_nearby") >= threshold).select(key, ts).distinct()
