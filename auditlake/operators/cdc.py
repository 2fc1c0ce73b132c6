"""Change data: upserts, version history, dimensions, snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlake import constants as K
from auditlake.functions import surrogate_key
from auditlake.operators.joins import latest_snapshot
from auditlake.operators.keyed import (
    SLICE,
    SLICE_SECONDS,
    heavy,
    join_null_safe,
    last_known,
    latest_by,
    repeated,
    total_order,
    with_repeated,
    with_slice,
)
from auditlake.session import stage


def scd1(
    changes: DataFrame,
    keys: list[str],
    sequence: str,
    except_cols: list[str] = (),
    tie_break: list[str] | None = None,
) -> DataFrame:
    """One row per key, the highest sequence wins. Replaying any input changes nothing.

    Equal sequences are settled by ``tie_break`` (highest wins), or by every other column.
    """
    leading = [F.col(sequence).desc_nulls_last()]
    if tie_break is None:
        order = total_order(changes, leading, exclude=[*keys, sequence])
    else:
        order = [*leading, *[F.col(c).desc_nulls_last() for c in tie_break]]
    return latest_by(changes, keys, order).drop(*except_cols)


def scd1_rare(
    changes: DataFrame,
    keys: list[str],
    sequence: str,
    except_cols: list[str] = (),
    tie_break: list[str] | None = None,
) -> DataFrame:
    """``scd1`` of wide rows whose keys seldom repeat: the same rows, but only repeated keys are shuffled.

    ``changes`` is read three times, twice right away. With more repeated keys than fit a broadcast this is ``scd1``.
    """
    again = repeated(changes, keys)
    if again is None:
        return scd1(changes, keys, sequence, except_cols, tie_break)
    winners = scd1(with_repeated(changes, keys, again, "left_semi"), keys, sequence, except_cols, tie_break)
    once = with_repeated(changes, keys, again, "left_anti").drop(*except_cols)
    return once.unionByName(stage(winners, "repeated-winners"))


def scd2(
    changes: DataFrame,
    keys: list[str],
    sequence: str,
    track: list[str],
    except_cols: list[str] = (),
    tie_break: list[str] | None = None,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Version history: a new version starts when a tracked column changes.

    Adds ``start_at`` (time of the change) and ``end_at`` (start of the next version, NULL for the
    open one). Columns that are not tracked show their last value within the version. Input order
    does not matter; of several changes at one time only the last counts. A NULL key is a key.

    A key with few rows is cut in one task, after one shuffle; heavier ones in time slices. The rows of a key are
    counted when the history is built.
    """
    crowded = heavy(changes.where(F.col(sequence).isNotNull()).select(F.xxhash64(*keys)))
    how = keys, sequence, track, except_cols, tie_break
    if crowded is None:
        return _versions(changes, *how)
    sliced = _versions(with_repeated(changes, keys, crowded, "left_semi"), *how, seconds)
    return _versions(with_repeated(changes, keys, crowded, "left_anti"), *how).unionByName(sliced)


def _versions(
    changes: DataFrame, keys: list[str], sequence: str, track: list[str], except_cols: list[str],
    tie_break: list[str] | None, seconds: int | None = None,
) -> DataFrame:
    """``scd2`` with the rows of a key in one task, or in time slices of so many ``seconds``."""
    kept = [c for c in changes.columns if c not in except_cols]
    ties = [c for c in sorted(kept) if c not in (*keys, sequence)] if tie_break is None else tie_break
    other = [c for c in kept if c not in (*keys, sequence, *track)]
    ranked = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate([*ties, *track, *other])])
    timed = changes.where(F.col(sequence).isNotNull())
    moments = (
        (timed.repartition(*keys) if seconds is None else timed)
        .groupBy(*keys, sequence)
        .agg(F.max_by(F.struct(*track, *other), ranked).alias("_row"))
        .select(*keys, sequence, F.struct(*[F.col(f"_row.{c}") for c in track]).alias("_now"), "_row")
    )

    def named(result: DataFrame) -> DataFrame:
        columns = {**{c: F.col(f"_tracked.{c}") for c in track}, **{c: F.col(f"_other.{c}") for c in other}}
        listed = [columns[c].alias(c) for c in kept if c in columns]
        return result.select(*keys, *listed, "start_at", F.col("_end").alias("end_at"))

    def differs(before: str):
        changed = [~F.col(f"_now.{c}").eqNullSafe(F.col(f"{before}.{c}")) for c in track]
        return F.col(before).isNull() | reduce(lambda a, b: a | b, changed)

    if seconds is None:
        # What is dealt by key stays where it is from here on.
        ordered = W.partitionBy(*keys).orderBy(sequence)
        begun = moments.withColumn("_before", F.lag("_now").over(ordered)).withColumn(
            "_from", F.last(F.when(differs("_before"), F.col(sequence)), ignorenulls=True).over(ordered)
        )
        cut = begun.groupBy(*keys, "_from").agg(
            F.min_by("_now", sequence).alias("_tracked"), F.max_by("_row", sequence).alias("_other")
        )
        following = F.lead("_from").over(W.partitionBy(*keys).orderBy("_from"))
        return named(cut.withColumn("_end", following).withColumnRenamed("_from", "start_at"))

    within = W.partitionBy(*keys, SLICE).orderBy(sequence)
    local = (
        with_slice(moments, sequence, seconds)
        .withColumn("_before", F.lag("_now").over(within))
        .withColumn("_inner", F.col("_before").isNotNull() & differs("_before"))
    )
    # One row per key and slice: what it ends with, and where its first version starts.
    slices = W.partitionBy(*keys).orderBy(SLICE)
    summary = (
        local.groupBy(*keys, SLICE)
        .agg(
            F.min(sequence).alias("_first_seq"),
            F.min_by("_now", sequence).alias("_now"),
            F.max_by("_now", sequence).alias("_last"),
            F.min(F.when(F.col("_inner"), F.col(sequence))).alias("_inner_start"),
        )
        .withColumn("_previous", F.lag("_last").over(slices))
        .withColumn("_opens", differs("_previous"))
        .withColumn("_start", F.when(F.col("_opens"), F.col("_first_seq")).otherwise(F.col("_inner_start")))
        .withColumn(
            "_later", F.first("_start", ignorenulls=True).over(slices.rowsBetween(1, W.unboundedFollowing))
        )
        .select(*keys, SLICE, "_opens", "_later")
    )
    start = F.when(F.when(F.col("_before").isNull(), F.col("_opens")).otherwise(F.col("_inner")), F.col(sequence))
    following = F.first("_starts", ignorenulls=True).over(within.rowsBetween(1, W.unboundedFollowing))
    versions = (
        join_null_safe(local, summary, [*keys, SLICE])
        .withColumn("_starts", start)
        .withColumn("_end", F.coalesce(following, F.col("_later")))
    )

    # All rows of a version share the start of the next one.
    result = versions.groupBy(*keys, "_end").agg(
        F.min(sequence).alias("start_at"),
        F.min_by("_now", sequence).alias("_tracked"),
        F.max_by("_row", sequence).alias("_other"),
    )
    return named(result)


def scd2_dimension(history: DataFrame, key: str = "customer_id", unknown: bool = True) -> DataFrame:
    """History as a dimension: hash key, closed range end, and the Unknown member."""
    versions = history.select(
        surrogate_key(F.col(key), F.col("start_at")).alias("customer_key"),
        F.col(key).alias("customer_id"),
        "entity_type",
        "segment",
        "region",
        F.col("start_at").alias("valid_from"),
        F.coalesce(F.col("end_at"), F.lit(K.OPEN_END).cast("timestamp")).alias("valid_to"),
        F.col("end_at").isNull().alias("is_current"),
    )
    return versions.unionByName(unknown_member(history.sparkSession)) if unknown else versions


def unknown_member(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(K.UNKNOWN_KEY).cast("bigint").alias("customer_key"),
        F.lit("UNKNOWN").alias("customer_id"),
        F.lit("unknown").alias("entity_type"),
        F.lit("Unknown").alias("segment"),
        F.lit("Unknown").alias("region"),
        F.lit(K.UNKNOWN_START).cast("timestamp").alias("valid_from"),
        F.lit(K.OPEN_END).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def version_links(dim: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every known version with the start of the one after it (``next_from``)."""
    known = dim.where(F.col("customer_key") != K.UNKNOWN_KEY).select(
        "customer_key", "customer_id", "valid_from", "valid_to", "is_current"
    )
    sliced = with_slice(known, "valid_from", seconds)
    # customer_key makes the order total, so overlapping versions are linked one by one.
    return last_known(
        sliced,
        ["customer_id"],
        ["valid_from", "customer_key"],
        {"next_from": (F.col("valid_from"), False)},
        backward=True,
    )


def scd2_integrity(dim: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row of counts: gaps or overlaps, inverted ranges, customers without one current row."""
    links = version_links(dim, seconds)
    per_customer = links.groupBy("customer_id").agg(
        F.count_if(
            F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))
        ).alias("broken"),
        F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("inverted"),
        F.count_if("is_current").alias("current"),
    )
    return per_customer.agg(
        F.coalesce(F.sum("broken"), F.lit(0)).alias("gaps_or_overlaps"),
        F.coalesce(F.sum("inverted"), F.lit(0)).alias("inverted_ranges"),
        F.count_if(F.col("current") != 1).alias("not_one_current"),
    )


def explode_calendar(payloads: DataFrame) -> DataFrame:
    """One row per holiday in each payload: a map of regions, each with a list of events."""
    regions = payloads.select(
        "_ingested_at", F.explode(F.from_json("payload", K.PAYLOAD_DDL)).alias("division", "region")
    )
    events = regions.select("_ingested_at", "division", F.explode("region.events").alias("event"))
    return events.select(
        "division",
        "event.title",
        "event.notes",
        "event.bunting",
        F.col("_ingested_at").alias("loaded_at"),
        F.to_date("event.date").alias("holiday_date"),
    )


def snapshot_replace(payloads: DataFrame) -> DataFrame:
    """The newest payloads are the whole truth: one row per region, date and title from them."""
    rows = explode_calendar(latest_snapshot(payloads, "_ingested_at"))
    keys = ["division", "holiday_date", "title"]
    order = [
        F.col("loaded_at").desc(),
        F.col("notes").desc_nulls_last(),
        F.col("bunting").desc_nulls_last(),
    ]
    return latest_by(rows, keys, order)
