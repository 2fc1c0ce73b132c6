"""Joins: stream-static flags, point-in-time lookups, orphan and disagreement counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlake import constants as K
from auditlake.operators.keyed import SLICE_SECONDS, heavy, if_few, last_known, with_slice
from auditlake.session import stage


def with_holiday_flag(
    tx: DataFrame, holidays: DataFrame, division: str = K.HEADLINE_DIVISION
) -> DataFrame:
    """Add ``is_bank_holiday``. ``tx`` may be a stream; a date with two names never adds a row.

    The distinct dates are broadcast: there are only so many calendar days, however large the
    holiday table. So the transactions are never shuffled by date.
    """
    dates = (
        holidays.where(F.col("division") == division)
        .select(F.col("holiday_date").alias("_holiday"))
        .distinct()
    )
    match = F.col("event_date") == F.col("_holiday")
    joined = tx.drop("is_bank_holiday").join(F.broadcast(dates), match, "left")
    return joined.withColumn("is_bank_holiday", F.col("_holiday").isNotNull()).drop("_holiday")


def asof_join(
    facts: DataFrame,
    events: DataFrame,
    key: str,
    ts: str,
    event_key: str,
    event_ts: str,
    values: list[str],
    out: str,
    seconds: int = SLICE_SECONDS,
    few_known: bool = False,
) -> DataFrame:
    """Add ``out``: a struct of the latest event at or before each fact, NULL without one.

    Facts and events of a key that has few rows are ordered together, in one shuffle of either. Of heavier keys
    facts are reduced to their distinct (key, time), events to the highest values at one; these meet
    in time slices, and the answer is joined back to the facts on (key, time). Linear in facts plus
    events, whatever a key holds. Facts without a key or time look for nothing and are dealt by their other columns.
    Events are staged and the rows of a key counted when the join is built.

    ``few_known`` is for wide facts most of whose keys have no event: these stay out of every shuffle. The keys
    of the events are gathered for it right away, and used if they fit a broadcast.
    """
    happened = events.where(F.col(event_key).isNotNull() & F.col(event_ts).isNotNull()).select(
        F.col(event_key).alias("_key"), F.col(event_ts).alias("_at"), F.struct(F.col(event_ts).alias("at"), *values).alias("_event")
    )
    happened = stage(happened, "events")
    names = facts.columns if out in facts.columns else [*facts.columns, out]
    facts = facts.drop(out)
    apart = []
    if few_known:
        known = if_few(happened.select(F.col("_key").alias("_known")).distinct(), "known-keys")
        if known is not None:
            has_events = F.col(key) == F.col("_known")
            apart.append(facts.join(known, has_events, "left_anti"))
            facts = facts.join(known, has_events, "left_semi")
    looks = F.col(key).isNotNull() & F.col(ts).isNotNull()
    crowded = heavy(facts.where(looks).select(F.col(key).alias("_key")).unionByName(happened.select("_key")))
    light, before = facts, happened
    if crowded is not None:
        mine, its = looks & (F.col(key) == F.col("_again")), F.col("_key") == F.col("_again")
        light, before = facts.join(crowded, mine, "left_anti"), happened.join(crowded, its, "left_anti")
        apart.append(_asof_sliced(facts.join(crowded, mine, "left_semi"), happened.join(crowded, its, "left_semi"), key, ts, out, seconds))
    hashed = [f.name for f in facts.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    placed = light.withColumns(
        {"_asof_key": F.col(key), "_asof_at": F.col(ts), "_asof_apart": F.when(~looks, F.xxhash64(*hashed)), "_asof_fact": F.lit(True)}
    )
    rising = before.select(
        F.col("_key").alias("_asof_key"), F.col("_at").alias("_asof_at"), F.lit(False).alias("_asof_fact"), F.col("_event").alias("_asof_event")
    )
    # An event at a fact's own time sorts before it, the highest of several last.
    upto = W.partitionBy("_asof_key", "_asof_apart").orderBy("_asof_at", "_asof_fact", "_asof_event").rowsBetween(W.unboundedPreceding, 0)
    both = placed.unionByName(rising, allowMissingColumns=True)
    joined = both.withColumn(out, F.last("_asof_event", ignorenulls=True).over(upto)).where("_asof_fact").select(*names)
    for more in apart:
        joined = joined.unionByName(more, allowMissingColumns=True)
    return joined


def _asof_sliced(facts: DataFrame, happened: DataFrame, key: str, ts: str, out: str, seconds: int) -> DataFrame:
    """``asof_join`` of keys with any number of rows; all facts have a key and a time."""
    points = facts.groupBy(F.col(key).alias("_key"), F.col(ts).alias("_at")).agg(F.lit(True).alias("_is_fact"))
    moments = happened.groupBy("_key", "_at").agg(F.max("_event").alias("_event"))
    both = with_slice(points.unionByName(moments, allowMissingColumns=True), "_at", seconds)
    # An event at a fact's own time sorts before it.
    placed = both.withColumn("_rank", F.coalesce(F.col("_is_fact"), F.lit(False)))
    known = last_known(placed, ["_key"], ["_at", "_rank"], {out: (F.col("_event"), True)})
    answers = known.where("_is_fact").select(
        F.col("_key").alias("_a_key"), F.col("_at").alias("_a_at"), F.col(out).alias("_a_out")
    )
    match = (F.col(key) == F.col("_a_key")) & (F.col(ts) == F.col("_a_at"))
    return facts.join(answers, match, "left").withColumn(out, F.col("_a_out")).drop("_a_key", "_a_at", "_a_out")


def pit_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    out: str,
    version_key: str = "customer_id",
    value: str = "customer_key",
    unknown: int | None = K.UNKNOWN_KEY,
    seconds: int = SLICE_SECONDS,
    few_known: bool = False,
) -> DataFrame:
    """Value of the version valid at the fact's time, on the half-open [valid_from, valid_to).

    The versions of a key must not overlap, so only the latest one that has begun can be valid;
    ``pit_join_overlapping`` is for versions that may. ``few_known`` as in ``asof_join``.
    """
    joined = asof_join(
        facts, versions, key, ts, version_key, "valid_from", [value, "valid_to"], "_hit", seconds, few_known
    )
    found = F.when(F.col(ts) < F.col("_hit.valid_to"), F.col(f"_hit.{value}"))
    if unknown is not None:
        found = F.coalesce(found, F.lit(unknown))
    return joined.withColumn(out, found).drop("_hit")


GRID = 8  # cells of a level that one of the next level covers


def _at_level(level: int):
    return lambda cell: F.struct(F.lit(level).alias("level"), cell.alias("cell"))


def _cells(low, high, levels: int):
    """Cells of a time grid that together cover slices low .. high - 1: (level, cell) structs, few for long spans."""
    parts = []
    for level in range(levels):
        unit = GRID**level
        first, last = F.ceil(low / unit), F.floor(high / unit)
        spans = [(first, last)]
        if level + 1 < levels:
            # What whole cells of the next level cover is left to it.
            inner, outer = F.ceil(low / (unit * GRID)) * GRID, F.floor(high / (unit * GRID)) * GRID
            some = inner < outer
            spans = [(first, F.when(some, inner).otherwise(last)), (F.when(some, outer).otherwise(last), last)]
        for begin, end in spans:
            cells = F.when(begin < end, F.sequence(begin, end - 1)).otherwise(F.array().cast("array<bigint>"))
            parts.append(F.transform(cells, _at_level(level)))
    return F.flatten(F.array(*parts))


def pit_join_overlapping(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    out: str,
    version_key: str = "customer_id",
    value: str = "customer_key",
    start: str = "valid_from",
    end: str = "valid_to",
    prefer: list[str] | None = None,
    unknown: int | None = K.UNKNOWN_KEY,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Value of the best version valid at the fact's time; the versions of a key may overlap as they like.

    Of several valid versions the one with the highest ``prefer`` (latest start, then value) is taken. A NULL
    end is open; facts and versions without a key or time find nothing.

    A version fills whole cells of a time grid, small at its ends and larger towards its middle, and parts of
    the time slices of its first and last moment. In whole cells only the best version of a key can win, so
    these are reduced to one row a cell before they meet the facts, one lookup per level. Only versions that
    begin or end within a slice are compared with its facts one by one. A key's rows spread over its cells.
    """
    order = prefer or [start, value]
    points = facts.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_at")
    )
    points = points.distinct()
    width = seconds * 1_000_000
    # Versions matter within the facts' time only.
    times = points.agg(F.min("_at").alias("low"), F.max("_at").alias("high")).first()
    floor, ceiling = (times["low"] or 0), (times["high"] or 0) + 1
    first_slice, slices = floor // width, ceiling // width - floor // width + 1
    levels = 1
    while GRID**levels < slices:
        levels += 1

    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    known = versions.where(F.col(version_key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(version_key).alias("_key"),
        F.greatest(micros(start), F.lit(first_slice * width)).alias("_from"),
        F.least(F.coalesce(micros(end), F.lit(ceiling)), F.lit((first_slice + slices) * width)).alias("_to"),
        F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(value).alias("value")).alias("_best"),
    )
    known = known.where(F.col("_from") < F.col("_to"))
    slice_of = lambda c: F.floor(c / width) - first_slice
    low, high = F.ceil(F.col("_from") / width) - first_slice, slice_of(F.col("_to"))
    whole = (
        known.select("_key", F.explode(F.when(low < high, _cells(low, high, levels))).alias("c"), "_best")
        .select("_key", "c.level", "c.cell", "_best")
        .groupBy("_key", "level", "cell")
        .agg(F.max("_best").alias("_best"))
    )
    ends = F.array_distinct(F.array(slice_of(F.col("_from")), slice_of(F.col("_to"))))
    partly = F.filter(ends, lambda s: (s < low) | (s >= high))
    parts = known.select("_key", F.explode(partly).alias("cell"), "_best", "_from", "_to")

    # Two joins, since whole cells already lie by the columns they are looked up by. Spark's size check does not
    # see how many cells a version fills, so it must not take the cells for a small side.
    whole, parts = whole.hint("merge"), parts.hint("merge")
    mine = slice_of(F.col("_at"))
    asked = F.array(*[F.struct(F.lit(n).alias("level"), F.floor(mine / GRID**n).alias("cell")) for n in range(levels)])
    looked = points.select("_key", "_at", F.explode(asked).alias("a")).select("_key", "_at", "a.level", "a.cell")
    inside = (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    within = points.withColumn("cell", mine).join(parts, ["_key", "cell"]).where(inside).select("_key", "_at", "_best")
    answers = (
        looked.join(whole, ["_key", "level", "cell"]).select("_key", "_at", "_best").unionByName(within)
        .groupBy(F.col("_key").alias("_a_key"), F.col("_at").alias("_a_at"))
        .agg(F.max("_best").alias("_best"))
    )
    match = (F.col(key) == F.col("_a_key")) & (F.unix_micros(F.col(ts).cast("timestamp")) == F.col("_a_at"))
    found = F.col("_best.value") if unknown is None else F.coalesce("_best.value", F.lit(unknown))
    return facts.join(answers, match, "left").withColumn(out, found).drop("_a_key", "_a_at", "_best")


def asof_recompute(
    facts: DataFrame,
    events: DataFrame,
    attrs: list[str],
    id_col: str = "event_id",
    key: str = "customer_id",
    ts: str = "event_ts",
    changed_at: str = "changed_at",
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Attributes at fact time straight from the change events, without the version history."""
    joined = asof_join(
        facts.select(id_col, key, ts), events, key, ts, key, changed_at, attrs, "_hit", seconds
    )
    return joined.where(F.col("_hit").isNotNull()).select(
        id_col, *[F.col(f"_hit.{a}").alias(f"expected_{a}") for a in attrs]
    )


def lookup(df: DataFrame, dim: DataFrame, column: str, dim_column: str, take: list[str]) -> DataFrame:
    """Left join to a dimension on one column; an unknown value gives NULL."""
    right = dim.select(F.col(dim_column).alias("_d_key"), *take)
    return df.join(right, F.col(column) == F.col("_d_key"), "left").drop("_d_key")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact key values missing in the dimension, with their row counts.

    The fact is counted per key first, so a key that most rows share is one row in the join.
    """
    counted = fact.groupBy(F.col(fk).alias("fk_value")).agg(F.count(F.lit(1)).alias("fact_rows"))
    return counted.join(dim.select(F.col(pk).alias("_pk")), F.col("fk_value") == F.col("_pk"), "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, fk: str, pk: str, name: str) -> DataFrame:
    return orphans(fact, dim, fk, pk).agg(F.coalesce(F.sum("fact_rows"), F.lit(0)).alias(name))


def mismatch_count(a: DataFrame, b: DataFrame, key: str, cols: dict[str, str], name: str) -> DataFrame:
    """Matched rows of two derivations where any pair of columns differs (NULL never differs)."""
    left = a.groupBy(key, *cols.keys()).agg(F.count(F.lit(1)).alias("_n_a"))
    right = b.groupBy(F.col(key).alias("_b_key"), *[F.col(c).alias(f"_b_{c}") for c in cols.values()])
    right = right.agg(F.count(F.lit(1)).alias("_n_b"))
    differs = reduce(lambda x, y: x | y, [F.col(c) != F.col(f"_b_{d}") for c, d in cols.items()])
    joined = left.join(right, F.col(key) == F.col("_b_key"))
    pairs = F.when(differs, F.col("_n_a") * F.col("_n_b")).otherwise(0)
    return joined.agg(F.coalesce(F.sum(pairs), F.lit(0)).alias(name))


def overlap_count(a: DataFrame, b: DataFrame, key: str, name: str = "overlap") -> DataFrame:
    """Rows an inner join on the key would give, without producing them."""
    left = a.groupBy(key).agg(F.count(F.lit(1)).alias("_n_a"))
    right = b.groupBy(key).agg(F.count(F.lit(1)).alias("_n_b"))
    total = F.sum(F.col("_n_a") * F.col("_n_b"))
    return left.join(right, key).agg(F.coalesce(total, F.lit(0)).alias(name))


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows that carry the newest value of ``ts``."""
    newest = df.agg(F.max(ts).alias("_newest"))  # one row, so broadcasting it is always safe
    return df.join(F.broadcast(newest), F.col(ts) == F.col("_newest")).drop("_newest")


def newest(df: DataFrame, ts: str) -> DataFrame:
    return df.orderBy(F.desc(ts)).limit(1)


def manifest_compare(
    measured: DataFrame, manifest: DataFrame, pairs: dict[str, tuple[str, str]], on: str = "feed_date"
) -> DataFrame:
    """One row: per name, the days whose measured column differs from the manifest's column."""
    theirs = manifest.select(F.col(on).alias("_day"), *[F.col(m).alias(f"_m_{m}") for m in {m for _, m in pairs.values()}])
    joined = measured.join(theirs, F.col(on) == F.col("_day"))
    return joined.agg(
        *[F.count_if(F.col(c) != F.col(f"_m_{m}")).alias(name) for name, (c, m) in pairs.items()]
    )
