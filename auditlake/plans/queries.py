"""The registered queries: every operator bound to the benchmark tables.

Each takes (spark, sf_dir) and reads whole tables. Results are made portable at the very end:
money as double, times and dates as text, lists joined, so another engine can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
    TimestampType,
)

from auditlake import constants as K
from auditlake.functions import content_id, strict_ts
from auditlake.operators import cdc, joins, keyed, kpis, metrics, quality, reconcile, scan, shape, star, suites
from auditlake.operators.rules import DATASETS, expectations
from auditlake.plans import bindings as B
from auditlake.plans.world import BURST_COUNT, BURST_MINUTES, FREQUENT, HUB_SENDERS, HUB_TRANSFERS, NIGHT_AMOUNT, OUTPUT_DROPS, World
from auditlake.session import prepare, scratch_dir, stage
from auditlake.sources import files, layouts, ranged, reference, sinks
from auditlake.streaming import flows, gated, layers, maintained, pinned, runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RULES = (BURST_MINUTES, BURST_COUNT, NIGHT_AMOUNT)

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def portable(df: DataFrame) -> DataFrame:
    def convert(field):
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, DecimalType):
            col = col.cast("double")
        elif isinstance(kind, TimestampType):
            col = F.date_format(col, TS_TEXT)
        elif isinstance(kind, DateType):
            col = col.cast("string")
        elif isinstance(kind, (ByteType, ShortType, IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, ArrayType):
            col = F.concat_ws(",", col)
        return col.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


# ---- KPIs, rules, unusual activity -------------------------------------------------------------


@query
def kpi_daily(spark, sf):
    return World(spark, sf).kpi_daily


@query
def kpi_by_type(spark, sf):
    w = World(spark, sf)
    return kpis.kpi_by_type(w.fact, w.dim_type)


@query
def kpi_by_band(spark, sf):
    return kpis.kpi_by_band(World(spark, sf).fact)


@query
def kpi_by_hour(spark, sf):
    return kpis.kpi_by_hour(World(spark, sf).fact)


@query
def rule_effectiveness(spark, sf):
    return kpis.rule_effectiveness(World(spark, sf).fact)


@query
def unusual_senders(spark, sf):
    return kpis.unusual_senders(World(spark, sf).fact, FREQUENT)


@query
def unusual_recipients(spark, sf):
    w = World(spark, sf)
    return kpis.unusual_recipients(w.fact, w.dim_type, HUB_TRANSFERS, HUB_SENDERS)


@query
def unusual_activity(spark, sf):
    return World(spark, sf).unusual


@query
def unusual_activity_default(spark, sf):
    """The same with every threshold at its default."""
    w = World(spark, sf)
    fact = star.fact_transactions(w.transactions, w.dim_type, staged=True)
    return kpis.unusual_activity(fact, w.dim_type)


@query
def fact_transactions(spark, sf):
    """The fact with the versions both parties had at event time (their start, not the hash key)."""
    w = World(spark, sf)
    dim = w.dim_customer.select("customer_id", "valid_from", "valid_to")
    of = {"value": "valid_from", "unknown": None, "few_known": True}
    sent = joins.pit_join(stage(w.fact, "fact"), dim, "customer_id", "event_ts", "origin_from", **of)
    return joins.pit_join(sent, dim, "counterparty_id", "event_ts", "counterparty_from", **of)


def _clicks_within(spark, sf, seconds):
    events = B.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    is_click = F.col("event_type") == "click"
    return keyed.count_within(events, "user_id", "ts", is_click, seconds, seconds, "clicks_nearby").select(
        "event_id", "clicks_nearby"
    )


@query
def count_within(spark, sf):
    return _clicks_within(spark, sf, 6 * 3600)


@query
def count_within_default(spark, sf):
    return _clicks_within(spark, sf, K.BURST_MINUTES * 60)


# ---- Shaping -----------------------------------------------------------------------------------


@query
def unify_sources(spark, sf):
    return World(spark, sf).unified.drop("_source_file")


@query
def content_ids(spark, sf):
    """Null-safe ids over order columns, with a NULL in every third row's second column."""
    o = B.table(spark, sf, "orders")
    maybe = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    columns = [F.col("o_orderkey"), maybe, F.col("o_orderstatus")]
    return o.select("o_orderkey", content_id(columns, "O", 16, null_safe=True).alias("order_id"))


@query
def strict_timestamps(spark, sf):
    feed = B.raw_feed(spark, sf)
    return feed.select("event_id", "event_ts", strict_ts(F.col("event_ts")).alias("parsed"))


def _tagged_feed(spark, sf):
    return shape.map_feed(B.raw_feed(spark, sf, status_defects=True))


@query
def tag_failures(spark, sf):
    return _tagged_feed(spark, sf).select("event_id", "failed_checks", "_ingested_at")


@query
def split_valid(spark, sf):
    return shape.split_valid(_tagged_feed(spark, sf)).select("event_id", "event_ts", "amount", "status")


@query
def quarantine(spark, sf):
    rows = shape.quarantine(shape.unify([_tagged_feed(spark, sf)]))
    field = lambda name: F.get_json_object("raw_record", f"$.{name}").alias(name)
    return rows.select(
        "event_id",
        "failed_checks",
        *[field(n) for n in ("event_ts_raw", "txn_type", "customer_id", "status", "is_fraud")],
        F.from_json("raw_record", "amount DECIMAL(18,2)")["amount"].alias("amount"),
        F.array_size(F.json_object_keys("raw_record")).alias("n_fields"),
    )


# ---- Expectations and quality history ----------------------------------------------------------


@query
def expectations_report(spark, sf):
    """All rules of all tables over the staged layers."""
    w = World(spark, sf, staged=True)
    tables = world_tables(w)
    bounds = {"first_day": "1996-01-01", "last_day": "2024-01-20", "history": K.HISTORY_SOURCE}
    found = [
        quality.expectation_metrics(tables[name], expectations(name, **bounds), name, "update-1")
        for name in DATASETS
    ]
    return reduce(DataFrame.unionByName, found)


def world_tables(w: World) -> dict[str, DataFrame]:
    """The bound layers by dataset name."""
    return {
        "bronze.bank_holidays_raw": w.payloads,
        "bronze.customer_profile_changes": w.profile,
        "bronze.history_transactions": w.history,
        "bronze.transactions_daily": w.feed,
        "silver.bank_holidays": w.holidays,
        "silver.customer_profile_events": w.profile_events,
        "silver.transactions": w.transactions,
        "silver.transactions_quarantine": w.quarantine,
        "gold.dim_customer": w.dim_customer,
        "gold.dim_date": w.dim_date,
        "gold.dim_type": w.dim_type,
        "gold.fact_transactions": w.keyed_fact,
        "gold.kpi_daily": w.kpi_daily,
        "gold.reconciliation": reconcile.control_totals(audit_tables(w, reconcile.TABLES)),
        "gold.unusual_activity": w.unusual,
    }


AUDITED = {
    "feed": "feed",
    "history": "history",
    "profile": "profile",
    "payloads": "payloads",
    "manifests": "manifests",
    "profile_landing": "profile_files",
    "history_landing": "history_files",
    "feed_landing": "feed_files",
    "profile_events": "profile_events",
    "transactions": "transactions",
    "quarantine": "quarantine",
    "holidays": "holidays",
    "fact": "keyed_fact",
    "dim_customer": "dim_customer",
    "dim_date": "dim_date",
    "dim_type": "dim_type",
    "kpi_daily": "kpi_daily",
    "unusual": "unusual",
}


def audit_tables(w: World, names: tuple[str, ...] = tuple(AUDITED)) -> dict[str, DataFrame]:
    """The tables the control totals and the check suites read; those not named are not built."""
    return {name: getattr(w, AUDITED[name]) for name in names}


@query
def expectations_drop(spark, sf):
    """DROP keeps the rows every rule accepts."""
    rules = [
        quality.Expectation("positive_amount", "amount > 0", quality.DROP),
        quality.Expectation("known_customer", "customer_id IS NOT NULL", quality.DROP),
        quality.Expectation("has_label", "is_fraud IS NOT NULL", quality.WARN),
    ]
    kept = quality.drop_violations(B.raw_feed(spark, sf), rules)
    return kept.select("event_id", "amount", "_ingested_at")


def _daily_checks(spark, sf):
    """Check rows of one run per feed day, from the feed and its manifest."""
    measured = quality.measure_defects(B.raw_feed(spark, sf), quality.defect_rules())
    manifest = B.manifests(spark, sf).select("feed_date", "clean_rows", "rows_written", F.col("null_field").alias("m_null"))
    joined = measured.join(manifest, "feed_date")
    check = lambda suite, name, e, a: F.struct(
        F.lit(suite).alias("suite"),
        F.lit(name).alias("check_name"),
        F.col(e).cast("decimal(28,2)").alias("expected"),
        F.col(a).cast("decimal(28,2)").alias("actual"),
        (F.col(e) == F.col(a)).alias("passed"),
    )
    rows = F.explode(
        F.array(
            check("rows", "lines", "rows_written", "bronze_rows"),
            check("rows", "no duplicates", "clean_rows", "bronze_rows"),
            check("defects", "nulls", "m_null", "null_field"),
        )
    )
    return joined.select("feed_date", rows.alias("c")).select("feed_date", "c.*")


def _check_results(spark, sf):
    return quality.result_rows(_daily_checks(spark, sf), F.col("feed_date"), "run-1")


@query
def check_results(spark, sf):
    return _check_results(spark, sf)


@query
def check_scorecard(spark, sf):
    return quality.check_scorecard(_check_results(spark, sf))


@query
def check_history(spark, sf):
    return quality.check_history(_check_results(spark, sf))


@query
def expectation_scorecard(spark, sf):
    measured = quality.measure_defects(B.raw_feed(spark, sf), quality.defect_rules())
    names = list(quality.defect_rules())
    rows = F.explode(
        F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("failed_records")) for n in names])
    )
    results = measured.select("feed_date", "bronze_rows", rows.alias("r")).select(
        F.col("feed_date").cast("timestamp").alias("run_at"),
        F.lit("feed").alias("dataset"),
        "r.expectation",
        (F.col("bronze_rows") - F.col("r.failed_records")).alias("passed_records"),
        "r.failed_records",
    )
    return quality.expectation_scorecard(results)


@query
def latest_expectations(spark, sf):
    """Two flows per update; an update is a feed day."""
    feed = B.raw_feed(spark, sf)
    rules = quality.defect_rules()
    flows = feed.groupBy(F.to_date("_source_modified_at").alias("update_at"), (F.hour("_ingested_at") == 6).alias("first")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(n) for n, c in rules.items()]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("failed")) for n in rules]))
    log = flows.select("update_at", "n", rows.alias("r")).select(
        "update_at",
        F.col("update_at").cast("string").alias("update_id"),
        F.lit("feed").alias("dataset"),
        "r.expectation",
        (F.col("n") - F.col("r.failed")).alias("passed_records"),
        F.col("r.failed").alias("failed_records"),
    )
    return quality.latest_expectations(log)


@query
def quarantine_summary(spark, sf):
    return quality.quarantine_summary(shape.quarantine(shape.unify([_tagged_feed(spark, sf)])))


@query
def measure_defects(spark, sf):
    return quality.measure_defects(B.raw_feed(spark, sf), quality.defect_rules())


@query
def manifest_compare(spark, sf):
    measured = quality.measure_defects(B.raw_feed(spark, sf), quality.defect_rules())
    pairs = {
        "days_rows_differ": ("bronze_rows", "rows_written"),
        "days_events_differ": ("distinct_events", "clean_rows"),
        "days_with_duplicates": ("bronze_rows", "clean_rows"),
        "days_nulls_differ": ("null_field", "null_field"),
    }
    return joins.manifest_compare(measured, B.manifests(spark, sf), pairs)


@query
def fingerprint(spark, sf):
    history = B.raw_history(spark, sf)
    columns = ["step", "type", "amount", "nameOrig", "nameDest", "oldbalanceOrg", "isFraud", "_rescued_data"]
    return quality.fingerprint(history, columns, "sha256")


@query
def fingerprint_native(spark, sf):
    """Spark's own hash as a fingerprint: the same after reordering, another one after one edit."""
    line = B.table(spark, sf, "lineitem")
    edited = F.when((F.col("l_orderkey") == F.lit(1)) & (F.col("l_linenumber") == 1), F.col("l_quantity") + 1)
    prints = {
        "given": line,
        "reordered": line.repartition("l_partkey").sortWithinPartitions(F.desc("l_extendedprice")),
        "edited": line.withColumn("l_quantity", F.coalesce(edited, F.col("l_quantity"))),
    }
    rows = [quality.fingerprint(df, line.columns).withColumnsRenamed({"row_count": f"{k}_rows", "content_hash": k}) for k, df in prints.items()]
    one = F.broadcast(rows[0]).join(F.broadcast(rows[1])).join(F.broadcast(rows[2]))  # three single rows
    return one.select(
        F.col("given_rows").alias("row_count"),
        (F.col("given") == F.col("reordered")).alias("same_when_reordered"),
        (F.col("given") != F.col("edited")).alias("other_when_edited"),
    )


# ---- Change data -------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query
def scd1_lineitem(spark, sf):
    line = B.table(spark, sf, "lineitem")
    return cdc.scd1(line, LINE_KEYS, "l_shipdate", ["l_linestatus"], LINE_TIES)


MICRO_BATCHES = 4


def _bytes_per_trigger(spark, path: str, glob: str = "part-*") -> int:
    """A quarter of what has landed, so that every scale gives several micro-batches."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return max(1, (sizes.agg(F.sum("length")).first()[0] or 0) // MICRO_BATCHES)


def _landed(spark, df: DataFrame, label: str, by: tuple[str, ...] = ()) -> str:
    path = scratch_dir(spark, label)
    n = max(MICRO_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (df.repartitionByRange(n, *by) if by else df.repartition(n)).write.parquet(path)
    return path


def _stream(spark, df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """A landed copy of a table as a stream of several micro-batches."""
    path = path or _landed(spark, df, label)
    return spark.readStream.schema(df.schema).option("maxBytesPerTrigger", _bytes_per_trigger(spark, path)).parquet(path)


@query
def scd1_stream(spark, sf):
    line = B.table(spark, sf, "lineitem")
    target, checkpoint = scratch_dir(spark, "scd1"), scratch_dir(spark, "scd1-checkpoint")
    changes = _stream(spark, line, "lineitem")
    runs.scd1_stream(changes, LINE_KEYS, "l_shipdate", target, checkpoint, LINE_TIES)
    return runs.scd1_current(spark, target, line.schema, LINE_KEYS, "l_shipdate", ["l_linestatus"], LINE_TIES)


def _kept_lines(spark, sf) -> str:
    """Lines kept up by key: most arrive beside their neighbours, every sixteenth late and out of order."""
    line = B.table(spark, sf, "lineitem")
    late = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 16 == 0
    path = _landed(spark, line.where(~late), "lineitem", by=("l_orderkey",))
    target, checkpoint = scratch_dir(spark, "kept-lines"), scratch_dir(spark, "kept-checkpoint")
    rows_per_file = max(1, min(ranged.ROWS_PER_FILE, line.count() // 24))

    def keep_up():
        changes = _stream(spark, line, "lineitem", path)
        maintained.scd1_maintained(changes, LINE_KEYS, "l_shipdate", target, checkpoint, LINE_TIES, rows_per_file)

    keep_up()
    # The late lines land afterwards, in as many files as they were read in, and the stream goes on.
    line.where(late).write.mode("append").parquet(path)
    keep_up()
    return target


@query
def scd1_maintained(spark, sf):
    schema = B.table(spark, sf, "lineitem").schema
    return maintained.scd1_maintained_current(spark, _kept_lines(spark, sf), schema, ["l_linestatus"])


@query
def scd1_maintained_batches(spark, sf):
    """Rows that keeping the lines up has left, and whether most batches left most files alone."""
    batches = ranged.states(spark, _kept_lines(spark, sf))
    spared = (F.col("files_stored") > 0) & (2 * F.col("files_rewritten") < F.col("files_stored"))
    return batches.agg(
        F.max_by("rows_now", "batch_id").alias("row_count"),
        (F.count(F.lit(1)) >= 4).alias("several_batches"),
        (F.count_if(spared) >= 3).alias("left_files_alone"),
    )


@query
def split_stream(spark, sf):
    """Two flows in, two sinks out; the result counts both sinks."""
    flows = shape.unify(
        [
            shape.map_feed(_stream(spark, B.raw_feed(spark, sf, status_defects=True), "feed")),
            shape.map_history(_stream(spark, B.raw_history(spark, sf), "history"), B.ANCHOR),
        ]
    )
    clean, rejected = scratch_dir(spark, "clean"), scratch_dir(spark, "rejected")
    runs.split_stream(flows, clean, rejected, scratch_dir(spark, "split-checkpoint"))
    kept = runs.read_batches(spark, clean).select(
        F.lit("clean").alias("sink"), "source_system", F.lit("").alias("reasons"), "amount"
    )
    put_aside = runs.read_batches(spark, rejected).select(
        F.lit("quarantine").alias("sink"),
        "source_system",
        F.concat_ws(",", "failed_checks").alias("reasons"),
        F.from_json("raw_record", "amount DECIMAL(18,2)")["amount"].alias("amount"),
    )
    return kept.unionByName(put_aside).groupBy("sink", "source_system", "reasons").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount")
    )


ORDER_TRACK = ["segment", "region"]


@query
def scd2_orders_profile(spark, sf):
    return cdc.scd2(
        B.orders_profile(spark, sf), ["customer_id"], "changed_at", ORDER_TRACK, ["o_orderkey"], ["o_orderkey"]
    )


@query
def scd2_untracked(spark, sf):
    """Only the segment is tracked: the region shows its last value within each version."""
    return cdc.scd2(
        B.orders_profile(spark, sf), ["customer_id"], "changed_at", ["segment"], ["o_orderkey"], ["o_orderkey"]
    )


@query
def scd2_stream(spark, sf):
    profile = B.signup_profile(spark, sf)
    target, checkpoint = scratch_dir(spark, "scd2"), scratch_dir(spark, "scd2-checkpoint")
    changes = _stream(spark, profile, "profile")
    runs.scd2_stream(changes, ["customer_id"], "changed_at", ORDER_TRACK, target, checkpoint, ["event_id"])
    history = runs.scd2_current(
        spark, target, profile.schema, ["customer_id"], "changed_at", ORDER_TRACK, tie_break=["event_id"]
    )
    return history.drop("event_id")


@query
def scd2_maintained(spark, sf):
    """Order profiles as versions that every micro-batch cuts again for its own customers."""
    changes = B.orders_profile(spark, sf)
    target = scratch_dir(spark, "kept-history")
    maintained.scd2_maintained(
        _stream(spark, changes, "orders-profile"), ["customer_id"], "changed_at", ORDER_TRACK, target,
        scratch_dir(spark, "kept-checkpoint"), ["o_orderkey"],
    )
    return maintained.scd2_maintained_current(spark, target, changes.schema, "changed_at", ["o_orderkey"])


@query
def dim_customer(spark, sf):
    return World(spark, sf).dim_customer.drop("customer_key")


def _orders_history(spark, sf):
    history = cdc.scd2(
        B.orders_profile(spark, sf), ["customer_id"], "changed_at", ORDER_TRACK, ["o_orderkey"], ["o_orderkey"]
    )
    return history.withColumnsRenamed({"start_at": "valid_from"}).withColumn(
        "valid_to", F.coalesce("end_at", F.lit(K.OPEN_END).cast("timestamp"))
    )


def _shipped(spark, sf):
    """Lines with the customer of their order."""
    line = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query
def pit_join_lineitem(spark, sf):
    facts = _shipped(spark, sf)
    return joins.pit_join(facts, _orders_history(spark, sf), "o_custkey", "l_shipdate", "version_from", value="valid_from", unknown=None)


@query
def pit_join_linear(spark, sf):
    """The same by the form that allows versions to overlap."""
    facts = _shipped(spark, sf)
    return joins.pit_join_overlapping(
        facts, _orders_history(spark, sf), "o_custkey", "l_shipdate", "version_from", value="valid_from", unknown=None
    )


@query
def pit_join_overlapping(spark, sf):
    """Every order is a term of its customer, open or of some weeks; lines get the newest term they fall in."""
    orders = B.table(spark, sf, "orders")
    days = F.make_dt_interval(days=(F.col("o_orderkey") % 500).cast("int"))
    terms = orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("valid_from"),
        F.when(F.col("o_orderkey") % 50 != 7, F.col("o_orderdate") + days).alias("valid_to"),
        F.col("o_orderkey").alias("term"),
    )
    return joins.pit_join_overlapping(_shipped(spark, sf), terms, "o_custkey", "l_shipdate", "term", value="term", seconds=30 * 86_400)


@query
def pit_join_both_roles(spark, sf):
    """Sender and recipient versions of every event, -1 where there is none yet."""
    history = cdc.scd2(B.signup_profile(spark, sf), ["customer_id"], "changed_at", ORDER_TRACK, ["event_id"])
    versions = history.select(
        "customer_id",
        F.col("start_at").alias("valid_from"),
        F.coalesce("end_at", F.lit(K.OPEN_END).cast("timestamp")).alias("valid_to"),
        F.unix_micros("start_at").alias("version"),
    )
    e = B.table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )
    sent = joins.pit_join(e, versions, "user_id", "ts", "sender_version", value="version")
    return joins.pit_join(sent, versions, "k", "ts", "recipient_version", value="version")


@query
def late_change_diff(spark, sf):
    """Events whose version moves when every tenth change arrives late, with both answers."""
    profile = B.signup_profile(spark, sf)

    def versions(changes, name):
        cut = cdc.scd2(changes, ["customer_id"], "changed_at", ORDER_TRACK, ["event_id"])
        known = cut.select(
            "customer_id",
            F.col("start_at").alias("valid_from"),
            F.coalesce("end_at", F.lit(K.OPEN_END).cast("timestamp")).alias("valid_to"),
            F.unix_micros("start_at").alias(name),
        )
        return known

    e = B.table(spark, sf, "events").select("event_id", "user_id", "ts")
    on_time = versions(profile.where(F.col("event_id") % 10 != 3), "before_version")
    all_in = versions(profile, "after_version")
    both = joins.pit_join(e, on_time, "user_id", "ts", "before_version", value="before_version")
    both = joins.pit_join(both, all_in, "user_id", "ts", "after_version", value="after_version")
    return both.where(F.col("before_version") != F.col("after_version")).drop("ts")


@query
def asof_recompute(spark, sf):
    facts = B.table(spark, sf, "events").select("event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_ts"))
    return joins.asof_recompute(facts, B.signup_profile(spark, sf).drop("event_id"), ORDER_TRACK)


@query
def derivations_agree(spark, sf):
    """Attributes from the versions against attributes from the raw changes: how many differ."""
    facts = B.table(spark, sf, "events").select("event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_ts"))
    profile = B.signup_profile(spark, sf)
    recomputed = joins.asof_recompute(facts, profile.drop("event_id"), ORDER_TRACK)
    history = cdc.scd2(profile, ["customer_id"], "changed_at", ORDER_TRACK, ["event_id"]).select(
        "customer_id", "segment", "region", F.col("start_at").alias("valid_from"),
        F.coalesce("end_at", F.lit(K.OPEN_END).cast("timestamp")).alias("valid_to"),
    )
    versioned = joins.pit_join(facts, history.withColumn("pair", F.struct("segment", "region")), "customer_id", "event_ts", "v", value="pair", unknown=None)
    actual = versioned.where(F.col("v").isNotNull()).select("event_id", F.col("v.segment").alias("segment"), F.col("v.region").alias("region"))
    differ = joins.mismatch_count(recomputed, actual, "event_id", {"expected_segment": "segment", "expected_region": "region"}, "mismatches")
    return reconcile.one_row([differ, recomputed.agg(F.count(F.lit(1)).alias("recomputed")), actual.agg(F.count(F.lit(1)).alias("versioned"))])


@query
def scd2_integrity(spark, sf):
    """The dimension with every tenth known version ended a day early, so there is something to find."""
    dim = World(spark, sf).dim_customer
    early = (F.dayofmonth("valid_from") == 10) & (F.col("customer_key") != K.UNKNOWN_KEY)
    damaged = dim.withColumn("valid_to", F.when(early, F.col("valid_from") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to")))
    return cdc.scd2_integrity(damaged)


# ---- Calendar and payloads ---------------------------------------------------------------------


@query
def dim_date(spark, sf):
    """Calendar over the order dates, holidays from the newest order payloads."""
    days = reference.calendar_over(B.table(spark, sf, "orders"), "o_orderdate")
    return star.dim_date(days, cdc.snapshot_replace(B.order_payloads(spark, sf)))


@query
def type_lookup(spark, sf):
    """Feed rows per looked-up type; the unknown type has no key."""
    feed = B.raw_feed(spark, sf)
    found = joins.lookup(feed, reference.dim_type(spark), "type", "type_name", ["type_key", "category", "can_be_fraud"])
    return found.groupBy("type", "type_key", "category", "can_be_fraud").agg(F.count(F.lit(1)).alias("row_count"))


@query
def payload_to_rows(spark, sf):
    return cdc.explode_calendar(B.order_payloads(spark, sf))


@query
def snapshot_replace(spark, sf):
    return cdc.snapshot_replace(B.order_payloads(spark, sf))


@query
def holiday_flag(spark, sf):
    w = World(spark, sf)
    flagged = joins.with_holiday_flag(w.tagged, w.holidays)
    return flagged.groupBy("event_date", "is_bank_holiday").agg(F.count(F.lit(1)).alias("row_count"))


@query
def holiday_flag_stream(spark, sf):
    w = World(spark, sf)
    holidays = stage(w.holidays, "holidays")
    flow = shape.unify([shape.map_feed(_stream(spark, B.raw_feed(spark, sf), "feed"))])
    path = scratch_dir(spark, "flagged")
    runs.run_available(joins.with_holiday_flag(flow, holidays), path, scratch_dir(spark, "flag-checkpoint"))
    return spark.read.parquet(path).groupBy("event_date", "is_bank_holiday").agg(F.count(F.lit(1)).alias("row_count"))


@query
def holiday_versions(spark, sf):
    """Holidays added while a stream runs: its stored flags keep the version they saw, derived again or not, and
    only the calendar shows them. The first half of the feed arrives before the even days become holidays."""
    holidays = stage(World(spark, sf).holidays.where(F.col("division") == K.HEADLINE_DIVISION), "holidays")
    late = F.substring("event_id", -1, 1).isin("1", "3", "5", "7", "9")
    tagged = stage(shape.unify([shape.map_feed(B.raw_feed(spark, sf))]).select("event_id", "event_date"), "feed-days")
    side, landing, target, checkpoint = (scratch_dir(spark, n) for n in ("holiday-versions", "feed", "flagged", "flag-checkpoint"))
    with_file = lambda df: df.select("*", F.col("_metadata.file_path").alias("file"))
    flags = (side, holidays.schema, "event_date", "holiday_date", "is_bank_holiday", target)
    for known, arrived in ((holidays.where(F.dayofmonth("holiday_date") % 2 == 1), ~late), (holidays, late)):
        pinned.publish_side(known, side)
        tagged.where(arrived).repartition(MICRO_BATCHES).write.mode("append").parquet(landing)
        stream = with_file(_stream(spark, tagged, "feed", landing))
        pinned.flag_stream(stream, *flags, checkpoint, "file")
    stored = pinned.read_flagged(spark, target, stream.schema, "is_bank_holiday").withColumn("how", F.lit("stored"))
    source = with_file(spark.read.schema(tagged.schema).parquet(landing))
    again = pinned.replay(source, *flags, "file").withColumn("how", F.lit("derived again"))
    columns = ["how", "event_date", "side_version", "is_bank_holiday"]
    counted = stored.select(*columns).unionByName(again.select(*columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return pinned.with_match(counted, pinned.read_side(spark, side, holidays.schema), "event_date", "holiday_date", "holiday_now")


# ---- Reconciliation and suites -----------------------------------------------------------------


@query
def orphans(spark, sf):
    """Parts of the order lines that no event's user number covers, with their line counts."""
    known = B.table(spark, sf, "events").select("user_id").distinct()
    return joins.orphans(B.table(spark, sf, "lineitem"), known, "l_partkey", "user_id")


@query
def overlap(spark, sf):
    """Rows an inner join of lines and order-like events would give."""
    line = B.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    events = B.table(spark, sf, "events").select(F.col("user_id").alias("id"))
    return joins.overlap_count(line, events, "id")


@query
def control_totals(spark, sf):
    return reconcile.control_totals(audit_tables(World(spark, sf, staged=True), reconcile.TABLES))


@query
def reconcile_constraints(spark, sf):
    totals = reconcile.control_totals(audit_tables(World(spark, sf, staged=True), reconcile.TABLES))
    return reconcile.constraint_results(totals)


def bound_known(spark, sf) -> suites.Known:
    """What is known about the bound sources, counted from ``lineitem`` and ``nation`` alone."""
    li = B.table(spark, sf, "lineitem")
    kind, returned = F.col("l_linenumber") % 5, F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    shipped = F.date_trunc("day", "l_shipdate") + F.make_dt_interval(hours=F.col("l_suppkey") % 24)
    counted = li.agg(
        F.count(F.lit(1)).alias("history_rows"),
        F.count_if(kind.isin(1, 2) & returned).alias("history_fraud"),
        F.count_if((kind == 2) & returned & (quantity == 50)).alias("history_flagged"),
        F.count_if(kind.isin(1, 2) & (quantity == 1) & (F.col("l_partkey") % 500 != 0)).alias("history_drain"),
        F.min(shipped).alias("first_at"),
        F.max(shipped).alias("last_at"),
    )
    # Holidays that stayed, in the region of the headline division: one or two days a nation.
    nations = B.table(spark, sf, "nation").where((F.col("n_regionkey") % 3 == 0) & (F.col("n_nationkey") % 5 != 4))
    starts = F.array(*[F.date_add(F.lit(start).cast("date"), F.col("n_nationkey")) for start, _ in B.HOLIDAY_STARTS])
    days = nations.select(F.explode(starts).alias("day")).distinct()
    per_day = li.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    on_holidays = per_day.join(days, "day").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("holiday_rows"))
    headline = nations.agg(F.count(F.lit(1))).first()[0]
    return suites.Known(
        anchor=B.ANCHOR,
        last_step="the last",
        holiday_steps_label="1 June",
        payloads=len(B.HOLIDAY_STARTS),
        summer_holiday="1996-06-01",
        headline_year=1996,
        headline_holidays=headline,
        calendar_days=10958,
        history_drain=None,
        history_flagged=None,
        counted=reconcile.one_row([counted, on_holidays]),
    )


@query
def check_suites(spark, sf):
    w = World(spark, sf, staged=True)
    return suites.run_checks(audit_tables(w), bound_known(spark, sf))


# ---- Scans over documents ----------------------------------------------------------------------


@query
def validate_payloads(spark, sf):
    """Payloads made per order, each class of breach at its own orders."""
    o = B.table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    m = key % 11
    date = F.when(m == 4, F.date_format("o_orderdate", "dd/MM/yyyy")).when(m == 9, "2024-02-30").otherwise(day)
    title = F.when(m == 3, '"name"').otherwise('"title"')
    event = F.concat(
        F.lit("{"), title, F.lit(': "'), F.col("o_orderpriority"), F.lit('", "date": "'), date,
        F.lit('", "notes": "", "bunting": true}'),
    )
    events = F.when(m == 2, "[]").when(m == 7, '"none"').otherwise(F.concat(F.lit("["), event, F.lit("]")))
    region = lambda name, e: F.concat(F.lit(f'"{name}": {{"events": '), e, F.lit("}"))
    good = F.concat(F.lit("["), F.regexp_replace(F.regexp_replace(event, '"name"', '"title"'), '"date": "[^"]*"', '"date": "2024-01-01"'), F.lit("]"))
    body = F.concat_ws(
        ", ",
        region(K.DIVISIONS[0], good),
        F.when(m != 1, region(K.DIVISIONS[1], good)),
        region(K.DIVISIONS[2], events),
    )
    payload = F.when(m == 5, "not json").otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    return scan.validate_payloads(o.select("o_orderkey", payload.alias("payload")), "o_orderkey", "payload")


@query
def scan_lines(spark, sf):
    return scan.scan_lines(B.table(spark, sf, "documents"), "doc_id", "text")


@query
def scan_lines_pages(spark, sf):
    patterns = (r"https?://[a-z0-9.-]+", r"<script>")
    return scan.scan_lines(B.table(spark, sf, "pages"), "page_id", "html", patterns)


@query
def scan_lines_conversations(spark, sf):
    talks = B.table(spark, sf, "conversations")
    turns = talks.select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text")
    return scan.scan_lines(turns, "turn_id", "text", (r"(^|[ ,.])le([ ,.]|$)", r"(^|[ ,.])the([ ,.]|$)", r"[0-9]{2,}"))


@query
def profile_columns(spark, sf):
    """The feed as text, one number in every hundred unreadable and one with four decimals."""
    e = B.table(spark, sf, "events")
    m = F.col("event_id") % 100
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    rows = e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(m == 7, "n/a").when(m == 8, F.concat(amount, F.lit("55"))).when(m == 9, " ").otherwise(amount).alias("amount"),
        F.when(m != 3, F.col("event_type")).alias("event_type"),
        F.when(m == 4, "").otherwise(F.col("props")).alias("props"),
    )
    return scan.profile_columns(rows, numeric_text=("amount",))


@query
def profile_counts(spark, sf):
    history = B.raw_history(spark, sf)
    by = {
        "type": F.col("type"),
        "hour": (F.col("step") - 1) % 24,
        "day": F.floor((F.col("step") - 1) / 24),
        "recipient": F.left("nameDest", F.lit(1)),
    }
    return scan.profile_counts(history, by)


@query
def profile_distinct(spark, sf):
    line = B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    return scan.distinct_counts(line, line.columns)


@query
def duplicate_rows(spark, sf):
    feed = B.raw_feed(spark, sf).drop("_ingested_at")
    return scan.duplicate_rows(feed)


# ---- Landed files ------------------------------------------------------------------------------

LINE_CONTRACT = "row_id BIGINT, quantity INT, amount DECIMAL(18,2), shipped TIMESTAMP, flag STRING"


def _line_texts(spark, sf):
    """Lines as text columns; some values do not fit the contract, some use scientific notation."""
    li = B.table(spark, sf, "lineitem")
    key = F.col("l_partkey") * 10 + F.col("l_linenumber")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return li.select(
        key.cast("string").alias("row_id"),
        F.when(key % 13 == 5, "many").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(key % 17 == 3, "1.010284203E7").when(key % 17 == 4, "12,50").otherwise(amount).alias("amount"),
        F.when(key % 19 == 1, F.date_format("l_shipdate", "dd.MM.yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("shipped"),
        F.col("l_returnflag").alias("flag"),
    )


def _land_csv(spark, sf, parts: int | None = None) -> str:
    """``parts`` deals the rows to so many files at least, for streams of several micro-batches."""
    path = scratch_dir(spark, "landing-csv")
    texts = _line_texts(spark, sf)
    if parts:
        texts = texts.repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    texts.write.option("header", True).csv(path)
    return path


def _contract(spark, path, streaming, **options):
    return files.read_contract(
        spark, path, LINE_CONTRACT, streaming=streaming, timestamp_format=K.PROFILE_TS_FORMAT, tz="UTC", **options
    )


def _contract_report(df):
    kept = lambda name: F.get_json_object(files.RESCUE, f"$.{name}").alias(f"rescued_{name}")
    return df.groupBy(
        "quantity", "flag", F.col("amount").isNull().alias("no_amount"), F.to_date("shipped").alias("ship_day"),
        kept("quantity"), kept("amount"), F.get_json_object(files.RESCUE, "$.shipped").isNotNull().alias("shipped_rescued"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"))


@query
def read_contract(spark, sf):
    return _contract_report(_contract(spark, _land_csv(spark, sf), streaming=False))


@query
def read_contract_stream(spark, sf):
    landing, target = _land_csv(spark, sf, MICRO_BATCHES), scratch_dir(spark, "bronze")
    per_trigger = _bytes_per_trigger(spark, landing)
    runs.run_available(_contract(spark, landing, True, maxBytesPerTrigger=per_trigger), target, scratch_dir(spark, "bronze-checkpoint"))
    return _contract_report(spark.read.parquet(target))


FEED_HINTS = "event_id BIGINT, ts STRING, value DECIMAL(18,2), user_id BIGINT"


def _land_json(spark, sf) -> str:
    """Events as JSON lines: an earlier delivery, and a later one with a new field and misfits."""
    path = scratch_dir(spark, "landing-json")
    e = B.table(spark, sf, "events")
    base = [F.col("event_id"), F.date_format("ts", TS_TEXT).alias("ts"), F.col("user_id")]
    new = F.dayofmonth("ts") >= 16
    lines = lambda rows: rows.select(F.to_json(F.struct("*")).alias("value"))
    early = e.where(~new).select(*base, F.col("value").cast("decimal(18,2)").alias("value"))
    fits = e.where(new & (F.col("event_id") % 20 != 0)).select(
        *base, F.col("value").cast("decimal(18,2)").alias("value"), F.col("event_type").alias("channel")
    )
    misfits = e.where(new & (F.col("event_id") % 20 == 0)).select(*base, F.lit("lots").alias("value"), F.col("event_type").alias("channel"))
    for delivery in (lines(early), lines(fits), lines(misfits)):
        delivery.write.mode("append").option("compression", "none").text(path)
    return path


def _evolved_report(df):
    return df.select("event_id", "ts", "value", "user_id", "channel", F.get_json_object(files.RESCUE, "$.value").alias("rescued_value"))


@query
def read_evolving(spark, sf):
    return _evolved_report(files.read_evolving(spark, _land_json(spark, sf), FEED_HINTS, "*.txt", ["channel"]))


@query
def read_evolving_stream(spark, sf):
    landing, target = _land_json(spark, sf), scratch_dir(spark, "evolving")
    per_trigger = _bytes_per_trigger(spark, landing, "*.txt")
    checkpoint = scratch_dir(spark, "evolving-checkpoint")
    runs.ingest_evolving(spark, landing, FEED_HINTS, target, checkpoint, glob="*.txt", maxBytesPerTrigger=per_trigger)
    return _evolved_report(runs.read_evolved(spark, target, FEED_HINTS, ["channel"]))


@query
def unlisted_fields(spark, sf):
    """Fields that the hints do not list, with the rows that have them."""
    return files.unlisted_names(files.read_evolving(spark, _land_json(spark, sf), FEED_HINTS, "*.txt"))


@query
def expectations_stream(spark, sf):
    """Rules counted and applied batch by batch: counts over all batches, and the rows that were published."""
    rules = [
        quality.Expectation("positive_amount", "amount > 0", quality.DROP),
        quality.Expectation("known_customer", "customer_id IS NOT NULL", quality.DROP),
        quality.Expectation("has_label", "is_fraud IS NOT NULL", quality.WARN),
        quality.Expectation("named_source", "source_system IS NOT NULL", quality.FAIL),
    ]
    raw = B.raw_feed(spark, sf)
    target = scratch_dir(spark, "gated")
    gated.expect_stream(_stream(spark, raw, "feed"), rules, "feed", target, scratch_dir(spark, "gated-checkpoint"))
    counted = gated.batch_metrics(spark, target).groupBy("expectation").agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"),
        (F.countDistinct("batch_id") >= 4).alias("several_batches"),
    )
    published = gated.read_published(spark, target, raw.schema)
    kept = published.agg(F.count(F.lit(1)).alias("published_rows"), F.sum("amount").alias("published_amount"))
    return counted.join(F.broadcast(kept))  # one row


@query
def clustered_layout(spark, sf):
    """The fact written in clustered layout and read back for one year and type."""
    w = World(spark, sf)
    path = scratch_dir(spark, "clustered")
    sinks.write_clustered(w.fact, path, ["date_key", "type_key"], ["event_id"])
    wanted = F.col("date_key").between(19970101, 19971231) & (F.col("type_key") == 4)
    return spark.read.parquet(path).where(wanted).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount")
    )


@query
def read_payloads(spark, sf):
    """Calendar payloads, one file each, read whole; the holidays in them by division."""
    path = scratch_dir(spark, "payloads")
    named = B.raw_holidays(spark, sf).select("payload", F.element_at(F.split("_source_file", "/"), -1).alias("file"))
    named.write.partitionBy("file").text(path)
    rows = cdc.explode_calendar(files.read_payloads(spark, path, glob="*.txt"))
    return rows.groupBy("division").agg(F.count(F.lit(1)).alias("holidays"), F.min("holiday_date").alias("first_day"))


@query
def audit_columns(spark, sf):
    """Rows of a contract read that say which file they came from, of when, and when they were read."""
    df = _contract(spark, _land_csv(spark, sf), streaming=False)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("with_file"),
        F.count_if(F.col("_source_modified_at") <= F.current_timestamp()).alias("with_file_time"),
        F.count_if(F.col("_ingested_at").isNotNull()).alias("with_read_time"),
    )


@query
def rerun_without_new_files(spark, sf):
    """A stream run twice over the same files delivers every row once."""
    landing, target, checkpoint = _land_csv(spark, sf), scratch_dir(spark, "bronze"), scratch_dir(spark, "bronze-checkpoint")
    for _ in range(2):
        runs.run_available(_contract(spark, landing, streaming=True), target, checkpoint)
    return spark.read.parquet(target).agg(F.count(F.lit(1)).alias("row_count"))


@query
def rebuild(spark, sf):
    """Feed and clean rows derived again through streams; their fingerprints are those of a batch."""
    raw = B.raw_feed(spark, sf, status_defects=True)
    columns = ["event_id", "amount", "customer_id", "status"]

    def unified(before, target, checkpoint):
        runs.run_available(shape.unify([shape.map_feed(_stream(spark, raw, "feed"))]), target, checkpoint)

    def clean(before, target, checkpoint):
        known = spark.read.parquet(before["unified"]).schema
        flow = spark.readStream.schema(known).parquet(before["unified"])
        runs.run_available(shape.split_valid(flow), target, checkpoint)

    folders = runs.rebuild(spark, scratch_dir(spark, "layers"), {"unified": unified, "clean": clean})
    streamed = quality.fingerprint(spark.read.parquet(folders["clean"]), columns)
    batch = quality.fingerprint(shape.split_valid(shape.unify([shape.map_feed(raw)])), columns).withColumnsRenamed(
        {"row_count": "batch_rows", "content_hash": "batch_hash"}
    )
    both = F.broadcast(streamed).join(F.broadcast(batch))  # two single rows
    return both.select("row_count", (F.col("content_hash") == F.col("batch_hash")).alias("same_as_batch"))


@query
def rebuild_layers(spark, sf):
    """Unified rows, clean rows, fact and a KPI table derived in order; they are those of a batch, and a
    second call derives nothing."""
    w, root = World(spark, sf), scratch_dir(spark, "layers")
    sources = {"feed": _landed(spark, w.feed, "feed"), "history": _landed(spark, w.history, "history")}

    def unified(inputs, target, checkpoint):
        feed, history = (spark.readStream.schema(df.schema).parquet(inputs[n]) for n, df in (("feed", w.feed), ("history", w.history)))
        runs.run_available(shape.unify([shape.map_feed(feed), shape.map_history(history, B.ANCHOR)]), target, checkpoint)

    def clean(inputs, target, checkpoint):
        valid = shape.split_valid(spark.read.parquet(inputs["unified"]))
        cdc.scd1_rare(valid, ["event_id"], "_ingested_at", OUTPUT_DROPS).write.parquet(target)

    def fact(inputs, target, checkpoint):
        star.fact_transactions(spark.read.parquet(inputs["clean"]), w.dim_type, None, *RULES, True).write.parquet(target)

    def by_type(inputs, target, checkpoint):
        kpis.kpi_by_type(spark.read.parquet(inputs["fact"]), w.dim_type).write.parquet(target)

    # Given in no particular order: the inputs tell it.
    declared = [
        layers.Layer("by_type", ("fact",), by_type),
        layers.Layer("fact", ("clean",), fact),
        layers.Layer("unified", ("feed", "history"), unified),
        layers.Layer("clean", ("unified",), clean),
    ]
    first, again = (layers.refresh(spark, root, sources, declared) for _ in range(2))
    batch = {"unified": w.tagged, "clean": w.transactions, "fact": w.fact, "by_type": kpis.kpi_by_type(w.fact, w.dim_type)}
    hashes = [quality.fingerprint(df, df.columns).select(F.lit(n).alias("layer"), F.col("content_hash").alias("batch_hash")) for n, df in batch.items()]
    both = layers.state(spark, root).join(reduce(DataFrame.unionByName, hashes), "layer")
    return both.select(
        "layer", "row_count", (F.col("content_hash") == F.col("batch_hash")).alias("same_as_batch"),
        F.lit(",".join(first)).alias("derived_first"), F.lit(len(again)).alias("derived_again"),
    )


@query
def separate_flows(spark, sf):
    """The feed, and the history as a flow added later, each a stream of its own into one table."""
    target, checkpoints = scratch_dir(spark, "flows"), scratch_dir(spark, "flows-checkpoints")
    mapped = {
        "feed": shape.map_feed(_stream(spark, B.raw_feed(spark, sf, status_defects=True), "feed")),
        "history": shape.map_history(_stream(spark, B.raw_history(spark, sf), "history"), B.ANCHOR),
    }
    for names in (["feed"], ["feed", "history"]):
        flows.run_flows({n: mapped[n] for n in names}, K.UNIFIED_DDL, target, checkpoints)
    return flows.read_flows(spark, target, K.UNIFIED_DDL).groupBy("flow").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"), (F.countDistinct("batch_id") >= 4).alias("several_batches")
    )


@query
def quality_tables(spark, sf):
    """Check history appended to its table and read back through the scorecard view."""
    folder = scratch_dir(spark, "quality")
    schema = f"quality_{folder[-32:]}"
    sinks.ensure_quality_objects(spark, schema, folder)
    rows = _check_results(spark, sf)
    newest = rows.agg(F.max("run_at")).first()[0]
    for part in (rows.where(F.col("run_at") < F.lit(newest)), rows.where(F.col("run_at") >= F.lit(newest))):
        sinks.append_history(part, f"{schema}.{sinks.CHECK_TABLE}")
    sinks.append_history(part, f"{schema}.{sinks.CHECK_TABLE}")  # a retry
    sinks.ensure_quality_objects(spark, schema, folder)
    return spark.table(f"{schema}.check_scorecard")


@query
def recomputed_table(spark, sf):
    """A table replaced by its full recomputation, twice."""
    folder = scratch_dir(spark, "tables")
    schema = f"tables_{folder[-32:]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder}'")
    orders = B.table(spark, sf, "orders")
    for number in (1, 2):
        counted = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.lit(number).alias("version"))
        sinks.materialize(counted, f"{schema}.by_priority")
    return spark.table(f"{schema}.by_priority")


LAYOUT_KEYS = ["date_key", "type_key"]
LAYOUT_FILES = 16
LAYOUT_ROWS = 2_000_000


def _layout_files(spark, sf, least: int = LAYOUT_FILES) -> int:
    """Files of a layout of the fact: more for more rows, so that no task lays out more than some millions."""
    rows = sum(B.table(spark, sf, name).count() for name in ("events", "lineitem"))
    return max(least, -(-rows // LAYOUT_ROWS))


@query
def layout_report(spark, sf):
    """Rows a filter hits in the clustered fact, and whether it touches some but not all files."""
    path = scratch_dir(spark, "clustered")
    sinks.write_clustered(World(spark, sf).fact, path, ["date_key", "type_key"], ["event_id"], files=_layout_files(spark, sf, 8))
    report = sinks.layout_report(spark, path, "date_key BETWEEN 19970101 AND 19971231 AND type_key = 4")
    return report.select(
        "row_count",
        (F.col("files_touched") <= F.col("files")).alias("files_fit"),
        (F.col("files_touched") < F.col("files")).alias("files_skipped"),
        (F.col("bytes_touched") <= F.col("bytes")).alias("bytes_fit"),
    )


LAYOUT_FILTERS = {
    "one day": {"date_key": (19970310, 19970310)},
    "one week and type": {"date_key": (19970310, 19970316), "type_key": (4, 4)},
    "one type": {"type_key": (4, 4)},
    "everything": {},
}


def _within(ranges):
    return reduce(lambda a, b: a & b, [F.col(k).between(*ends) for k, ends in ranges.items()], F.lit(True))


@query
def curve_layout(spark, sf):
    """The fact along a curve over both keys: rows and amount per filter, and whether files are skipped."""
    path = scratch_dir(spark, "curve")
    layouts.write_curve(stage(World(spark, sf).fact, "laid-fact"), path, LAYOUT_KEYS, ["event_id"], files=_layout_files(spark, sf))
    pruned = layouts.pruning(layouts.footers(spark, path, LAYOUT_KEYS), LAYOUT_FILTERS)
    stored = spark.read.parquet(path)
    sums = [
        stored.where(_within(ranges)).agg(F.lit(name).alias("filter"), F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"))
        for name, ranges in LAYOUT_FILTERS.items()
    ]
    found = reduce(DataFrame.unionByName, sums).join(pruned, "filter")
    return found.select("filter", "row_count", "amount", (F.col("files_touched") < F.col("files")).alias("skips_files"))


@query
def layout_pruning(spark, sf):
    """What four filters read of four layouts of the fact, from the footers: rows asked for, whether files are
    skipped, and whether what is read holds all of them."""
    fact = stage(World(spark, sf).fact.withColumn("month_key", F.floor(F.col("date_key") / 100)), "laid-fact")
    files = _layout_files(spark, sf)
    path = {name: scratch_dir(spark, name) for name in ("plain", "partitioned", "clustered", "curve")}
    fact.repartition(files, F.xxhash64("event_id")).write.parquet(path["plain"])
    fact.repartitionByRange(files, "month_key", F.xxhash64("event_id")).write.partitionBy("month_key").parquet(path["partitioned"])
    sinks.write_clustered(fact, path["clustered"], LAYOUT_KEYS, ["event_id"], files=files)
    layouts.write_curve(fact, path["curve"], LAYOUT_KEYS, ["event_id"], files=files)
    reports = [
        layouts.pruning(layouts.footers(spark, at, LAYOUT_KEYS), LAYOUT_FILTERS).withColumn("layout", F.lit(name)) for name, at in path.items()
    ]
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.count_if(_within(r)).alias("row_count")) for n, r in LAYOUT_FILTERS.items()]))
    rows = fact.agg(asked.alias("a")).select("a.*")  # one row per filter
    found = reduce(DataFrame.unionByName, reports).join(rows, "filter")
    return found.select(
        "layout", "filter", "row_count",
        (F.col("files_touched") < F.col("files")).alias("skips_files"),
        (F.col("rows_touched") >= F.col("row_count")).alias("holds_all"),
    )


@query
def scan_documents(spark, sf):
    """Patterns bound to the ends of a line, on texts of many lines."""
    docs = B.table(spark, sf, "documents").select("doc_id", "text")
    return scan.scan_lines(docs, "doc_id", "text", ("^the ", "and\\.$", "^$"))


# ---- Metric layer ------------------------------------------------------------------------------

FEED_ONLY = {"source_system": K.FEED_SOURCE}


@query
def metric_tiles(spark, sf):
    return metrics.tiles(World(spark, sf).kpi_daily, FEED_ONLY)


@query
def metric_trend(spark, sf):
    return metrics.trend(World(spark, sf).kpi_daily, metrics.FRAUD_RATE, {**FEED_ONLY, "no_such_column": 1})


@query
def metric_by_type(spark, sf):
    w = World(spark, sf)
    return metrics.by_type(kpis.kpi_by_type(w.fact, w.dim_type), FEED_ONLY)


@query
def metric_by_hour(spark, sf):
    return metrics.by_hour(kpis.kpi_by_hour(World(spark, sf).fact), FEED_ONLY)


@query
def metric_rules(spark, sf):
    return metrics.rule_table(kpis.rule_effectiveness(World(spark, sf).fact), FEED_ONLY)


@query
def metric_range(spark, sf):
    """A measure over a range of days, by holiday flag."""
    days = {"date_key": (19960101, 20240115)}
    measures = [metrics.TRANSACTIONS, metrics.VALUE, metrics.APPROVAL_RATE]
    return metrics.metric_query(World(spark, sf).kpi_daily, ["source_system", "is_bank_holiday_eaw"], measures, days)


def _star(spark, sf, by, role="sender", **dims):
    w = World(spark, sf, staged=True)
    fact = w._fact(w.dim_customer)
    return metrics.star_metrics(fact, by, dim_customer=w.dim_customer, dim_type=w.dim_type, role=role, filters=FEED_ONLY, **dims)


@query
def star_metrics_sender(spark, sf):
    return _star(spark, sf, ["segment", "region"])


@query
def star_metrics_recipient(spark, sf):
    return _star(spark, sf, ["segment", "type_name"], role="recipient")


@query
def star_metrics_calendar(spark, sf):
    w = World(spark, sf)
    return metrics.star_metrics(w.fact, ["calendar_year", "day_part", "source_system"], dim_date=w.dim_date)


@query
def with_previous_day(spark, sf):
    """Daily history fraud rate; the history has days without rows."""
    daily = World(spark, sf).kpi_daily
    out = metrics.with_previous_day(daily, ["fraud_rate", "txn_count"], by=["source_system"])
    return out.select("calendar_date", "source_system", "fraud_rate", "previous_fraud_rate", "previous_txn_count")


@query
def newest_orders(spark, sf):
    """The newest order (one row), ties settled by key."""
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return joins.newest(o.withColumn("seq", F.struct("o_orderdate", "o_orderkey")), "seq").drop("seq")
