"""The benchmark tables seen as the canonical raw tables.

``events`` plays the daily feed and the profile changes, ``lineitem`` the step-based history,
``nation`` the holiday calendar, ``orders`` a second profile feed. Defects follow from the row id,
so the number of each is known without looking at the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake import constants as K

ANCHOR = "1995-01-01 00:00:00"
CALENDAR = ("1995-01-01", "2024-12-31")
INITIAL_DAY = "2024-01-01"
INITIAL_AT = "2023-12-31 00:00:00"
CHANNEL_FROM = "2024-01-16"
HOLIDAY_STARTS = (("2024-01-01", ""), ("1996-06-01", " SUMMER"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table with its wall-clock times read as UTC timestamps."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoned = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoned}) if zoned else df


def _event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "CAST(event_id % 100 AS INT) AS m",
        "CAST(value AS DECIMAL(18,2)) AS val",
        "to_date(ts) AS day",
    )


def raw_feed(spark: SparkSession, sf_dir: str, status_defects: bool = False) -> DataFrame:
    """``events`` as the daily feed, defects and duplicate deliveries included."""
    declined = "CASE WHEN k < 10 THEN 'DECLINED' ELSE 'APPROVED' END"
    status = f"CASE WHEN m = 5 THEN 'PENDING' ELSE {declined} END" if status_defects else declined
    before = "CASE WHEN event_id % 50 = 0 THEN val ELSE CAST(val * 2 AS DECIMAL(18,2)) END"
    delivered = _event_fields(spark, sf_dir).selectExpr(
        "*",
        f"{before} AS before",
        "explode(CASE WHEN m IN (10, 11) THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    return delivered.selectExpr(
        "concat('E', event_id) AS event_id",
        "CASE m WHEN 4 THEN '10:30' WHEN 24 THEN date_format(ts, 'yyyy-MM-dd') "
        "WHEN 44 THEN '2024-02-30T10:00:00Z' "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END AS event_ts",
        "CASE WHEN m = 3 THEN 'REFUND' ELSE CASE event_type WHEN 'click' THEN 'TRANSFER' "
        "WHEN 'error' THEN 'CASH_OUT' WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'CASH_IN' "
        "WHEN 'view' THEN 'DEBIT' END END AS type",
        "CASE m WHEN 1 THEN NULL WHEN 2 THEN CAST(-val AS DECIMAL(18,2)) ELSE val END AS amount",
        "CASE WHEN m <> 21 THEN concat('CG', user_id) END AS customer_id",
        "concat(CASE WHEN event_type IN ('purchase', 'view') THEN 'MG' ELSE 'CG' END, k) AS counterparty_id",
        "before AS origin_balance_before",
        "CAST(before - val AS DECIMAL(18,2)) AS origin_balance_after",
        f"{status} AS status",
        "CASE WHEN k < 10 THEN 'LIMIT' END AS decline_reason",
        "CASE WHEN event_id % 71 <> 0 THEN CAST(k % 10 = 0 AS INT) END AS is_fraud",
        f"'{K.FEED_SOURCE}' AS source_system",
        f"CASE WHEN day >= DATE '{CHANNEL_FROM}' THEN if(event_id % 2 = 0, 'app', 'web') END AS channel",
        "CAST(NULL AS STRING) AS _rescued_data",
        "concat('/landing/transactions_daily/transactions_', day, '.jsonl') AS _source_file",
        "timestampadd(HOUR, 24, CAST(day AS TIMESTAMP)) AS _source_modified_at",
        "timestampadd(HOUR, 30 + copy, CAST(day AS TIMESTAMP)) AS _ingested_at",
    )


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as the step-based history."""
    money = "CAST({} AS DECIMAL(18,2))".format
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "CASE l_linenumber % 5 WHEN 0 THEN 'CASH_IN' WHEN 1 THEN 'CASH_OUT' WHEN 2 THEN 'TRANSFER' "
        "WHEN 3 THEN 'PAYMENT' ELSE 'DEBIT' END AS type",
        f"CASE WHEN l_partkey % 500 = 0 THEN {money('0')} ELSE {money('l_extendedprice')} END AS amount",
        "l_linenumber % 5 = 3 AS merchant",
        "CAST(l_quantity AS INT) AS quantity",
    )
    before = f"CASE WHEN quantity = 1 THEN amount ELSE {money('amount + quantity')} END"
    received = f"CASE WHEN merchant THEN {money('0')} ELSE {money('quantity * 100')} END"
    return rows.selectExpr(
        f"CAST(datediff(l_shipdate, DATE '{ANCHOR[:10]}') * 24 + l_suppkey % 24 + 1 AS INT) AS step",
        "type",
        "amount",
        "concat('C', l_orderkey) AS nameOrig",
        f"{before} AS oldbalanceOrg",
        money(f"{before} - amount") + " AS newbalanceOrig",
        "CASE WHEN merchant THEN concat('M', l_suppkey) ELSE concat('C', l_partkey) END AS nameDest",
        f"{received} AS oldbalanceDest",
        f"CASE WHEN merchant THEN {money('0')} ELSE {money(received + ' + amount')} END AS newbalanceDest",
        "CAST(type IN ('TRANSFER', 'CASH_OUT') AND l_returnflag = 'R' AS INT) AS isFraud",
        "CAST(type = 'TRANSFER' AND l_returnflag = 'R' AND quantity = 50 AS INT) AS isFlaggedFraud",
        "CAST(NULL AS STRING) AS _rescued_data",
        "'/landing/history/history.csv' AS _source_file",
        "TIMESTAMP '2024-02-01 00:00:00' AS _source_modified_at",
        "TIMESTAMP '2024-02-01 01:00:00' AS _ingested_at",
    )


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial load of every party seen in ``events``, then one change per signup."""
    e = _event_fields(spark, sf_dir)
    parties = e.select(
        F.explode(
            F.array(
                F.struct(F.lit("CG").alias("p"), F.col("user_id").alias("n")),
                F.struct(F.lit("CG").alias("p"), F.col("k").cast("bigint").alias("n")),
                F.struct(F.lit("MG").alias("p"), F.col("k").cast("bigint").alias("n")),
            )
        ).alias("x")
    ).select("x.p", "x.n").distinct()
    merchant = F.col("p") == "MG"
    initial = parties.select(
        F.concat("p", F.col("n").cast("string")).alias("customer_id"),
        F.when(merchant, "merchant").otherwise("customer").alias("entity_type"),
        F.when(merchant, "retail")
        .otherwise(F.concat(F.lit("S"), (F.col("n") % 4).cast("string")))
        .alias("segment"),
        F.concat(F.lit("R"), (F.col("n") % 10).cast("string")).alias("region"),
        F.lit(INITIAL_AT).cast("timestamp").alias("changed_at"),
        F.lit(INITIAL_DAY).alias("day"),
        F.lit(False).alias("late"),
    )
    changes = e.where(F.col("event_type") == "signup").select(
        F.concat(F.lit("CG"), F.col("user_id").cast("string")).alias("customer_id"),
        F.lit("customer").alias("entity_type"),
        F.concat(F.lit("S"), (F.col("k") % 4).cast("string")).alias("segment"),
        F.concat(F.lit("R"), (F.col("k") % 10).cast("string")).alias("region"),
        F.date_trunc("second", "ts").alias("changed_at"),
        F.col("day").cast("string").alias("day"),
        (F.col("event_id") % 10 == 3).alias("late"),
    )
    both = initial.unionByName(changes)
    return both.select(
        "customer_id",
        "entity_type",
        "segment",
        "region",
        "changed_at",
        F.lit(None).cast("string").alias("_rescued_data"),
        F.concat(
            F.lit("/landing/customer_profile/customer_profile_"),
            "day",
            F.when(F.col("late"), "_late.csv").otherwise(".csv"),
        ).alias("_source_file"),
        F.timestamp_add("HOUR", F.lit(24), F.col("day").cast("timestamp")).alias("_source_modified_at"),
        F.timestamp_add("HOUR", F.lit(30), F.col("day").cast("timestamp")).alias("_ingested_at"),
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each feed day should contain, counted from ``events`` and the defect rules alone."""
    e = _event_fields(spark, sf_dir)
    m = F.col("m")
    regular_change = (F.col("event_type") == "signup") & (F.col("event_id") % 10 != 3)
    daily = e.groupBy(F.col("day").alias("feed_date")).agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_if(m.isin(1, 21)).alias("null_field"),
        F.count_if(m == 2).alias("bad_amount"),
        F.count_if(m == 3).alias("unknown_type"),
        F.count_if(m.isin(4, 24, 44)).alias("bad_timestamp"),
        F.count_if(m.isin(10, 11)).alias("duplicates"),
        F.count_if(regular_change).alias("changes"),
    )
    users = e.select(F.col("user_id").alias("n")).distinct()
    keys = e.select(F.col("k").cast("bigint").alias("n")).distinct()
    loaded = users.union(keys).distinct().unionAll(keys).agg(F.count(F.lit(1)).alias("n"))
    load = loaded.select(F.lit(INITIAL_DAY).cast("date").alias("_day"), F.col("n").alias("loaded"))
    return daily.join(load, F.col("feed_date") == F.col("_day"), "left").select(
        "feed_date",
        "clean_rows",
        (F.col("clean_rows") + F.col("duplicates")).alias("rows_written"),
        (F.col("changes") + F.coalesce("loaded", F.lit(0))).alias("profile_rows"),
        "null_field",
        "bad_amount",
        "unknown_type",
        "bad_timestamp",
        "duplicates",
    )


def _division(number: Column) -> Column:
    names = F.array(*[F.lit(d) for d in K.DIVISIONS])
    return F.element_at(names, (number % len(K.DIVISIONS) + 1).cast("int"))


def raw_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two calendar payloads made from ``nation``: the newer one lacks every fifth nation.

    A payload is one document by definition; ``nation`` holds 25 rows at every scale.
    """
    nation = table(spark, sf_dir, "nation")
    entries = nation.select(
        "n_nationkey",
        _division(F.col("n_regionkey")).alias("division"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.concat("n_name", F.lit(suffix)).alias("title"),
                        F.date_add(F.lit(start).cast("date"), F.col("n_nationkey"))
                        .cast("string")
                        .alias("date"),
                        F.lit("").alias("notes"),
                        (F.col("n_nationkey") % 2 == 0).alias("bunting"),
                    )
                    for start, suffix in HOLIDAY_STARTS
                ]
            )
        ).alias("event"),
    )

    def payload(rows: DataFrame, at: str) -> DataFrame:
        lists = rows.groupBy("division").agg(F.sort_array(F.collect_list("event")).alias("events"))
        region = F.struct("division", F.struct("division", "events"))
        return lists.agg(F.to_json(F.map_from_entries(F.collect_list(region))).alias("payload")).select(
            "payload",
            F.lit(f"/landing/bank_holidays/{at[:10]}.json").alias("_source_file"),
            F.lit(at).cast("timestamp").alias("_source_modified_at"),
            F.lit(at).cast("timestamp").alias("_ingested_at"),
        )

    older = payload(entries, "2024-01-01 00:00:00")
    newer = payload(entries.where(F.col("n_nationkey") % 5 != 4), "2024-01-02 00:00:00")
    return older.unionByName(newer)


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar payload per order; payloads of one month arrive together."""
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")

    def event(days: int, suffix: str) -> Column:
        return F.struct(
            F.concat("o_orderpriority", F.lit(suffix)).alias("title"),
            F.date_add(day, days).cast("string").alias("date"),
            F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("notes"),
            (F.col("o_orderkey") % 2 == 0).alias("bunting"),
        )

    division = _division(F.col("o_orderkey"))
    region = F.struct(division.alias("division"), F.array(event(0, ""), event(7, " +7")).alias("events"))
    return o.select(
        "o_orderkey",
        F.to_json(F.create_map(division, region)).alias("payload"),
        F.date_trunc("month", "o_orderdate").alias("_ingested_at"),
    )


def orders_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a profile change feed keyed by customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.lit("customer").alias("entity_type"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderdate").alias("changed_at"),
        "o_orderkey",
    )


def signup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups only, with no initial load: early events have no version yet."""
    e = _event_fields(spark, sf_dir)
    return e.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("customer_id"),
        F.lit("customer").alias("entity_type"),
        F.concat(F.lit("S"), (F.col("k") % 4).cast("string")).alias("segment"),
        F.concat(F.lit("R"), (F.col("k") % 10).cast("string")).alias("region"),
        F.col("ts").alias("changed_at"),
        "event_id",
    )
