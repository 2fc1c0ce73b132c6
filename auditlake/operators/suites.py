"""Check suites: uniform rows (suite, check_name, expected, actual, passed) and their runner.

A suite first reduces every table to one row of measures, each table read once, and then states
its checks over that row. The names of the checks are fixed output values of the data model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from auditlake import constants as K
from auditlake.functions import count_true, feed_date, is_late_file, step_to_ts
from auditlake.operators.cdc import scd2_integrity
from auditlake.operators.joins import asof_join, manifest_compare, overlap_count
from auditlake.operators.quality import defect_rules, measure_defects, result_rows
from auditlake.operators.reconcile import one_row

NUMBER = "decimal(28,2)"
PROFILE_PREFIX = "customer_profile_"


FIGURES = ("history_rows", "history_fraud", "history_flagged", "history_drain")


@dataclass(frozen=True)
class Known:
    """Facts about the sources that are known before anything is loaded."""

    history: str = K.HISTORY_SOURCE
    label: str = "PaySim"
    feed: str = K.FEED_SOURCE
    anchor: str = K.HISTORY_ANCHOR
    last_step: int | str = 743
    holiday_steps: tuple[tuple[int, int], ...] = ((265, 288),)
    holiday_steps_label: str = "31 August"
    payloads: int = 1
    regions: int = 3
    summer_holiday: str = "2026-08-31"
    headline_year: int = 2026
    headline_holidays: int = 8
    calendar_days: int = 1096
    types: int = 5
    history_rows: int | None = 6362620
    history_fraud: int | None = 8213
    history_flagged: int | None = 16
    history_drain: int | None = 8018
    # One-row frame with the columns of FIGURES, for sources whose figures are counted rather than
    # written down. It may also have first_at, last_at (times) and holiday_rows.
    counted: DataFrame | None = field(default=None, compare=False)

    def figures(self, spark) -> DataFrame:
        if self.counted is not None:
            return self.counted.select(*[F.col(n).alias(f"known_{n}") for n in self.counted.columns])
        first = F.lit(self.anchor).cast("timestamp").alias("known_first_at")
        last = step_to_ts(F.lit(self.last_step), self.anchor).alias("known_last_at")
        numbers = [F.lit(getattr(self, n)).alias(f"known_{n}") for n in FIGURES]
        return spark.range(1).select(*numbers, first, last)

    @property
    def counts_holidays(self) -> bool:
        return self.counted is not None and "holiday_rows" in self.counted.columns


def check_rows(suite: str, measures: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """One row per check; a NULL on either side is a failure."""
    structs = [
        F.struct(
            F.lit(name).alias("check_name"),
            expected.cast(NUMBER).alias("expected"),
            actual.cast(NUMBER).alias("actual"),
        )
        for name, expected, actual in checks
    ]
    rows = measures.select(F.explode(F.array(*structs)).alias("c")).select("c.*")
    return rows.select(
        F.lit(suite).alias("suite"),
        "check_name",
        "expected",
        "actual",
        F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("passed"),
    )


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def bronze_suite(tables: dict[str, DataFrame], known: Known = Known()) -> DataFrame:
    """Every raw table against the files and manifests that fed it.

    ``tables``: history, feed, profile, profile_landing (with ``file_path``), payloads, manifests.
    """
    h, manifest = known.history, tables["manifests"]
    money = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    no_money = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in money])
    rescued = F.col("_rescued_data").isNotNull()
    late = is_late_file(F.col("_source_file"))
    regions = F.from_json("payload", K.PAYLOAD_DDL)

    measured = measure_defects(tables["feed"], defect_rules())
    profile_days = (
        tables["profile"]
        .where(~late)
        .groupBy(feed_date(F.col("_source_file"), PROFILE_PREFIX).alias("feed_date"))
        .agg(_rows("bronze_rows"))
    )
    pairs = {
        "diff_rows": ("bronze_rows", "rows_written"),
        "diff_events": ("distinct_events", "clean_rows"),
        "diff_null": ("null_field", "null_field"),
        "diff_amount": ("bad_amount", "bad_amount"),
        "diff_type": ("unknown_type", "unknown_type"),
        "diff_ts": ("bad_timestamp", "bad_timestamp"),
    }
    measures = one_row(
        [
            known.figures(manifest.sparkSession),
            tables["history"].agg(
                _rows("h_rows"),
                F.sum("isFraud").alias("h_fraud"),
                F.sum("isFlaggedFraud").alias("h_flagged"),
                count_true(rescued).alias("h_rescued"),
                count_true(no_money).alias("h_no_money"),
            ),
            manifest.agg(_rows("m_days"), F.sum("profile_rows").alias("m_profile")),
            measured.agg(_rows("t_days")),
            manifest_compare(measured, manifest, pairs),
            tables["feed"].agg(count_true(rescued).alias("t_rescued")),
            tables["profile"].agg(
                _rows("p_rows"), count_true(late).alias("p_late"), count_true(rescued).alias("p_rescued")
            ),
            tables["profile_landing"].agg(count_true(is_late_file(F.col("file_path"))).alias("l_late")),
            manifest_compare(profile_days, manifest, {"p_diff": ("bronze_rows", "profile_rows")}),
            tables["payloads"].agg(_rows("b_payloads"), F.max(F.size(regions)).alias("b_regions")),
        ]
    )
    c, zero = F.col, F.lit(0)
    return check_rows(
        "bronze_reconciliation",
        measures,
        [
            (f"{h}: row count equals the source file", c("known_history_rows"), c("h_rows")),
            (f"{h}: fraud rows equal the source", c("known_history_fraud"), c("h_fraud")),
            (f"{h}: flagged rows equal the source", c("known_history_flagged"), c("h_flagged")),
            (f"{h}: rows rescued by the contract", zero, c("h_rescued")),
            (f"{h}: money values rejected as null", zero, c("h_no_money")),
            ("transactions: days loaded equal days in the manifests", c("m_days"), c("t_days")),
            ("transactions: days whose line count differs from the manifest", zero, c("diff_rows")),
            ("transactions: days whose distinct events differ from the manifest", zero, c("diff_events")),
            ("transactions: days whose null defects differ from the manifest", zero, c("diff_null")),
            ("transactions: days whose bad amounts differ from the manifest", zero, c("diff_amount")),
            ("transactions: days whose unknown types differ from the manifest", zero, c("diff_type")),
            ("transactions: days whose bad timestamps differ from the manifest", zero, c("diff_ts")),
            ("transactions: rows rescued by the contract", zero, c("t_rescued")),
            (
                "customer profile: total rows equal the manifests plus the late files",
                c("m_profile") + c("l_late"),
                c("p_rows"),
            ),
            ("customer profile: late-arriving rows equal the landing files", c("l_late"), c("p_late")),
            ("customer profile: days whose row count differs from the manifest", zero, c("p_diff")),
            ("customer profile: rows rescued by the contract", zero, c("p_rescued")),
            ("bank holidays: payloads landed", F.lit(known.payloads), c("b_payloads")),
            ("bank holidays: regions parsed from the payload", F.lit(known.regions), c("b_regions")),
        ],
    )


def silver_suite(tables: dict[str, DataFrame], known: Known = Known()) -> DataFrame:
    """Every clean table against the raw tables and the manifests.

    ``tables``: history, feed, profile, transactions, quarantine, profile_events, holidays,
    manifests.
    """
    tx, manifest, quarantined = tables["transactions"], tables["manifests"], tables["quarantine"]
    history, feed = F.col("source_system") == known.history, F.col("source_system") == known.feed
    defects = ["null_field", "bad_amount", "unknown_type", "bad_timestamp"]
    all_defects = reduce(lambda a, b: a + b, [F.col(d) for d in defects])
    expected_days = manifest.withColumn("valid_rows", F.col("clean_rows") - all_defects)
    silver_days = tx.where(feed).groupBy(F.col("event_date").alias("feed_date")).agg(_rows("silver_rows"))
    reason = lambda code: count_true(F.array_contains("failed_checks", code))
    on_holiday = reduce(lambda a, b: a | b, [F.col("step").between(*s) for s in known.holiday_steps])
    measures = one_row(
        [
            known.figures(manifest.sparkSession),
            tables["history"].agg(
                _rows("h_rows"),
                F.sum("isFlaggedFraud").alias("h_flagged"),
                count_true(F.col("amount") == 0).alias("h_zero"),
                count_true(on_holiday).alias("h_holiday"),
            ),
            expected_days.agg(
                _rows("m_days"),
                F.sum("valid_rows").alias("m_valid"),
                F.sum(all_defects).alias("m_defects"),
                F.sum("duplicates").alias("m_duplicates"),
                *[F.sum(d).alias(f"m_{d}") for d in defects],
            ),
            tx.agg(
                _rows("s_rows"),
                F.count_distinct("event_id").alias("s_events"),
                count_true(history).alias("s_history"),
                count_true(feed).alias("s_feed"),
                count_true(history & (F.col("status") == "DECLINED")).alias("s_declined"),
                count_true(history & F.col("is_zero_amount")).alias("s_zero"),
                count_true(
                    history
                    & (F.col("counterparty_kind") == "merchant")
                    & F.col("dest_balance_before").isNotNull()
                ).alias("s_merchant"),
                F.min(F.when(history, F.col("event_ts"))).alias("s_first"),
                F.max(F.when(history, F.col("event_ts"))).alias("s_last"),
                count_true(history & F.col("is_bank_holiday")).alias("s_holiday"),
                count_true((F.col("status_source") == K.HISTORY_STATUS_SOURCE) & ~history).alias("s_derived"),
            ),
            silver_days.agg(_rows("s_days")),
            manifest_compare(silver_days, expected_days, {"s_diff": ("silver_rows", "valid_rows")}),
            overlap_count(tx, quarantined, "event_id", "s_overlap"),
            quarantined.agg(
                _rows("q_rows"),
                *[
                    reason(code).alias(f"q_{code}")
                    for code in (
                        K.NULL_REQUIRED_FIELD,
                        K.NEGATIVE_AMOUNT,
                        K.UNKNOWN_TYPE,
                        K.BAD_TIMESTAMP,
                        K.UNKNOWN_STATUS,
                    )
                ],
                count_true(F.size("failed_checks") > 1).alias("q_many"),
                count_true(F.col("raw_record").isNull()).alias("q_no_record"),
            ),
            tables["feed"].agg(_rows("t_rows")),
            tables["profile"].agg(_rows("p_rows")),
            tables["profile_events"].agg(_rows("e_rows")),
            tables["holidays"]
            .groupBy("division", "holiday_date", "title")
            .agg(_rows("n"))
            .agg(
                F.sum("n").alias("b_rows"),
                _rows("b_distinct"),
                F.count_distinct("division").alias("b_regions"),
                F.sum(
                    F.when(
                        (F.col("division") == K.HEADLINE_DIVISION)
                        & (F.col("holiday_date") == F.lit(known.summer_holiday).cast("date")),
                        F.col("n"),
                    ).otherwise(0)
                ).alias("b_summer"),
            ),
        ]
    )
    c, zero, h = F.col, F.lit(0), known.history
    return check_rows(
        "silver_reconciliation",
        measures,
        [
            (
                f"silver: total rows equal {known.label} rows plus valid generated rows",
                c("h_rows") + c("m_valid"),
                c("s_rows"),
            ),
            (f"silver: {known.label} rows equal bronze", c("h_rows"), c("s_history")),
            ("silver: days loaded equal days in the manifests", c("m_days"), c("s_days")),
            ("silver: days whose valid rows differ from the manifest", zero, c("s_diff")),
            ("silver: event_id is unique", zero, c("s_rows") - c("s_events")),
            ("silver and quarantine share no event_id", zero, c("s_overlap")),
            ("quarantine: rows equal the injected defects", c("m_defects"), c("q_rows")),
            (
                "quarantine: NULL_REQUIRED_FIELD rows equal the manifests",
                c("m_null_field"),
                c("q_NULL_REQUIRED_FIELD"),
            ),
            ("quarantine: NEGATIVE_AMOUNT rows equal the manifests", c("m_bad_amount"), c("q_NEGATIVE_AMOUNT")),
            ("quarantine: UNKNOWN_TYPE rows equal the manifests", c("m_unknown_type"), c("q_UNKNOWN_TYPE")),
            ("quarantine: BAD_TIMESTAMP rows equal the manifests", c("m_bad_timestamp"), c("q_BAD_TIMESTAMP")),
            ("quarantine: UNKNOWN_STATUS rows (the generator injects none)", zero, c("q_UNKNOWN_STATUS")),
            ("quarantine: rows with more than one reason", zero, c("q_many")),
            ("quarantine: rows without a raw record", zero, c("q_no_record")),
            (
                "duplicates removed equal the manifests",
                c("m_duplicates"),
                c("t_rows") - c("s_feed") - c("q_rows"),
            ),
            (f"{h}: declined rows equal the flagged rows", c("h_flagged"), c("s_declined")),
            (f"{h}: zero-amount rows are kept and flagged", c("h_zero"), c("s_zero")),
            (f"{h}: merchant destination balances are NULL, not zero", zero, c("s_merchant")),
            (
                f"{h}: first event time is the anchor",
                F.lit(1),
                (c("s_first") == c("known_first_at")).cast("int"),
            ),
            (
                f"{h}: last event time is step {known.last_step}",
                F.lit(1),
                (c("s_last") == c("known_last_at")).cast("int"),
            ),
            (
                f"{h}: bank holiday rows equal the rows on {known.holiday_steps_label}",
                c("known_holiday_rows") if known.counts_holidays else c("h_holiday"),
                c("s_holiday"),
            ),
            (f"status is derived for {known.label} only", zero, c("s_derived")),
            ("customer profile: rows equal bronze", c("p_rows"), c("e_rows")),
            ("bank holidays: regions", F.lit(known.regions), c("b_regions")),
            ("bank holidays: duplicate holidays", zero, c("b_rows") - c("b_distinct")),
            (
                f"bank holidays: England and Wales has the {known.headline_year} summer bank holiday",
                F.lit(1),
                c("b_summer"),
            ),
        ],
    )


def gold_suite(tables: dict[str, DataFrame], known: Known = Known()) -> DataFrame:
    """The star schema against the change events and the landing files themselves.

    ``tables``: fact, dim_customer, dim_date, dim_type, kpi_daily, unusual, profile_events,
    quarantine, history_landing (amounts as text), feed_landing.
    """
    fact, dim, kpi = tables["fact"], tables["dim_customer"], tables["kpi_daily"]
    history, feed = F.col("source_system") == known.history, F.col("source_system") == known.feed

    # Attributes at event time from the raw change events, held against the version in the fact.
    feed_rows = fact.where(feed).select("customer_id", "event_ts", "origin_customer_key")
    recomputed = asof_join(
        feed_rows, tables["profile_events"], "customer_id", "event_ts", "customer_id", "changed_at",
        ["segment", "region"], "asof",
    )
    compared = recomputed.join(
        dim.select("customer_key", "segment", "region", "is_current"),
        F.col("origin_customer_key") == F.col("customer_key"),
    )
    differs = (F.col("asof.segment") != F.col("segment")) | (F.col("asof.region") != F.col("region"))
    day = F.date_format(F.lit(known.summer_holiday).cast("date"), "yyyyMMdd").cast("int")
    rate_ok = F.col("approval_rate").between(0, 1) & F.col("fraud_rate").between(0, 1)
    measures = one_row(
        [
            known.figures(fact.sparkSession),
            scd2_integrity(dim),
            compared.agg(
                count_true(F.col("asof").isNull()).alias("pit_none"),
                count_true(differs).alias("pit_diff"),
                (count_true(~F.col("is_current")) > 0).cast("int").alias("pit_old"),
            ),
            dim.agg(count_true(F.col("customer_key") == K.UNKNOWN_KEY).alias("d_unknown")),
            tables["dim_date"].agg(
                _rows("c_days"),
                count_true(
                    F.col("is_bank_holiday_eaw") & (F.col("calendar_year") == known.headline_year)
                ).alias("c_holidays"),
                count_true((F.col("date_key") == day) & F.col("is_bank_holiday_eaw")).alias("c_summer"),
            ),
            tables["dim_type"].agg(_rows("y_rows")),
            fact.agg(
                count_true(~history & (F.col("origin_customer_key") == -1)).alias("f_unknown"),
                count_true(history & (F.col("origin_customer_key") != -1)).alias("f_known"),
                count_true(F.col("amount_band").isNull()).alias("f_no_band"),
                count_true(history).alias("f_history"),
                count_true(feed).alias("f_feed"),
                F.sum(F.when(history, F.col("amount"))).alias("f_amount"),
                count_true(history & F.col("flag_balance_drain")).alias("f_drain"),
                count_true(history & F.col("flag_source_rule")).alias("f_source"),
            ),
            tables["history_landing"].agg(
                _rows("l_rows"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("l_amount")
            ),
            tables["feed_landing"].agg(F.count_distinct("event_id").alias("l_events")),
            tables["quarantine"].agg(F.count_distinct("event_id").alias("q_events")),
            kpi.groupBy("date_key", "source_system")
            .agg(_rows("n"), count_true(~rate_ok).alias("bad"))
            .agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("k_extra"),
                F.coalesce(F.sum("bad"), F.lit(0)).alias("k_bad"),
            ),
            tables["unusual"].agg(count_true(F.size("flag_reasons") == 0).alias("u_none")),
        ]
    )
    c, zero, one, h = F.col, F.lit(0), F.lit(1), known.history
    drain = "" if known.history_drain is None else f" ({known.history_drain:,})"
    source = "" if known.history_flagged is None else f" ({known.history_flagged:,})"
    return check_rows(
        "gold_reconciliation",
        measures,
        [
            ("scd2: versions with a gap or overlap before the next one", zero, c("gaps_or_overlaps")),
            ("scd2: versions that end before they start", zero, c("inverted_ranges")),
            ("scd2: customers without exactly one current version", zero, c("not_one_current")),
            ("scd2: generated facts with no as-of match", zero, c("pit_none")),
            ("scd2: point-in-time mismatches (segment or region)", zero, c("pit_diff")),
            ("scd2: history is used (some facts point at an older version)", one, c("pit_old")),
            ("dim_customer: Unknown member rows", one, c("d_unknown")),
            ("dim_date: calendar days", F.lit(known.calendar_days), c("c_days")),
            (
                f"dim_date: England and Wales bank holidays in {known.headline_year}",
                F.lit(known.headline_holidays),
                c("c_holidays"),
            ),
            (
                f"dim_date: {known.holiday_steps_label} is the England and Wales summer bank holiday",
                one,
                c("c_summer"),
            ),
            ("dim_type: rows", F.lit(known.types), c("y_rows")),
            (f"fact: Unknown customers outside {known.label}", zero, c("f_unknown")),
            (f"fact: {known.label} rows with a known customer", zero, c("f_known")),
            ("fact: rows without an amount band", zero, c("f_no_band")),
            (f"landing file: {known.label} rows equal gold", c("l_rows"), c("f_history")),
            (f"landing file: {known.label} total amount equals gold, to the cent", c("l_amount"), c("f_amount")),
            (
                "landing files: generated events are in gold or quarantine",
                c("l_events"),
                c("f_feed") + c("q_events"),
            ),
            ("kpi_daily: one row per date and source", zero, c("k_extra")),
            ("kpi_daily: rates outside 0 to 1", zero, c("k_bad")),
            (f"rules: {known.label} balance-drain flags equal the profile{drain}", c("known_history_drain"), c("f_drain")),
            (f"rules: {known.label} source-rule flags equal the profile{source}", c("known_history_flagged"), c("f_source")),
            ("unusual_activity: rows without a reason", zero, c("u_none")),
        ],
    )


SUITES: dict[str, Callable[[dict[str, DataFrame], Known], DataFrame]] = {
    "bronze_reconciliation": bronze_suite,
    "silver_reconciliation": silver_suite,
    "gold_reconciliation": gold_suite,
}


def run_checks(tables: dict[str, DataFrame], known: Known = Known()) -> DataFrame:
    """The rows of all suites."""
    return reduce(DataFrame.unionByName, [suite(tables, known) for suite in SUITES.values()])


class NoChecks(RuntimeError):
    """A suite without rows would look like a pass, so it is an error."""


def collect_suites(suites: dict[str, DataFrame]) -> list[Row]:
    """The verdict rows of each suite: a few dozen rows by construction."""
    if not suites:
        raise NoChecks("no suites given")
    rows: list[Row] = []
    for name, frame in suites.items():
        found = frame.collect()
        if not found:
            raise NoChecks(f"{name} returned no checks")
        rows.extend(found)
    return rows


def _plain(value) -> str:
    if value is not None and value == value.to_integral_value():
        return str(int(value))
    return str(value)


def format_report(rows: list[Row]) -> str:
    failed = [r for r in rows if not r["passed"]]
    lines = [f"{len(rows) - len(failed)} of {len(rows)} checks passed"]
    lines += [
        f"FAILED [{r['suite']}] {r['check_name']}: "
        f"expected {_plain(r['expected'])}, actual {_plain(r['actual'])}"
        for r in failed
    ]
    return "\n".join(lines)


def run_suites(
    suites: dict[str, DataFrame],
    append: Callable[[DataFrame], None] | None = None,
    run_id: str | None = None,
) -> str:
    """Run the suites, report, append to the history, and exit non-zero on any failure.

    Recording is a convenience: when it fails the report says so, and the checks still decide.
    """
    rows = collect_suites(suites)
    report = format_report(rows)
    if append is not None:
        try:
            spark = next(iter(suites.values())).sparkSession
            ddl = f"suite STRING, check_name STRING, expected {NUMBER}, actual {NUMBER}, passed BOOLEAN"
            checks = spark.createDataFrame([tuple(r) for r in rows], ddl)
            append(result_rows(checks, F.current_timestamp(), run_id))
        except Exception as error:  # noqa: BLE001
            report += f"\nWARNING: could not record the results: {error!r}"
    print(report)
    if any(not r["passed"] for r in rows):
        raise SystemExit(report)
    return report
