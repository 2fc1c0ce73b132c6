"""Every layer built from the bound raw tables, on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.operators import cdc, kpis, shape, star
from auditlake.operators.joins import with_holiday_flag
from auditlake.plans import bindings as B
from auditlake.session import scratch_dir, stage
from auditlake.sources import reference
from auditlake.sources.files import scan_files

# The benchmark amounts and times are sparser than real payments, so the bound rules are looser.
BURST_MINUTES, BURST_COUNT, NIGHT_AMOUNT = 360, 3, 50
FREQUENT, HUB_TRANSFERS, HUB_SENDERS = 8, 2, 2
QUARANTINED_AT = "2024-03-01 00:00:00"
OUTPUT_DROPS = ["failed_checks", "event_ts_raw"]


class World:
    """Lazily built tables of one benchmark folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = False):
        self.spark, self.sf_dir, self.staged = spark, sf_dir, staged

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        """Tables that several others read are written once when ``staged``, unless reading the inputs again costs less."""
        return stage(df, label) if self.staged else df

    @cached_property
    def feed(self) -> DataFrame:
        return B.raw_feed(self.spark, self.sf_dir)

    @cached_property
    def history(self) -> DataFrame:
        return B.raw_history(self.spark, self.sf_dir)

    @cached_property
    def profile(self) -> DataFrame:
        return self._keep(B.raw_profile(self.spark, self.sf_dir), "profile")

    @cached_property
    def payloads(self) -> DataFrame:
        return self._keep(B.raw_holidays(self.spark, self.sf_dir), "payloads")

    def _landed(self, df: DataFrame, label: str, fmt: str, **options) -> str:
        """The folder of a raw table's columns as plain files, one folder per source file."""
        path = scratch_dir(self.spark, f"landing-{label}")
        plain = [c for c in df.columns if not c.startswith("_")]
        named = df.select(*plain, F.element_at(F.split("_source_file", "/"), -1).alias("file"))
        named.write.partitionBy("file").options(**options).format(fmt).save(path)
        return path

    @cached_property
    def history_files(self) -> DataFrame:
        """The history as landed: a scan of its CSV files, amounts as text."""
        path = self._landed(B.raw_history(self.spark, self.sf_dir), "history", "csv", header=True)
        return scan_files(self.spark, path, "csv", header=True).select(F.col("amount").cast("string").alias("amount"))

    @cached_property
    def feed_files(self) -> DataFrame:
        path = self._landed(B.raw_feed(self.spark, self.sf_dir), "feed", "json")
        return scan_files(self.spark, path, "json", "event_id STRING").select("event_id")

    @cached_property
    def profile_files(self) -> DataFrame:
        """The profile as landed; ``file_path`` ends with the name of the source file."""
        path = self._landed(B.raw_profile(self.spark, self.sf_dir), "profile", "csv", header=True)
        found = scan_files(self.spark, path, "csv", header=True)
        return found.withColumn("file_path", F.concat(F.lit("/landing/customer_profile/"), "file"))

    @cached_property
    def manifests(self) -> DataFrame:
        return B.manifests(self.spark, self.sf_dir)

    @cached_property
    def holidays(self) -> DataFrame:
        return self._keep(cdc.snapshot_replace(self.payloads), "holidays")

    @cached_property
    def unified(self) -> DataFrame:
        return with_holiday_flag(self.tagged, self.holidays)

    @cached_property
    def tagged(self) -> DataFrame:
        """The unified rows without the holiday flag, for tables that do not read it.

        Their ids are hashes of whole rows and their times are parsed, which is most of what a reading costs.
        """
        return self._keep(shape.unify([shape.map_feed(self.feed), shape.map_history(self.history, B.ANCHOR)]), "tagged")

    @cached_property
    def transactions(self) -> DataFrame:
        source = self.unified if self.staged else self.tagged
        return cdc.scd1_rare(shape.split_valid(source), ["event_id"], "_ingested_at", OUTPUT_DROPS)

    @cached_property
    def quarantine(self) -> DataFrame:
        at = F.lit(QUARANTINED_AT).cast("timestamp")
        return self._keep(shape.quarantine(self.tagged, at), "quarantine")

    @cached_property
    def profile_events(self) -> DataFrame:
        return shape.profile_events(self.profile)

    @cached_property
    def customer_history(self) -> DataFrame:
        return cdc.scd2(
            self.profile_events,
            ["customer_id"],
            "changed_at",
            track=["segment", "region"],
            except_cols=["_source_file", "_ingested_at"],
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return stage(cdc.scd2_dimension(self.customer_history), "dim_customer")

    @cached_property
    def dim_type(self) -> DataFrame:
        return reference.dim_type(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        days = reference.calendar(self.spark, *B.CALENDAR)
        return self._keep(star.dim_date(days, self.holidays), "dim_date")

    def _fact(self, dim_customer: DataFrame | None) -> DataFrame:
        return star.fact_transactions(
            self.transactions, self.dim_type, dim_customer, BURST_MINUTES, BURST_COUNT, NIGHT_AMOUNT, True
        )

    @cached_property
    def fact(self) -> DataFrame:
        """The fact without customer keys."""
        return self._fact(None)

    @cached_property
    def keyed_fact(self) -> DataFrame:
        return self._keep(self._fact(self.dim_customer), "fact")

    @cached_property
    def kpi_daily(self) -> DataFrame:
        fact = self.keyed_fact if self.staged else self.fact
        return kpis.kpi_daily(fact, self.dim_date)

    @cached_property
    def unusual(self) -> DataFrame:
        fact = self.keyed_fact if self.staged else self.fact
        return kpis.unusual_activity(fact, self.dim_type, FREQUENT, HUB_TRANSFERS, HUB_SENDERS)
