"""Where one app keeps its tables.  Apps never share a root, so replacing a day of one
cannot touch another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import quality, registry, retention
from tidemark.operators.marts import MARTS
from tidemark.operators.registry import DynamicColumn
from tidemark.schema import tables
from tidemark.schema.raw import STORED_RAW
from tidemark.sources import merged, partitions
from tidemark.sources.buckets import BucketedDays


@dataclass(frozen=True)
class App:
    """The tables of one app under one root path."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def raw(self, first=None, last=None) -> DataFrame:
        return partitions.read_days(self.spark, self.path("events_raw"), STORED_RAW, first, last)

    def day_counts(self, table: str, name: str, first=None, last=None) -> DataFrame:
        """Stored rows per day, from file footers: no column but the day is read."""
        rows = partitions.read_days(self.spark, self.path(table), "_dt date", first, last)
        return quality.day_counts(rows, name)

    def names(self) -> DataFrame:
        """The column of every triple ever found, with its counts as it got the name."""
        return registry.latest(
            merged.read(self.spark, self.path("flat_schema_registry"), tables.REGISTRY)
        )

    def registry(self) -> DataFrame:
        """The registry: names, and the days and counts of all months stored now."""
        seen = registry.seen_months(self.key_months())
        return registry.with_counts(self.names(), seen)

    def columns(self) -> list[DynamicColumn]:
        return registry.columns(self.names())

    def flat(self, first=None, last=None) -> DataFrame:
        """The flat table, as wide as the registry says."""
        schema = registry.flat_schema(self.columns())
        return partitions.read_days(self.spark, self.path("events_flat"), schema, first, last)

    def key_counts(self, first=None, last=None) -> DataFrame:
        return partitions.read_days(
            self.spark, self.path("key_counts"), tables.KEY_COUNTS, first, last
        )

    def key_months(self) -> DataFrame:
        """The key counts summed by month (``_dt`` is its first day)."""
        return partitions.read_days(self.spark, self.path("key_months"), tables.KEY_MONTHS)

    def mart(self, name: str, first=None, last=None) -> DataFrame:
        if name not in {m.name for m in MARTS}:
            raise ValueError(f"no mart named {name!r}")
        return partitions.read_days(self.spark, self.path(name), _MART_SCHEMAS[name], first, last)

    def user_days(self) -> BucketedDays:
        """The days of each user as bits, by month and dealt by user."""
        return BucketedDays(self.spark, self.path("user_days"), tables.USER_DAYS, "user_pseudo_id")

    def retention(self) -> DataFrame:
        """The retention view, computed when read from the kept day sets."""
        return retention.retention_of_sets(self.user_days().rows())

    def daily_log(self) -> DataFrame:
        """How each day of each daily run ended."""
        return merged.read(self.spark, self.path("daily_log"), tables.DAILY_LOG)

    def log(self) -> DataFrame:
        return merged.read(self.spark, self.path("ingestion_log"), tables.RUN_LOG)


_BUILT = "_built_at timestamp, _run_id string, _dt date"
_MART_SCHEMAS = {
    "mart_daily_kpi": (
        "dau bigint, new_users bigint, sessions bigint, engaged_sessions bigint, "
        "engagement_sec double, events bigint, prompts_sent bigint, prompt_users bigint, "
        "prompt_results bigint, chat_starts bigint, paywall_views bigint, paywall_users bigint, "
        "purchases bigint, buyers bigint, revenue_usd double, ad_revenue_usd double, "
        "app_removes bigint, " + _BUILT
    ),
    "mart_daily_events": (
        "event_name string, events bigint, users bigint, sessions bigint, " + _BUILT
    ),
    "mart_daily_geo": (
        "country string, platform string, users bigint, new_users bigint, sessions bigint, "
        "events bigint, purchases bigint, buyers bigint, revenue_usd double, " + _BUILT
    ),
    "mart_user_daily": (
        "user_pseudo_id string, is_new int, events bigint, sessions bigint, "
        "engagement_sec double, prompts_sent bigint, purchases bigint, revenue_usd double, "
        "first_event_ts timestamp, last_event_ts timestamp, platform string, country string, "
        "app_version string, " + _BUILT
    ),
}
