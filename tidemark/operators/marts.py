"""Daily marts over the flat table.

All four marts count distinct users and sessions exactly.  Spark would expand every
event once per distinct count; instead events are first rolled up to one row per
(day, user, session), then to one per (day, user), then to the mart's grain.  At each
level a distinct count is a plain count of rows, and every aggregate has a
fixed-width buffer that is combined inside the task before the shuffle -- so neither a
day, nor a market, nor a user (NULL included) with a large share of the events ends
up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventNames:
    """Events the business metrics count; an app without one gets zeros."""

    new_user: str = "first_open"
    prompt: str = "send_prompt"
    prompt_result: str = "prompt_result"
    chat_start: str = "chat_start"
    paywall: str = "paywall_view"
    purchase: str = "in_app_purchase"
    remove: str = "app_remove"


# Discovered columns the metrics use, NULL of this type while the table lacks them.
SESSION_COLUMNS = {
    "ga_session_id_int": "bigint",
    "session_engaged_int": "bigint",
    "engagement_time_msec_int": "bigint",
}

_KEYS = ("_dt", "user_pseudo_id", "session")
_SUMS = (
    "events", "first_opens", "prompts", "prompt_results", "chat_starts", "paywalls",
    "purchases", "removes", "engagement_ms", "revenue", "ad_revenue",
)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column if the table has it, else a typed NULL."""
    present = {c.lower() for c in df.columns}
    return F.col(name) if name.lower() in present else F.lit(None).cast(kind)


def rollup(
    flat: DataFrame, dimensions: Sequence[str], names: EventNames = EventNames()
) -> DataFrame:
    """Events summed per day, user, session and the given dimensions.

    Sums that the caller does not use are pruned by the optimizer, and so are the flat
    columns behind them.
    """
    session, engaged, millis = (
        column_or_null(flat, name, kind) for name, kind in SESSION_COLUMNS.items()
    )
    events = flat.select(
        "_dt", "user_pseudo_id", session.alias("session"),
        "event_name", "platform",
        F.coalesce("geo_country", F.lit("")).alias("country"),
        F.coalesce("app_info_version", F.lit("")).alias("app_version"),
        F.coalesce(engaged == 1, F.lit(False)).alias("is_engaged"),
        F.coalesce(millis, F.lit(0)).alias("millis"),
        F.coalesce("event_value_in_usd", F.lit(0.0)).alias("usd"),
        F.coalesce("publisher_ad_revenue_in_usd", F.lit(0.0)).alias("ad_usd"),
        "event_timestamp", "event_ts",
    )

    def times(name: str) -> Column:
        return F.count_if(F.col("event_name") == name)

    return events.groupBy(*_KEYS, *dimensions).agg(
        F.count("*").alias("events"),
        times(names.new_user).alias("first_opens"),
        times(names.prompt).alias("prompts"),
        times(names.prompt_result).alias("prompt_results"),
        times(names.chat_start).alias("chat_starts"),
        times(names.paywall).alias("paywalls"),
        times(names.purchase).alias("purchases"),
        times(names.remove).alias("removes"),
        F.sum("millis").alias("engagement_ms"),
        F.sum(F.when(F.col("event_name") == names.purchase, F.col("usd")).otherwise(0.0))
        .alias("revenue"),
        F.sum("ad_usd").alias("ad_revenue"),
        F.max("is_engaged").alias("is_engaged"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.max("event_timestamp").alias("last_micros"),
    )


def _seconds(millis: Column) -> Column:
    return F.round(millis / 1000, 3)


def _summary(rolled: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Every metric per day and the given dimensions, from the rollup by these dimensions."""
    user = F.col("user_pseudo_id")
    per_user = rolled.groupBy("_dt", *dimensions, "user_pseudo_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.count("session").alias("sessions"),
        F.count_if("is_engaged").alias("engaged_sessions"),
    )

    def users_with(column: str) -> Column:
        return F.count_if(user.isNotNull() & (F.col(column) > 0))

    return per_user.groupBy("_dt", *dimensions).agg(
        F.count(user).alias("users"),
        users_with("first_opens").alias("new_users"),
        F.sum("sessions").alias("sessions"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
        _seconds(F.sum("engagement_ms")).alias("engagement_sec"),
        F.sum("events").alias("events"),
        F.sum("prompts").alias("prompts_sent"),
        users_with("prompts").alias("prompt_users"),
        F.sum("prompt_results").alias("prompt_results"),
        F.sum("chat_starts").alias("chat_starts"),
        F.sum("paywalls").alias("paywall_views"),
        users_with("paywalls").alias("paywall_users"),
        F.sum("purchases").alias("purchases"),
        users_with("purchases").alias("buyers"),
        F.sum("revenue").alias("revenue_usd"),
        F.sum("ad_revenue").alias("ad_revenue_usd"),
        users_with("removes").alias("app_removes"),
    )


def daily_kpi(rolled: DataFrame) -> DataFrame:
    """One row per day with the headline metrics."""
    return _summary(rolled, ()).select(
        "_dt", F.col("users").alias("dau"), "new_users", "sessions", "engaged_sessions",
        "engagement_sec", "events", "prompts_sent", "prompt_users", "prompt_results",
        "chat_starts", "paywall_views", "paywall_users", "purchases", "buyers",
        "revenue_usd", "ad_revenue_usd", "app_removes",
    )


def daily_events(rolled: DataFrame) -> DataFrame:
    """Per day and event name: events, users, sessions."""
    return _summary(rolled, ("event_name",)).select(
        "_dt", "event_name", "events", "users", "sessions"
    )


def daily_geo(rolled: DataFrame) -> DataFrame:
    """Per day, country and platform.  Events without a user stay in their group."""
    return _summary(rolled, ("country", "platform")).select(
        "_dt", "country", "platform", "users", "new_users", "sessions", "events",
        "purchases", "buyers", "revenue_usd",
    )


def user_daily(rolled: DataFrame) -> DataFrame:
    """Per day and user; events without a user are left out, an empty user id is a user.

    Platform, country and version are those of the user's latest event; among events
    of the same microsecond the largest value counts.  These maxima need the sort-based
    aggregate, which is why the three are dimensions of the rollup -- they seldom change
    within a session -- and the maxima are taken over its rows and not over events.
    """

    def at_latest(column: str) -> Column:
        return F.max(F.struct("last_micros", column))[column]

    return (
        rolled.filter(F.col("user_pseudo_id").isNotNull())
        .groupBy("_dt", "user_pseudo_id")
        .agg(
            F.max((F.col("first_opens") > 0).cast("int")).alias("is_new"),
            F.sum("events").alias("events"),
            F.count_distinct("session").alias("sessions"),
            _seconds(F.sum("engagement_ms")).alias("engagement_sec"),
            F.sum("prompts").alias("prompts_sent"),
            F.sum("purchases").alias("purchases"),
            F.sum("revenue").alias("revenue_usd"),
            F.min("first_ts").alias("first_event_ts"),
            F.max("last_ts").alias("last_event_ts"),
            at_latest("platform").alias("platform"),
            at_latest("country").alias("country"),
            at_latest("app_version").alias("app_version"),
        )
    )


@dataclass(frozen=True)
class Mart:
    """A mart table: how to build it from the rollup by its dimensions, and its sort."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    dimensions: tuple[str, ...]
    sort: tuple[str, ...] = ()

    def from_flat(self, flat: DataFrame, names: EventNames = EventNames()) -> DataFrame:
        return self.build(rollup(flat, self.dimensions, names))


MARTS = (
    Mart("mart_daily_kpi", daily_kpi, ()),
    Mart("mart_daily_events", daily_events, ("event_name",), ("event_name",)),
    Mart("mart_daily_geo", daily_geo, ("country", "platform"), ("country", "platform")),
    Mart("mart_user_daily", user_daily, ("country", "platform", "app_version"),
         ("user_pseudo_id",)),
)
