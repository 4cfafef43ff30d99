"""Flattening raw days and building the marts of flat days."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days
from tidemark.operators import discover, flatten, marts, quality, registry, retention
from tidemark.operators.marts import EventNames
from tidemark.plans import status
from tidemark.plans.app import App
from tidemark.schema.raw import SORT_KEY
from tidemark.sources import merged, partitions


@dataclass
class Flattened:
    """What a flatten run did."""

    statuses: dict[date, str]
    new_columns: list[str] = field(default_factory=list)


def _days_with_rows(app: App, table: str, first: date, last: date, only) -> set[date]:
    """Days of a stored table that hold rows, one entry per calendar day."""
    found = {r["_dt"] for r in app.day_counts(table, "n", first, last).collect()}
    return found if only is None else found & set(only)


def _last_day(month: date) -> date:
    return (month.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def months_of(app: App, found: set[date]) -> DataFrame:
    """The key counts of the months of the given days, summed by month; no other is read."""
    months = sorted({d.replace(day=1) for d in found})
    counts = app.key_counts(months[0], _last_day(months[-1]))
    return registry.months(counts.filter(F.trunc("_dt", "month").isin(months)))


def sync_registry(app: App, raw: DataFrame, found: set[date], run_id: str) -> list[str]:
    """Discover the keys of the given raw days and bring the registry up to date.

    The counts are kept per day and replaced like any other day, so that a re-run
    adds nothing twice; the sums of their months are replaced with them.  Names go first:
    after a break in between, no triple that is counted lacks its column.  Returns the
    columns that are new to the flat table.
    """
    counts = discover.discover_keys(raw).withColumn("_run_id", F.lit(run_id))
    partitions.replace_days(counts, app.path("key_counts"), found, rebalance=True)
    # As small as the flat table is wide, for each of a few months; held as local tables,
    # they are not worked out again for every join below.
    known = app.names()
    known = app.spark.createDataFrame(known.collect(), known.schema)
    partial = months_of(app, found)
    partial = app.spark.createDataFrame(partial.collect(), partial.schema)
    unnamed = registry.seen_months(partial).join(known, registry.TRIPLE, "left_anti")
    found_now, new = unnamed.collect(), []
    if found_now:
        unnamed = app.spark.createDataFrame(found_now, unnamed.schema)
        rows = registry.from_seen(known, unnamed).orderBy(*registry.TRIPLE)
        rows = app.spark.createDataFrame(rows.collect(), rows.schema)
        new = [r["column_name"] for r in rows.select("column_name").collect()]
        merged.append(
            rows.withColumn("updated_at", F.current_timestamp()),
            app.path("flat_schema_registry"), registry.latest,
        )
    partitions.replace_days(
        partial, app.path("key_months"), {d.replace(day=1) for d in found}, rebalance=True
    )
    return new


def flatten_days(app: App, first, last, run_id: str) -> Flattened:
    """Flatten the raw days first..last again: keys, columns, then all rows in one job.

    A day without raw rows is skipped.  Raises at the end if a day's flat rows do not
    equal its raw rows.
    """
    done = try_flatten(app, first, last, run_id)
    status.raise_if_failed(done.statuses)
    return done


def try_flatten(app: App, first, last, run_id: str, only=None) -> Flattened:
    """As ``flatten_days``, with failed days in the result; ``only`` works on a set of days."""
    first, last = days.check_range(first, last)
    new_columns: list[str] = []

    def job(a: date, b: date) -> dict[date, str]:
        found = _days_with_rows(app, "events_raw", a, b, only)
        if not found:
            return dict.fromkeys(status.span(a, b), "skipped")
        raw = app.raw(a, b).filter(F.col("_dt").isin(sorted(found)))
        new_columns.extend(sync_registry(app, raw, found, run_id))
        partitions.replace_days(
            flatten.flatten(raw, app.columns(), run_id), app.path("events_flat"), found, SORT_KEY,
            rebalance=False,  # stored raw rows lie by day
        )
        checked = quality.reconcile_flat(
            app.day_counts("events_raw", "raw_rows", a, b),
            app.day_counts("events_flat", "flat_rows", a, b),
        ).filter((F.col("raw_rows") > 0) & F.col("_dt").isin(sorted(found)))
        return _statuses(app, a, b, checked)

    outcomes = status.over_range(job, first, last)
    return Flattened(outcomes, new_columns)


def sync_user_days(app: App, found: set[date]) -> None:
    """Bring the day sets of the months of the given days up to date with the per-user mart."""
    months = {d.replace(day=1) for d in found}
    users = app.mart("mart_user_daily", min(months), _last_day(max(months)))
    sets = retention.day_sets(users.select("user_pseudo_id", "_dt", "is_new"))
    app.user_days().replace(sets, months)


def build_marts(
    app: App, first, last, run_id: str, names: EventNames = EventNames()
) -> dict[date, str]:
    """Build the four marts of the flat days first..last again.

    Each mart reads the few flat columns it needs; they share no intermediate table,
    because a rollup fine enough for all four would itself have to be shuffled again for
    each.  A day without flat rows is skipped.  Raises at the end if a day's per-event
    mart does not sum up to its flat rows.
    """
    return status.raise_if_failed(try_marts(app, first, last, run_id, names))


def try_marts(
    app: App, first, last, run_id: str, names: EventNames = EventNames(), only=None
) -> dict[date, str]:
    """As ``build_marts``, with failed days in the result; ``only`` works on a set of days."""
    first, last = days.check_range(first, last)

    def job(a: date, b: date) -> dict[date, str]:
        found = _days_with_rows(app, "events_flat", a, b, only)
        if not found:
            return dict.fromkeys(status.span(a, b), "skipped")
        flat = app.flat(a, b).filter(F.col("_dt").isin(sorted(found)))
        built = {"_built_at": F.current_timestamp(), "_run_id": F.lit(run_id)}

        def build_one(mart: marts.Mart) -> None:
            partitions.replace_days(
                mart.from_flat(flat, names).withColumns(built), app.path(mart.name), found,
                mart.sort, rebalance=True,
            )

        # The marts do not depend on each other; run side by side, the last tasks of one
        # leave no executor idle.
        with ThreadPoolExecutor(len(marts.MARTS)) as pool:
            list(pool.map(build_one, marts.MARTS))
        sync_user_days(app, found)
        flat_counts = app.day_counts("events_flat", "flat_rows", a, b).filter(
            F.col("_dt").isin(sorted(found))
        )
        events = app.mart("mart_daily_events", a, b).join(flat_counts, "_dt", "left_semi")
        return _statuses(app, a, b, quality.reconcile_marts(flat_counts, events))

    return status.over_range(job, first, last)


def build_mart_day(
    app: App, day: str | date, run_id: str, names: EventNames = EventNames()
) -> dict[date, str]:
    """Build the marts of one day; a day that was never flattened is an error."""
    statuses = build_marts(app, day, day, run_id, names)
    if "skipped" in statuses.values():
        raise ValueError(f"no flat rows for {day}: flatten it before building its marts")
    return statuses


def _statuses(app: App, first: date, last: date, checked: DataFrame) -> dict[date, str]:
    """Status per day of the range, one entry per calendar day."""
    rows = status.range_status(app.spark, first, last, checked).collect()
    return {r["_dt"]: r["status"] for r in rows}
