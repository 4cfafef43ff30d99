"""Looking after stored tables: expiry, compaction, the storage report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days
from tidemark.operators import quality, reports
from tidemark.plans.app import App
from tidemark.schema.raw import SORT_KEY
from tidemark.sources import files, folders, partitions

# Output file size a compaction aims at.
TARGET_FILE_BYTES = 512 * 1024**2


def expire(app: App, keep_days: int, as_of: str | date) -> list[date]:
    """Drop raw days whose day + keep_days is not after ``as_of``; 0 keeps everything."""
    limit = days.check_day(as_of)
    table = app.path("events_raw")
    old = [
        d for d in folders.stored_days(app.spark, table)
        if keep_days > 0 and d + timedelta(days=keep_days) <= limit
    ]
    partitions.drop_days(app.spark, table, old)
    return old


class CountsDiffer(RuntimeError):
    """A rewritten day does not hold the rows of the stored one."""


def _beside(table: str, kind: str) -> str:
    return f"{table}__{kind}"


def recover(app: App, name: str = "events_raw") -> list[date]:
    """Put back days that a compaction had moved away when it was cut short."""
    table, away = app.path(name), _beside(app.path(name), "replaced")
    stored = set(folders.stored_days(app.spark, table))
    back = [d for d in folders.stored_days(app.spark, away) if d not in stored]
    for day in back:
        folders.rename(app.spark, f"{away}/_dt={day}", f"{table}/_dt={day}")
    folders.delete(app.spark, away)
    return back


def _by_day(rows: DataFrame, pieces: dict[date, int]) -> DataFrame:
    """Rows dealt so that each day fills tasks of its own: one, or ranges of the sort key."""
    single = sorted(d for d, n in pieces.items() if n == 1)
    parts = [
        rows.filter(F.col("_dt") == F.lit(d)).repartitionByRange(n, *SORT_KEY)
        for d, n in sorted(pieces.items()) if n > 1
    ]
    if single:
        number = F.array_position(F.array(*map(F.lit, single)), F.col("_dt")) - 1
        parts.append(rows.filter(F.col("_dt").isin(single)).repartitionById(len(single), number.cast("int")))
    return reduce(DataFrame.union, parts)


def compact_days(
    app: App, first, last, target_bytes: int = TARGET_FILE_BYTES, name: str = "events_raw"
) -> set[date]:
    """Rewrite the stored days first..last of raw (or flat) rows into few, sorted files.

    Each day has tasks and files of its own, as many as its bytes ask for.  Rows of a large
    day are cut into ranges of the sort key, so an event name that makes up most of it is
    spread as well.  They are written beside the table and held against the stored ones, by
    count and fingerprint; only then does each new day take the place of the old one, which
    is deleted last.  Whatever breaks, one whole copy of a day stays: in place, or where ``recover`` finds it (which the next compaction calls).
    """
    first, last = days.check_range(first, last)
    table = app.path(name)
    recover(app, name)
    stored = {d for d in folders.stored_days(app.spark, table) if first <= d <= last}
    if not stored:
        return set()
    listed = files.parquet_files(app.spark, [f"{table}/_dt={d}" for d in sorted(stored)])
    sizes = listed.groupBy(F.regexp_extract("path", "_dt=([^/]+)", 1).alias("day")).agg(F.sum("length").alias("bytes"))
    pieces = dict.fromkeys(stored, 1)
    # One row per calendar day.
    pieces.update({days.check_day(r["day"]): max(1, -(-r["bytes"] // target_bytes)) for r in sizes.collect()})
    rows = app.raw(first, last) if name == "events_raw" else app.flat(first, last)
    fresh, away = _beside(table, "compacting"), _beside(table, "replaced")
    folders.delete(app.spark, fresh)
    written = partitions.replace_days(
        _by_day(rows, pieces), fresh, stored, SORT_KEY, rebalance=False
    )
    again = partitions.read_days(app.spark, fresh, rows.schema, first, last)
    compared = quality.reconcile_content(quality.fingerprints(rows), quality.fingerprints(again))
    wrong = compared.filter("verdict = 'fail'").collect()
    if wrong:  # one row per calendar day at most
        raise CountsDiffer(f"rewritten days differ, the stored ones stay: {wrong}")
    for day in sorted(written):
        part = f"_dt={day.isoformat()}"
        folders.rename(app.spark, f"{table}/{part}", f"{away}/{part}")
        folders.rename(app.spark, f"{fresh}/{part}", f"{table}/{part}")
    folders.delete(app.spark, away)
    folders.delete(app.spark, fresh)
    return written


def compact_last_week(app: App, day: str | date, names: Sequence[str] = ("events_raw", "events_flat")) -> set[date]:
    """Compact the seven days before a day, of the raw and of the flat table."""
    day = days.check_day(day)
    done = [compact_days(app, day - timedelta(days=7), day - timedelta(days=1), name=name) for name in names]
    return set().union(*done)


def storage_total(app: App) -> DataFrame:
    """Files, bytes and rows of the raw table, and whether it is above the size limit."""
    return reports.storage_total(storage_report(app))


def storage_report(app: App) -> DataFrame:
    """Files, bytes and rows per raw day."""
    return reports.storage(
        files.parquet_files(app.spark, app.path("events_raw")),
        app.day_counts("events_raw", "rows"),
    )
