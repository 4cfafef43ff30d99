"""Loading raw days: from export files or from a source table."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions import days
from tidemark.operators import quality
from tidemark.plans import status
from tidemark.plans.app import App
from tidemark.schema import tables
from tidemark.schema.raw import RAW, SORT_KEY
from tidemark.sources import broken, files, merged, partitions, raw


def _now() -> datetime:
    return datetime.now(tz=timezone.utc).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class _Run:
    """One load, as it is written to the run log."""

    run_id: str
    strategy: str
    started: datetime
    warned: dict[date, str] = field(default_factory=dict)


def _log_rows(run: _Run, days_done: DataFrame) -> DataFrame:
    """Run log rows; ``days_done`` has one row per day with its counts and outcome."""
    finished = _now()
    return days_done.select(
        F.col("_dt").alias("event_date"),
        F.coalesce("source_table", F.lit("")).alias("source_table"),
        F.coalesce("is_intraday", F.lit(1)).alias("is_intraday"),
        F.lit(run.strategy).alias("strategy"),
        *[
            F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
            for c in ("source_row_count", "files_read", "bytes_read", "rows_inserted")
        ],
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.started).alias("started_at"),
        F.lit(finished).alias("finished_at"),
        F.lit(int((finished - run.started).total_seconds())).cast("bigint").alias("duration_sec"),
        "status",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    )


def append_log(app: App, rows: DataFrame) -> None:
    """Append to the run log: a row per day, whatever the outcome."""
    merged.append(rows, app.path("ingestion_log"))


def _finish(app: App, run: _Run, first: date, last: date, days_done: DataFrame) -> dict[date, str]:
    """Log every day of the range and report each one's status; the log itself is not read."""
    whole = status.calendar(app.spark, first, last).join(days_done, "_dt", "left")
    rows = _log_rows(run, whole.withColumn("status", F.coalesce("status", F.lit("skipped"))))
    rows = app.spark.createDataFrame(rows.orderBy("event_date").collect(), rows.schema)
    append_log(app, rows)
    told = rows.select("event_date", "status", "error_message").collect()  # one row a day
    run.warned.update({
        r["event_date"]: r["error_message"] for r in told
        if r["status"] == "success" and r["error_message"]
    })
    return {r["event_date"]: r["status"] for r in told}


def _run(app: App, run: _Run, job, first: date, last: date) -> dict[date, str]:
    """Run the job over the range; days whose job broke are logged here."""
    outcomes = status.over_range(job, first, last)
    broken = [(d, s) for d, s in outcomes.items() if s.startswith("failed: ")]
    if broken:
        rows = app.spark.createDataFrame(broken, "_dt date, error_message string")
        unknown = dict.fromkeys(
            ("source_table", "is_intraday", "source_row_count", "files_read", "bytes_read",
             "rows_inserted"), F.lit(None))
        append_log(app, _log_rows(run, rows.withColumns({**unknown, "status": F.lit("failed")})))
    return outcomes


def _unread_days(app: App, every: DataFrame, found: list[Row]) -> dict[date, str]:
    """Days of which files can't be read, with the names of those files."""
    folders = app.spark.createDataFrame([(r["_dt"], r["folder"]) for r in found], "_dt date, folder string")
    mine = every.join(folders, files.folder(F.col("path")) == F.col("folder"), "left_semi")
    judged = broken.check_files(app.spark, mine, RAW).where("broken")
    name = F.regexp_extract("path", "[^/]+$", 0)
    named = judged.join(folders, files.folder(F.col("path")) == F.col("folder")).groupBy("_dt").agg(
        F.array_join(F.sort_array(F.collect_list(name)), ", ").alias("names")
    )
    return {r["_dt"]: f"files that can't be read: {r['names']}" for r in named.collect()}


def load_files(app: App, export_root: str, first, last, run_id: str) -> dict[date, str]:
    """Load the days first..last from export files, in whatever day layout they lie.

    All days found are read and replaced in one job.  A day without files is skipped
    and keeps its stored rows; a day whose files hold no row fails.  If the job breaks on
    its data, one pass over the files finds those that can't be read; their days fail, with
    the files' names in the log, and keep their stored rows, and the others are loaded in
    one more job.  Returns the status per day and raises at the end if any day failed.
    """
    first, last = days.check_range(first, last)
    run = _Run(run_id, "files", _now())

    def job(a: date, b: date) -> dict[date, str]:
        # One folder per calendar day of the range.
        paths = files.day_paths(app.spark, export_root, a, b)
        every = files.parquet_files(app.spark, paths)
        listed = files.day_folders(every)
        found = listed.collect()

        def store(rows: list[Row]) -> None:
            if not rows:
                return
            scanned = raw.scan_days(app.spark, [r["folder"] for r in rows])
            stored = raw.load_columns(
                scanned, run_id, F.concat(F.lit("files:"), "_folder"), is_intraday=True
            )
            partitions.replace_days(
                stored, app.path("events_raw"), {r["_dt"] for r in rows}, SORT_KEY,
                rebalance=False,  # files lie by day
            )

        unread: dict[date, str] = {}
        try:
            store(found)
        except Exception as error:
            if not status.lies_in_data(error):
                raise
            unread = _unread_days(app, every, found)
            if not unread:
                raise
            store([r for r in found if r["_dt"] not in unread])
        listed = app.spark.createDataFrame(found, listed.schema)
        named = app.spark.createDataFrame(list(unread.items()), "_dt date, unread string")
        loaded = app.day_counts("events_raw", "rows_inserted", a, b).join(named, "_dt", "left_anti")
        empty = F.col("rows_inserted").isNull()
        done = listed.join(loaded, "_dt", "left").join(named, "_dt", "left").select(
            "_dt",
            F.concat(F.lit("files:"), "folder").alias("source_table"),
            F.lit(1).alias("is_intraday"),
            F.lit(0).alias("source_row_count"),
            F.col("files").alias("files_read"), F.col("bytes").alias("bytes_read"),
            "rows_inserted",
            F.when(empty, "failed").otherwise("success").alias("status"),
            F.when(empty, F.coalesce("unread", F.lit("no rows loaded"))).alias("error_message"),
        )
        return _finish(app, run, a, b, done)

    return status.raise_if_failed(_run(app, run, job, first, last))


def load_tables(
    app: App, final: DataFrame, intraday: DataFrame, first, last, run_id: str, by_day: bool = False
) -> dict[date, str]:
    """Load the days first..last from source tables (raw columns and ``_dt``).

    Per day the final table wins over the intraday one.  The load is counted against
    the source: a final day must match exactly; an intraday day may drift a little, which
    the log tells.  Days in neither table are skipped.  ``by_day`` says that tasks read the
    source tables day by day, so that their rows need no shuffle before they are written.
    """
    return status.raise_if_failed(try_tables(app, final, intraday, first, last, run_id, by_day=by_day))


def try_tables(
    app: App, final: DataFrame, intraday: DataFrame, first, last, run_id: str,
    warned: dict[date, str] | None = None, by_day: bool = False,
) -> dict[date, str]:
    """As ``load_tables``, with failed days in the result instead of an error.

    ``warned`` takes up what the log warns of, on days that it calls a success.
    """
    first, last = days.check_range(first, last)
    run = _Run(run_id, "tables", _now(), {} if warned is None else warned)

    def source_name(flag: str) -> Column:
        kind = F.when(F.col(flag) == 1, "events_intraday_").otherwise("events_")
        return F.concat(kind, F.date_format("_dt", "yyyyMMdd"))

    def job(a: date, b: date) -> dict[date, str]:
        span = days.within(a, b)
        # One row per calendar day of the range and table; the days decide what is read.
        sides = {}
        for flag, side in ((1, intraday), (0, final)):
            for r in quality.day_counts(side.filter(span), "n").collect():
                sides[r["_dt"]] = (r["_dt"], r["n"], flag)
        counted = [Row(_dt=d, source_rows=n, is_intraday=f) for d, n, f in sides.values()]
        chosen = raw.by_days(
            final, [d for d, _, f in sides.values() if f == 0],
            intraday, [d for d, _, f in sides.values() if f == 1],
        )
        stored = raw.load_columns(
            chosen, run_id, source_name("_is_intraday"), F.col("_is_intraday")
        )
        partitions.replace_days(
            stored, app.path("events_raw"), {r["_dt"] for r in counted}, SORT_KEY,
            rebalance=not by_day,
        )
        expected = app.spark.createDataFrame(
            counted, "_dt date, source_rows bigint, is_intraday int"
        )
        loaded = app.day_counts("events_raw", "loaded_rows", a, b).join(expected, "_dt", "left_semi")
        checked = quality.reconcile_source(expected, loaded, F.col("is_intraday") == 1)
        failed = F.col("verdict") == "fail"
        done = checked.select(
            "_dt",
            source_name("is_intraday").alias("source_table"),
            "is_intraday",
            F.col("source_rows").alias("source_row_count"),
            F.lit(0).alias("files_read"), F.lit(0).alias("bytes_read"),
            F.col("loaded_rows").alias("rows_inserted"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            F.when(F.col("verdict") != "ok", F.concat(
                F.when(failed, "row counts differ: loaded ").otherwise("row counts drift: loaded "),
                "loaded_rows", F.lit(", source "), "source_rows",
            )).alias("error_message"),
        )
        return _finish(app, run, a, b, done)

    return _run(app, run, job, first, last)
