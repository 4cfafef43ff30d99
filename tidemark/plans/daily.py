"""The daily run, over one day or a range: load, check, flatten, build the marts.

Every day goes its own way: a day that fails at one stage is left out of the later ones,
and the others are carried on, each stage as one job over the days that are still good.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days
from tidemark.operators import quality
from tidemark.plans import build, load, status
from tidemark.plans.app import App
from tidemark.schema import tables
from tidemark.sources import merged

STAGES = ("load", "checks", "flatten", "marts")


class ChecksFailed(RuntimeError):
    """A quality check of the loaded rows failed."""


@dataclass
class Outcome:
    """How a day ended: the last stage it entered, why it failed, what it warns of."""

    status: str
    stage: str = STAGES[-1]
    message: str = ""
    warnings: list[str] = field(default_factory=list)


@dataclass
class Run:
    """What a daily run did."""

    outcomes: dict[date, Outcome]
    new_columns: list[str] = field(default_factory=list)

    @property
    def statuses(self) -> dict[date, str]:
        return {d: o.status for d, o in self.outcomes.items()}


def judged(measured: DataFrame) -> DataFrame:
    """Metrics with their verdicts, and per day ``failure`` and ``warnings`` in words.

    A day fails if a verdict does, or if no bag of it could be read: a longest bag of no
    entries means that the declared schema does not fit the files.
    """
    rows = measured.join(quality.verdicts(measured), "_dt")

    def said(parts: list[Column]) -> Column:
        return F.array_join(F.array_compact(F.array(*parts)), "; ")

    share = lambda c: F.format_number(100 * F.try_divide(c, "rows"), 1)
    return rows.withColumns({
        "failure": said([
            F.when(F.col("rows_verdict") == "fail", "no rows"),
            F.when(F.col("names_verdict") == "fail", "no event names"),
            F.when(F.coalesce("max_params_len", F.lit(0)) <= 0, "no event_params could be read"),
        ]),
        "warnings": said([
            F.when(F.col("user_verdict") == "warn",
                   F.concat(share("null_pseudo"), F.lit("% of rows have no user"))),
            F.when(F.col("params_verdict") == "warn",
                   F.concat(share("empty_params"), F.lit("% of rows have no event_params"))),
        ]),
    })


def judge_days(app: App, only: Collection[date]) -> DataFrame:
    """Metrics and verdicts of the given loaded days, in one pass over their rows."""
    rows = app.raw(min(only), max(only)).filter(F.col("_dt").isin(sorted(only)))
    measured = quality.metrics(rows).collect()  # one row per calendar day
    return judged(app.spark.createDataFrame(measured, quality.METRICS))


def check_loaded(app: App, first, last) -> DataFrame:
    """Metrics and verdicts per loaded day; raises if a day fails."""
    first, last = days.check_range(first, last)
    rows = judge_days(app, status.span(first, last))
    failed = [str(r["_dt"]) for r in rows.filter("failure != ''").select("_dt").collect()]
    if failed:
        raise ChecksFailed(f"quality checks failed for {failed}")
    return rows


def _log(app: App, run_id: str, started: datetime, outcomes: dict[date, Outcome]) -> None:
    """Append the closing row of each day: final status, last stage, message, warnings."""
    finished = datetime.now(tz=timezone.utc).replace(tzinfo=None, microsecond=0)
    rows = [
        (d, run_id, o.status, o.stage, o.message, "; ".join(o.warnings), started, finished)
        for d, o in sorted(outcomes.items())
    ]
    merged.append(app.spark.createDataFrame(rows, tables.DAILY_LOG), app.path("daily_log"))


def try_days(
    app: App, final: DataFrame, intraday: DataFrame, first, last, run_id: str, by_day: bool = False
) -> Run:
    """As ``run_days``, with failed days in the result instead of an error."""
    first, last = days.check_range(first, last)
    started = datetime.now(tz=timezone.utc).replace(tzinfo=None, microsecond=0)
    outcomes: dict[date, Outcome] = {}
    new_columns: list[str] = []

    def settle(stage: str, statuses: dict[date, str], asked: Collection[date]) -> list[date]:
        """Note the days that ended at a stage; the others go on."""
        good = []
        for d in sorted(asked):
            said = statuses.get(d, "skipped")
            outcomes[d].stage = stage
            if said == "success":
                good.append(d)
            else:
                kind, _, message = said.partition(": ")
                outcomes[d].status = kind
                outcomes[d].message = message or ("counts differ" if kind == "failed" else "")
        return good

    span = status.span(first, last)
    outcomes = {d: Outcome("success") for d in span}
    try:
        warned: dict[date, str] = {}
        loaded = load.try_tables(app, final, intraday, first, last, run_id, warned, by_day)
        good = settle("load", loaded, span)
        for d, text in warned.items():
            if d in outcomes:
                outcomes[d].warnings.append(text)
        if good:
            checks = {}
            for r in judge_days(app, good).select("_dt", "failure", "warnings").collect():
                checks[r["_dt"]] = f"failed: {r['failure']}" if r["failure"] else "success"
                if r["warnings"]:
                    outcomes[r["_dt"]].warnings.append(r["warnings"])
            good = settle("checks", checks, good)
        if good:
            flattened = build.try_flatten(app, good[0], good[-1], run_id, good)
            new_columns = flattened.new_columns
            good = settle("flatten", flattened.statuses, good)
        if good:
            settle("marts", build.try_marts(app, good[0], good[-1], run_id, only=good), good)
    except Exception as error:
        # Not the fault of one day: whatever was still under way has failed.
        for d, o in outcomes.items():
            if o.status == "success":
                outcomes[d] = Outcome("failed", o.stage, str(error), o.warnings)
        _log(app, run_id, started, outcomes)
        raise
    _log(app, run_id, started, outcomes)
    return Run(outcomes, new_columns)


def run_days(
    app: App, final: DataFrame, intraday: DataFrame, first, last, run_id: str
) -> Run:
    """Source tables to marts.  Days without a source are skipped throughout.

    Good days are done even if others fail; the log says how each day ended.  Raises at the
    end if any failed.
    """
    done = try_days(app, final, intraday, first, last, run_id)
    status.raise_if_failed({
        d: f"failed: {o.stage}: {o.message}" if o.status == "failed" else o.status
        for d, o in done.outcomes.items()
    })
    return done
