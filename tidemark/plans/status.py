"""Per-day outcome of a range job, and what to do when a day failed."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, timedelta

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


class DaysFailed(RuntimeError):
    """Raised once the whole range was worked on, if any of its days failed."""


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Every day of an inclusive range."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("_dt")
    )


def range_status(spark: SparkSession, first: date, last: date, checked: DataFrame) -> DataFrame:
    """``success``, ``skipped`` (no rows for the day) or ``failed`` per calendar day.

    ``checked`` has _dt and verdict for the days that had input.
    """
    status = (
        F.when(F.col("verdict").isNull(), "skipped")
        .when(F.col("verdict") == "fail", "failed")
        .otherwise("success")
    )
    return (
        calendar(spark, first, last)
        .join(checked.select("_dt", "verdict"), "_dt", "left")
        .select("_dt", status.alias("status"))
        .orderBy("_dt")
    )


# Conditions of Spark errors that a file's content or a row's values cause.
DATA_CONDITIONS = (
    "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "CANNOT_MERGE_SCHEMAS", "MALFORMED_RECORD",
    "PARQUET_CONVERSION_FAILURE", "CAST_INVALID_INPUT", "CAST_OVERFLOW", "CANNOT_PARSE",
    "ARITHMETIC_OVERFLOW", "DIVIDE_BY_ZERO", "NULL_MAP_KEY", "DUPLICATED_MAP_KEY",
    "INVALID_ARRAY_INDEX", "USER_RAISED_EXCEPTION",
)
DATA_MESSAGES = ("is not a Parquet file", "Could not read footer", "Encountered error while reading file")

# Causes of a failed read that lie outside the file.
OUTER_CAUSES = (
    "AccessControlException", "AccessDeniedException", "Permission denied", "Access Denied",
    "UnknownHostException", "ConnectException", "SocketException", "SocketTimeoutException",
    "NoRouteToHostException", "Connection refused", "Connection reset", "No space left on device",
)


def lies_in_data(error: Exception) -> bool:
    """Whether a file or row of some day caused the error, so that other days may be sound.

    Missing columns or permissions, a network that is down, a full disk or a lost session
    break every day alike, also where they show as a file that could not be read.
    """
    if isinstance(error, (PySparkException, Py4JError)):
        # A job's failure carries the failed task's condition and causes in its text.
        said = str(error)
        if any(cause in said for cause in OUTER_CAUSES):
            return False
        marks = [f"[{condition}" for condition in DATA_CONDITIONS] + list(DATA_MESSAGES)
        return any(mark in said for mark in marks)
    return isinstance(error, (ValueError, ArithmeticError, LookupError))


def span(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def over_range(
    job: Callable[[date, date], dict[date, str]], first: date, last: date
) -> dict[date, str]:
    """Run a range job; when data break it, halve the range to find the day they belong to.

    A sound range is one Spark job.  A broken file or row fails only its own day: the
    other days still get done, as if each had been run alone.  Any other error fails the
    whole range at once, since smaller ranges would only meet it again.
    """
    try:
        return job(first, last)
    except Exception as error:
        if first == last or not lies_in_data(error):
            log.exception("days %s to %s failed", first, last)
            return dict.fromkeys(span(first, last), f"failed: {error}")
        middle = first + (last - first) // 2
        return {
            **over_range(job, first, middle),
            **over_range(job, middle + timedelta(days=1), last),
        }


def raise_if_failed(statuses: dict[date, str]) -> dict[date, str]:
    bad = {str(d): s for d, s in statuses.items() if s.startswith("failed")}
    if bad:
        raise DaysFailed(f"failed days: {bad}")
    return statuses
