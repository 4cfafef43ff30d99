"""Small reports on raw rows, marts and stored files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days

# Limits of the storage report.
MAX_FILES_PER_DAY = 30
MAX_TABLE_BYTES = 100 * 1024**3


def event_counts(raw: DataFrame) -> DataFrame:
    """Events per day and name, most frequent first within the day."""
    return (
        raw.groupBy("_dt", "event_name").agg(F.count("*").alias("n"))
        .orderBy("_dt", F.desc("n"), "event_name")
    )


def kpi_trend(kpi: DataFrame) -> DataFrame:
    """Headline KPI columns in day order."""
    return kpi.select(
        "_dt", "dau", "new_users", "sessions", "prompts_sent", "revenue_usd"
    ).orderBy("_dt")


def peek(df: DataFrame, day: str | date, order: Sequence[str] = ()) -> DataFrame:
    """One whole row of a day; the first by ``order``, if one is given."""
    rows = df.filter(F.col("_dt") == F.lit(days.check_day(day)))
    return (rows.orderBy(*order) if order else rows).limit(1)


def survivors(raw: DataFrame, keep_days: int, as_of: str | date) -> DataFrame:
    """Rows not yet expired: day + keep_days is after ``as_of``; 0 keeps everything."""
    if keep_days <= 0:
        return raw
    # Compared on the bare partition column, so expired days are never listed.
    return raw.filter(F.col("_dt") > F.date_sub(F.lit(days.check_day(as_of)), keep_days))


def storage(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files, bytes and rows per stored day; warns on a day cut into many files.

    ``files`` lists the table's files (path, length), ``rows`` counts it per day.
    """
    day = F.try_to_date(F.regexp_extract("path", r"/_dt=([^/]+)/", 1), "yyyy-MM-dd")
    per_day = (
        files.select(day.alias("_dt"), "length")
        .filter("_dt IS NOT NULL")
        .groupBy("_dt")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
    return (
        per_day.join(rows, "_dt", "left")
        .withColumn("too_many_files", F.col("files") > MAX_FILES_PER_DAY)
        .orderBy("_dt")
    )


def storage_total(per_day: DataFrame) -> DataFrame:
    """The whole table in one row; warns above the size limit."""
    return per_day.agg(
        F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    ).withColumn("too_large", F.col("bytes") > MAX_TABLE_BYTES)
