"""Quality checks: per-day metrics, verdicts on them, and layer-to-layer counts.

A verdict is ``ok``, ``warn`` or ``fail``, one row per day, for any number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import params

# Thresholds on the share of a day's rows.
NULL_USER_WARN = 0.05
EMPTY_PARAMS_WARN = 0.20
INTRADAY_DRIFT = 0.005


METRICS = (
    "_dt date, rows bigint, null_pseudo bigint, empty_params bigint, uniq_event_names bigint, "
    "max_params_len int"
)


def metrics(raw: DataFrame) -> DataFrame:
    """Rows, missing users, empty bags, event names and longest bag per day."""
    user, size = F.col("user_pseudo_id"), params.count(F.col("event_params"))
    return raw.groupBy("_dt").agg(
        F.count("*").alias("rows"),
        F.count_if(user.isNull() | (user == "")).alias("null_pseudo"),
        F.count_if(size == 0).alias("empty_params"),
        F.count_distinct("event_name").alias("uniq_event_names"),
        F.max(size).alias("max_params_len"),
    )


def _verdict(fail: Column, warn: Column) -> Column:
    return F.when(fail, "fail").when(warn, "warn").otherwise("ok")


def verdicts(measured: DataFrame) -> DataFrame:
    """Judges the metrics: no rows or no event name fails, high shares warn."""
    rows = F.col("rows")
    users = F.try_divide("null_pseudo", "rows")
    empty = F.try_divide("empty_params", "rows")
    never = F.lit(False)
    return measured.select(
        "_dt",
        _verdict(rows == 0, never).alias("rows_verdict"),
        _verdict(never, users > NULL_USER_WARN).alias("user_verdict"),
        _verdict(never, empty > EMPTY_PARAMS_WARN).alias("params_verdict"),
        _verdict(F.col("uniq_event_names") <= 0, never).alias("names_verdict"),
    )


def nested_readable(raw: DataFrame) -> DataFrame:
    """Whether any row of the day has a non-empty bag; if none has, the declared
    schema most likely does not fit the files."""
    longest = F.max(params.count(F.col("event_params")))
    return raw.groupBy("_dt").agg((longest > 0).alias("nested_readable"))


def day_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per day."""
    return df.groupBy("_dt").agg(F.count("*").alias(name))


def fingerprints(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per day and a fingerprint of their values, whatever the order of rows: _dt, rows, print.

    Two 64-bit hashes of each row are summed up, exactly and before the shuffle, so equal rows
    count as often as they stand.  Nested values are hashed as JSON, which tells a NULL part from
    an empty one and from its neighbours.
    """
    names = [c for c in (columns or df.columns) if c != "_dt"]
    plain = [F.col(c) for c in names if not isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType))]
    nested = [F.to_json(F.struct(c)) for c in names if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType))]
    absent = F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in names])
    values = [absent, *plain, *nested]

    def total(hashed: Column) -> Column:
        return F.sum(hashed.cast("decimal(20,0)")).cast("string")

    return df.groupBy("_dt").agg(
        F.count("*").alias("rows"),
        F.concat_ws("/", total(F.xxhash64(*values)), total(F.xxhash64(F.lit("b"), *values))).alias("print"),
    )


def reconcile_content(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fingerprints of two tables day by day: _dt, left_rows, right_rows, verdict.

    ``fail`` where a day has other rows on the two sides, be they as many, or is on one only.
    """
    here = left.select("_dt", F.col("rows").alias("left_rows"), F.col("print").alias("left_print"))
    there = right.select("_dt", F.col("rows").alias("right_rows"), F.col("print").alias("right_print"))
    both = here.join(there, "_dt", "full_outer")
    differs = ~F.col("left_print").eqNullSafe(F.col("right_print")) | (F.col("left_rows") != F.col("right_rows"))
    return both.select(
        "_dt",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("left_rows", "right_rows")],
        _verdict(differs, F.lit(False)).alias("verdict"),
    )


def _paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two per-day counts side by side, 0 where a day is on one side only."""
    both = left.join(right, "_dt", "full_outer")
    return both.select("_dt", *[
        F.coalesce(c, F.lit(0)).alias(c) for c in both.columns if c != "_dt"
    ])


def reconcile_source(source: DataFrame, loaded: DataFrame, intraday: Column) -> DataFrame:
    """Loaded rows against source rows (columns source_rows, loaded_rows).

    A final day must match exactly.  An intraday day is still being written while it
    is read, so a small drift only warns; with no source rows any drift fails.
    """
    diff = F.abs(F.col("loaded_rows") - F.col("source_rows"))
    small = intraday & (F.col("source_rows") > 0) & (
        F.try_divide(diff, F.col("source_rows")) <= INTRADAY_DRIFT
    )
    pairs = _paired(source, loaded).withColumn("diff", diff)
    return pairs.withColumn(
        "verdict", F.when(F.col("diff") == 0, "ok").when(small, "warn").otherwise("fail")
    )


def reconcile_flat(raw_counts: DataFrame, flat_counts: DataFrame) -> DataFrame:
    """Flat rows must equal raw rows (columns raw_rows, flat_rows)."""
    return _paired(raw_counts, flat_counts).withColumn(
        "verdict", _verdict(F.col("raw_rows") != F.col("flat_rows"), F.lit(False))
    )


def reconcile_marts(flat_counts: DataFrame, daily_events: DataFrame) -> DataFrame:
    """Events summed over the per-event mart must equal flat rows; an empty day fails."""
    summed = daily_events.groupBy("_dt").agg(F.sum("events").alias("mart_events"))
    differs = (F.col("flat_rows") != F.col("mart_events")) | (F.col("flat_rows") == 0)
    return _paired(flat_counts, summed).withColumn("verdict", _verdict(differs, F.lit(False)))
