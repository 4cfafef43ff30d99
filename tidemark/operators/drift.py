"""Declared against actual schema, and how well each declared column is filled."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import days
from tidemark.schema.raw import RAW
from tidemark.sources import files, footers

AT_ONCE = 8


def differences(actual: T.StructType, declared: T.StructType = RAW) -> list[tuple]:
    """Rows of column, kind (extra, missing, mismatched), declared and actual type."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    rows = [(n, "extra", None, t) for n, t in have.items() if n not in want]
    rows += [(n, "missing", t, None) for n, t in want.items() if n not in have]
    rows += [
        (n, "mismatched", t, have[n]) for n, t in want.items() if n in have and have[n] != t
    ]
    return rows


def compare_schemas(
    spark: SparkSession, actual: T.StructType, declared: T.StructType = RAW
) -> DataFrame:
    """The differences of two schemas as rows."""
    return spark.createDataFrame(
        differences(actual, declared), "column string, kind string, declared string, actual string"
    )


def schema_drift(
    spark: SparkSession, root: str, first: str | date, last: str | date,
    declared: T.StructType = RAW,
) -> DataFrame:
    """Drift of each exported day first..last: _dt, column, kind, both types.

    Days are never merged with each other, so a column that one day lacks or that changes
    its type between days shows on that day.  The day in a folder's name is not a column
    of its files.  A day takes one merge of its footers, and a few more where its files
    disagree; ``AT_ONCE`` days are merged side by side.  What is gathered is one schema per
    calendar day, or per type that its files have.
    """
    first, last = days.check_range(first, last)
    paths = files.day_paths(spark, root, first, last)
    found = files.day_folders(files.parquet_files(spark, paths)).collect()

    def of_day(row) -> list[tuple]:
        groups = footers.schema_groups(spark, [row["folder"]])
        return [(row["_dt"], *diff) for schema, _ in groups for diff in differences(schema, declared)]

    with ThreadPoolExecutor(AT_ONCE) as pool:
        rows = {row for of_one in pool.map(of_day, found) for row in of_one}
    return spark.createDataFrame(
        sorted(rows, key=str),
        "_dt date, column string, kind string, declared string, actual string",
    )


def column_coverage(raw: DataFrame, columns: Sequence[str] = tuple(RAW.names)) -> DataFrame:
    """Share of rows where each column is not NULL: one pass, one row per column."""
    counts = raw.agg(
        F.count("*").alias("rows"), *[F.count(c).alias(c) for c in columns]
    )
    return counts.unpivot(["rows"], list(columns), "column", "non_null").select(
        "column", "rows", "non_null",
        F.round(F.try_divide("non_null", "rows"), 4).alias("ratio"),
    )
