"""Small tables that get a few rows with every run: a merged base, and the deltas since.

Each append is a folder of its own, visible once it is renamed to its final name. When ``most``
deltas have gathered they are merged with the base into a new one, which is counted before it is
renamed into its place; a break leaves the old base with its deltas. What a merge has replaced is
deleted by the next one, so whoever has just listed the table can still read it. The number of files
is bounded, however many runs there are. One run writes at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders

MOST_DELTAS = 16
ROWS_A_FILE = 1_000_000
BASE, DELTA = "base", "delta"


class RowsLost(RuntimeError):
    """A merged base does not hold the rows that were written to it."""


def _versions(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The numbers of the folders there are, unfinished ones (with a leading ``_``) too."""
    out: dict[str, list[int]] = {}
    for name in folders.children(spark, path):
        kind, _, number = name.partition("-")
        if number.isdigit():
            out.setdefault(kind, []).append(int(number))
    return {kind: sorted(numbers) for kind, numbers in out.items()}


def _folder(path: str, kind: str, version: int) -> str:
    return f"{path}/{kind}-{version:012d}"


def _current(spark: SparkSession, path: str) -> tuple[list[str], dict[str, list[int]]]:
    """The folders that make up the table now, and all versions."""
    versions = _versions(spark, path)
    base = max(versions.get(BASE, []), default=0)
    deltas = [v for v in versions.get(DELTA, []) if v > base]
    parts = [_folder(path, BASE, base)] if base else []
    return parts + [_folder(path, DELTA, v) for v in deltas], versions


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table's rows by its declared schema; a table that was never written is empty."""
    parts, _ = _current(spark, path)
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def append(
    df: DataFrame, path: str, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, most: int = MOST_DELTAS
) -> None:
    """Add the rows of ``df`` as a delta; ``merge`` says what stays of all rows in a new base."""
    spark = df.sparkSession
    _, versions = _current(spark, path)
    version = 1 + max((max(v) for v in versions.values()), default=0)
    unfinished = _folder(path, f"_{DELTA}", version)
    df.coalesce(1).write.parquet(unfinished)
    folders.rename(spark, unfinished, _folder(path, DELTA, version))
    parts, versions = _current(spark, path)
    if len(parts) >= most:
        _merge(spark, path, parts, versions, df.schema, merge)


def _merge(spark: SparkSession, path: str, parts: list[str], versions, schema, merge: Callable) -> None:
    version, before = max(versions[DELTA]), max(versions.get(BASE, []), default=0)
    rows = merge(spark.read.schema(schema).parquet(*parts)).select(*schema.names)
    unfinished = _folder(path, f"_{BASE}", version)
    counted = Observation()
    tasks = 1 + rows.count() // ROWS_A_FILE
    rows.observe(counted, F.count("*").alias("n")).coalesce(int(tasks)).write.mode("overwrite").parquet(unfinished)
    there = spark.read.schema(schema).parquet(unfinished).count()
    if there != counted.get["n"]:
        raise RowsLost(f"{unfinished} has {there} rows of {counted.get['n']}")
    folders.rename(spark, unfinished, _folder(path, BASE, version))
    for kind, numbers in versions.items():
        for number in numbers:
            if number < before or (kind != BASE and number <= before):
                folders.delete(spark, _folder(path, kind, number))
