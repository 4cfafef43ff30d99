"""Writing day-partitioned tables: replace whole days, drop days, export a snapshot.

Replacing a day is what makes every re-run idempotent.  Many days are one job: a
dynamic partition overwrite swaps in the days that have rows, and the days that got
none are dropped afterwards, since the overwrite alone would leave their old rows.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import days as day_functions
from tidemark.sources import folders

# Bytes of files that a task reads whose rows it sorts and writes as they are: some 350,000 raw
# rows, which take 1.1 GB while they are sorted.
TASK_BYTES = 32 * 1024**2
_READ_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def _small_reads(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside put ``TASK_BYTES`` of files into a task at most."""
    before = spark.conf.get(_READ_BYTES)
    number, unit = re.fullmatch(r"(\d+)([bkmgtp]?)b?", before.strip().lower()).groups()
    spark.conf.set(_READ_BYTES, min(TASK_BYTES, int(number) * 1024 ** "bkmgtp".find(unit or "b")))
    try:
        yield
    finally:
        spark.conf.set(_READ_BYTES, before)


def replace_days(
    df: DataFrame,
    table: str,
    days: Collection[date],
    sort: Sequence[str] = (),
    rebalance: bool = True,
) -> set[date]:
    """Make the rows of ``df`` the whole content of the given days.

    AQE cuts the output by day into files of about the session's advisory partition size:
    a small day is one file, a day too large for one task is split, whatever the layout
    of the input.  Without ``rebalance`` the tasks that read the rows write them, which
    spares the shuffle of input that is already clustered by day; a task then takes few files.

    Returns the days that got rows.
    """
    if not days:
        return set()
    spark = df.sparkSession
    rows = df.filter(F.col("_dt").isin(sorted(days)))
    if rebalance:
        rows = rows.hint("rebalance", "_dt")
    seen = Observation()
    writer = (
        rows.observe(seen, F.collect_set("_dt").alias("days"))
        .sortWithinPartitions("_dt", *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("_dt")
    )
    with nullcontext() if rebalance else _small_reads(spark):
        writer.parquet(table)
    # At most one entry per calendar day.
    written = set(seen.get["days"])
    drop_days(spark, table, set(days) - written)
    return written


def drop_days(spark: SparkSession, table: str, days: Collection[date]) -> None:
    """Remove whole stored days."""
    for day in sorted(days):
        folders.delete(spark, f"{table}/_dt={day.isoformat()}")


def read_days(
    spark: SparkSession, table: str, schema, first: str | date | None = None,
    last: str | date | None = None,
) -> DataFrame:
    """A stored table by its declared schema, cut to a day range when one is given.

    A table that was never written reads as empty.  A range lists only the folders of its
    own days (and their names, in the table's root), so a long history costs nothing.
    """
    if first is None:
        if not folders.exists(spark, table):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(table)
    first, last = day_functions.check_range(first, last)
    stored = [d for d in folders.stored_days(spark, table) if first <= d <= last]
    if not stored:
        return spark.createDataFrame([], schema)
    paths = [f"{table}/_dt={d.isoformat()}" for d in stored]
    return spark.read.schema(schema).option("basePath", table).parquet(*paths)


def export_snapshot(df: DataFrame, root: str, day: str | date) -> str:
    """A whole table as SNAPPY Parquet under ``dt=<day>/``; older files there are cleared."""
    target = f"{root}/dt={day_functions.check_day(day).isoformat()}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return target


def export_days(df: DataFrame, root: str, rebalance: bool = True) -> None:
    """Every day of ``df`` (column ``_dt``) as its own snapshot folder, in one job.

    Without ``rebalance`` the tasks that read the rows write them, as in ``replace_days``.
    """
    rows = df.withColumnRenamed("_dt", "dt")
    (
        (rows.hint("rebalance", "dt") if rebalance else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("dt")
        .parquet(root)
    )
