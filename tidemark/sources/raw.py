"""Reading raw exports into the shape the raw table stores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import days
from tidemark.schema.raw import LOAD_METADATA, NON_NULL, RAW
from tidemark.sources import conform, files, footers


def _scans(spark: SparkSession, paths: Sequence[str], *extra: Column) -> DataFrame:
    """One scan for each group of files that agree on their types, cast to the declared ones.

    Files that are all of the declared types are one scan by the declared schema.
    """
    scans = []
    for actual, group in footers.schema_groups(spark, paths):
        kind = conform.readable(RAW, actual)
        rows = spark.read.schema(kind).parquet(*group)
        columns = [
            conform.conformed(F.col(have.name), have.dataType, want.dataType).alias(want.name)
            for have, want in zip(kind.fields, RAW.fields)
        ]
        scans.append(rows.select(*columns, *extra))
    if not scans:
        return spark.read.schema(RAW).parquet(*paths).select("*", *extra)
    return reduce(DataFrame.unionByName, scans)


def scan(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Export files by the declared schema.

    Missing columns and nested fields are NULL, undeclared ones are ignored, names
    match whatever their case and order.  A column that some files have with another type
    is cast; a value that can't be cast breaks the scan.
    """
    return _scans(spark, [paths] if isinstance(paths, str) else list(paths))


def scan_days(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """As ``scan``, with the day (``_dt``) and the folder (``_folder``) of each row's file."""
    path = F.col("_metadata.file_path")
    day, _ = files.layout_day(path)
    return _scans(spark, list(paths), day.alias("_dt"), files.folder(path).alias("_folder"))


def _filled_bag(name: str) -> Column:
    """A bag without NULLs where the raw table allows none: neither the bag nor a key.

    Only a bag that has a NULL key (or a NULL entry) is rebuilt.
    """
    bag = F.col(name)
    rebuilt = F.transform(
        bag,
        lambda p: F.struct(F.coalesce(p["key"], F.lit("")).alias("key"), p["value"].alias("value")),
    )
    full = F.when(F.exists(bag["key"], lambda k: k.isNull()), rebuilt).otherwise(bag)
    return F.coalesce(full, F.array().cast(RAW[name].dataType))


def with_defaults(df: DataFrame) -> DataFrame:
    """NULL becomes the type's default in the columns that are declared non-null."""
    changed = {name: F.coalesce(name, F.lit(default)) for name, default in NON_NULL.items()}
    changed["event_params"] = _filled_bag("event_params")
    changed["user_properties"] = _filled_bag("user_properties")
    changed["items"] = F.coalesce("items", F.array().cast(RAW["items"].dataType))
    return df.withColumns({name: c for name, c in changed.items() if name in df.columns})


def load_columns(
    df: DataFrame,
    run_id: str,
    source_table: str | Column,
    is_intraday: bool | Column,
) -> DataFrame:
    """The stored row: the declared source columns, then the load metadata.

    ``df`` carries its day as ``_dt``.
    """
    flag = is_intraday if isinstance(is_intraday, Column) else F.lit(int(is_intraday))
    table = source_table if isinstance(source_table, Column) else F.lit(source_table)
    return with_defaults(df).select(
        *RAW.names,
        "_dt",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(run_id).alias("_run_id"),
        table.alias("_source_table"),
        flag.cast(LOAD_METADATA["_is_intraday"].dataType).alias("_is_intraday"),
    )


def with_computed_day(df: DataFrame) -> DataFrame:
    """Adds ``event_date_d``: the day of ``event_date``, NULL when malformed."""
    return df.withColumn("event_date_d", days.parsed_day(F.col("event_date")))


def by_days(
    final: DataFrame, final_days: Sequence, intraday: DataFrame, intraday_days: Sequence
) -> DataFrame:
    """The final rows of some days and the intraday rows of others, known beforehand.

    The days are plain filters, so a source partitioned by day reads nothing else.
    """
    return final.filter(F.col("_dt").isin(list(final_days))).withColumn(
        "_is_intraday", F.lit(0)
    ).unionByName(
        intraday.filter(F.col("_dt").isin(list(intraday_days))).withColumn("_is_intraday", F.lit(1))
    )


def prefer_final(final: DataFrame, intraday: DataFrame) -> DataFrame:
    """Per day the final rows where there are any, else the intraday rows.

    A day with neither simply has no rows.  The broadcast side holds one row per
    calendar day, whatever the size of the tables, and keeps the intraday rows
    from being shuffled by day.
    """
    final_days = final.select("_dt").distinct()
    return final.withColumn("_is_intraday", F.lit(0)).unionByName(
        intraday.join(F.broadcast(final_days), "_dt", "left_anti")
        .withColumn("_is_intraday", F.lit(1))
    )
