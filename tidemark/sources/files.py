"""Listing Parquet files: where a day lives, how many files and bytes it has."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders

_LISTING = "path string, modificationTime timestamp, length bigint"

# Day folder layouts, the preferred one first.
LAYOUTS = (
    (r"/dt=(\d{4}-\d{2}-\d{2})/[^/]+$", "yyyy-MM-dd"),
    (r"/(\d{4}-\d{2}-\d{2})/[^/]+$", "yyyy-MM-dd"),
    (r"/dt=(\d{8})/[^/]+$", "yyyyMMdd"),
    (r"/(\d{8})/[^/]+$", "yyyyMMdd"),
)


# The same layouts as folder names.
FOLDER_NAMES = ("dt=%Y-%m-%d", "%Y-%m-%d", "dt=%Y%m%d", "%Y%m%d")


def parquet_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per ``.parquet`` file under the paths: path and length, contents unread."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    there = [path for path in paths if folders.exists(spark, path)]
    if not there:
        return spark.createDataFrame([], _LISTING).select("path", "length")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(there)
        .select("path", "length")
    )


def day_paths(spark: SparkSession, root: str, first: date, last: date) -> list[str]:
    """Folders under a root that are named for a day of the range, in any layout.

    Only the root itself is listed, so the rest of a long history costs nothing.
    """
    wanted = set()
    day = first
    while day <= last:
        wanted |= {day.strftime(form) for form in FOLDER_NAMES}
        day += timedelta(days=1)
    return [f"{root}/{name}" for name in folders.children(spark, root) if name in wanted]


def layout_day(path: Column) -> tuple[Column, Column]:
    """Day and layout rank of a file path, both NULL outside the known layouts."""
    day = rank = None
    for index, (pattern, form) in enumerate(LAYOUTS):
        found = F.try_to_date(F.regexp_extract(path, pattern, 1), form)
        day = found if day is None else F.coalesce(day, found)
        hit = F.when(found.isNotNull(), F.lit(index))
        rank = hit if rank is None else F.coalesce(rank, hit)
    return day, rank


def folder(path: Column) -> Column:
    """The folder of a file path."""
    return F.regexp_replace(path, "/[^/]+$", "")


def day_folders(files: DataFrame) -> DataFrame:
    """The folder that serves each day: the best-ranked layout holding a file.

    Columns: _dt, folder, files, bytes.
    """
    day, rank = layout_day(F.col("path"))
    per_folder = (
        files.select(
            day.alias("_dt"), rank.alias("rank"), "length",
            folder(F.col("path")).alias("folder"),
        )
        .filter("_dt IS NOT NULL")
        .groupBy("_dt", "rank", "folder")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
    return (
        per_folder.groupBy("_dt")
        .agg(F.min_by(
            F.struct("folder", "files", "bytes"), F.struct("rank", "folder")
        ).alias("best"))
        .select("_dt", "best.folder", "best.files", "best.bytes")
    )


def day_statistics(files: DataFrame) -> DataFrame:
    """Files and bytes per day, over the folder that serves the day."""
    return day_folders(files).select("_dt", "files", "bytes")
