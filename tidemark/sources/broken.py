"""Files that can't be read, by name, in one pass over all of them."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.sources import footers

FOUND = "path string, length bigint, rows bigint, broken boolean"


def _rows(spark: SparkSession, paths: list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of each file by its footer (path, stored), and those that Spark could read (path, rows, mark)."""
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    every = reader.option("pathGlobFilter", "*.parquet").parquet(*paths)
    # the path as a listing has it: without the escapes of a URL, in which a plus is a plus
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path")
    said = every.select(path).groupBy("path").agg(F.count("*").alias("stored"))
    # a hash of all values: whoever keeps it has every declared column decoded
    values = F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]).alias("value")
    read = every.select(path, values).groupBy("path").agg(F.count("*").alias("rows"), F.bit_xor("value").alias("mark"))
    return said, read


def check_files(spark: SparkSession, listed: DataFrame, declared: T.StructType) -> DataFrame:
    """(path, length, rows, broken) of every listed file (path, length).

    All files are read in one pass that steps over what it can't read, and are joined to the
    listing. A file is broken if it has fewer rows there than its footer says, or no readable
    footer; a sound file may be empty. ``rows`` are those that could be read.
    """
    every = sorted(r["path"] for r in listed.select("path").collect())  # one path a file
    if not every:
        return spark.createDataFrame([], FOUND)
    counted = listed.select("path", "length").withColumns(
        {c: F.lit(None).cast("bigint") for c in ("stored", "rows", "mark")}
    )
    groups = footers.schema_groups(spark, every, readable_only=True)
    if groups:
        sides = []
        for schema, paths in groups:
            have = {f.name.lower(): f for f in schema.fields}
            mine = [have[n.lower()] for n in declared.names if n.lower() in have] or schema.fields
            sides.append(_rows(spark, paths, T.StructType(mine)))
        said, read = (reduce(DataFrame.unionByName, side) for side in zip(*sides))
        counted = listed.select("path", "length").join(said, "path", "left").join(read, "path", "left")
    counted = session.stored(counted, session.scratch_path(spark, "file-counts"))
    silent = sorted(r["path"] for r in counted.where("stored IS NULL").select("path").collect())
    lost = F.coalesce("rows", F.lit(0)) < F.coalesce("stored", F.lit(0))
    unread = F.col("path").isin(_unreadable(spark, silent))
    return counted.select("path", "length", F.coalesce("rows", F.lit(0)).alias("rows"), (lost | unread).alias("broken"))


def _unreadable(spark: SparkSession, paths: list[str]) -> list[str]:
    """Of files that gave no rows, those without a readable footer; the others are empty."""
    if not paths:
        return []
    try:
        footers.merged_schema(spark, paths)
        return []
    except (PySparkException, Py4JError):
        if len(paths) == 1:
            return paths
    middle = len(paths) // 2
    return _unreadable(spark, paths[:middle]) + _unreadable(spark, paths[middle:])
