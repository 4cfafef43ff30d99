"""What the footers of files say, found by merging the schemas of whole lists of files.

Spark merges the footers of a list in parallel. Only a list that can't be merged is halved, so
``k`` files of another type among ``n`` take about ``k log n`` merges, and a sound list takes one.
What is held by the driver is one path per file and one schema per group.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

AT_ONCE = 8
_TASK = re.compile(r"^part-\d+-")
Group = tuple[T.StructType, list[str]]


def can_not_merge(error: Exception) -> bool:
    """Whether files disagree on a type."""
    return "CANNOT_MERGE" in str(error) or "Failed to merge" in str(error)


def no_files(error: Exception) -> bool:
    return "UNABLE_TO_INFER_SCHEMA" in str(error)


def merged_schema(spark: SparkSession, paths: Sequence[str], readable_only: bool = False) -> T.StructType:
    """The schema that all files under the paths have together; raises where two disagree.

    With ``readable_only`` files without a readable footer are passed over.
    """
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    if readable_only:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.option("pathGlobFilter", "*.parquet").parquet(*paths).schema


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """One type for values of both, or None where that takes a cast."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name.lower(): f for f in a.fields}
        for f in b.fields:
            known = fields.get(f.name.lower())
            kind = f.dataType if known is None else merged_type(known.dataType, f.dataType)
            if kind is None:
                return None
            fields[f.name.lower()] = T.StructField(known.name if known else f.name, kind)
        return T.StructType(list(fields.values()))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = merged_type(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    return a if a == b else None


def parted(items: list[str], whole: Callable[[list[str]], T.StructType], breaks: Callable) -> list[Group]:
    """``items`` in lists that ``whole`` takes; a list is halved where ``breaks`` says why.

    The lists of one size are tried side by side, ``AT_ONCE`` at a time.
    """

    def tried(some: list[str]) -> T.StructType | None:
        try:
            return whole(some)
        except (PySparkException, Py4JError) as error:
            if not breaks(error) or len(some) == 1:
                raise
            return None

    found, left = [], [items] if items else []
    with ThreadPoolExecutor(AT_ONCE) as pool:
        while left:
            schemas = list(pool.map(tried, left))
            found += [(schema, some) for schema, some in zip(schemas, left) if schema is not None]
            halves = [(some, len(some) // 2) for schema, some in zip(schemas, left) if schema is None]
            left = [part for some, at in halves for part in (some[:at], some[at:])]
    return found


def schema_groups(spark: SparkSession, paths: Sequence[str], readable_only: bool = False) -> list[Group]:
    """The files under the paths in groups that agree on all types, with each group's schema.

    A sound list stays as the paths given. No files give no group.
    """

    def whole(some: list[str]) -> T.StructType:
        return merged_schema(spark, some, readable_only)

    try:
        return [(whole(list(paths)), list(paths))]
    except (PySparkException, Py4JError) as error:
        if no_files(error):
            return []
        if not can_not_merge(error):
            raise
    found: list[Group] = []
    for schema, some in parted(_listed(spark, paths), whole, can_not_merge):
        for at, (known, others) in enumerate(found):
            both = merged_type(known, schema)
            if both is not None:
                found[at] = (both, others + some)
                break
        else:
            found.append((schema, some))
    return found


def _listed(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Every file under paths that exist, patterns among them.

    Files are in the order of their names without the task's number: those of one job, which most
    likely agree, are neighbours and stay together when the list is halved.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    rows = reader.option("recursiveFileLookup", "true").load(list(paths)).select("path")
    return sorted((r["path"] for r in rows.collect()), key=lambda path: (_TASK.sub("", path.rsplit("/", 1)[-1]), path))
