"""Folder housekeeping through the file system Spark itself is configured with."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _open(spark, path)
    return system.exists(location)


def delete(spark: SparkSession, path: str) -> bool:
    system, location = _open(spark, path)
    return system.delete(location, True)


def overwrite(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file, in the place of one that may be there."""
    system, location = _open(spark, path)
    stream = system.create(location, True)
    stream.write(bytearray(data))
    stream.close()


def read(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, location = _open(spark, path)
    stream = system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder; the folder above the target is made if need be."""
    system, location = _open(spark, path)
    _, there = _open(spark, target)
    system.mkdirs(there.getParent())
    if not system.rename(location, there):
        raise OSError(f"could not move {path} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path; a dataset has one per day."""
    system, location = _open(spark, path)
    if not system.exists(location):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(location) if s.isDirectory())


def stored_days(spark: SparkSession, table: str) -> list[date]:
    """Days that have a partition folder, in order."""
    return sorted(
        date.fromisoformat(name.removeprefix("_dt="))
        for name in children(spark, table)
        if name.startswith("_dt=") and not name.startswith("_dt=__")
    )
