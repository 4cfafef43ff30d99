"""Session settings the library relies on, and its scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local(cpus: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Event timestamps are UTC microseconds, so the session must read days in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


class NoSharedFolder(RuntimeError):
    """Executors on other machines can't see a temporary folder of this one."""


# Scratch paths given out and not cleared yet; whoever reads a query's result keeps them.
_given: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where that is unset and the driver runs all tasks itself, as in local tests, a
    temporary folder takes its place, until the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise NoSharedFolder(
                f"set spark.checkpoint.dir to a folder that all executors of {master} share"
            )
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root, there until ``clear_scratch``."""
    path = f"{scratch_root(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    _given.add(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what scratch paths of this process hold, once no result is read any more.

    Results of queries are lazy and may still read scratch, so only their reader can say
    when that is.  Returns how many paths were given back.
    """
    from tidemark.sources import folders

    n = len(_given)
    while _given:
        folders.delete(spark, _given.pop())
    return n


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df`` written to a scratch path and read back.

    Whoever reads them several times does not recompute ``df``, and a lost executor
    costs a re-read, not the lineage behind it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
