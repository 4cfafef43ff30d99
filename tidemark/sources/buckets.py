"""Day-partitioned tables that are also dealt into buckets by a key, so that grouping or joining
by the key needs no shuffle, over however many days.

Spark knows buckets of catalog tables only. The catalog entry is made anew by whoever opens the
table; what stays is the folder, with the number of buckets in a small file beside the days.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import folders, partitions

NOTE = "_buckets"


class BucketsUnknown(ValueError):
    """A folder holds data but does not tell how many buckets it was dealt into."""


class BucketedDays:
    """A table of rows with a day (``_dt``), dealt by ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int | None = None):
        """``buckets``: for a new table, by default as many as the session has shuffle partitions."""
        self.spark, self.path, self.key = spark, path, key
        self.fields = [f.name for f in T.StructType.fromDDL(schema).fields if f.name != "_dt"]
        self.buckets = self._kept(buckets)
        self.name = "tidemark_days_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # the entry only
        spark.sql(
            f"CREATE TABLE {self.name} ({schema}) USING parquet PARTITIONED BY (_dt) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{escaped}'"
        )
        if folders.stored_days(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def _kept(self, asked: int | None) -> int:
        note = f"{self.path}/{NOTE}"
        if folders.exists(self.spark, note):
            return int(folders.read(self.spark, note))
        if folders.stored_days(self.spark, self.path):
            raise BucketsUnknown(f"{self.path} has days, but no {NOTE}")
        new = asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        folders.overwrite(self.spark, note, str(new).encode())
        return new

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, df: DataFrame, days: Collection[date]) -> None:
        """Make the rows of ``df`` the whole content of the given days."""
        if not days:
            return
        rows = df.filter(F.col("_dt").isin(sorted(days))).select(*self.fields, "_dt")
        setting, before = "spark.sql.sources.partitionOverwriteMode", None
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            rows.repartition(self.buckets, self.key).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(setting, before)
        written = {r["_dt"] for r in rows.select("_dt").distinct().collect()}  # one a day
        gone = set(days) - written
        for day in sorted(gone & set(folders.stored_days(self.spark, self.path))):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (_dt = DATE '{day}')")
        partitions.drop_days(self.spark, self.path, gone)
