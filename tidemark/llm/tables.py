"""The given tables, and what several operators do with rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back.

    What follows reads files, so a lost executor costs a re-read; and both sides of a join on
    such tables are plain exchanges, whose hot partitions adaptive execution can split.
    """
    return session.stored(df, session.scratch_path(df.sparkSession, name))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of one's own that ``df`` does not have, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
