"""Raw rows to flat rows: fixed columns by path, discovered columns by lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import params
from tidemark.operators.registry import DynamicColumn
from tidemark.schema.flat import BASE, SOURCES


def base_columns(raw: DataFrame, *others: str) -> DataFrame:
    """The fixed flat columns, ``_dt`` and any other raw columns asked for."""
    return raw.selectExpr(*[column.sql() for column in BASE], "_dt", *others)


def flatten(raw: DataFrame, dynamic: list[DynamicColumn], run_id: str) -> DataFrame:
    """One flat row per raw row: a single projection, no shuffle.

    The keys of a bag, the values of a sub-field and the place of a key are common to
    all columns that ask for them, and are worked out once per row.  A projection that
    first made a map of each bag took longer: the wide row is then copied once more.
    """
    bags = {source: F.col(source) for source in SOURCES}
    return raw.select(
        *[F.expr(column.sql()) for column in BASE],
        *[params.value(bags[c.source], c.key, c.sub_field).alias(c.name) for c in dynamic],
        "_dt",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(run_id).alias("_run_id"),
    )
