"""What keys the bags hold: discovery for the registry, and a fuller profile.

Both unnest a bag and count per key.  The counts are combined inside each task
before the shuffle, so a key present in every event still crosses it as one row
per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schema.flat import SOURCES, SUB_FIELDS


def entries(raw: DataFrame, source: str) -> DataFrame:
    """One row per bag entry: _dt, key, value.  Events with an empty bag have none."""
    return raw.select("_dt", F.explode(source).alias("p")).select("_dt", "p.key", "p.value")


def discover_keys(raw: DataFrame) -> DataFrame:
    """Non-NULL values per day, bag, key and sub-field: _dt, source, key, sub_field, n.

    A sub-field that is NULL on every entry of a key is left out.
    """
    counts = None
    for source in SOURCES:
        per_key = (
            entries(raw, source)
            .groupBy("_dt", "key")
            .agg(*[F.count(F.col("value")[sub]).alias(sub) for sub in SUB_FIELDS])
            .withColumn("source", F.lit(source))
        )
        counts = per_key if counts is None else counts.unionByName(per_key)
    return counts.unpivot(
        ["_dt", "source", "key"], list(SUB_FIELDS), "sub_field", "n"
    ).filter("n > 0")


def profile_keys(raw: DataFrame, source: str, sub_fields: Sequence[str]) -> DataFrame:
    """Per key of one bag: values per sub-field, entries, and a sample text.

    The sample is the smallest text of the key, so that a re-run shows the same one;
    NULL if no entry has a text.  Most frequent keys first.
    """
    value = F.col("value")
    return (
        entries(raw, source)
        .groupBy("key")
        .agg(
            *[F.count(value[sub]).alias(f"n_{sub}") for sub in sub_fields],
            F.count("*").alias("n_total"),
            F.min(value["string_value"]).alias("sample"),
        )
        .orderBy(F.desc("n_total"), "key")
    )


def profile_event_params(raw: DataFrame) -> DataFrame:
    return profile_keys(raw, "event_params", list(SUB_FIELDS))


def profile_user_properties(raw: DataFrame) -> DataFrame:
    return profile_keys(raw, "user_properties", [*SUB_FIELDS, "set_timestamp_micros"])
