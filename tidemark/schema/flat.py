"""Fixed columns of the wide flat table, derived from the raw schema by rule.

A raw scalar keeps its name.  A struct field becomes ``<prefix>_<field>``, a
field two levels down ``<prefix>_<group>_<field>``.  The key-value bags are not
here: their columns are found in the data, see ``operators.registry``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.schema.raw import RAW

# Flat column prefix of each raw struct, by path.
PREFIX = {
    "privacy_info": "privacy",
    "event_dimensions": "event_dimensions",
    "user_ltv": "user_ltv",
    "device": "device",
    "device.web_info": "device_web",
    "geo": "geo",
    "app_info": "app_info",
    "traffic_source": "traffic_source",
    "collected_traffic_source": "cts",
    "session_traffic_source_last_click.manual_campaign": "stlc_manual",
    "session_traffic_source_last_click.google_ads_campaign": "stlc_gads",
    "session_traffic_source_last_click.cross_channel_campaign": "stlc_cross",
    "session_traffic_source_last_click.sa360_campaign": "stlc_sa360",
    "session_traffic_source_last_click.cm360_campaign": "stlc_cm360",
    "session_traffic_source_last_click.dv360_campaign": "stlc_dv360",
    "publisher": "publisher",
}

# Kept in raw only.
RAW_ONLY = {
    "ecommerce", "items", "event_params", "user_properties",
    "event_original_occurrence_timestamp",
}


@dataclass(frozen=True)
class FlatColumn:
    """One fixed flat column: its name, type and raw source path."""

    name: str
    type: T.DataType
    path: str

    def sql(self) -> str:
        """The column as a select expression over raw rows."""
        return f"{_COMPUTED.get(self.name, self.path)} AS {self.name}"


# Day of ``event_date`` or, when that is malformed, of the partition; UTC moment.
_COMPUTED = {
    "event_date": "coalesce(try_to_date(event_date, 'yyyyMMdd'), _dt)",
    "event_ts": "timestamp_micros(event_timestamp)",
}


def _leaves(struct: T.StructType, path: str) -> Iterator[FlatColumn]:
    for field in struct.fields:
        here = f"{path}.{field.name}"
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield FlatColumn(f"{PREFIX[path]}_{field.name}", field.dataType, here)


def _base() -> Iterator[FlatColumn]:
    nested = []
    for field in RAW.fields:
        if field.name in RAW_ONLY:
            continue
        if isinstance(field.dataType, T.StructType):
            nested += list(_leaves(field.dataType, field.name))
        elif field.name == "event_date":
            yield FlatColumn("event_date", T.DateType(), "event_date")
        else:
            yield FlatColumn(field.name, field.dataType, field.name)
            if field.name == "event_timestamp":
                yield FlatColumn("event_ts", T.TimestampType(), "event_timestamp")
    yield from nested


BASE: tuple[FlatColumn, ...] = tuple(_base())

METADATA = T.StructType([
    T.StructField("_dt", T.DateType()),
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_run_id", T.StringType()),
])

# Suffix and column type of each sub-field, in naming order.
SUB_FIELDS = {
    "string_value": ("str", T.StringType()),
    "int_value": ("int", T.LongType()),
    "float_value": ("float", T.DoubleType()),
    "double_value": ("double", T.DoubleType()),
}

# Bag columns in naming order, with the prefix their columns get on a name clash.
SOURCES = {"event_params": "ep", "user_properties": "up"}


def reserved_names() -> list[str]:
    """Names that no discovered column may take."""
    return [column.name for column in BASE] + METADATA.names
