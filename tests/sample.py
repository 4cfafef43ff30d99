"""The small nested sample: three events of one day, and one event with a new key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schema.raw import DEVICE, PARAMS, PROPERTIES

DAY = "2099-01-01"

# Another field order than declared; only some of the declared columns.
GEO = T.StructType([
    T.StructField(n, T.StringType())
    for n in ("continent", "sub_continent", "country", "region", "city", "metro")
])
SCHEMA = T.StructType([
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_params", PARAMS),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("user_properties", PROPERTIES),
    T.StructField("device", DEVICE),
    T.StructField("geo", GEO),
    T.StructField("platform", T.StringType()),
])


def param(key, string=None, integer=None, floating=None, double=None):
    return (key, (string, integer, floating, double))


def prop(key, string=None, integer=None, double=None, set_at=None):
    return (key, (string, integer, None, double, set_at))


def event(ts, name, user, params, properties=(), date="20990101", platform="ANDROID"):
    device = ("mobile",) + (None,) * 4 + ("Android",) + (None,) * 8 + (("Chrome", None, None),)
    geo = ("Asia", None, "Vietnam", None, None, None)
    return (date, ts, name, list(params), user, list(properties), device, geo, platform)


def first_rows():
    return [
        event(1000, "session_start", "dev-7",
              [param("ga_session_id", integer=123), param("page", "home")],
              [prop("_worth", double=1.5, set_at=417), prop("user_id", "acc-9")]),
        event(2000, "screen_view", "p-2", []),
        event(3000, "blank_event", None, [param("blank")]),
    ]


def new_key_row():
    return event(4000, "new_key_event", "dev-7", [param("fresh_key", "grüezi")])


def frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def write_day(spark: SparkSession, rows, root: str, folder: str = f"dt={DAY}") -> None:
    frame(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{root}/{folder}")
