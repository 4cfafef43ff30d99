"""Export-shaped raw rows derived from the ``events`` test table.

Every row of ``events`` gives one raw row.  The rows have what real exports have:
users and countries that are missing, days that do not parse, bags that are empty or
NULL, keys that repeat, that are NULL or never carry a value, and a numeric key that
occurs in both bags.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema.raw import PARAM_VALUE, PROPERTY_VALUE, RAW

_EXPRESSIONS = {
    "event_date": "CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE day_text END",
    "event_timestamp": "micros",
    "event_name": """CASE event_type
        WHEN 'signup' THEN 'first_open' WHEN 'purchase' THEN 'in_app_purchase'
        WHEN 'view' THEN 'paywall_view' WHEN 'error' THEN 'app_remove'
        ELSE CASE k % 3 WHEN 0 THEN 'send_prompt' WHEN 1 THEN 'prompt_result'
             ELSE 'chat_start' END END""",
    "event_previous_timestamp": "CASE WHEN event_id % 5 > 0 THEN micros - 1000 END",
    "event_value_in_usd":
        "CASE WHEN event_type = 'purchase' AND event_id % 7 <> 0 THEN value END",
    "event_bundle_sequence_id": "event_id",
    "event_server_timestamp_offset": "event_id % 1000",
    "user_id": "CASE WHEN event_id % 3 = 0 THEN concat('u-', CAST(user_id AS STRING)) END",
    "user_pseudo_id": """CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN ''
        ELSE CAST(user_id AS STRING) END""",
    "user_first_touch_timestamp": "micros - user_id * 1000000",
    "stream_id": "CASE WHEN user_id % 2 = 0 THEN '1001' ELSE '1002' END",
    "platform": """CASE WHEN event_id % 101 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'ANDROID'
        ELSE 'IOS' END""",
    "is_active_user": "CASE WHEN event_id % 9 > 0 THEN event_id % 2 = 0 END",
    "batch_event_index": "event_id % 10",
    "batch_page_id": "CASE WHEN event_id % 4 = 0 THEN event_id % 6 END",
    "batch_ordering_id": "event_id % 8",
    "event_original_occurrence_timestamp": "micros - 5000",
    "geo.country": "CASE WHEN user_id % 5 < 4 THEN concat('C', CAST(user_id % 5 AS STRING)) END",
    "app_info.version": "CASE WHEN k % 10 < 9 THEN concat('1.', CAST(k % 4 AS STRING)) END",
    "publisher.ad_revenue_in_usd": "CASE WHEN event_id % 17 = 0 THEN value / 100 END",
}

# Entries of the bags: key, sub-field, value, and when the entry is there.
PARAM_ENTRIES = (
    ("ga_session_id", "int_value", "session_id", "event_id % 10 > 0"),
    ("session_engaged", "int_value", "k % 2", "TRUE"),
    ("engagement_time_msec", "int_value", "k * 100", "event_id % 6 > 0"),
    ("k", "int_value", "k", "TRUE"),
    ("score", "double_value", "value", "TRUE"),
    ("screen-name", "string_value", "event_type", "event_id % 4 > 0"),
    ("7th_try", "float_value", "CAST(k AS DOUBLE)", "event_id % 8 = 0"),
    ("ga_session_id", "int_value", "session_id + 1", "event_id % 31 = 0"),
    (None, "int_value", "k", "event_id % 41 = 0"),
    ("blank", "string_value", "CAST(NULL AS STRING)", "event_id % 11 = 0"),
)
PROPERTY_ENTRIES = (
    ("user_id", "string_value", "concat('u-', CAST(user_id AS STRING))", "TRUE"),
    ("k", "int_value", "k", "event_id % 3 > 0"),
    ("_worth", "double_value", "value", "event_type = 'purchase'"),
)
# Filled fields of an item; only purchases have one.
ITEM_VALUES = {
    "item_id": "concat('item-', CAST(k AS STRING))", "price": "value", "quantity": "k % 3 + 1",
}
# When a bag has a NULL entry at its end, is empty, or is NULL as a whole.
NULL_ENTRY = "event_id % 37 = 0"
EMPTY_BAG = "event_id % 29 = 0"
NULL_BAG = "event_id % 59 = 0"


# Days on which something is amiss, by day of the month, and the rows concerned; the same
# text in both dialects.
FEW_USERS = "day(_dt) % 6 = 1 AND event_bundle_sequence_id % 3 = 0"
FEW_BAGS = "day(_dt) % 6 = 2 AND event_bundle_sequence_id % 2 = 0 OR day(_dt) % 6 = 3"
NO_NAMES = "day(_dt) % 6 = 4"
LOST = "day(_dt) % 6 = 5 AND event_bundle_sequence_id % 4 = 1"


# Rows of a task that writes a day: fewer are put together, more are parted. A row takes about
# 4 KB while it is sorted, and 140 bytes in a file.
FEW_ROWS = 10_000
MOST_ROWS = 250_000


def leaf_expression(path: str, kind: T.DataType, number: int) -> str:
    """SQL for one struct leaf, the same text in both dialects; NULL on some rows."""
    if path in _EXPRESSIONS:
        return _EXPRESSIONS[path]
    value = {
        "string": f"concat('{path.split('.')[-1]}-', CAST((user_id + {number}) % 5 AS STRING))",
        "bigint": f"user_id * 100 + {number}",
        "double": f"value + {number}",
    }[kind.simpleString()]
    return f"CASE WHEN (event_id + {number}) % 11 > 0 THEN {value} END"


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with the few values everything else is derived from."""
    moment = F.col("ts").cast("timestamp")
    micros = F.unix_micros(moment)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "value",
        micros.alias("micros"),
        F.col("ts").cast("date").alias("_dt"),
        F.date_format(moment, "yyyyMMdd").alias("day_text"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.floor(micros / F.lit(21_600_000_000)).cast("bigint").alias("session_id"),
    )


def _cast(text: str, kind: T.DataType) -> str:
    return f"CAST({text} AS {kind.simpleString()})"


def _struct(parts: dict[str, str]) -> str:
    return f"named_struct({', '.join(f"'{name}', {text}" for name, text in parts.items())})"


def _bag(entries, value_type: T.StructType) -> str:
    kind = full_type(value_type)
    made = []
    for key, sub_field, text, present in entries:
        value = {
            f.name: _cast(
                text if f.name == sub_field
                else "micros" if f.name == "set_timestamp_micros" and key else "NULL",
                f.dataType,
            )
            for f in value_type.fields
        }
        name = "CAST(NULL AS STRING)" if key is None else f"'{key}'"
        entry = _struct({"key": name, "value": _struct(value)})
        made.append(f"CASE WHEN {present} THEN {entry} END")
    full = f"array_compact(array({', '.join(made)}))"
    return (
        f"CASE WHEN {NULL_BAG} THEN NULL WHEN {EMPTY_BAG} THEN {_cast('array()', kind)} "
        f"WHEN {NULL_ENTRY} THEN array_append({full}, {_cast('NULL', kind.elementType)}) "
        f"ELSE {full} END"
    )


def full_type(value_type: T.StructType) -> T.ArrayType:
    return T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", value_type)
    ]))


def _filled(field: T.StructField, path: str, numbers) -> str:
    if path == "event_params":
        return _bag(PARAM_ENTRIES, PARAM_VALUE)
    if path == "user_properties":
        return _bag(PROPERTY_ENTRIES, PROPERTY_VALUE)
    if path == "items":
        item = _struct({
            f.name: _cast(ITEM_VALUES.get(f.name, "NULL"), f.dataType)
            for f in field.dataType.elementType.fields
        })
        return f"CASE WHEN event_type = 'purchase' THEN array({item}) END"
    if isinstance(field.dataType, T.StructType):
        return _struct({
            f.name: _filled(f, f"{path}.{f.name}", numbers) for f in field.dataType.fields
        })
    number = next(numbers) if "." in path else 0
    return _cast(leaf_expression(path, field.dataType, number), field.dataType)


def dealt(rows: DataFrame, *keys: Column, most: int | None = MOST_ROWS) -> DataFrame:
    """Source rows by day (or by other keys, a few a day), so that tasks can write days as they are.

    A key of more than ``most`` rows, unless that is None, is parted; small ones share a task. It
    is the narrow rows that are shuffled, not the fifty times wider ones made of them.
    """
    names = [f"key{i}" for i in range(len(keys or "d"))]
    keyed = rows.withColumns(dict(zip(names, keys or (F.col("_dt"),))))
    sizes = keyed.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names)
    places, at, held = [], 0, 0
    for row in sizes.collect():  # one row a calendar day and key
        parts = -(-row["n"] // most) if most else 1
        if held and (held + row["n"] > FEW_ROWS or parts > 1):
            at, held = at + 1, 0
        places.append((*[row[c] for c in names], at, parts))
        held += row["n"]
        if parts > 1:
            at, held = at + parts, 0
    kinds = ", ".join(f"have{i} {sizes.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    where = rows.sparkSession.createDataFrame(places, f"{kinds}, at int, parts int")
    same = [F.col(c).eqNullSafe(F.col(f"have{i}")) for i, c in enumerate(names)]
    number = F.col("at") + F.pmod(F.xxhash64("event_id"), F.col("parts"))
    tasks = max((p[-2] + p[-1] for p in places), default=1)
    placed = keyed.join(F.broadcast(where), same, "left").repartitionById(tasks, number.cast("int"))
    return placed.select(rows.columns)


def spread(rows: DataFrame) -> DataFrame:
    """Source rows dealt evenly: a task for each core at least, ``MOST_ROWS`` in a task at most.

    Files of few row groups are read by as few tasks, however many cores there are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // MOST_ROWS)))


def exported(
    spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Rows as an export has them -- the declared source columns -- and ``_dt``.

    ``deal`` shuffles the rows that they are made of.
    """
    numbers = itertools.count()
    columns = [f"{_filled(f, f.name, numbers)} AS {f.name}" for f in RAW.fields]
    return deal(source(spark, sf_dir)).selectExpr(*columns, "_dt")


def loaded(
    spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Rows as the raw table stores them: NULL replaced where a column is non-null."""
    from tidemark.sources import raw

    return raw.with_defaults(exported(spark, sf_dir, deal))


def uneven(rows: DataFrame) -> DataFrame:
    """Days on which users are missing, bags are empty, or all bags are."""
    user, bag = F.col("user_pseudo_id"), F.col("event_params")
    return rows.withColumns({
        "user_pseudo_id": F.when(F.expr(FEW_USERS), None).otherwise(user),
        "event_params": F.when(
            F.expr(FEW_BAGS), F.array().cast(rows.schema["event_params"].dataType)
        ).otherwise(bag),
    })


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows of such days, and of days without any event name."""
    name = F.when(F.expr(NO_NAMES), None).otherwise(F.col("event_name"))
    return uneven(loaded(spark, sf_dir)).withColumn("event_name", name)
