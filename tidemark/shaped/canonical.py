"""Nested values as one text that reads the same in both dialects.

``~`` stands for NULL; parts of a struct are parted by ``;``, entries of an array by ``,``.  Doubles
are shown as whole thousandths, as the dialects write them differently.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.schema.raw import RAW

NESTED = [f.name for f in RAW.fields if isinstance(f.dataType, (T.ArrayType, T.StructType))]


def text(value: str, kind: T.DataType, spark: bool, depth: int = 0) -> str:
    """SQL of the text of ``value``."""
    if isinstance(kind, T.ArrayType):
        name = f"x{depth}"
        inner = text(name, kind.elementType, spark, depth + 1)
        if spark:
            listed = f"array_join(transform({value}, {name} -> {inner}), ',')"
        else:
            listed = f"array_to_string(list_transform({value}, lambda {name}: {inner}), ',')"
        return f"CASE WHEN {value} IS NULL THEN '~' ELSE concat('[', {listed}, ']') END"
    if isinstance(kind, T.StructType):
        parts = ", ';', ".join(text(f"{value}.{f.name}", f.dataType, spark, depth) for f in kind.fields)
        return f"CASE WHEN {value} IS NULL THEN '~' ELSE concat('{{', {parts}, '}}') END"
    if isinstance(kind, T.DoubleType):
        value = f"CAST(round({value} * 1000) AS BIGINT)"
    return f"coalesce(CAST({value} AS {'STRING' if spark else 'VARCHAR'}), '~')"


def whole_row(spark: bool, absent: tuple[str, ...] = ()) -> list[str]:
    """Every declared column, the nested ones as texts; ``absent`` ones are NULL."""
    made = []
    for field in RAW.fields:
        if field.name in absent and field.name in NESTED:
            value = "'~'"
        elif field.name in absent:
            kind = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
            value = f"CAST(NULL AS {kind[field.dataType.simpleString()]})"
        else:
            value = text(field.name, field.dataType, spark) if field.name in NESTED else field.name
        made.append(f"{value} AS {field.name}")
    return made
