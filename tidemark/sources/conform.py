"""Columns of one type as columns of a declared type, nested parts matched by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(kind: T.StructType, name: str) -> T.StructField | None:
    """A field by its name, whatever the case."""
    return next((f for f in kind.fields if f.name.lower() == name.lower()), None)


def readable(declared: T.DataType, actual: T.DataType, name: str = "") -> T.DataType:
    """The type to read so that only declared parts are read, each as its file has it."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(declared, T.StructType) and isinstance(actual, T.StructType):
        fields = []
        for want in declared.fields:
            have = _field(actual, want.name)
            kind = want.dataType if have is None else readable(want.dataType, have.dataType, f"{name}.{want.name}")
            fields.append(T.StructField(want.name, kind))
        return T.StructType(fields)
    if isinstance(declared, T.ArrayType) and isinstance(actual, T.ArrayType):
        return T.ArrayType(readable(declared.elementType, actual.elementType, name))
    if isinstance(declared, nested) != isinstance(actual, nested):
        raise ValueError(f"{name.lstrip('.')} can't be read as {declared.simpleString()}: it is {actual.simpleString()}")
    return actual


def conformed(column: Column, actual: T.DataType, declared: T.DataType) -> Column:
    """A column read as ``readable`` says, cast where its type is not the declared one.

    A value that can't be cast raises, as the day that holds it is not sound.
    """
    if actual == declared:
        return column
    if isinstance(declared, T.StructType):
        parts = [
            conformed(column[have.name], have.dataType, want.dataType).alias(want.name)
            for have, want in zip(actual.fields, declared.fields)
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(declared, T.ArrayType):
        return F.transform(column, lambda x: conformed(x, actual.elementType, declared.elementType))
    return column.cast(declared)
