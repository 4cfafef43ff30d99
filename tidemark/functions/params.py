"""Lookups in a key-value bag (``event_params`` or ``user_properties``).

Lookups go through the arrays of keys and values (``bag.key``, ``bag.value``), not
through a lambda over the entries: the position search is generated code, and a
Parquet scan then reads only the key and the one sub-field asked for.  A key that
occurs twice gives its first value; an absent key gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keys(bag: Column) -> Column:
    """Keys of the bag, in order."""
    return bag["key"]


def _place(bag: Column, key: str) -> Column:
    """0-based place of the first entry with this key, -1 if none."""
    return F.array_position(keys(bag), F.lit(key)) - 1


def value(bag: Column, key: str, sub_field: str) -> Column:
    """One sub-field of the first entry with this key."""
    return F.get(bag["value"][sub_field], _place(bag, key))


def has_key(bag: Column, key: str) -> Column:
    """Whether any entry has this key; FALSE for a NULL bag."""
    return F.coalesce(F.array_contains(keys(bag), key), F.lit(False))


def count(bag: Column) -> Column:
    """Number of entries; 0 for a NULL bag."""
    return F.coalesce(F.size(keys(bag)), F.lit(0))
