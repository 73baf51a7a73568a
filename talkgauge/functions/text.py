"""`key=(value)` pairs of a log line's quoted content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR = r"(\w+)=\(([^\)]*)\)"


def kv_arrays(content: Column) -> tuple[Column, Column]:
    """Keys and values of all pairs, last one first, so the first hit wins."""
    keys, values = (F.regexp_extract_all(content, F.lit(PAIR), F.lit(g)) for g in (1, 2))
    return F.reverse(keys), F.reverse(values)


def kv_get(keys: Column, values: Column, name: Column) -> Column:
    """Value of the key `name`; null if it is absent."""
    return F.get(values, (F.array_position(keys, name) - 1).cast("int"))


def kv_table(content: Column) -> Column:
    """Array of (key, value), one entry per key, the last duplicate winning."""
    keys, values = kv_arrays(content)
    rows = F.arrays_zip(keys.alias("key"), values.alias("value"))
    return F.filter(rows, lambda r, i: F.array_position(keys, r["key"]) == i + 1)
