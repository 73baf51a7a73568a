"""Binary row keys of the history tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK = 0xFFFFFFFF


def _big_endian(value: Column, nbytes: int) -> Column:
    return F.unhex(F.lpad(F.hex(value), 2 * nbytes, "0"))


def string_hash(text) -> Column:
    """Unsigned 32-bit h = h*33 + c over UTF-16 units from 5381; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    start = F.lit(5381).cast("bigint")

    def add(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        above = code - 0x10000
        pair = (h * 33 + (F.shiftright(above, 10) + 0xD800)) * 33 + (above.bitwiseAND(F.lit(0x3FF)) + 0xDC00)
        return F.when(code < 0x10000, h * 33 + code).otherwise(pair).bitwiseAND(F.lit(_MASK))

    folded = F.aggregate(F.split(text, ""), start, add)
    return F.when(text.isNull(), F.lit(0).cast("bigint")).when(text == "", start).otherwise(folded)


def bytes_hash(text) -> Column:
    return _big_endian(string_hash(text), 4)


def time_bytes(ms) -> Column:
    return _big_endian(F.col(ms) if isinstance(ms, str) else ms, 8)


def row_key(*parts: Column) -> Column:
    return F.concat(*parts)
