"""Event-time arithmetic on BIGINT epoch milliseconds.

Text is read and written as UTC wall time by date arithmetic alone, so results
do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgauge.schemas import MINUTE_MS, SECOND_MS

STANDARD_DT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_to(ms, width: int) -> Column:
    """Start of the bucket of `width` ms that holds `ms`."""
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(width).cast("bigint"))


def ceil_to(ms, width: int) -> Column:
    """First multiple of `width` at or after `ms`."""
    return floor_to(_col(ms) + (width - 1), width)


def second_bucket(ms) -> Column:
    return floor_to(ms, SECOND_MS)


def minute_bucket(ms) -> Column:
    return floor_to(ms, MINUTE_MS)


def minute_mark(ms) -> Column:
    """Minute boundary whose report is the first to see `ms`."""
    return ceil_to(ms, MINUTE_MS)


def interval_seconds(from_ms, to_ms) -> Column:
    """Whole seconds between two epoch-ms values, `to_ms` not the earlier one."""
    return (floor_to(_col(to_ms) - _col(from_ms), SECOND_MS) / 1000).cast("bigint")


def epoch_days(date: Column) -> Column:
    return F.date_diff(date, F.lit("1970-01-01").cast("date")).cast("bigint")


def format_dt(ms) -> Column:
    """`yyyy-MM-dd HH:mm:ss.SSS` text of an epoch-ms value."""
    ms = _col(ms)
    millis = F.pmod(ms, F.lit(1000).cast("bigint"))
    seconds = F.timestamp_add("SECOND", F.floor(ms / 1000), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.concat(seconds.cast("string"), F.lit("."), F.lpad(millis.cast("string"), 3, "0"))


def parse_dt(text) -> Column:
    """Epoch ms of standard text, null where the text is not in that format."""
    text = _col(text)

    def num(start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    seconds = (
        epoch_days(F.substring(text, 1, 10).try_cast("date")) * 86400
        + num(12, 2) * 3600 + num(15, 2) * 60 + num(18, 2)
    )
    return F.when(text.rlike(STANDARD_DT), seconds * 1000 + num(21, 3))


def ntz_micros(ts) -> Column:
    """Microseconds of a TIMESTAMP_NTZ since 1970-01-01 00:00."""
    ts = _col(ts)
    seconds = epoch_days(ts.cast("date")) * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
