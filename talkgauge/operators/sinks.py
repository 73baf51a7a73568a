"""History tables with binary row keys, reports and current-state tables.

History keeps every row; `latest_per_key` is the overwrite view, where a later
arrival with the same key replaces the earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.functions.jsons import json_out
from talkgauge.functions.keys import bytes_hash, row_key, time_bytes
from talkgauge.schemas import (
    ACTION_COLUMNS, DAY_MS, GROUP_EVENT_COLUMNS, SESSION_COLUMNS, SPEAKING_COLUMNS,
)

# Row key parts of each table; h hashes a column, t is a time.
ROW_KEYS = {
    "user_action": "h:company h:uid t:ts_ms h:event",
    "user_session": "h:company t:login_ms t:logout_ms h:uid",
    "group_event": "h:gcompany h:gid t:ts_ms h:event",
    "temp_group_event": "h:gcompany t:ts_ms h:svc h:gid h:event",
    "group_speaking": "h:gcompany h:gid t:start_ms t:end_ms h:uid",
    "temp_group_speaking": "h:gcompany t:start_ms t:end_ms h:uid h:gid",
    "load": "h:entity t:bucket",
}
TABLE_COLUMNS = {
    "user_action": ACTION_COLUMNS,
    "user_session": SESSION_COLUMNS,
    "group_event": GROUP_EVENT_COLUMNS,
    "temp_group_event": GROUP_EVENT_COLUMNS,
    "group_speaking": SPEAKING_COLUMNS,
    "temp_group_speaking": SPEAKING_COLUMNS,
}


def table_key(table: str) -> Column:
    parts = [p.split(":") for p in ROW_KEYS[table].split()]
    return row_key(*[bytes_hash(c) if how == "h" else time_bytes(c) for how, c in parts])


def with_row_key(rows: DataFrame, table: str) -> DataFrame:
    return rows.withColumn("row_key", table_key(table))


def latest_per_key(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(row_key, columns) of the last arrival per key; partial aggregation first."""
    return (
        rows.groupBy("row_key").agg(F.max(F.struct("seq", *columns)).alias("last"))
        .select("row_key", *[F.col("last")[c].alias(c) for c in columns])
    )


def table_view(rows: DataFrame, table: str) -> DataFrame:
    return latest_per_key(with_row_key(rows, table), TABLE_COLUMNS[table])


# The time that dates a row of each history table.
TABLE_TIMES = {
    "user_action": "ts_ms",
    "user_session": "logout_ms",
    "group_event": "ts_ms",
    "temp_group_event": "ts_ms",
    "group_speaking": "end_ms",
    "temp_group_speaking": "end_ms",
    "load": "bucket",
}


def _dated(rows: DataFrame, ms: str) -> DataFrame:
    days = F.floor(F.col(ms) / DAY_MS).cast("int")
    return rows.withColumn("date", F.date_add(F.lit("1970-01-01").cast("date"), days))


def history_rows(rows: DataFrame, table: str) -> DataFrame:
    """All rows of a history table with their key and date."""
    return _dated(with_row_key(rows, table), TABLE_TIMES[table])


def replace_dates(rows: DataFrame, path: str) -> None:
    """Write rows by `date`, in place of what is there for the dates they have.

    A repeated run writes the same dates again and doubles nothing; a run must
    hold all rows of its dates.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def write_history(rows: DataFrame, table: str, folder: str) -> None:
    """Put whole days of a history table into `folder`/`table`."""
    replace_dates(history_rows(rows, table), f"{folder}/{table}")


def write_hour_report(load: DataFrame, measures: list[str], name: str, folder: str) -> None:
    """Put whole days of hour reports into `folder`/`name`."""
    replace_dates(_dated(hour_report(load, measures), "bucket"), f"{folder}/{name}")


def hour_report(load: DataFrame, measures: list[str]) -> DataFrame:
    """Hour loads as (row_key, entity, bucket, report), the report as JSON."""
    return with_row_key(load, "load").select(
        "row_key", "entity", "bucket", json_out({m: m for m in measures}).alias("report")
    )


def state_values(parts: dict[str, DataFrame]) -> DataFrame:
    """(key, value) of `user:<uid>:<name>` from (uid, value) tables by name; nulls are not kept."""
    out = None
    for name, rows in parts.items():
        uid, value = rows.columns
        entries = rows.where(F.col(value).isNotNull()).select(
            F.concat(F.lit("user:"), uid, F.lit(f":{name}")).alias("key"), F.col(value).alias("value")
        )
        out = entries if out is None else out.unionByName(entries)
    return out


def state_sets(parts: dict[str, DataFrame]) -> DataFrame:
    """(key, member) of sets, from key patterns to tables.

    `server:<svc>:user` takes its key from the column `svc` and its members
    from the other column; a pattern without `<` names one set.
    """
    out = None
    for pattern, rows in parts.items():
        head, _, rest = pattern.partition("<")
        column, _, tail = rest.partition(">")
        (member,) = [c for c in rows.columns if c != column]
        key = F.concat(F.lit(head), F.col(column), F.lit(tail)) if column else F.lit(pattern)
        entries = rows.select(key.alias("key"), F.col(member).alias("member"))
        out = entries if out is None else out.unionByName(entries)
    return out


def appload(server_load: DataFrame) -> DataFrame:
    """Second loads as (key, value) messages for the channel of their server."""
    fields = ["server", "bucket", "userLoad", "groupLoad", "speakLoad"]
    return server_load.select(
        F.concat(F.lit("appload-"), "server").alias("key"), "bucket",
        json_out({f: f for f in fields}).alias("value"),
    )


def publish_appload(server_load: DataFrame, servers: str, topic: str = "appload") -> None:
    """Send second loads to Kafka, keyed by channel, so one server's stay in order."""
    appload(server_load).select("key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic).save()


def write_appload(server_load: DataFrame, path: str) -> None:
    """Put whole days of messages into files, in place of those days' files."""
    _dated(appload(server_load), "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("date").json(path)
