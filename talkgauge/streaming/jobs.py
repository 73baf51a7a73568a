"""The job as linked streaming queries, each writing a table the next one reads.

Every query keeps its offsets and state in a checkpoint below the shared
folder, and the file sink commits each trigger's files once, so a lost executor
or driver repeats a trigger without repeating its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from talkgauge.operators.enrich import filter_speak, group_events, user_actions
from talkgauge.operators.parse import parse_logs
from talkgauge.operators.loads import server_load_second
from talkgauge.operators.sinks import appload, history_rows, hour_report
from talkgauge.schemas import (
    GROUP_NORMAL, GROUP_TEMP, LATE_MS, SPEAK_HOUR_MEASURES, USER_BROKEN, USER_HOUR_MEASURES, USER_OFFLINE, USER_ONLINE,
)
from talkgauge.sources.logs import BATCH_LINES, TOPIC_PARTITIONS, raw_from_kafka
from talkgauge.sources.org import group_org, read_dims, user_org
from talkgauge.streaming.clocks import closed_seconds
from talkgauge.streaming.hours import stream_hour_merge, stream_speak_hours, stream_user_hours
from talkgauge.streaming.processors import (
    SPEAK_TIMES, USER_TIMES, load_schema, online_event_columns, session_columns, stream_accepted,
    stream_group_load, stream_group_steps, stream_load, stream_online, stream_server_record,
    stream_speak_changes, stream_speaking, stream_user_changes,
)
from talkgauge.streaming.sets import stream_group_sets, stream_seen_sets, stream_user_sets

#: Files that a trigger of a linked query takes on.
FILES_PER_TRIGGER = 1000

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def use_state_store(spark: SparkSession) -> None:
    """Keep state in RocksDB, which the machines need and which spills to disk."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def write_table(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to a Parquet table; `once` stops after what is there now."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def write_batches(rows: DataFrame, path: str, checkpoint: str, make: Callable[[DataFrame, int], DataFrame],
                  once: bool = False) -> StreamingQuery:
    """Write what `make` gives for each trigger's rows to `path`/batch=<id>.

    A trigger that is repeated after its files were committed is left alone, so
    queries that follow the table never meet its rows twice.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if not _exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            make(batch, batch_id).write.mode("overwrite").parquet(folder)

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_log(records: DataFrame, path: str, checkpoint: str, partitions: int = TOPIC_PARTITIONS,
            once: bool = False) -> StreamingQuery:
    """Kafka records to a table of (seq, line): each trigger's lines are sorted and numbered.

    Triggers follow each other in time, and the number of a trigger leads `seq`.
    """
    def number(batch: DataFrame, batch_id: int) -> DataFrame:
        lines = raw_from_kafka(batch, partitions)
        return lines.withColumn("seq", F.col("seq") + F.lit(batch_id * BATCH_LINES))

    return write_batches(records, path, checkpoint, number, once)


def run_actions(raw: DataFrame, read_org: Callable[[], DataFrame], path: str, checkpoint: str,
                once: bool = False) -> StreamingQuery:
    """Raw lines to actions; `read_org` reads the users' organisation anew for each trigger."""
    return write_batches(raw, path, checkpoint, lambda lines, _: user_actions(parse_logs(lines), read_org()), once)


def run_group_events(action: DataFrame, read_org: Callable[[], DataFrame], path: str, checkpoint: str,
                     once: bool = False) -> StreamingQuery:
    """Actions to group events; `read_org` reads the groups' organisation anew for each trigger."""
    return write_batches(action, path, checkpoint, lambda rows, _: group_events(rows, read_org()), once)


def run_history(rows: DataFrame, table: str, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A stream's rows with key and date to `folder`/`table`/batch=<id>."""
    return write_batches(rows, f"{folder}/{table}", checkpoint, lambda batch, _: history_rows(batch, table), once)


def run_hour_reports(hours: DataFrame, measures: list[str], path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A stream's hour reports with key and JSON to `path`/batch=<id>."""
    return write_batches(hours, path, checkpoint, lambda rows, _: hour_report(rows, measures), once)


def stream_actions(raw: DataFrame, user_org: DataFrame) -> DataFrame:
    """Actions of a stream of raw lines; the organisation is joined as a static table."""
    return user_actions(parse_logs(raw), user_org)


def stream_group_events(action: DataFrame, group_org: DataFrame) -> DataFrame:
    return group_events(action, group_org)


def read_table(spark: SparkSession, path: str, schema, files_per_trigger: int) -> DataFrame:
    """Follow a Parquet table as a stream; its folder is made if the writer has not started yet.

    `files_per_trigger` bounds what a trigger takes on, after an outage too.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", files_per_trigger
    ).parquet(path)


def with_event_time(rows: DataFrame, ms: str = "ts_ms") -> DataFrame:
    return rows.withColumn("ts", F.timestamp_millis(ms))


def second_counts(rows: DataFrame, entity: str, late_seconds: int = LATE_MS // 1000) -> DataFrame:
    """(entity, bucket, n) of closed seconds; rows over four seconds late are dropped.

    The watermark is the whole query's newest time, and late rows are judged by
    that of the trigger before, so a server lagging behind the others needs a
    larger `late_seconds`, and a row just too late may still count.
    """
    counted = (
        with_event_time(rows).withWatermark("ts", f"{late_seconds} seconds")
        .groupBy(entity, F.window("ts", "1 second")).agg(F.count("*").alias("n"))
    )
    return counted.select(entity, F.unix_millis("window.start").alias("bucket"), "n")


def user_seconds(online: DataFrame, entity: str) -> DataFrame:
    """(entity, uid, bucket) of closed seconds, with 1 where the user went on, off or broken."""
    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        flags = {n: (rows["event"] == e).astype("int64") for n, e in
                 zip(USER_TIMES, (USER_ONLINE, USER_OFFLINE, USER_BROKEN))}
        return pd.DataFrame({"uid": rows["uid"], **flags}).groupby("uid", as_index=False).max()

    rows = online.withColumnRenamed(entity, "entity").select("entity", "seq", "ts_ms", "uid", "event")
    return closed_seconds(rows, ["uid", "event"], reduce, _second_schema(USER_TIMES, []))


def speak_seconds(group_event: DataFrame, entity: str) -> DataFrame:
    """(entity, uid, bucket) of closed seconds, with event counts and the last get, release or loss."""
    events = ("GET_MIC", "LOSTMIC_AUTO", "LOSTMIC_REPLACE", "DENT_MIC")

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {n: (rows["event"] == e).astype("int64") for n, e in zip(SPEAK_TIMES, events)}
        out = pd.DataFrame({"uid": rows["uid"], **counts}).groupby("uid").sum()
        op = rows[rows["event"] != "DENT_MIC"].groupby("uid")["event"].last()
        op = op.reindex(out.index).astype(object)
        return out.assign(op=op.where(op.notna(), None)).reset_index()

    rows = filter_speak(group_event).withColumnRenamed(entity, "entity").select("entity", "seq", "ts_ms", "uid", "event")
    return closed_seconds(rows, ["uid", "event"], reduce, _second_schema(SPEAK_TIMES, ["op"]))


def _second_schema(times: list[str], strings: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in ("entity", "uid")]
                        + [T.StructField(n, T.LongType()) for n in ["bucket", *times]]
                        + [T.StructField(n, T.StringType()) for n in strings])


def entity_seconds(changes: DataFrame, times: list[str]) -> DataFrame:
    """Users' changes added up per (entity, bucket, at) within each task, so no task gets an entity's users.

    The users of a second close together and so come in one trigger.
    """
    keys, sums = ["entity", "bucket", "at"], [*times, "delta"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.groupby(keys, as_index=False)[sums].sum()

    return changes.select(*keys, *sums).mapInPandas(
        run, ", ".join(["entity string", *[f"{c} long" for c in [*keys[1:], *sums]]]))


def user_load_stream(online: DataFrame, entity: str) -> DataFrame:
    """Second loads of users: clocks, seconds, users, and entities are steps of one query."""
    changes = stream_user_changes(user_seconds(online, entity))
    return stream_load(entity_seconds(changes, USER_TIMES), "onlines", USER_TIMES)


def speak_load_stream(group_event: DataFrame, entity: str) -> DataFrame:
    """Second loads of speaking, in one query as well."""
    changes = stream_speak_changes(speak_seconds(group_event, entity))
    return stream_load(entity_seconds(changes, SPEAK_TIMES), "speakings", SPEAK_TIMES)


def run_user_load(online: DataFrame, entity: str, folder: str, once: bool = False) -> StreamingQuery:
    """Online events to `folder`/user_load_second; with `once` to the end of what is there."""
    return write_table(user_load_stream(online, entity), f"{folder}/user_load_second",
                       f"{folder}/_checkpoints/user_load_second", once)


def run_speak_load(group_event: DataFrame, entity: str, folder: str, once: bool = False) -> StreamingQuery:
    """Group events to `folder`/speak_load_second; with `once` to the end of what is there."""
    return write_table(speak_load_stream(group_event, entity), f"{folder}/speak_load_second",
                       f"{folder}/_checkpoints/speak_load_second", once)


def run_job(spark: SparkSession, records: DataFrame, dims: str, folder: str, once: bool = False) -> dict[str, StreamingQuery]:
    """The whole job from Kafka records to tables below `folder`, as linked queries by table name.

    `dims` holds the organisation's tables, read anew by every trigger. Tables: log,
    action, group_event, online (with the logins that sessions are made of),
    speaking, group_step (of which the group sets are made), group_load_second,
    the second and hour loads of servers and companies, server_second, the history of
    the six event tables and of the four hour reports, appload, and the changes of the
    user, group and seen sets below set_change.
    """
    use_state_store(spark)
    queries: dict[str, StreamingQuery] = {}

    def link(name: str, start: Callable[[str, str], StreamingQuery], schema) -> DataFrame:
        queries[name] = start(f"{folder}/{name}", f"{folder}/_checkpoints/{name}")
        if once:
            queries[name].awaitTermination()
        return follow(name, schema)

    def follow(name: str, schema) -> DataFrame:
        return read_table(spark, f"{folder}/{name}", schema, FILES_PER_TRIGGER)

    def users() -> DataFrame:
        members, _, companies = read_dims(spark, dims)
        return user_org(members, companies)

    def groups() -> DataFrame:
        _, rows, companies = read_dims(spark, dims)
        return group_org(rows, companies)

    def table(name: str, rows: DataFrame) -> DataFrame:
        return link(name, lambda path, checkpoint: write_table(rows, path, checkpoint, once), rows.schema)

    log = link("log", lambda path, at: run_log(records, path, at, once=once), "seq long, line string")
    none = spark.createDataFrame([], "seq long, line string")
    shape = user_actions(parse_logs(none), users())
    action = link("action", lambda path, at: run_actions(log, users, path, at, once), shape.schema)
    shape = group_events(shape, groups())
    group_event = link("group_event", lambda path, at: run_group_events(action, groups, path, at, once), shape.schema)
    online = table("online", stream_online(action))
    events, sessions = online_event_columns(online), session_columns(online)
    speaking = table("speaking", stream_speaking(group_event))
    accepted = table("group_accepted", stream_accepted(group_event))
    steps = table("group_step", stream_group_steps(accepted))
    for name, changes in (("user", stream_user_sets(events)), ("group", stream_group_sets(accepted)),
                          ("seen", stream_seen_sets(action))):
        table(f"set_change/{name}", changes)
    group_load = table("group_load_second", stream_group_load(steps))
    for entity, prefix in (("svc", "server"), ("company", "company")):
        for kind, load, hours, rows, column, measures in (
            ("user", user_load_stream, stream_user_hours, events, entity, USER_HOUR_MEASURES),
            ("speak", speak_load_stream, stream_speak_hours, group_event, "svc" if entity == "svc" else "gcompany",
             SPEAK_HOUR_MEASURES),
        ):
            seconds = table(f"load_{entity}/{kind}_load_second", load(rows, column))
            hour = table(f"load_{entity}/{kind}_load_hour", hours(seconds, rows, column))
            if entity == "svc":  # the newest mark of a server stays open
                hour = table(f"load_{entity}/{kind}_load_merge", stream_hour_merge(hour, measures))
            queries[f"history/{prefix}_{kind}_load"] = run_hour_reports(
                hour, measures, f"{folder}/history/{prefix}_{kind}_load",
                f"{folder}/_checkpoints/history/{prefix}_{kind}_load", once)
    server = table("server_second", stream_server_record(
        follow("load_svc/user_load_second", load_schema("onlines", USER_TIMES)), group_load,
        follow("load_svc/speak_load_second", load_schema("speakings", SPEAK_TIMES))))
    link("appload", lambda path, at: write_batches(
        server, path, at, lambda rows, _: appload(server_load_second(rows)), once), "key string")
    kinds = {"": GROUP_NORMAL, "temp_": GROUP_TEMP}
    history = {"user_action": action, "user_session": sessions} | {
        f"{prefix}{name}": rows.where(F.col("gtype") == gtype) for prefix, gtype in kinds.items()
        for name, rows in (("group_event", group_event), ("group_speaking", speaking))}
    for name, rows in history.items():
        queries[f"history/{name}"] = run_history(
            rows, name, f"{folder}/history", f"{folder}/_checkpoints/history/{name}", once)
    if once:
        for query in queries.values():
            query.awaitTermination()
    return queries
