"""Load of servers and companies, by second and by trailing hour.

Rows are reduced to one per (entity, user, second) before anything is counted,
which partial aggregation does ahead of the shuffle, so neither a busy user nor
a busy entity meets in one task. Hour reports come from sparse per-second
changes summed by minute, not from the dense table of seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.functions.times import minute_mark, second_bucket
from talkgauge.operators.enrich import filter_speak
from talkgauge.operators.scan import CELL_ROWS, hold_deltas
from talkgauge.operators.windows import (
    dense_seconds, distinct_members, fill, mark_late, minute_grid, per_minute_mark, trailing_hour,
)
from talkgauge.schemas import (
    GROUP_SECOND_MEASURES, HOUR_MS, LATE_MS, MIC_CAP_MS, SECOND_MS, SPEAK_HOUR_MEASURES,
    SPEAK_SECOND_MEASURES, USER_BROKEN, USER_HOUR_MEASURES, USER_OFFLINE, USER_ONLINE, USER_SECOND_MEASURES,
)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def _bucketed(rows: DataFrame, entity: str, late: str, cell_rows: int) -> DataFrame:
    """Rows with entity, bucket and whether they count (`late='drop'` rules late ones out)."""
    rows = rows.withColumnRenamed(entity, "entity")
    if late == "drop":
        return mark_late(rows, "entity", cell_rows).withColumn("counts", ~F.col("late"))
    return rows.withColumn("bucket", second_bucket("ts_ms")).withColumn("counts", F.lit(True))


def _user_rows(online: DataFrame, entity: str, late: str, cell_rows: int) -> DataFrame:
    rows = online.select("seq", entity, "uid", "event", "ts_ms")
    return _bucketed(rows, entity, late, cell_rows)


USER_TIMES = {"loginTimes": USER_ONLINE, "logoutTimes": USER_OFFLINE, "brokenTimes": USER_BROKEN}


def user_changes(online: DataFrame, entity: str, late: str = "drop",
                 cell_rows: int = CELL_ROWS) -> DataFrame:
    """(entity, bucket) with distinct users per event and `delta`, the change of the online set.

    Seconds without rows are left out; a user whose second has a logout is off
    at its end. `seen` is zero where only a delta falls. Late rows don't count
    unless `late="keep"`.
    """
    per_user = _user_rows(online, entity, late, cell_rows).where("counts").groupBy(
        "entity", "uid", "bucket"
    ).agg(*[F.max(_flag(F.col("event") == e)).alias(n) for n, e in USER_TIMES.items()])
    ops = per_user.where((F.col("loginTimes") + F.col("logoutTimes")) > 0).withColumn(
        "holds", F.col("logoutTimes") == 0
    )
    return _add_up(per_user, hold_deltas(ops, ["entity", "uid"], "bucket", "holds"), list(USER_TIMES))


def _add_up(counted: DataFrame, deltas: DataFrame, times: list[str]) -> DataFrame:
    none = F.lit(0).cast("bigint")
    return (
        counted.select("entity", "bucket", *times, none.alias("delta"), F.lit(1).cast("bigint").alias("seen"))
        .unionByName(deltas.select(
            "entity", "bucket", *[none.alias(t) for t in times], "delta", none.alias("seen")
        ))
        .groupBy("entity", "bucket").agg(*[F.sum(c).alias(c) for c in [*times, "delta", "seen"]])
    )


def user_load_second(changes: DataFrame) -> DataFrame:
    """Per (entity, second): users online at its end, distinct users going on, off, broken."""
    return dense_seconds(changes, "entity", {"onlines": "delta"}, list(USER_TIMES)).select(
        "entity", "bucket", *USER_SECOND_MEASURES
    )


def _hour_sums(changes: DataFrame, grid: DataFrame, integral: str, times: list[str]) -> DataFrame:
    """(entity, mark): sums over the trailing 3,600 seconds, the gauge's as `integral`.

    A change of d at second s adds d to each second from s to the mark, so a
    minute's share is the carry times 60 plus each d times its seconds left.
    """
    left = ((minute_mark("bucket") - F.col("bucket")) / 1000).cast("bigint") + 1
    minutes = per_minute_mark(
        changes.withColumn("inside", F.col("delta") * left), "entity", [*times, "delta", "inside"]
    )
    dense = fill(grid, minutes, "entity", [*times, "delta", "inside"])
    before = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce(F.sum("delta").over(before), F.lit(0))
    return trailing_hour(
        dense.withColumn(integral, carry * 60 + F.col("inside")), "entity", [*times, integral]
    ).select("entity", "bucket", *times, integral)


def user_member_rows(online: DataFrame, entity: str) -> DataFrame:
    """Online events whose users count as distinct, late ones among them."""
    return _user_rows(online, entity, "keep", CELL_ROWS)


def user_members(rows: DataFrame) -> DataFrame:
    """(seq, entity, member, bucket, kind, forever): the kinds of distinct users that an event's user is of."""
    on, off = F.col("event") == USER_ONLINE, F.col("event") == USER_OFFLINE
    kinds = F.array(
        F.when(on, "loginUsers").when(off, "logoutUsers").otherwise("brokenUsers"),
        F.when(on | off, "onlines"),
    )
    return (
        rows.select("seq", "entity", F.col("uid").alias("member"), "bucket", on.alias("on"),
                    F.explode(kinds).alias("kind"))
        .where(F.col("kind").isNotNull())
        .withColumn("forever", (F.col("kind") == "onlines") & F.col("on"))
    )


def user_load_hour(online: DataFrame, changes: DataFrame, entity: str,
                   distinct_hours: int = 2) -> DataFrame:
    """Per (entity, minute mark): sums over an hour, distinct users over `distinct_hours`.

    `changes` are the `user_changes` of the same events. `onlines` counts users
    whose last event is uon, or a uoff not timed out; late rows count as users.
    """
    grid = minute_grid(changes.where("seen > 0"), "entity")
    sums = _hour_sums(changes, grid, "totalOnlineSeconds", list(USER_TIMES))
    users = distinct_members(
        user_members(user_member_rows(online, entity)), "entity", grid, ["onlines", "loginUsers", "logoutUsers", "brokenUsers"],
        distinct_hours * HOUR_MS,
    )
    return sums.join(users, ["entity", "bucket"]).select("entity", "bucket", *USER_HOUR_MEASURES)


def _speak_rows(group_event: DataFrame, entity: str, late: str, cell_rows: int) -> DataFrame:
    rows = filter_speak(group_event).select("seq", entity, "uid", "gfull", "event", "ts_ms")
    return _bucketed(rows, entity, late, cell_rows)


SPEAK_TIMES = {
    "getTimes": "GET_MIC", "lostAutoTimes": "LOSTMIC_AUTO",
    "lostReplaceTimes": "LOSTMIC_REPLACE", "dentTimes": "DENT_MIC",
}


def speak_changes(group_event: DataFrame, entity: str, late: str = "drop", mic_cap: bool = True,
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """(entity, bucket) with event counts and `delta`, the change of the speaking set.

    A user speaks from a GET_MIC to the next release or loss, in any group, or
    until the five-minute cap. `seen` is zero where only a delta falls.
    """
    rows = _speak_rows(group_event, entity, late, cell_rows).where("counts")
    ops = (
        rows.where(F.col("event") != "DENT_MIC").groupBy("entity", "uid", "bucket")
        .agg(F.max(F.struct("seq", "event")).alias("last"))
        .select(
            "entity", "uid", "bucket", (F.col("last.event") == "GET_MIC").alias("holds"),
            (F.col("bucket") + MIC_CAP_MS if mic_cap else F.lit(None).cast("bigint")).alias("until"),
        )
    )
    deltas = hold_deltas(ops, ["entity", "uid"], "bucket", "holds", "until")
    counted = rows.select(
        "entity", "bucket", *[_flag(F.col("event") == e).alias(n) for n, e in SPEAK_TIMES.items()]
    )
    return _add_up(counted, deltas, list(SPEAK_TIMES))


def speak_load_second(changes: DataFrame) -> DataFrame:
    """Per (entity, second): users speaking at its end, and counts of microphone events."""
    return dense_seconds(changes, "entity", {"speakings": "delta"}, list(SPEAK_TIMES)).select(
        "entity", "bucket", *SPEAK_SECOND_MEASURES
    )


def speak_member_rows(group_event: DataFrame, entity: str) -> DataFrame:
    """Microphone events whose users and groups count as distinct, late ones among them."""
    return _speak_rows(group_event, entity, "keep", CELL_ROWS)


def speak_members(rows: DataFrame) -> DataFrame:
    """(seq, entity, bucket, kind, member, forever): users and groups, by kind of event."""
    stem = F.when(F.col("event") == "GET_MIC", "speaking").when(
        F.col("event") == "LOSTMIC_AUTO", "lostAuto"
    ).when(F.col("event") == "LOSTMIC_REPLACE", "lostReplace").when(F.col("event") == "DENT_MIC", "dent")
    pairs = F.array(
        F.struct(F.concat("stem", F.lit("Users")).alias("kind"), F.col("uid").alias("member")),
        F.struct(F.concat("stem", F.lit("Groups")).alias("kind"), F.col("gfull").alias("member")),
    )
    return (
        rows.withColumn("stem", stem).where(F.col("stem").isNotNull())
        .select("seq", "entity", "bucket", F.inline(pairs).alias("kind", "member"))
        .withColumn("forever", F.lit(False))
    )


def speak_load_hour(group_event: DataFrame, changes: DataFrame, entity: str,
                    distinct_hours: int = 2) -> DataFrame:
    """Per (entity, minute mark): sums over an hour, distinct users and groups."""
    grid = minute_grid(changes.where("seen > 0"), "entity")
    sums = _hour_sums(changes, grid, "speakingSeconds", list(SPEAK_TIMES))
    members = speak_members(speak_member_rows(group_event, entity))
    kinds = [m for m in SPEAK_HOUR_MEASURES if m.endswith(("Users", "Groups"))]
    distinct = distinct_members(members, "entity", grid, kinds, distinct_hours * HOUR_MS)
    return (
        sums.withColumnRenamed("getTimes", "speakingTimes").join(distinct, ["entity", "bucket"])
        .select("entity", "bucket", *SPEAK_HOUR_MEASURES)
    )


def closed_hours(hours: DataFrame) -> DataFrame:
    """Hour reports an entity has moved past: its newest mark is still open."""
    newest = F.max("bucket").over(Window.partitionBy("entity"))
    return hours.withColumn("newest", newest).where(F.col("bucket") < F.col("newest")).drop("newest")


SERVER_GAUGES = {"onlines": "online_delta", "speakings": "speak_delta", "inside": "inside_delta"}
SERVER_COUNTS = [*USER_TIMES, *SPEAK_TIMES, *GROUP_SECOND_MEASURES, "group_rows"]


def _within_span(changes: DataFrame, delta: str, times: list[str]) -> DataFrame:
    """A load's changes as part of the server record, which it enters four seconds before and leaves after its own."""
    spans = changes.where("seen > 0").groupBy("entity").agg(
        (F.min("bucket") - LATE_MS).alias("first"), F.max("bucket").alias("last")
    )
    inner = changes.join(spans, "entity").where(F.col("bucket") <= F.col("last"))
    after = (F.col("last") + SECOND_MS).alias("bucket")
    ends = inner.groupBy("entity", "last").agg((-F.sum("delta")).alias(delta)).select("entity", after, delta)
    edge = F.inline(F.array(
        F.struct(F.col("first").alias("bucket"), F.lit(1).alias("inside_delta"), F.lit(1).alias("seen")),
        F.struct(after, F.lit(-1).alias("inside_delta"), F.lit(0).alias("seen")),
    ))
    return (
        _server_part(inner.withColumnRenamed("delta", delta).select("entity", "bucket", *times, delta, "seen"))
        .unionByName(_server_part(ends)).unionByName(_server_part(spans.select("entity", edge)))
    )


def _server_part(rows: DataFrame) -> DataFrame:
    """`rows` with all columns of a server's changes, zero where it has none."""
    def column(name: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(0)).cast("bigint").alias(name)

    return rows.select(
        F.col("entity").alias("svc"), "bucket",
        *[column(n) for n in [*SERVER_COUNTS, *SERVER_GAUGES.values(), "seen"]],
    )


def server_seconds(user: DataFrame, group: DataFrame, speak: DataFrame) -> DataFrame:
    """Every second of each server with the measures of its user, group and speaking load.

    Takes the sparse changes of users and of speaking, and the group load, and
    stretches them once; nothing dense is shuffled. A load's gauge is zero
    outside its own span. `inside` counts the loads whose span holds the second.
    """
    one = F.lit(1).alias("group_rows")
    changes = (
        _within_span(user, "online_delta", list(USER_TIMES))
        .unionByName(_within_span(speak, "speak_delta", list(SPEAK_TIMES)))
        .unionByName(_server_part(group.select(
            F.col("svc").alias("entity"), "bucket", *GROUP_SECOND_MEASURES, one, F.lit(1).alias("seen")
        )))
    ).groupBy("svc", "bucket").agg(
        *[F.sum(c).alias(c) for c in [*SERVER_COUNTS, *SERVER_GAUGES.values(), "seen"]]
    )
    return dense_seconds(changes, "svc", SERVER_GAUGES, SERVER_COUNTS)


def merge_reports(seconds: DataFrame) -> DataFrame:
    """Seconds of servers that any of the three loads reports, as one row per (svc, bucket)."""
    return seconds.where((F.col("inside") > 0) | (F.col("group_rows") > 0)).select(
        "svc", "bucket", *USER_SECOND_MEASURES, *GROUP_SECOND_MEASURES, *SPEAK_SECOND_MEASURES
    )


def server_load_second(seconds: DataFrame) -> DataFrame:
    """One nested record per server and second, gap-filled from four seconds before the first."""
    return seconds.select(
        F.col("svc").alias("server"), "bucket",
        F.struct(*USER_SECOND_MEASURES).alias("userLoad"),
        F.struct(*GROUP_SECOND_MEASURES).alias("groupLoad"),
        F.struct(*SPEAK_SECOND_MEASURES).alias("speakLoad"),
    )
