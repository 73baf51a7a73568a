"""Logins and logouts: online events, sessions and presence.

The state of a user is the latest login and the latest logout in event time,
a later arrival winning a tie. As of any row that is a running max over the
rows that arrived before it, so the machine is one `running` step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.functions.jsons import action_json
from talkgauge.functions.times import interval_seconds
from talkgauge.operators.enrich import filter_online
from talkgauge.operators.scan import CELL_ROWS, running, with_cells
from talkgauge.schemas import (
    ACTION_JSON_FIELDS, BROKEN_GAP_SECONDS, CLIENT_COLUMNS, LOGIN_EVENTS, LOGOUT_EVENTS,
    ONLINE_EVENT_COLUMNS, USER_BROKEN, USER_OFFLINE, USER_ONLINE,
)

LOGIN_STATE = ["ts_ms", "seq", "svc", "dt", "company", "agent", *CLIENT_COLUMNS]
LOGOUT_STATE = ["ts_ms", "seq", "event"]


def login_logout_state(rows: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add `on` and `off`: the user's latest login and logout before each row."""
    return running(
        with_cells(rows, ["uid"], "seq", cell_rows), ["uid"], "seq",
        maxes={
            "on": F.when(F.col("event").isin(LOGIN_EVENTS), F.struct(*LOGIN_STATE)),
            "off": F.when(F.col("event").isin(LOGOUT_EVENTS), F.struct(*LOGOUT_STATE)),
        },
    )


def _before(a: str, b: str, first_event: str) -> Column:
    """Whether state `a` is earlier than state `b`.

    A missing b counts as later, then a missing a as not earlier; 'corrected'
    tests the missing a first, so that a user's first event is never swallowed.
    """
    earlier = F.col(f"{a}.ts_ms") < F.col(f"{b}.ts_ms")
    if first_event == "corrected":
        return F.when(F.col(a).isNull(), True).when(F.col(b).isNull(), False).otherwise(earlier)
    return F.when(F.col(b).isNull(), True).when(F.col(a).isNull(), False).otherwise(earlier)


def machine_events(state: DataFrame, first_event: str = "reference") -> DataFrame:
    """Add `emits`: ubro, uon, ubro, uoff in order of emission, null where not given."""
    ts, on, off = F.col("ts_ms"), F.col("on"), F.col("off")
    fresh = (on.isNull() | (on.ts_ms <= ts)) & (off.isNull() | (off.ts_ms <= ts))
    goes_on = F.col("event").isin(LOGIN_EVENTS) & fresh & _before("on", "off", first_event)
    goes_off = F.col("event").isin(LOGOUT_EVENTS) & fresh & _before("off", "on", first_event)
    zero = F.lit(0).cast("bigint")
    off_time = F.coalesce(interval_seconds(off.ts_ms, ts), zero)
    on_time = F.coalesce(interval_seconds(on.ts_ms, ts), zero)
    was_broken = (off.event == "BROKEN") & (off_time < BROKEN_GAP_SECONDS)
    relogin = F.col("event") == "RELOGIN"

    def emit(condition: Column, event: str, interval: Column) -> Column:
        return F.when(condition, F.struct(F.lit(event).alias("event"), interval.alias("interval")))

    return state.withColumn("emits", F.array(
        emit(goes_on & ~relogin & was_broken, USER_BROKEN, off_time),
        emit(goes_on, USER_ONLINE, off_time),
        emit(relogin, USER_BROKEN, zero),
        emit(goes_off, USER_OFFLINE, on_time),
    ))


def online_machine(action: DataFrame, first_event: str = "reference", cell_rows: int = CELL_ROWS) -> DataFrame:
    """Online rows with the user's state and the events they give; one shuffle of the rows.

    Online events and sessions both come from it, so stage it when both are wanted.
    """
    rows = filter_online(action).select(
        "seq", "ts_ms", "svc", "dt", "event", "uid", "company", "agent", *CLIENT_COLUMNS
    )
    return machine_events(login_logout_state(rows, cell_rows), first_event)


def online_events(action: DataFrame, first_event: str = "reference",
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """uon, uoff and ubro events; `pos` orders the events of one row."""
    return machine_online_events(online_machine(action, first_event, cell_rows))


def machine_online_events(machine: DataFrame) -> DataFrame:
    return (
        machine.drop("on", "off").withColumnRenamed("event", "action")
        .select("*", F.posexplode_outer("emits").alias("pos", "e")).where(F.col("e").isNotNull())
        .withColumns({"event": F.col("e.event"), "interval": F.col("e.interval")})
        .select("seq", "pos", *ONLINE_EVENT_COLUMNS, "ts_ms")
    )


def user_sessions(action: DataFrame, first_event: str = "reference",
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """Each uoff with the user's last login, if that was at the same server.

    seq, login_ms and logout_ms are kept beside the session's columns.
    """
    return machine_sessions(online_machine(action, first_event, cell_rows))


def machine_sessions(machine: DataFrame) -> DataFrame:
    on = F.col("on")
    return (
        machine
        .where(F.col("emits")[3].isNotNull() & (on.svc == F.col("svc")))
        .select(
            "seq", "svc", "uid", on.company.alias("company"), on.agent.alias("agent"),
            on.dt.alias("login"), F.col("dt").alias("logout"),
            *[on[c].alias(c) for c in CLIENT_COLUMNS],
            on.ts_ms.alias("login_ms"), F.col("ts_ms").alias("logout_ms"),
        )
    )


def _newest(action: DataFrame, events: list[str], name: str) -> DataFrame:
    columns = ACTION_JSON_FIELDS.values()
    return (
        action.where(F.col("event").isin(events)).groupBy(F.col("uid").alias("of"))
        .agg(F.max(F.struct("ts_ms", "seq", *columns)).alias("last"))
        .select("last.*").select("uid", action_json().alias(name))
    )


def last_login(action: DataFrame) -> DataFrame:
    """Newest login or relogin per user, as JSON."""
    return _newest(action, LOGIN_EVENTS, "last_login")


def last_logout(action: DataFrame) -> DataFrame:
    """Newest logout or break per user, as JSON."""
    return _newest(action, LOGOUT_EVENTS, "last_logout")


def user_state(online: DataFrame) -> DataFrame:
    """(uid, state, server, dev) after the last online event of each user."""
    at = ("seq", "pos")
    on = F.col("event") == USER_ONLINE
    return (
        online.where(F.col("event") != USER_BROKEN).groupBy("uid")
        .agg(
            F.max(F.struct(*at, "event")).alias("last"),
            F.max(F.when(on, F.struct(*at, "svc"))).alias("server"),
            F.max(F.when(on & F.col("dev").isNotNull(), F.struct(*at, "dev"))).alias("dev"),
        )
        .select(
            "uid",
            F.when(F.col("last.event") == USER_ONLINE, "online").otherwise("offline").alias("state"),
            F.col("server.svc").alias("server"), F.col("dev.dev").alias("dev"),
        )
    )


def online_user_set(online: DataFrame) -> DataFrame:
    return user_state(online).where(F.col("state") == "online").select("uid")


def online_users_by(online: DataFrame, entity: str) -> DataFrame:
    """(entity, uid) whose last event at that entity was uon.

    A logout only removes the user from the entity of the logout row.
    """
    return (
        online.where(F.col("event") != USER_BROKEN).groupBy(entity, "uid")
        .agg(F.max(F.struct("seq", "pos", "event")).alias("last"))
        .where(F.col("last.event") == USER_ONLINE).select(entity, "uid")
    )


def device_user_set(online: DataFrame) -> DataFrame:
    """(dev, uid) ever online with that device."""
    return (
        online.where((F.col("event") == USER_ONLINE) & F.col("dev").isNotNull())
        .select("dev", "uid").distinct()
    )


def server_set(action: DataFrame) -> DataFrame:
    return filter_online(action).select("svc").distinct()


def device_set(action: DataFrame) -> DataFrame:
    return filter_online(action).where(F.col("dev").isNotNull()).select("dev").distinct()
