"""Keyed state for the machines, on streams.

Each processor gets one key's rows of a trigger, sorts them by arrival and
carries the same few values that `running` carries in the batch transforms. A
trigger bounds the rows a key can have (`maxOffsetsPerTrigger` on the source).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from talkgauge.operators.enrich import filter_online
from talkgauge.schemas import (
    BROKEN_GAP_SECONDS, CLIENT_COLUMNS, DAY_MS, GROUP_SECOND_MEASURES, GROUP_TEMP, IN_OUT_EVENTS, LATE_MS,
    LOGIN_EVENTS, MIC_CAP_MS, MIC_CLOSE_EVENTS, ONLINE_EVENT_COLUMNS, SECOND_MS, SESSION_COLUMNS,
    SPEAK_SECOND_MEASURES, SPEAKING_COLUMNS, TEMP_GROUP_TTL_MS, USER_BROKEN, USER_OFFLINE, USER_ONLINE,
    USER_SECOND_MEASURES,
)


def _schema(longs: list[str], strings: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.LongType()) for n in longs] + [T.StructField(n, T.StringType()) for n in strings]
    )


def _in_order(rows: Iterator[pd.DataFrame], *by: str) -> list[dict]:
    frame = pd.concat(list(rows)).sort_values(list(by) or "seq").astype(object)
    return frame.where(frame.notna(), None).to_dict("records")


def _frame(records: list[dict], schema: T.StructType) -> pd.DataFrame:
    frame = pd.DataFrame(records, columns=schema.names, dtype=object)
    longs = [f.name for f in schema if isinstance(f.dataType, T.LongType)]
    return frame.astype({n: "Int64" for n in longs})


def _load(state, names: list[str]) -> dict | None:
    value = state.get()
    return None if value is None else dict(zip(names, value))


LOGIN = _schema(["ts_ms"], ["svc", "dt", "company", "agent", *CLIENT_COLUMNS])
LOGOUT = _schema(["ts_ms"], ["event"])
ONLINE = _schema(
    ["seq", "pos", "interval", "ts_ms", "login_ms"],
    [c for c in ONLINE_EVENT_COLUMNS if c != "interval"] + ["login"] + [f"login_{c}" for c in CLIENT_COLUMNS]
    + ["login_svc", "login_company", "login_agent"],
)


class OnlineMachine(StatefulProcessor):
    """Online events of one user; a uoff also carries the login it may pair with.

    A user may start with the newest login and logout of a history (`online_state`).
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._on = handle.getValueState("on", LOGIN)
        self._off = handle.getValueState("off", LOGOUT)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        (row,) = _in_order([initialState], "uid")
        for state, name, schema in ((self._on, "on", LOGIN), (self._off, "off", LOGOUT)):
            if row[f"{name}_ts_ms"] is not None:
                state.update(tuple(row[f"{name}_{n}"] for n in schema.names))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        on, off = _load(self._on, LOGIN.names), _load(self._off, LOGOUT.names)
        out: list[dict] = []
        for row in _in_order(rows):
            ts, event = row["ts_ms"], row["event"]
            fresh = all(s is None or s["ts_ms"] <= ts for s in (on, off))
            if event in LOGIN_EVENTS:
                gap = (ts - off["ts_ms"]) // 1000 if off and fresh else 0
                if fresh and (off is None or (on is not None and on["ts_ms"] < off["ts_ms"])):
                    if event == "LOGIN" and off and off["event"] == "BROKEN" and gap < BROKEN_GAP_SECONDS:
                        out.append({**row, "pos": 0, "event": USER_BROKEN, "interval": gap})
                    out.append({**row, "pos": 1, "event": USER_ONLINE, "interval": gap})
                if event == "RELOGIN":
                    out.append({**row, "pos": 2, "event": USER_BROKEN, "interval": 0})
                if on is None or on["ts_ms"] <= ts:
                    on = {n: row[n] for n in LOGIN.names}
            else:
                if fresh and (on is None or (off is not None and off["ts_ms"] < on["ts_ms"])):
                    login = {} if on is None else {
                        "login": on["dt"], **{f"login_{n}": on[n] for n in on if n != "dt"}, "login_ms": on["ts_ms"],
                    }
                    gap = (ts - on["ts_ms"]) // 1000 if on else 0
                    out.append({**row, **login, "pos": 3, "event": USER_OFFLINE, "interval": gap})
                if off is None or off["ts_ms"] <= ts:
                    off = {n: row[n] for n in LOGOUT.names}
        for state, value, schema in ((self._on, on, LOGIN), (self._off, off, LOGOUT)):
            if value is not None:
                state.update(tuple(value[n] for n in schema.names))
        if out:
            yield _frame(out, ONLINE)

    def close(self) -> None:
        pass


def _stateful(rows: DataFrame, key: list[str], processor: StatefulProcessor, schema: T.StructType,
              start: DataFrame | None = None) -> DataFrame:
    return rows.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None",
        initialState=None if start is None else start.groupBy(*key),
    )


def online_state(action: DataFrame) -> DataFrame:
    """What the machine holds of each user after a history of actions: the newest login and logout.

    A row replaces what is held unless it is older, so it is the greatest by (time, arrival).
    Columns are uid, and on_ and off_ with those of the state.
    """
    parts = [("on", LOGIN, F.col("event").isin(LOGIN_EVENTS)), ("off", LOGOUT, ~F.col("event").isin(LOGIN_EVENTS))]
    held = filter_online(action).groupBy("uid").agg(*[
        F.max(F.when(mine, F.struct("ts_ms", "seq", *schema.names[1:]))).alias(name) for name, schema, mine in parts])
    return held.select("uid", *[F.col(f"{name}.{c}").alias(f"{name}_{c}") for name, schema, _ in parts for c in schema.names])


def stream_online(action: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Online events of a stream of actions, each uoff with its user's last login.

    `history` holds the actions before the stream's first: the first trigger fills the
    state with what they leave, so that the stream goes on where they end.
    """
    rows = filter_online(action).select(
        "seq", "ts_ms", "svc", "dt", "event", "uid", "company", "agent", *CLIENT_COLUMNS
    )
    return _stateful(rows, ["uid"], OnlineMachine(), ONLINE, None if history is None else online_state(history))


def online_event_columns(online: DataFrame) -> DataFrame:
    return online.select("seq", "pos", *ONLINE_EVENT_COLUMNS, "ts_ms")


def session_columns(online: DataFrame) -> DataFrame:
    """Sessions of streamed online events: uoff with a login at the same server."""
    from_login = {"company", "agent", *CLIENT_COLUMNS}
    columns = [
        F.col(f"login_{c}").alias(c) if c in from_login else F.col("dt").alias(c) if c == "logout" else F.col(c)
        for c in SESSION_COLUMNS
    ]
    return online.where((F.col("event") == USER_OFFLINE) & (F.col("login_svc") == F.col("svc"))).select(
        "seq", *columns, "login_ms", F.col("ts_ms").alias("logout_ms")
    )


OPENER = _schema([], ["svc", "gtype", "gcompany", "gagent"])
MIC = _schema(["ts_ms"], ["event", "uid", "company", "agent", "dt"])
SPEAKING = _schema(["seq", "start_ms", "end_ms"], SPEAKING_COLUMNS)


class SpeakingMachine(StatefulProcessor):
    """Speaking records of one group from its last accepted microphone row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._opener = handle.getValueState("opener", OPENER)
        self._last = handle.getValueState("last", MIC)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        opener, last = _load(self._opener, OPENER.names), _load(self._last, MIC.names)
        out: list[dict] = []
        for row in _in_order(rows):
            if last is not None and last["ts_ms"] > row["ts_ms"]:
                continue
            gets = row["event"] == "GET_MIC"
            if opener is None and gets:
                opener = {n: row[n] for n in OPENER.names}
            if last and last["event"] == "GET_MIC" and (gets or last["uid"] == row["uid"]):
                out.append({
                    **opener, "seq": row["seq"], "gid": key[0], "uid": last["uid"], "company": last["company"],
                    "agent": last["agent"], "tvstart": last["dt"], "tvend": row["dt"], "event": row["event"],
                    "start_ms": last["ts_ms"], "end_ms": row["ts_ms"],
                })
            last = {n: row[n] for n in MIC.names}
        for state, value, schema in ((self._opener, opener, OPENER), (self._last, last, MIC)):
            if value is not None:
                state.update(tuple(value[n] for n in schema.names))
        if out:
            yield _frame(out, SPEAKING)

    def close(self) -> None:
        pass


def stream_speaking(group_event: DataFrame) -> DataFrame:
    rows = group_event.where(F.col("event").isin(["GET_MIC", *MIC_CLOSE_EVENTS])).select(
        "seq", "ts_ms", "svc", "dt", "event", "uid", "company", "agent", "gtype", "gcompany", "gagent", "gfull"
    )
    return _stateful(rows, ["gfull"], SpeakingMachine(), SPEAKING)


IN_OUT = ["svc", "event", "uid", "gtype", "gcompany", "gfull"]
ACCEPTED = _schema(["seq", "ts_ms", "accepted"], IN_OUT)
GROUP_STEPS = _schema(["seq", "ts_ms", "kind", "episode", "life", "emptied", "step"], IN_OUT)
#: Kinds of group steps: a group opens or closes at a server, an accepted row, a stale row.
MOVE, LIFE, STALE = 0, 1, 2


class AcceptInOut(StatefulProcessor):
    """Marks the joins and leaves of one user that are not older than the newest before them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", _schema(["ts_ms"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._newest.get()
        newest = None if state is None else state[0]
        out = []
        for row in _in_order(rows):
            out.append({**row, "accepted": int(newest is None or newest <= row["ts_ms"])})
            newest = row["ts_ms"] if newest is None else max(newest, row["ts_ms"])
        self._newest.update((newest,))
        yield _frame(out, ACCEPTED)

    def close(self) -> None:
        pass


class GroupMachine(StatefulProcessor):
    """Episodes and lives of one group, and where it opens and closes.

    The state holds who is in, one entry per member, and the servers the group
    is open at. It is cleared when a temporary group has expired, which the next
    row after that tells.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._group = handle.getValueState("group", _schema(["newest", "episode", "life", "size"], ["places"]))
        self._members = handle.getMapState("members", _schema([], ["uid"]), _schema(["inside"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._group.get()
        newest, episode, life, size = (None, 0, 0, 0) if state is None else state[:4]
        places = [] if state is None else json.loads(state[4])
        out: list[dict] = []
        for row in _in_order(rows):
            if not row["accepted"]:
                out.append({**row, "kind": STALE})
                continue
            joins, uid = row["event"] == "JOIN_GROUP", (row["uid"],)

            def move(svc: str, step: int, row: dict = row) -> dict:
                return {**row, "svc": svc, "kind": MOVE, "step": step}

            if row["gtype"] == GROUP_TEMP and newest is not None and row["ts_ms"] - newest > TEMP_GROUP_TTL_MS:
                out += [move(svc, -1) for svc in places]
                episode, life, size, places = episode + 1, 0, 0, []
                self._members.clear()
            was_in = self._members.containsKey(uid)
            if joins and not was_in:
                self._members.updateValue(uid, (1,))
                size += 1
            elif not joins and was_in:
                self._members.removeKey(uid)
                size -= 1
            emptied = not joins and size == 0
            out.append({**row, "kind": LIFE, "episode": episode, "life": life, "emptied": int(emptied)})
            if joins and row["svc"] not in places:
                places.append(row["svc"])
                out.append(move(row["svc"], 1))
            if emptied:
                out += [move(svc, -1) for svc in places]
                life, places = life + 1, []
            newest = row["ts_ms"] if newest is None else max(newest, row["ts_ms"])
        self._group.update((newest, episode, life, size, json.dumps(places)))
        yield _frame(out, GROUP_STEPS)

    def close(self) -> None:
        pass


GROUP_LOAD = _schema(["bucket", "groups", "temp_groups"], ["svc"])


class ServerGroups(StatefulProcessor):
    """Groups and temporary groups open at one server, for every second of its clock that has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", _schema(["clock", "groups", "temp_groups", "g", "t"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        clock, groups, temps, g, t = self._last.get() or (None, 0, 0, 0, 0)
        out = []
        for row in _in_order(rows, "seq", "kind"):
            if row["kind"] == MOVE:
                step, temp = int(row["step"]), row["gtype"] == GROUP_TEMP
                groups, temps = groups + (0 if temp else step), temps + (step if temp else 0)
                continue
            now = row["ts_ms"] if clock is None else max(clock, row["ts_ms"])
            if clock is not None and now // SECOND_MS > clock // SECOND_MS:
                out.append({"svc": key[0], "bucket": clock // SECOND_MS * SECOND_MS, "groups": g, "temp_groups": t})
            clock, g, t = now, groups, temps
        self._last.update((clock, groups, temps, g, t))
        if out:
            yield _frame(out, GROUP_LOAD)

    def close(self) -> None:
        pass


def stream_accepted(group_event: DataFrame) -> DataFrame:
    """All joins and leaves, with whether the user's newest one before was not newer."""
    rows = group_event.where(F.col("event").isin(IN_OUT_EVENTS)).select("seq", "ts_ms", *IN_OUT)
    return _stateful(rows, ["uid"], AcceptInOut(), ACCEPTED)


def stream_group_steps(accepted: DataFrame) -> DataFrame:
    """Rows of each group with its episode and life, and the moves of servers' group counts."""
    return _stateful(accepted, ["gfull"], GroupMachine(), GROUP_STEPS)


def stream_group_load(steps: DataFrame) -> DataFrame:
    """Group load of servers, (svc, bucket, groups, temp_groups), of seconds that have passed."""
    return _stateful(steps, ["svc"], ServerGroups(), GROUP_LOAD)


def group_lives_of(steps: DataFrame) -> DataFrame:
    """The rows of `operators.groups.group_lives`, of which all group sets are made."""
    return steps.where(F.col("kind") == LIFE).select(
        "seq", "ts_ms", *IN_OUT, "episode", "life", (F.col("emptied") == 1).alias("emptied")
    )


USER_TIMES = ["loginTimes", "logoutTimes", "brokenTimes"]
SPEAK_TIMES = ["getTimes", "lostAutoTimes", "lostReplaceTimes", "dentTimes"]


def _change_schema(times: list[str]) -> T.StructType:
    return _schema(["bucket", "at", *times, "delta"], ["entity", "uid"])


class UserChange(StatefulProcessor):
    """Change of the online set by one user's closed seconds; a logout wins its second."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", _schema(["held"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._held.get()
        held = 0 if state is None else state[0]
        out = []
        for row in _in_order(rows, "bucket"):
            now = 0 if row["logoutTimes"] else 1 if row["loginTimes"] else held
            out.append({**row, "at": row["bucket"], "delta": now - held})
            held = now
        self._held.update((held,))
        yield _frame(out, _change_schema(USER_TIMES))

    def close(self) -> None:
        pass


class SpeakChange(StatefulProcessor):
    """Change of the speaking set by one user's closed seconds.

    A GET_MIC plans the end of its five minutes as a change `at` that time; a
    release, loss or new GET_MIC before then plans the opposite change.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._until = handle.getValueState("until", _schema(["until"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._until.get()
        until = 0 if state is None else state[0]
        out = []
        for row in _in_order(rows, "bucket"):
            bucket, gets = row["bucket"], row["op"] == "GET_MIC"
            held = until > bucket
            ends = held and row["op"] is not None
            plan = {"entity": row["entity"], "uid": row["uid"], "bucket": bucket, **dict.fromkeys(SPEAK_TIMES, 0)}
            out.append({**row, "at": bucket, "delta": int(gets) - int(ends)})
            if ends:
                out.append({**plan, "at": until, "delta": 1})
                until = 0
            if gets:
                until = bucket + MIC_CAP_MS
                out.append({**plan, "at": until, "delta": -1})
        self._until.update((until,))
        yield _frame(out, _change_schema(SPEAK_TIMES))

    def close(self) -> None:
        pass


def load_schema(gauge: str, times: list[str]) -> T.StructType:
    return _schema(["bucket", gauge, *times], ["entity"])


class LoadGauge(StatefulProcessor):
    """Every second of one entity in order, from four before its first, empty ones included.

    A trigger brings one row per closed second and planned change time; planned
    changes past the newest second wait in the state, at most five minutes of them.
    """

    def __init__(self, gauge: str, times: list[str]) -> None:
        self._gauge, self._times = gauge, times

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", _schema(["bucket", "level"], ["planned"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        state = self._last.get()
        planned = {} if state is None else {int(at): d for at, d in json.loads(state[2]).items()}
        deltas = frame.groupby("at")["delta"].sum().add(pd.Series(planned, dtype="int64"), fill_value=0)
        times = frame.groupby("bucket")[self._times].sum()
        start, level = (frame["bucket"].min() - LATE_MS, 0) if state is None else (state[0] + SECOND_MS, state[1])
        end = int(frame["bucket"].max())
        for day in range(int(start), end + 1, DAY_MS):
            seconds = pd.RangeIndex(day, min(day + DAY_MS, end + SECOND_MS), SECOND_MS, name="bucket")
            out = times.reindex(seconds, fill_value=0).astype("int64")
            out[self._gauge] = deltas.reindex(seconds, fill_value=0).astype("int64").cumsum() + level
            level = int(out[self._gauge].iloc[-1])
            out["entity"] = pd.Series(key[0], index=out.index, dtype=object)
            yield out.reset_index()[load_schema(self._gauge, self._times).names]
        ahead = {int(at): int(d) for at, d in deltas.items() if at > end and d}
        self._last.update((end, level, json.dumps(ahead)))

    def close(self) -> None:
        pass


def stream_user_changes(user_seconds: DataFrame) -> DataFrame:
    return _stateful(user_seconds, ["entity", "uid"], UserChange(), _change_schema(USER_TIMES))


def stream_speak_changes(speak_seconds: DataFrame) -> DataFrame:
    return _stateful(speak_seconds, ["entity", "uid"], SpeakChange(), _change_schema(SPEAK_TIMES))


def stream_load(entity_seconds: DataFrame, gauge: str, times: list[str]) -> DataFrame:
    """Second loads from closed (entity, bucket, at) changes, one row per second."""
    return _stateful(entity_seconds, ["entity"], LoadGauge(gauge, times), load_schema(gauge, times))


SERVER_MEASURES = [*USER_SECOND_MEASURES, *GROUP_SECOND_MEASURES, *SPEAK_SECOND_MEASURES]
SERVER_RECORD = _schema(["bucket", *SERVER_MEASURES], ["svc"])


class ServerRecord(StatefulProcessor):
    """Every second of one server with the sums of its loads, closed when it is five seconds old.

    Open seconds wait in the state; rows of closed ones come too late and don't count.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("open", _schema(["closed"], ["rows"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._state.get()
        frame = pd.concat(list(rows))[["bucket", *SERVER_MEASURES]]
        if state is not None:
            waiting = pd.DataFrame(json.loads(state[1]), columns=["bucket", *SERVER_MEASURES])
            frame = pd.concat([waiting, frame[frame["bucket"] > state[0]]]).astype("int64")
        sums = frame.groupby("bucket").sum()
        closed = int(sums.index.min()) - LATE_MS - SECOND_MS if state is None else state[0]
        until = max(closed, int(sums.index.max()) - LATE_MS - SECOND_MS) if len(sums) else closed
        for day in range(closed + SECOND_MS, until + 1, DAY_MS):
            seconds = pd.RangeIndex(day, min(day + DAY_MS, until + SECOND_MS), SECOND_MS, name="bucket")
            out = sums.reindex(seconds, fill_value=0).astype("int64").reset_index()
            out["svc"] = pd.Series(key[0], index=out.index, dtype=object)
            yield out[SERVER_RECORD.names]
        left = sums[sums.index > until].reset_index()
        self._state.update((until, json.dumps(left.values.tolist())))

    def close(self) -> None:
        pass


def stream_server_record(user: DataFrame, group: DataFrame, speak: DataFrame) -> DataFrame:
    """(svc, bucket, all measures) of streams of the three second loads of servers."""
    def part(rows: DataFrame, entity: str, own: list[str]) -> DataFrame:
        return rows.select(F.col(entity).alias("svc"), "bucket", *[
            (F.col(m) if m in own else F.lit(0)).cast("bigint").alias(m) for m in SERVER_MEASURES
        ])

    rows = part(user, "entity", USER_SECOND_MEASURES).unionByName(
        part(group, "svc", GROUP_SECOND_MEASURES)
    ).unionByName(part(speak, "entity", SPEAK_SECOND_MEASURES))
    return _stateful(rows, ["svc"], ServerRecord(), SERVER_RECORD)
