"""Presence and group sets of a stream, as tables of changes.

A row puts a member into a set (`step` 1) or takes it out (-1); sets are named as
`operators.sinks.state_sets` names them. A set as of a trigger is the sum of the steps
up to it, so nothing is rewritten and a reader of one set reads its rows alone.

A user's state is the sets that hold them, a group's is its members and the places it
is open at. A temporary group is taken out of all sets by an event-time timer an hour
after its newest join or leave, each of which arms the timer anew; its state goes with it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from talkgauge.operators.enrich import filter_online
from talkgauge.schemas import DAY_MS, GROUP_TEMP, TEMP_GROUP_TTL_MS, USER_BROKEN, USER_ONLINE
from talkgauge.streaming.processors import _frame, _in_order, _schema, _stateful

CHANGES = _schema(["seq", "step", "until"], ["key", "member", "gfull"])


class UserSets(StatefulProcessor):
    """The sets that hold one user: online users, and those of servers, companies and devices."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._sets = handle.getMapState("sets", _schema([], ["key"]), _schema(["inside"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        for row in _in_order(rows, "seq", "pos"):
            on = row["event"] == USER_ONLINE
            moves = {"online-user": on}
            moves |= {f"{name}:{row[column]}:user": on for name, column in (("server", "svc"), ("company", "company"))
                      if row[column] is not None}
            if on and row["dev"] is not None:
                moves[f"dev:{row['dev']}:user"] = True
            for name, inside in moves.items():
                if inside == self._sets.containsKey((name,)):
                    continue
                if inside:
                    self._sets.updateValue((name,), (1,))
                else:
                    self._sets.removeKey((name,))
                out.append({"seq": row["seq"], "step": 1 if inside else -1, "key": name, "member": key[0]})
        if out:
            yield _frame(out, CHANGES)

    def close(self) -> None:
        pass


class GroupSets(StatefulProcessor):
    """The members of one group, the places it is open at, and whether it is live.

    A row with `until` and step 0 tells when a temporary group expires if it is not touched
    again, so that a reader who knows the time needs not wait for the watermark.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._group = handle.getValueState("group", _schema(["newest", "size"], ["servers", "companies"]))
        self._members = handle.getMapState("members", _schema([], ["uid"]), _schema(["inside"], []))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._group.get()
        before, size = (None, 0) if state is None else state[:2]
        newest, places = before, ([], []) if state is None else tuple(json.loads(s) for s in state[2:])
        out: list[dict] = []
        for row in _in_order(rows):
            temp, seq = row["gtype"] == GROUP_TEMP, row["seq"]
            if temp and newest is not None and row["ts_ms"] - newest > TEMP_GROUP_TTL_MS:
                out += self._closed(key[0], temp, size, places, seq)
                size, places = 0, ([], [])
            joins, uid = row["event"] == "JOIN_GROUP", row["uid"]
            was_in = self._members.containsKey((uid,))
            if joins and not was_in:
                self._members.updateValue((uid,), (1,))
                size += 1
                out.append(_change(_members_of(key[0], temp), uid, 1, key[0], seq))
                if size == 1:
                    out.append(_change(_live(temp), key[0], 1, key[0], seq))
            elif not joins and was_in:
                self._members.removeKey((uid,))
                size -= 1
                out.append(_change(_members_of(key[0], temp), uid, -1, key[0], seq))
                if size == 0:
                    out.append(_change(_live(temp), key[0], -1, key[0], seq))
            if joins:
                for known, place, name in zip(places, (row["svc"], row["gcompany"]), ("server", "company")):
                    if place is not None and place not in known:
                        known.append(place)
                        out += _place(key[0], temp, name, place, 1, seq)
            elif size == 0:
                out += [c for known, name in zip(places, ("server", "company"))
                        for place in known for c in _place(key[0], temp, name, place, -1, seq)]
                places = ([], [])
            newest = row["ts_ms"] if newest is None else max(newest, row["ts_ms"])
        if temp and newest != before:
            if before is not None:
                self._handle.deleteTimer(before + TEMP_GROUP_TTL_MS + 1)
            self._handle.registerTimer(newest + TEMP_GROUP_TTL_MS + 1)
            out.append({**_change(_live(temp), key[0], 0, key[0], seq), "until": newest + TEMP_GROUP_TTL_MS})
        self._group.update((newest, size, *[json.dumps(p) for p in places]))
        if out:
            yield _frame(out, CHANGES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._group.get()
        if state is not None and state[0] + TEMP_GROUP_TTL_MS < expiredTimerInfo.getExpiryTimeInMs():
            out = self._closed(key[0], True, state[1], tuple(json.loads(s) for s in state[2:]), None)
            self._group.clear()
            if out:
                yield _frame(out, CHANGES)

    def _closed(self, gfull: str, temp: bool, size: int, places: tuple, seq: int | None) -> list[dict]:
        """Everything the group is in taken back, and its members forgotten."""
        out = [_change(_members_of(gfull, temp), uid, -1, gfull, seq) for (uid,) in self._members.keys()]
        self._members.clear()
        if size:
            out.append(_change(_live(temp), gfull, -1, gfull, seq))
        return out + [c for known, name in zip(places, ("server", "company"))
                      for place in known for c in _place(gfull, temp, name, place, -1, seq)]

    def close(self) -> None:
        pass


def _change(key: str, member: str, step: int, gfull: str, seq: int | None) -> dict:
    return {"seq": seq, "step": step, "key": key, "member": member, "gfull": gfull}


def _kind(temp: bool) -> str:
    return "tgroup" if temp else "group"


def _live(temp: bool) -> str:
    return "tempgroup-set" if temp else "group-set"


def _members_of(gfull: str, temp: bool) -> str:
    return f"{_kind(temp)}:{gfull}:user"


def _place(gfull: str, temp: bool, name: str, place: str, step: int, seq: int | None) -> list[dict]:
    """A group opens or closes at a place; servers are also kept by group."""
    out = [_change(f"{name}:{place}:{_kind(temp)}", gfull, step, gfull, seq)]
    if name == "server":
        out.append(_change(f"{_kind(temp)}:{gfull}:server", place, step, gfull, seq))
    return out


def stream_user_sets(online: DataFrame) -> DataFrame:
    """Changes of the sets of users from a stream of online events."""
    rows = online.where(F.col("event") != USER_BROKEN).select("uid", "seq", "pos", "event", "svc", "company", "dev")
    return _stateful(rows, ["uid"], UserSets(), CHANGES)


def stream_group_sets(accepted: DataFrame, keep_ms: int = DAY_MS) -> DataFrame:
    """Changes of the sets of groups from a stream of `processors.stream_accepted`.

    Timers run by the newest time of all rows less `keep_ms`, and rows further behind it
    are not counted.
    """
    rows = accepted.where(F.col("accepted") == 1).drop("accepted")
    timed = rows.withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", f"{keep_ms} milliseconds")
    return timed.groupBy("gfull").transformWithStateInPandas(
        statefulProcessor=GroupSets(), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime")


def stream_seen_sets(action: DataFrame) -> DataFrame:
    """(key, member) of the servers and devices seen in online actions, each once.

    Tasks keep one row of each batch, so a busy server's rows don't meet in one task.
    """
    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop_duplicates()

    entries = F.array(*[F.struct(F.lit(name).alias("key"), F.col(column).alias("member"))
                        for name, column in (("server-set", "svc"), ("dev-set", "dev"))])
    rows = filter_online(action).select(F.inline(entries)).where("member IS NOT NULL")
    return rows.mapInPandas(seen, "key string, member string").dropDuplicates(["key", "member"])


def sets_of(changes: DataFrame, as_of: Column | int | None = None) -> DataFrame:
    """(key, member) of all sets after the given changes.

    With a time, temporary groups that have expired by then are left out also where no
    timer has told so yet.
    """
    inside = changes.groupBy("key", "member").agg(
        F.sum("step").alias("n"), F.max("gfull").alias("gfull")).where("n > 0")
    if as_of is not None:
        until = changes.where("until IS NOT NULL").groupBy("gfull").agg(F.max("until").alias("until"))
        inside = inside.join(until.where(F.col("until") < as_of), "gfull", "left_anti")
    return inside.select("key", "member")
