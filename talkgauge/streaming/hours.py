"""Reports of the trailing hour on streams.

Sums come from the second loads, of which a minute's sums are kept for an hour.
Distinct users and groups come in two layers. A member's state is the interval in
which it counts: an event gives +1 at its minute mark and -1 where the interval will
end, and an event before that end moves it. The entity's state adds these changes up
along the marks, so no task holds an entity's members. Both meet in one keyed state per
entity, which reports a mark once the entity's seconds have passed it and the members'
rows are as far.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from talkgauge.functions.times import minute_mark
from talkgauge.operators.loads import (
    SPEAK_TIMES, USER_TIMES, speak_member_rows, speak_members, user_member_rows, user_members,
)
from talkgauge.schemas import DAY_MS, HOUR_MS, MINUTE_MS, SPEAK_HOUR_MEASURES, USER_HOUR_MEASURES

#: The end of an interval that only another event ends.
FOREVER = 1 << 60
USER_KINDS = ["onlines", "loginUsers", "logoutUsers", "brokenUsers"]
SPEAK_KINDS = [m for m in SPEAK_HOUR_MEASURES if m.endswith(("Users", "Groups"))]
DELTAS = T.StructType([T.StructField("entity", T.StringType()), T.StructField("kind", T.StringType()),
                       T.StructField("mark", T.LongType()), T.StructField("delta", T.LongType())])


class MemberIntervals(StatefulProcessor):
    """Changes (mark, delta) of the distinct members of a kind by one member's events.

    The state is the interval that counts now, the mark of its last event and the end of
    the interval before. An event older than the last one adds what neither interval
    covers. A timer clears an interval that is over.
    """

    def __init__(self, ttl_ms: int) -> None:
        self._ttl = -(-ttl_ms // MINUTE_MS) * MINUTE_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._interval = handle.getValueState("interval", "start long, until long, last long, before long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._interval.get()
        start, until, last, before = state or (None, None, None, -FOREVER)
        timer = until
        deltas: dict[int, int] = {}

        def change(at: int, by: int) -> None:
            if at < FOREVER:
                deltas[at] = deltas.get(at, 0) + by

        frame = pd.concat(list(rows)).sort_values(["bucket", "seq"])
        for mark, forever in zip(frame["mark"].tolist(), frame["forever"].tolist()):
            end = FOREVER if forever else mark + self._ttl
            if last is not None and mark < last:
                low, high = max(mark, before), min(start, end)
                if mark < start and low < high:
                    change(low, 1)
                    change(high, -1)
            elif start is None or mark >= until:
                before = -FOREVER if start is None else until
                change(mark, 1)
                change(end, -1)
                start, until, last = mark, end, mark
            else:
                change(until, 1)
                change(end, -1)
                until, last = end, mark
        if timer is not None and timer < FOREVER and timer != until:
            self._handle.deleteTimer(timer)
        if until < FOREVER and timer != until:
            self._handle.registerTimer(until)
        self._interval.update((start, until, last, before))
        deltas = {at: d for at, d in deltas.items() if d}
        if deltas:
            yield pd.DataFrame({"entity": key[0], "kind": key[1], "mark": list(deltas), "delta": list(deltas.values())})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._interval.get()
        if state is not None and state[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self._interval.clear()
        return iter([])

    def close(self) -> None:
        pass


def member_changes(members: DataFrame, ttl_ms: int, keep_ms: int = DAY_MS) -> DataFrame:
    """(entity, kind, mark, delta) of a stream of members (entity, kind, member, bucket, seq, forever).

    An interval's state stays until `keep_ms` of event time after its end, and rows
    further behind the newest one of all are not counted.
    """
    timed = members.withColumns({"mark": minute_mark("bucket"), "ts": F.timestamp_millis("bucket")}).withWatermark(
        "ts", f"{keep_ms} milliseconds")
    return timed.groupBy("entity", "kind", "member").transformWithStateInPandas(
        statefulProcessor=MemberIntervals(ttl_ms), outputStructType=DELTAS, outputMode="Append", timeMode="EventTime")


def hour_schema(measures: list[str]) -> T.StructType:
    return T.StructType([T.StructField("entity", T.StringType())]
                        + [T.StructField(n, T.LongType()) for n in ["bucket", *measures]])


#: What a row of `HourReport` tells: sums of a mark, changes at a mark, how far the members' rows are.
SUMS, CHANGES, CLOCK = 0, 1, 2


class HourReport(StatefulProcessor):
    """Reports of one entity's trailing hour at every minute mark that it has passed.

    The state holds 60 minutes' sums, changes at marks ahead, of which there is at most
    one per mark of a member's life, and the level of each kind. Changes at marks that are
    reported already count from the next one on.
    """

    def __init__(self, sums: list[str], kinds: list[str], measures: list[str]) -> None:
        self._sums, self._kinds, self._measures = sums, kinds, measures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState(
            "hour", "first long, newest long, clock long, next long, minutes string, ahead string, level string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._state.get()
        first, newest, clock, coming = (None, None, None, None) if state is None else state[:4]
        minutes, ahead, level = ([], [], [0] * len(self._kinds)) if state is None else map(json.loads, state[4:])
        frame = pd.concat(list(rows))
        sums, changes, clocks = (frame[frame["part"] == p] for p in (SUMS, CHANGES, CLOCK))
        minutes = pd.concat([pd.DataFrame(minutes, columns=["mark", *self._sums]), sums[["mark", *self._sums]]]).astype(
            "int64").groupby("mark").sum()
        ahead = pd.concat([pd.DataFrame(ahead, columns=["mark", *self._kinds]), changes[["mark", *self._kinds]]]).astype(
            "int64").groupby("mark").sum()
        if len(sums):
            low, high = int(sums["low"].min()), int(sums["high"].max())
            newest = high if newest is None else max(newest, high)
            if first is None:
                first = low
                coming = first // MINUTE_MS * MINUTE_MS + MINUTE_MS
        if len(clocks):
            clock = int(clocks["high"].max()) if clock is None else max(clock, int(clocks["high"].max()))
        if newest is not None and clock is not None and clock >= newest:
            end = newest // MINUTE_MS * MINUTE_MS
            for day in range(coming, end + 1, DAY_MS):
                upto = min(day + DAY_MS - MINUTE_MS, end)
                out, level = self._report(day, upto, minutes, ahead, level)
                ahead = ahead[ahead.index > upto]
                yield out.assign(entity=key[0])[hour_schema(self._measures).names]
            if end >= coming:
                coming = end + MINUTE_MS
        if coming is not None:
            minutes = minutes[minutes.index > coming - HOUR_MS]
        self._state.update((first, newest, clock, coming, *(
            json.dumps(x) for x in (minutes.reset_index().values.tolist(), ahead.reset_index().values.tolist(), level))))

    def _report(self, start: int, end: int, minutes: pd.DataFrame, ahead: pd.DataFrame,
                level: list[int]) -> tuple[pd.DataFrame, list[int]]:
        """The marks from start to end, and the levels after them; `ahead` may hold marks before."""
        back = HOUR_MS - MINUTE_MS
        hour = minutes.reindex(range(start - back, end + 1, MINUTE_MS), fill_value=0)
        total = np.vstack([np.zeros((1, len(self._sums)), np.int64), hour.to_numpy(np.int64).cumsum(axis=0)])
        width = HOUR_MS // MINUTE_MS
        out = pd.DataFrame(total[width:] - total[:-width], columns=self._sums)
        marks = np.arange(start, end + 1, MINUTE_MS)
        due = ahead[ahead.index <= end]
        step = due.groupby(np.maximum(due.index, start)).sum().reindex(marks, fill_value=0)
        levels = step.to_numpy(np.int64).cumsum(axis=0) + np.array(level, np.int64)
        out[self._kinds] = levels
        return out.assign(bucket=marks), levels[-1].tolist()

    def close(self) -> None:
        pass


def _in_batches(rows: DataFrame, columns: list[str], schema: str, reduce) -> DataFrame:
    """`reduce` on each batch of each task, ahead of a shuffle."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield reduce(frame)

    return rows.select(*columns).mapInPandas(run, schema)


def hour_reports(seconds: DataFrame, rows: DataFrame, changes: DataFrame, gauge: str, integral: str,
                 times: dict[str, str], kinds: list[str], measures: list[str]) -> DataFrame:
    """Hour reports (entity, bucket, measures) of streams of second loads, of the rows they came from and of
    members' changes; `times` gives the report's name of each count of a second."""
    sums = [integral, *times.values()]
    longs = ["mark", "low", "high", *sums, *kinds]
    schema = ", ".join(["entity string", "part int", *[f"{c} long" for c in longs]])

    def filled(frame: pd.DataFrame, part: int) -> pd.DataFrame:
        return frame.assign(part=part).reindex(columns=["entity", "part", *longs], fill_value=0)

    def of_seconds(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.rename(columns={gauge: integral, **times})
        frame["mark"] = -(-frame["bucket"] // MINUTE_MS) * MINUTE_MS
        grouped = frame.groupby(["entity", "mark"])
        out = grouped[sums].sum().assign(low=grouped["bucket"].min(), high=grouped["bucket"].max())
        return filled(out.reset_index(), SUMS)

    def of_changes(frame: pd.DataFrame) -> pd.DataFrame:
        wide = frame.pivot_table(index=["entity", "mark"], columns="kind", values="delta", aggfunc="sum", fill_value=0)
        return filled(wide.reset_index().rename_axis(columns=None), CHANGES)

    def of_rows(frame: pd.DataFrame) -> pd.DataFrame:
        return filled(frame.groupby("entity", as_index=False)["bucket"].max().rename(columns={"bucket": "high"}), CLOCK)

    parts = _in_batches(seconds, ["entity", "bucket", gauge, *times], schema, of_seconds).unionByName(
        _in_batches(changes, ["entity", "kind", "mark", "delta"], schema, of_changes)).unionByName(
        _in_batches(rows, ["entity", "bucket"], schema, of_rows))
    return parts.groupBy("entity").transformWithStateInPandas(
        statefulProcessor=HourReport(sums, kinds, measures), outputStructType=hour_schema(measures),
        outputMode="Append", timeMode="None")


def stream_user_hours(seconds: DataFrame, online: DataFrame, entity: str, distinct_hours: int = 2) -> DataFrame:
    """`loads.user_load_hour` of a stream of second loads and of the online events they came from."""
    rows = user_member_rows(online, entity).where(F.col("entity").isNotNull())
    changes = member_changes(user_members(rows), distinct_hours * HOUR_MS)
    return hour_reports(seconds, rows, changes, "onlines", "totalOnlineSeconds", {n: n for n in USER_TIMES},
                        USER_KINDS, USER_HOUR_MEASURES)


def stream_speak_hours(seconds: DataFrame, group_event: DataFrame, entity: str, distinct_hours: int = 2) -> DataFrame:
    """`loads.speak_load_hour` of a stream of second loads and of the group events they came from."""
    rows = speak_member_rows(group_event, entity).where(F.col("entity").isNotNull())
    changes = member_changes(speak_members(rows), distinct_hours * HOUR_MS)
    times = {n: "speakingTimes" if n == "getTimes" else n for n in SPEAK_TIMES}
    return hour_reports(seconds, rows, changes, "speakings", "speakingSeconds", times, SPEAK_KINDS, SPEAK_HOUR_MEASURES)


class HourMerge(StatefulProcessor):
    """Adds up partial reports of the mark that is open; a later mark closes it and gives it, once.

    Partials of marks closed before are left out, and `dropped` counts them so far.
    """

    def __init__(self, measures: list[str]) -> None:
        self._measures = measures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", "bucket long, dropped long, sums string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        bucket, dropped, sums = self._open.get() or (None, 0, None)
        if bucket is not None:
            dropped += int((frame["bucket"] < bucket).sum())
            held = pd.DataFrame([[bucket, *json.loads(sums)]], columns=["bucket", *self._measures])
            frame = pd.concat([held, frame.loc[frame["bucket"] >= bucket, held.columns]])
        added = frame.groupby("bucket")[self._measures].sum().sort_index().astype("int64")
        self._open.update((int(added.index[-1]), dropped, json.dumps(added.iloc[-1].tolist())))
        closed = added.iloc[:-1].reset_index()
        if len(closed):
            yield closed.assign(entity=key[0], dropped=dropped)[merged_schema(self._measures).names]

    def close(self) -> None:
        pass


def merged_schema(measures: list[str]) -> T.StructType:
    return T.StructType([*hour_schema(measures), T.StructField("dropped", T.LongType())])


def stream_hour_merge(hours: DataFrame, measures: list[str]) -> DataFrame:
    """`loads.closed_hours` of a stream of hour reports, partial ones added up."""
    return hours.groupBy("entity").transformWithStateInPandas(
        statefulProcessor=HourMerge(measures), outputStructType=merged_schema(measures), outputMode="Append",
        timeMode="None")
