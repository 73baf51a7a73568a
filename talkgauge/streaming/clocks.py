"""Seconds of a stream that close by the clock of their own entity.

A watermark is one time for a whole query, so a server that lags behind the others
would lose its rows. Here each entity has a clock in keyed state, the staircase of
`operators.windows`: the newest second seen so far, in order of arrival. Tasks tell
the clock only the first and last row they have of each second. A second ends with
the first row that moves the end of the window past it; the clock tells the second
which row that was, and the second, which has held its rows, gives those up to it.
All of it is one query: the steps hand over within a trigger.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from talkgauge.functions.times import second_bucket
from talkgauge.schemas import LATE_MS, SECOND_MS

ARRIVALS = "entity string, bucket long, first long, last long"
CUTS = T.StructType([T.StructField("entity", T.StringType()), T.StructField("bucket", T.LongType()),
                     T.StructField("seq", T.LongType())])
#: The cut of a second that ended before this trigger: no row is up to it.
ENDED = -1


def arrivals(rows: DataFrame) -> DataFrame:
    """(entity, bucket, first, last) of rows (entity, bucket, seq), one per second and batch of a task."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.groupby(["entity", "bucket"], as_index=False)["seq"].agg(first="min", last="max")

    return rows.select("entity", "bucket", "seq").mapInPandas(run, ARRIVALS)


class Clock(StatefulProcessor):
    """Tells which of an entity's seconds end, and after which row.

    The state holds the newest second, the end of the window, and the seconds in it
    that have rows, at most five.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._clock = handle.getValueState("clock", "newest long, floor long, waiting string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._clock.get()
        newest, floor, waiting = (None, None, []) if state is None else (state[0], state[1], json.loads(state[2]))
        seen = pd.concat(list(rows)).groupby("bucket")["first"].min().sort_values()
        cuts = {int(b): ENDED for b in seen.index if floor is not None and b < floor}
        waiting = sorted({*waiting, *map(int, seen.index)} - cuts.keys())
        ended = 0
        for bucket, first in zip(seen.index.tolist(), seen.tolist()):
            if newest is not None and bucket <= newest:
                continue
            jump = newest is not None and bucket - newest >= LATE_MS + SECOND_MS
            newest, floor = bucket, bucket - (LATE_MS - SECOND_MS if jump else LATE_MS)
            while ended < len(waiting) and waiting[ended] < floor:
                cuts[waiting[ended]] = first
                ended += 1
        self._clock.update((newest, floor, json.dumps(waiting[ended:])))
        if cuts:
            yield pd.DataFrame({"entity": key[0], "bucket": list(cuts), "seq": list(cuts.values())})

    def close(self) -> None:
        pass


class Seconds(StatefulProcessor):
    """Holds the rows of one second of one entity until its clock ends it, then gives what `reduce` makes of them."""

    def __init__(self, columns: list[str], reduce: Callable[[pd.DataFrame], pd.DataFrame], names: list[str]) -> None:
        self._columns, self._reduce, self._names = columns, reduce, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{c} {'long' if c == 'seq' else 'string'}" for c in self._columns)
        self._rows = handle.getListState("rows", fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        fresh, cuts = frame[~frame["is_cut"]], frame.loc[frame["is_cut"], "seq"]
        if cuts.empty:
            self._rows.appendList([tuple(r) for r in fresh[self._columns].astype(object).itertuples(index=False)])
            return
        held = pd.DataFrame(list(self._rows.get()), columns=self._columns)
        self._rows.clear()
        counted = pd.concat([held, fresh.loc[fresh["seq"] <= int(cuts.max()), self._columns]])
        if len(counted):
            out = self._reduce(counted.astype({"seq": "int64"}).sort_values("seq"))
            yield out.assign(entity=key[0], bucket=int(key[1]))[self._names]

    def close(self) -> None:
        pass


def closed_seconds(rows: DataFrame, columns: list[str], reduce: Callable[[pd.DataFrame], pd.DataFrame],
                   schema: T.StructType) -> DataFrame:
    """What `reduce` makes of each (entity, second), once its entity's clock has passed it.

    `rows` has entity, seq, ts_ms and the text `columns`; `reduce` gets the rows of a second
    in order of arrival, late ones left out, and gives the columns of `schema` but entity and bucket.
    """
    timed = rows.where(F.col("entity").isNotNull()).withColumn("bucket", second_bucket("ts_ms"))
    cuts = arrivals(timed).groupBy("entity").transformWithStateInPandas(
        statefulProcessor=Clock(), outputStructType=CUTS, outputMode="Append", timeMode="None")
    none = [F.lit(None).cast("string").alias(c) for c in columns]
    both = timed.select("entity", "bucket", "seq", *columns, F.lit(False).alias("is_cut")).unionByName(
        cuts.select("entity", "bucket", "seq", *none, F.lit(True).alias("is_cut")))
    return both.groupBy("entity", "bucket").transformWithStateInPandas(
        statefulProcessor=Seconds(["seq", *columns], reduce, schema.names), outputStructType=schema,
        outputMode="Append", timeMode="None")
