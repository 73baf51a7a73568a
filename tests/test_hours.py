"""Loads, clocks and trailing hours on streams: processors in many triggers against models, queries against batch."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.operators import loads
from talkgauge.schemas import HOUR_MS, MINUTE_MS
from talkgauge.streaming import clocks, hours, jobs

HOUR = HOUR_MS


class Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Rows(Value):
    def get(self):
        return iter(self.value or [])

    def appendList(self, rows):
        self.value = (self.value or []) + rows


class Handle:
    """State of one key, kept in memory."""

    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return Value()

    def getListState(self, name, schema):
        return Rows()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def started(processor):
    handle = Handle()
    processor.init(handle)
    return processor, handle


def feed(processor, key, frame):
    return [row for out in processor.handleInputRows(key, iter([frame]), None) for row in out.to_dict("records")]


def in_triggers(rows, rng, n=20):
    cuts = sorted(rng.sample(range(1, len(rows)), n - 1))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


@pytest.mark.parametrize("seed", range(4))
def test_clock_ends_seconds_as_the_rule_row_by_row(seed):
    """Rows that jump, lag and come too late, in 20 triggers: each counts in its second or not, by arrival alone."""
    rng = random.Random(seed)
    rows, now = [], 1_000_000
    for seq in range(600):
        now += rng.choice([0, 0, 200, 700, 1000, 1500, 6000 if rng.random() < 0.1 else 0])
        rows.append((seq, (now - rng.choice([0, 0, 0, 900, 2500, 3500, 4500, 9000])) // 1000 * 1000))
    newest, reach, want = None, 4000, {}
    for seq, bucket in rows:
        if newest is None or bucket >= newest - reach:
            want.setdefault(bucket, []).append(seq)
        if newest is None or bucket > newest:
            newest, reach = bucket, 3000 if newest is not None and bucket - newest >= 5000 else 4000
    clock, _ = started(clocks.Clock())
    seconds, got = {}, {}
    names = ["uid", "entity", "bucket", "seqs"]
    for part in in_triggers(rows, rng):
        frame = pd.DataFrame(part, columns=["seq", "bucket"])
        seen = frame.groupby("bucket", as_index=False)["seq"].agg(first="min", last="max")
        cuts = feed(clock, ("s",), seen)
        for bucket in sorted({*frame["bucket"], *[c["bucket"] for c in cuts]}):
            if bucket not in seconds:
                seconds[bucket], _ = started(clocks.Seconds(
                    ["seq", "uid"], lambda r: pd.DataFrame({"uid": ["u"], "seqs": [r["seq"].tolist()]}), names))
            mine = frame.loc[frame["bucket"] == bucket, ["seq"]].assign(uid="u", is_cut=False)
            ends = pd.DataFrame([c["seq"] for c in cuts if c["bucket"] == bucket], columns=["seq"]).assign(uid=None, is_cut=True)
            for out in feed(seconds[bucket], ("s", bucket), pd.concat([mine, ends]).astype({"is_cut": bool})):
                assert bucket not in got
                got[bucket] = out["seqs"]
    still_open = {b for b, s in want.items() if b >= newest - reach}
    assert got == {b: s for b, s in want.items() if b not in still_open}
    assert all(s._rows.value is None for b, s in seconds.items() if b not in still_open)  # nothing is held of ended ones


def intervals(ops, ttl):
    """Marks at which a member counts: from each op to its end or the next op."""
    last = {}
    for bucket, seq, forever in ops:
        mark = -(-bucket // MINUTE_MS) * MINUTE_MS
        last[mark] = max(last.get(mark, (0, 0, False)), (bucket, seq, forever))
    marks = sorted(last)
    out = []
    for mark, coming in zip(marks, [*marks[1:], 1 << 61]):
        out.append((mark, min(coming, hours.FOREVER if last[mark][2] else mark + ttl)))
    return out


@pytest.mark.parametrize("forever", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_member_intervals(seed, forever):
    """Puts again, ties, events that last forever and rows out of order by less than a trigger."""
    rng = random.Random(seed)
    ttl, ops, now = 2 * HOUR, [], 0
    for seq in range(120):
        now += rng.choice([0, 500, 20_000, 61_000, HOUR, 3 * HOUR])
        ops.append((now, seq, forever and rng.random() < 0.5))
    member, handle = started(hours.MemberIntervals(ttl))
    deltas = {}
    for part in in_triggers(ops, rng):
        rng.shuffle(part)
        frame = pd.DataFrame(part, columns=["bucket", "seq", "forever"])
        frame["mark"] = -(-frame["bucket"] // MINUTE_MS) * MINUTE_MS
        for row in feed(member, ("s", "k", "u"), frame):
            deltas[row["mark"]] = deltas.get(row["mark"], 0) + row["delta"]
        assert len(handle.timers) <= 1
    want = intervals(ops, ttl)
    for at in range(0, now + 4 * HOUR, 7 * MINUTE_MS):
        assert sum(d for m, d in deltas.items() if m <= at) == sum(a <= at < b for a, b in want), at
    if handle.timers:
        class Expired:
            def getExpiryTimeInMs(self):
                return max(handle.timers)
        list(member.handleExpiredTimer(("s", "k", "u"), None, Expired()))
        assert member._interval.get() is None


def test_an_older_event_adds_what_is_not_covered():
    member, _ = started(hours.MemberIntervals(HOUR))
    deltas = {}
    for bucket in (10 * HOUR, 8 * HOUR, 10 * HOUR + MINUTE_MS, 9 * HOUR + 30 * MINUTE_MS):
        frame = pd.DataFrame([(bucket, 1, bucket, False)], columns=["bucket", "seq", "mark", "forever"])
        for row in feed(member, ("s", "k", "u"), frame):
            deltas[row["mark"]] = deltas.get(row["mark"], 0) + row["delta"]
    assert {m: d for m, d in deltas.items() if d} == {
        8 * HOUR: 1, 9 * HOUR: -1, 9 * HOUR + 30 * MINUTE_MS: 1, 11 * HOUR + MINUTE_MS: -1}


@pytest.mark.parametrize("seed", range(3))
def test_hour_report_in_twenty_triggers(seed):
    """Sums and levels at every passed mark equal plain sums; the state holds an hour of minutes."""
    rng = random.Random(seed)
    start = 7 * HOUR + rng.randrange(60) * 1000
    seconds = [(start + 1000 * k, rng.randint(0, 5) if rng.random() < 0.2 else 0) for k in range(3 * 3600 + rng.randrange(100))]
    deltas = [(-(-rng.choice(seconds)[0] // MINUTE_MS) * MINUTE_MS, rng.choice([1, 1, -1])) for _ in range(300)]
    report, _ = started(hours.HourReport(["n"], ["k"], ["n", "k"]))
    got, sent = {}, 0
    for part in in_triggers(seconds, rng):
        high = part[-1][0]
        rows = [(hours.SUMS, -(-b // MINUTE_MS) * MINUTE_MS, b, b, n, 0) for b, n in part]
        due = [d for d in sorted(deltas) if sent < d[0] <= high + MINUTE_MS]
        sent = max([sent, high + MINUTE_MS])
        rows += [(hours.CHANGES, m, 0, 0, 0, d) for m, d in due] + [(hours.CLOCK, 0, 0, high, 0, 0)]
        for row in feed(report, ("s",), pd.DataFrame(rows, columns=["part", "mark", "low", "high", "n", "k"])):
            assert row["bucket"] not in got
            got[row["bucket"]] = row["n"], row["k"]
        assert report._state.get()[4].count("[") <= 62
    last = seconds[-1][0]
    marks = range(start // MINUTE_MS * MINUTE_MS + MINUTE_MS, last + 1, MINUTE_MS)
    assert got == {m: (sum(n for b, n in seconds if m - HOUR < b <= m), sum(d for at, d in deltas if at <= m)) for m in marks}


def test_merge_writes_each_mark_once_and_counts_older_partials():
    merge, _ = started(hours.HourMerge(["n"]))
    triggers = [[(1, 5), (1, 2)], [(1, 1), (2, 4)], [(1, 9), (2, 6), (2, 1)], [(5, 1), (4, 7)], [(3, 1), (6, 0)]]
    got = [(r["bucket"], r["n"], r["dropped"]) for t in triggers for r in feed(merge, ("s",), pd.DataFrame(t, columns=["bucket", "n"]))]
    assert got == [(1, 8, 0), (2, 11, 1), (4, 7, 1), (5, 1, 2)]


@pytest.fixture(scope="module")
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def follow(spark, rows, folder, parts):
    """`rows` as a stream of `parts` triggers in order of arrival."""
    width = rows.agg(F.max("seq")).first()[0] // parts + 1
    for part in range(parts):
        rows.where(F.floor(F.col("seq") / width) == part).coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_table(spark, folder, rows.schema, 1)


@pytest.mark.parametrize("kind,place", [("user", "svc"), ("speak", "gcompany")])
def test_loads_and_hours_of_a_stream(spark, tables, tmp_path, few_partitions, kind, place):
    """Seconds, hours and merged hours in three triggers equal the batch ones as far as they are closed."""
    source = (tables.online if kind == "user" else tables.group_event).withColumnRenamed("pos", "pos_")
    rows = follow(spark, source, str(tmp_path / "rows"), 3)
    build = jobs.user_load_stream if kind == "user" else jobs.speak_load_stream
    stream = build(rows, place)
    query = jobs.write_table(stream, str(tmp_path / "second"), str(tmp_path / "c1"), once=True)
    query.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "second"))
    newest = got.groupBy("entity").agg(F.max("bucket").alias("newest"))
    changes = tables.user_changes(place) if kind == "user" else tables.speak_changes(place)
    batch = (loads.user_load_second if kind == "user" else loads.speak_load_second)(changes)
    closed = batch.join(newest, "entity").where("bucket <= newest").select(got.columns)
    assert newest.count() >= 2 and rows_of(got) == rows_of(closed)

    seconds = jobs.read_table(spark, str(tmp_path / "second"), stream.schema, 1)
    again = jobs.read_table(spark, str(tmp_path / "rows"), source.schema, 1)
    report = (hours.stream_user_hours if kind == "user" else hours.stream_speak_hours)(seconds, again, place)
    jobs.write_table(report, str(tmp_path / "hour"), str(tmp_path / "c2"), once=True).awaitTermination()
    got = spark.read.schema(report.schema).parquet(str(tmp_path / "hour"))
    batch = (loads.user_load_hour if kind == "user" else loads.speak_load_hour)(source, changes, place)
    closed = batch.join(newest, "entity").where("bucket <= newest").select(got.columns)
    assert got.count() > 10 and rows_of(got) == rows_of(closed)


def test_a_server_that_lags_keeps_its_rows(spark, tmp_path, few_partitions):
    """Two servers an hour apart, in four triggers: each closes its seconds by its own clock."""
    rows = [(2 * k + s, f"s{s}", f"u{k % 3}", "uon", 10**9 + 1000 * k - s * HOUR) for k in range(60) for s in range(2)]
    source = spark.createDataFrame(rows, "seq long, svc string, uid string, event string, ts_ms long")
    stream = jobs.user_load_stream(follow(spark, source, str(tmp_path / "rows"), 4), "svc")
    jobs.write_table(stream, str(tmp_path / "out"), str(tmp_path / "c"), once=True).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    counts = {r["entity"]: r["n"] for r in got.groupBy("entity").agg(F.sum("loginTimes").alias("n")).collect()}
    assert counts == {"s0": 55, "s1": 55}  # the last five seconds are open
