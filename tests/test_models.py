"""State machines and load reports against small row-by-row models and literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.functions.times import format_dt
from talkgauge.operators import groups, loads, online, speaking, windows
from talkgauge.schemas import CLIENT_COLUMNS

BASE = 1_456_790_400_000


def make_action(spark, rows):
    """rows: (seq, svc, event, uid, ms after BASE)."""
    df = spark.createDataFrame(
        [(q, s, e, u, BASE + t) for q, s, e, u, t in rows],
        "seq bigint, svc string, event string, uid string, ts_ms bigint",
    )
    nulls = {c: F.lit(None).cast("string") for c in ["agent", *CLIENT_COLUMNS]}
    return df.withColumns({"dt": format_dt("ts_ms"), "company": F.lit("c"), **nulls})


class Machine:
    """One user's latest login and logout, fed row by row."""

    def __init__(self, corrected=False):
        self.on = self.off = None
        self.login_svc = None
        self.corrected = corrected

    def before(self, a, b):
        if self.corrected:
            return True if a is None else False if b is None else a[0] < b[0]
        return True if b is None else False if a is None else a[0] < b[0]

    def feed(self, svc, event, t):
        out = []
        fresh = all(x is None or x[0] <= t for x in (self.on, self.off))
        if event in ("LOGIN", "RELOGIN"):
            if fresh and self.before(self.on, self.off):
                gap = (t - self.off[0]) // 1000 if self.off else 0
                if event == "LOGIN" and self.off and self.off[1] == "BROKEN" and gap < 300:
                    out.append(("ubro", gap))
                out.append(("uon", gap))
            if self.on is None or self.on[0] <= t:
                self.on, self.login_svc = (t, event), svc
            if event == "RELOGIN":
                out.append(("ubro", 0))
        else:
            if fresh and self.before(self.off, self.on):
                out.append(("uoff", (t - self.on[0]) // 1000 if self.on else 0))
                if self.on and self.login_svc == svc:
                    out.append(("session", (self.on[0], t)))
            if self.off is None or self.off[0] <= t:
                self.off = (t, event)
        return out


@pytest.mark.parametrize("corrected", [False, True])
def test_online_machine_on_random_rows(spark, corrected):
    rng = random.Random(5)
    rows = [
        (i, f"s{rng.randrange(2)}", rng.choice(["LOGIN", "RELOGIN", "LOGOUT", "BROKEN"]), f"u{rng.randrange(12)}",
         i * 20_000 + rng.randrange(-300_000, 300_000)) for i in range(1500)
    ]
    machines, events, sessions = {}, [], []
    for q, svc, event, uid, t in rows:
        for kind, value in machines.setdefault(uid, Machine(corrected)).feed(svc, event, t):
            if kind == "session":
                sessions.append((q, BASE + value[0], BASE + value[1]))
            else:
                events.append((q, kind, value))
    action = make_action(spark, rows)
    mode = "corrected" if corrected else "reference"
    got = online.online_events(action, mode).select("seq", "event", "interval", "pos").orderBy("seq", "pos")
    assert [(r.seq, r.event, r.interval) for r in got.collect()] == events
    got = online.user_sessions(action, mode).select("seq", "login_ms", "logout_ms").orderBy("seq")
    assert [tuple(r) for r in got.collect()] == sessions


CASES = [
    ("LOGIN 0", "uon 0"),
    ("LOGIN 0, LOGOUT 10", "uon 0"),
    ("LOGIN 0, BROKEN 10, LOGIN 20, LOGOUT 50", "uon 0, ubro 10, uon 10, uoff 30"),
    ("LOGIN 0, BROKEN 10, LOGIN 310", "uon 0, uon 300"),
    ("RELOGIN 0", "uon 0, ubro 0"),
    ("LOGOUT 0", "uoff 0"),
    ("LOGOUT 0, LOGIN 5", "uoff 0"),
    ("LOGIN 20, LOGOUT 10", "uon 0"),
    ("LOGIN 20, RELOGIN 10", "uon 0, ubro 0"),
]


def test_online_machine_cases(spark):
    rows = []
    for case, (text, _) in enumerate(CASES):
        for step in text.split(", "):
            event, second = step.split()
            rows.append((len(rows), "s", event, f"u{case}", int(second) * 1000))
    got = {}
    for r in online.online_events(make_action(spark, rows)).orderBy("seq", "pos").collect():
        got.setdefault(r.uid, []).append(f"{r.event} {r.interval}")
    assert {f"u{i}": out.split(", ") for i, (_, out) in enumerate(CASES)} == got


def make_group_event(spark, rows):
    """rows: (seq, svc, event, uid, gid, ms after BASE); temporary groups start with t."""
    df = spark.createDataFrame(
        [(q, s, e, u, g, BASE + t) for q, s, e, u, g, t in rows],
        "seq bigint, svc string, event string, uid string, gid string, ts_ms bigint",
    )
    temp = F.col("gid").startswith("t")
    return df.withColumns({
        "dt": format_dt("ts_ms"), "company": F.concat(F.lit("c"), "uid"), "agent": F.lit(None).cast("string"),
        "gtype": F.when(temp, "gtemp").otherwise("gnormal"), "gagent": F.lit("a"),
        "gcompany": F.when(temp, F.concat(F.lit("c"), "uid")).otherwise("gc"),
        "gfull": F.when(temp, F.concat("svc", F.lit(":"), "gid")).otherwise(F.col("gid")),
    })


def speaking_model(rows, literal):
    newest, holder, out = {}, {}, []
    first = {}
    for q, svc, event, uid, gid, t in rows:
        if event == "DENT_MIC" or newest.get(gid, t) > t:
            continue
        newest[gid] = t
        if event == "GET_MIC":
            first.setdefault(gid, svc)
        if gid not in first:
            continue
        held = holder.pop(gid, None)
        if held and (literal or event == "GET_MIC" or held[0] == uid):
            out.append((q, first[gid], held[0], BASE + held[1], BASE + t, event))
        if literal or event == "GET_MIC":
            holder[gid] = (uid, t)
    return out


@pytest.mark.parametrize("literal", [False, True])
def test_speaking_on_random_rows(spark, literal):
    rng = random.Random(9)
    kinds = ["GET_MIC", "GET_MIC", "RELEASE_MIC", "LOSTMIC_AUTO", "LOSTMIC_REPLACE", "DENT_MIC"]
    rows = [(i, f"s{rng.randrange(2)}", rng.choice(kinds), f"u{rng.randrange(3)}", f"g{rng.randrange(5)}",
             i * 1000 + rng.randrange(-8000, 8000)) for i in range(1500)]
    got = speaking.speaking_records(make_group_event(spark, rows), literal).select(
        "seq", "svc", "uid", "start_ms", "end_ms", "event").orderBy("seq").collect()
    assert [tuple(r) for r in got] == speaking_model(rows, literal)


def test_speaking_cases(spark):
    cases = {
        "a": [("GET_MIC", "x", 0), ("RELEASE_MIC", "x", 4)],
        "b": [("GET_MIC", "x", 0), ("GET_MIC", "y", 3)],
        "c": [("GET_MIC", "x", 0), ("RELEASE_MIC", "y", 2), ("RELEASE_MIC", "x", 4)],
        "d": [("GET_MIC", "x", 0), ("RELEASE_MIC", "x", 4), ("GET_MIC", "y", 9)],
    }
    rows = []
    for gid, steps in cases.items():
        for event, uid, second in steps:
            rows.append((len(rows), "s", event, uid, gid, second * 1000))
    events = make_group_event(spark, rows)

    def spans(literal):
        return sorted((r.gid, r.uid, (r.start_ms - BASE) // 1000, (r.end_ms - BASE) // 1000, r.event)
                      for r in speaking.speaking_records(events, literal).collect())

    assert spans(False) == [("a", "x", 0, 4, "RELEASE_MIC"), ("b", "x", 0, 3, "GET_MIC"), ("d", "x", 0, 4, "RELEASE_MIC")]
    assert ("d", "x", 4, 9, "GET_MIC") in spans(True)


def test_temporary_group_expires_and_groups_empty(spark):
    hour = 3_600_000
    rows = [
        (0, "s", "JOIN_GROUP", "u", "t1", 0), (1, "s", "JOIN_GROUP", "v", "t1", 1000),
        (2, "s", "JOIN_GROUP", "u", "g1", 2000), (3, "r", "JOIN_GROUP", "v", "g1", 3000),
        (4, "s", "LEAVE_GROUP", "u", "g1", 4000), (5, "r", "LEAVE_GROUP", "v", "g1", 5000),
        (6, "r", "JOIN_GROUP", "w", "g1", 6000), (7, "r", "JOIN_GROUP", "x", "g1", 5500),
        (8, "s", "JOIN_GROUP", "y", "t1", 2 * hour), (9, "r", "JOIN_GROUP", "x", "g1", 100),
        (10, "s", "JOIN_GROUP", "z", "t2", 100_000),
    ]
    events = make_group_event(spark, rows)
    members = groups.membership(groups.accepted_in_out(events))
    lives = groups.group_lives(members)
    assert rows_of(groups.group_members(members)) == [
        ("g1", "gnormal", "w"), ("g1", "gnormal", "x"), ("s:t1", "gtemp", "y"),
    ]
    assert rows_of(groups.live_groups_by(members, lives, "svc"), ["svc", "gfull"]) == [("g1", "r"), ("s:t1", "s")]
    load = {(r.svc, (r.bucket - BASE) // 1000): (r.groups, r.temp_groups)
            for r in groups.group_load_second(events, lives).collect()}
    assert load == {
        ("s", 0): (0, 1), ("s", 1): (0, 1), ("s", 2): (1, 1), ("r", 3): (1, 0), ("s", 4): (1, 1),
        ("r", 5): (0, 0), ("r", 6): (1, 0), ("s", 7200): (0, 2),
    }
    assert {r.uid: r.current_group for r in groups.user_current_group(events).collect()} == {
        "u": "0", "v": "0", "w": "g1", "x": "g1", "y": "s:t1", "z": "s:t2"
    }


def test_late_rule(spark):
    times = [100.2, 100.9, 101.0, 104.9, 105.0, 100.5, 101.1]
    rows = spark.createDataFrame([(i, "s", int(t * 1000)) for i, t in enumerate(times)], "seq bigint, svc string, ts_ms bigint")
    late = [r.late for r in windows.mark_late(rows, "svc").orderBy("seq").collect()]
    assert late == [False] * 5 + [True, False]
    skipped = windows.skipped_seconds(
        spark.createDataFrame([(0, "s", 100_000), (1, "s", 110_000)], "seq bigint, svc string, ts_ms bigint"), "svc")
    assert [r.bucket for r in skipped.orderBy("bucket").collect()] == list(range(101_000, 107_000, 1000))


def test_user_load_against_sets(spark):
    """Gauge, trailing sums and timed-out sets, second by second."""
    rng = random.Random(3)
    rows, t = [], 0
    for i in range(900):
        t += rng.randrange(0, 30_000)
        rows.append((i, rng.choice(["uon", "uon", "uoff", "ubro"]), f"u{rng.randrange(15)}", t))
    df = spark.createDataFrame(
        [(i, 0, "s", e, u, BASE + t) for i, e, u, t in rows],
        "seq bigint, pos int, svc string, event string, uid string, ts_ms bigint")
    first, last = rows[0][3] // 1000 - 4, rows[-1][3] // 1000
    by_second, online_now, second, hour = {}, set(), {}, {}
    for i, e, u, t in rows:
        by_second.setdefault(t // 1000, []).append((e, u))
    last_op, logins, logouts, brokens, history = {}, {}, {}, {}, []
    base_s = BASE // 1000
    for s in range(first, last + 1):
        here = by_second.get(s, [])
        sets = {k: {u for e, u in here if e == k} for k in ("uon", "uoff", "ubro")}
        online_now = (online_now | sets["uon"]) - sets["uoff"]
        for e, u in here:
            {"uon": logins, "uoff": logouts, "ubro": brokens}[e][u] = s
            if e != "ubro":
                last_op[u] = (e, s)
        report = (len(online_now), len(sets["uon"]), len(sets["uoff"]), len(sets["ubro"]))
        second[s] = report
        history = (history + [report])[-3600:]
        if (s + base_s) % 60 == 0 and s > first:
            alive = lambda d: sum(1 for x in d.values() if x > s - 7200)
            sums = [sum(h[k] for h in history) for k in range(4)]
            present = sum(1 for e, x in last_op.values() if e == "uon" or x > s - 7200)
            hour[s] = (present, alive(logins), sums[1], alive(logouts), sums[2], alive(brokens), sums[3], sums[0])
    got = {(r.bucket - BASE) // 1000: (r.onlines, r.loginTimes, r.logoutTimes, r.brokenTimes)
           for r in loads.user_load_second(loads.user_changes(df, "svc")).collect()}
    assert got == second
    got = {(r.bucket - BASE) // 1000: tuple(r)[2:] for r in loads.user_load_hour(df, loads.user_changes(df, "svc"), "svc").collect()}
    assert got == hour
