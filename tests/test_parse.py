"""Literal log lines and what they become."""

import pytest
from pyspark.sql import functions as F

from talkgauge.operators import enrich
from talkgauge.operators.parse import COLUMN_KEYS, EVENT_PREFIXES, FAMILIES, parse_logs

HEAD = "svc1 2016-03-01 10:20:30.12345 INFO [x] "

# line -> expected fields of the log row, or None if the line is dropped
CASES = [
    (HEAD + '"LOGIN uid=(1001) context=(c1) address=(1.2.3.4:5) meid=(A1) imsi=()"',
     {"event": "LOGIN", "uid": "1001", "ctx": "c1", "ip": "1.2.3.4:5", "dev_id": "meid-A1", "imsi": "",
      "dt": "2016-03-01 10:20:30.123", "svc": "svc1", "level": "INFO"}),
    (HEAD.replace("12345", "123456") + '"LOGIN uid=(1)"', {"dt": "2016-03-01 10:20:30.234"}),
    ('svc1 2016/03/01 10:20:30.1234 INFO "LOGIN FAILED account=(bob) result=(3)"',
     {"event": "LOGIN_FAILED", "uid": "bob", "result": "3", "dt": "2016-03-01 10:20:30.012"}),
    ('svc1 2016.03.01 10:20:30.1234 INFO "LOGOUT uid=(1)"', None),
    ('svc1 2016-03/01 10:20:30.1234 INFO "LOGOUT uid=(1)"', None),
    ('svc1 2016-03-01\t10:20:30.1234 INFO "LOGOUT uid=(1)"', None),
    ('svc1 2016-13-32 24:61:00.0 INFO "LOGOUT uid=(1)"', {"dt": "2017-02-02 01:01:00.000"}),
    ('svc1 2016-03-01 10:20:30.99999999999999999999 INFO "LOGOUT uid=(1)"', None),
    ('svc1 2016-03-01 10:20:30.1234 ERROR "boom"', {"event": None, "uid": None, "level": "ERROR", "content": "boom"}),
    ('svc1 2016-03-01 10:20:30.1234 WARN "LOGIN uid=(1)"', {"event": None, "uid": None}),
    ('svc1 2016-03-01 10:20:30.1234 INFO "SOMETHING uid=(1)"', None),
    ("garbage", None),
    ("", None),
    (HEAD + '"LOGOUT BROKEN uid=(1) address=(a)"', {"event": "BROKEN", "ip": "a"}),
    (HEAD + '"RELOGIN uid=(1) esn=(E) version=(2) device=(d) expect_payload=(p)"',
     {"event": "RELOGIN", "dev_id": "esn-E", "ver": "2", "dev": "d", "ex_pt": "p"}),
    (HEAD + '"CONFIG uid=(7) uid=(8) target=(9) audio=(on) dispatched=(9)"',
     {"event": "SW_AUDIO", "uid": "8", "tar": "9", "sw": "on", "tar_got": "9", "val": None}),
    (HEAD + '"CONFIG uid=(7) location=(on) period=(60)"', {"event": "SW_GPS", "sw": "on", "val": "60"}),
    (HEAD + '"CONFIG uid=(7)"', None),
    (HEAD + '"GET MIC uid=(1)"', None),
    (HEAD + '"JOIN GROUP gid=(1)"', None),
    (HEAD + '"GET MIC uid=(1) gid=(x) target=(t)"', {"event": "GET_MIC", "gid": "x", "tar": "t"}),
    (HEAD + '"QUERY GROUP uid=(1) gcount=(4) gids=(1,2)"', {"event": "QUERY_GROUP", "count": "4", "tar": "1,2"}),
    (HEAD + '"QUERY USER uid=(1) count=(5) gcount=(4)"', {"event": "QUERY_USER", "count": "5"}),
    (HEAD + '"CALL uid=(1) targets=(2,3) called=(2)"', {"event": "CALL", "tar": "2,3", "tar_got": "2"}),
    (HEAD + '"QUICKDIAL uid=(1) targets=(2)"', {"event": "QUICK_DIAL", "tar": "2", "tar_got": None}),
    (HEAD + '"CHANGE NAME uid=(1) name=(n)"', {"event": "CH_NAME", "tar_got": "n"}),
    (HEAD + '"CONTACT MAKE uid=(1) target=(2) requested=(3)"', {"event": "CONTACT_REQ", "tar": "2", "tar_got": "3"}),
    (HEAD + '"CONTACT RESPONSE uid=(1) accept=(2) paired=(3) refuse=(4)"',
     {"event": "CONTACT_REP", "tar": "2", "tar_got": "3", "tar_dent": "4"}),
    (HEAD + '"CONTACT REMOVE uid=(1) target=(2)"', {"event": "CONTACT_RM", "tar": "2"}),
    (HEAD + '"DISPATCH uid=(1) gid=(5) target=(2) dispatched=(3)"',
     {"event": "DISPATCH", "val": "5", "tar": "2", "tar_got": "3", "gid": None}),
    (HEAD + '"TAKE MIC uid=(1) target=(2) dispatched=(3)"', {"event": "TAKE_MIC", "tar": "2", "tar_got": "3"}),
    (HEAD + '"CREATE GROUP uid=(1) gid=(5) name=(n)"', {"event": "CREATE_GROUP", "tar": "5", "val": "n"}),
    (HEAD + '"DELETE GROUP uid=(1) gid=(5) deleted=(5)"', {"event": "RM_GROUP", "tar": "5", "tar_got": "5"}),
    (HEAD + '"EMPOWER uid=(1) target=(2) added=(3) gid=(5)"', {"event": "EMPOWER", "tar": "2", "tar_got": "3", "val": "5"}),
    (HEAD + '"EMPOWER FAULT uid=(1) target=(2) gid=(5)"', {"event": "EMPOWER_FAILED", "tar": "2", "val": "5"}),
    (HEAD + '"DEPRIVE uid=(1) target=(2) remove=(3) gid=(5)"', {"event": "DEPRIVE", "tar": "2", "tar_got": "3", "val": "5"}),
    (HEAD + '"DEPRIVE FAULT uid=(1) target=(2) gid=(5)"', {"event": "DEPRIVE_FAILED", "tar": "2", "val": "5"}),
    (HEAD + '"MODIFY GROUP uid=(1) gid=(5) name=(n)"', {"event": "CH_GROUP_NAME", "tar": "5", "val": "n"}),
    (HEAD + '"MODIFY GROUP FAULT uid=(1) gid=(5) name=(n)"', {"event": "CH_GROUP_NAME_FAILED", "tar": "5", "val": "n"}),
    (HEAD + '"POST WORKSHEET uid=(1) target=(2) msgcount=(3)"', {"event": "WORKSHEET_POST", "tar": "2", "count": "3"}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    raw = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(CASES)], "seq bigint, line string")
    return {r.seq: r.asDict() for r in parse_logs(raw).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_line(parsed, i):
    expected = CASES[i][1]
    if expected is None:
        assert i not in parsed
    else:
        assert {k: parsed[i][k] for k in expected} == expected


def test_passwords_are_hashed_unless_asked(spark):
    import hashlib

    raw = spark.createDataFrame([(0, HEAD + '"CHANGE PWD FAULT uid=(1) oldpwd=(a) newpwd=(b)"')], "seq bigint, line string")
    masked, plain = parse_logs(raw).first(), parse_logs(raw, mask_passwords=False).first()
    assert (plain.tar, plain.tar_dent, plain.uid) == ("a", "b", "1")
    assert (masked.tar, masked.tar_dent, masked.uid) == (
        hashlib.sha256(b"a").hexdigest(), hashlib.sha256(b"b").hexdigest(), "1"
    )


def test_true_fraction(spark):
    raw = spark.createDataFrame([(0, HEAD.replace("12345", "5") + '"LOGOUT uid=(1)"')], "seq bigint, line string")
    assert parse_logs(raw, true_fraction=True).first().ts_ms % 1000 == 500


def test_every_event_has_a_family():
    events = {e for _, e in EVENT_PREFIXES} - {"CONFIG"} | {"SW_AUDIO", "SW_GPS"}
    assert events == {e for f in FAMILIES.values() for e in f}
    assert all(set(FAMILIES) <= set(COLUMN_KEYS["uid"]) for _ in [0])


def test_group_type_and_organisation(spark):
    rows = [
        (0, "s", "GET_MIC", "u", "x", "cu", "au"), (1, "s", "JOIN_GROUP", "u", "1879048192", "cu", "au"),
        (2, "s", "JOIN_GROUP", "u", "1879048191", "cu", "au"), (3, "s", "JOIN_GROUP", "u", "+5", "cu", "au"),
        (4, "s", "JOIN_GROUP", "u", "7", "cu", "au"), (5, "s", "LOGIN", "u", None, "cu", "au"),
    ]
    action = spark.createDataFrame(rows, "seq bigint, svc string, event string, uid string, gid string, company string, agent string")
    action = action.withColumns({"dt": F.lit("2016-03-01 00:00:00.000"), "ts_ms": F.lit(0).cast("bigint")})
    org = spark.createDataFrame([("1879048191", "", None), ("+5", "g", "ga")], "gid string, gcompany string, gagent string")
    got = {r.seq: (r.gtype, r.gfull, r.gcompany, r.gagent) for r in enrich.group_events(action, org).collect()}
    assert got == {
        1: ("gtemp", "s:1879048192", "cu", "au"), 2: ("gnormal", "1879048191", "", None), 3: ("gnormal", "+5", "g", "ga"),
    }
