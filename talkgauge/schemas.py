"""Column lists, event names and fixed values shared by every transform."""

from __future__ import annotations

from pyspark.sql import types as T

SECOND_MS = 1000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

# The tables and keys written must carry exactly these names.
LOG_COLUMNS = [
    "svc", "dt", "level", "content", "event", "uid", "gid", "result", "ctx",
    "ip", "dev", "dev_id", "ver", "imsi", "ex_pt", "tar", "tar_got",
    "tar_dent", "count", "sw", "val",
]
ACTION_COLUMNS = [
    "svc", "dt", "event", "uid", "company", "agent", "gid", "ctx", "ip",
    "dev", "dev_id", "ver", "imsi", "ex_pt", "tar", "tar_got", "tar_dent",
    "count", "sw", "val",
]
ONLINE_EVENT_COLUMNS = [
    "svc", "dt", "event", "uid", "company", "agent", "interval", "ctx", "ip",
    "dev", "dev_id", "ver", "imsi", "ex_pt",
]
CLIENT_COLUMNS = ["ctx", "ip", "dev", "dev_id", "ver", "imsi", "ex_pt"]
GROUP_EVENT_COLUMNS = [
    "svc", "dt", "event", "uid", "company", "agent", "gid", "gtype",
    "gcompany", "gagent",
]
SESSION_COLUMNS = ["svc", "uid", "company", "agent", "login", "logout", *CLIENT_COLUMNS]
SPEAKING_COLUMNS = [
    "svc", "gid", "gtype", "gcompany", "gagent", "uid", "company", "agent",
    "tvstart", "tvend", "event",
]

# JSON field names of an action, in output order, by column.
ACTION_JSON_FIELDS = {
    "server": "svc", "datetime": "dt", "event": "event", "uid": "uid",
    "gid": "gid", "company": "company", "agent": "agent", "ctx": "ctx",
    "ip": "ip", "device": "dev", "devid": "dev_id", "version": "ver",
    "imsi": "imsi", "expect_payload": "ex_pt", "target": "tar",
    "target_got": "tar_got", "target_dent": "tar_dent", "count": "count",
    "sw": "sw", "value": "val",
}

LOGIN_EVENTS = ["LOGIN", "RELOGIN"]
LOGOUT_EVENTS = ["LOGOUT", "BROKEN"]
ONLINE_EVENTS = ["LOGIN", "RELOGIN", "BROKEN", "LOGOUT"]
IN_OUT_EVENTS = ["JOIN_GROUP", "LEAVE_GROUP"]
MIC_CLOSE_EVENTS = ["RELEASE_MIC", "LOSTMIC_AUTO", "LOSTMIC_REPLACE"]
SPEAK_EVENTS = ["GET_MIC", "RELEASE_MIC", "DENT_MIC", "LOSTMIC_AUTO", "LOSTMIC_REPLACE"]
GROUP_EVENTS = [*IN_OUT_EVENTS, *SPEAK_EVENTS]

USER_ONLINE = "uon"
USER_OFFLINE = "uoff"
USER_BROKEN = "ubro"

GROUP_NORMAL = "gnormal"
GROUP_TEMP = "gtemp"
TEMP_GID_START = 0x70000000

BROKEN_GAP_SECONDS = 300
MIC_CAP_MS = 5 * MINUTE_MS
TEMP_GROUP_TTL_MS = HOUR_MS
LATE_MS = 4 * SECOND_MS

USER_SECOND_MEASURES = ["onlines", "loginTimes", "logoutTimes", "brokenTimes"]
USER_HOUR_MEASURES = [
    "onlines", "loginUsers", "loginTimes", "logoutUsers", "logoutTimes",
    "brokenUsers", "brokenTimes", "totalOnlineSeconds",
]
SPEAK_SECOND_MEASURES = [
    "speakings", "getTimes", "lostAutoTimes", "lostReplaceTimes", "dentTimes",
]
SPEAK_HOUR_MEASURES = [
    "speakingSeconds", "speakingTimes", "speakingUsers", "speakingGroups",
    "lostAutoTimes", "lostAutoUsers", "lostAutoGroups",
    "lostReplaceTimes", "lostReplaceUsers", "lostReplaceGroups",
    "dentTimes", "dentUsers", "dentGroups",
]
GROUP_SECOND_MEASURES = ["groups", "temp_groups"]

RAW_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("line", T.StringType())]
)


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


LOG_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType()), *_strings(LOG_COLUMNS), T.StructField("ts_ms", T.LongType())]
)
ACTION_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType()), *_strings(ACTION_COLUMNS), T.StructField("ts_ms", T.LongType())]
)
DIM_USER_SCHEMA = T.StructType(_strings(["uid", "company"]))
DIM_GROUP_SCHEMA = T.StructType(_strings(["gid", "company"]))
DIM_COMPANY_SCHEMA = T.StructType(_strings(["company", "agent"]))
