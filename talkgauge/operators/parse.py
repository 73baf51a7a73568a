"""Log lines to the 21-column `log` table, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.functions.text import kv_arrays, kv_get
from talkgauge.functions.times import epoch_days, floor_to, format_dt
from talkgauge.schemas import LOG_COLUMNS, SPEAK_EVENTS, IN_OUT_EVENTS

# What a line must look like, and the prefix of each event; the
# first prefix that fits decides, so order counts.
HEADER = (
    r'^(\w+)\s+(\d{4}[/:\.\-\\]\d{2}[/:\.\-\\]\d{2}\s\d{2}:\d{2}:\d{2})'
    r'\.(\d+)\s(\w+)[^"]*"([^"]+)"'
)
EVENT_PREFIXES = [
    ("GET MIC", "GET_MIC"),
    ("RELEASE MIC", "RELEASE_MIC"),
    ("DENT MIC", "DENT_MIC"),
    ("LOSTMIC REPLACE", "LOSTMIC_REPLACE"),
    ("LOSTMIC AUTO", "LOSTMIC_AUTO"),
    ("RELOGIN", "RELOGIN"),
    ("LOGIN FAILED", "LOGIN_FAILED"),
    ("LOGIN", "LOGIN"),
    ("LOGOUT BROKEN", "BROKEN"),
    ("LOGOUT", "LOGOUT"),
    ("QUERY MEMBERS", "QUERY_MEMBERS"),
    ("QUERY GROUP", "QUERY_GROUP"),
    ("QUERY CONTACTS", "QUERY_CONTACT"),
    ("QUERY DEPARTMENT", "QUERY_DEPARTMENT"),
    ("QUERY ENTERPRISE GROUP", "QUERY_ENTERPRISE_GROUP"),
    ("QUERY USER", "QUERY_USER"),
    ("JOIN GROUP", "JOIN_GROUP"),
    ("LEAVE GROUP", "LEAVE_GROUP"),
    ("CALL", "CALL"),
    ("QUICKDIAL", "QUICK_DIAL"),
    ("CHANGE NAME", "CH_NAME"),
    ("CHANGE PWD FAULT", "CH_PWD_FAILED"),
    ("CHANGE PWD", "CH_PWD"),
    ("CONTACT MAKE", "CONTACT_REQ"),
    ("CONTACT RESPONSE", "CONTACT_REP"),
    ("CONTACT REMOVE", "CONTACT_RM"),
    ("DISPATCH", "DISPATCH"),
    ("CONFIG", "CONFIG"),
    ("TAKE MIC", "TAKE_MIC"),
    ("CREATE GROUP", "CREATE_GROUP"),
    ("DELETE GROUP", "RM_GROUP"),
    ("EMPOWER FAULT", "EMPOWER_FAILED"),
    ("EMPOWER", "EMPOWER"),
    ("DEPRIVE FAULT", "DEPRIVE_FAILED"),
    ("DEPRIVE", "DEPRIVE"),
    ("MODIFY GROUP FAULT", "CH_GROUP_NAME_FAILED"),
    ("MODIFY GROUP", "CH_GROUP_NAME"),
    ("POST WORKSHEET", "WORKSHEET_POST"),
]

# Events of each family, and the keys each column is read from.
FAMILIES = {
    "login": ["LOGIN", "RELOGIN", "LOGIN_FAILED"],
    "logout": ["BROKEN", "LOGOUT"],
    "speak": SPEAK_EVENTS,
    "group": IN_OUT_EVENTS,
    "call": ["CALL", "QUICK_DIAL"],
    "query": ["QUERY_USER", "QUERY_GROUP", "QUERY_CONTACT", "QUERY_MEMBERS",
              "QUERY_DEPARTMENT", "QUERY_ENTERPRISE_GROUP"],
    "profile": ["CH_NAME", "CH_PWD", "CH_PWD_FAILED", "CONTACT_REQ", "CONTACT_REP", "CONTACT_RM"],
    "manage": ["DISPATCH", "SW_GPS", "SW_AUDIO", "TAKE_MIC", "CREATE_GROUP", "RM_GROUP",
               "EMPOWER", "EMPOWER_FAILED", "DEPRIVE", "DEPRIVE_FAILED",
               "CH_GROUP_NAME", "CH_GROUP_NAME_FAILED"],
    "worksheet": ["WORKSHEET_POST"],
}
COLUMN_KEYS = {
    "uid": {"login": "uid account", "logout": "uid", "speak": "uid", "group": "uid",
            "call": "uid", "query": "uid", "profile": "uid", "manage": "uid", "worksheet": "uid"},
    "gid": {"speak": "gid", "group": "gid"},
    "result": {"login": "result"},
    "ctx": {"login": "context"},
    "ip": {"login": "address", "logout": "address"},
    "dev": {"login": "device"},
    "ver": {"login": "version"},
    "imsi": {"login": "imsi"},
    "ex_pt": {"login": "expect_payload"},
    "tar": {"speak": "target", "call": "targets", "query": "gids", "worksheet": "target",
            "CH_PWD": "oldpwd", "CH_PWD_FAILED": "oldpwd", "CONTACT_REQ": "target",
            "CONTACT_REP": "accept", "CONTACT_RM": "target",
            "DISPATCH": "target", "SW_GPS": "target", "SW_AUDIO": "target", "TAKE_MIC": "target",
            "CREATE_GROUP": "gid", "RM_GROUP": "gid", "EMPOWER": "target",
            "EMPOWER_FAILED": "target", "DEPRIVE": "target", "DEPRIVE_FAILED": "target",
            "CH_GROUP_NAME": "gid", "CH_GROUP_NAME_FAILED": "gid"},
    "tar_got": {"call": "called", "CH_NAME": "name", "CH_PWD": "newpwd",
                "CONTACT_REQ": "requested", "CONTACT_REP": "paired",
                "DISPATCH": "dispatched", "SW_GPS": "dispatched", "SW_AUDIO": "dispatched",
                "TAKE_MIC": "dispatched", "RM_GROUP": "deleted", "EMPOWER": "added",
                "DEPRIVE": "remove"},
    "tar_dent": {"CH_PWD_FAILED": "newpwd", "CONTACT_REP": "refuse"},
    "count": {"query": "count gcount", "worksheet": "msgcount"},
    "sw": {"SW_GPS": "location", "SW_AUDIO": "audio"},
    "val": {"DISPATCH": "gid", "SW_GPS": "period", "CREATE_GROUP": "name", "EMPOWER": "gid",
            "EMPOWER_FAILED": "gid", "DEPRIVE": "gid", "DEPRIVE_FAILED": "gid",
            "CH_GROUP_NAME": "name", "CH_GROUP_NAME_FAILED": "name"},
}
PASSWORD_EVENTS = ["CH_PWD", "CH_PWD_FAILED"]

_MARK = "\u0001"


def _once(rows: DataFrame, **values: Column) -> DataFrame:
    """Add columns computed once per row.

    Filters on a plain projected column are pushed below it by copying its
    expression, so a regex would run once per use; they stay above a generator.
    """
    row = F.struct(*[v.alias(n) for n, v in values.items()])
    return rows.select("*", F.inline(F.array(row)).alias(*values))


def parse_header(raw: DataFrame) -> DataFrame:
    """Split lines into svc, day_time, frac, level, content; others are dropped."""
    marked = F.regexp_replace(
        "line", "(?s)" + HEADER + ".*", _MARK.join(["$1", "$2", "$3", "$4", "$5"])
    )
    parts = F.when(F.col("line").rlike(HEADER), F.split(marked, _MARK, 5))
    names = ["svc", "day_time", "frac", "level", "content"]
    return (
        _once(raw, _p=parts).where(F.col("_p").isNotNull())
        .select("seq", *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])
    )


def header_ms(day_time: Column, frac: Column, true_fraction: bool = False) -> Column:
    """Epoch ms of a line's date, time and fraction digits; null if not a date.

    Fields out of range roll over (month 13 is next January). The fraction is
    taken as digits/100 modulo 1000, which is right for five digits only;
    `true_fraction` reads it as a decimal fraction of any length.
    """
    ok = day_time.rlike(r"^\d{4}([/-])\d{2}\1\d{2} ")

    def num(start: int, length: int) -> Column:
        return F.substring(day_time, start, length).try_cast("int")

    month = F.add_months(F.make_date(num(1, 4), F.lit(1), F.lit(1)), num(6, 2) - 1)
    days = epoch_days(month) + num(9, 2) - 1
    seconds = days * 86400 + num(12, 2) * 3600 + num(15, 2) * 60 + num(18, 2)
    if true_fraction:
        millis = F.rpad(F.substring(frac, 1, 3), 3, "0").try_cast("bigint")
    else:
        millis = F.pmod((floor_to(frac.try_cast("bigint"), 100) / 100).cast("bigint"), F.lit(1000))
    return F.when(ok, seconds * 1000 + millis)


def parse_datetime(header: DataFrame, true_fraction: bool = False) -> DataFrame:
    """Add ts_ms and dt; rows whose date does not parse are dropped."""
    ms = header_ms(F.col("day_time"), F.col("frac"), true_fraction)
    return (
        _once(header, ts_ms=ms).where(F.col("ts_ms").isNotNull())
        .withColumn("dt", format_dt("ts_ms"))
    )


def event_of(content: Column) -> Column:
    """Event of an INFO line's content; null if no prefix fits."""
    config = F.when(content.contains("audio"), "SW_AUDIO").when(content.contains("location"), "SW_GPS")
    event = None
    for prefix, name in EVENT_PREFIXES:
        value = config if name == "CONFIG" else F.lit(name)
        fits = content.startswith(prefix)
        event = F.when(fits, value) if event is None else event.when(fits, value)
    return event


def classify_event(header: DataFrame) -> DataFrame:
    """Add event; INFO lines without one are dropped, other levels kept with null."""
    info = F.col("level") == "INFO"
    return _once(header, event=F.when(info, event_of(F.col("content")))).where(
        ~info | F.col("event").isNotNull()
    )


def _event_keys() -> tuple[Column, dict[str, int]]:
    """Literal map from event to the keys its columns are read from, and the slots.

    One key per column of COLUMN_KEYS, in order, then the second choices
    (`column?`). A lookup keeps the generated code small enough to be compiled, which a CASE
    per column and event does not.
    """
    columns, second = list(COLUMN_KEYS), []
    table: dict[str, dict[str, str]] = {}
    for column, families in COLUMN_KEYS.items():
        for family, keys in families.items():
            for event in FAMILIES.get(family, [family]):
                first, *other = keys.split()
                table.setdefault(event, {})[column] = first
                for key in other:
                    table[event][column + "?"] = key
                    if column + "?" not in second:
                        second.append(column + "?")
    slots = columns + second

    def quoted(keys: dict[str, str]) -> str:
        return ", ".join(f"'{keys[s]}'" if s in keys else "CAST(NULL AS STRING)" for s in slots)

    cells = ", ".join(f"'{event}', array({quoted(keys)})" for event, keys in table.items())
    return F.expr(f"map({cells})"), {slot: i for i, slot in enumerate(slots)}


def extract_fields(classified: DataFrame, mask_passwords: bool = True) -> DataFrame:
    """Read every event's columns from its pairs; rows missing a required one are dropped."""
    known = F.col("event").isNotNull()
    keys, values = kv_arrays(F.col("content"))
    key_table, slots = _event_keys()

    def read(key: Column) -> Column:
        return kv_get(F.col("_k"), F.col("_v"), key)

    def column(name: str) -> Column:
        value = read(F.get("_n", F.lit(slots[name])))
        if name + "?" in slots:
            value = F.coalesce(value, read(F.get("_n", F.lit(slots[name + "?"]))))
        return value

    dev_id = F.when(
        F.col("event").isin(FAMILIES["login"]),
        F.coalesce(*[F.concat(F.lit(k + "-"), read(F.lit(k))) for k in ("meid", "esn")]),
    )
    needs_gid = F.col("event").isin(SPEAK_EVENTS + IN_OUT_EVENTS)
    pairs = _once(
        classified, _k=F.when(known, keys), _v=F.when(known, values),
        _n=F.try_element_at(key_table, F.col("event")),
    )
    # In three steps: one step for all columns makes a method too long to be compiled.
    ids = _once(pairs, dev_id=dev_id, **{n: column(n) for n in ("uid", "gid", "result")}).where(
        ~known | (F.col("uid").isNotNull() & (~needs_gid | F.col("gid").isNotNull()))
    )
    client = _once(ids, **{n: column(n) for n in ("ctx", "ip", "dev", "ver", "imsi", "ex_pt")})
    fields = _once(client, **{n: column(n) for n in ("tar", "tar_got", "tar_dent", "count", "sw", "val")})
    if mask_passwords:
        secret = F.col("event").isin(PASSWORD_EVENTS)
        fields = fields.withColumns({
            n: F.when(secret, F.sha2(n, 256)).otherwise(F.col(n)) for n in ("tar", "tar_got", "tar_dent")
        })
    return fields.select("seq", *LOG_COLUMNS, "ts_ms")


def parse_logs(raw: DataFrame, mask_passwords: bool = True, true_fraction: bool = False) -> DataFrame:
    """(seq, line) to the `log` table; no shuffle, no Python on rows.

    Old and new passwords of CH_PWD and CH_PWD_FAILED are hashed unless
    `mask_passwords` is off.
    """
    return extract_fields(
        classify_event(parse_datetime(parse_header(raw), true_fraction)), mask_passwords
    )
