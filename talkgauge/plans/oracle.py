"""DuckDB SQL giving the results of `queries`, built from shared subqueries.

Written over whole keys with plain windows and range joins, so that it shares
no method with the transforms it checks. Only the input lines and the lists of
fixed values are common to both.
"""

from __future__ import annotations

import re

from talkgauge.operators.parse import COLUMN_KEYS, EVENT_PREFIXES, FAMILIES, HEADER
from talkgauge.operators.sinks import ROW_KEYS, TABLE_COLUMNS
from talkgauge.schemas import (
    ACTION_COLUMNS, ACTION_JSON_FIELDS, CLIENT_COLUMNS, GROUP_EVENT_COLUMNS, GROUP_SECOND_MEASURES,
    LOG_COLUMNS, ONLINE_EVENT_COLUMNS, SESSION_COLUMNS, SPEAK_HOUR_MEASURES, SPEAK_SECOND_MEASURES,
    SPEAKING_COLUMNS, USER_HOUR_MEASURES, USER_SECOND_MEASURES,
)
from talkgauge.sources.events import GID_SQL, line_sql

_CTE: dict[str, str] = {}
_FINAL: dict[str, str] = {}

ONLINE = "('LOGIN', 'RELOGIN', 'BROKEN', 'LOGOUT')"
SPEAK = "('GET_MIC', 'RELEASE_MIC', 'DENT_MIC', 'LOSTMIC_AUTO', 'LOSTMIC_REPLACE')"
GROUP = SPEAK[:-1] + ", 'JOIN_GROUP', 'LEAVE_GROUP')"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _q(column: str) -> str:
    return f'"{column}"'


def _cols(columns: list[str]) -> str:
    return ", ".join(_q(c) for c in columns)


def _text_of(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S.%g')"


# --- input lines and dimensions

_CTE["ev"] = f"""SELECT event_id, user_id, event_type, {GID_SQL} AS gid,
  1704067200000 + (epoch_us(ts) - 1704067200000000) // 300000
  - CASE WHEN event_id % 97 = 0 THEN 9000 WHEN event_id % 50 = 7 THEN 3000 ELSE 0 END AS ms
FROM events"""
_CTE["ev_text"] = f"""SELECT *, substr(t, 1, 10) AS day, substr(t, 12, 8) AS clock, substr(t, 21, 3) AS frac
FROM (SELECT *, {_text_of('ms')} AS t FROM ev)"""
_CTE["raw"] = "\nUNION ALL\n".join(
    f"SELECT seq, line FROM (SELECT event_id * 4 + {i} AS seq, {sql} AS line FROM ev_text) WHERE line IS NOT NULL"
    for i, sql in enumerate(line_sql("//").values())
)
_CTE["dim_user"] = """SELECT DISTINCT CAST(1000 + user_id AS VARCHAR) AS uid,
  CASE WHEN user_id % 17 = 15 THEN '' ELSE 'c' || user_id % 5 END AS company
FROM events WHERE user_id % 17 <> 16"""
_CTE["dim_group"] = """SELECT DISTINCT CAST(100 + user_id % 8 AS VARCHAR) AS gid,
  'c' || (100 + user_id % 8) % 5 AS company FROM events WHERE user_id % 8 <> 7"""
_CTE["dim_company"] = """SELECT DISTINCT 'c' || user_id % 5 AS company, 'a' || user_id % 5 % 3 AS agent
FROM events WHERE user_id % 5 <> 4"""

# --- parsing

_CTE["header"] = f"""SELECT seq, p.svc, p.day_time, p.frac, p.level, p.content FROM (
  SELECT seq, regexp_extract(line, '{HEADER}', ['svc', 'day_time', 'frac', 'level', 'content']) AS p
  FROM raw WHERE regexp_matches(line, '{HEADER}'))"""
_CTE["dated"] = f"""SELECT *, {_text_of('ts_ms')} AS dt FROM (
  SELECT *, epoch_ms(strptime(replace(day_time, '/', '-'), '%Y-%m-%d %H:%M:%S'))
    + (CAST(frac AS BIGINT) // 100) % 1000 AS ts_ms
  FROM header WHERE regexp_matches(day_time, '^[0-9]{{4}}(-[0-9]{{2}}-|/[0-9]{{2}}/)[0-9]{{2}} '))"""
_PREFIX_CASE = " ".join(
    f"WHEN starts_with(content, '{p}') THEN "
    + ("CASE WHEN content LIKE '%audio%' THEN 'SW_AUDIO' WHEN content LIKE '%location%' THEN 'SW_GPS' END"
       if e == "CONFIG" else f"'{e}'")
    for p, e in EVENT_PREFIXES
)
_CTE["classified"] = f"""SELECT * FROM (
  SELECT *, CASE WHEN level = 'INFO' THEN CASE {_PREFIX_CASE} END END AS event FROM dated)
WHERE level <> 'INFO' OR event IS NOT NULL"""
_PAIR = r"(\w+)=\(([^\)]*)\)"
_CTE["paired"] = f"""SELECT *, list_reverse(regexp_extract_all(content, '{_PAIR}', 1)) AS k,
  list_reverse(regexp_extract_all(content, '{_PAIR}', 2)) AS v FROM classified"""


def _kv(key: str) -> str:
    return f"v[list_position(k, '{key}')]"


def _field(column: str) -> str:
    whens = []
    for family, keys in COLUMN_KEYS[column].items():
        events = ", ".join(f"'{e}'" for e in FAMILIES.get(family, [family]))
        value = "coalesce(" + ", ".join(_kv(k) for k in keys.split()) + ")"
        if column in ("tar", "tar_got", "tar_dent") and family.startswith("CH_PWD"):
            value = f"sha256({value})"
        whens.append(f"WHEN event IN ({events}) THEN {value}")
    return "CASE " + " ".join(whens) + f" END AS {_q(column)}"


_CTE["log"] = f"""SELECT seq, {_cols(LOG_COLUMNS)}, ts_ms FROM (
  SELECT seq, svc, dt, level, content, event, ts_ms, {', '.join(_field(c) for c in COLUMN_KEYS)},
    CASE WHEN event IN ('LOGIN', 'RELOGIN', 'LOGIN_FAILED') THEN
      coalesce('meid-' || {_kv('meid')}, 'esn-' || {_kv('esn')}) END AS dev_id
  FROM paired)
WHERE event IS NULL OR (uid IS NOT NULL AND (event NOT IN {GROUP} OR gid IS NOT NULL))"""

# --- actions and group events

_CTE["action"] = f"""SELECT seq, {_cols(ACTION_COLUMNS)}, ts_ms FROM (
  SELECT l.*, u.company, c.agent FROM log l JOIN dim_user u ON l.uid = u.uid AND u.company <> ''
  LEFT JOIN dim_company c ON c.company = u.company WHERE l.event IS NOT NULL)"""
_CTE["typed"] = f"""SELECT *, CASE WHEN gtype = 'gtemp' THEN svc || ':' || gid ELSE gid END AS gfull FROM (
  SELECT *, CASE WHEN TRY_CAST(gid AS BIGINT) >= 1879048192 THEN 'gtemp'
    WHEN TRY_CAST(gid AS BIGINT) IS NOT NULL THEN 'gnormal' END AS gtype
  FROM action WHERE event IN {GROUP}) WHERE gtype IS NOT NULL"""
_CTE["group_event"] = """SELECT * FROM (
  SELECT t.*, CASE WHEN gtype = 'gtemp' THEN t.company ELSE g.company END AS gcompany,
    CASE WHEN gtype = 'gtemp' THEN t.agent ELSE c.agent END AS gagent
  FROM typed t LEFT JOIN dim_group g ON t.gid = g.gid LEFT JOIN dim_company c ON c.company = g.company)
WHERE gcompany IS NOT NULL"""

# --- online machine

_LOGIN = "event IN ('LOGIN', 'RELOGIN')"
_LOGOUT = "event IN ('LOGOUT', 'BROKEN')"
_CTE["online_state"] = f"""SELECT *,
  max({{'ts': ts_ms, 'seq': seq}}) FILTER ({_LOGIN}) OVER w AS o,
  max({{'ts': ts_ms, 'seq': seq, 'event': event}}) FILTER ({_LOGOUT}) OVER w AS f
FROM action WHERE event IN {ONLINE}
WINDOW w AS (PARTITION BY uid ORDER BY seq {BEFORE})"""


def _machine(name: str, on_off: str, off_on: str) -> None:
    _CTE[name] = f"""SELECT *,
  {_LOGIN} AND fresh AND ({on_off}) AS goes_on, {_LOGOUT} AND fresh AND ({off_on}) AS goes_off
FROM (SELECT *, coalesce(o.ts <= ts_ms, true) AND coalesce(f.ts <= ts_ms, true) AS fresh,
  coalesce((ts_ms - f.ts) // 1000, 0) AS off_time, coalesce((ts_ms - o.ts) // 1000, 0) AS on_time
  FROM online_state)"""
    shared = ("seq, svc, dt, {e} AS event, uid, company, agent, {i} AS interval, "
              + _cols(CLIENT_COLUMNS) + ", ts_ms, event AS action, {p} AS pos")
    parts = [
        ("'ubro'", "off_time", "goes_on AND event = 'LOGIN' AND f.event = 'BROKEN' AND off_time < 300", 0),
        ("'uon'", "off_time", "goes_on", 1),
        ("'ubro'", "CAST(0 AS BIGINT)", "event = 'RELOGIN'", 2),
        ("'uoff'", "on_time", "goes_off", 3),
    ]
    _CTE[name + "_events"] = "\nUNION ALL\n".join(
        "SELECT " + shared.format(e=e, i=i, p=p) + f" FROM {name} WHERE {cond}" for e, i, cond, p in parts
    )


_machine("machine", "f IS NULL OR (o IS NOT NULL AND o.ts < f.ts)",
         "o IS NULL OR (f IS NOT NULL AND f.ts < o.ts)")
_machine("corrected", "o IS NULL OR (f IS NOT NULL AND o.ts < f.ts)",
         "f IS NULL OR (o IS NOT NULL AND f.ts < o.ts)")
_CTE["online"] = "SELECT * FROM machine_events"
_CTE["session"] = f"""SELECT m.seq, l.svc, m.uid, l.company, l.agent, l.dt AS login, m.dt AS logout,
  {', '.join('l.' + _q(c) for c in CLIENT_COLUMNS)}, l.ts_ms AS login_ms, m.ts_ms AS logout_ms
FROM machine m JOIN action l ON l.seq = m.o.seq AND l.svc = m.svc WHERE goes_off"""


def _action_json() -> str:
    parts = ", ".join(
        f"'\"{name}\":\"' || {_q(c)} || '\"'" for name, c in ACTION_JSON_FIELDS.items()
    )
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _newest(condition: str, name: str) -> str:
    return f"""SELECT uid, {_action_json()} AS {name} FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, seq DESC) AS rn
  FROM action WHERE {condition}) WHERE rn = 1"""


_CTE["last_login"] = _newest(_LOGIN, "last_login")
_CTE["last_logout"] = _newest(_LOGOUT, "last_logout")
_CTE["on_off"] = "SELECT * FROM online WHERE event <> 'ubro'"
_CTE["user_state"] = """SELECT uid,
  CASE WHEN arg_max(event, seq) = 'uon' THEN 'online' ELSE 'offline' END AS state,
  arg_max(svc, seq) FILTER (event = 'uon') AS server,
  arg_max(dev, seq) FILTER (event = 'uon' AND dev IS NOT NULL) AS dev
FROM on_off GROUP BY uid"""

# --- groups

_CTE["in_out"] = "SELECT * FROM group_event WHERE event IN ('JOIN_GROUP', 'LEAVE_GROUP')"
_CTE["accepted"] = f"""SELECT * FROM (SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY seq {BEFORE}) AS newest
  FROM in_out) WHERE newest IS NULL OR newest <= ts_ms"""
_CTE["member"] = f"""SELECT * EXCLUDE (gap), sum(CASE WHEN gtype = 'gtemp' AND ts_ms - gap > 3600000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY gfull ORDER BY seq) AS episode
FROM (SELECT *, max(ts_ms) OVER (PARTITION BY gfull ORDER BY seq {BEFORE}) AS gap FROM accepted)"""
_CTE["group_end"] = """SELECT gfull, max(episode) AS last_episode FROM member GROUP BY gfull, gtype
HAVING gtype = 'gnormal' OR (SELECT max(ts_ms) FROM member) - max(ts_ms) <= 3600000"""
_CTE["in_group"] = """SELECT gtype, gfull, uid FROM (
  SELECT *, row_number() OVER (PARTITION BY gfull, uid ORDER BY seq DESC) AS rn FROM member)
JOIN group_end USING (gfull) WHERE rn = 1 AND event = 'JOIN_GROUP' AND episode = last_episode"""
_CTE["sized"] = """SELECT *, sum(CASE WHEN event = 'JOIN_GROUP' AND was IS DISTINCT FROM 'JOIN_GROUP' THEN 1
    WHEN event = 'LEAVE_GROUP' AND was = 'JOIN_GROUP' THEN -1 ELSE 0 END)
  OVER (PARTITION BY gfull, episode ORDER BY seq) AS size
FROM (SELECT *, lag(event) OVER (PARTITION BY gfull, episode, uid ORDER BY seq) AS was FROM member)"""
_CTE["emptied"] = "SELECT gfull, episode, seq FROM sized WHERE event = 'LEAVE_GROUP' AND size = 0"


def _places(place: str) -> str:
    return f"""SELECT gfull, gtype, episode, place, closed, min(seq) AS opened FROM (
  SELECT j.gfull, j.gtype, j.episode, j.{place} AS place, j.seq, coalesce(
    (SELECT min(e.seq) FROM emptied e WHERE e.gfull = j.gfull AND e.episode = j.episode AND e.seq > j.seq),
    (SELECT min(n.seq) FROM member n WHERE n.gfull = j.gfull AND n.episode = j.episode + 1)) AS closed
  FROM member j WHERE event = 'JOIN_GROUP') GROUP BY ALL"""


_CTE["places_svc"] = _places("svc")
_CTE["places_company"] = _places("gcompany")


def _live(places: str, name: str, where: str = "true", keep: str = "") -> str:
    return f"""SELECT DISTINCT {keep} p.place AS {name}, p.gfull FROM {places} p JOIN group_end e
  ON e.gfull = p.gfull AND e.last_episode = p.episode WHERE closed IS NULL AND {where}"""


_CTE["group_second"] = f"""SELECT c.svc, c.bucket,
  count(p.gfull) FILTER (p.gtype = 'gnormal') AS groups, count(p.gfull) FILTER (p.gtype = 'gtemp') AS temp_groups
FROM (SELECT svc, clock // 1000 * 1000 AS bucket, max(seq) AS seq FROM (
    SELECT svc, seq, max(ts_ms) OVER (PARTITION BY svc ORDER BY seq) AS clock FROM in_out) GROUP BY ALL) c
LEFT JOIN places_svc p ON p.place = c.svc AND p.opened <= c.seq AND (p.closed IS NULL OR p.closed > c.seq)
GROUP BY ALL"""

# --- speaking

_CTE["mic"] = f"""SELECT * FROM (SELECT *, max(ts_ms) OVER (PARTITION BY gfull ORDER BY seq {BEFORE}) AS newest
  FROM group_event WHERE event IN {SPEAK} AND event <> 'DENT_MIC') WHERE newest IS NULL OR newest <= ts_ms"""
_CTE["mic_lag"] = """SELECT *, lag(event) OVER w AS p_event, lag(uid) OVER w AS p_uid, lag(company) OVER w AS p_company,
  lag(agent) OVER w AS p_agent, lag(dt) OVER w AS p_dt, lag(ts_ms) OVER w AS p_ms, lag(seq) OVER w AS p_seq
FROM mic WINDOW w AS (PARTITION BY gfull ORDER BY seq)"""
_CTE["opener"] = """SELECT gfull, min(seq) AS o_seq, arg_min(svc, seq) AS o_svc, arg_min(gtype, seq) AS o_type,
  arg_min(gcompany, seq) AS o_company, arg_min({'a': gagent}, seq).a AS o_agent
FROM mic WHERE event = 'GET_MIC' GROUP BY gfull"""


def _speaking(condition: str) -> str:
    return f"""SELECT seq, o_svc AS svc, gfull AS gid, o_type AS gtype, o_company AS gcompany, o_agent AS gagent,
  p_uid AS uid, p_company AS company, p_agent AS agent, p_dt AS tvstart, dt AS tvend, event,
  p_ms AS start_ms, ts_ms AS end_ms
FROM mic_lag JOIN opener USING (gfull) WHERE {condition}"""


_CTE["speaking"] = _speaking("p_event = 'GET_MIC' AND (event = 'GET_MIC' OR p_uid = uid)")
_CTE["speaking_literal"] = _speaking("p_seq >= o_seq")

# --- loads


def _dense(name: str, source: str) -> None:
    """Every second of each entity, and its first second."""
    _CTE[name + "_grid"] = f"""SELECT entity, first, unnest(range(first, last + 1000, 1000)) AS bucket FROM (
  SELECT entity, min(bucket) - 4000 AS first, max(bucket) AS last FROM {source} GROUP BY entity)"""


def _on_time(rows: str, key: str = "entity") -> str:
    """Rows with newest, the newest bucket before, and the seconds the window reaches back."""
    return f"""SELECT *, CASE WHEN jumped = newest THEN 3000 ELSE 4000 END AS reach FROM (
  SELECT *, max(CASE WHEN bucket >= newest + 5000 THEN bucket END) OVER (PARTITION BY {key} ORDER BY seq {BEFORE}) AS jumped
  FROM (SELECT *, max(bucket) OVER (PARTITION BY {key} ORDER BY seq {BEFORE}) AS newest FROM {rows}))"""


def _user_load(name: str, entity: str, late: bool = True, hours: int = 2) -> None:
    rows = f"SELECT seq, {entity} AS entity, uid, event, ts_ms // 1000 * 1000 AS bucket FROM online"
    _CTE[name + "_all"] = rows
    _CTE[name + "_rows"] = f"SELECT * FROM ({_on_time(name + '_all')})" + (
        " WHERE newest IS NULL OR bucket >= newest - reach" if late else ""
    )
    _dense(name, name + "_rows")
    _CTE[name + "_held"] = f"""SELECT *, lead(bucket) OVER (PARTITION BY entity, uid ORDER BY bucket) AS next FROM (
  SELECT entity, uid, bucket, bool_or(event = 'uoff') AS off FROM {name}_rows
  WHERE event <> 'ubro' GROUP BY ALL)"""
    _CTE[name + "_times"] = f"""SELECT entity, bucket, count(DISTINCT uid) FILTER (event = 'uon') AS loginTimes,
  count(DISTINCT uid) FILTER (event = 'uoff') AS logoutTimes, count(DISTINCT uid) FILTER (event = 'ubro') AS brokenTimes
FROM {name}_rows GROUP BY ALL"""
    _CTE[name + "_gauge"] = f"""SELECT g.entity, g.bucket, count(*) AS onlines FROM {name}_grid g JOIN {name}_held h
  ON h.entity = g.entity AND NOT h.off AND h.bucket <= g.bucket AND (h.next IS NULL OR h.next > g.bucket) GROUP BY ALL"""
    _CTE[name + "_second"] = f"""SELECT g.entity, g.bucket, coalesce(onlines, 0) AS onlines,
  coalesce(loginTimes, 0) AS loginTimes, coalesce(logoutTimes, 0) AS logoutTimes, coalesce(brokenTimes, 0) AS brokenTimes
FROM {name}_grid g LEFT JOIN {name}_times t USING (entity, bucket) LEFT JOIN {name}_gauge o USING (entity, bucket)"""
    _CTE[name + "_sums"] = f"""SELECT * FROM (SELECT s.entity, s.bucket, first,
  {', '.join(f'CAST(sum({m}) OVER w AS BIGINT) AS {m}' for m in USER_SECOND_MEASURES)}
  FROM {name}_second s JOIN (SELECT DISTINCT entity, first FROM {name}_grid) USING (entity)
  WINDOW w AS (PARTITION BY entity ORDER BY s.bucket RANGE BETWEEN 3599000 PRECEDING AND CURRENT ROW))
WHERE bucket % 60000 = 0 AND bucket > first // 60000 * 60000"""
    ttl = hours * 3600000
    _CTE[name + "_distinct"] = f"""SELECT m.entity, m.bucket,
  {', '.join(f"count(DISTINCT uid) FILTER (event = '{e}' AND r.bucket > m.bucket - {ttl}) AS {n}"
             for e, n in (('uon', 'loginUsers'), ('uoff', 'logoutUsers'), ('ubro', 'brokenUsers')))}
FROM {name}_sums m LEFT JOIN {name}_all r ON r.entity = m.entity AND r.bucket <= m.bucket GROUP BY ALL"""
    _CTE[name + "_present"] = f"""SELECT entity, mark, count(*) FILTER (event = 'uon' OR bucket > mark - {ttl}) AS present
FROM (SELECT m.entity, m.bucket AS mark, uid, arg_max(event, {{'b': r.bucket, 's': seq}}) AS event, max(r.bucket) AS bucket
  FROM {name}_sums m JOIN {name}_all r ON r.entity = m.entity AND r.bucket <= m.bucket AND event <> 'ubro'
  GROUP BY m.entity, m.bucket, uid) GROUP BY ALL"""
    _CTE[name + "_hour"] = f"""SELECT s.entity, s.bucket, coalesce(present, 0) AS onlines, loginUsers, loginTimes,
  logoutUsers, logoutTimes, brokenUsers, brokenTimes, onlines AS totalOnlineSeconds
FROM {name}_sums s JOIN {name}_distinct USING (entity, bucket)
LEFT JOIN {name}_present p ON p.entity = s.entity AND p.mark = s.bucket"""


_user_load("us", "svc")
_user_load("uc", "company")
_user_load("uk", "svc", late=False)
_user_load("u1", "svc", hours=1)

_STEMS = {"speaking": "GET_MIC", "lostAuto": "LOSTMIC_AUTO", "lostReplace": "LOSTMIC_REPLACE", "dent": "DENT_MIC"}


def _speak_load(name: str, entity: str, cap: bool = True, late: bool = True) -> None:
    _CTE[name + "_all"] = f"""SELECT seq, {entity} AS entity, uid, gfull, event, ts_ms // 1000 * 1000 AS bucket
FROM group_event WHERE event IN {SPEAK}"""
    _CTE[name + "_rows"] = f"SELECT * FROM ({_on_time(name + '_all')})" + (
        " WHERE newest IS NULL OR bucket >= newest - reach" if late else ""
    )
    _dense(name, name + "_rows")
    _CTE[name + "_held"] = f"""SELECT *, least(lead(bucket) OVER (PARTITION BY entity, uid ORDER BY bucket),
  {'bucket + 300000' if cap else 'NULL'}) AS until
FROM (SELECT entity, uid, bucket, arg_max(event, seq) AS event FROM {name}_rows WHERE event <> 'DENT_MIC' GROUP BY ALL)"""
    _CTE[name + "_times"] = f"""SELECT entity, bucket, count(*) FILTER (event = 'GET_MIC') AS getTimes,
  count(*) FILTER (event = 'LOSTMIC_AUTO') AS lostAutoTimes, count(*) FILTER (event = 'LOSTMIC_REPLACE') AS lostReplaceTimes,
  count(*) FILTER (event = 'DENT_MIC') AS dentTimes FROM {name}_rows GROUP BY ALL"""
    _CTE[name + "_gauge"] = f"""SELECT g.entity, g.bucket, count(*) AS speakings FROM {name}_grid g JOIN {name}_held h
  ON h.entity = g.entity AND h.event = 'GET_MIC' AND h.bucket <= g.bucket AND (h.until IS NULL OR h.until > g.bucket)
GROUP BY ALL"""
    _CTE[name + "_second"] = f"""SELECT g.entity, g.bucket,
  {', '.join(f'coalesce({m}, 0) AS {m}' for m in SPEAK_SECOND_MEASURES)}
FROM {name}_grid g LEFT JOIN {name}_times t USING (entity, bucket) LEFT JOIN {name}_gauge o USING (entity, bucket)"""
    _CTE[name + "_sums"] = f"""SELECT * FROM (SELECT s.entity, s.bucket, first,
  {', '.join(f'CAST(sum({m}) OVER w AS BIGINT) AS {m}' for m in SPEAK_SECOND_MEASURES)}
  FROM {name}_second s JOIN (SELECT DISTINCT entity, first FROM {name}_grid) USING (entity)
  WINDOW w AS (PARTITION BY entity ORDER BY s.bucket RANGE BETWEEN 3599000 PRECEDING AND CURRENT ROW))
WHERE bucket % 60000 = 0 AND bucket > first // 60000 * 60000"""
    distinct = ", ".join(
        f"count(DISTINCT {c}) FILTER (event = '{e}') AS {s}{what}"
        for s, e in _STEMS.items() for c, what in (("uid", "Users"), ("gfull", "Groups"))
    )
    _CTE[name + "_distinct"] = f"""SELECT m.entity, m.bucket, {distinct} FROM {name}_sums m LEFT JOIN {name}_all r
  ON r.entity = m.entity AND r.bucket <= m.bucket AND r.bucket > m.bucket - 7200000 GROUP BY ALL"""
    _CTE[name + "_hour"] = f"""SELECT entity, bucket, {_cols(SPEAK_HOUR_MEASURES)} FROM (
  SELECT s.* RENAME (speakings AS speakingSeconds, getTimes AS speakingTimes), d.* EXCLUDE (entity, bucket)
  FROM {name}_sums s JOIN {name}_distinct d USING (entity, bucket))"""


_speak_load("ss", "svc")
_speak_load("sc", "gcompany")
_speak_load("sn", "svc", cap=False)
_speak_load("sk", "svc", late=False)


def _closed(hour: str) -> str:
    return f"SELECT * FROM {hour} h WHERE bucket < (SELECT max(bucket) FROM {hour} n WHERE n.entity = h.entity)"


_CTE["us_closed"] = _closed("us_hour")
_CTE["ss_closed"] = _closed("ss_hour")
_SERVER = [*USER_SECOND_MEASURES, *GROUP_SECOND_MEASURES, *SPEAK_SECOND_MEASURES]
_CTE["merged"] = f"""SELECT coalesce(u.entity, g.svc, s.entity) AS svc, coalesce(u.bucket, g.bucket, s.bucket) AS bucket,
  {', '.join(f'coalesce({m}, 0) AS {m}' for m in _SERVER)}
FROM us_second u FULL JOIN group_second g ON g.svc = u.entity AND g.bucket = u.bucket
FULL JOIN ss_second s ON s.entity = coalesce(u.entity, g.svc) AND s.bucket = coalesce(u.bucket, g.bucket)"""
_CTE["server_second"] = f"""SELECT g.svc AS server, g.bucket, {', '.join(f'coalesce({m}, 0) AS {m}' for m in _SERVER)}
FROM (SELECT svc, unnest(range(min(bucket) - 4000, max(bucket) + 1000, 1000)) AS bucket FROM merged GROUP BY svc) g
LEFT JOIN merged m ON m.svc = g.svc AND m.bucket = g.bucket"""

# --- windows

_CTE["counts"] = "SELECT svc AS entity, ts_ms // 1000 * 1000 AS bucket, count(*) AS n FROM online GROUP BY ALL"
_dense("counts", "counts")
_CTE["counts_dense"] = """SELECT g.entity, g.first, g.bucket, coalesce(n, 0) AS n
FROM counts_grid g LEFT JOIN counts c USING (entity, bucket)"""

# --- keys and JSON


def _hash(column: str) -> str:
    return (
        f"CASE WHEN {_q(column)} IS NULL THEN '00000000' ELSE lpad(lower(to_hex(list_reduce([5381::BIGINT] || "
        f"list_transform(string_split({_q(column)}, ''), lambda x: ord(x)::BIGINT), "
        f"lambda a, b: (a * 33 + b) & 4294967295))), 8, '0') END"
    )


def _key(table: str) -> str:
    parts = []
    for part in ROW_KEYS[table].split():
        how, column = part.split(":")
        parts.append(_hash(column) if how == "h" else f"lpad(lower(to_hex({_q(column)})), 16, '0')")
    return " || ".join(f"({p})" for p in parts)


def _view(source: str, table: str) -> str:
    return f"""SELECT row_key, {_cols(TABLE_COLUMNS[table])} FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY seq DESC) AS rn
  FROM (SELECT *, {_key(table)} AS row_key FROM {source})) WHERE rn = 1"""


def _json_numbers(measures: list[str]) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{m}\":' || {_q(m)}" for m in measures) + " || '}'"


def _report(hour: str, measures: list[str]) -> str:
    return f"SELECT {_key('load')} AS row_key, entity, bucket, {_json_numbers(measures)} AS report FROM {hour}"


# --- one final select per query

for _name in ("src_kafka_log", "src_log_files"):
    _FINAL[_name] = "SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, line FROM raw"
_FINAL["src_dim_org"] = """SELECT 'user' AS kind, uid AS id, u.company, agent FROM dim_user u LEFT JOIN dim_company c
  ON c.company = u.company WHERE u.company <> ''
UNION ALL SELECT 'group', gid, g.company, agent FROM dim_group g LEFT JOIN dim_company c ON c.company = g.company
UNION ALL SELECT 'company', company, NULL, agent FROM dim_company"""
_FINAL["parse_header"] = "SELECT seq, svc, day_time, frac, level, content FROM header"
_FINAL["parse_datetime"] = "SELECT seq, dt, ts_ms FROM dated"
_FINAL["classify_event"] = "SELECT seq, level, event FROM classified"
_FINAL["split_config"] = "SELECT seq, event, content FROM classified WHERE event IN ('SW_AUDIO', 'SW_GPS')"
_FINAL["extract_kv"] = """SELECT seq, key, arg_max(value, pos) AS value FROM (
  SELECT seq, unnest(list_reverse(k)) AS key, unnest(list_reverse(v)) AS value, unnest(range(len(k))) AS pos
  FROM paired WHERE event IS NOT NULL) GROUP BY seq, key"""
for _name, _events in FAMILIES.items():
    _FINAL[f"parse_{_name}"] = (
        f"SELECT * EXCLUDE (content) FROM log WHERE event IN ({', '.join(repr(e) for e in _events)})"
    )
_FINAL["parse_logs"] = "SELECT * FROM log"
_FINAL["filter_not_null"] = "SELECT seq, event, uid FROM log WHERE event IS NOT NULL"
_FINAL["filter_online"] = f"SELECT seq, event, uid FROM action WHERE event IN {ONLINE}"
_FINAL["filter_group"] = f"SELECT seq, event, gid FROM action WHERE event IN {GROUP}"
_FINAL["filter_speak"] = f"SELECT seq, event, gid FROM action WHERE event IN {SPEAK}"
_FINAL["project_action"] = f"SELECT seq, {_cols(ACTION_COLUMNS)} FROM action"
_FINAL["project_group"] = f"SELECT seq, {_cols(GROUP_EVENT_COLUMNS)} FROM group_event"
_FINAL["group_type"] = "SELECT seq, gid, gtype FROM typed"
_FINAL["group_full_id"] = "SELECT seq, gfull FROM typed"
_FINAL["join_user_org"] = "SELECT seq, uid, company, agent FROM action"
_FINAL["join_group_org"] = "SELECT seq, gid, gtype, gcompany, gagent FROM group_event"
_FINAL["session_pair"] = "SELECT seq, uid, svc, login_ms, logout_ms FROM session"
for _event in ("uon", "uoff"):
    _FINAL[f"online_event_{_event}"] = (
        f"SELECT seq, svc, dt, uid, company, agent, interval FROM online WHERE event = '{_event}'"
    )
for _action in ("LOGIN", "RELOGIN"):
    _FINAL[f"online_event_ubro_{_action.lower()}"] = (
        f"SELECT seq, svc, dt, uid, interval FROM online WHERE event = 'ubro' AND action = '{_action}'"
    )
_FINAL["online_events"] = f"SELECT seq, {_cols(ONLINE_EVENT_COLUMNS)}, ts_ms FROM online"
_FINAL["online_events_corrected"] = "SELECT seq, event, uid, interval FROM corrected_events"
_FINAL["user_session"] = f"SELECT seq, {_cols(SESSION_COLUMNS)} FROM session"
_FINAL["last_login"] = "SELECT * FROM last_login"
_FINAL["last_logout"] = "SELECT * FROM last_logout"
_FINAL["user_state"] = "SELECT * FROM user_state"
_FINAL["online_user_set"] = "SELECT uid FROM user_state WHERE state = 'online'"
for _entity, _name in (("svc", "server_user_set"), ("company", "company_user_set")):
    _FINAL[_name] = f"SELECT {_entity}, uid FROM on_off GROUP BY ALL HAVING arg_max(event, seq) = 'uon'"
_FINAL["device_user_set"] = "SELECT DISTINCT dev, uid FROM online WHERE event = 'uon' AND dev IS NOT NULL"
_FINAL["server_set"] = f"SELECT DISTINCT svc FROM action WHERE event IN {ONLINE}"
_FINAL["device_set"] = f"SELECT DISTINCT dev FROM action WHERE event IN {ONLINE} AND dev IS NOT NULL"
_FINAL["user_current_group"] = """SELECT uid,
  arg_max(CASE WHEN event = 'JOIN_GROUP' THEN gfull ELSE '0' END, seq) AS current_group FROM accepted GROUP BY uid"""
_FINAL["group_member_set"] = "SELECT gfull, uid FROM in_group WHERE gtype = 'gnormal'"
_FINAL["temp_group_member_set"] = "SELECT gfull, uid FROM in_group WHERE gtype = 'gtemp'"
_FINAL["online_group_set"] = "SELECT DISTINCT gfull FROM in_group WHERE gtype = 'gnormal'"
_FINAL["online_temp_group_set"] = "SELECT DISTINCT gfull FROM in_group WHERE gtype = 'gtemp'"
_FINAL["group_server_set"] = _live("places_svc", "svc", keep="p.gtype,")
_FINAL["server_group_set"] = _live("places_svc", "svc", "gtype = 'gnormal'")
_FINAL["server_temp_group_set"] = _live("places_svc", "svc", "gtype = 'gtemp'")
_FINAL["company_group_set"] = _live("places_company", "gcompany", "gtype = 'gnormal'")
_FINAL["company_temp_group_set"] = _live("places_company", "gcompany", "gtype = 'gtemp'")
_FINAL["group_load_second"] = "SELECT * FROM group_second"
_FINAL["speaking_record"] = f"SELECT seq, {_cols(SPEAKING_COLUMNS)} FROM speaking"
_FINAL["speaking_record_literal"] = f"SELECT seq, {_cols(SPEAKING_COLUMNS)} FROM speaking_literal"
_FINAL["speaking_split"] = """SELECT CASE gtype WHEN 'gtemp' THEN 'temp_group_speaking' ELSE 'group_speaking' END
  AS "table", seq, gid, uid, tvstart, tvend FROM speaking"""
_FINAL["group_event_split"] = """SELECT CASE gtype WHEN 'gtemp' THEN 'temp_group_event' ELSE 'group_event' END
  AS "table", seq, gid, uid, event, dt FROM group_event"""
_FINAL["user_load_second_server"] = "SELECT * FROM us_second"
_FINAL["user_load_second_company"] = "SELECT * FROM uc_second"
_FINAL["user_load_second_server_late"] = "SELECT * FROM us_second"
_FINAL["user_load_second_server_keep"] = "SELECT * FROM uk_second"
_FINAL["user_load_hour_server_keep"] = "SELECT * FROM uk_hour"
_FINAL["speak_load_second_server_keep"] = "SELECT * FROM sk_second"
_FINAL["speak_load_hour_server_keep"] = "SELECT * FROM sk_hour"
_FINAL["user_load_hour_server"] = "SELECT * FROM us_hour"
_FINAL["user_load_hour_company"] = "SELECT * FROM uc_hour"
_FINAL["user_load_hour_server_1h"] = "SELECT * FROM u1_hour"
_FINAL["user_load_hour_merge"] = "SELECT * FROM us_closed"
_FINAL["speak_load_second_server"] = "SELECT * FROM ss_second"
_FINAL["speak_load_second_company"] = "SELECT * FROM sc_second"
_FINAL["speak_load_second_server_uncapped"] = "SELECT * FROM sn_second"
_FINAL["speak_load_hour_server"] = "SELECT * FROM ss_hour"
_FINAL["speak_load_hour_company"] = "SELECT * FROM sc_hour"
_FINAL["speak_load_hour_merge"] = "SELECT * FROM ss_closed"
_FINAL["merge_reports"] = "SELECT * FROM merged"
_FINAL["server_load_second"] = "SELECT * FROM server_second"
_FINAL["win_second"] = "SELECT svc, ts_ms // 1000 * 1000 AS bucket, count(*) AS n FROM action GROUP BY ALL"
_FINAL["win_late"] = f"""SELECT seq, svc, bucket, CASE WHEN bucket < newest - reach THEN 1 ELSE 0 END AS late
FROM ({_on_time('(SELECT seq, svc, ts_ms // 1000 * 1000 AS bucket FROM action)', 'svc')})"""
_FINAL["win_gap_fill"] = "SELECT entity AS svc, bucket, n FROM counts_dense"
_FINAL["win_skip"] = f"""SELECT svc, s.bucket, u.onlines FROM (
  SELECT svc, unnest(range(newest + 1000, bucket - 3000, 1000)) AS bucket FROM (
    SELECT *, max(bucket) OVER (PARTITION BY svc ORDER BY seq, pos {BEFORE}) AS newest
    FROM (SELECT seq, pos, svc, ts_ms // 1000 * 1000 AS bucket FROM online)) WHERE bucket >= newest + 5000) s
JOIN us_second u ON u.entity = s.svc AND u.bucket = s.bucket"""
_FINAL["win_trailing_hour"] = """SELECT entity AS svc, bucket, n FROM (
  SELECT entity, first, bucket, CAST(sum(n) OVER (PARTITION BY entity ORDER BY bucket
    RANGE BETWEEN 3599000 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM counts_dense)
WHERE bucket % 60000 = 0 AND bucket > first // 60000 * 60000"""
_FINAL["distinct_ttl"] = """SELECT g.entity AS svc, g.bucket, count(DISTINCT uid) AS users FROM counts_grid g
LEFT JOIN us_all r ON r.entity = g.entity AND r.bucket <= g.bucket AND r.bucket > g.bucket - 600000
WHERE g.bucket % 60000 = 0 AND g.bucket > first // 60000 * 60000 GROUP BY ALL"""
_FINAL["stale_drop"] = f"""SELECT seq, uid, ts_ms FROM (
  SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY seq {BEFORE}) AS newest FROM action)
WHERE newest IS NULL OR newest <= ts_ms"""
_FINAL["sink_user_action"] = _view("action", "user_action")
_FINAL["sink_user_session"] = _view("session", "user_session")
for _table, _source in (("group_event", "group_event"), ("group_speaking", "speaking")):
    _FINAL[f"sink_{_table}"] = _view(f"(FROM {_source} WHERE gtype = 'gnormal')", _table)
    _FINAL[f"sink_temp_{_table}"] = _view(f"(FROM {_source} WHERE gtype = 'gtemp')", f"temp_{_table}")
_FINAL["sink_company_user_load"] = _report("uc_hour", USER_HOUR_MEASURES)
_FINAL["sink_company_speak_load"] = _report("sc_hour", SPEAK_HOUR_MEASURES)
_FINAL["sink_server_user_load"] = _report("us_closed", USER_HOUR_MEASURES)
_FINAL["sink_server_speak_load"] = _report("ss_closed", SPEAK_HOUR_MEASURES)
_FINAL["sink_appload"] = f"""SELECT 'appload-' || server AS key, bucket,
  '{{"server":"' || server || '","bucket":' || bucket || ',"userLoad":' || {_json_numbers(USER_SECOND_MEASURES)}
  || ',"groupLoad":' || {_json_numbers(GROUP_SECOND_MEASURES)} || ',"speakLoad":'
  || {_json_numbers(SPEAK_SECOND_MEASURES)} || '}}' AS value FROM server_second"""
_FINAL["sink_state_tables"] = "\nUNION ALL\n".join(
    f"SELECT 'user:' || uid || ':{suffix}' AS key, {value} AS value FROM {source} WHERE {value} IS NOT NULL"
    for suffix, value, source in (
        ("state", "state", "user_state"), ("server", "server", "user_state"), ("dev", "dev", "user_state"),
        ("group", "current_group", f"({_FINAL['user_current_group']})"),
        ("last-login", "last_login", "last_login"), ("last-logout", "last_logout", "last_logout"),
    )
)
_SETS = [
    ("'online-user'", "uid", "online_user_set"), ("'server-set'", "svc", "server_set"),
    ("'dev-set'", "dev", "device_set"), ("'server:' || svc || ':user'", "uid", "server_user_set"),
    ("'company:' || company || ':user'", "uid", "company_user_set"),
    ("'dev:' || dev || ':user'", "uid", "device_user_set"),
    ("'group-set'", "gfull", "online_group_set"), ("'tempgroup-set'", "gfull", "online_temp_group_set"),
    ("'group:' || gfull || ':user'", "uid", "group_member_set"),
    ("'tgroup:' || gfull || ':user'", "uid", "temp_group_member_set"),
    ("CASE gtype WHEN 'gtemp' THEN 't' ELSE '' END || 'group:' || gfull || ':server'", "svc", "group_server_set"),
    ("'server:' || svc || ':group'", "gfull", "server_group_set"),
    ("'server:' || svc || ':tgroup'", "gfull", "server_temp_group_set"),
    ("'company:' || gcompany || ':group'", "gfull", "company_group_set"),
    ("'company:' || gcompany || ':tgroup'", "gfull", "company_temp_group_set"),
]
_FINAL["sink_state_sets"] = "\nUNION ALL\n".join(
    f"SELECT {key} AS key, {member} AS member FROM ({_FINAL[name]})" for key, member, name in _SETS
)
_FINAL["second_bucket"] = "SELECT seq, ts_ms // 1000 * 1000 AS bucket FROM action"
_FINAL["minute_bucket"] = "SELECT seq, ts_ms // 60000 * 60000 AS bucket FROM action"
_FINAL["format_dt"] = "SELECT seq, dt FROM action"
_FINAL["parse_dt"] = "SELECT seq, ts_ms FROM action"
_FINAL["interval_seconds"] = "SELECT seq, (logout_ms - login_ms) // 1000 AS seconds FROM session"
_FINAL["bytes_hash"] = "SELECT seq, " + ", ".join(
    f"{_hash(c)} AS {c}_hash" for c in ("uid", "company", "event", "agent")) + " FROM action"
_FINAL["row_key"] = f"SELECT seq, {_key('user_action')} AS row_key FROM action"
_FINAL["json_out"] = f"SELECT seq, {_action_json()} AS json FROM action"
_FINAL["json_in"] = f"""SELECT uid, svc AS server, dt AS datetime, dev AS device, dev_id AS devid, agent FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts_ms DESC, seq DESC) AS rn
  FROM action WHERE {_LOGIN}) WHERE rn = 1"""


def _needed(sql: str) -> list[str]:
    """Subqueries `sql` reads, in the order they were defined."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b\w+\b", todo.pop()))
        new = [n for n in _CTE if n in words and n not in found]
        found.update(new)
        todo.extend(_CTE[n] for n in new)
    return [n for n in _CTE if n in found]


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, final in _FINAL.items():
        ctes = _needed(final)
        head = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTE[n]})" for n in ctes) + "\n" if ctes else ""
        out[name] = head + final
    return out
