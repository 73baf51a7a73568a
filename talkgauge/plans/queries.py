"""One query per operator of the job, over the tables of an `events` folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgauge.functions import jsons, keys, text, times
from talkgauge.operators import enrich, groups, loads, online, parse, sinks, speaking, windows
from talkgauge.plans.staging import run_folder
from talkgauge.plans.tables import Query, Tables
from talkgauge.schemas import (
    ACTION_COLUMNS, GROUP_EVENT_COLUMNS, GROUP_NORMAL, GROUP_TEMP, LOG_COLUMNS, MINUTE_MS,
    ONLINE_EVENT_COLUMNS, SESSION_COLUMNS, SPEAK_HOUR_MEASURES, SPEAKING_COLUMNS, USER_HOUR_MEASURES,
)
from talkgauge.sources import logs

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def add(name: str, fn: Query) -> None:
    QUERIES[name] = fn


# --- sources

@query
def src_kafka_log(t: Tables) -> DataFrame:
    """Two partitions, one with a tenth of the other's records."""
    small = F.col("seq") % 11 == 0
    records = t.raw.select(
        F.encode("line", "UTF-8").alias("value"),
        F.when(small, 1).otherwise(0).alias("partition"),
        F.when(small, F.floor(F.col("seq") / 11)).otherwise(F.col("seq")).alias("offset"),
        F.timestamp_millis(F.col("seq")).alias("timestamp"),
    )
    return logs.raw_from_kafka(records)


@query
def src_log_files(t: Tables) -> DataFrame:
    """A small and a large folder of log files."""
    folder = f"{run_folder(t.spark)}/log_files"
    for name, part in (("1", F.col("seq") < 4000), ("2", F.col("seq") >= 4000)):
        t.raw.where(part).repartitionByRange("seq").sortWithinPartitions("seq").select("line").write.text(
            f"{folder}/{name}"
        )
    return logs.read_log_files(t.spark, [f"{folder}/1", f"{folder}/2"])


@query
def src_dim_org(t: Tables) -> DataFrame:
    company = t.dims[2].select(
        F.lit("company").alias("kind"), F.col("company").alias("id"),
        F.lit(None).cast("string").alias("company"), "agent",
    )
    users = t.user_org.select(F.lit("user").alias("kind"), F.col("uid").alias("id"), "company", "agent")
    grps = t.group_org.select(
        F.lit("group").alias("kind"), F.col("gid").alias("id"),
        F.col("gcompany").alias("company"), F.col("gagent").alias("agent"),
    )
    return users.unionByName(grps).unionByName(company)


# --- parsing

@query
def parse_header(t: Tables) -> DataFrame:
    return parse.parse_header(t.raw)


@query
def parse_datetime(t: Tables) -> DataFrame:
    return parse.parse_datetime(parse.parse_header(t.raw)).select("seq", "dt", "ts_ms")


def _classified(t: Tables) -> DataFrame:
    return parse.classify_event(parse.parse_datetime(parse.parse_header(t.raw)))


@query
def classify_event(t: Tables) -> DataFrame:
    return _classified(t).select("seq", "level", "event")


@query
def split_config(t: Tables) -> DataFrame:
    return _classified(t).where(F.col("event").isin("SW_AUDIO", "SW_GPS")).select("seq", "event", "content")


@query
def extract_kv(t: Tables) -> DataFrame:
    return _classified(t).where(F.col("event").isNotNull()).select(
        "seq", F.inline(text.kv_table(F.col("content"))).alias("key", "value")
    )


def _family(name: str) -> Query:
    return lambda t: t.log.where(F.col("event").isin(parse.FAMILIES[name])).drop("content")


for _name in parse.FAMILIES:
    add(f"parse_{_name}", _family(_name))


@query
def parse_logs(t: Tables) -> DataFrame:
    return t.log.select("seq", *LOG_COLUMNS, "ts_ms")


# --- filters, projections, predicates, joins

@query
def filter_not_null(t: Tables) -> DataFrame:
    return enrich.filter_not_null(t.log, "event").select("seq", "event", "uid")


@query
def filter_online(t: Tables) -> DataFrame:
    return enrich.filter_online(t.action).select("seq", "event", "uid")


@query
def filter_group(t: Tables) -> DataFrame:
    return enrich.filter_group(t.action).select("seq", "event", "gid")


@query
def filter_speak(t: Tables) -> DataFrame:
    return enrich.filter_speak(t.action).select("seq", "event", "gid")


@query
def project_action(t: Tables) -> DataFrame:
    return t.action.select("seq", *ACTION_COLUMNS)


@query
def project_group(t: Tables) -> DataFrame:
    return t.group_event.select("seq", *GROUP_EVENT_COLUMNS)


@query
def group_type(t: Tables) -> DataFrame:
    return enrich.with_group_type(enrich.filter_group(t.action)).select("seq", "gid", "gtype")


@query
def group_full_id(t: Tables) -> DataFrame:
    return enrich.with_group_type(enrich.filter_group(t.action)).select(
        "seq", enrich.group_full_id().alias("gfull")
    )


@query
def join_user_org(t: Tables) -> DataFrame:
    log = enrich.filter_not_null(t.log, "event").select("seq", "uid")
    return enrich.join_user_org(log, t.user_org).select("seq", "uid", "company", "agent")


@query
def join_group_org(t: Tables) -> DataFrame:
    rows = enrich.with_group_type(enrich.filter_group(t.action))
    return enrich.join_group_org(rows, t.group_org).select("seq", "gid", "gtype", "gcompany", "gagent")


@query
def session_pair(t: Tables) -> DataFrame:
    return t.sessions.select("seq", "uid", "svc", "login_ms", "logout_ms")


# --- online events and presence

def _online_kind(event: str) -> Query:
    return lambda t: t.online.where(F.col("event") == event).select(
        "seq", "svc", "dt", "uid", "company", "agent", "interval"
    )


add("online_event_uon", _online_kind("uon"))
add("online_event_uoff", _online_kind("uoff"))


def _broken(actions: str) -> Query:
    def run(t: Tables) -> DataFrame:
        source = t.action.where(F.col("event") == actions).select("seq")
        rows = t.online.where(F.col("event") == "ubro")
        return rows.join(source, "seq", "left_semi").select("seq", "svc", "dt", "uid", "interval")
    return run


add("online_event_ubro_login", _broken("LOGIN"))
add("online_event_ubro_relogin", _broken("RELOGIN"))


@query
def online_events(t: Tables) -> DataFrame:
    return t.online.select("seq", *ONLINE_EVENT_COLUMNS, "ts_ms")


@query
def online_events_corrected(t: Tables) -> DataFrame:
    return online.online_events(t.action, first_event="corrected").select(
        "seq", "event", "uid", "interval"
    )


@query
def user_session(t: Tables) -> DataFrame:
    return online.user_sessions(t.action).select("seq", *SESSION_COLUMNS)


add("last_login", lambda t: online.last_login(t.action))
add("last_logout", lambda t: online.last_logout(t.action))
add("user_state", lambda t: online.user_state(t.online))
add("online_user_set", lambda t: online.online_user_set(t.online))
add("server_user_set", lambda t: online.online_users_by(t.online, "svc"))
add("company_user_set", lambda t: online.online_users_by(t.online, "company"))
add("device_user_set", lambda t: online.device_user_set(t.online))
add("server_set", lambda t: online.server_set(t.action))
add("device_set", lambda t: online.device_set(t.action))


# --- groups

def _of_type(rows: DataFrame, gtype: str) -> DataFrame:
    return rows.where(F.col("gtype") == gtype).drop("gtype")


add("user_current_group", lambda t: groups.user_current_group(t.group_event))
add("group_member_set", lambda t: _of_type(groups.group_members(t.members), GROUP_NORMAL))
add("temp_group_member_set", lambda t: _of_type(groups.group_members(t.members), GROUP_TEMP))
add("online_group_set", lambda t: _of_type(groups.online_groups(t.members), GROUP_NORMAL))
add("online_temp_group_set", lambda t: _of_type(groups.online_groups(t.members), GROUP_TEMP))
add("group_server_set", lambda t: groups.live_groups_by(t.members, t.lives, "svc"))
add("server_group_set", lambda t: _of_type(groups.live_groups_by(t.members, t.lives, "svc"), GROUP_NORMAL))
add("server_temp_group_set", lambda t: _of_type(groups.live_groups_by(t.members, t.lives, "svc"), GROUP_TEMP))
add("company_group_set",
    lambda t: _of_type(groups.live_groups_by(t.members, t.lives, "gcompany"), GROUP_NORMAL))
add("company_temp_group_set",
    lambda t: _of_type(groups.live_groups_by(t.members, t.lives, "gcompany"), GROUP_TEMP))
add("group_load_second", lambda t: groups.group_load_second(t.group_event, t.lives))


# --- speaking

@query
def speaking_record(t: Tables) -> DataFrame:
    return speaking.speaking_records(t.group_event).select("seq", *SPEAKING_COLUMNS)


@query
def speaking_record_literal(t: Tables) -> DataFrame:
    return speaking.speaking_records(t.group_event, literal=True).select("seq", *SPEAKING_COLUMNS)


def _tagged(parts: tuple[DataFrame, DataFrame], names: tuple[str, str], columns: list[str]) -> DataFrame:
    return parts[0].select(F.lit(names[0]).alias("table"), "seq", *columns).unionByName(
        parts[1].select(F.lit(names[1]).alias("table"), "seq", *columns)
    )


@query
def speaking_split(t: Tables) -> DataFrame:
    return _tagged(
        enrich.split_by_group_type(t.speaking), ("group_speaking", "temp_group_speaking"),
        ["gid", "uid", "tvstart", "tvend"],
    )


@query
def group_event_split(t: Tables) -> DataFrame:
    return _tagged(
        enrich.split_by_group_type(t.group_event), ("group_event", "temp_group_event"),
        ["gid", "uid", "event", "dt"],
    )


# --- loads

def _user_hour(t: Tables, entity: str, late: str = "drop", **options) -> DataFrame:
    return loads.user_load_hour(t.online, t.user_changes(entity, late), entity, **options)


def _speak_hour(t: Tables, entity: str, late: str = "drop") -> DataFrame:
    return loads.speak_load_hour(t.group_event, t.speak_changes(entity, late), entity)


add("user_load_second_server", lambda t: loads.user_load_second(t.user_changes("svc")))
add("user_load_second_company", lambda t: loads.user_load_second(t.user_changes("company")))
add("user_load_second_server_late",
    lambda t: loads.user_load_second(loads.user_changes(t.online, "svc", late="drop")))
add("user_load_second_server_keep", lambda t: loads.user_load_second(t.user_changes("svc", "keep")))
add("user_load_hour_server_keep", lambda t: _user_hour(t, "svc", "keep"))
add("speak_load_second_server_keep", lambda t: loads.speak_load_second(t.speak_changes("svc", "keep")))
add("speak_load_hour_server_keep", lambda t: _speak_hour(t, "svc", "keep"))
add("user_load_hour_server", lambda t: _user_hour(t, "svc"))
add("user_load_hour_company", lambda t: _user_hour(t, "company"))
add("user_load_hour_merge", lambda t: loads.closed_hours(_user_hour(t, "svc")))
add("user_load_hour_server_1h", lambda t: _user_hour(t, "svc", distinct_hours=1))
add("speak_load_second_server", lambda t: loads.speak_load_second(t.speak_changes("svc")))
add("speak_load_second_company", lambda t: loads.speak_load_second(t.speak_changes("gcompany")))
add("speak_load_second_server_uncapped",
    lambda t: loads.speak_load_second(loads.speak_changes(t.group_event, "svc", mic_cap=False)))
add("speak_load_hour_server", lambda t: _speak_hour(t, "svc"))
add("speak_load_hour_company", lambda t: _speak_hour(t, "gcompany"))
add("speak_load_hour_merge", lambda t: loads.closed_hours(_speak_hour(t, "svc")))
add("merge_reports", lambda t: loads.merge_reports(t.server_seconds))


@query
def server_load_second(t: Tables) -> DataFrame:
    return loads.server_load_second(t.server_seconds).select(
        "server", "bucket", "userLoad.*", "groupLoad.*", "speakLoad.*"
    )


# --- windows

add("win_second", lambda t: windows.count_per_second(t.action, "svc"))


@query
def win_late(t: Tables) -> DataFrame:
    return windows.mark_late(t.action.select("seq", "svc", "ts_ms"), "svc").select(
        "seq", "svc", "bucket", F.col("late").cast("int").alias("late")
    )


def _counts(t: Tables) -> DataFrame:
    return windows.count_per_second(t.online, "svc")


@query
def win_gap_fill(t: Tables) -> DataFrame:
    counts = _counts(t)
    return windows.dense_seconds(counts.withColumn("seen", F.lit(1)), "svc", {}, ["n"])


@query
def win_skip(t: Tables) -> DataFrame:
    spans = windows.skipped_spans(t.online.select("seq", "svc", "ts_ms"), "svc")
    changes = t.user_changes("svc").withColumnRenamed("entity", "svc")
    return windows.skipped_gauges(spans, changes, "svc", "onlines", "delta")


@query
def win_trailing_hour(t: Tables) -> DataFrame:
    counts = _counts(t)
    minutes = windows.per_minute_mark(counts, "svc", ["n"])
    dense = windows.fill(windows.minute_grid(counts, "svc"), minutes, "svc", ["n"])
    return windows.trailing_hour(dense, "svc", ["n"])


@query
def distinct_ttl(t: Tables) -> DataFrame:
    members = t.online.select(
        "svc", "seq", F.col("uid").alias("member"), times.second_bucket("ts_ms").alias("bucket"),
        F.lit("users").alias("kind"), F.lit(False).alias("forever"),
    )
    grid = windows.minute_grid(members, "svc")
    return windows.distinct_members(members, "svc", grid, ["users"], 10 * MINUTE_MS)


@query
def stale_drop(t: Tables) -> DataFrame:
    return windows.drop_stale(t.action.select("seq", "uid", "ts_ms"), "uid").select("seq", "uid", "ts_ms")


# --- sinks

def _hex_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row_key", F.lower(F.hex("row_key")))


def _table(table: str, rows) -> Query:
    return lambda t: _hex_key(sinks.table_view(rows(t), table))


add("sink_user_action", _table("user_action", lambda t: t.action))
add("sink_user_session", _table("user_session", lambda t: t.sessions))
add("sink_group_event", _table("group_event", lambda t: enrich.split_by_group_type(t.group_event)[0]))
add("sink_temp_group_event", _table("temp_group_event", lambda t: enrich.split_by_group_type(t.group_event)[1]))
add("sink_group_speaking", _table("group_speaking", lambda t: enrich.split_by_group_type(t.speaking)[0]))
add("sink_temp_group_speaking",
    _table("temp_group_speaking", lambda t: enrich.split_by_group_type(t.speaking)[1]))
add("sink_company_user_load",
    lambda t: _hex_key(sinks.hour_report(_user_hour(t, "company"), USER_HOUR_MEASURES)))
add("sink_company_speak_load",
    lambda t: _hex_key(sinks.hour_report(_speak_hour(t, "gcompany"), SPEAK_HOUR_MEASURES)))
add("sink_server_user_load", lambda t: _hex_key(
    sinks.hour_report(loads.closed_hours(_user_hour(t, "svc")), USER_HOUR_MEASURES)))
add("sink_server_speak_load", lambda t: _hex_key(
    sinks.hour_report(loads.closed_hours(_speak_hour(t, "svc")), SPEAK_HOUR_MEASURES)))
add("sink_appload", lambda t: sinks.appload(loads.server_load_second(t.server_seconds)))


@query
def sink_state_tables(t: Tables) -> DataFrame:
    state = online.user_state(t.online)
    return sinks.state_values({
        "state": state.select("uid", "state"), "server": state.select("uid", "server"),
        "dev": state.select("uid", "dev"), "group": groups.user_current_group(t.group_event),
        "last-login": online.last_login(t.action), "last-logout": online.last_logout(t.action),
    })


@query
def sink_state_sets(t: Tables) -> DataFrame:
    members, live = groups.group_members(t.members), groups.online_groups(t.members)
    by_server = groups.live_groups_by(t.members, t.lives, "svc")
    by_company = groups.live_groups_by(t.members, t.lives, "gcompany")
    sets = {
        "online-user": online.online_user_set(t.online),
        "server-set": online.server_set(t.action),
        "dev-set": online.device_set(t.action),
        "server:<svc>:user": online.online_users_by(t.online, "svc"),
        "company:<company>:user": online.online_users_by(t.online, "company"),
        "dev:<dev>:user": online.device_user_set(t.online),
    }
    for gtype, kind in ((GROUP_NORMAL, "group"), (GROUP_TEMP, "tgroup")):
        servers = _of_type(by_server, gtype)
        sets |= {
            "group-set" if kind == "group" else "tempgroup-set": _of_type(live, gtype),
            f"{kind}:<gfull>:user": _of_type(members, gtype),
            f"{kind}:<gfull>:server": servers,
            f"server:<svc>:{kind}": servers,
            f"company:<gcompany>:{kind}": _of_type(by_company, gtype),
        }
    return sinks.state_sets(sets)


# --- scalar functions

add("second_bucket", lambda t: t.action.select("seq", times.second_bucket("ts_ms").alias("bucket")))
add("minute_bucket", lambda t: t.action.select("seq", times.minute_bucket("ts_ms").alias("bucket")))
add("format_dt", lambda t: t.action.select("seq", times.format_dt("ts_ms").alias("dt")))
add("parse_dt", lambda t: t.action.select("seq", times.parse_dt("dt").alias("ts_ms")))
add("interval_seconds", lambda t: t.sessions.select(
    "seq", times.interval_seconds("login_ms", "logout_ms").alias("seconds")))
add("bytes_hash", lambda t: t.action.select("seq", *[
    F.lower(F.hex(keys.bytes_hash(c))).alias(f"{c}_hash") for c in ("uid", "company", "event", "agent")]))
add("row_key", lambda t: t.action.select(
    "seq", F.lower(F.hex(sinks.table_key("user_action"))).alias("row_key")))
add("json_out", lambda t: t.action.select("seq", jsons.action_json().alias("json")))


@query
def json_in(t: Tables) -> DataFrame:
    read = jsons.json_in(F.col("last_login"), jsons.ACTION_JSON_SCHEMA)
    return online.last_login(t.action).select("uid", read.alias("r")).select(
        "uid", "r.server", "r.datetime", "r.device", "r.devid", "r.agent"
    )
