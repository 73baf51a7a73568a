"""Plans: what is shuffled, what is read, and where code is generated."""

import contextlib
import io
import re

from conftest import SF_DIR
from pyspark.sql import functions as F

from talkgauge.operators import enrich, loads, online, parse, windows
from talkgauge.plans.staging import stage
from talkgauge.sources.events import read_events


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def count(text, node):
    return len(re.findall(rf"^\(\d+\) {node}\b", text, re.M))


def test_parsing_is_one_generated_stage_without_shuffle(spark, tables):
    raw = stage(tables.raw, "raw")
    text = plan(parse.parse_logs(raw))
    assert count(text, "Exchange") == 0 and "Python" not in text
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        parse.parse_logs(raw).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    # methods above 8,000 bytes are not compiled to machine code
    assert len(sizes) == 1 and sizes[0] < 8000


def test_actions_are_joined_without_shuffling_the_log(spark, tables):
    raw = stage(tables.raw, "raw")
    text = plan(enrich.user_actions(parse.parse_logs(raw), tables.user_org))
    assert count(text, "Exchange") == 0 and count(text, "BroadcastHashJoin") == 1


def test_only_needed_columns_are_read(spark, tables):
    text = plan(windows.count_per_second(tables.action, "svc"))
    assert re.findall(r"ReadSchema: struct<(.*)>", text) == ["svc:string,ts_ms:bigint"]
    text = plan(enrich.filter_speak(tables.action).select("seq"))
    assert "PushedFilters: [In(event" in text


def test_online_events_shuffle_rows_once(spark, tables):
    """One exchange carries the wide rows; the others carry counts and hot keys' carries."""
    text = plan(online.online_events(tables.action))
    wide = re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]", text)
    assert sum(int(n) > 10 for n in wide) == 1


def test_no_cross_joins_and_no_python(spark, tables):
    for df in (
        loads.user_load_second(tables.user_changes("svc")),
        loads.user_load_hour(tables.online, tables.user_changes("svc"), "svc"),
        loads.speak_load_hour(tables.group_event, tables.speak_changes("svc"), "svc"),
        loads.server_load_second(tables.server_seconds),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_events_of_one_row_group_are_spread(spark):
    """A row group lies in one split, so splits alone leave all of its lines to one task."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = read_events(spark, SF_DIR)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 4
    assert rows.exceptAll(spark.read.parquet(f"{SF_DIR}/events.parquet")).count() == 0


def test_dimensions_read_staged_users(tables):
    assert all(any("/users" in f for f in dim.inputFiles()) for dim in tables.dims)
