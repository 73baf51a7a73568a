"""What is written is read back, and written twice is written once."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.operators import enrich, loads, sinks
from talkgauge.plans.tables import Tables
from talkgauge.schemas import GROUP_NORMAL, GROUP_TEMP, SPEAK_HOUR_MEASURES, USER_HOUR_MEASURES


def source(tables: Tables, table: str):
    if table == "user_action":
        return tables.action
    if table == "user_session":
        return tables.sessions
    rows = tables.group_event if table.endswith("event") else tables.speaking
    return rows.where(F.col("gtype") == (GROUP_TEMP if table.startswith("temp") else GROUP_NORMAL))


@pytest.mark.parametrize("table", sorted(sinks.TABLE_COLUMNS))
def test_history(spark, tables, tmp_path, table):
    rows, folder = source(tables, table), str(tmp_path)
    for _ in range(2):
        sinks.write_history(rows, table, folder)
    back = spark.read.parquet(f"{folder}/{table}")
    assert rows_of(back, [*sinks.TABLE_COLUMNS[table], "row_key", "seq"]) == rows_of(
        sinks.with_row_key(rows, table), [*sinks.TABLE_COLUMNS[table], "row_key", "seq"])
    view = sinks.latest_per_key(back, sinks.TABLE_COLUMNS[table])
    assert rows_of(view) == rows_of(sinks.table_view(rows, table))


def test_other_days_stay(spark, tables, tmp_path):
    day = 86_400_000
    rows = tables.action.limit(20)
    later = rows.withColumn("ts_ms", F.col("ts_ms") + 3 * day)
    for part in (rows, later, later):
        sinks.write_history(part, "user_action", str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/user_action").count() == 40


@pytest.mark.parametrize("kind", ["user", "speak"])
@pytest.mark.parametrize("entity", ["server", "company"])
def test_hour_reports(spark, tables, tmp_path, kind, entity):
    if kind == "user":
        column, measures = ("svc" if entity == "server" else "company"), USER_HOUR_MEASURES
        load = loads.user_load_hour(tables.online, tables.user_changes(column), column)
    else:
        column, measures = ("svc" if entity == "server" else "gcompany"), SPEAK_HOUR_MEASURES
        load = loads.speak_load_hour(tables.group_event, tables.speak_changes(column), column)
    for _ in range(2):
        sinks.write_hour_report(load, measures, f"{entity}_{kind}_load", str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/{entity}_{kind}_load").drop("date")
    assert rows_of(back) == rows_of(sinks.hour_report(load, measures))


def test_appload_files(spark, tables, tmp_path):
    load = loads.server_load_second(tables.server_seconds)
    for _ in range(2):
        sinks.write_appload(load, str(tmp_path / "appload"))
    back = spark.read.json(str(tmp_path / "appload")).drop("date")
    assert rows_of(back) == rows_of(sinks.appload(load))


def test_dimensions_are_read_back(spark, tables, tmp_path):
    from talkgauge.sources.org import group_org, read_dims, user_org

    for rows, name in zip(tables.dims, ("dim_user", "dim_group", "dim_company")):
        rows.write.parquet(str(tmp_path / name))
    users, groups_, companies = read_dims(spark, str(tmp_path))
    assert rows_of(user_org(users, companies)) == rows_of(tables.user_org)
    assert rows_of(group_org(groups_, companies)) == rows_of(tables.group_org)
    assert enrich.user_actions(tables.log, user_org(users, companies)).count() == tables.action.count()
