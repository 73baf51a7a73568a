"""Actions and group events: filters, projections and organisation lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.operators.lookup import lookup_join
from talkgauge.schemas import (
    ACTION_COLUMNS, GROUP_EVENT_COLUMNS, GROUP_EVENTS, GROUP_NORMAL, GROUP_TEMP,
    ONLINE_EVENTS, SPEAK_EVENTS, TEMP_GID_START,
)


def filter_not_null(rows: DataFrame, field: str) -> DataFrame:
    return rows.where(F.col(field).isNotNull())


def filter_events(rows: DataFrame, events: list[str]) -> DataFrame:
    return rows.where(F.col("event").isin(events))


def filter_online(rows: DataFrame) -> DataFrame:
    return filter_events(rows, ONLINE_EVENTS)


def filter_group(rows: DataFrame) -> DataFrame:
    return filter_events(rows, GROUP_EVENTS)


def filter_speak(rows: DataFrame) -> DataFrame:
    return filter_events(rows, SPEAK_EVENTS)


def project_action(rows: DataFrame) -> DataFrame:
    return rows.select("seq", *ACTION_COLUMNS, "ts_ms")


def project_group(rows: DataFrame) -> DataFrame:
    return rows.select("seq", *GROUP_EVENT_COLUMNS, "ts_ms", "gfull")


def join_user_org(rows: DataFrame, user_org: DataFrame, **limits) -> DataFrame:
    """Add company and agent by uid; rows of users without a company are dropped."""
    return lookup_join(rows, user_org, "uid", "inner", **limits)


def user_actions(log: DataFrame, user_org: DataFrame, **limits) -> DataFrame:
    """`log` to the 20-column `action` table (plus seq and ts_ms)."""
    return project_action(join_user_org(filter_not_null(log, "event"), user_org, **limits))


def group_type(gid: Column) -> Column:
    """Temporary or normal group by number; null if the id is not a number."""
    number = F.when(gid.rlike(r"^[+-]?\d+$"), gid.try_cast("bigint"))
    return F.when(number >= TEMP_GID_START, GROUP_TEMP).when(number.isNotNull(), GROUP_NORMAL)


def group_full_id() -> Column:
    """Temporary groups are numbered per server, normal ones globally."""
    return F.when(
        F.col("gtype") == GROUP_TEMP, F.concat("svc", F.lit(":"), "gid")
    ).otherwise(F.col("gid"))


def with_group_type(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gtype", group_type(F.col("gid"))).where(F.col("gtype").isNotNull())


def join_group_org(rows: DataFrame, group_org: DataFrame, **limits) -> DataFrame:
    """Add gcompany and gagent: by gid, or the acting user's for a temporary group."""
    temp = F.col("gtype") == GROUP_TEMP
    return (
        lookup_join(rows, group_org, "gid", "left", **limits)
        .withColumn("gcompany", F.when(temp, F.col("company")).otherwise(F.col("gcompany")))
        .withColumn("gagent", F.when(temp, F.col("agent")).otherwise(F.col("gagent")))
        .where(temp | F.col("gcompany").isNotNull())
    )


def group_events(action: DataFrame, group_org: DataFrame, **limits) -> DataFrame:
    """The seven group events of `action` with their group's organisation."""
    rows = join_group_org(with_group_type(filter_group(action)), group_org, **limits)
    return project_group(rows.withColumn("gfull", group_full_id()))


def split_by_group_type(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normal, temporary) rows, for the two tables they go to."""
    temp = F.col("gtype") == GROUP_TEMP
    return rows.where(~temp), rows.where(temp)
