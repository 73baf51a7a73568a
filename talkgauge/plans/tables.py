"""The job's tables in the order they are made, each staged once per session.

A deployment writes these tables anyway (`action` is the user_action history);
reports read them instead of parsing the log again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from talkgauge.operators import enrich, groups, loads, online, parse, speaking
from talkgauge.plans.staging import remove_folders, stage
from talkgauge.sources import events, org


class Tables:
    """Tables derived from one `events` table; attributes are made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.events = events.read_events(spark, sf_dir)
        self._changes: dict[tuple[str, str, str], DataFrame] = {}

    @cached_property
    def raw(self) -> DataFrame:
        return events.raw_lines(self.events)

    @cached_property
    def log(self) -> DataFrame:
        return parse.parse_logs(self.raw)

    @cached_property
    def dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return events.org_dims(stage(self.events.select("user_id").distinct(), "users"))

    @cached_property
    def user_org(self) -> DataFrame:
        return stage(org.user_org(self.dims[0], self.dims[2]), "user_org")

    @cached_property
    def group_org(self) -> DataFrame:
        return stage(org.group_org(self.dims[1], self.dims[2]), "group_org")

    @cached_property
    def action(self) -> DataFrame:
        return stage(enrich.user_actions(self.log, self.user_org), "action")

    @cached_property
    def machine(self) -> DataFrame:
        return stage(online.online_machine(self.action), "online_machine")

    @cached_property
    def online(self) -> DataFrame:
        return stage(online.machine_online_events(self.machine), "online_event")

    @cached_property
    def sessions(self) -> DataFrame:
        return stage(online.machine_sessions(self.machine), "user_session")

    @cached_property
    def group_event(self) -> DataFrame:
        return stage(enrich.group_events(self.action, self.group_org), "group_event")

    @cached_property
    def members(self) -> DataFrame:
        accepted = stage(groups.accepted_in_out(self.group_event), "accepted_in_out")
        return stage(groups.membership(accepted), "membership")

    @cached_property
    def lives(self) -> DataFrame:
        return stage(groups.group_lives(self.members), "group_lives")

    @cached_property
    def speaking(self) -> DataFrame:
        return stage(speaking.speaking_records(self.group_event), "speaking")

    def user_changes(self, entity: str, late: str = "drop") -> DataFrame:
        if ("user", entity, late) not in self._changes:
            self._changes["user", entity, late] = stage(
                loads.user_changes(self.online, entity, late), "user_changes"
            )
        return self._changes["user", entity, late]

    def speak_changes(self, entity: str, late: str = "drop") -> DataFrame:
        if ("speak", entity, late) not in self._changes:
            self._changes["speak", entity, late] = stage(
                loads.speak_changes(self.group_event, entity, late), "speak_changes"
            )
        return self._changes["speak", entity, late]

    @cached_property
    def server_seconds(self) -> DataFrame:
        """User, group and speak loads of servers by second."""
        group = groups.group_load_second(self.group_event, self.lives)
        return stage(
            loads.server_seconds(self.user_changes("svc"), group, self.speak_changes("svc")), "server_seconds"
        )


_OPEN: dict[tuple[str, str], Tables] = {}


def open_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of `sf_dir` in this session, so that stages are written once."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _OPEN:
        _OPEN[key] = Tables(spark, str(sf_dir))
    return _OPEN[key]


def forget_tables() -> None:
    """Remove what is staged and make later calls of `open_tables` start afresh."""
    for tables in _OPEN.values():
        remove_folders(tables.spark)
    _OPEN.clear()


Query = Callable[[Tables], DataFrame]
