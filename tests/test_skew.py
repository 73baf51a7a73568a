"""Splitting big keys must not change any result.

The cell width is set so low that every key is split into many cells, and the
broadcast limit so low that lookups take the split-join way.
"""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.operators import enrich, groups, loads, online, speaking, windows
from talkgauge.operators.lookup import lookup_join
from talkgauge.operators.scan import CELL, running, with_cells

CELLS = 7


@pytest.fixture(scope="module")
def rows(tables):
    """Actions of one user put on a third of all rows, so that one key is hot."""
    hot = F.when(F.col("seq") % 3 == 0, "1003").otherwise(F.col("uid"))
    return tables.action.withColumn("uid", hot).withColumn(
        "gid", F.when((F.col("seq") % 3 == 0) & F.col("gid").isNotNull(), "1879048192").otherwise(F.col("gid"))
    )


@pytest.fixture(scope="module")
def group_event(rows, tables):
    from talkgauge.plans.staging import stage

    return stage(enrich.group_events(rows, tables.group_org), "skewed_group_event")


def test_cells_are_bounded(rows):
    cells = with_cells(rows, ["uid"], "seq", CELLS)
    assert cells.where(F.col(CELL).isNotNull()).count() > 0
    assert cells.where(F.col(CELL).isNotNull()).groupBy("uid", CELL).count().agg(F.max("count")).first()[0] <= CELLS


@pytest.mark.parametrize("inclusive", [False, True])
def test_running_equals_plain_window(rows, inclusive):
    def run(width):
        return rows_of(running(
            with_cells(rows.select("seq", "uid", "ts_ms"), ["uid"], "seq", width), ["uid"], "seq",
            maxes={"a": F.struct("ts_ms", "seq")}, mins={"b": F.col("ts_ms")},
            sums={"c": F.when(F.col("seq") % 2 == 0, 1)}, inclusive=inclusive,
        ).drop(CELL))

    assert run(CELLS) == run(10**9)


@pytest.mark.parametrize("first_event", ["reference", "corrected"])
def test_online(rows, first_event):
    assert rows_of(online.online_events(rows, first_event, CELLS)) == rows_of(
        online.online_events(rows, first_event)
    )
    assert rows_of(online.user_sessions(rows, first_event, CELLS)) == rows_of(
        online.user_sessions(rows, first_event)
    )


@pytest.mark.parametrize("literal", [False, True])
def test_speaking(group_event, literal):
    split = rows_of(speaking.speaking_records(group_event, literal, CELLS))
    assert split and split == rows_of(speaking.speaking_records(group_event, literal))


def test_groups(group_event):
    def run(width):
        accepted = groups.accepted_in_out(group_event, width)
        members = groups.membership(accepted, width)
        from talkgauge.plans.staging import stage

        lives = stage(groups.group_lives(stage(members, "members")), "lives")
        return (
            rows_of(members.drop(CELL)), rows_of(lives),
            rows_of(groups.group_load_second(group_event, lives, width)),
        )

    assert run(CELLS) == run(10**9)


def test_late_loads(rows):
    events = online.online_events(rows)
    assert rows_of(loads.user_changes(events, "svc", "drop", CELLS)) == rows_of(
        loads.user_changes(events, "svc", "drop")
    )
    assert rows_of(windows.drop_stale(rows, "uid", CELLS)) == rows_of(windows.drop_stale(rows, "uid"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [20, 10**9])
def test_lookup_beyond_broadcast(rows, tables, how, hot_rows):
    left = rows.select("seq", "uid")
    split = lookup_join(left, tables.user_org, "uid", how, broadcast_rows=0, hot_rows=hot_rows)
    assert rows_of(split) == rows_of(left.join(tables.user_org, "uid", how))


def test_lookup_beyond_bytes(rows, tables):
    left = rows.select("seq", "uid")
    split = lookup_join(left, tables.user_org, "uid", broadcast_bytes=0, hot_rows=20)
    assert rows_of(split) == rows_of(left.join(tables.user_org, "uid"))


def test_sets_as_of_a_time(spark):
    """A row dated far ahead expires temporary groups by default, and not as of a time given."""
    from talkgauge.schemas import GROUP_TEMP

    at = 1_704_067_200_000
    members = spark.createDataFrame(
        [(1, at, "s", "JOIN_GROUP", "u1", GROUP_TEMP, "c", "g1", 0), (2, at + 10**10, "s", "JOIN_GROUP", "u2", GROUP_TEMP, "c", "g2", 0)],
        "seq long, ts_ms long, svc string, event string, uid string, gtype string, gcompany string, gfull string, episode long")
    assert {r["gfull"] for r in groups.group_members(members).collect()} == {"g2"}
    assert {r["gfull"] for r in groups.group_members(members, as_of=at + 1000).collect()} == {"g1", "g2"}


def test_holding_over_days(spark):
    """The end of a hold is found in the key's next day with rows, however far that is."""
    from talkgauge.operators.scan import hold_deltas
    from talkgauge.schemas import DAY_MS

    rows = [("a", 5, True), ("a", 3 * DAY_MS + 1, False), ("a", 3 * DAY_MS + 9, True), ("b", 7, True), ("b", 8, True)]
    ops = spark.createDataFrame(rows, "k string, at long, holds boolean")
    got = {(r["k"], r["at"], r["delta"]) for r in hold_deltas(ops, ["k"], "at", "holds").collect()}
    assert got == {("a", 5, 1), ("a", 3 * DAY_MS + 1, -1), ("a", 3 * DAY_MS + 9, 1), ("b", 7, 1), ("b", 8, -1), ("b", 8, 1)}


def test_late_rule_of_split_clocks(tables):
    """Clocks cut into cells and lookups that are not broadcast judge rows alike, as does the rule row by row."""
    back = F.when(F.col("seq") % 17 == 0, 7000).when(F.col("seq") % 19 == 0, 3500).otherwise(0)
    rows = tables.action.select("seq", "svc", (F.col("ts_ms") - back).alias("ts_ms"))
    want = []
    state = {}
    for row in rows.orderBy("seq").collect():
        bucket = row["ts_ms"] // 1000 * 1000
        newest, reach = state.get(row["svc"], (None, 4000))
        want.append((row["seq"], newest is not None and bucket < newest - reach))
        if newest is None or bucket > newest:
            state[row["svc"]] = bucket, 3000 if newest is not None and bucket - newest >= 5000 else 4000
    for options in ({}, {"cell_rows": CELLS, "broadcast_rows": 0}):
        late = windows.mark_late(rows, "svc", **options).orderBy("seq").collect()
        assert [(r["seq"], r["late"]) for r in late] == want
    assert any(late for _, late in want)


def test_a_dimension_that_grows_is_measured_again(spark, tmp_path):
    from talkgauge.operators.lookup import size_of

    path = str(tmp_path / "dim")
    sizes = []
    for n in (10, 1000):
        spark.range(n).selectExpr("cast(id AS string) AS uid", "'c' AS company").write.mode("overwrite").parquet(path)
        sizes.append(size_of(spark.read.parquet(path))[0])
    assert sizes == [10, 1000]
