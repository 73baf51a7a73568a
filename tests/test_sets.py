"""Sets kept as changes against the batch sets."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.plans import queries
from talkgauge.schemas import GROUP_NORMAL, GROUP_TEMP, TEMP_GROUP_TTL_MS
from talkgauge.streaming import jobs, processors, sets

PARTS = 3


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def follow(spark, rows, bounds, folder):
    """A table as one file per trigger, cut after each of the bounds of `seq`."""
    low = -1
    for high in bounds:
        rows.where((F.col("seq") > low) & (F.col("seq") <= high)).coalesce(1).write.mode("append").parquet(folder)
        low = high
    return jobs.read_table(spark, folder, rows.schema, files_per_trigger=1)


def run(spark, rows, folder):
    query = jobs.write_table(rows, f"{folder}/out", f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def test_sets_equal_batch_after_each_trigger(spark, tables, tmp_path):
    last = tables.action.agg(F.max("seq")).first()[0]
    bounds = [last * (k + 1) // PARTS for k in range(PARTS)]
    online = follow(spark, tables.online, bounds, str(tmp_path / "online"))
    users = run(spark, sets.stream_user_sets(online), str(tmp_path / "u"))
    accepted = run(spark, processors.stream_accepted(
        follow(spark, tables.group_event, bounds, str(tmp_path / "group_event"))), str(tmp_path / "a"))
    groups = run(spark, sets.stream_group_sets(
        follow(spark, accepted, bounds, str(tmp_path / "accepted"))), str(tmp_path / "g"))
    seen = run(spark, sets.stream_seen_sets(
        follow(spark, tables.action, bounds, str(tmp_path / "action"))), str(tmp_path / "s"))
    assert groups.where("step < 0").count() > 0 and users.where("step < 0").count() > 0
    for bound in bounds:
        upto = F.col("seq") <= bound
        part = SimpleNamespace(**{n: getattr(tables, n).where(upto) for n in ("members", "lives", "online", "action")})
        now = part.members.agg(F.max("ts_ms")).first()[0]
        got = sets.sets_of(users.unionByName(groups).where(upto), now)
        batch = queries.sink_state_sets(part).where("key IS NOT NULL")
        is_seen = F.col("key").isin("server-set", "dev-set")
        assert rows_of(got) == rows_of(batch.where(~is_seen))
    assert rows_of(seen) == rows_of(batch.where(is_seen))


def events(spark, rows):
    return spark.createDataFrame(
        [(seq, ts, 1, svc, event, uid, gtype, "c1", gfull) for seq, ts, svc, event, uid, gtype, gfull in rows],
        processors.ACCEPTED)


def test_temporary_group_expires_without_being_touched(spark, tmp_path):
    """A timer takes an idle temporary group out of all sets, a normal one and one touched in time stay."""
    t, hour = GROUP_TEMP, TEMP_GROUP_TTL_MS
    rows = events(spark, [
        (0, 1000, "s1", "JOIN_GROUP", "u1", t, "idle"), (1, 2000, "s2", "JOIN_GROUP", "u2", t, "idle"),
        (2, 1000, "s1", "JOIN_GROUP", "u3", t, "busy"), (3, 1000, "s1", "JOIN_GROUP", "u4", GROUP_NORMAL, "normal"),
        (4, hour, "s1", "JOIN_GROUP", "u5", t, "busy"),
        (5, 2000 + hour, "s1", "JOIN_GROUP", "u6", GROUP_NORMAL, "normal"),
        (6, 2001 + hour, "s1", "JOIN_GROUP", "u7", GROUP_NORMAL, "normal"),
        (7, 2002 + hour, "s1", "JOIN_GROUP", "u1", t, "busy"),
    ])
    changes = run(spark, sets.stream_group_sets(follow(spark, rows, [3, 4, 5, 6, 7], str(tmp_path / "in")), keep_ms=0),
                  str(tmp_path))
    timed = {(r["key"], r["member"]) for r in changes.where("seq IS NULL").collect()}
    assert timed == {("tgroup:idle:user", "u1"), ("tgroup:idle:user", "u2"), ("tempgroup-set", "idle"),
                     ("server:s1:tgroup", "idle"), ("server:s2:tgroup", "idle"), ("tgroup:idle:server", "s1"),
                     ("tgroup:idle:server", "s2"), ("company:c1:tgroup", "idle")}
    left = {(r["key"], r["member"]) for r in sets.sets_of(changes).collect()}
    assert not [e for e in left if "idle" in e[0] or e[1] == "idle"]
    assert {m for k, m in left if k == "tgroup:busy:user"} == {"u1", "u3", "u5"}
    assert {m for k, m in left if k == "group:normal:user"} == {"u4", "u6", "u7"}
    early = changes.where("seq < 5")
    assert ("tempgroup-set", "idle") in {(r["key"], r["member"]) for r in sets.sets_of(early, 2000 + hour).collect()}
    assert ("tempgroup-set", "idle") not in {(r["key"], r["member"]) for r in sets.sets_of(early, 2001 + hour).collect()}


def test_touch_after_expiry_starts_anew(spark, tmp_path):
    """Also where the timer has not run, the next row of an expired group forgets its members first."""
    t, hour = GROUP_TEMP, TEMP_GROUP_TTL_MS
    rows = events(spark, [(0, 1000, "s1", "JOIN_GROUP", "u1", t, "g"), (1, 1001 + hour, "s2", "JOIN_GROUP", "u2", t, "g"),
                          (2, 1002 + hour, "s2", "LEAVE_GROUP", "u2", t, "g"), (3, 1003 + hour, "s3", "JOIN_GROUP", "u3", t, "g")])
    changes = run(spark, sets.stream_group_sets(follow(spark, rows, [3], str(tmp_path / "in"))), str(tmp_path))
    for bound, members, servers in ((0, {"u1"}, {"s1"}), (1, {"u2"}, {"s2"}), (2, set(), set()), (3, {"u3"}, {"s3"})):
        got = sets.sets_of(changes.where(F.col("seq") <= bound)).collect()
        assert {r["member"] for r in got if r["key"] == "tgroup:g:user"} == members
        assert {r["member"] for r in got if r["key"] == "tgroup:g:server"} == servers
