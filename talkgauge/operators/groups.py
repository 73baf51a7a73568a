"""Group membership: who is in which group, and which groups are live where.

Rows older than the acting user's newest join or leave are ignored. A temporary
group's members expire an hour after its last join or leave; the next row after
that starts a new episode. Within an episode a life lasts from the first join
to the leave that empties the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgauge.functions.times import second_bucket
from talkgauge.operators.lookup import lookup_join
from talkgauge.operators.scan import CELL, CELL_ROWS, running, with_cells
from talkgauge.plans.staging import stage
from talkgauge.schemas import GROUP_NORMAL, GROUP_TEMP, IN_OUT_EVENTS, TEMP_GROUP_TTL_MS


def in_out(group_event: DataFrame) -> DataFrame:
    return group_event.where(F.col("event").isin(IN_OUT_EVENTS)).select(
        "seq", "ts_ms", "svc", "event", "uid", "gtype", "gcompany", "gfull"
    )


def accepted_in_out(group_event: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Joins and leaves that are not older than the user's newest one before them."""
    return running(
        with_cells(in_out(group_event), ["uid"], "seq", cell_rows), ["uid"], "seq",
        maxes={"newest": F.col("ts_ms")},
    ).where(F.col("newest").isNull() | (F.col("newest") <= F.col("ts_ms"))).drop(CELL, "newest")


def membership(accepted: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Accepted joins and leaves with the episode of their group (0 for normal ones).

    The rows keep their group's cell, which later steps reuse.
    """
    gaps = running(
        with_cells(accepted, ["gfull"], "seq", cell_rows), ["gfull"], "seq",
        maxes={"newest": F.col("ts_ms")},
    )
    expired = (F.col("gtype") == GROUP_TEMP) & (F.col("ts_ms") - F.col("newest") > TEMP_GROUP_TTL_MS)
    return running(
        gaps, ["gfull"], "seq", inclusive=True, sums={"episode": F.when(expired, 1).otherwise(0)}
    ).drop("newest")


def user_current_group(group_event: DataFrame) -> DataFrame:
    """(uid, current_group): the group last joined, "0" after a leave.

    The last accepted row of a user is the latest by (time, arrival).
    """
    now = F.when(F.col("event") == "JOIN_GROUP", F.col("gfull")).otherwise("0")
    return (
        in_out(group_event).groupBy("uid")
        .agg(F.max(F.struct("ts_ms", "seq", now.alias("now"))).alias("last"))
        .select("uid", F.col("last.now").alias("current_group"))
    )


def _ends(members: DataFrame, as_of: int | None) -> DataFrame:
    """Last episode of each group; groups expired at `as_of` are left out.

    Without a time the newest row's is taken, for which one future date is enough
    to expire all temporary groups; a caller that knows the time should give it.
    """
    now = members.agg(F.max("ts_ms")).scalar() if as_of is None else F.lit(as_of)
    last = members.groupBy("gfull", "gtype").agg(
        F.max("episode").alias("last_episode"), F.max("ts_ms").alias("last_ms")
    )
    expired = (F.col("gtype") == GROUP_TEMP) & (now - F.col("last_ms") > TEMP_GROUP_TTL_MS)
    return stage(last.where(~expired).select("gfull", "last_episode"), "group_ends")


def group_members(members: DataFrame, as_of: int | None = None) -> DataFrame:
    """(gtype, gfull, uid) in each group after the last row, as of a time."""
    status = members.groupBy("gfull", "gtype", "uid").agg(
        F.max(F.struct("seq", "event", "episode")).alias("last")
    ).where(F.col("last.event") == "JOIN_GROUP")
    return (
        lookup_join(status, _ends(members, as_of), "gfull")
        .where(F.col("last.episode") == F.col("last_episode")).select("gtype", "gfull", "uid")
    )


def online_groups(members: DataFrame, as_of: int | None = None) -> DataFrame:
    """(gtype, gfull) with at least one member."""
    return group_members(members, as_of).select("gtype", "gfull").distinct()


def group_lives(members: DataFrame) -> DataFrame:
    """Joins and leaves with their life and `emptied`, set on the leave that ends one."""
    joins = F.col("event") == "JOIN_GROUP"
    before = running(
        members, ["gfull", "episode", "uid"], "seq", maxes={"was": F.struct("seq", "event")}
    )
    was_in = F.coalesce(F.col("was.event") == "JOIN_GROUP", F.lit(False))
    step = F.when(joins & ~was_in, 1).when(~joins & was_in, -1).otherwise(0)
    counted = running(
        before, ["gfull", "episode"], "seq", sums={"size": step}, inclusive=True
    ).drop("was").withColumn("emptied", ~joins & (F.col("size") == 0))
    return running(
        counted, ["gfull", "episode"], "seq", sums={"life": F.col("emptied").cast("int")}
    ).drop(CELL, "size")


def life_places(lives: DataFrame, place: str) -> DataFrame:
    """Where each life was joined: (gfull, gtype, place, episode, opened, closed).

    opened is the seq of the first join there; closed that of the leave that
    emptied the group or, if it expired instead, of the next episode's first
    row; null while it lives. Next episodes are looked up, so that a group with
    very many lives in one episode is spread.
    """
    life = ["gfull", "episode", "life"]
    opened = lives.where(F.col("event") == "JOIN_GROUP").groupBy(*life, "gtype", place).agg(
        F.min("seq").alias("opened")
    )
    emptied = lives.where("emptied").select(*life, F.col("seq").alias("emptied_at"))
    next_start = stage(
        lives.where("episode > 0").groupBy("gfull", "episode").agg(F.min("seq").alias("expired_at"))
        .select(F.struct("gfull", (F.col("episode") - 1).alias("episode")).alias("_of"), "expired_at"), "next_episodes"
    )
    lived = opened.join(emptied, life, "left").withColumn("_of", F.struct("gfull", "episode"))
    return (
        lookup_join(lived, next_start, "_of", "left")
        .withColumn("closed", F.coalesce("emptied_at", "expired_at"))
        .select("gfull", "gtype", place, "episode", "opened", "closed")
    )


def live_groups_by(members: DataFrame, lives: DataFrame, place: str, as_of: int | None = None) -> DataFrame:
    """(gtype, place, gfull) of groups with members, by server or group company of their joins."""
    places = life_places(lives, place).where(F.col("closed").isNull())
    return (
        lookup_join(places, _ends(members, as_of), "gfull")
        .where(F.col("episode") == F.col("last_episode"))
        .select("gtype", place, "gfull").distinct()
    )


def group_load_second(group_event: DataFrame, lives: DataFrame,
                      cell_rows: int = CELL_ROWS) -> DataFrame:
    """(svc, bucket, groups, temp_groups) for every second a server saw a join or leave.

    A server's clock is its newest join or leave, stale ones included. Counts
    are those after its last row of the second; an expired group leaves the
    count when it is next touched.
    """
    edges = F.array(
        F.struct(F.col("opened").alias("seq"), F.lit(1).alias("step")),
        F.struct(F.col("closed").alias("seq"), F.lit(-1).alias("step")),
    )
    moves = (
        life_places(lives, "svc").select("svc", "gtype", F.inline(edges).alias("seq", "step"))
        .where(F.col("seq").isNotNull())
        .select("svc", "seq", *[
            F.when(F.col("gtype") == t, F.col("step")).otherwise(0).cast("bigint").alias(n)
            for t, n in ((GROUP_NORMAL, "groups"), (GROUP_TEMP, "temp_groups"))
        ], F.lit(None).cast("bigint").alias("ts_ms"))
    )
    zero = F.lit(0).cast("bigint")
    clock = in_out(group_event).select(
        "svc", "seq", zero.alias("groups"), zero.alias("temp_groups"), "ts_ms"
    )
    steps = moves.unionByName(clock).groupBy("svc", "seq").agg(
        F.sum("groups").alias("g"), F.sum("temp_groups").alias("t"), F.max("ts_ms").alias("ts_ms")
    )
    timed = running(
        with_cells(steps, ["svc"], "seq", cell_rows, few_keys=True), ["svc"], "seq", inclusive=True,
        sums={"groups": F.col("g"), "temp_groups": F.col("t")}, maxes={"clock": F.col("ts_ms")},
    ).where(F.col("ts_ms").isNotNull())
    return (
        timed.groupBy("svc", second_bucket("clock").alias("bucket"))
        .agg(F.max(F.struct("seq", "groups", "temp_groups")).alias("last"))
        .select("svc", "bucket", "last.groups", "last.temp_groups")
    )
