"""Event-time buckets, late rows, gap filling and trailing reports.

Counts per (entity, bucket) stay sparse, one row where something happened.
Dense grids are made only for the tables that need a row per second or minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.functions.times import floor_to, minute_bucket, minute_mark, second_bucket
from talkgauge.operators.lookup import BROADCAST_ROWS
from talkgauge.operators.scan import CELL, CELL_ROWS, hold_deltas, running, with_cells
from talkgauge.plans.staging import stage
from talkgauge.schemas import DAY_MS, HOUR_MS, LATE_MS, MINUTE_MS, SECOND_MS


def count_per_second(rows: DataFrame, entity: str) -> DataFrame:
    """(entity, bucket, n): tumbling one-second event-time windows."""
    return rows.groupBy(entity, second_bucket("ts_ms").alias("bucket")).agg(F.count("*").alias("n"))


def second_arrivals(bucketed: DataFrame, entity: str) -> DataFrame:
    """(entity, bucket, first, last): the first and last row of each second by arrival; partial per task."""
    return bucketed.groupBy(entity, "bucket").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))


def clock_steps(arrivals: DataFrame, entity: str, cell_rows: int = CELL_ROWS, split: bool = True) -> DataFrame:
    """(entity, at, bucket, newest): the staircase of each entity's clock, at most one step a second.

    Its newest second rises from `newest` to `bucket` with the row `at`; `newest` is
    null at the first step.
    """
    aged = running(
        with_cells(arrivals, [entity], "first", cell_rows, few_keys=True), [entity], "first",
        maxes={"newest": F.col("bucket")}, split=split,
    )
    return aged.where(F.col("newest").isNull() | (F.col("bucket") > F.col("newest"))).select(
        entity, F.col("first").alias("at"), "bucket", "newest"
    )


def is_jump() -> Column:
    """Whether a step leaps five seconds or more, which empties the window."""
    return F.coalesce(F.col("bucket") - F.col("newest") >= LATE_MS + SECOND_MS, F.lit(False))


def late_after(arrivals: DataFrame, steps: DataFrame, entity: str, split: bool = True) -> DataFrame:
    """(entity, bucket, cut) of seconds that have late rows: those that arrive after the row `cut`.

    A step moves the end of the window to 4 s before its second, 3 s after a jump, and
    ends the seconds before that. Falling through seconds and window ends, the
    earliest step whose end lies above a second is a running minimum.
    """
    none = F.lit(None).cast("bigint")
    floor = F.col("bucket") - F.when(is_jump(), LATE_MS - SECOND_MS).otherwise(LATE_MS)
    points = arrivals.select(entity, "bucket", none.alias("at"), "last", F.lit(0).alias("after")).unionByName(
        steps.select(entity, floor.alias("bucket"), "at", none.alias("last"), F.lit(1).alias("after"))
    ).withColumn("fall", F.expr(f"-2 * (bucket div {SECOND_MS}) + after"))
    ended = running(
        points.withColumn(CELL, F.floor(F.col("fall") / (2 * DAY_MS // SECOND_MS)).cast("bigint")), [entity], "fall",
        mins={"cut": F.col("at")}, split=split,
    )
    return ended.where(F.col("last") > F.col("cut")).select(entity, "bucket", "cut")


def mark_late(rows: DataFrame, entity: str, cell_rows: int = CELL_ROWS,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add bucket and late: the entity's newest bucket was over 4 s ahead on arrival.

    A jump of five seconds or more empties the window, which then reaches back
    3 s only, until a still newer bucket opens. Rows are judged by a lookup of their
    second among those that have late rows, which come from the clock's staircase.
    Where all entities together have `broadcast_rows` seconds or fewer, that lookup is
    broadcast; where they have `cell_rows` or fewer, no entity's seconds are split.
    """
    bucketed = rows.withColumn("bucket", second_bucket("ts_ms"))
    arrivals = stage(second_arrivals(bucketed, entity), "clock_arrivals")
    seconds = arrivals.count()
    split = seconds > cell_rows
    cuts = late_after(arrivals, clock_steps(arrivals, entity, cell_rows, split), entity, split)
    cuts = F.broadcast(cuts) if seconds <= broadcast_rows else cuts
    return bucketed.join(cuts, [entity, "bucket"], "left").select(
        *bucketed.columns, F.coalesce(F.col("seq") > F.col("cut"), F.lit(False)).alias("late")
    )


def drop_stale(rows: DataFrame, key: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Keep rows not older than the newest earlier arrival of their key."""
    return running(
        with_cells(rows, [key], "seq", cell_rows), [key], "seq", maxes={"newest": F.col("ts_ms")}
    ).where(F.col("newest").isNull() | (F.col("newest") <= F.col("ts_ms"))).drop(CELL, "newest")


def explode_range(spans: DataFrame, step: int, name: str) -> DataFrame:
    """One row per multiple of `step` from first to last, by way of one row per day.

    `spans` has first and last, both multiples of `step`.
    """
    days = F.sequence(floor_to("first", DAY_MS), floor_to("last", DAY_MS), F.lit(DAY_MS).cast("bigint"))
    daily = spans.where(F.col("first") <= F.col("last")).withColumn("_day", F.explode(days))
    within = F.sequence(
        F.greatest(F.col("first"), F.col("_day")),
        F.least(F.col("last"), F.col("_day") + (DAY_MS - step)),
        F.lit(step).cast("bigint"),
    )
    return daily.withColumn(name, F.explode(within)).drop("_day", "first", "last")


def second_grid(rows: DataFrame, entity: str) -> DataFrame:
    """(entity, bucket) for every second from four before the first to the newest."""
    spans = rows.groupBy(entity).agg(
        (F.min("bucket") - LATE_MS).alias("first"), F.max("bucket").alias("last")
    )
    return explode_range(spans, SECOND_MS, "bucket")


def minute_grid(rows: DataFrame, entity: str) -> DataFrame:
    """(entity, bucket) for every minute mark a trailing report is made at."""
    spans = rows.groupBy(entity).agg(
        (minute_bucket(F.min("bucket") - LATE_MS) + MINUTE_MS).alias("first"),
        minute_bucket(F.max("bucket")).alias("last"),
    )
    return explode_range(spans, MINUTE_MS, "bucket")


def fill(grid: DataFrame, rows: DataFrame, entity: str, measures: list[str],
         keep_outside: bool = False) -> DataFrame:
    """Sum `rows` onto the grid, zero where there are none; one shuffle, no join."""
    zero = F.lit(0).cast("bigint")
    marked = grid.select(entity, "bucket", *[zero.alias(m) for m in measures], F.lit(True).alias("_grid"))
    summed = marked.unionByName(
        rows.select(entity, "bucket", *measures, F.lit(None).cast("boolean").alias("_grid"))
    ).groupBy(entity, "bucket").agg(
        *[F.coalesce(F.sum(m), zero).alias(m) for m in measures], F.max("_grid").alias("_grid")
    )
    return summed if keep_outside else summed.where("_grid").drop("_grid")


def dense_seconds(changes: DataFrame, entity: str, gauges: dict[str, str], counts: list[str]) -> DataFrame:
    """Every second of each entity: its counts, and for each gauge its column of changes summed up so far.

    `changes` is sparse, with `seen` over zero where there were rows. Each
    change is stretched to the next one of its day, so a task makes the seconds
    of one entity and day, and nothing dense is shuffled.
    """
    zero = F.lit(0).cast("bigint")
    summed = [*counts, *gauges.values()]
    spans = changes.where("seen > 0").groupBy(entity).agg(
        (F.min("bucket") - LATE_MS).alias("first"), F.max("bucket").alias("last")
    )
    days = F.explode(
        F.sequence(floor_to("first", DAY_MS), floor_to("last", DAY_MS), F.lit(DAY_MS).cast("bigint"))
    )
    starts = spans.withColumn("day", days).select(
        entity, F.greatest("day", "first").alias("bucket"), *[zero.alias(c) for c in summed],
        F.least(F.col("day") + DAY_MS, F.col("last") + SECOND_MS).alias("end"),
    )
    rows = (
        changes.select(entity, "bucket", *summed, F.lit(None).cast("bigint").alias("end"))
        .unionByName(starts).withColumn(CELL, floor_to("bucket", DAY_MS))
        .groupBy(entity, CELL, "bucket")
        .agg(*[F.sum(c).alias(c) for c in summed], F.max("end").alias("end"))
    )
    day = Window.partitionBy(entity, CELL)
    if gauges:
        rows = running(rows, [entity], "bucket", sums={g: F.col(d) for g, d in gauges.items()}, inclusive=True)
    spread = (
        rows.withColumn("end", F.max("end").over(day)).where(F.col("bucket") < F.col("end"))
        .withColumn("next", F.lead("bucket").over(day.orderBy("bucket")))
        .withColumn("last", F.coalesce("next", "end") - SECOND_MS)
    )
    seconds = F.posexplode(F.sequence("bucket", "last", F.lit(SECOND_MS).cast("bigint")))
    return spread.select(entity, *gauges, *counts, seconds.alias("pos", "second")).select(
        entity, F.col("second").alias("bucket"), *gauges,
        *[F.when(F.col("pos") == 0, F.col(c)).otherwise(zero).alias(c) for c in counts],
    )


def skipped_spans(rows: DataFrame, entity: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(entity, first, last) of seconds reported by a jump ahead instead of by sliding out.

    A row five or more seconds past the newest bucket empties the window; the
    seconds up to four before it are then reported without having been open.
    """
    bucketed = rows.withColumn("bucket", second_bucket("ts_ms"))
    return clock_steps(second_arrivals(bucketed, entity), entity, cell_rows).where(is_jump()).select(
        entity, (F.col("newest") + SECOND_MS).alias("first"), (F.col("bucket") - LATE_MS).alias("last")
    )


def skipped_seconds(rows: DataFrame, entity: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(entity, bucket) of the seconds of `skipped_spans`."""
    return explode_range(skipped_spans(rows, entity, cell_rows), SECOND_MS, "bucket")


def skipped_gauges(spans: DataFrame, changes: DataFrame, entity: str, gauge: str, delta: str) -> DataFrame:
    """(entity, bucket, gauge) of skipped seconds: the changes summed up to a span's start hold all through it.

    A span lies between two steps of the clock, and rows within it come too late to
    count, so nothing changes there. Only changes and spans are shuffled, not seconds.
    """
    points = changes.select(entity, "bucket", delta, F.lit(None).cast("bigint").alias("last")).unionByName(
        spans.select(entity, F.col("first").alias("bucket"), F.lit(0).cast("bigint").alias(delta), "last")
    ).groupBy(entity, "bucket").agg(F.sum(delta).alias(delta), F.max("last").alias("last"))
    levels = running(points.withColumn(CELL, floor_to("bucket", DAY_MS)), [entity], "bucket",
                     sums={gauge: F.col(delta)}, inclusive=True)
    held = levels.where(F.col("last").isNotNull()).select(entity, gauge, F.col("bucket").alias("first"), "last")
    return explode_range(held, SECOND_MS, "bucket").select(entity, "bucket", gauge)


def per_minute_mark(rows: DataFrame, entity: str, measures: list[str]) -> DataFrame:
    """Sums per minute mark M over the seconds in (M - 60 s, M]."""
    return rows.groupBy(entity, minute_mark("bucket").alias("bucket")).agg(
        *[F.sum(m).cast("bigint").alias(m) for m in measures]
    )


def trailing_hour(minutes: DataFrame, entity: str, measures: list[str]) -> DataFrame:
    """Sums over the 60 marks ending at each; `minutes` has every mark of the grid.

    The window holds an entity's minutes, which the span bounds, not its rows.
    """
    hour = Window.partitionBy(entity).orderBy("bucket").rangeBetween(MINUTE_MS - HOUR_MS, 0)
    return minutes.withColumns({m: F.sum(m).over(hour) for m in measures})


def distinct_members(members: DataFrame, entity: str, grid: DataFrame, kinds: list[str],
                     ttl_ms: int) -> DataFrame:
    """Distinct members per kind at each mark of the grid, a member living ttl_ms.

    `members` has (entity, kind, member, bucket, forever): a member counts at
    marks M with bucket <= M < bucket + ttl_ms, or until its next row if
    `forever` is set. Rows collapse to one per (entity, kind, member, mark);
    intervals then give +1 and -1, summed along the marks.
    """
    keys = [entity, "kind", "member"]
    ops = (
        members.groupBy(*keys, minute_mark("bucket").alias("mark"))
        .agg(F.max(F.struct("bucket", "seq", "forever")).alias("last"))
        .select(
            *keys, F.col("mark").alias("bucket"), F.lit(True).alias("holds"),
            F.when(~F.col("last.forever"), F.col("mark") + minute_mark(F.lit(ttl_ms))).alias("until"),
        )
    )
    deltas = hold_deltas(ops, keys, "bucket", "holds", "until").groupBy(entity, "bucket").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("delta")).otherwise(0)).alias(k) for k in kinds]
    )
    upto = Window.partitionBy(entity).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        fill(grid, deltas, entity, kinds, keep_outside=True)
        .withColumns({k: F.sum(k).over(upto) for k in kinds}).where("_grid").drop("_grid")
    )
