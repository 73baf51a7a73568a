"""Running values per key that do not need a key's rows in one task.

A window over `partitionBy(key)` sorts all rows of a key in one task. Here a
key with many rows is cut into cells of `order`; the cells are summarised
(partial aggregation), the summaries run over the key, and each row combines
the carry of the cells before its own with a window inside its cell. Only
associative values are supported: max, min and sum. `max(struct(order, ..))`
gives the latest earlier row that fits a condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgauge.schemas import DAY_MS

CELL_ROWS = 4_000_000
CELL = "_cell"


def with_cells(rows: DataFrame, by: list[str], order: str, cell_rows: int = CELL_ROWS,
               few_keys: bool = False) -> DataFrame:
    """Add the cell of each row: null for most keys, a range of `order` for big ones.

    `order` is a unique integer, so a range of `cell_rows` values holds at most
    that many rows whatever the skew. Big keys have more than `cell_rows` rows:
    there are at most total / cell_rows of them, which bounds the broadcast.
    With `few_keys` (servers, say) all keys are split and none are counted.
    """
    cell = F.floor(F.col(order) / cell_rows).cast("bigint")
    if few_keys:
        return rows.withColumn(CELL, cell)
    big = (
        rows.groupBy(*by).count().where(F.col("count") > cell_rows)
        .select(*by, F.lit(True).alias("_big"))
    )
    return (  # fewer than rows / cell_rows big keys: 250,000 of 10^12 rows
        rows.join(F.broadcast(big), by, "left")
        .withColumn(CELL, F.when(F.col("_big"), cell)).drop("_big")
    )


def running(rows: DataFrame, by: list[str], order: str, *,
            maxes: dict[str, Column] | None = None, mins: dict[str, Column] | None = None,
            sums: dict[str, Column] | None = None, inclusive: bool = False, split: bool = True) -> DataFrame:
    """Add running values over the rows before each row (and itself if `inclusive`).

    `rows` must have the cell column (`with_cells`, or any non-decreasing
    function of `order`). Rows whose value is null are skipped. Without `split`, for
    keys known to be small, cells are not looked at and a key is one window.
    """
    maxes, mins, sums = maxes or {}, mins or {}, sums or {}
    values = {**maxes, **mins, **sums}
    rows = rows.withColumns({f"_v_{n}": c for n, c in values.items()})

    def total(name: str) -> Column:
        fold = F.max if name in maxes else F.min if name in mins else F.sum
        return fold(f"_v_{name}")

    if not split:
        upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        kept = [c for c in rows.columns if not c.startswith("_v_")]
        plain = {n: F.coalesce(total(n).over(upto), F.lit(0).cast("bigint")) if n in sums else total(n).over(upto)
                 for n in values}
        return rows.select(*kept, *[c.alias(n) for n, c in plain.items()])

    before = Window.partitionBy(*by).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.where(F.col(CELL).isNotNull()).groupBy(*by, CELL)
        .agg(*[total(n).alias(f"_v_{n}") for n in values])
        .select(*by, CELL, *[total(n).over(before).alias(f"_c_{n}") for n in values])
    )
    inside = Window.partitionBy(*by, CELL).orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )

    def combine(name: str) -> Column:
        here, earlier = total(name).over(inside), F.col(f"_c_{name}")
        if name in sums:
            zero = F.lit(0).cast("bigint")
            return F.coalesce(here, zero) + F.coalesce(earlier, zero)
        return (F.greatest if name in maxes else F.least)(here, earlier)

    kept = [c for c in rows.columns if not c.startswith("_v_")]
    return rows.join(carry, [*by, CELL], "left").select(
        *kept, *[combine(n).alias(n) for n in values]
    )


def hold_deltas(ops: DataFrame, by: list[str], at: str, holds: str, until: str | None = None) -> DataFrame:
    """Interval ends of members that start or stop holding something.

    `ops` has one row per (by, at): `holds` says whether the member holds from
    `at` until its next row, or until the time `until` (null: no limit) if that
    is earlier. Gives (by, at, delta) with +1 at starts and -1 at ends; summing
    deltas up to a time counts the members holding then.

    A key's rows meet by day. The last row of a day ends with the first row of
    the key's next day, of which there is one row each, so no window holds more
    than a day's seconds.
    """
    ops = ops.withColumn(CELL, F.floor(F.col(at) / DAY_MS).cast("bigint"))
    days = ops.groupBy(*by, CELL).agg(F.min(at).alias("_first"))
    coming = days.select(*by, CELL, F.lead("_first").over(Window.partitionBy(*by).orderBy(CELL)).alias("_coming"))
    ops = ops.join(coming, [*by, CELL])
    following = F.coalesce(F.lead(at).over(Window.partitionBy(*by, CELL).orderBy(at)), "_coming")
    end = following if until is None else F.least(following, F.col(until))
    edges = F.array(
        F.struct(F.col(at).alias("at"), F.lit(1).cast("bigint").alias("delta")),
        F.struct(F.col("_end").alias("at"), F.lit(-1).cast("bigint").alias("delta")),
    )
    return (
        ops.withColumn("_end", end).where(F.col(holds))
        .select(*by, F.inline(edges).alias(at, "delta"))
        .where(F.col(at).isNotNull())
    )
