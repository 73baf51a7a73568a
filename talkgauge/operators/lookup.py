"""Point lookups of a dimension that neither outgrow memory nor pile up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20
HOT_ROWS = 4_000_000

_SIZES: dict[tuple, tuple[int, int]] = {}


def size_of(dim: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a dimension, counted once a session for the same plan over the same files.

    A table that is read again after it has grown has other files, and is counted again.
    Counts and sums are partial per partition, so one row of each is brought together.
    """
    key = (dim.sparkSession.sparkContext.applicationId, dim.semanticHash(), tuple(sorted(dim.inputFiles())))
    if key not in _SIZES:
        row = dim.agg(F.count("*").alias("n"), F.sum(F.length(F.to_csv(F.struct(*dim.columns)))).alias("b")).first()
        _SIZES[key] = (row["n"], row["b"] or 0)
    return _SIZES[key]


def lookup_join(rows: DataFrame, dim: DataFrame, key: str, how: str = "inner", *,
                broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join `rows` to `dim` (unique on `key`), `how` being inner or left.

    The dimension is measured first. Up to `broadcast_rows` and `broadcast_bytes`
    it is broadcast and `rows` is not shuffled. Beyond that the join is shuffled, and
    a key with more than `hot_rows` rows is spread over one salt per `hot_rows`,
    its dimension row being copied to each: no task gets a whole hot key. There
    are fewer than total / hot_rows hot keys and twice that many copies, which
    bounds the broadcast of the hot keys. A stream joins as Spark decides, since
    its rows cannot be counted.
    """
    if rows.isStreaming:
        return rows.join(dim, key, how)
    n, size = size_of(dim)
    if n <= broadcast_rows and size <= broadcast_bytes:
        return rows.join(F.broadcast(dim), key, how)
    hot = F.broadcast(  # fewer than rows / hot_rows keys: 250,000 of 10^12 rows
        rows.groupBy(key).count().where(F.col("count") > hot_rows)
        .select(key, F.ceil(F.col("count") / hot_rows).alias("_salts"))
    )
    salt = F.pmod(F.xxhash64(*rows.columns), F.col("_salts"))
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.coalesce(salt, F.lit(0).cast("bigint"))
    ).drop("_salts")
    last = F.coalesce(F.col("_salts"), F.lit(1).cast("bigint")) - 1
    copies = dim.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    ).drop("_salts")
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")
