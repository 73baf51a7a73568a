"""Raw log lines as (seq, line): one row per line, `seq` giving arrival order.

Every stateful step orders rows by `seq`, so it must be unique and follow the
order of the log. It is dense too, so a range of it holds as many rows as it is
wide, which is what the cells of big keys rest on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkgauge.plans.staging import stage

TOPIC_PARTITIONS = 3
#: A trigger's lines are numbered from its number times this on.
BATCH_LINES = 1 << 40


def number_lines(lines: DataFrame, part: list[str]) -> DataFrame:
    """(seq, line) of staged lines (part columns, at, line), numbered from 0.

    `at` rises by one from line to line of a part, and parts follow each other in
    the order of their columns. Only the parts' sizes are brought together, one row each.
    """
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy(*part).agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        *part, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    return lines.join(starts, part).select((F.col("at") + F.col("shift")).alias("seq"), "line")


def kafka_lines(records: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Kafka records as (timestamp, partition, offset, line); an undeclared partition fails."""
    known = F.when(F.col("partition") < partitions, F.col("partition")).otherwise(
        F.raise_error(F.concat(F.lit(f"of {partitions} partitions there is number "), "partition")).cast("int")
    )
    return records.select(
        "timestamp", known.alias("partition"), "offset", F.col("value").cast("string").alias("line")
    )


def raw_from_kafka(records: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Static Kafka records as raw lines in order of (Kafka's timestamp, partition, offset).

    Partitions fill unevenly, so offsets of two partitions say nothing about each
    other; the time a record was appended does. The sort is by range and its
    result staged, since `seq` must not change when it is read again. A stream
    numbers each trigger in this way (`streaming.jobs.run_log`).
    """
    order = ["timestamp", "partition", "offset"]
    ranged = kafka_lines(records, partitions).repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(ranged.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "line"
    ), "kafka_lines")
    return number_lines(staged, ["part"])


def read_kafka(spark: SparkSession, servers: str, topic: str, per_trigger: int, **options: str) -> DataFrame:
    """Tail the log topic from its end; the checkpoint resumes stored offsets.

    `per_trigger` bounds the records of a trigger: after an outage the backlog is
    worked off in triggers of that size. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("kafka.isolation.level", "read_committed")
        .option("maxOffsetsPerTrigger", per_trigger)
    )
    return reader.options(**options).load()


def read_log_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log files as raw lines, in order of (file path, split of the file, line).

    Spark packs splits into tasks by their size, so a line's place is taken from
    its file and split, and its number in the task only counts within the split.
    The lines are staged once; a retried task can't change their numbers.
    """
    staged = stage(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    ), "file_lines")
    return number_lines(staged, ["file", "start"])
