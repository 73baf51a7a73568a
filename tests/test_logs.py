"""Arrival order of raw lines from Kafka records and from files."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.operators import enrich, online, parse, windows
from talkgauge.sources import logs


def records(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, partition int, offset long, value string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")).withColumn("value", F.encode("value", "UTF-8"))


def test_uneven_partitions_are_on_time(spark):
    """1,100 records at 10:1, all in time: none is late or stale."""
    rows = spark.range(1100).select(
        F.timestamp_millis(F.col("id") * 1000).alias("timestamp"),
        F.when(F.col("id") % 11 == 0, 1).otherwise(0).alias("partition"),
        F.when(F.col("id") % 11 == 0, F.floor(F.col("id") / 11)).otherwise(F.col("id")).alias("offset"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("value"))
    raw = logs.raw_from_kafka(rows.repartition(7))
    assert [r["line"] for r in raw.orderBy("seq").collect()] == [str(k) for k in range(1100)]
    timed = raw.select("seq", F.lit("svc0").alias("svc"), (F.col("line").cast("long") * 1000).alias("ts_ms"))
    assert windows.mark_late(timed, "svc").where("late").count() == 0
    assert windows.drop_stale(timed, "svc").count() == 1100


def test_order_within_one_millisecond(spark):
    from datetime import datetime

    at = datetime(2024, 1, 1)
    got = logs.raw_from_kafka(records(spark, [(at, 2, 0, "d"), (at, 0, 7, "b"), (at, 0, 6, "a"), (at, 1, 1, "c")]))
    assert rows_of(got) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_undeclared_partition_fails(spark):
    from datetime import datetime

    with pytest.raises(Exception, match="of 3 partitions there is number 3"):
        logs.raw_from_kafka(records(spark, [(datetime(2024, 1, 1), 3, 0, "x")])).collect()


@pytest.mark.parametrize("sizes", [(3, 3000, 300), (3000, 300, 3), (1, 0, 2)])
def test_files_of_all_sizes_in_name_order(spark, tmp_path, sizes):
    n = 0
    for k, size in enumerate(sizes):
        (tmp_path / f"{k:02}.log").write_text("".join(f"{n + i}\n" for i in range(size)))
        n += size
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits per file
    try:
        got = logs.read_log_files(spark, str(tmp_path))
        assert [tuple(r) for r in got.orderBy("seq").collect()] == [(k, str(k)) for k in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_machines_on_kafka_lines_equal_those_on_the_fixture(spark, tables):
    from talkgauge.plans.queries import QUERIES

    action = enrich.user_actions(parse.parse_logs(QUERIES["src_kafka_log"](tables)), tables.user_org)
    columns = ["svc", "dt", "event", "uid", "interval", "ts_ms"]
    assert rows_of(online.online_events(action), columns) == rows_of(tables.online, columns)
