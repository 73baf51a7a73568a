from conftest import rows_of
from pyspark.sql import functions as F

from talkgauge.functions import jsons, keys, times
from talkgauge.functions.text import kv_table


def _java_hash(text):
    if text is None:
        return 0
    units = text.encode("utf-16-be")
    h = 5381
    for i in range(0, len(units), 2):
        h = (h * 33 + units[i] * 256 + units[i + 1]) & 0xFFFFFFFF
    return h


def test_hash_of_any_text(spark):
    texts = ["", "a", "1001", "LOGIN", "é", "公司", "a\U0001F600b", "x" * 100, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.h, bytes(r.b)) for r in df.select("t", keys.string_hash("t").alias("h"), keys.bytes_hash("t").alias("b")).collect()}
    assert got == {t: (_java_hash(t), _java_hash(t).to_bytes(4, "big")) for t in texts}


def test_row_key_layout(spark):
    df = spark.createDataFrame([("c1", 1456827630123)], "c string, t bigint")
    key = bytes(df.select(keys.row_key(keys.bytes_hash("c"), keys.time_bytes("t"))).first()[0])
    assert key == _java_hash("c1").to_bytes(4, "big") + (1456827630123).to_bytes(8, "big")


def test_time_text_round_trip(spark):
    values = [0, 1, 999, 1704067199999, 1456827630123, -1, -86400000]
    df = spark.createDataFrame([(v,) for v in values], "ms bigint").select("ms", times.format_dt("ms").alias("dt"))
    rows = df.select("ms", "dt", times.parse_dt("dt").alias("back")).collect()
    assert all(r.ms == r.back for r in rows)
    assert {r.ms: r.dt for r in rows}[1704067199999] == "2023-12-31 23:59:59.999"
    assert {r.ms: r.dt for r in rows}[-1] == "1969-12-31 23:59:59.999"


def test_times_ignore_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.5' AS ts, 1710037800500L AS ms").select(
            times.ntz_micros("ts").alias("us"), times.format_dt("ms").alias("dt"),
            times.parse_dt(F.lit("2024-03-10 02:30:00.500")).alias("ms"),
        ).first()
        assert (row.us, row.dt, row.ms) == (1710037800500000, "2024-03-10 02:30:00.500", 1710037800500)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_buckets(spark):
    df = spark.createDataFrame([(-1,), (0,), (59999,), (60000,)], "ms bigint").select(
        times.second_bucket("ms").alias("s"), times.minute_bucket("ms").alias("m"), times.minute_mark("ms").alias("k")
    )
    assert [tuple(r) for r in df.collect()] == [(-1000, -60000, 0), (0, 0, 0), (59000, 0, 60000), (60000, 60000, 60000)]


def test_last_duplicate_key_wins(spark):
    df = spark.createDataFrame([("CONFIG uid=(7) a=(x=(y) uid=(8) empty=()",)], "c string")
    got = rows_of(df.select(F.inline(kv_table(F.col("c"))).alias("k", "v")))
    assert got == [("a", "x=(y"), ("empty", ""), ("uid", "8")]


def test_json_leaves_out_nulls_and_reads_back(spark):
    df = spark.createDataFrame([("u1", None, "x")], "uid string, dev string, extra string")
    text = df.select(jsons.json_out({"uid": "uid", "device": "dev", "extra": "extra"}).alias("j"))
    assert text.first().j == '{"uid":"u1","extra":"x"}'
    back = text.select(jsons.json_in(F.col("j"), jsons.ACTION_JSON_SCHEMA).alias("r")).first().r
    assert back.uid == "u1" and back.device is None
