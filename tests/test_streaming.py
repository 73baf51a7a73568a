"""Streams in several triggers against the batch transforms."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from talkgauge.operators import loads, windows
from talkgauge.plans.queries import sink_state_sets
from talkgauge.sources.events import raw_lines
from talkgauge.streaming import jobs, processors, sets

PARTS = 3


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Write a table as one file per trigger, in order of arrival, and follow it."""
    def make(rows):
        folder = str(tmp_path_factory.mktemp("source"))
        rows = rows.cache()
        width = rows.agg(F.max("seq")).first()[0] // PARTS + 1
        for part in range(PARTS):
            rows.where(F.floor(F.col("seq") / width) == part).coalesce(1).write.mode("append").parquet(folder)
        return jobs.read_table(spark, folder, rows.schema, files_per_trigger=1)
    return make


def run(spark, rows, folder):
    query = jobs.write_table(rows, f"{folder}/out", f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def test_actions_and_group_events(spark, tables, source, tmp_path):
    stream = jobs.stream_actions(source(raw_lines(tables.events)), tables.user_org)
    action = run(spark, stream, str(tmp_path / "a"))
    assert rows_of(action) == rows_of(tables.action)
    stream = jobs.stream_group_events(source(tables.action), tables.group_org)
    assert rows_of(run(spark, stream, str(tmp_path / "g"))) == rows_of(tables.group_event)


def test_online_machine_and_sessions(spark, tables, source, tmp_path):
    online = run(spark, processors.stream_online(source(tables.action)), str(tmp_path))
    assert rows_of(processors.online_event_columns(online)) == rows_of(
        tables.online.withColumn("pos", F.col("pos").cast("bigint")))
    assert rows_of(processors.session_columns(online)) == rows_of(tables.sessions)


def test_online_machine_goes_on_where_history_ends(spark, tables, source, tmp_path):
    """Batch of the first half and a stream of the second, in three triggers, give the batch of all."""
    half = tables.action.agg(F.max("seq")).first()[0] // 2
    history = tables.action.where(F.col("seq") < half)
    rest = tables.action.where(F.col("seq") >= half).withColumn("at", F.col("seq")).withColumn("seq", F.col("seq") - half)
    stream = source(rest).withColumn("seq", F.col("at")).drop("at")
    online = run(spark, processors.stream_online(stream, history), str(tmp_path))
    late = F.col("seq") >= half
    assert rows_of(processors.online_event_columns(online)) == rows_of(
        tables.online.where(late).withColumn("pos", F.col("pos").cast("bigint")))
    assert rows_of(processors.session_columns(online)) == rows_of(tables.sessions.where(late))
    assert rows_of(processors.session_columns(online)) != []


def test_numbered_log_is_followed_in_order(spark, tables, tmp_path):
    """Records of uneven partitions in two triggers, a new user between them, a restart and a repeated trigger."""
    records = str(tmp_path / "records")
    rows = tables.raw.where("seq < 3000").select(
        F.timestamp_millis("seq").alias("timestamp"), F.when(F.col("seq") % 11 == 0, 1).otherwise(0).alias("partition"),
        F.col("seq").alias("offset"), F.encode("line", "UTF-8").alias("value"))
    org = tables.user_org.where("uid <> '1003'")
    orgs, used = [org, tables.user_org], []

    def read_org():
        used.append(len(used))
        return orgs[min(len(used) - 1, 1)]

    raw_schema = "seq long, line string"
    for part in (F.col("offset") < 1500, F.col("offset") >= 1500):
        rows.where(part).coalesce(1).write.mode("append").parquet(records)
        jobs.run_log(jobs.read_table(spark, records, rows.schema, 1), str(tmp_path / "log"), str(tmp_path / "c1"), once=True).awaitTermination()
        raw = jobs.read_table(spark, str(tmp_path / "log"), raw_schema, 100)
        jobs.run_actions(raw, read_org, str(tmp_path / "action"), str(tmp_path / "c2"), once=True).awaitTermination()
    log = spark.read.schema(raw_schema).parquet(str(tmp_path / "log"))
    assert [r["line"] for r in log.orderBy("seq").collect()] == [
        r["line"] for r in tables.raw.where("seq < 3000").orderBy("seq").collect()]
    assert log.select("seq").distinct().count() == log.count() == rows.count()
    action = spark.read.parquet(str(tmp_path / "action"))
    early = action.where((F.col("uid") == "1003") & (F.col("seq") < jobs.BATCH_LINES))
    late = action.where((F.col("uid") == "1003") & (F.col("seq") >= jobs.BATCH_LINES))
    assert early.where("company IS NOT NULL").count() == 0
    assert late.where("company IS NOT NULL").count() > 0


def test_groups(spark, tables, source, tmp_path):
    """All group sets and the group load of a stream in three triggers equal the batch ones."""
    from talkgauge.operators import groups

    accepted = run(spark, processors.stream_accepted(source(tables.group_event)), str(tmp_path / "a"))
    steps = run(spark, processors.stream_group_steps(source(accepted)), str(tmp_path / "s"))
    lives = processors.group_lives_of(steps)
    columns = ["seq", "uid", "gfull", "episode", "life", "emptied"]
    assert rows_of(lives, columns) == rows_of(tables.lives, columns)
    assert rows_of(groups.group_members(lives)) == rows_of(groups.group_members(tables.members))
    for place in ("svc", "gcompany"):
        assert rows_of(groups.live_groups_by(lives, lives, place)) == rows_of(
            groups.live_groups_by(tables.members, tables.lives, place))
    load = run(spark, processors.stream_group_load(source(steps)), str(tmp_path / "l"))
    newest = load.groupBy("svc").agg(F.max("bucket").alias("newest"))
    batch = groups.group_load_second(tables.group_event, tables.lives).join(newest, "svc").where("bucket <= newest")
    assert load.count() > 0 and rows_of(load) == rows_of(batch, load.columns)


def test_server_record(spark, tables, tmp_path):
    """Second loads in three triggers of time give the batch record, up to what is still open."""
    from talkgauge.operators import groups

    parts = [loads.user_load_second(tables.user_changes("svc")),
             groups.group_load_second(tables.group_event, tables.lives),
             loads.speak_load_second(tables.speak_changes("svc"))]
    low, high = tables.server_seconds.agg(F.min("bucket"), F.max("bucket")).first()
    streams = []
    for k, part in enumerate(parts):
        folder = str(tmp_path / f"part{k}")
        for third in range(3):
            time = F.floor((F.col("bucket") - low) * 3 / (high - low + 1))
            part.where(time == third).coalesce(1).write.mode("append").parquet(folder)
        streams.append(jobs.read_table(spark, folder, part.schema, 1))
    got = run(spark, processors.stream_server_record(*streams), str(tmp_path))
    batch = loads.merge_reports(tables.server_seconds).groupBy("svc").agg(F.max("bucket").alias("newest"))
    record = loads.server_load_second(tables.server_seconds).select(
        F.col("server").alias("svc"), "bucket", "userLoad.*", "groupLoad.*", "speakLoad.*")
    closed = record.join(batch, "svc").where("bucket <= newest - 5000")
    assert got.count() > 1000 and rows_of(got) == rows_of(closed, got.columns)


def test_whole_job(spark, tables, tmp_path):
    """All linked queries over records in two runs; a third run without records adds nothing."""
    from talkgauge.operators import enrich, groups, online, parse, sinks, speaking

    rows = tables.raw.where("seq < 2400").select(
        F.timestamp_millis("seq").alias("timestamp"), F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        F.encode("line", "UTF-8").alias("value"))
    records, out = str(tmp_path / "records"), str(tmp_path / "out")
    for dim, name in zip(tables.dims, ("dim_user", "dim_group", "dim_company")):
        dim.write.parquet(str(tmp_path / "dims" / name))
    counts = []
    for part in (F.col("offset") < 1200, F.col("offset") >= 1200, F.lit(False)):
        rows.where(part).coalesce(1).write.mode("append").parquet(records)
        stream = jobs.read_table(spark, records, rows.schema, 100)
        queries = jobs.run_job(spark, stream, str(tmp_path / "dims"), out, once=True)
        assert all(q.exception() is None for q in queries.values())
        counts.append({n: spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{n}").count()
                       for n in ("log", "action", "online", "speaking", "group_step", "history/user_action", "server_second")})
    assert counts[1] == counts[2] and counts[0]["log"] < counts[1]["log"] == rows.count()

    def read(name):
        return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{name}")

    action = enrich.user_actions(parse.parse_logs(read("log")), tables.user_org)
    group_event = enrich.group_events(action, tables.group_org)
    events = online.online_events(action)
    columns = ["seq", "event", "uid", "interval", "ts_ms"]
    assert rows_of(read("action")) == rows_of(action)
    assert rows_of(read("group_event")) == rows_of(group_event)
    assert rows_of(processors.online_event_columns(read("online")), columns) == rows_of(events, columns)
    assert rows_of(read("speaking")) == rows_of(speaking.speaking_records(group_event))
    members = groups.membership(groups.accepted_in_out(group_event))
    lives = processors.group_lives_of(read("group_step"))
    assert rows_of(groups.group_members(lives)) == rows_of(groups.group_members(members))
    changes = read("set_change/user").unionByName(read("set_change/group"))
    now = members.agg(F.max("ts_ms")).first()[0]
    inside = sets.sets_of(changes, now).unionByName(read("set_change/seen"))
    part = SimpleNamespace(members=members, lives=groups.group_lives(members), online=events, action=action)
    assert rows_of(inside) == rows_of(sink_state_sets(part).where("key IS NOT NULL"))
    view = sinks.latest_per_key(read("history/user_session"), sinks.TABLE_COLUMNS["user_session"])
    assert rows_of(view) == rows_of(sinks.table_view(online.user_sessions(action), "user_session"))
    assert read("appload").count() == read("server_second").count() > 0
    for prefix, place in (("server", "svc"), ("company", "company")):
        for kind in ("user", "speak"):
            seconds, hours = (read(f"load_{place}/{kind}_load_{t}") for t in ("second", "hour"))
            assert 0 < seconds.select("entity").distinct().count() and seconds.groupBy("entity", "bucket").count().where("count > 1").count() == 0
            closed = read(f"load_{place}/{kind}_load_merge" if place == "svc" else f"load_{place}/{kind}_load_hour")
            assert rows_of(read(f"history/{prefix}_{kind}_load"), ["entity", "bucket"]) == rows_of(closed, ["entity", "bucket"])
            if place == "svc":
                assert rows_of(closed.drop("dropped")) == rows_of(loads.closed_hours(hours), hours.columns)


def test_history_of_a_stream(spark, tables, source, tmp_path):
    from talkgauge.operators import sinks

    for _ in range(2):  # a restart finds nothing new and doubles nothing
        jobs.run_history(
            source(tables.action) if _ == 0 else jobs.read_table(spark, str(tmp_path / "none"), tables.action.schema, 1),
            "user_action", str(tmp_path / "history"), str(tmp_path / f"checkpoint{_}"), once=True).awaitTermination()
    back = spark.read.parquet(str(tmp_path / "history" / "user_action"))
    assert rows_of(sinks.latest_per_key(back, sinks.TABLE_COLUMNS["user_action"])) == rows_of(
        sinks.table_view(tables.action, "user_action"))


def test_speaking(spark, tables, source, tmp_path):
    records = run(spark, processors.stream_speaking(source(tables.group_event)), str(tmp_path))
    assert rows_of(records) == rows_of(tables.speaking)


def test_seconds_close_at_the_watermark(spark, tmp_path):
    """100.x closes once 105.0 is seen; a trigger later 100.5 is dropped and 101.1 counts."""
    folder = str(tmp_path / "in")
    for times in ([100.2, 100.9, 101.0, 104.9, 105.0], [105.1], [100.5, 101.1], [120.0], [121.0]):
        rows = spark.createDataFrame([("s", int(t * 1000)) for t in times], "svc string, ts_ms bigint")
        rows.coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_table(spark, folder, rows.schema, files_per_trigger=1)
    out = run(spark, jobs.second_counts(stream, "svc"), str(tmp_path))
    assert {r.bucket // 1000: r.n for r in out.collect()} == {100: 2, 101: 2, 104: 1, 105: 2}


def test_kafka_records(spark):
    from talkgauge.sources.logs import raw_from_kafka

    rows = [(p, o, f"line {p} {o}".encode()) for p in range(3) for o in range(4)]
    df = spark.createDataFrame(rows, "partition int, offset bigint, value binary").withColumn(
        "timestamp", F.timestamp_millis(F.col("offset")))
    got = raw_from_kafka(df).orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(12)) and got[4].line == "line 1 1"
    assert windows.count_per_second(spark.range(3).select(F.lit("s").alias("svc"), F.lit(1).cast("bigint").alias("ts_ms")), "svc").first().n == 3
