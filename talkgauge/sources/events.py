"""Log lines and dimensions derived from an `events` table.

The text is the same in every SQL engine: `line_sql` and `FAMILY_LINES` are
plain SQL over event_id, user_id and event_type, used by the checks as well.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgauge.functions.times import floor_to, format_dt, ntz_micros

# (header form, content) of the lines added to every 13th event, in turn.
# {u} user text, {g} group text, {e} event id.
FAMILY_LINES = [
    ("std", "CALL uid=({u}) targets=(11,12,13) called=(11)"),
    ("std", "QUICKDIAL uid=({u}) targets=(14) called=()"),
    ("std", "QUERY MEMBERS uid=({u}) count=(5) gids=({g})"),
    ("std", "QUERY GROUP uid=({u}) gcount=(4) gids=(1,2)"),
    ("std", "QUERY CONTACTS uid=({u}) count=(9) gcount=(2)"),
    ("slash", "QUERY DEPARTMENT uid=({u})"),
    ("std", "QUERY ENTERPRISE GROUP uid=({u}) gcount=(7)"),
    ("std", "QUERY USER uid=({u}) count=(1)"),
    ("std", "CHANGE NAME uid=({u}) name=(n{e})"),
    ("std", "CHANGE PWD FAULT uid=({u}) oldpwd=(a{e}) newpwd=(b{e})"),
    ("std", "CHANGE PWD uid=({u}) oldpwd=(a{e}) newpwd=(b{e})"),
    ("std", "CONTACT MAKE uid=({u}) target=(21) requested=(21)"),
    ("six", "CONTACT RESPONSE uid=({u}) accept=(22) paired=(22) refuse=(23)"),
    ("std", "CONTACT REMOVE uid=({u}) target=(24)"),
    ("std", "DISPATCH uid=({u}) gid=({g}) target=(25,26) dispatched=(25)"),
    ("std", "CONFIG uid=(7) uid=({u}) target=(9) audio=(on)"),
    ("std", "CONFIG uid=({u}) location=(on) period=(60)"),
    ("std", "CONFIG uid=({u})"),
    ("std", "TAKE MIC uid=({u}) target=(27) dispatched=(27)"),
    ("std", "CREATE GROUP uid=({u}) gid=({g}) name=(g{e})"),
    ("std", "DELETE GROUP uid=({u}) gid=({g}) deleted=({g})"),
    ("std", "EMPOWER FAULT uid=({u}) target=(28) gid=({g})"),
    ("std", "EMPOWER uid=({u}) target=(28) added=(28) gid=({g})"),
    ("std", "DEPRIVE FAULT uid=({u}) target=(29) gid=({g})"),
    ("std", "DEPRIVE uid=({u}) target=(29) remove=(29) gid=({g})"),
    ("std", "MODIFY GROUP FAULT uid=({u}) gid=({g}) name=(h{e})"),
    ("std", "MODIFY GROUP uid=({u}) gid=({g}) name=(h{e})"),
    ("std", "POST WORKSHEET uid=({u}) target=(30) msgcount=(3)"),
    ("slash", "LOGIN FAILED account=({u}) result=(3)"),
    ("std", "LOGIN FAILED result=(4)"),
    ("dot", "LOGOUT uid=({u})"),
    ("std", "SOMETHING uid=({u})"),
    ("std", "GET MIC uid=({u})"),
    ("std", "DENT MIC uid=({u}) gid=(x) target=(31)"),
    ("six", "QUERY USER uid=({u}) imsi=() count=()"),
]


def _template(text: str) -> str:
    """SQL concat of a template's fixed text and its {u} {g} {e} fields."""
    parts, rest = [], text
    while rest:
        cut = rest.find("{")
        if cut < 0:
            parts.append(f"'{rest}'")
            break
        if cut:
            parts.append(f"'{rest[:cut]}'")
        parts.append({"u": "1000 + user_id", "g": "gid", "e": "event_id"}[rest[cut + 1]])
        rest = rest[cut + 3:]
    return "concat(" + ", ".join(parts) + ")"


GID_SQL = "CASE WHEN event_id % 5 = 0 THEN 1879048192 + user_id % 4 ELSE 100 + user_id % 8 END"

CORE_SQL = """CASE event_type
  WHEN 'signup' THEN concat(
    CASE WHEN event_id % 4 = 0 THEN 'RELOGIN' ELSE 'LOGIN' END, ' uid=(', 1000 + user_id,
    ') context=(c', event_id % 7, ') address=(10.0.0.', user_id % 250, ':80) version=(1.', user_id % 3, ')',
    CASE WHEN user_id % 6 = 5 THEN '' ELSE concat(' device=(D', user_id % 4, ')') END,
    CASE user_id % 3 WHEN 0 THEN concat(' meid=(A', 1000 + user_id, ')')
      WHEN 1 THEN concat(' esn=(E', 1000 + user_id, ')') ELSE '' END)
  WHEN 'error' THEN concat(
    CASE WHEN event_id % 2 = 0 THEN 'LOGOUT BROKEN' ELSE 'LOGOUT' END, ' uid=(', 1000 + user_id,
    ') address=(10.0.0.', user_id % 250, ':80)')
  WHEN 'click' THEN concat('GET MIC uid=(', 1000 + user_id, ') gid=(', gid, ')')
  WHEN 'purchase' THEN concat(
    CASE event_id % 4 WHEN 0 THEN 'RELEASE MIC' WHEN 1 THEN 'LOSTMIC AUTO'
      WHEN 2 THEN 'LOSTMIC REPLACE' ELSE 'DENT MIC' END,
    ' uid=(', 1000 + user_id, ') gid=(', gid, ')')
  WHEN 'view' THEN concat(
    CASE WHEN event_id % 2 = 0 THEN 'JOIN GROUP' ELSE 'LEAVE GROUP' END,
    ' uid=(', 1000 + user_id, ') gid=(', gid, ')')
END"""


def line_sql(idiv: str) -> dict[str, str]:
    """SQL of the four lines of one event, by name; null where there is none.

    Needs the columns gid, day (`yyyy-MM-dd`), clock (`HH:mm:ss`) and frac
    (three digits). `idiv` is the engine's integer division operator.
    """
    pick = f"(event_id {idiv} 13) % {len(FAMILY_LINES)}"
    heads = {
        "std": "concat(day, ' ', clock, '.', frac, '00')",
        "slash": "concat(replace(day, '-', '/'), ' ', clock, '.', frac, '00')",
        "dot": "concat(replace(day, '-', '.'), ' ', clock, '.', frac, '00')",
        "six": "concat(day, ' ', clock, '.', frac, '456')",
    }
    svc = "concat('svc', user_id % 3, ' ')"

    def line(head: str, level: str, content: str) -> str:
        return f"concat({svc}, {head}, ' {level} [main] \"', {content}, '\"')"

    family = "\n".join(
        f"WHEN {i} THEN {line(heads[h], 'INFO', _template(t))}"
        for i, (h, t) in enumerate(FAMILY_LINES)
    )
    return {
        "core": line(heads["std"], "INFO", CORE_SQL),
        "family": f"CASE WHEN event_id % 13 = 0 THEN CASE {pick} {family} END END",
        "error": "CASE WHEN event_id % 41 = 0 THEN "
                 + line(heads["std"], "ERROR", "concat('boom ', event_id)") + " END",
        "garbage": "CASE WHEN event_id % 43 = 0 THEN concat('garbage ', event_id) END",
    }


#: Tasks for each split, once there are as many splits as cores.
SPREAD = 4


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, dealt by id over all cores, or over `SPREAD` tasks a split if those are more.

    Splits say nothing of the rows in them: a row group lies in one split whatever its
    size, and a line costs far more to parse than to deal.
    """
    rows = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    cores, splits = spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    return rows.repartition(cores if splits < cores else SPREAD * splits, "event_id")


def event_ms() -> F.Column:
    """Thirty days squeezed into 144 minutes, some rows late by 3 or 9 seconds."""
    micros = ntz_micros("ts") - 1704067200000000
    late = F.expr("CASE WHEN event_id % 97 = 0 THEN 9000 WHEN event_id % 50 = 7 THEN 3000 ELSE 0 END")
    return F.lit(1704067200000).cast("bigint") + (floor_to(micros, 300000) / 300000).cast("bigint") - late


def raw_lines(events: DataFrame) -> DataFrame:
    """(seq, line) of an events table, static or streaming; seq = event_id * 4 + line number."""
    text = format_dt("ms")
    base = (
        events.select("event_id", "user_id", "event_type", event_ms().alias("ms"))
        .withColumn("gid", F.expr(GID_SQL))
        .withColumn("text", text)
        .withColumn("day", F.substring("text", 1, 10))
        .withColumn("clock", F.substring("text", 12, 8))
        .withColumn("frac", F.substring("text", 21, 3))
    )
    lines = F.array(*[F.expr(s) for s in line_sql("div").values()])
    return (
        base.select("event_id", F.posexplode(lines).alias("pos", "line"))
        .where(F.col("line").isNotNull())
        .select((F.col("event_id") * 4 + F.col("pos")).cast("bigint").alias("seq"), "line")
    )


def org_dims(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_user, dim_group, dim_company) derived from the users seen."""
    users = events.select("user_id").distinct()
    dim_user = users.where("user_id % 17 <> 16").select(
        F.expr("CAST(1000 + user_id AS STRING)").alias("uid"),
        F.expr("CASE WHEN user_id % 17 = 15 THEN '' ELSE concat('c', user_id % 5) END").alias("company"),
    )
    dim_group = users.select(F.expr("100 + user_id % 8").alias("g")).distinct().where("g <> 107").select(
        F.expr("CAST(g AS STRING)").alias("gid"), F.expr("concat('c', g % 5)").alias("company")
    )
    dim_company = users.select(F.expr("user_id % 5").alias("n")).distinct().where("n <> 4").select(
        F.expr("concat('c', n)").alias("company"), F.expr("concat('a', n % 3)").alias("agent")
    )
    return dim_user, dim_group, dim_company
