"""Time the headline queries on $BENCH_SF_DIR and print one JSON line.

`queries` holds the wall seconds of each query into a no-op sink. Tables that
queries share are written first and timed as `stage_*`; `cold_user_session`
runs the flagship query from raw lines with nothing staged.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from talkgauge.plans.queries import QUERIES
from talkgauge.plans.tables import Tables, forget_tables

HEADLINE = [
    "parse_logs", "project_action", "join_user_org", "online_events_corrected", "user_session",
    "user_state", "group_load_second", "server_group_set", "speaking_record", "user_load_second_server",
    "user_load_second_company", "user_load_hour_server", "user_load_hour_company",
    "speak_load_second_server", "speak_load_hour_company", "server_load_second", "win_late",
    "sink_user_action", "sink_group_event", "sink_company_user_load", "sink_appload", "group_member_set",
    "sink_state_sets",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(Tables(spark, sf_dir).events)  # starts the session
    out: dict[str, float] = {}
    out["cold_user_session"] = timed(lambda: run(QUERIES["user_session"](Tables(spark, sf_dir))))
    tables = Tables(spark, sf_dir)
    for name in ("user_org", "group_org", "action", "machine", "online", "sessions", "group_event", "members",
                 "lives", "speaking"):
        out[f"stage_{name}"] = timed(lambda: getattr(tables, name))
    for kind in ("user", "speak"):
        for entity in ("svc", "company" if kind == "user" else "gcompany"):
            out[f"stage_{kind}_changes_{entity}"] = timed(lambda: getattr(tables, f"{kind}_changes")(entity))
    for name in ("server_seconds",):
        out[f"stage_{name}"] = timed(lambda: getattr(tables, name))
    for name in HEADLINE:
        if name in QUERIES:
            out[name] = timed(lambda: run(QUERIES[name](tables)))
    forget_tables()
    print(json.dumps({
        "metric": "total wall time of headline queries and shared stages",
        "value": round(sum(out.values()), 3), "unit": "sec", "queries": out,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
