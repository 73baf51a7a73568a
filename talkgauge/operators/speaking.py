"""Speaking records: who held a group's microphone, from when to when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgauge.operators.scan import CELL_ROWS, running, with_cells
from talkgauge.schemas import MIC_CLOSE_EVENTS, SPEAKING_COLUMNS

PREVIOUS = ["ts_ms", "seq", "event", "uid", "company", "agent", "dt"]


def mic_rows(group_event: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Accepted microphone rows with `prev`, the accepted row before, and `opener`.

    A row is accepted if no earlier arrival of its group has a later time, so
    the accepted row before it is the latest by (time, arrival) of all arrivals.
    `opener` is the group's first accepted GET_MIC, whose server and
    organisation all records of the group carry.
    """
    rows = group_event.where(F.col("event").isin(["GET_MIC", *MIC_CLOSE_EVENTS]))
    accepted = running(
        with_cells(rows, ["gfull"], "seq", cell_rows), ["gfull"], "seq",
        maxes={"prev": F.struct(*PREVIOUS)},
    ).where(F.col("prev").isNull() | (F.col("prev.ts_ms") <= F.col("ts_ms")))
    return running(
        accepted, ["gfull"], "seq", inclusive=True,
        mins={"opener": F.when(
            F.col("event") == "GET_MIC", F.struct("seq", "svc", "gtype", "gcompany", "gagent")
        )},
    )


def speaking_records(group_event: DataFrame, literal: bool = False,
                     cell_rows: int = CELL_ROWS) -> DataFrame:
    """Records with seq of the closing row, start_ms and end_ms beside the columns.

    A GET_MIC is closed by the group's next accepted row if that is a GET_MIC
    or the same user's release or loss; another user's release discards it.
    `literal`: every accepted row closes the one before it and opens anew.
    """
    prev, opener = F.col("prev"), F.col("opener")
    if literal:
        closes = prev.seq >= opener.seq
    else:
        closes = (prev.event == "GET_MIC") & (
            (F.col("event") == "GET_MIC") | (prev.uid == F.col("uid"))
        )
    return (
        mic_rows(group_event, cell_rows).where(closes)
        .select(
            "seq", opener.svc.alias("svc"), F.col("gfull").alias("gid"),
            *[opener[c].alias(c) for c in ("gtype", "gcompany", "gagent")],
            *[prev[c].alias(c) for c in ("uid", "company", "agent")],
            prev.dt.alias("tvstart"), F.col("dt").alias("tvend"), "event",
            prev.ts_ms.alias("start_ms"), F.col("ts_ms").alias("end_ms"),
        )
        .select("seq", *SPEAKING_COLUMNS, "start_ms", "end_ms")
    )
