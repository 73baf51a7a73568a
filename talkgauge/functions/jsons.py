"""Reports and events as JSON text; null fields are left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgauge.schemas import ACTION_JSON_FIELDS


def json_out(fields: dict[str, Column | str]) -> Column:
    """JSON object with the given field names, in order."""
    return F.to_json(
        F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()])
    )


def json_in(text: Column, schema: T.StructType) -> Column:
    """Struct read from JSON text; fields not in `schema` are ignored."""
    return F.from_json(text, schema)


def action_json() -> Column:
    return json_out(ACTION_JSON_FIELDS)


ACTION_JSON_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ACTION_JSON_FIELDS])
