"""Organisation dimension: who belongs to which company and agent."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgauge.operators.lookup import lookup_join
from talkgauge.schemas import DIM_COMPANY_SCHEMA, DIM_GROUP_SCHEMA, DIM_USER_SCHEMA


def read_dims(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_user, dim_group, dim_company) from Parquet tables of those names."""
    return tuple(
        spark.read.schema(schema).parquet(os.path.join(folder, name))
        for name, schema in (
            ("dim_user", DIM_USER_SCHEMA),
            ("dim_group", DIM_GROUP_SCHEMA),
            ("dim_company", DIM_COMPANY_SCHEMA),
        )
    )


def user_org(dim_user: DataFrame, dim_company: DataFrame, **limits) -> DataFrame:
    """uid -> company, agent. Users with no company are left out."""
    users = dim_user.where(F.col("company").isNotNull() & (F.col("company") != ""))
    return lookup_join(users, dim_company, "company", "left", **limits).select(
        "uid", "company", "agent"
    )


def group_org(dim_group: DataFrame, dim_company: DataFrame, **limits) -> DataFrame:
    """gid -> gcompany, gagent. An empty company is kept, a null one is not."""
    groups = dim_group.where(F.col("company").isNotNull())
    return lookup_join(groups, dim_company, "company", "left", **limits).select(
        "gid", F.col("company").alias("gcompany"), F.col("agent").alias("gagent")
    )
