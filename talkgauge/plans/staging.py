"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a session in one process may do without that setting and gets a temporary
    folder; on a cluster the folder must be named, as executors share nothing else.
    """
    folder = spark.conf.get(_KEY, None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"set {_KEY} to a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="talkgauge-")
    return _OWN[context.applicationId]


def run_folder(spark: SparkSession) -> str:
    """A new folder name below the shared folder."""
    path = f"{shared_folder(spark)}/talkgauge/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_folders(spark: SparkSession) -> None:
    """Remove the folders that this session has staged; tables read from them are gone."""
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write `rows` as Parquet and read them back, which cuts the lineage."""
    spark = rows.sparkSession
    path = f"{run_folder(spark)}/{name}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries run meanwhile go when each ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
