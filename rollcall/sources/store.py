"""Intermediate tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. A folder of our own is made only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="rollcall-")


class Store:
    """Writes a DataFrame as Parquet and reads it back.

    This does three things at once: the work so far is not repeated by each of several readers, a lost executor
    does not send the job back to the source files, and the planner learns the true size of the table, so that it
    broadcasts the table in a later join only when it is small enough (`spark.sql.autoBroadcastJoinThreshold`) and
    shuffles it otherwise. Every kept table gets a folder of its own, so that a DataFrame over an earlier one stays
    valid; all lie under `root`, which can be removed when the job is over.
    """

    def __init__(self, spark: SparkSession, name: str = "work"):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/rollcall/{spark.sparkContext.applicationId}/{name}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        path = self.path(f"{table}-{uuid.uuid4().hex[:12]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
