"""Materialising intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="shelfwise-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/shelfwise-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows once as Parquet and continues from that table.

    Later passes read only the columns they need, and a lost executor costs a re-read rather
    than a recomputation of everything before.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a known schema saves a pass over the footers
