"""Cutting lineage and staging tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.  Where it is not set, a temporary one in local mode (tests), else an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir", "")
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="vigil-shared-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage, so that Spark now removes the shuffle files that no table refers to any more.

    Spark does this by itself every half hour (spark.cleaner.periodicGC.interval); a job of many short rounds writes more by then.
    """
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """df written as Parquet to the shared folder and read back: compressed, and read again without being computed again.  free: release() then."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    if free:
        release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
