"""The folder that driver and executors share, and lineage cuts in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on one machine, where it is unset, an own one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    context = spark.sparkContext
    ours = context._jsc.sc().getCheckpointDir()
    if ours.isDefined():
        return ours.get().rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that driver and executors share")
    base = f"file://{tempfile.mkdtemp(prefix='foliant-')}"
    context.setCheckpointDir(base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder once, so that it is read and not made again, also when executors are lost."""
    folder(df.sparkSession)
    return df.checkpoint()
