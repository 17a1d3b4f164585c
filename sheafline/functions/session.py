"""Session helpers: where shared scratch data goes, and cutting long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="sheafline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and cuts the lineage."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
