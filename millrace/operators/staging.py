"""Tables that a job writes and reads again: computed once, and safe when an executor is lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder; only a local session may do without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and spark.sparkContext.master.startswith("local"):
        shared = tempfile.gettempdir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written to the shared folder."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
