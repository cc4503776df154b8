"""Helpers that the operators share: the shared folder, staged tables, free column names."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows that a counted table may have at most to be broadcast; a row here is one long, about 64 bytes once hashed.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and all executors share.

    Only a local session, where driver and executors are one process, may lack it and gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remembered(name: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gave in this worker process for the name, made anew only when there is none.

    It is kept outside of the package's own modules, as those may travel with each task and arrive as new copies.
    """
    kept = vars(sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")))
    if name not in kept:
        kept[name] = make()
    return kept[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def semi_join(df: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, a staged table of distinct keys.

    The keys are counted first: up to ``limit`` rows they are broadcast, beyond it both sides are shuffled.
    Both ways give the same rows.
    """
    keys = F.broadcast(keys) if keys.count() <= limit else keys
    return df.join(keys, on, "left_semi")
