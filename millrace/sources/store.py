"""The table of atomic events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.model import ATOMIC_COLUMNS


def write_atomic(events: DataFrame, path: str, mode: str = "append", gather: bool = True) -> None:
    """Parquet partitioned by day and event name.

    Rows are gathered by day and name first, so a folder gets few files however many tasks there are. Adaptive execution
    cuts a large day and merges small ones by their measured size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so
    a day that holds most rows is written by many tasks. Without ``gather`` every task writes its own files.
    """
    table = events.select(*ATOMIC_COLUMNS).withColumn("event_date", F.to_date("tstamp"))
    if gather:
        table = table.hint("rebalance", "event_date", "event_name")
    table = table.sortWithinPartitions("event_date", "event_name")
    # The event name stays a column of the file as well as a folder.
    table.withColumn("name", F.col("event_name")).write.mode(mode).partitionBy("event_date", "name").parquet(path)


def read_atomic(spark: SparkSession, path: str) -> DataFrame:
    """The stored events; filter on ``event_date`` and ``name`` to skip folders."""
    return spark.read.parquet(path)


def register_atomic(events: DataFrame, name: str = "atomic") -> None:
    """Make the events available to ``spark.sql``."""
    events.createOrReplaceTempView(name)


def write_bucketed(events: DataFrame, table: str, path: str, by: str = "network_userid", buckets: int = 64, mode: str = "overwrite") -> DataFrame:
    """Events as the table ``table`` at ``path``, in buckets by user and sorted inside them.

    Tables with the same number of buckets are joined and grouped by user where their buckets lie: no shuffle. ``buckets`` is
    about the stored bytes divided by what a task should read; each task reads one bucket of all files.
    A user with a large share of the events fills a bucket alone; where there is one, join by shuffle instead.
    """
    parted = events.repartition(buckets, by)  # one file a bucket, not one for each task and bucket
    parted.write.mode(mode).option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    return events.sparkSession.table(table)


def write_wide(flat: DataFrame, path: str, mode: str = "append") -> None:
    """Wide rows (``shred.flatten_atomic``) with the event's data and each context as a VARIANT column, by day and event name.

    Parquet keeps the paths that a file's values have in common as columns of their own (``spark.sql.variant.writeShredding``,
    on by default), so ``variant_get`` of one path of one context reads that column and no other. Text that is not JSON is null.
    """
    data = [c for c in flat.columns if c == "event" or c.startswith("context_")]
    table = flat.withColumns({c: F.try_parse_json(c) for c in data}).withColumns({"event_date": F.to_date("tstamp"), "name": F.col("event_name")})
    table.hint("rebalance", "event_date", "name").write.mode(mode).partitionBy("event_date", "name").parquet(path)
