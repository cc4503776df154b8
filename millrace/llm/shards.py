"""Contiguous shards of near equal byte size, from prefix sums over per-partition totals (DataFrame operations only).

Rows are laid out by id in range partitions, once, as a staged table of narrow rows. Each partition's bytes and rows are
totalled; the running sum of those totals (one row per partition) tells where each partition starts, and a running sum
inside the partition where each row starts. A row goes to the shard in whose equal part of all bytes its middle lies, so
shards are contiguous in id order and differ from the target by one row's bytes at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, table


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard (from 0) and slot (place in its shard, from 0).

    A row's size is its text's UTF-8 bytes (null: none) plus 1, so empty and null texts count too. Rows are ordered by id,
    null ids first; rows of one id by their text's hash. Equal rows are interchangeable; their order among each other is
    arbitrary, and they are spread over several partitions if they are many. No rows give no shards; with fewer rows than
    shards some shards are empty. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("crc"),
        F.xxhash64(text_col).alias("tie"),
        F.spark_partition_id().alias("source_part"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("source_part")]
    laid = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "layout")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        laid.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        laid.withColumns({"upto": F.sum("size").over(inside), "nth": F.row_number().over(Window.partitionBy("part").orderBy(*order))})
        .join(F.broadcast(parts), "part")  # a row per partition
        .select(
            "id",
            "size",
            "crc",
            F.least(
                F.lit(shards - 1),
                F.expr(f"((2 * (bytes_before + upto) - size) * {shards}) div (2 * all_bytes)").cast("int"),
            ).alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # a row per shard
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
