"""What came before a row of its key: last values, sessions and running counts, without a task that holds a whole key.

A window by key puts all rows of a key into one task. Here a key with very many rows is cut into slices of time first: its rows
are counted by short stretches of time, and the running count over those says which slice a stretch belongs to. Windows run
by key and slice. What a slice leaves to the next ones (its last value, its count) is one row, a prefix over a key's slices
carries it forward, and the rows of a slice that need it get it by a join with that small table. Keys with few rows are one
slice each and are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.operators.lookup import lookup_join
from millrace.operators.staging import staged

#: Rows of a slice, about, and the length of the stretches in which rows are counted, in the unit of the time column.
SLICE_ROWS, STRETCH = 1_000_000, 1_000

KEY, SLICE = "_key", "_slice"


@dataclass(frozen=True)
class Ordered:
    """Rows of keys in the order of ``at`` (a long) and further columns, with the slice of each row."""

    rows: DataFrame
    order: list[str]
    config: PipelineConfig
    hot: bool

    @property
    def by(self) -> list[str]:
        return [KEY, SLICE] if self.hot else [KEY]


def ordered(rows: DataFrame, key: str, at: str, order: list[str], config: PipelineConfig, slice_rows: int = SLICE_ROWS, stretch: int = STRETCH) -> Ordered:
    """``rows``, written once, with their slices.

    Rows go by ``at`` and then ``order``, nulls first; where that leaves ties, their order is open. Null keys are one key.
    A slice has about ``slice_rows`` rows; rows within one stretch of time always share it.
    """
    rows = staged(rows.withColumn(KEY, F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))), "rows")
    heavy = staged(rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > slice_rows).select(KEY), "heavy")
    if heavy.isEmpty():
        return Ordered(rows, [at, *order], config, False)
    # the earliest stretch also holds rows without a time
    timed = rows.withColumn("_stretch", F.coalesce(F.floor(F.col(at) / stretch), F.lit(-(2**62))))
    few = heavy.count() <= config.broadcast_limit_rows  # at most one key for each slice_rows rows
    counted = timed.join(F.broadcast(heavy) if few else heavy, KEY, "left_semi").groupBy(KEY, "_stretch").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(KEY).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1))
    slices = staged(counted.select(KEY, "_stretch", F.floor(F.coalesce(before, F.lit(0)) / slice_rows).alias(SLICE)), "slices")
    cut = lookup_join(timed, slices, [KEY, "_stretch"], config).withColumn(SLICE, F.coalesce(SLICE, F.lit(0))).drop("_stretch")
    return Ordered(staged(cut, "sliced"), [at, *order], config, True)


def _from_earlier(found: Ordered, summary: Column, prefix, out: str) -> DataFrame:
    """(key, slice, out): ``prefix`` over the summaries of a key's earlier slices, of keys with several."""
    slices = found.rows.groupBy(KEY, SLICE).agg(summary.alias("_left"))
    earlier = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn(out, prefix("_left").over(earlier)).where(F.col(out).isNotNull())
    return staged(carried.select(KEY, SLICE, out), "carried")


def with_last(found: Ordered, value: str, out: str, inclusive: bool = True) -> DataFrame:
    """All rows plus ``out``: the last ``value`` that is not null among the rows of the key up to each one, or before it."""
    here = Window.partitionBy(*found.by).orderBy(*found.order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = found.rows.withColumn(out, F.last(value, ignorenulls=True).over(here))
    if found.hot:
        last = F.max(F.when(F.col(value).isNotNull(), F.struct(*found.order, F.col(value).alias("_value"))))
        carried = _from_earlier(found, last, F.max, "_before")
        rows = lookup_join(rows, carried, [KEY, SLICE], found.config).withColumn(out, F.coalesce(out, "_before._value")).drop("_before")
    return rows.drop(KEY, SLICE)


def with_running(found: Ordered, amount: str, out: str) -> DataFrame:
    """All rows plus ``out``: the sum of ``amount`` over the rows of the key up to each one."""
    here = Window.partitionBy(*found.by).orderBy(*found.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = found.rows.withColumn(out, F.sum(amount).over(here))
    if found.hot:
        carried = _from_earlier(found, F.sum(amount), F.sum, "_before")
        rows = lookup_join(rows, carried, [KEY, SLICE], found.config)
        rows = rows.withColumn(out, F.coalesce(F.col(out) + F.col("_before"), F.col(out), F.col("_before"))).drop("_before")
    return rows.drop(KEY, SLICE)


def with_sessions(
    rows: DataFrame, key: str, at: str, order: list[str], gap: int, config: PipelineConfig, out: str = "session", slice_rows: int = SLICE_ROWS, stretch: int = STRETCH
) -> DataFrame:
    """All rows plus ``out``: the number of the key's session, from 1. A row starts one if it is the key's first or comes more
    than ``gap`` after the one before. Rows without a time come first and share a session."""
    found = ordered(rows, key, at, order, config, slice_rows, stretch)
    before = with_last(found, at, "_previous", inclusive=False)
    first = F.col("_previous").isNull() & F.col(at).isNotNull()
    starts = before.withColumn("_start", (F.coalesce(first, F.lit(False)) | F.coalesce(F.col(at) - F.col("_previous") > gap, F.lit(False))).cast("long")).drop("_previous")
    counted = with_running(ordered(starts, key, at, order, config, slice_rows, stretch), "_start", out)
    return counted.withColumn(out, F.greatest(F.col(out), F.lit(1))).drop("_start")


def with_rank(rows: DataFrame, by: str, config: PipelineConfig, out: str = "rank") -> DataFrame:
    """All rows plus ``out``: one more than the rows with a greater ``by``, over the whole table; nulls come last.

    Equal values are one row before anything is sorted. The distinct values are range-partitioned, what each partition adds up
    to is carried to the ones after it, and inside a partition the counts run on: no task sorts them all.
    """
    rows = staged(rows, "rows")
    counts = rows.groupBy(F.col(by).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.repartitionByRange(F.col("_value").desc_nulls_last()).withColumn("_part", F.spark_partition_id())
    parts = staged(parts, "values")
    before, offsets = 0, []
    for r in parts.groupBy("_part").agg(F.sum("_n").alias("n")).orderBy("_part").toLocalIterator():  # a row for each partition
        offsets.append((r["_part"], before))
        before += r["n"]
    above = Window.partitionBy("_part").orderBy(F.col("_value").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    spark = rows.sparkSession
    ranked = parts.join(F.broadcast(spark.createDataFrame(offsets, "_part int, _before long")), "_part")
    ranked = ranked.select("_value", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + F.col("_before") + 1).alias(out))
    ranked = staged(ranked, "ranks")
    few = ranked.limit(config.broadcast_limit_rows + 1).count() <= config.broadcast_limit_rows
    return rows.join(F.broadcast(ranked) if few else ranked, rows[by].eqNullSafe(ranked["_value"]), "left").drop("_value")
