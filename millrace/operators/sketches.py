"""Distinct counts over any span of days from small sketches, without the events.

Each day and group keeps one HyperLogLog sketch of a column. Sketches are merged like counts are added, so a span's distinct
number comes from as many rows as it has days and groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Power of two of a sketch's registers; the relative standard error is about 1.04 / sqrt(2 ** REGISTERS).
REGISTERS = 14


def daily_sketches(events: DataFrame, day: str, by: list[str], of: str, registers: int = REGISTERS) -> DataFrame:
    """``day``, ``by``, ``n`` (rows) and ``sketch`` (of the values of ``of`` that are not null)."""
    return events.groupBy(day, *by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(of, F.lit(registers)).alias("sketch"))


def distinct_over(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``n`` and ``about``: rows and estimated distinct values over the days that ``sketches`` holds."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
