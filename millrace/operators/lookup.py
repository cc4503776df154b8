"""Joins against reference tables whose size is checked before choosing a strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import PipelineConfig

#: Bytes of a table with large rows that may be broadcast.
BROADCAST_BYTES = 32 << 20


def is_small(table: DataFrame, rows: int) -> bool:
    """Whether the table, as prepared, has ``rows`` rows at most. Counting stops there."""
    return table.limit(rows + 1).count() <= rows


def is_light(table: DataFrame, size: str, limit: int) -> bool:
    """Whether the sizes of all rows, given by an expression, sum up to ``limit`` bytes at most."""
    return (table.agg(F.expr(f"sum({size})")).first()[0] or 0) <= limit


def lookup_join(facts: DataFrame, table: DataFrame, on: list[str], config: PipelineConfig, size: str | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join ``facts`` with a reference table that has one row per key.

    A table of up to ``config.broadcast_limit_rows`` rows, counted on what is joined, is broadcast. Where rows may be
    large, ``size`` is an expression for their bytes, and the sum has to be ``max_bytes`` at most too. A larger one is
    joined by shuffle; adaptive execution then splits the facts of a key that holds a large share of them by their size,
    however large that share is.
    """
    small = is_small(table, config.broadcast_limit_rows) and (size is None or is_light(table, size, max_bytes))
    side = F.broadcast(table) if small else table
    side = side.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in side.columns])
    return facts.join(side, F.expr(" AND ".join(f"{k} = _r_{k}" for k in on)), "left").drop(*[f"_r_{k}" for k in on])
