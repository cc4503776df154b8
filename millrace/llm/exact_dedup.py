"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide.

Each partition files its texts' 64-bit fingerprints in counting quotient filters. A fingerprint's high bits (quotient)
choose a run, its low bits (remainder) are kept in ascending order inside the run, and each remainder has a count, so a
filter loses nothing: quotient and remainder give back the fingerprint. There is a filter for each segment of the
fingerprints' range, with about 250,000 texts each. The filters of a segment meet from all partitions, and merging them
puts their sorted remainders together and adds the counts. A text that a third of all rows have is one remainder with a count in each partition's filter.

Fingerprints counted once are unique texts. The others' texts are grouped by their bytes, so different texts that share a
fingerprint part again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_ROWS, semi_join, staged, table

#: Fingerprints that a task files at once, and rows that a segment of the fingerprints' range has on average.
FILTER_ROWS = 1_000_000
SEGMENT_ROWS = 250_000


def _split(values: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned values as their high part and their low ``low_bits``."""
    if low_bits >= 64:
        return np.zeros(len(values), np.int64), values
    return (values >> np.uint64(low_bits)).astype(np.int64), values & np.uint64((1 << low_bits) - 1)


class CountingQuotientFilter:
    """Distinct values of ``width`` bits with counts, as run ends by quotient, sorted remainders and their counts.

    The high ``log2(len(ends))`` bits are the quotient; run q is remainders[ends[q - 1]:ends[q]].
    """

    def __init__(self, width: int, ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.width, self.ends, self.remainders, self.counts = width, ends, remainders, counts
        self.low_bits = width - (len(ends) - 1).bit_length()

    @classmethod
    def build(cls, values: np.ndarray, counts: np.ndarray, width: int) -> CountingQuotientFilter:
        """Of unsigned values in any order, which may repeat; their counts add up. It has about as many runs as values."""
        found, place = np.unique(values, return_inverse=True)
        counts = np.bincount(place, weights=counts, minlength=len(found)).astype(np.int64)
        quotient_bits = min(width, max(0, len(found) - 1).bit_length())
        quotients, remainders = _split(found, width - quotient_bits)
        return cls(width, np.cumsum(np.bincount(quotients, minlength=1 << quotient_bits)), remainders, counts)

    def values(self) -> np.ndarray:
        quotients = np.repeat(np.arange(len(self.ends), dtype=np.uint64), np.diff(self.ends, prepend=0))
        return self.remainders if self.low_bits >= 64 else quotients << np.uint64(self.low_bits) | self.remainders

    def count(self, value: int) -> int:
        run, low = value >> self.low_bits, np.uint64(value & ((1 << self.low_bits) - 1))
        a, b = int(self.ends[run - 1]) if run else 0, int(self.ends[run])
        at = a + int(np.searchsorted(self.remainders[a:b], low))
        return int(self.counts[at]) if at < b and self.remainders[at] == low else 0

    def to_bytes(self) -> tuple[bytes, bytes, bytes]:
        return np.diff(self.ends, prepend=0).astype("<u4").tobytes(), self.remainders.astype("<u8").tobytes(), self.counts.astype("<i8").tobytes()

    @classmethod
    def from_bytes(cls, width: int, runs: bytes, remainders: bytes, counts: bytes) -> CountingQuotientFilter:
        return cls(width, np.cumsum(np.frombuffer(runs, "<u4").astype(np.int64)), np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<i8"))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter with all values: equal ones become one, with their counts' sum."""
        return cls.build(np.concatenate([f.values() for f in filters]), np.concatenate([f.counts for f in filters]), filters[0].width)


def repeated_fingerprints(rows: DataFrame, bits: int = 64) -> DataFrame:
    """The fingerprints (column fp, long, its low ``bits`` used) that ``rows`` has more than once, with their count n."""
    rows = rows.select("fp")
    segment_bits = min(bits, (rows.count() // SEGMENT_ROWS).bit_length())
    width = bits - segment_bits

    def filed(parts: list[np.ndarray]) -> pa.RecordBatch:
        segments, values = _split(np.sort(np.concatenate(parts)), width)
        numbers, starts = np.unique(segments, return_index=True)
        held = [CountingQuotientFilter.build(v, np.ones(len(v), np.int64), width).to_bytes() for v in np.split(values, starts[1:])]
        columns = [pa.array(numbers, pa.int64()), *(pa.array([f[i] for f in held], pa.binary()) for i in range(3))]
        return pa.RecordBatch.from_arrays(columns, ["segment", "runs", "remainders", "counts"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(parts[-1])
            if n >= FILTER_ROWS:
                yield filed(parts)
                parts, n = [], 0
        if n:
            yield filed(parts)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        high = np.uint64(int(part["segment"].iloc[0]) << width if segment_bits else 0)
        merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(width, *f) for f in zip(part["runs"], part["remainders"], part["counts"])])
        often = merged.counts > 1
        return pd.DataFrame({"fp": (merged.values()[often] | high).view(np.int64), "n": merged.counts[often]})

    segments = rows.mapInArrow(build, "segment long, runs binary, remainders binary, counts binary")
    return segments.groupBy("segment").applyInPandas(merge, "fp long, n long")


def fingerprint(text: Column, bits: int = 64) -> Column:
    """The low ``bits`` of the text's 64-bit hash. Fewer than 64 only make more texts share one."""
    hashed = F.xxhash64(text)
    return hashed if bits == 64 else hashed.bitwiseAND(F.lit((1 << bits) - 1))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. The largest id of a group stays, null ids being smallest.
    If several rows of a group have that id, all of them are marked as kept, as no column tells them apart. Other
    columns aren't read, and an empty table gives no rows.

    Only texts whose fingerprint is repeated are read a second time; up to ``broadcast_rows`` such fingerprints they are
    picked out by a broadcast, beyond that by a shuffle of both sides, with the same result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    light = staged(docs.select(F.col(id_col).alias("id"), fingerprint(text, bits).alias("fp"), F.sha2(text, 256).alias("sha")), "fingerprints")
    repeated = staged(repeated_fingerprints(light, bits).select("fp"), "repeated")
    routed = semi_join(docs.select(F.col(id_col).alias("id"), text.alias("text"), fingerprint(text, bits).alias("fp")), repeated, "fp", broadcast_rows)
    verified = (
        routed.groupBy("fp", "text")  # the bytes decide
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("fp", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
        .where("group_size > 1")
    )
    out = light.join(verified, ["fp", "sha"], "left").withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
    keep = F.when(F.col("group_size") > 1, F.col("keep_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), keep.alias("keep_id"), "group_size", F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
