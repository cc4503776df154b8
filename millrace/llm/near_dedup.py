"""Near duplicates by b-bit MinHash.

Each distinct shingle set gets minima of many permutations. Bands of whole minima give candidates; of each minimum only
two bits of a hash of it are kept, packed into longs, 32 minima each. The minimum's own low bits would not do: they depend
on the low bits of its shingle alone, so unequal minima would be equal there by more or less than chance. For a candidate pair the share of equal two-bit fields,
counted by bit operations and corrected for the quarter of fields that are equal by chance, estimates the similarity.
Pairs whose estimate lies six standard errors below the threshold are let go; all others are verified on the full
sets. Sets of fewer than 32 shingles have no estimate, and their pairs are all verified.

With 48 bands of 7 minima a pair at a similarity of 0.8 shares no band with a probability of 1.2e-5, and a pair at 0.9 of
5e-14. If both sets have an estimate, one of 0.8 lies below the margin with a probability of about 1e-9 by the normal law.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import shingles
from millrace.llm.chunks import small_slices
from millrace.llm.common import BROADCAST_ROWS, free_name, semi_join, staged, table
from millrace.llm.links import linked

BANDS, ROWS = 48, 7
#: Minima of which two bits are kept, a multiple of 32.
SIGNED = 320
#: Rows and characters of text that are worked on at once.
TOGETHER, SLICE = 500, 500_000
#: Sets of fewer shingles have no packed signature.
LEAST_SIGNED = 32


def packed(found: np.ndarray) -> np.ndarray:
    """texts x (SIGNED / 32) longs: two bits of a hash of each of the first SIGNED minima and its number."""
    numbered = found[:, :SIGNED].astype(np.uint64) | np.arange(1, SIGNED + 1, dtype=np.uint64) << np.uint64(32)
    low = (shingles.mixed(numbered) & np.uint64(3)).reshape(len(found), SIGNED // 32, 32)
    return np.bitwise_or.reduce(low << np.arange(0, 64, 2, dtype=np.uint64), axis=2).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """The similarity that two packed signatures tell: share of equal fields without those equal by chance."""
    ones = F.lit(0x5555555555555555)
    equal = F.lit(SIGNED)
    for i in range(SIGNED // 32):
        x = a[i].bitwiseXOR(b[i])
        equal = equal - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))
    return (equal / F.lit(SIGNED) - 0.25) / 0.75


def likely(percent: int):
    """Whether two signatures may belong to a pair at the threshold: six standard errors are allowed for. Without a
    signature they may."""
    p = 0.25 + 0.75 * percent / 100
    floor = percent / 100 - 6 * (p * (1 - p) / SIGNED) ** 0.5 / 0.75
    return lambda a, b: F.coalesce(estimate(a, b) >= F.lit(floor), F.lit(True))


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """id, hash of the text, n (size of the set), key, bands and sig of every row."""
    a, b = shingles.permutations(BANDS * ROWS)
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("id", docs.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("hash", "n", "key")), T.StructField("bands", longs), T.StructField("sig", longs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in small_slices(batches, "text", TOGETHER, SLICE):
            hashes, many = shingles.shingle_hashes(texts, k)
            sets = shingles.shingle_sets(hashes, many)
            n = np.array([len(s) for s in sets], np.int64)
            found = shingles.minima(np.concatenate(sets), n, a, b)
            none = n == 0
            lists = []
            for values, without in ((shingles.band_keys(found, BANDS, ROWS), none), (packed(found), n < LEAST_SIGNED)):
                ends = np.arange(len(n) + 1, dtype=np.int32) * values.shape[1]
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=pa.array(without)))
            keys = pa.array([shingles.set_key(s) for s in sets], pa.int64(), mask=none)
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("hash"), pa.array(n), keys, *lists], [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """key and shingles (array of long) of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in small_slices(batches, "text", TOGETHER, SLICE):
            sets = shingles.shingle_sets(*shingles.shingle_hashes(part, k))
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([shingles.set_key(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values)], ["key", "shingles"])

    return texts.mapInArrow(run, "key long, shingles array<long>")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    documents: a row per row of ``docs`` with id, hash (of its text), n_shingles, key (of its shingle set), component_id
    and kept. links: (a, b), the linked pairs of different sets by key that were needed to connect the components.

    A document's set are its distinct shingles of k lower-cased words; with fewer words the whole sequence is one. Two
    documents are linked when 100 * intersection >= percent * union. component_id is the smallest id that links lead to,
    its own included, and the row with that id is kept. Null, empty and blank texts have an empty set and are linked with
    nothing. A row with a null id takes part; it is kept only where no row of its component has an id. Rows that repeat an
    id and a text are one document and share their verdict. Other columns aren't read; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    signed = staged(_signed(source, k), "signed")
    nodes = signed.where("n > 0")
    by_text = nodes.groupBy("key").agg(F.min("hash").alias("hash"))  # a text for each set

    def sets_of(keys: DataFrame) -> DataFrame:
        wanted = staged(by_text.join(keys, "key", "left_semi").select("hash").distinct(), "wanted")
        texts = semi_join(source.select("hash", "text"), wanted, "hash", broadcast_rows).dropDuplicates(["hash"])
        return _sets(texts.select("text"), k)

    links, groups = linked(nodes, sets_of, percent, likely(percent))
    labelled = signed.select("id", "hash", "n", "key").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest = labelled.where("component is not null").groupBy("component").agg(F.min("id").alias("smallest"))
    found = labelled.join(smallest, "component", "left")
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id"))
    documents = found.select(F.col("id").alias(id_col), "hash", F.col("n").alias("n_shingles"), "key", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
    return documents, links


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows and columns of ``docs`` without near duplicates: of each component the row with the smallest id stays."""
    documents, _ = near_duplicates(docs, k, percent, id_col, text_col, broadcast_rows)
    gone = staged(documents.where(~F.col("kept")).select(F.col(id_col).alias("gone_id"), F.col("hash").alias("gone_hash")).distinct(), "gone")
    small = gone.count() <= broadcast_rows
    hash_name = free_name(docs, "__hash")
    rows = docs.withColumn(hash_name, F.xxhash64(text_col))
    return rows.join(F.broadcast(gone) if small else gone, rows[id_col].eqNullSafe(gone["gone_id"]) & (rows[hash_name] == gone["gone_hash"]), "left_anti").drop(hash_name)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)
    return documents.select("doc_id", "n_shingles", "component_id", "kept")
