"""MinHash fingerprints, compared with an edited text's and the next document's.

A fingerprint is the smallest value of each of 128 universal hash permutations over a text's distinct five-word shingles,
and the share of equal values in two fingerprints estimates the Jaccard similarity of the texts. Similar documents are
found by joining bands of the fingerprints in Spark and verifying the similarity on the full sets.

The next document is the one that follows in descending id. Documents are dealt into ranges of ids by quantiles and sorted
inside each; the first document of a range also goes, as a guest, to the end of the range before. So each task sees every
document's successor, the texts are shuffled once, and no range is larger than its share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import shingles
from millrace.llm.chunks import slices
from millrace.llm.common import BROADCAST_ROWS, semi_join, staged, table
from millrace.llm.links import linked

PERMUTATIONS = 128
WORDS = 5
#: Rows of a band: 32 bands of 4 miss a pair at a similarity of 0.8 with a probability of 5e-8.
BAND_ROWS = 4


def signatures(texts: list[str]) -> np.ndarray:
    """texts x PERMUTATIONS minima. Without words all are the largest value; such texts are alike."""
    hashes, many = shingles.shingle_hashes(texts, WORDS)
    return shingles.minima(hashes, many, *shingles.permutations(PERMUTATIONS))


def fingerprint(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one == other).mean(axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint (hexadecimal) of every row; null texts count as empty, other columns aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array([fingerprint(s) for s in signatures(texts)])], ["id", "fingerprint"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def similar_documents(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(documents, links): a row per row with id, set_id (its shingle set) and class_id (the smallest set linked), and the
    verified links (a, b) between sets that connect the classes.

    Bands of the fingerprints are joined in Spark and the Jaccard similarity is verified on the full sets. Texts without
    words have a null set and class.
    """
    a, b = shingles.permutations(PERMUTATIONS)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("hash", T.LongType()), T.StructField("key", T.LongType())])
    schema.add("bands", T.ArrayType(T.LongType())).add("sig", T.ArrayType(T.LongType()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            hashes, many = shingles.shingle_hashes(texts, WORDS)
            keys = [shingles.set_key(s) if len(s) else None for s in shingles.shingle_sets(hashes, many)]
            bands = shingles.band_keys(shingles.minima(hashes, many, a, b), PERMUTATIONS // BAND_ROWS, BAND_ROWS)
            lists = pa.array([None if k is None else v for k, v in zip(keys, bands)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("hash"), pa.array(keys, pa.int64()), lists, pa.nulls(len(keys), pa.list_(pa.int64()))], schema.names)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            found = shingles.shingle_sets(*shingles.shingle_hashes(texts, WORDS))
            yield pa.RecordBatch.from_arrays([pa.array([shingles.set_key(s) for s in found], pa.int64()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["key", "shingles"])

    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    signed = staged(source.mapInArrow(sign, schema), "signed")
    nodes = signed.where("key is not null")
    by_text = nodes.groupBy("key").agg(F.min("hash").alias("hash"))

    def sets_of(keys: DataFrame) -> DataFrame:
        wanted = staged(by_text.join(keys, "key", "left_semi").select("hash").distinct(), "wanted")
        texts = semi_join(source.select("hash", "text"), wanted, "hash", broadcast_rows).dropDuplicates(["hash"])
        return texts.select("text").mapInArrow(sets, "key long, shingles array<long>")

    links, groups = linked(nodes, sets_of, percent, lambda one, other: F.lit(True))
    documents = signed.select("id", "key").join(groups.withColumnRenamed("node", "key"), "key", "left")
    return documents.select(F.col("id").alias(id_col), F.col("key").alias("set_id"), F.coalesce("component", "key").alias("class_id")), links


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document in descending id; the first document follows the last one. Null ids come last, rows of one id are ordered by
    their text's hash, and null texts count as empty. A single row is its own next document. Texts without words have
    one fingerprint, so their likeness is 1. An empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = source.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)])).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        """From 0 for null and the smallest ids up."""
        found = np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "left") + 1
        return pd.Series(np.where(ids.isna(), 0, found))

    firsts = source.select(range_of("id").alias("range"), F.struct("id", "hash").alias("first")).groupBy("range").agg(F.max("first").alias("first")).orderBy("range").collect()  # a row per range
    before = [r["range"] for r in firsts[1:]] + [r["range"] for r in firsts[:1]]
    guests = [(r["first"]["id"], r["first"]["hash"], b) for r, b in zip(firsts, before)]

    guest = F.broadcast(spark.createDataFrame(guests, "guest_id long, guest_hash long, range int"))  # a row per range
    visiting = source.join(guest, F.col("id").eqNullSafe(F.col("guest_id")) & (F.col("hash") == F.col("guest_hash")))
    visiting = visiting.dropDuplicates(["range"]).select("range", F.lit(1).alias("guest"), "id", "hash", "text")
    dealt = source.select(range_of("id").alias("range"), F.lit(0).alias("guest"), "id", "hash", "text").unionByName(visiting)
    dealt = dealt.repartition(ranges // 2, "range").sortWithinPartitions("range", "guest", F.col("id").desc_nulls_last(), F.col("hash").desc())

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [c.split()[0] for c in schema.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, int | None, str]] = []
        for rows, texts in slices(batches, "text"):
            part = waiting + list(zip(rows.column("range").to_pylist(), rows.column("guest").to_pylist(), rows.column("id").to_pylist(), texts))
            waiting = part[-1:]
            pairs = [i for i in range(len(part) - 1) if not part[i][1] and part[i][0] == part[i + 1][0]]
            if not pairs:
                continue
            own = [p[3] for p in part]
            edited = []
            for i in pairs:
                k = len(own[i]) // 3
                edited.append(own[i][: len(own[i]) - k] + own[i + 1][:k])
            signed, signed_edited, at = signatures(own), signatures(edited), np.array(pairs)
            columns = [
                pa.array([part[i][2] for i in pairs], pa.int64()),
                pa.array([len(own[i]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
                pa.array([fingerprint(s) for s in signed[at]]),
                pa.array([fingerprint(s) for s in signed_edited]),
                pa.array(likeness(signed[at], signed_edited)),
                pa.array(likeness(signed[at], signed[at + 1])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return dealt.select("range", "guest", "id", "text").mapInArrow(compare, schema).withColumnRenamed("id", id_col)


def op7_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents"))
