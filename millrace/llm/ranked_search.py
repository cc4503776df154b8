"""Ranked lexical search by buckets of norms: exact top-k inner products of impact vectors.

A document is a vector of impacts, integers from how often it holds each query term and from its length; a query is a vector
of its terms' weights, and the score is their inner product. Documents are ordered by the length of their vectors and cut
into buckets. For each bucket and query, three steps follow:

1. Cauchy-Schwarz: no score exceeds the product of the query's length and the bucket's greatest length. If that is below the
   k-th best score known, the query leaves the whole bucket out.
2. Coordinate bounds: over the query's heaviest coordinates the products are added up from the bucket's lists of documents by
   term. The rest is bounded by Cauchy-Schwarz on what is left of both vectors, and by the greatest impact that the bucket has
   in each coordinate left; the smaller bound counts. Documents below the known score are left out.
3. The remaining documents are scored anew in 64-bit integers, which alone decide.

Lengths are taken after dividing the weights between both sides, each coordinate by the root of its weight, so frequent terms
of little weight make no vector long; bounds are widened by more than floating-point numbers can be wrong.

Queries are sent to the documents in blocks of bounded size. A first round over the longest vectors of each batch gives each
query a score that ten documents are known to reach; the second round starts from it in every task, so most tasks give back
few rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.chunks import slices
from millrace.llm.common import staged, table

#: Terms with repeats of the queries that go over the documents together (or one query's).
BLOCK_TERMS = 200_000
#: Documents in a bucket, and buckets at the head of each batch from which the first round takes its scores.
BUCKET, HEAD = 1_024, 1
#: Coordinates are added up until those left can give at most this share of the score that is known.
LEFT = 0.2
#: By how much bounds are widened; the errors of double arithmetic are far smaller.
WIDER = 1 + 1e-9

#: Bytes of a text in UTF-8: digits, small letters and all of other characters stay, A-Z are lower-cased, the others part terms.
_TO_TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).translate(bytes(range(256)).lower())


def terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


class Queries:
    """A block of queries: the terms they have, numbered, and each query's counts."""

    def __init__(self, rows: list[tuple[Any, list[bytes]]]):
        self.ids = [i for i, _ in rows]
        self.number: dict[bytes, int] = {}
        self.counts = [Counter(self.number.setdefault(t, len(self.number)) for t in found) for _, found in rows]


def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_terms: int) -> Iterator[Queries]:
    """The queries in blocks of about ``block_terms`` terms. Rows that repeat an id and a text are one query."""
    block: list[tuple[Any, list[bytes]]] = []
    size = 0
    rows = queries.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    for row in rows.toLocalIterator():
        found = terms(row["text"])
        if block and size + len(found) > block_terms:
            yield Queries(block)
            block, size = [], 0
        block.append((row["id"], found))
        size += len(found)
    if block:
        yield Queries(block)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """id, n (terms with repeats), term (numbers of those that the queries have) and tf of every row with id and text."""
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("n", T.LongType()), T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))])
    shared = docs.sparkSession.sparkContext.broadcast(number)  # bounded by a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, texts in slices(batches, "text"):
            n, found, counts, sizes = [], [], [], []
            for t in texts:
                cut = terms(t)
                at, times = np.unique(np.array([known[x] for x in cut if x in known], np.int32), return_counts=True)
                n.append(len(cut))
                found.append(at)
                counts.append(times)
                sizes.append(len(at))
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(n, pa.int64()), _lists(np.concatenate(found), np.array(sizes)), _lists(np.concatenate(counts).astype(np.int64), np.array(sizes))], schema.names)

    return docs.mapInArrow(run, schema)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _impacts(vectors: DataFrame, documents: int, all_terms: int, roots: np.ndarray) -> DataFrame:
    """id, length, term and impact: the longest vectors of each partition first. Vectors without coordinates are left out."""
    schema = T.StructType([vectors.schema["id"], T.StructField("length", T.DoubleType()), T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("impact", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, tf = (batch.column(c).flatten().to_numpy() for c in ("term", "tf"))
            sizes = np.diff(batch.column("term").offsets.to_numpy()).astype(np.int64)
            m = 100 - 75 + (75 * batch.column("n").to_numpy() * documents) // all_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
            squares = (impact * roots[term]) ** 2
            length = np.sqrt(np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=squares, minlength=len(sizes)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(length), _lists(term, sizes), _lists(impact, sizes)], schema.names)

    return vectors.where(F.size("term") > 0).mapInArrow(run, schema).sortWithinPartitions(F.desc("length"))


class _Bucket:
    """Documents with their coordinates by row and by term."""

    def __init__(self, term: np.ndarray, impact: np.ndarray, sizes: np.ndarray, length: np.ndarray, roots: np.ndarray):
        self.term, self.impact, self.length = term, impact, length
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        order = np.argsort(term, kind="stable")
        self.row = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.value = impact[order] * roots[term[order]]
        self.first = np.searchsorted(term[order], np.arange(len(roots) + 1))
        self.most = np.zeros(len(roots))
        held = np.flatnonzero(np.diff(self.first))
        self.most[held] = np.maximum.reduceat(self.value, self.first[held])

    def live(self, found: np.ndarray, values: np.ndarray, rests: np.ndarray, least: float) -> np.ndarray:
        """Rows whose bound reaches ``least``. ``found`` and ``values`` are the query's coordinates, the heaviest first, and
        ``rests`` the lengths of what is left of it from each on."""
        after = np.append(np.cumsum((values * self.most[found])[::-1])[::-1], 0.0)
        if after[0] * WIDER < least:
            return np.zeros(0, np.int64)
        heavy = int(np.argmax(after <= LEFT * least))
        spans = [slice(self.first[t], self.first[t + 1]) for t in found[:heavy]]
        rows = np.concatenate([self.row[s] for s in spans])
        held = np.concatenate([self.value[s] for s in spans])
        times = np.repeat(values[:heavy], [s.stop - s.start for s in spans])
        n = len(self.length)
        product = np.bincount(rows, weights=held * times, minlength=n)
        left = self.length**2 - np.bincount(rows, weights=held * held, minlength=n)
        rest = rests[heavy] * np.sqrt(np.maximum(left, self.length**2 * 1e-12))
        return np.flatnonzero((product + np.minimum(rest, after[heavy])) * WIDER >= least)

    def scores(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of rows; ``weights`` has a number for each term."""
        sizes = self.ends[rows] - self.starts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.add.reduceat(weights[self.term[at]] * self.impact[at], np.cumsum(sizes) - sizes)


class Search:
    """Scores documents for a block of queries and keeps the k best of each."""

    def __init__(self, counts: list[Counter], weights: np.ndarray, k: int, floors: np.ndarray):
        """``floors``: for each query a score that k documents are known to reach, or 0."""
        self.k, self.roots = k, np.sqrt(weights.astype(float))
        self.floors = np.maximum(floors, 1)
        self.best: list[list[tuple[int, bool, Any]]] = [[] for _ in counts]
        self.whole, self.length, self.focus = [], np.zeros(len(counts)), []
        self.size = len(weights)
        for q, times in enumerate(counts):
            found = np.array([t for t in times if weights[t] > 0], np.int64)
            n = np.array([times[t] for t in found], np.int64)
            value = n * self.roots[found]
            order = np.argsort(-value, kind="stable")
            found, n, value = found[order], n[order], value[order]
            left = np.append(np.cumsum((value**2)[::-1])[::-1], 0.0)
            self.length[q] = math.sqrt(left[0])
            self.focus.append((found, value, np.sqrt(left + 1e-12 * left[0])))
            self.whole.append((found, n * weights[found]))

    def add(self, bucket: _Bucket, ids: pa.Array) -> None:
        greatest = bucket.length.max()
        for q in np.flatnonzero(self.length * greatest * WIDER >= self.floors):
            rows = bucket.live(*self.focus[q], self.floors[q])
            if not len(rows):
                continue
            weights = np.zeros(self.size, np.int64)
            weights[self.whole[q][0]] = self.whole[q][1]
            scores = bucket.scores(rows, weights)
            enough = scores >= self.floors[q]
            rows, scores = rows[enough], scores[enough]
            if len(rows) > self.k:
                enough = scores >= np.partition(scores, -self.k)[-self.k]
                rows, scores = rows[enough], scores[enough]
            if len(rows):
                met = [(-s, i is None, i) for s, i in zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist())]
                self.best[q] = sorted(self.best[q] + met, key=_rank)[: self.k]
                if len(self.best[q]) == self.k:
                    self.floors[q] = max(self.floors[q], -self.best[q][-1][0])


def _rank(found: tuple[int, bool, Any]) -> tuple:
    return found[:2] if found[1] else found


def _round(impacts: DataFrame, counts: list[Counter], weights: np.ndarray, k: int, floors: np.ndarray, head: int | None) -> DataFrame:
    """query (its number), id and score: the k best of each task, from the first ``head`` buckets of each batch or from all."""
    schema = T.StructType([T.StructField("query", T.IntegerType()), impacts.schema["id"], T.StructField("score", T.LongType())])
    shared = impacts.sparkSession.sparkContext.broadcast((counts, weights, floors))  # bounded by a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value[:2], k, shared.value[2])
        for batch in batches:
            for start in range(0, min(batch.num_rows, head * BUCKET) if head else batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                lists = part.column("term")
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                bucket = _Bucket(lists.flatten().to_numpy(), part.column("impact").flatten().to_numpy(), sizes, part.column("length").to_numpy(), search.roots)
                search.add(bucket, part.column("id"))
        rows = [(q, i, -s) for q, best in enumerate(search.best) for s, _, i in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type), pa.array([r[2] for r in rows], pa.int64())], schema.names)

    id_type = to_arrow_type(impacts.schema["id"].dataType)
    return impacts.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_documents(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """query_id, rank (from 1), id_col and score: each query's k highest-scoring documents with a score above 0.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. With N documents that
    have a term, L terms in all, n terms in a document and df documents holding a term, a term weighs
    w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's m is 25 + (75 * n * N) div L, and each occurrence of a term in the query
    adds w * ((1000000000 * tf) div (1000 * tf + 8 * m)). Equal scores go by ascending id, null ids last.

    Null and empty texts have no terms: such documents count nowhere, such queries give no rows. Rows of ``docs`` that repeat
    an id are documents of their own. Rows of ``queries`` that repeat an id and a text are one query; the same id with
    different texts is several. Other columns aren't read; an empty table on either side gives no rows.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark, found = docs.sparkSession, []
    query_type = queries.schema[query_id].dataType
    names = T.StructType([T.StructField("query", T.IntegerType()), T.StructField(query_id, query_type)])
    out = T.StructType([T.StructField(query_id, query_type), T.StructField("rank", T.IntegerType()), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    for block in query_blocks(queries, query_id, query_text, block_terms):
        vectors = staged(_vectors(source, block.number), "vectors")
        told = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
        if not told["terms"]:
            break
        df = np.zeros(len(block.number), np.int64)
        for row in vectors.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():  # terms of the block
            df[row["term"]] = row["count"]
        weights = np.array([weight(told["documents"], int(n)) for n in df], np.int64)
        impacts = staged(_impacts(vectors, told["documents"], told["terms"], np.sqrt(weights.astype(float))), "impacts")
        floors = np.zeros(len(block.ids), np.int64)
        for row in _ranked(_round(impacts, block.counts, weights, k, floors, HEAD), k).where(F.col("rank") == k).select("query", "score").toLocalIterator():
            floors[row["query"]] = row["score"]
        best = _ranked(_round(impacts, block.counts, weights, k, floors, None), k)
        ids = spark.createDataFrame(list(enumerate(block.ids)), names)
        found.append(best.join(F.broadcast(ids), "query").select(query_id, "rank", F.col("id").alias(id_col), "score"))
    if not found:
        return spark.createDataFrame([], out)
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS all_terms FROM cut WHERE len(terms) > 0),
wanted AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM cut) WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, n, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held CROSS JOIN sizes GROUP BY term),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // all_terms))) AS impact
  FROM held JOIN weights USING (term) CROSS JOIN sizes),
scored AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
