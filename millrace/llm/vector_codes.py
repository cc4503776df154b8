"""Vector code compression: product quantisation in integers, with distances by a lexicographic trie over distinct parts.

A vector's components become integers and are cut into equal consecutive parts; each part position has a codebook of up to
256 entries, and a part is replaced by the index of the nearest entry. The codebooks are trained on all vectors: each round
assigns every distinct part, weighted by how many vectors have it, and moves each entry to the floored mean of its parts.

Distinct parts meet in lexicographic order, so they are the leaves of a trie with one component a level. A depth-first
traversal carries the vector of the squared distances to all entries, as far as they are known from the components of the
path: parts with a common prefix share it, and each component adds one row of a table (value x entry). Subtrees of a few
hundred leaves are walked level by level, a row for each distinct prefix. At the leaves the smallest distance gives the
code, and the leaf's weight goes to the entry's sums.

A codebook is bounded by 256 entries, so rounds send and gather a bounded table whatever the input. Spark range-partitions
the distinct parts, which keeps common prefixes together and needs no task that holds all copies of a vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import BROADCAST_ROWS, free_name, staged, table

#: A component x becomes floor(SCALE * x).
SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Leaves of a subtree that is walked level by level, and vectors whose parts are looked at together.
LEAVES, VECTORS = 256, 8_192


def whole_components(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors and their components as integers: not null, without null or non-finite components."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    offsets = column.offsets.to_numpy()
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null as nan
    there = column.is_valid().to_numpy(zero_copy_only=False)
    at, out = [], []
    for i in np.flatnonzero(there):
        x = flat[offsets[i] : offsets[i + 1]]
        if np.isfinite(x).all():
            at.append(i)
            out.append(x)
    return np.array(at, np.int64), out


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    found = np.floor(vectors * scale)
    if found.size and 4 * np.abs(found).max() ** 2 * found.shape[-1] >= 2.0**62:
        raise ValueError("components are too large: squared distances of the vectors don't fit 64 bits")
    return found.astype(np.int64)


class Trie:
    """The squared distances of ascending distinct ``parts`` (parts x components) to ``entries`` (entries x components)."""

    def __init__(self, parts: np.ndarray, entries: np.ndarray, leaves: int = LEAVES):
        self.parts, self.leaves = parts, leaves
        self.nearest = np.zeros(len(parts), np.int64)
        self.distance = np.zeros(len(parts), np.int64)
        differ = parts[1:] != parts[:-1]
        # components that a part shares with the one before it
        self.shared = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), parts.shape[1])]) if len(parts) else np.zeros(0, np.int64)
        reach = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
        self.number = np.int32 if 4 * reach * reach * parts.shape[1] < 2**31 else np.int64
        self.rows, self.steps = [], []  # for each component: each part's row in the table value x entry
        for d in range(parts.shape[1]):
            values, at = np.unique(parts[:, d], return_inverse=True)
            self.rows.append(at)
            self.steps.append(((values[:, None] - entries[:, d]) ** 2).astype(self.number))
        self._visit(0, len(parts), 0, np.zeros((1, len(entries)), self.number))

    def _visit(self, lo: int, hi: int, depth: int, above: np.ndarray) -> None:
        """Leaves lo to hi share ``depth`` components, whose distances are ``above``."""
        todo = [(lo, hi, depth, above)]  # a stack: large subtrees first go down to their children
        while todo:
            lo, hi, depth, above = todo.pop()
            if hi - lo <= self.leaves or depth == self.parts.shape[1]:
                self._walk(lo, hi, depth, above)
                continue
            cuts = [lo, *(lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] <= depth)), hi]
            start = lo  # children in a row that are small enough together are one walk from here
            for a, b in zip(cuts, cuts[1:]):
                if b - a > self.leaves:
                    if start < a:
                        todo.append((start, a, depth, above))
                    todo.append((a, b, depth + 1, above + self.steps[depth][self.rows[depth][a]]))
                    start = b
                elif b - start > self.leaves:
                    todo.append((start, a, depth, above))
                    start = a
            if start < hi:
                todo.append((start, hi, depth, above))

    def _walk(self, lo: int, hi: int, depth: int, above: np.ndarray) -> None:
        if lo == hi:
            return
        shared = self.shared[lo:hi].copy()
        shared[0] = -1
        node = np.zeros(hi - lo, np.int64)  # each leaf's prefix at this level
        for d in range(depth, self.parts.shape[1]):
            new = shared <= d  # leaves with which a prefix starts
            first = np.flatnonzero(new)
            step = self.steps[d][self.rows[d][lo + first]]
            if len(first) == len(above):
                above = np.add(above, step, out=step)
            else:
                above = np.add(above[node[first]], step, out=step)
            node = np.cumsum(new) - 1
        best = above.argmin(axis=1)  # of equal ones the first
        self.nearest[lo:hi] = best[node]
        self.distance[lo:hi] = above[np.arange(len(best)), best][node]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(column) else np.zeros((0, width), np.int64)


def _usable(batch: pa.RecordBatch, vector: str, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and integer components of the batch's vectors of this length."""
    at, found = whole_components(batch.column(vector))
    fits = [i for i, x in enumerate(found) if len(x) == width]
    return at[fits], _integers(np.array([found[i] for i in fits]).reshape(-1, width), scale)


def first_vectors(vectors: DataFrame, id_col: str, vector_col: str, entries: int, parts: int, scale: int) -> np.ndarray:
    """Components of the usable vectors with the smallest ids, ``entries`` rows at most; equal ids by their vectors, null ids
    last. Their length is that of the first one that can be cut into ``parts``."""
    v = F.col("vector")
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = source.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    ordered = [F.col("id").asc_nulls_last(), v]
    first = usable.orderBy(*ordered).limit(1).collect()
    if not first:
        return np.zeros((0, 0), np.int64)
    width = len(first[0]["vector"])
    rows = usable.where(F.size(v) == width).orderBy(*ordered).limit(entries).collect()
    return _integers(np.array([r["vector"] for r in rows]), scale)


def train(vectors: DataFrame, id_col: str, vector_col: str, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """parts x entries x components: the codebooks after ``rounds`` rounds over all usable vectors.

    Each position's codebook starts as the parts of the vectors with the smallest ids. An entry without parts stays.
    Without any usable vector there is no entry.
    """
    first = first_vectors(vectors, id_col, vector_col, entries, parts, scale)
    width = first.shape[1] if first.size else 0
    books = np.stack(np.split(first, parts, axis=1)) if width else np.zeros((parts, 0, 0), np.int64)
    if not width:
        return books
    size = width // parts
    spark = vectors.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = _usable(batch, "vector", width, scale)
            for p, part in enumerate(np.split(found, parts, axis=1)):
                distinct, n = np.unique(part, axis=0, return_counts=True)  # copies in a batch are one row
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * size), pa.array(distinct.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), p, np.int32)), lists, pa.array(n.astype(np.int64))], ["pos", "part", "n"])

    met = staged(vectors.select(F.col(vector_col).alias("vector")).mapInArrow(cut, "pos int, part array<long>, n long"), "met")
    tasks = max(spark.sparkContext.defaultParallelism, met.rdd.getNumPartitions())
    distinct = met.repartitionByRange(tasks, "pos", "part").groupBy("pos", "part").agg(F.sum("n").alias("n"))
    distinct = staged(distinct.sortWithinPartitions("pos", "part"), "distinct")

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)  # bounded by entries x components

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = shared.value
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                pos, found, n = batch.column("pos").to_numpy(), _matrix(batch.column("part"), size), batch.column("n").to_numpy()
                for p in np.unique(pos):
                    mine = np.flatnonzero(pos == p)
                    order = mine[np.lexsort(found[mine].T[::-1])]  # files that one task reads may not follow each other
                    code = Trie(found[order], books[p]).nearest
                    np.add.at(counts[p], code, n[order])
                    np.add.at(sums[p], code, found[order] * n[order, None])
            p, e = np.nonzero(counts)
            table = np.concatenate([counts[p, e][:, None], sums[p, e]], axis=1)  # the count stands before the sums
            yield pa.RecordBatch.from_pydict({"cell": np.repeat((p * books.shape[1] + e) * (size + 1), size + 1) + np.tile(np.arange(size + 1), len(p)), "total": table.ravel()})

        gathered = distinct.mapInArrow(assign, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
        total = np.zeros(parts * books.shape[1] * (size + 1), np.int64)
        total[gathered.column("cell").to_numpy()] = gathered.column("total").to_numpy()
        total = total.reshape(parts, books.shape[1], size + 1)
        books = np.where(total[:, :, :1] > 0, total[:, :, 1:] // np.maximum(total[:, :, :1], 1), books)
    return books


def encode(vectors: DataFrame, books: np.ndarray, vector_col: str, code_out: str = "code", error_out: str = "error", scale: int = SCALE) -> DataFrame:
    """The usable rows of ``vectors`` with all their columns plus the code (array of entry numbers, one a part) and its error,
    the sum of the parts' squared distances.

    Rows go whose vector is null, has null or non-finite components or another length than the codebooks'. A column that
    already has an output's name keeps it, and the output's gets underscores in front.
    """
    names = free_name(vectors, code_out), free_name(vectors, error_out)
    schema = T.StructType([*vectors.schema.fields, T.StructField(names[0], T.ArrayType(T.IntegerType())), T.StructField(names[1], T.LongType())])
    parts, entries, size = books.shape
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, VECTORS):
                batch = whole.slice(start, VECTORS)
                at, found = _usable(batch, vector_col, parts * size, scale) if entries else (np.zeros(0, np.int64), np.zeros((0, 0), np.int64))
                codes, errors = np.zeros((len(at), parts), np.int32), np.zeros(len(at), np.int64)
                for p, part in enumerate(np.split(found, parts, axis=1) if len(at) else []):
                    distinct, of = np.unique(part, axis=0, return_inverse=True)  # in lexicographic order
                    trie = Trie(distinct, shared.value[p])
                    codes[:, p] = trie.nearest[of.ravel()]
                    errors += trie.distance[of.ravel()]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * parts), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, lists, pa.array(errors)], schema.names)

    return vectors.mapInArrow(run, schema)


def decode(books: np.ndarray, codes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Vectors x components: what the codes (vectors x parts) stand for, the middle of each component's step."""
    return np.concatenate([(book[codes[:, p]] + 0.5) / scale for p, book in enumerate(books)], axis=1)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(rows with code and error, codebooks): trained on all usable vectors, which are then encoded.

    Vectors that are null, empty, or have null or non-finite components are left out, as are those whose length ``parts``
    does not divide or that is not the length of the first usable one by id. Rows that repeat an id are vectors of their
    own; null ids take part and come last where the smallest are asked for. Other columns are kept. An empty table gives
    no rows and codebooks without entries. Components so large that squared distances don't fit 64 bits raise an error.
    """
    books = train(vectors, id_col, vector_col, entries, parts, rounds, scale)
    return encode(vectors, books, vector_col, scale=scale), books


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def with_sum_by(rows: DataFrame, by: str, value: str, out: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows``, staged, with the sum of ``value`` over rows of equal ``by``, nulls together. Sums are formed before they are
    sent back, so a frequent value is one row; up to ``broadcast_rows`` values they are broadcast, beyond that shuffled."""
    sums = staged(rows.groupBy(F.col(by).alias("__by")).agg(F.sum(value).alias(out)), "sums")
    return rows.join(F.broadcast(sums) if sums.count() <= broadcast_rows else sums, rows[by].eqNullSafe(sums["__by"]), "left").drop("__by")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = staged(coded.select("vec_id", "label", digits.alias("code"), "error"), "codes")
    summed = with_sum_by(rows, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(sha256(books_text(books).encode()).hexdigest()).alias("codebooks_sha256"))


def _op12_sql() -> str:
    """The rounds one after the other: every part with every entry, the nearest by (distance, entry), floored means."""
    steps = [
        f"""whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (
  SELECT vec_id, label, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS part
  FROM whole CROSS JOIN range({PARTS}) AS r(p)),
ranked AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM whole QUALIFY e < {ENTRIES}),
book0 AS (SELECT p, e, part AS entry FROM cut JOIN ranked USING (vec_id))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""far{r} AS (
  SELECT vec_id, label, p, part, e, list_inner_product(part, part) - 2 * list_inner_product(part, entry) + list_inner_product(entry, entry) AS d
  FROM cut JOIN book{r} USING (p)),
near{r} AS (SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS best, any_value(label) AS label, any_value(part) AS part FROM far{r} GROUP BY vec_id, p)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""mean{r} AS (
  SELECT p, e, list(m ORDER BY i) AS entry FROM (
    SELECT p, best.e AS e, i, floor(sum(list_extract(part, i)) / count(*)) AS m
    FROM near{r} CROSS JOIN range(1, 1 + (SELECT max(len(part)) FROM cut)) AS r(i) GROUP BY ALL) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(mean{r}.entry, book{r}.entry) AS entry FROM book{r} LEFT JOIN mean{r} USING (p, e))"""
            )
    last = ROUNDS
    return f"""
WITH {', '.join(steps)},
named AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(entry) AS x, generate_subscripts(entry, 1) AS i FROM book{last})),
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM near{last} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded CROSS JOIN named
"""


OP12_SQL = _op12_sql()
