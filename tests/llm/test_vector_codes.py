import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm import vector_codes

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("error", T.StringType())]
)


def plain(rows, entries=256, parts=4, rounds=4, width=None):
    """{row number: (code, error)} and the codebooks, by all distances of all vectors."""
    usable = [n for n, (_, v, _) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and len(v) % parts == 0]
    order = sorted(usable, key=lambda n: (rows[n][0] is None, rows[n][0] or 0, rows[n][1]))
    width = len(rows[order[0]][1]) if order else 0
    order = [n for n in order if len(rows[n][1]) == width]
    if not order:
        return {}, []
    whole = np.floor(np.array([rows[n][1] for n in order], np.float32).astype(float) * 1024).astype(np.int64)
    codes, errors, books = [], 0, []
    for part in np.split(whole, parts, axis=1):
        book = part[:entries].copy()
        for _ in range(rounds):
            near = ((part[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)
            book = np.array([part[near == e].sum(axis=0) // (near == e).sum() if (near == e).any() else book[e] for e in range(len(book))])
        far = ((part[:, None] - book) ** 2).sum(axis=2)
        codes.append(far.argmin(axis=1))
        errors = errors + far.min(axis=1)
        books.append(book)
    return {n: (list(map(int, c)), int(e)) for n, c, e in zip(order, zip(*codes), errors)}, np.stack(books)


def rows_of(seed=1, n=700, width=12):
    rng = np.random.default_rng(seed)
    found = [(i, [float(x) for x in rng.normal(0, 0.02, width).astype(np.float32)], int(rng.integers(4))) for i in range(n)]
    hot = found[5][1]
    found += [(1000 + i, hot, 1) for i in range(300)]  # one vector that very many have
    found += [(2000, None, 1), (2001, [], 2), (2002, [0.5] * (width - 1) + [None], None), (2003, [float("nan")] + [0.1] * (width - 1), 3), (2004, [float("-inf")] * width, 3)]
    found += [(2005, [0.1] * (width - 1), 3), (2006, [0.1] * (2 * width), 0), (None, [0.3] * width, None), (7, [0.25] * width, None), (7, [0.25] * width, None)]
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "e") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("entries,parts,width", [(256, 4, 12), (16, 4, 8), (9, 2, 6), (300, 1, 3)])
def test_codes_and_codebooks_against_all_distances(spark, entries, parts, width):
    rows = rows_of(width=width)
    want, books = plain(rows, entries, parts)
    coded, got_books = vector_codes.compress(frame(spark, rows), entries=entries, parts=parts)
    assert (got_books == books).all()
    assert coded.columns == ["vec_id", "embedding", "label", "code", "error", "_code", "_error"]
    assert sorted((str(r["vec_id"]), r["_code"], r["_error"]) for r in coded.collect()) == sorted((str(rows[n][0]), *found) for n, found in want.items())


@pytest.mark.parametrize("leaves", [1, 2, 7, 1000])
@pytest.mark.parametrize("spread", [2, 40, 2**20, 2**27])
def test_trie_against_all_distances(leaves, spread):
    rng = np.random.default_rng(leaves)
    parts = np.unique(rng.integers(-spread, spread, (500, 5)), axis=0)
    entries = rng.integers(-spread, spread, (37, 5))
    entries[20] = entries[3]  # of equal entries the first counts
    trie = vector_codes.Trie(parts, entries, leaves)
    far = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (trie.nearest == far.argmin(axis=1)).all() and (trie.distance == far.min(axis=1)).all()


def test_decoded_vectors_are_near(spark):
    rows = rows_of(n=200)
    coded, books = vector_codes.compress(frame(spark, rows))
    found = [r for r in coded.collect() if r["vec_id"] is not None and r["vec_id"] < 200]
    back = vector_codes.decode(books, np.array([r["_code"] for r in found]))
    assert np.abs(back - np.array([r["embedding"] for r in found])).max() < 1 / 1024 + 1e-6  # fewer vectors than entries


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.1, 0.2, 0.3], 1)], [(None, [0.1, 0.2, 0.3, 0.4], None)]])
def test_next_to_nothing(spark, rows):
    coded, books = vector_codes.compress(frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA))
    assert [(r["_code"], r["_error"]) for r in coded.collect()] == ([([0, 0, 0, 0], 0)] if rows and rows[0][0] is None else [])
    assert books.shape[1] == (1 if rows and rows[0][0] is None else 0)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, [(1, [1e30] * 4, 1)]))


@pytest.mark.parametrize("limit", [0, 1000])
def test_query_of_a_given_table(spark, limit):
    got = vector_codes.op12_vector_codes(spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = plain(rows)
    sums = {}
    for n, (_, error) in want.items():
        sums[rows[n][2]] = sums.get(rows[n][2], 0) + error
    sha = hashlib.sha256(vector_codes.books_text(books).encode()).hexdigest()
    assert sorted(map(tuple, got)) == sorted((rows[n][0], "".join(f"{c:02x}" for c in code), error, sums[rows[n][2]], sha) for n, (code, error) in want.items())
    both = spark.createDataFrame([(1, None, 5), (2, None, 6), (3, 4, 7)], "vec_id long, label int, error long")
    summed = vector_codes.with_sum_by(both, "label", "error", "label_error", limit)
    assert sorted((r["vec_id"], r["label_error"]) for r in summed.collect()) == [(1, 11), (2, 11), (3, 7)]
