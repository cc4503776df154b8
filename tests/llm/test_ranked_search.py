import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ranked_search
from millrace.llm.common import table

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item, rank, id, score) of every item's k best documents by all scores."""
    counted = [(i, Counter(cut(t))) for i, t in docs]
    documents, length = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in counted:
            m = 25 + 75 * c.total() * documents // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in cut(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    """Frequent and rare words, copies, empty texts, one of very many words, and ids that are null."""
    rng = random.Random(4)
    words = [f"{rng.choice('aeiouñßж日')}{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 120)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(7, docs[7][1]), (None, docs[3][1]), (None, None), (2000, None), (2001, ""), (2002, " .,-/:@[`{\x7f\x00"), (2003, " ".join(rng.choices(words, k=30_000)))]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(25)]
    items += [(100, docs[3][1]), (100, docs[3][1]), (100, docs[4][1]), (101, None), (102, ""), (103, "nowhere"), (104, words[0]), (105, " ".join([words[250]] * 30))]
    return docs, items


@pytest.mark.parametrize("k,block_terms,bucket", [(10, 200_000, 1_024), (3, 60, 16), (1, 1, 1_024), (500, 200_000, 64)])
def test_rows_against_all_scores(spark, docs_of, corpus, monkeypatch, k, block_terms, bucket):
    docs, items = corpus
    monkeypatch.setattr(ranked_search, "BUCKET", bucket)
    if block_terms == 1:
        items = items[-9:]  # a block each
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string").repartition(2)
    got = ranked_search.top_documents(docs_of(docs), queries, k, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    # one id with two texts is two queries, which only their scores tell apart
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def test_bounds_leave_rows_out_and_never_one_that_counts(corpus):
    docs, items = corpus
    rows = [(i, ranked_search.terms(t or "")) for i, t in items if t]
    queries = ranked_search.Queries(rows)
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 9_000, len(queries.number))
    sizes = rng.integers(1, 40, 200)
    term = np.concatenate([rng.choice(len(weights), n, replace=False) for n in sizes]).astype(np.int32)
    impact = rng.integers(1, 1_000_000, sizes.sum())
    roots = np.sqrt(weights.astype(float))
    starts = np.cumsum(sizes) - sizes
    length = np.sqrt(np.add.reduceat((impact * roots[term]) ** 2, starts))
    bucket = ranked_search._Bucket(term, impact, sizes, length, roots)
    search = ranked_search.Search(queries.counts, weights, 10, np.zeros(len(rows), np.int64))
    fewer = 0
    for q, counts in enumerate(queries.counts):
        exact = np.array([sum(counts[int(t)] * int(weights[t]) * int(x) for t, x in zip(term[s : s + n], impact[s : s + n])) for s, n in zip(starts, sizes)])
        for share in (0.2, 0.5, 0.9, 1.0):
            least = max(int(exact.max() * share), 1)
            live = bucket.live(*search.focus[q], least)
            assert set(np.flatnonzero(exact >= least)) <= set(live)
            assert not len(live) or exact[live].max() <= search.length[q] * length.max() * ranked_search.WIDER
            fewer += len(live) < len(sizes)
            if len(live):
                dense = np.zeros(len(weights), np.int64)
                dense[search.whole[q][0]] = search.whole[q][1]
                assert (bucket.scores(live, dense) == exact[live]).all()
    assert fewer > len(rows)


def test_terms():
    assert ranked_search.terms("Ab1,cD é日Ü x\x00y~z") == [t.encode() for t in cut("Ab1,cD é日Ü x\x00y~z")]


def test_query_of_a_given_table(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert sorted(map(tuple, ranked_search.op11_ranked_search(spark, SF).collect()), key=str) == brute(docs, items, 10)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "")], [(1, "a")]), ([(1, "a")], [(1, None), (2, "b")])])
def test_next_to_nothing(spark, docs_of, docs, items):
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert ranked_search.top_documents(docs_of(docs), queries).collect() == []
