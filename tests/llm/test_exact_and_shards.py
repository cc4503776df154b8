import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm.exact_dedup import CountingQuotientFilter, exact_groups, repeated_fingerprints
from millrace.llm.shards import shard_by_bytes


@pytest.mark.parametrize("width", [64, 20, 5])
def test_filters_merge_without_loss(width):
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << min(width, 12), 500, dtype=np.uint64) << np.uint64(max(0, width - 12)) for _ in range(4)]
    filters = []
    for p in parts:
        f = CountingQuotientFilter.build(p, np.ones(len(p), np.int64), width)
        filters.append(CountingQuotientFilter.from_bytes(width, *f.to_bytes()))
    merged = CountingQuotientFilter.merge(filters)
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert merged.values().tolist() == values.tolist() and merged.counts.tolist() == counts.tolist()
    assert all(merged.count(int(v)) == c for v, c in zip(values[:50], counts[:50]))
    assert merged.count(int(values[0]) ^ 1) == int(counts[values == (int(values[0]) ^ 1)].sum())


def test_repeated_fingerprints(spark):
    rows = spark.createDataFrame([(v,) for v in (-1, -1, 5, 7, 7, 7, -(1 << 63), 0)], "fp long").repartition(3)
    assert sorted(map(tuple, repeated_fingerprints(rows).collect())) == [(-1, 2), (7, 3)]
    assert repeated_fingerprints(rows.limit(0)).collect() == []


@pytest.mark.parametrize("bits, limit", [(64, 1_000_000), (64, 0), (3, 1_000_000), (3, 0)])
def test_groups_by_bytes_whatever_the_fingerprints(docs_of, odd_rows, bits, limit):
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[t or ""].append(i)
    want = []
    for i, t in odd_rows:
        same = groups[t or ""]
        keep = max((s for s in same if s is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_groups(docs_of(odd_rows), bits=bits, broadcast_rows=limit).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_documents(docs_of):
    assert exact_groups(docs_of([])).collect() == []
    assert shard_by_bytes(docs_of([]), 8).collect() == []


def test_shards_are_contiguous_balanced_and_gapless(docs_of, odd_rows):
    rows = odd_rows + [(400 + i, "y" * (i % 900)) for i in range(500)] + [(950, "same")] * 300
    got = shard_by_bytes(docs_of(rows), 8).collect()
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    total, largest, last = sum(r["size"] for r in got), max(r["size"] for r in got), -1
    for s in range(8):
        own = sorted((r for r in got if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= largest
        ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in own]
        assert ids == sorted(ids) and (not ids or ids[0] >= last)
        last = ids[-1] if ids else last
