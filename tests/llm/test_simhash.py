import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.common import staged
from millrace.llm.links import components


def fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), seed=42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(values, most):
    """For each value the number of its component."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= most:
                parent[root(a)] = root(b)
    return [root(x) for x in range(len(values))]


def near_rows(seed=1):
    """A base with many near copies of it, and a chain of texts each alike the next."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(150)]
    rows = [(5000, " ".join(base))]
    for i in range(80):
        copy = list(base)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(150)] = word()
        rows.append((5001 + i, " ".join(copy)))
    for i in range(15):
        base = base[3:] + [word() for _ in range(3)]
        rows.append((4000 - i, " ".join(base)))
    return rows


@pytest.mark.parametrize("k,most", [(3, 3), (5, 3), (3, 0), (3, 6)])
def test_documents_against_all_pairs(docs_of, odd_rows, k, most):
    rows = odd_rows + near_rows()
    prints = [fingerprint(t, k) for _, t in rows]
    groups = defaultdict(list)
    labels = brute(prints, most)
    for (i, _), label in zip(rows, labels):
        groups[label].append(i)
    smallest = {label: min((i for i in ids if i is not None), default=None) for label, ids in groups.items()}
    want = sorted(((i, f, smallest[label], i == smallest[label]) for (i, _), f, label in zip(rows, prints, labels)), key=str)
    documents, found = simhash.near_duplicates(docs_of(rows), k, most)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"], r["kept"]) for r in documents.collect()), key=str)
    assert got == want
    assert all(0 < ((r["a"] ^ r["b"]) % 2**64).bit_count() <= most for r in found.collect())


def test_one_in_a_dense_cluster_and_correlated_bits(spark):
    """Thousands of fingerprints around one, others that share 20 bits, and copies of a block in all of them."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for _ in range(1500)}
    values |= {(rng.getrandbits(44) << 20) | 0xABCDE for _ in range(700)} | {rng.getrandbits(64) for _ in range(300)}
    values = sorted(values)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    nodes = staged(spark.createDataFrame(signed, "fp long"), "fps")
    of = {r["node"] % 2**64: r["component"] for r in components(simhash.links(nodes, 3)).collect()}
    want = defaultdict(set)
    for v, label in zip(values, brute(values, 3)):
        want[label].add(v)
    got = defaultdict(set)
    for v in values:
        got[of.get(v, v - 2**64 if v >= 2**63 else v)].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("plan", simhash.PLANS)
def test_thresholds_leave_no_pair_out(plan):
    """Each pair at most bits apart meets where one of the two looks up the other's value, for any plan and both ways."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = [base]
    for most in (1, 2, 3):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, most, replace=False)) for _ in base], np.uint64)
        fps.append(base ^ flips)
    hot = (rng.integers(0, 2**48, 200, dtype=np.uint64) << np.uint64(16)) | np.uint64(77)
    fps = np.unique(np.concatenate([*fps, hot]))
    blocks = np.arange(64).reshape(4, 16)
    values = simhash.block_values(fps, blocks)
    near = np.stack([simhash.near_counts(np.bincount(v, minlength=1 << 16), 3) for v in values.T])
    chosen, cost = simhash.Thresholds(near, 3).choose(values, plan)
    assert ((chosen + 1).sum(axis=1) == 4).all() and chosen.min() >= -1 and np.isfinite(cost).all()
    owners, lookers = defaultdict(set), defaultdict(set)
    for keys, members, own, looks in simhash.probes(fps, values, chosen, plan, near):
        for key, fp, looking in zip(keys.tolist(), members.tolist(), looks.tolist()):
            if own:
                owners[key].add(fp)
            if looking:
                lookers[key].add(fp)
    met = {(a, b) for key in owners for a in owners[key] for b in lookers[key]}
    for a in fps.tolist():
        for b in fps.tolist():
            if 0 < (a ^ b).bit_count() <= 3:
                assert (a, b) in met and (b, a) in met


def test_near_counts_against_all_values():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, 256)
    want = [[sum(int(counts[w]) for w in range(256) if (v ^ w).bit_count() == e) for v in range(256)] for e in range(4)]
    assert (simhash.near_counts(counts, 3) == np.array(want)).all()


def test_majority_of_long_and_empty_texts():
    rng = np.random.default_rng(2)
    many = np.array([0, 1, 254, 255, 256, 0, 70_000, 2, 0])
    hashes = rng.integers(0, 2**64, many.sum(), dtype=np.uint64)
    got, at = simhash.majority(hashes, many), 0
    for n, value in zip(many, got):
        part = hashes[at : at + n]
        at += n
        assert int(value) == sum(1 << b for b in range(64) if 2 * int((part >> np.uint64(b) & np.uint64(1)).sum()) > n)


def test_query_of_a_given_table(spark):
    got = simhash.op13_simhash_near_dedup(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = [fingerprint(r["text"], 3) for r in rows]
    labels = brute(prints, 3)
    smallest = {}
    for r, label in zip(rows, labels):
        smallest[label] = min(smallest.get(label, r["doc_id"]), r["doc_id"])
    assert sorted(map(tuple, got.collect())) == sorted((r["doc_id"], f"{f:016x}", smallest[label]) for r, f, label in zip(rows, prints, labels))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (2, "")]])
def test_next_to_nothing(docs_of, rows):
    documents, _ = simhash.near_duplicates(docs_of(rows))
    assert sorted((r["doc_id"], r["component_id"]) for r in documents.collect()) == [(i, min((j for j, _ in rows if j is not None), default=None)) for i, _ in rows]
