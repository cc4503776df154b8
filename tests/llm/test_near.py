import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import fingerprints, near_dedup, shingles
from millrace.llm.links import components
from millrace.llm.near_dedup import drop_near_duplicates, near_duplicates


def sets_of(rows, k):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()))
    return out


def brute(rows, k, percent=80):
    """(id, size, smallest id reachable) of every row."""
    docs = sets_of(rows, k)
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(docs[a][1] & docs[b][1])
            if both and 100 * both >= percent * (len(docs[a][1]) + len(docs[b][1]) - both):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for a, (i, _) in enumerate(docs):
        groups[root(a)].append(i)
    return [(i, len(s), min((x for x in groups[root(a)] if x is not None), default=None) if s else i) for a, (i, s) in enumerate(docs)]


def chains(seed=2):
    """A base, a large group of near copies of it, a chain whose ends are not alike, and rows just above and below 0.8."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(120)] = word()
        rows.append((1001 + i, " ".join(copy)))
    link = [word() for _ in range(100)]
    for i in range(12):
        rows.append((1900 - i, " ".join(link)))
        link = link[8:] + [word() for _ in range(8)]
    return rows


@pytest.mark.parametrize("k, limit", [(2, 1_000_000), (5, 1_000_000), (2, 0)])
def test_components_against_all_pairs(docs_of, odd_rows, k, limit):
    rows = odd_rows + chains()
    got, _ = near_duplicates(docs_of(rows), k=k, percent=80, broadcast_rows=limit)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == sorted(brute(rows, k), key=str)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_packed_bits_of_unequal_minima_are_equal_by_chance():
    rng = np.random.default_rng(5)
    a, b = shingles.permutations(near_dedup.BANDS * near_dedup.ROWS)
    n = 4000
    common, own = rng.integers(0, 1 << 64, (n, 4), np.uint64), rng.integers(0, 1 << 64, n, np.uint64)
    one = shingles.minima(common.ravel(), np.full(n, 4), a, b)
    other = shingles.minima(np.column_stack([common, own]).ravel(), np.full(n, 5), a, b)
    bits = [near_dedup.packed(x).view(np.uint8).reshape(n, -1) for x in (one, other)]
    xor = np.unpackbits(bits[0] ^ bits[1], axis=1).reshape(n, -1, 2).any(axis=2)
    chance = 1 - xor.sum(axis=1) / (one[:, : near_dedup.SIGNED] != other[:, : near_dedup.SIGNED]).sum(axis=1)
    assert abs(chance.mean() - 0.25) < 0.01 and chance.std() < 0.07  # 0.25 of about 64 fields: 0.054


def test_short_pairs_need_no_estimate(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "estimate", lambda a, b: a[0] * 0.0)
    words = "one two three four five six".split()
    got, _ = near_duplicates(docs_of([(1, " ".join(words[:5])), (2, " ".join(words))]), k=2)
    assert {r["component_id"] for r in got.collect()} == {1}


def test_one_document_of_each_group_stays(docs_of, odd_rows):
    rows = odd_rows + chains(4)
    kept = drop_near_duplicates(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    want = sorted((i for i, _, c in brute(rows, 5) if i == c), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want
    assert drop_near_duplicates(docs_of([])).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(1)
    names = rng.sample(range(10_000), 300)
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], n) for n in names[201:]]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: min(names[:151]) for n in names[:151]} | {n: min(names[200:]) for n in names[200:]}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_minima_in_blocks(monkeypatch):
    texts = ["a b c d e f g", "", "one", "x y " * 40, " ", "p q r s t"]
    hashes, many = shingles.shingle_hashes(texts, 5)
    a, b = shingles.permutations(16)
    assert many.tolist() == [3, 0, 1, 76, 0, 1]
    whole = shingles.minima(hashes, many, a, b)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for i, (n, end) in enumerate(zip(many, np.cumsum(many))):
        own = [int(min((int(a[j]) * int(v) + int(b[j])) % 2**32 for v in x[end - n : end])) if n else 2**32 - 1 for j in range(16)]
        assert whole[i].tolist() == own
    for block in (1, 2, 7, 76):
        monkeypatch.setattr(shingles, "BLOCK", block)
        assert (shingles.minima(hashes, many, a, b) == whole).all()


def test_edited_and_next(docs_of, odd_rows):
    rows = [(i, t) for n, (i, t) in enumerate(odd_rows) if odd_rows.index((i, t)) == n and i is not None]
    got = {r["doc_id"]: r for r in fingerprints.edited_and_next(docs_of(rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u, r = t or "", u or "", got[i]
        k = len(t) // 3
        edited = t[: len(t) - k] + u[:k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        prints = [fingerprints.fingerprint(s) for s in fingerprints.signatures([t, edited, u])]
        assert [r["fingerprint"], r["edited_fingerprint"], got[j]["fingerprint"]] == prints
        one, two, three = (np.frombuffer(bytes.fromhex(p), ">u4") for p in prints)
        assert r["near_edited"] == pytest.approx((one == two).mean()) and r["near_next"] == pytest.approx((one == three).mean())
    assert len(got) == len(rows)


def test_edited_of_repeated_null_single_and_no_rows(docs_of, odd_rows):
    assert len(fingerprints.edited_and_next(docs_of(odd_rows)).collect()) == len(odd_rows)
    (one,) = fingerprints.edited_and_next(docs_of([(5, "a b c d e f")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest() and one["near_next"] == 1
    assert fingerprints.edited_and_next(docs_of([])).collect() == []
    assert len(fingerprints.edited_and_next(docs_of([(None, "a"), (None, None)])).collect()) == 2


def test_likeness_estimates_jaccard():
    rng = random.Random(3)
    words = [str(rng.random()) for _ in range(400)]
    errors = []
    for cut in range(10, 400, 30):
        a, b = " ".join(words), " ".join(words[:cut] + [w + "x" for w in words[cut:]])
        (_, x), (_, y) = sets_of([(0, a), (1, b)], 5)
        one, two = fingerprints.signatures([a, b])
        errors.append((one == two).mean() - len(x & y) / len(x | y))
    assert max(map(abs, errors)) < 0.15 and abs(np.mean(errors)) < 0.04


def test_similar_documents_by_bands(docs_of, odd_rows):
    rows = odd_rows + chains(6)
    got, links = fingerprints.similar_documents(docs_of(rows))
    members = defaultdict(list)
    for r in got.collect():
        members[r["class_id"]].append(r["doc_id"])
    want = defaultdict(list)
    for i, n, c in brute(rows, 5):
        want[c if n else None].append(i)
    empty = members.pop(None)
    assert sorted(empty, key=str) == sorted((i for i, n, _ in brute(rows, 5) if not n), key=str)
    by_min = {min((i for i in ids if i is not None), default=None): sorted(ids, key=str) for ids in members.values()}
    assert by_min == {c: sorted((i for i, n, x in brute(rows, 5) if n and x == c), key=str) for c in {x for _, n, x in brute(rows, 5) if n}}
    assert links.count() > 0
