import base64
import json
import resource
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe, chunks, packing

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


ODD = ["", " ", "  ", "a  b", "a \n b", "x   y  ", " lead", "don't I'll", "\x1c x\x85 y", "日本 語  テ", "a\r\n\r\n\t b", "eau" * 40, "<|endoftext|> x", "é́ ﬁ K", "z" * 500 + "aab" * 300]


def test_encodes_as_the_library_and_decodes(library):
    vocabulary = bpe.bpe(RANKS, P.PATTERN)
    ids = [np.frombuffer(i, "<u4") for i in vocabulary.texts(ODD)]
    assert [i.tolist() for i in ids] == [library.encode_ordinary(t) for t in ODD]
    assert vocabulary.decode(ids) == [t.encode() for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\taeirstnouxé日'1!\x85\u3000"), max_size=40), min_size=1, max_size=5))
def test_any_mix_of_blanks_and_letters(library, tokenizer, texts):
    got = bpe.bpe(RANKS, P.PATTERN).texts(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [library.encode_ordinary(t) for t in texts]
    got = packing.chunk_encoder(JSON)(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_and_slow_files(tokenizer):
    texts = [*ODD, "a<|endoftext|> <|endoftext|> b", " <|endoftext|>x y"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(i, "<u4").tolist() for i in packing.chunk_encoder(JSON)(texts)] == want
    spec = json.load(open(JSON))
    assert packing._by_rank(tokenizer, spec)
    spec["model"]["merges"][5:7] = spec["model"]["merges"][6:4:-1]
    assert packing._by_rank(tokenizer, spec) is None


def test_both_contractions_agree():
    vocabulary = bpe.bpe(RANKS, P.PATTERN)
    rng = np.random.default_rng(5)
    words = [bytes(rng.choice(list(b"aeinrst"), rng.integers(1, 60)).tolist()) for _ in range(200)]
    assert vocabulary.contract(words) == vocabulary.contract(words, bpe.CONTRACT_LONG)


def test_bpe_frames(docs_of, odd_rows, library):
    docs = docs_of(odd_rows)
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    want = sorted(((i, library.encode_ordinary(t or "")) for i, t in odd_rows), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in encoded.collect()), key=str) == want
    decoded = bpe.decode(encoded, RANKS, P.PATTERN)
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in decoded.collect()), key=str) == sorted(((i, (t or "").encode()) for i, t in odd_rows), key=str)
    assert bpe.round_trip_digests(docs.limit(0), RANKS, P.PATTERN).collect() == []


def test_two_fit_exchanges_the_smallest():
    # greedy: 6 + 3 leaves a gap of 1; two 2s fit the gap of 4 tighter than the 3
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]
    assert packing.best_two_fit({10: 5, 4: 5}, 10) == [([10], 5), ([4, 4], 2), ([4], 1)]
    assert packing.best_two_fit({}, 10) == []


def two_fit_by_documents(lengths, capacity):
    """The bins, document by document: fill with the longest that fits, then the smallest goes for two unpacked documents
    that fill its expanded gap more, of equal sums the pair with the longest one."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], capacity
        for size in left:
            if size <= gap:
                own.append(size)
                gap -= size
        free = list(left)
        for size in own:
            free.remove(size)
        room = gap + own[-1]
        pairs = [(a + b, a, b) for i, a in enumerate(free) for b in free[i + 1 :] if own[-1] < a + b <= room]
        if pairs:
            own = [*own[:-1], *max(pairs)[1:]]
        for size in own:
            left.remove(size)
        bins.append(tuple(sorted(own, reverse=True)))
    return Counter(bins)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=10), st.integers(40, 60))
def test_two_fit_document_by_document(counts, capacity):
    got = Counter()
    for lengths, times in packing.best_two_fit(counts, capacity):
        got[tuple(lengths)] += times
    assert got == two_fit_by_documents(list(Counter(counts).elements()), capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plans_use_every_piece_once(counts):
    used = Counter()
    for lengths, times in packing.best_two_fit(counts, 64):
        assert sum(lengths) <= 64 and times > 0
        for size in lengths:
            used[size] += times
    assert used == Counter(counts)


def test_packed_documents(docs_of, odd_rows, tokenizer):
    got = packing.pack(docs_of(odd_rows), JSON, end_id=2, capacity=256, keep_ids=True).collect()
    pieces = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], ids.tolist()))
    want = defaultdict(list)
    for i, t in odd_rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range((len(ids) - 1) % 256 + 1, len(ids) + 1, 256)]
        want[i] += [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in want.items()}
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.02 * sum(r["length"] for r in got) / 256 + 1


def test_nothing_to_pack(docs_of):
    assert packing.pack(docs_of([]), JSON).collect() == []


def test_what_comes_often_is_encoded_once():
    """However many other chunks come, beyond what is remembered."""
    seen = []
    encoder = chunks.ChunkEncoder(lambda texts: seen.extend(texts) or [chunks.as_bytes([len(t)]) for t in texts], 10)
    for i in range(20):
        assert encoder([f"x often a{i} b{i}"]) == [chunks.as_bytes([1, 6, 2 + len(str(i)), 2 + len(str(i))])]
    assert seen.count(" often") == 1
    assert len(encoder.after_space) + len(encoder.after_space.before) <= 10 + 2 * 3


def test_merged_matches_are_remembered():
    """A match that took merges isn't merged again in another chunk."""
    merged = []

    class Counted(bpe.Bpe):
        def contract(self, words, query=bpe.CONTRACT):
            merged.extend(words)
            return super().contract(words, query)

    vocabulary = Counted(RANKS, P.PATTERN)
    first = vocabulary.texts(["a qzxvkwj, b"])
    assert vocabulary.texts(["a qzxvkwj; b", "a qzxvkwj, b"])[1] == first[0]
    assert merged.count(b" qzxvkwj") == 1


def test_packing_takes_few_rows_at_once(spark, monkeypatch):
    """An Arrow batch of 10,000 rows isn't encoded as a whole."""

    def few(texts):
        assert len(texts) <= 500 and sum(map(len, texts)) <= 1_000_000
        return [chunks.as_bytes([7]) for _ in texts]

    monkeypatch.setattr(packing, "chunk_encoder", lambda path: few)
    docs = spark.range(2_000, numPartitions=1).selectExpr("id AS doc_id", "repeat('x ', 5000) AS text")
    assert packing.encode_pieces(docs, "", 2, 1024).count() == 2_000


def test_places_come_without_python_rows(docs_of):
    """Rows of Python objects start another Python daemon with workers of its own on each executor."""
    packed = packing.pack(docs_of([(1, "a b"), (2, "c")]), JSON)
    assert "ExistingRDD" not in packed._jdf.queryExecution().toString()


def test_free_memory_is_given_back_after_the_last_batch():
    """Also where the newest block is still in use, so that the C library's heap cannot shrink from its end."""

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * resource.getpagesize() / 1e6

    blocks = [np.ones(8_000) for _ in range(3_000)]  # 192 MB in pieces too small to be mapped by themselves
    last = blocks[-1]
    del blocks
    before = resident()
    assert list(chunks.small_slices(iter([]), "text", 10, 10)) == []
    assert resident() < before - 100 and last[0] == 1


def test_chunks_are_not_searched_for_added_tokens_that_no_text_has(tokenizer):
    asked = []

    class Chunk(str):
        def __contains__(self, part):
            asked.append(part)
            return super().__contains__(part)

    path = P.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    encode = packing._by_rank(tokenizer, spec)
    texts = ["a", " b", " ünd", " 日本", " ", "  x", " word"]
    assert encode([Chunk(t) for t in texts]) == [chunks.as_bytes(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert not asked
    added = spec["added_tokens"][0]["content"]
    texts += [f" a{added}b", added, " c"]
    assert encode(texts) == [chunks.as_bytes(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
