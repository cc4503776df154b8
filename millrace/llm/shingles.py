"""Word shingles as numbers and their MinHash minima, in numpy, for use inside tasks."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import xxhash

from millrace.llm.common import remembered

#: Words that a worker remembers with their hashes; about 60 MB. It starts anew when they are reached.
REMEMBERED = 400_000
#: Shingles hashed at once, so that the arrays stay in the processor's cache.
BLOCK = 16_384

_BASE = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words(text: str) -> list[bytes]:
    """Words between blanks, tabs, line and page breaks (0x20, 0x09 to 0x0D), with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' shingles of k words, one text after the other, and how many each text has.

    A text with fewer words is one shingle of all of them, and a text without words has none. Repeats are not removed.
    """
    hash_of = remembered("word hashes", _WordHashes)
    if len(hash_of) > REMEMBERED:
        hash_of.clear()
    cut = [words(t) for t in texts]
    n = np.array([len(c) for c in cut], np.int64)
    flat = np.array([hash_of[w] for c in cut for w in c], np.uint64)
    starts = np.cumsum(n) - n
    size = np.minimum(n, k)  # words in a shingle of the text
    many = np.maximum(n - k + 1, (n > 0).astype(np.int64))
    first = np.repeat(starts, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    width = np.repeat(size, many)
    hashed = mixed(flat)
    value = width.astype(np.uint64)
    for j in range(k):
        if j == 0:
            value = value * _BASE + hashed[first]
        else:
            inside = width > j
            if inside.all():
                value = value * _BASE + hashed[first + j]
            else:
                value[inside] = value[inside] * _BASE + hashed[first[inside] + j]
    return mixed(value), many


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """n universal hashes x -> a * x + b of 32-bit numbers; a is odd, so each is a permutation."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 32, (2, n), dtype=np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def minima(hashes: np.ndarray, many: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """texts x permutations: the smallest value of each permutation over a text's shingles; all ones without any."""
    out = np.full((len(many), len(a)), 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    buffer = np.empty(BLOCK, np.uint32)
    ends = np.cumsum(many)
    for start in range(0, len(x), BLOCK):
        part = x[start : start + BLOCK]
        lo = int(np.searchsorted(ends, start, "right"))
        hi = int(np.searchsorted(ends, start + len(part), "left")) + 1
        rows = lo + np.flatnonzero(many[lo:hi])  # texts with shingles in this block
        cuts = np.maximum(ends[rows] - many[rows] - start, 0)
        work = buffer[: len(part)]
        found = np.empty((len(a), len(rows)), np.uint32)
        for j in range(len(a)):
            np.multiply(part, a[j], out=work)
            np.add(work, b[j], out=work)
            np.minimum.reduceat(work, cuts, out=found[j])
        out[rows] = np.minimum(out[rows], found.T)
    return out


def shingle_sets(hashes: np.ndarray, many: np.ndarray) -> list[np.ndarray]:
    """The distinct hashes of each text, in ascending order."""
    return [np.unique(part) for part in np.split(hashes, np.cumsum(many)[:-1])] if len(many) else []


def set_key(values: np.ndarray) -> int:
    """A 64-bit name (signed) of a set of distinct hashes in ascending order."""
    return int.from_bytes(blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """texts x bands: a hash of each band's minima and the band's number, as signed longs."""
    value = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(found), bands)).copy()
    for r in range(rows):
        value = mixed(value * _BASE + found[:, r : bands * rows : rows].astype(np.uint64))
    return value.view(np.int64)
