"""Token ids of whole texts from the ids of their distinct chunks, for use inside tasks.

A space that a non-space follows always starts a token of the byte-level patterns, whatever stands before it. So a text
can be cut there, each distinct chunk be encoded once and the ids be joined again. Ids are kept as little-endian
unsigned 32-bit bytes: joining them is one call, and checksums need no conversion.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

INSIDE = re.compile(r" (?:\s|\Z)")
STARTS = re.compile(r" (?=\S)")

#: Chunks that a worker remembers about, each up to LONGEST characters; about 100 MB.
REMEMBERED = 400_000
LONGEST = 64
#: Characters of text that are worked on at once.
SLICE = 4_000_000


def chunked(text: str) -> list[str]:
    """The text cut at spaces before non-spaces, without those spaces."""
    return STARTS.split(text) if INSIDE.search(text) else text.split(" ")


def slices(batches: Iterator[pa.RecordBatch], text: str, chars: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with at most ``chars`` characters (or one row), and their texts, null as empty."""
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if size + len(t) > chars and i > start:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def small_slices(batches: Iterator[pa.RecordBatch], text: str, rows: int, chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """As ``slices``, with at most ``rows`` rows taken out of a batch together, and free memory given back at the end: a
    worker stays small beside what Spark itself needs, also while it waits for the next stage."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from slices(iter([batch.slice(start, rows)]), text, chars)
        del batch  # else it is held while the next one is read
    give_back()


def give_back() -> None:
    """Free memory that Arrow and the C library hold goes back to the system. What numpy and Python have freed is otherwise kept
    as long as anything above it is in use, which a worker that waits does not need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


class Recent(dict):
    """What was found lately, about ``limit`` entries: at half of them a new half begins, and what the one before has is taken
    over when it is asked for. So what comes often stays."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.before: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that are not here, after a look at the half before."""
        if len(self) > self.limit // 2:
            self.before = dict(self)
            self.clear()
        new = keys.difference(self)
        again = [k for k in new if k in self.before]
        self.update(zip(again, map(self.before.__getitem__, again)))
        return list(new.difference(again))


class ChunkEncoder:
    """Encodes texts by chunks. ``encode(list of str)`` gives the ids of each str, as bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED):
        self.encode = encode
        self.after_space = Recent(remembered)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [chunked(t) for t in texts]
        heads = [c[0] for c in cut]
        known = self.after_space
        new = known.missing({p for c in cut for p in c[1:]})
        ids = self.encode(heads + [f" {p}" for p in new])
        known.update(zip(new, ids[len(heads) :]))
        out = [head + b"".join([known[p] for p in c[1:]]) for head, c in zip(ids, cut)]
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return out


def as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
