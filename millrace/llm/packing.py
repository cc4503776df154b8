"""Best-two-fit packing of token sequences.

Documents are encoded once, cut into pieces where they exceed a sequence, and written as narrow rows. How pieces share
sequences depends on their lengths only, and there are at most as many lengths as a sequence has tokens. So the packing is
worked out on the counts by length (bounded by the sequence length, whatever the corpus): fill a sequence greedily with
the longest pieces that fit, then exchange its shortest piece for the two unpacked ones that fill the widened gap best,
and repeat that arrangement while the counts allow. Each piece then finds its place from its number among the pieces
of its length. Those numbers come from counts by partition and length, so a length that a third of all pieces have is
numbered in as many tasks as there are partitions.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import ChunkEncoder, as_bytes, small_slices
from millrace.llm.common import remembered, staged, table

#: Fixed value: how byte-level tokenizers cut a text before they merge.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: a byte-level vocabulary writes these bytes as themselves, and all others as the characters from 256 up.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Rows and characters that a worker takes at once, and chunks that it remembers: other stages need the memory as well.
TOGETHER = 500
SLICE = 1_000_000
REMEMBERED = 500_000
#: Of the pieces of one length, those from number ``first`` on lie ``each`` to a sequence, from sequence and offset on.
SPAN = ("first", "each", "sequence", "at")


def _by_rank(tokenizer, spec: dict) -> Callable[[list[str]], list[bytes]] | None:
    """A much faster encoder of chunks with the tokenizer's ids, where the file proves that ids alone settle every merge.

    That is so for a plain byte-level vocabulary whose merges are in the order of their ids if each entry encodes to
    itself: two neighbours that make up an entry are then merged by the file's rules too, as on the entry alone.
    """
    model = spec["model"]
    plain = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if any(spec[k] != v for k, v in plain.items()) or model["type"] != "BPE" or any(model.get(k) for k in odd):
        return None
    others = iter(range(256, 512))
    byte_of = {c: b for b, c in ((b, chr(b) if b in PLAIN_BYTES else chr(next(others))) for b in range(256))}
    vocabulary = model["vocab"]
    merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    if len(vocabulary) != len(merged) + 256 or any(a >= b for a, b in zip(merged, merged[1:])) or any(set(t) - byte_of.keys() for t in vocabulary):
        return None
    if any(len(tokenizer.model.tokenize(t)) != 1 for t in vocabulary):
        return None
    import tiktoken

    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
    quick = tiktoken.Encoding("quick", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    size[list(ranks.values())] = [len(t) for t in ranks]
    added = [t["content"] for t in spec["added_tokens"]]

    def encode(chunks: list[str]) -> list[bytes]:
        out = [b""] * len(chunks)
        text = "".join(chunks)
        told = [a for a in added if a in text]  # mostly none, then no chunk has to be searched for them
        lone = [i for i, c in enumerate(chunks) if c[:1] != " " or c[1:2].isspace() or len(c) < 2 or (told and any(a in c for a in told))]
        for i in lone:
            own = any(a in chunks[i] for a in told)
            out[i] = as_bytes(tokenizer.encode(chunks[i], add_special_tokens=False).ids if own else quick.encode_ordinary(chunks[i]))
        known = set(lone)
        rest = [i for i in range(len(chunks)) if i not in known]  # each starts a token, so they can follow one another
        follow = [chunks[i] for i in rest]
        text = "".join(follow)
        ids = np.array(quick.encode_ordinary(text), "<u4")
        ends = np.cumsum(np.fromiter(map(len, follow if text.isascii() else map(str.encode, follow)), np.int64, len(follow)))
        cuts = (4 * (np.searchsorted(np.cumsum(size[ids]), ends) + 1)).tolist()
        whole = ids.tobytes()
        for i, a, b in zip(rest, [0, *cuts], cuts):
            out[i] = whole[a:b]
        return out

    return encode


def chunk_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file."""

    def make() -> ChunkEncoder:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            quick = _by_rank(tokenizer, json.load(file))
        return ChunkEncoder(quick or (lambda chunks: [as_bytes(e.ids) for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]), REMEMBERED)

    return remembered(("chunk encoder", path), make)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Arrangements (lengths in descending order, how many sequences have it) that use up ``counts`` by length."""
    left = {size: n for size, n in counts.items() if n}
    sizes = sorted(left)
    plan = []
    while sizes:
        used: dict[int, int] = {}
        gap = capacity
        end = len(sizes)
        while end := bisect_right(sizes, gap, hi=end):  # the longest that fits, as often as it fits
            size = sizes[end - 1]
            used[size] = min(gap // size, left[size])
            gap -= size * used[size]
            end -= 1
        shortest = min(used)
        looked_at = dict(used)  # pieces that have to be there for the next sequence to be filled and mended alike
        if pair := _tighter_pair(sizes, left, used, gap + shortest, shortest):
            used[shortest] -= 1
            for size in pair:
                used[size] = used.get(size, 0) + 1
                looked_at[size] = looked_at.get(size, 0) + 1
        used = {size: n for size, n in used.items() if n}
        times = 1 + min((left[size] - looked_at[size]) // n for size, n in used.items())
        for size, n in used.items():
            left[size] -= n * times
            if not left[size]:
                del left[size]
                sizes.remove(size)
        plan.append(([size for size in sorted(used, reverse=True) for _ in range(used[size])], times))
    return plan


def _tighter_pair(sizes: list[int], left: dict[int, int], used: dict[int, int], room: int, least: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is the largest over ``least`` and up to ``room``."""
    best, found = least, None
    free = [s for s in sizes[: bisect_right(sizes, room)] if left[s] > used.get(s, 0)]
    for i in range(len(free) - 1, -1, -1):
        long = free[i]
        if 2 * long <= best:
            break
        j = bisect_right(free, min(long, room - long)) - 1
        if j == i and left[long] - used.get(long, 0) < 2:
            j -= 1
        if j >= 0 and long + free[j] > best:
            best, found = long + free[j], (long, free[j])
            if best == room:
                break
    return found


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, (ids,) part and nth among the part's pieces of this length."""
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField("id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]
    fields += [T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = as_bytes([end_id])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = chunk_encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, texts in small_slices(batches, "text", TOGETHER, SLICE):
            row, piece, start, length, crc, nth, kept = [], [], [], [], [], [], []
            for i, ids in enumerate(encoder(texts)):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if k == 0 else capacity
                    own = ids[4 * at : 4 * (at + size)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own))
                    nth.append(int(seen[size]))
                    if keep_ids:
                        kept.append(own)
                    seen[size] += 1
                    at, k = at + size, k + 1
            columns = [rows.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            columns += [pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(nth, pa.int64())]
            names = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_ids, names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, T.StructType(fields))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text (null: empty) and ``end_id``, so each has one token at least. A longer one than
    ``capacity`` is cut so that all pieces but the first are full. With ``keep_ids`` the ids come too, as little-endian
    unsigned 32-bit bytes. Equal rows are packed each on its own, an empty table gives no rows, and only the id and text
    columns are read, so others may have any name. Which of the pieces of one length goes where depends on the
    partitions; the number of sequences and their arrangements don't.
    """
    spark = docs.sparkSession
    pieces = staged(encode_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, keep_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # up to `capacity` rows

    spans: dict[int, list[tuple[int, int, int, int]]] = {}
    taken = dict.fromkeys(by_length, 0)
    sequence = 0
    for lengths, times in best_two_fit(by_length, capacity):
        offset = 0
        for size in dict.fromkeys(lengths):
            n = lengths.count(size)
            spans.setdefault(size, []).append((taken[size], n, sequence, offset))
            taken[size] += n * times
            offset += n * size
        sequence += times
    span = pa.struct([(c, pa.int64()) for c in SPAN])
    # as Arrow, since rows of Python objects would start workers of another kind on the executors, which stay
    places = spark.createDataFrame(pa.table({"length": pa.array(spans, pa.int64()), "spans": pa.array([[dict(zip(SPAN, x)) for x in s] for s in spans.values()], pa.list_(span))}))

    numbered = pieces.join(offsets, ["part", "length"]).withColumn("number", F.col("nth") + F.col("before"))
    placed = numbered.join(F.broadcast(places), "length").withColumn(  # a row per length, up to `capacity`
        "span", F.expr("element_at(filter(spans, s -> s.first <= number), -1)")
    )
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.expr("span.sequence + (number - span.first) div span.each").alias("sequence_id"),
        F.expr("span.at + ((number - span.first) % span.each) * length").alias("offset"),
        *["ids"] * keep_ids,
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
