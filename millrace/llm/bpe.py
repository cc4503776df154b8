"""Byte-level BPE encoding and decoding by DuckDB queries inside each Spark task.

Encoding: a task takes the distinct pattern matches of its texts that are no tokens themselves, lays them out as rows
(match, position, token), one per byte, and runs a recursive query. Each step joins neighbouring tokens with the merge
table, takes each match's smallest rank and contracts the leftmost pair that has it; the match is done when no pair is
left. Long matches would need a step for each of their merges. For them a step also contracts the later pairs of that
rank which don't overlap, as those would be next, unless the merge can give rise to a smaller rank than its own.
Decoding: one row per id, joined with the vocabulary, and the tokens put together by an aggregate ordered by place.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import ChunkEncoder, Recent, slices
from millrace.llm.common import remembered, table

#: Bytes of distinct matches that one recursive query gets at most (or one match).
QUERY_BYTES = 1_000_000
#: Ids that one decoding query gets at most (or one document).
QUERY_IDS = 1_000_000

#: Bytes from which a match counts as long.
LONG = 48

#: Chunks, and as many matches that took merges, that a worker remembers about; some 300 MB.
REMEMBERED = 1_000_000

CONTRACT = """
WITH RECURSIVE tokens(done, w, pos, npos, tok, ntok) AS (
  SELECT false, w, pos, pos + 1, tok, ntok FROM bytes
  UNION ALL (
    WITH pairs AS (
      SELECT w, merged * 1099511627776 + pos AS rank_and_pos, npos AS rpos
      FROM tokens JOIN merges ON pair = tok * 1048576 + ntok WHERE NOT done),
    lowest AS (SELECT w, min(rank_and_pos) AS best, arg_min(rpos, rank_and_pos) AS rpos FROM pairs GROUP BY w),
    hits AS (
      SELECT l.w, best % 1099511627776 AS pos, best // 1099511627776 AS merged, rpos, r.npos AS rnpos, r.ntok AS rntok
      FROM lowest l JOIN tokens r ON r.w = l.w AND r.pos = l.rpos)
    SELECT h.w IS NULL, t.w, t.pos, CASE WHEN t.pos = h.pos THEN rnpos ELSE t.npos END,
      CASE WHEN t.pos = h.pos THEN merged ELSE tok END,
      CASE WHEN t.pos = h.pos THEN rntok WHEN t.npos = h.pos THEN merged ELSE ntok END
    FROM tokens t LEFT JOIN hits h ON h.w = t.w
    WHERE NOT done AND (h.w IS NULL OR t.pos <> rpos)))
SELECT w, tok FROM tokens WHERE done ORDER BY w, pos
"""

CONTRACT_LONG = """
WITH RECURSIVE tokens(done, w, pos, npos, tok) AS (
  SELECT false, w, pos, pos + 1, tok FROM bytes
  UNION ALL (
    WITH live AS (SELECT w, pos, npos, tok FROM tokens WHERE NOT done),
    pairs AS (
      SELECT l.w, l.pos, r.pos AS rpos, r.npos AS rnpos, merged, single
      FROM live l JOIN live r ON r.w = l.w AND r.pos = l.npos JOIN merges ON pair = l.tok * 1048576 + r.tok),
    lowest AS (SELECT w, min(merged) AS merged FROM pairs GROUP BY w),
    runs AS (
      SELECT *, sum(apart) OVER (PARTITION BY w ORDER BY pos) AS run
      FROM (SELECT pairs.*, CASE WHEN lag(rpos) OVER (PARTITION BY w ORDER BY pos) = pos THEN 0 ELSE 1 END AS apart
            FROM pairs JOIN lowest USING (w, merged))),
    hits AS (
      SELECT w, pos, rpos, rnpos, merged
      FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS nth FROM runs)
      WHERE nth % 2 = 1 AND (NOT single OR (run = 1 AND nth = 1)))
    SELECT lowest.w IS NULL, live.w, live.pos, coalesce(hits.rnpos, live.npos), coalesce(hits.merged, live.tok)
    FROM live LEFT JOIN lowest ON lowest.w = live.w LEFT JOIN hits ON hits.w = live.w AND hits.pos = live.pos
      LEFT JOIN hits gone ON gone.w = live.w AND gone.rpos = live.pos
    WHERE gone.w IS NULL))
SELECT w, tok FROM tokens WHERE done ORDER BY w, pos
"""

DECODE = """
SELECT d, string_agg(hex, '' ORDER BY place) AS hex
FROM ids JOIN vocabulary USING (id) GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    """A vocabulary of ranks in a DuckDB database of its own, in memory."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(ranks_path)
        # white space by its Unicode property, whatever the pattern library counts as such
        spaces = pattern.replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
        self.matches = regex.compile(spaces).findall
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.decimal = [b"%d" % i for i in range(max(self.ranks.values()) + 1)]
        self.db = duckdb.connect(config={"threads": 1})
        self._load()
        self.texts = ChunkEncoder(self._encode_chunks, REMEMBERED)
        self.merged = Recent(REMEMBERED)

    def _load(self) -> None:
        ranks = self.ranks
        left, right, merged = [], [], []
        lowest: dict[int, int] = {}  # by token, the smallest rank of a merge that it takes part in
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
                    for part in (a, b):
                        lowest[part] = min(rank, lowest.get(part, rank))
        # a merge is single where its token takes part in a merge of a smaller rank
        single = [lowest.get(m, m) < m for m in merged]
        rows = {"pair": np.array(left, np.int64) * 1048576 + np.array(right, np.int64), "merged": np.array(merged, np.int64), "single": np.array(single, bool)}
        self._table("merges", pa.table(rows))
        self._table("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int64()), "hex": [t.hex() for t in ranks]}))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def contract(self, words: list[bytes], query: str = CONTRACT) -> list[bytes]:
        """The ids of each byte string (none empty), by merges only, as little-endian unsigned 32-bit bytes."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        tok = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        ntok = np.append(tok[1:], -1)
        ntok[starts[1:] - 1] = -1  # no pair reaches into the next word
        self.db.register("bytes", pa.table({"w": np.repeat(np.arange(len(words)), sizes), "pos": np.arange(len(tok)) - np.repeat(starts, sizes), "tok": tok, "ntok": ntok}))
        done = self.db.sql(query).to_arrow_table()
        self.db.unregister("bytes")
        ids = done["tok"].to_numpy().astype("<u4").tobytes()
        ends = 4 * np.searchsorted(done["w"].to_numpy(), np.arange(len(words)), "right")
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [[m.encode() for m in self.matches(c)] for c in chunks]
        distinct = {w for c in cut for w in c}
        ids = {w: self.ranks[w].to_bytes(4, "little") for w in distinct if w in self.ranks}
        new = self.merged.missing(distinct.difference(ids))
        ids.update((w, self.merged[w]) for w in distinct if w in self.merged)
        for query, words in ((CONTRACT, [w for w in new if len(w) < LONG]), (CONTRACT_LONG, [w for w in new if len(w) >= LONG])):
            todo, size = [], 0
            for w in words:
                if size + len(w) > QUERY_BYTES and todo:
                    ids.update(zip(todo, self.contract(todo, query)))
                    todo, size = [], 0
                todo.append(w)
                size += len(w)
            if todo:
                ids.update(zip(todo, self.contract(todo, query)))
        self.merged.update((w, ids[w]) for w in new if len(w) < LONG)
        return [b"".join([ids[w] for w in c]) for c in cut]

    def decode(self, docs: list[np.ndarray]) -> list[bytes]:
        """The bytes of each document's ids."""
        out = [b""] * len(docs)
        start = size = 0
        for i in range(len(docs) + 1):
            if i == len(docs) or (size + len(docs[i]) > QUERY_IDS and i > start):
                part = docs[start:i]
                sizes = np.array([len(d) for d in part], np.int64)
                rows = {"d": np.repeat(np.arange(start, i), sizes), "place": np.arange(sizes.sum()), "id": np.concatenate([np.zeros(0, np.int64), *part])}
                self.db.register("ids", pa.table(rows))
                for d, text in self.db.sql(DECODE).fetchall():
                    out[d] = bytes.fromhex(text)
                self.db.unregister("ids")
                start, size = i, 0
            size += len(docs[i]) if i < len(docs) else 0
        return out


def bpe(ranks_path: str, pattern: str) -> Bpe:
    """The worker's vocabulary of that file."""
    return remembered(("bpe", ranks_path, pattern), lambda: Bpe(ranks_path, pattern))


def _id_and(df: DataFrame, id_col: str, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("id", df.schema[id_col].dataType), *more])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array of int) of every row's whole text.

    Each match of the pattern is encoded separately, special tokens are ordinary text, and a null or empty text has no
    ids. Equal rows give equal rows, an empty table none; other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_of = bpe(ranks_path, pattern).texts
        for rows, texts in slices(batches, "text"):
            ids = texts_of(texts)
            ends = np.cumsum([0] + [len(i) // 4 for i in ids], dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([rows.column("id"), lists], ["id", "ids"])

    schema = _id_and(docs, id_col, T.StructField("ids", T.ArrayType(T.IntegerType())))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and decoded (binary) of every row's ids; null or no ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(i or [], np.int64) for i in batch.column("ids").to_pylist()]
            decoded = bpe(ranks_path, pattern).decode(ids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(decoded, pa.binary())], ["id", "decoded"])

    schema = _id_and(encoded, id_col, T.StructField("decoded", T.BinaryType()))
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass over the rows: id, n_tokens, ids_sha256, decoded_sha256."""
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe(ranks_path, pattern)
        for rows, texts in slices(batches, "text"):
            ids = [np.frombuffer(i, "<u4") for i in vocabulary.texts(texts)]
            decoded = vocabulary.decode(ids)
            written = [hashlib.sha256(b" ".join(map(vocabulary.decimal.__getitem__, i.tolist()))).hexdigest() for i in ids]
            columns = [rows.column("id"), pa.array(map(len, ids), pa.int64()), pa.array(written), pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
            yield pa.RecordBatch.from_arrays(columns, ["id", *[f.name for f in more]])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _id_and(docs, id_col, *more)).withColumnRenamed("id", id_col)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
