"""Language identification, word first: known words score by their log frequency per language, others back off to n-grams.

The model is fitted on a bounded sample of labelled rows and small enough to go to every task. A word that the sample has
scores, for each language, the log of its share among that language's words. Any other word is cut into character n-grams
of the longest length of which the model knows one; the n-grams known at that length score, and shorter ones are tried
only where none is. A text's language is the one with the largest sum over all its words.

Words and n-grams are 64-bit hashes in ascending order beside one matrix of their scores, so the model takes a few
megabytes whatever holds it, and the distinct words of many texts are looked up at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import give_back, small_slices
from millrace.llm.common import free_name, table

#: Labelled rows of each language that the model is fitted on, on average over samples; their whole texts are used.
SAMPLE_ROWS = 1_500
#: Lengths of the n-grams that are tried, longest first. Length 0 stands for whole words.
GRAMS = (5, 4, 3, 2, 1)
#: Rows that are taken out of a batch together, characters of text whose words are scored at once, and characters of words
#: that are cut into n-grams at once: a worker stays small beside what Spark itself needs.
ROWS, SLICE, STRETCH = 500, 500_000, 200_000

UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_START, _END = np.uint64(0x110000), np.uint64(0x110001)


def letters(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall(text.lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' characters as numbers, one word after the other, and the words' lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def _windows(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n numbers from each place on."""
    many = max(len(points) - n + 1, 0)
    value = np.full(many, n, np.uint64)
    for j in range(n):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + points[j : j + many])
    return value


def word_keys(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; no word is empty."""
    points, size = _points(words)
    if not len(size):
        return np.zeros(0, np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(len(points), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64)
    return _mixed(np.add.reduceat(_mixed(points + (place << np.uint64(32))), first) + size.astype(np.uint64))


def gram_keys(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words' n-grams and the number of each one's word. Words stand between marks, but for n of 1."""
    points, size = _points([f"<{w}>" for w in words] if n > 1 else words)
    word = np.repeat(np.arange(len(size)), size)
    value = _windows(points, n)
    inside = word[: len(value)] == word[n - 1 :] if len(value) else np.zeros(0, bool)
    return value[inside], word[: len(value)][inside]


def entries(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, keys and numbers of the words of all entries that the words give: themselves (length 0) and their n-grams."""
    yield 0, word_keys(words), np.arange(len(words))
    for n in GRAMS:
        yield n, *gram_keys(words, n)


class Entries:
    """Scores by language of words or of n-grams of one length: ascending keys beside a matrix, keys x languages."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, n: np.ndarray, languages: int):
        """Log frequencies, with half a count added, from how often (n) each language (its number) has each key."""
        self.keys, at = np.unique(key, return_inverse=True)
        counts = np.zeros((len(self.keys), languages))
        np.add.at(counts, (at, lang), n)
        totals = np.maximum(counts.sum(axis=0) + 0.5 * len(self.keys), 0.5)
        self.scores = (np.log(counts + 0.5) - np.log(totals)).astype(np.float32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are known, and the rows of those."""
        if not len(self.keys):
            return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = self.keys[at] == wanted
        return known, at[known]

    def __contains__(self, word: str) -> bool:
        return bool(self.find(word_keys([word]))[0][0])


class WordBackoff:
    """Scores by language of words, from how often each language has each word."""

    def __init__(self, by_language: dict[str, Counter]):
        languages = sorted(by_language)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for number, lang in enumerate(languages):
            times = np.array(list(by_language[lang].values()), np.int64)
            for length, keys, of in entries(list(by_language[lang])):
                parts.append((np.full(len(keys), length), keys, np.full(len(keys), number), times[of]))
        self._fit(languages, *map(np.concatenate, zip(*parts)))

    @classmethod
    def of_entries(cls, languages: list[str], length: np.ndarray, key: np.ndarray, lang: np.ndarray, n: np.ndarray) -> WordBackoff:
        """The model of how often (n) each language (its number) has each entry (length and key)."""
        model = cls({})
        model._fit(languages, length, key, lang, n)
        return model

    def _fit(self, languages: list[str], length: np.ndarray, key: np.ndarray, lang: np.ndarray, n: np.ndarray) -> None:
        self.languages = languages
        of = {kind: Entries(key[length == kind], lang[length == kind], n[length == kind], len(languages)) for kind in (0, *GRAMS)}
        self.words, self.grams = of[0], [(kind, of[kind]) for kind in GRAMS]

    def word(self, word: str) -> np.ndarray:
        return self.scored([word])[0]

    def scored(self, words: list[str]) -> np.ndarray:
        """words x languages: each word's scores, zeros for a word of which nothing is known."""
        out = np.zeros((len(words), len(self.languages)))
        known, at = self.words.find(word_keys(words))
        out[known] = self.words.scores[at]
        left = np.flatnonzero(~known)
        for n, grams in self.grams:
            still = []
            ends = np.cumsum([len(words[i]) for i in left]) // STRETCH  # a bounded number of characters at once
            for part in np.split(left, np.flatnonzero(np.diff(ends)) + 1) if len(left) else []:
                keys, word = gram_keys([words[i] for i in part], n)
                known, at = grams.find(keys)
                word = word[known]
                times = np.bincount(word, minlength=len(part))
                for j in range(len(self.languages)):
                    out[part, j] = np.bincount(word, weights=grams.scores[at, j], minlength=len(part)) / np.maximum(times, 1)
                still.append(part[times == 0])
            left = np.concatenate(still) if still else left
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text: the languages' shares by mean score a word, sharpened by the root of the words.

        Without letters, or without a fitted language, the language is unknown and the score 0.
        """
        cut = [letters(t) for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        some = np.flatnonzero(n)
        if not self.languages or not len(some):
            return out
        place: dict[str, int] = {}
        flat = np.fromiter((place.setdefault(w, len(place)) for c in cut for w in c), np.int64, n.sum())
        scores = self.scored(list(place))
        starts = (np.cumsum(n) - n)[some]
        sums = np.stack([np.add.reduceat(scores[flat, j], starts) for j in range(len(self.languages))], axis=1)
        best = sums.argmax(axis=1)
        shares = np.exp((sums - sums.max(axis=1, keepdims=True)) / np.sqrt(n[some])[:, None])
        for i, b, share in zip(some, best, shares.max(axis=1) / shares.sum(axis=1)):
            out[i] = self.languages[b], float(share)
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 0 by 5, or there is no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", by_col: str = "doc_id", rows: int = SAMPLE_ROWS) -> WordBackoff:
    """A model of a sample of the rows that have text and language: about ``rows`` of each language, or all if it has fewer.

    A row is in the sample when the hash of its ``by_col`` is small enough, so the sample depends on no order and no group
    is gathered. Words and n-grams are counted in the tasks; the counts of the sample's entries by key are what reaches the
    driver. A table without a row that has both gives a model without languages, whose every answer is ``und``; a language
    whose texts have no word is known and takes part with nothing learned.
    """
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(by_col), F.lit(1_000_000)).alias("lot"))
    labelled = labelled.where("text is not null and lang is not null")
    n = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row per language
    sample = labelled.join(F.broadcast(n), "lang").where(F.col("lot") * F.col("n") < rows * 1_000_000).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_slices(batches, "text", ROWS, SLICE):
            found = Counter((lang, w) for lang, t in zip(part.column("lang").to_pylist(), texts) for w in ["", *letters(t)])
            yield pa.RecordBatch.from_pydict({"lang": [lang for lang, _ in found], "word": [w for _, w in found], "n": pa.array(found.values(), pa.int64())})

    counted = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.filter(pc.equal(batch.column("word"), ""))  # stand for the texts, so that a language without words is known too
            yield pa.RecordBatch.from_arrays([texts.column("lang"), pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.int64()), texts.column("n")], names)
            words = batch.filter(pc.not_equal(batch.column("word"), ""))
            for length, keys, of in entries(words.column("word").to_pylist()):
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays([words.column("lang").take(at), pa.array(np.full(len(keys), length, np.int32)), pa.array(keys.view(np.int64)), words.column("n").take(at)], names)
        give_back()

    names = ["lang", "length", "key", "n"]
    found = counted.mapInArrow(cut, "lang string, length int, key long, n long").groupBy("lang", "length", "key").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(found.column("lang").unique().to_pylist())
    found = found.filter(pc.is_valid(found.column("key")))
    number = pc.index_in(found.column("lang"), pa.array(languages, pa.string()))
    length, key, lang, n = (c.to_numpy() for c in (found.column("length"), found.column("key"), number, found.column("n")))
    return WordBackoff.of_entries(languages, length, key.view(np.uint64), lang, n)


def with_language(docs: DataFrame, model: WordBackoff, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus language (``und`` without letters or text) and score (0 to 1).

    Reads the text only. A column that already has an output's name keeps it; the output's gets underscores in front.
    """
    lang_name, score_name = free_name(docs, lang_out), free_name(docs, score_out)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in small_slices(batches, text_col, ROWS, SLICE):
            found = shared.value.predict(texts)
            columns = [*rows.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    found = with_language(docs.select("doc_id", "text", held_out().alias("held_out")).select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
