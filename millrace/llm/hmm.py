"""Hidden Markov language model: Baum-Welch counts from all partitions, exact likelihood by the scaled forward recursion.

A state emits a class of words, and the class one of its words: p(word | state) = p(class | state) * p(word | class). A
short word's class is its hash, a longer one's that of its first and last letters, so the states' tables have a fixed size
however many words there are, and rare words share what words of the same form tell. p(word | class) is the word's
count with one added, over all words of the corpus. The end of a text is a class of its own.

One pass cuts the documents into blocks and writes, for each, the documents as class numbers and as places in the block's
own list of words, and that list with its counts. Lists meet by a hash of the word; each word comes at most once from a
block, so a very frequent word is no hot key. There the counts are added up and sent back to the blocks. The lists thus
grow with the corpus and never reach the driver, which sees class totals and the states' tables only.

Training starts from states around anchor classes: frequent classes whose company differs most, from a table of how often
the most frequent ones share a document. Each round then runs forward and backward recursions over all training
documents, scaled at each token, adds the expected counts of all partitions and takes new tables from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import slices
from millrace.llm.common import staged, table

STATES = 8
ROUNDS = 4
#: Classes, the end of a text (0) included.
CLASSES = 1 << 15
#: Bytes up to which a word is in the class of its hash; longer ones go by this many bytes, half from either side.
WHOLE = 6
#: Frequent classes whose company is tabled to choose the first states.
COMPANY = 128
#: Characters of a block; it has one document at least.
BLOCK_CHARS = 8_000_000
#: Bytes of text for which there is one group of word lists.
LIST_BYTES = 32_000_000
#: Tokens whose state probabilities are held at once.
HELD = 1_000_000
#: Tokens' worth of the corpus' own frequencies that smooths a state's emissions.
SMOOTHING = 100.0


def class_of(word: bytes) -> int:
    form = word if len(word) <= WHOLE else word[: WHOLE // 2] + b" " + word[-WHOLE // 2 :]
    return xxhash.xxh32_intdigest(form) % (CLASSES - 1) + 1


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 by 7, or there is no id: nothing is learned from the row."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(True))


@dataclass
class Hmm:
    start: np.ndarray  # by state
    step: np.ndarray  # from state x to state
    emit: np.ndarray  # class x state


@dataclass
class Aligned:
    """Documents side by side, longest first: the t-th tokens of all that have one are tokens[at[t]:at[t + 1]]."""

    order: np.ndarray
    tokens: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Aligned:
        sizes = np.array([len(d) for d in docs])
        order = np.argsort(-sizes, kind="stable")
        width = len(docs) - np.searchsorted(np.sort(sizes), np.arange(sizes.max()), "right")
        at = np.concatenate([[0], np.cumsum(width)])
        tokens = np.empty(at[-1], np.uint16)
        for i, d in enumerate(order):
            tokens[at[: sizes[d]] + i] = docs[d]
        return cls(order, tokens, at)


def _batches(docs: list[np.ndarray]) -> Iterator[Aligned]:
    """Documents of up to HELD tokens together, or one."""
    start = size = 0
    for i, d in enumerate(docs):
        if size + len(d) > HELD and i > start:
            yield Aligned.of(docs[start:i])
            start, size = i, 0
        size += len(d)
    if start < len(docs):
        yield Aligned.of(docs[start:])


def _forward(model: Hmm, docs: Aligned, t0: int, t1: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """State probabilities after each token from t0 to t1, and what each token was scaled by. before: those at t0 - 1."""
    first = docs.at[t0]
    state = model.emit[docs.tokens[first : docs.at[t1]]]
    scale = np.empty(len(state))
    for t in range(t0, t1):
        a, b = docs.at[t] - first, docs.at[t + 1] - first
        now = state[a:b]
        now *= model.start if before is None else before[: b - a] @ model.step
        scale[a:b] = now.sum(axis=1)
        now /= scale[a:b, None]
        before = now
    return state, scale


def _spans(docs: Aligned) -> list[tuple[int, int]]:
    """Stretches of time with up to HELD tokens, so that one very long document is worked on in parts."""
    spans, t = [], 0
    while t < len(docs.at) - 1:
        end = max(t + 1, int(np.searchsorted(docs.at, docs.at[t] + HELD, "right")) - 1)
        spans.append((t, end))
        t = end
    return spans


def log_likelihood(model: Hmm, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log of each document's probability, by the forward recursion."""
    out, done = np.zeros(len(docs)), 0
    for batch in _batches(docs):
        sums, before = np.zeros(len(batch.order)), None
        for t0, t1 in _spans(batch):
            state, scale = _forward(model, batch, t0, t1, before)
            place = np.arange(len(scale)) - np.repeat(batch.at[t0:t1] - batch.at[t0], np.diff(batch.at[t0 : t1 + 1]))
            sums += np.bincount(place, weights=np.log(scale), minlength=len(sums))
            before = state[batch.at[t1 - 1] - batch.at[t0] :]
        out[done + batch.order] = sums
        done += len(batch.order)
    return out


class Expected:
    """Baum-Welch counts of the documents given so far."""

    def __init__(self) -> None:
        self.start, self.step, self.emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))

    def add(self, model: Hmm, docs: list[np.ndarray]) -> None:
        for batch in _batches(docs):
            spans, befores, kept = _spans(batch), [None], None
            for t0, t1 in spans:  # where each stretch begins; with one stretch, all there is to know
                kept = _forward(model, batch, t0, t1, befores[-1])
                befores.append(kept[0][batch.at[t1 - 1] - batch.at[t0] :])
            after: np.ndarray | None = None  # backward probabilities of the next time, with its emissions and scale
            for n in range(len(spans) - 1, -1, -1):
                t0, t1 = spans[n]
                state, scale = kept if n == len(spans) - 1 else _forward(model, batch, t0, t1, befores[n])
                after = self._backward(model, batch, t0, t1, state, scale, after)

    def _backward(self, model: Hmm, docs: Aligned, t0: int, t1: int, state: np.ndarray, scale: np.ndarray, after: np.ndarray | None) -> np.ndarray:
        first = docs.at[t0]
        emitted = model.emit[docs.tokens[first : docs.at[t1]]]
        emitted /= scale[:, None]
        counts = np.zeros((STATES, STATES))
        for t in range(t1 - 1, t0 - 1, -1):
            a, b = docs.at[t] - first, docs.at[t + 1] - first
            now, here = emitted[a:b], state[a:b]
            if after is not None:  # the documents that go on
                m = len(after)
                back = after @ model.step.T
                previous = here[:m]
                counts += previous.T @ after
                now[:m] *= back
                previous *= back
            after = now
        self.step += counts * model.step
        # state now holds each token's state probabilities given the whole document
        tokens = docs.tokens[first : docs.at[t1]]
        for z in range(STATES):
            self.emit[:, z] += np.bincount(tokens, weights=state[:, z], minlength=CLASSES)
        if t0 == 0:
            self.start += state[: docs.at[1]].sum(axis=0)
        return after

    def rows(self) -> pa.RecordBatch:
        """A row per class, then per state stepped from, then the start."""
        whole = np.concatenate([self.emit, self.step, self.start[None]])
        some = np.flatnonzero(whole.any(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(whole[some, z]) for z in range(STATES))], ["row", *[f"s{z}" for z in range(STATES)]])


def _blocks(docs: DataFrame, id_col: str, text_col: str, lists: int) -> DataFrame:
    """Documents (classes and words not null) and word lists by block and list (n not null)."""
    fields = [
        T.StructField("block", T.LongType()),
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("classes", T.BinaryType()),  # uint16 each
        T.StructField("places", T.BinaryType()),  # uint32 each, in the block's word list
        T.StructField("list", T.IntegerType()),
        T.StructField("first", T.IntegerType()),  # place of the list's first word
        T.StructField("words", T.BinaryType()),  # with a line feed after each
        T.StructField("n", T.BinaryType()),  # uint32 each: times in training documents
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows, texts in slices(batches, "text", BLOCK_CHARS):
            cut = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
            train = ~np.array(rows.column("held_out").to_pylist(), bool)
            seen: dict[bytes, int] = {}
            flat = np.array([seen.setdefault(w, len(seen)) for c in cut for w in c], np.int64)
            sizes = np.array([len(c) for c in cut])
            words = list(seen)
            in_list = np.array([xxhash.xxh32_intdigest(w, 1) % lists for w in words], np.int64)
            often = np.bincount(flat, minlength=len(words))
            order = np.lexsort((-often, in_list))
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            classes = np.array([class_of(w) for w in words], np.uint16)[flat] if words else np.zeros(0, np.uint16)
            places = place[flat].astype("<u4")
            n = np.bincount(places[np.repeat(train, sizes)], minlength=len(words)).astype("<u4")
            cuts = np.searchsorted(in_list[order], np.arange(lists + 1))
            held = [k for k in range(lists) if cuts[k] < cuts[k + 1]]
            ends = np.cumsum(sizes)
            made = len(texts) + len(held)
            none, blank = [None] * len(held), [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * made, pa.int64()),
                    pa.concat_arrays([rows.column("id"), pa.nulls(len(held), rows.column("id").type)]),
                    pa.array(rows.column("held_out").to_pylist() + none, pa.bool_()),
                    pa.array([classes[e - s : e].tobytes() for s, e in zip(sizes, ends)] + none, pa.binary()),
                    pa.array([places[e - s : e].tobytes() for s, e in zip(sizes, ends)] + none, pa.binary()),
                    pa.array(blank + held, pa.int32()),
                    pa.array(blank + [cuts[k] for k in held], pa.int32()),
                    pa.array(blank + [b"".join(words[i] + b"\n" for i in order[cuts[k] : cuts[k + 1]]) for k in held], pa.binary()),
                    pa.array(blank + [n[cuts[k] : cuts[k + 1]].tobytes() for k in held], pa.binary()),
                ],
                [f.name for f in fields],
            )
            block += 1

    source = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, T.StructType(fields))


def _counted(lists: DataFrame) -> DataFrame:
    """For each word list its words' counts in all training documents; and rows (class, count, words) of classes' totals."""

    def add(lists: pd.DataFrame) -> pd.DataFrame:
        words = [w for blob in lists["words"] for w in blob.split(b"\n")[:-1]]
        seen: dict[bytes, int] = {}
        flat = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
        total = np.bincount(flat, weights=np.frombuffer(b"".join(lists["n"]), "<u4"), minlength=len(seen)).astype(np.int64)
        ends = np.cumsum([len(n) // 4 for n in lists["n"]])
        back = pd.DataFrame({"block": lists["block"], "first": lists["first"], "counts": [c.astype("<i8").tobytes() for c in np.split(total[flat], ends[:-1])]})
        known = np.flatnonzero(total)
        names = list(seen)
        classes = np.array([class_of(names[i]) for i in known], np.int64)
        held = np.unique(classes)
        of_class = {"class": held, "count": np.bincount(classes, weights=total[known], minlength=CLASSES)[held].astype(np.int64), "words": np.bincount(classes, minlength=CLASSES)[held]}
        return pd.concat([back, pd.DataFrame(of_class)])[["block", "first", "counts", "class", "count", "words"]].astype({c: "Int64" for c in ("block", "first", "class", "count", "words")})

    return lists.groupBy("list").applyInPandas(add, "block long, first long, counts binary, class long, count long, words long")


def _documents(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Class numbers of each document, with the end."""
    return [np.append(np.frombuffer(c, np.uint16), np.uint16(0)) for c in batch.column("classes").to_pylist()]


def _first_states(train: DataFrame, share: np.ndarray) -> Hmm:
    """States around anchor classes; every class that is not tabled starts with its share of the corpus."""
    top = np.argsort(-share[1:], kind="stable")[:COMPANY] + 1
    column = np.full(CLASSES, -1, np.int64)
    column[top] = np.arange(len(top))

    def company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = np.zeros((len(top), len(top)))
        for batch in batches:
            for c in batch.column("classes").to_pylist():
                found = column[np.frombuffer(c, np.uint16)]
                found = found[found >= 0]
                if len(found):
                    has = np.bincount(found, minlength=len(top)) / np.sqrt(len(found))
                    held = np.flatnonzero(has)
                    shared[np.ix_(held, held)] += np.outer(has[held], has[held])
        i, j = np.nonzero(shared)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(shared[i, j])], ["i", "j", "n"])

    table_ = np.zeros((len(top), len(top)))
    for r in train.select("classes").mapInArrow(company, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # COMPANY x COMPANY
        table_[r["i"], r["j"]] = r["n"]
    rows = table_ / np.maximum(table_.sum(axis=1, keepdims=True), 1e-12)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    anchors, rest = [], rows - rows.mean(axis=0)
    for _ in range(STATES):  # the class farthest from what the chosen ones span
        far = int(np.argmax(np.linalg.norm(rest, axis=1)))
        anchors.append(far)
        direction = rest[far] / max(np.linalg.norm(rest[far]), 1e-12)
        rest = rest - np.outer(rest @ direction, direction)
    near = np.exp(8 * rows @ rows[anchors].T)
    near /= near.sum(axis=1, keepdims=True)
    emit = np.repeat(share[:, None], STATES, axis=1)
    emit[top] *= near * STATES
    step = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
    return Hmm(np.full(STATES, 1 / STATES), step, emit / emit.sum(axis=0))


def _trained(train: DataFrame, share: np.ndarray, rounds: int) -> Hmm:
    model = _first_states(train, share)
    context = train.sparkSession.sparkContext
    schema = "row int, " + ", ".join(f"s{z} double" for z in range(STATES))
    for _ in range(rounds):
        now = context.broadcast(model)  # CLASSES x STATES numbers

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            counts = Expected()
            for batch in batches:
                counts.add(now.value, _documents(batch))
            yield counts.rows()

        sums = train.select("classes").mapInArrow(expect, schema).groupBy("row").agg(*[F.sum(f"s{z}").alias(f"s{z}") for z in range(STATES)]).toPandas()  # a row per class and state
        whole = np.zeros((CLASSES + STATES + 1, STATES))
        whole[sums["row"].to_numpy(int)] = sums.drop(columns="row").to_numpy(float)
        emit = whole[:CLASSES] + SMOOTHING * share[:, None]
        step, start = whole[CLASSES:-1] + 1 / STATES, whole[-1] + 1
        model = Hmm(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        now.unpersist()
    return model


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """A row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text's tokens are its words with A-Z lower-cased, cut at blanks, tabs, line and page breaks, and one end. The model
    learns from rows that are not held out. base_score is the log10 probability by unigrams with one added, score that
    by the hidden Markov model, a word not seen in training being each class's unknown word. Null and empty texts have
    the end only. Rows without an id are scored and not learned from. Equal rows are scored each, an empty table gives
    no rows, and other columns aren't read.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    made = staged(_blocks(docs, id_col, text_col, size // LIST_BYTES + 1), "blocks")
    documents = made.where("classes is not null")
    counted = staged(_counted(made.where("n is not null").select("block", "list", "first", "words", "n")), "counts")
    ends = documents.where("not held_out").count()
    count, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counted.where("class is not null").groupBy("class").agg(F.sum("count").alias("count"), F.sum("words").alias("words")).collect():  # a row per class
        count[r["class"]], kinds[r["class"]] = r["count"], r["words"]
    count[0], kinds[0] = ends, int(ends > 0)
    n, v = int(count.sum()), int(kinds.sum())
    model = _trained(documents.where("not held_out"), (count + 1) / (n + CLASSES), rounds)
    given = docs.sparkSession.sparkContext.broadcast((model, count + kinds + 1))

    id_type = docs.schema[id_col].dataType
    scored = T.StructType([T.StructField("block", T.LongType()), T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("places", T.BinaryType())])
    scored.add("classes", T.BinaryType()).add("log_p", T.DoubleType())

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, room = given.value
            found = _documents(batch)
            # p(word | class) without its numerator; the end is its class's only word
            inside = np.array([np.log(room[d[:-1]]).sum() for d in found])
            log_p = (log_likelihood(model, found) - inside) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("block", "id", "held_out", "places")] + [pa.array(log_p)], names)

    names = ["block", "id", "held_out", "places", "log_p"]
    forward_schema = T.StructType([f for f in scored.fields if f.name in names])
    likely = documents.select("block", "id", "held_out", "places", "classes").mapInArrow(forward, forward_schema)
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("held_out", T.BooleanType())])
    for c in ("n_tokens", "n_known", "train_tokens"):
        out.add(c, T.LongType())
    out.add("base_score", T.DoubleType()).add("score", T.DoubleType())
    base_of_end = np.log10((ends + 1) / (n + v + 1))

    def finish(docs: pa.Table, counts: pa.Table) -> pa.Table:
        lists = sorted(zip(counts["first"].to_pylist(), counts["counts"].to_pylist()))
        c = np.frombuffer(b"".join(blob for _, blob in lists), "<i8")
        log_c, known = np.log10(c + 1.0), c > 0
        places = [np.frombuffer(p, "<u4") for p in docs["places"].to_pylist()]
        tokens = np.array([len(p) + 1 for p in places])
        sums = np.array([log_c[p].sum() for p in places])
        base = sums - (tokens - 1) * np.log10(n + v + 1) + base_of_end
        columns = [docs["id"], docs["held_out"], tokens, [int(known[p].sum()) + (ends > 0) for p in places], [n] * len(places), base, sums + docs["log_p"].to_numpy() / np.log(10)]
        return pa.table([x if isinstance(x, pa.ChunkedArray) else pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)

    arrow = pa.schema([pa.field(id_col, _arrow_type(id_type)), pa.field("held_out", pa.bool_()), *(pa.field(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")), pa.field("base_score", pa.float64()), pa.field("score", pa.float64())])
    counts = counted.where("block is not null").select("block", "first", "counts")
    return likely.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(finish, out)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op3_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
