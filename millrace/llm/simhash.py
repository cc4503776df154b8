"""Near duplicates by SimHash and the generalised pigeonhole principle.

Each distinct fingerprint of 64 bits is one node; copies share it. Bits that agree with each other over all fingerprints
are put into the same block of 16, and a partition is one block or two. If two fingerprints differ in at most t bits,
thresholds t_i of the partitions with sum t - m + 1 (m partitions, -1 leaves one out) guarantee a partition in which they
differ in at most t_i. So a fingerprint that looks up, in each partition, all values up to t_i flipped bits away meets all
that it is linked with.

The thresholds are chosen for each fingerprint anew by dynamic programming: how many fingerprints have a block's value, and
how many lie each number of bits from it, is counted exactly (a table of 65,536 counts a block whatever the input), two
blocks in one partition are taken as independent. Probes and candidates make the cost, so a fingerprint leaves out the
partition in which it shares a frequent value. Which blocks are put together is chosen by the total cost over all
fingerprints: large inputs get fewer and wider partitions.

Not all pairs of fingerprints that share a value are compared: first each with its value's centre, the one that meets most
others; then, where a value's fingerprints are still in several components, those outside of the largest with all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import shingles
from millrace.llm.chunks import slices
from millrace.llm.common import BROADCAST_ROWS, staged, table
from millrace.llm.links import components

SEED = 42
BITS, WIDTH = 64, 16
BLOCKS = BITS // WIDTH
#: Ways to put the blocks together to partitions.
PLANS = (((0,), (1,), (2,), (3,)), ((0, 1), (2,), (3,)), ((0, 1), (2, 3)))
#: What comparing one candidate costs beside one probe, which is shuffled.
CANDIDATE = 0.1
#: Differing bits up to which fingerprints can be linked; the number of probes grows quickly beyond.
MOST = 7

_SPREAD = (np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64) & np.uint64(1)) << np.arange(0, 64, 8, dtype=np.uint64)
#: A byte's bits, each in a byte of its own.
_LANES = np.bitwise_or.reduce(_SPREAD, axis=1)
#: Hashes whose bits can be summed in single bytes.
_STRETCH = 255


def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of the text's shingles of k words, joined by a space, repeats included; fewer words are one shingle, none are none."""
    words = shingles.words(text)
    if not words:
        return []
    parts = map(b" ".join, zip(*(words[j:] for j in range(k)))) if len(words) >= k else [b" ".join(words)]
    return list(map(xxhash.xxh64_intdigest, parts, repeat(SEED)))


def majority(hashes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A number for each text, whose bits are set in over half of its hashes; zero without any."""
    out = np.zeros(len(many), np.uint64)
    if not many.sum():
        return out
    stretches = -(-many // _STRETCH)
    text = np.repeat(np.arange(len(many)), stretches)
    number = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    starts = (np.cumsum(many) - many)[text] + number * _STRETCH
    sums = np.empty((len(text), 8), np.uint64)
    octets = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    for lo in range(0, len(starts), 128):
        part = starts[lo : lo + 128]
        end = starts[lo + 128] if lo + 128 < len(starts) else len(hashes)
        sums[lo : lo + 128] = np.add.reduceat(_LANES[octets[part[0] : end]], part - part[0], axis=0)
    some = np.flatnonzero(many)
    counts = np.add.reduceat(sums.view(np.uint8).astype(np.int64), (np.cumsum(stretches) - stretches)[some], axis=0)
    out[some] = np.packbits(2 * counts > many[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _prints(docs: DataFrame, k: int) -> DataFrame:
    """id and fp (signed long) of every row with id and text."""
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            found = [np.array(shingle_hashes(t, k), np.uint64) for t in texts]
            value = majority(np.concatenate(found), np.array([len(f) for f in found], np.int64))
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(value.view(np.int64))], ["id", "fp"])

    return docs.mapInArrow(run, schema)


def _columns(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_blocks(nodes: DataFrame) -> np.ndarray:
    """BLOCKS x WIDTH numbers of bits: bits that agree with each other over all ``nodes`` (fp) share a block.

    A block starts with the bit left that is correlated with the others most and takes, one by one, the bit most
    correlated with it. Each task adds up a table of 64 x 64 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for values in _columns(batches, "fp"):
            bits = _bits(values).astype(np.float64)
            total += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"cell": np.arange(BITS * BITS), "n": total.ravel().astype(np.int64)})

    cells = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros(BITS * BITS)
    both[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    share = both.reshape(BITS, BITS) / max(nodes.count(), 1)
    p = share.diagonal()
    spread = np.sqrt(p * (1 - p))
    alike = np.abs(share - np.outer(p, p)) / np.maximum(np.outer(spread, spread), 1e-12)
    left, blocks = list(range(BITS)), []
    for _ in range(BLOCKS):
        block = [max(left, key=lambda b: (alike[b, left].sum(), -b))]
        left.remove(block[0])
        while len(block) < WIDTH:
            block.append(max(left, key=lambda b: (alike[b, block].sum(), -b)))
            left.remove(block[-1])
        blocks.append(sorted(block))
    return np.array(blocks)


def block_values(values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """fingerprints x blocks: the bits of each block as a number."""
    bits = _bits(values)
    return np.stack([bits[:, b] @ (1 << np.arange(WIDTH)) for b in blocks], axis=1)


def near_counts(counts: np.ndarray, most: int) -> np.ndarray:
    """(most + 1) x values: how many have a value that differs from each value in exactly 0, 1, ... bits."""
    out = np.zeros((most + 1, len(counts)))
    out[0] = counts
    values = np.arange(len(counts))
    for bit in range(len(counts).bit_length() - 1):
        out[1:] = out[1:] + out[:-1, values ^ (1 << bit)]
    return out


class Thresholds:
    """The cheapest thresholds of each fingerprint, by dynamic programming over a plan's partitions."""

    def __init__(self, near: np.ndarray, most: int):
        """``near``: for each block its ``near_counts``."""
        self.near, self.most, self.total = near, most, max(float(near[0, 0].sum()), 1.0)

    def candidates(self, values: np.ndarray, part: tuple[int, ...]) -> np.ndarray:
        """fingerprints x (most + 1): how many differ from each in exactly 0, 1, ... of the partition's bits."""
        found = self.near[part[0]][:, values[:, part[0]]].T
        for block in part[1:]:
            other = self.near[block][:, values[:, block]].T / self.total
            found = np.stack([sum(found[:, i] * other[:, e - i] for i in range(e + 1)) for e in range(self.most + 1)], axis=1)
        return found

    def choose(self, values: np.ndarray, plan: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
        """(thresholds, cost): fingerprints x partitions, -1 where a partition is left out, and the cost of each row."""
        budget = self.most + 1  # thresholds plus one add up to this
        best = np.full((len(values), budget + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for part in plan:
            width = WIDTH * len(part)
            probes = np.cumsum([comb(width, e) for e in range(budget)])
            cost = np.concatenate([np.zeros((len(values), 1)), probes + CANDIDATE * np.cumsum(self.candidates(values, part), axis=1)], axis=1)
            ways = np.stack([np.stack([best[:, s - t] + cost[:, t] if t <= s else np.full(len(values), np.inf) for t in range(budget + 1)]) for s in range(budget + 1)])
            taken.append(ways.argmin(axis=1))  # sums x fingerprints
            best = ways.min(axis=1).T
        left, rows = np.full(len(values), budget), np.arange(len(values))
        chosen = np.empty((len(values), len(plan)), np.int64)
        for i in range(len(plan) - 1, -1, -1):
            chosen[:, i] = taken[i][left, rows] - 1
            left = left - chosen[:, i] - 1
        return chosen, best[:, budget]


def _flips(width: int, bits: int) -> np.ndarray:
    """All numbers of ``width`` bits of which ``bits`` are set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), bits)], np.int64)


def probes(fps: np.ndarray, values: np.ndarray, chosen: np.ndarray, plan: tuple[tuple[int, ...], ...], near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool, np.ndarray]]:
    """(keys, fingerprints, own, looks): each fingerprint under its own value of each partition, and where it looks up others'.

    ``looks`` tells whether a fingerprint looks up its own value. Values that no fingerprint has aren't looked up, and
    nothing is filed under a value that is alone up to the largest distance."""
    for i, part in enumerate(plan):
        own = sum(values[:, b] << (WIDTH * j) for j, b in enumerate(part))
        around = np.prod([near[b][:, values[:, b]].sum(axis=0) for b in part], axis=0)
        filed = around > 1
        yield own[filed] | (i << 40), fps[filed], True, chosen[filed, i] >= 0
        for t in range(1, int(chosen[:, i].max(initial=0)) + 1):
            rows = np.flatnonzero(chosen[:, i] >= t)
            for lo in range(0, len(rows), 1 << 12):
                some = rows[lo : lo + (1 << 12)]
                for flips in np.array_split(_flips(WIDTH * len(part), t), -(-comb(WIDTH * len(part), t) // 64)):
                    looked = own[some][:, None] ^ flips
                    known = np.all([near[b][0, looked >> (WIDTH * j) & ((1 << WIDTH) - 1)] > 0 for j, b in enumerate(part)], axis=0)
                    at, _ = np.nonzero(known)
                    yield looked[known] | (i << 40), fps[some][at], False, np.ones(len(at), bool)


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, most: int) -> DataFrame:
    """(a, b), pairs of different fingerprints of ``nodes`` (fp, distinct and staged) at ``most`` differing bits or fewer:
    as many as it takes to connect all that such pairs connect."""
    blocks = bit_blocks(nodes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BLOCKS, 1 << WIDTH), np.int64)
        for fps in _columns(batches, "fp"):
            for b, values in enumerate(block_values(fps, blocks).T):
                total[b] += np.bincount(values, minlength=1 << WIDTH)
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_pydict({"at": at, "n": total.ravel()[at]})

    found = nodes.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # 262,144 at most
    counts = np.zeros(BLOCKS << WIDTH)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    near = nodes.sparkSession.sparkContext.broadcast(np.stack([near_counts(c, most) for c in counts.reshape(BLOCKS, -1)]))  # bounded like the counts

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(PLANS))
        for fps in _columns(batches, "fp"):
            values, thresholds = block_values(fps, blocks), Thresholds(near.value, most)
            total += [thresholds.choose(values, plan)[1].sum() for plan in PLANS]
        yield pa.RecordBatch.from_pydict({"plan": np.arange(len(PLANS)), "cost": total})

    costs = {r["plan"]: r["cost"] for r in nodes.select("fp").mapInArrow(price, "plan long, cost double").groupBy("plan").agg(F.sum("cost").alias("cost")).collect()}
    plan = PLANS[min(costs, key=lambda p: (costs[p], p), default=0)]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps in _columns(batches, "fp"):
            values = block_values(fps, blocks)
            chosen, _ = Thresholds(near.value, most).choose(values, plan)
            met = sum(near.value[b][0, values[:, b]] for b in range(BLOCKS)).astype(np.int64)
            of = dict(zip(fps.tolist(), met.tolist()))
            for keys, members, own, looks in probes(fps, values, chosen, plan, near.value):
                met_by = np.array([of[f] for f in members.tolist()], np.int64) if own else np.zeros(len(keys), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(members.view(np.int64)), pa.array(met_by), pa.array(np.full(len(keys), own)), pa.array(looks)], ["key", "fp", "met", "own", "looks"])

    filed = nodes.select("fp").mapInArrow(file, "key long, fp long, met long, own boolean, looks boolean")
    members = staged(filed, "members")
    centres = members.groupBy("key").agg(F.max(F.when(F.col("own"), F.struct("met", "fp"))).alias("centre"), F.count(F.lit(1)).alias("n"), F.max("looks").alias("looked"))
    centres = centres.where("n > 1 AND looked AND centre IS NOT NULL").select("key", F.col("centre.fp").alias("centre"))
    near_centre = (F.col("fp") != F.col("centre")) & (differing(F.col("fp"), F.col("centre")) <= most)
    stars = staged(members.join(centres, "key").where(near_centre).select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct(), "stars")

    groups = components(stars).select(F.col("node").alias("fp"), "component")
    labelled = members.join(centres.select("key"), "key", "left_semi").join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labelled = staged(labelled.select("key", "fp", "own", "looks", "component"), "labelled")
    split = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    several = labelled.join(split, "key", "left_semi")
    sizes = several.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top")).select("key", F.col("top.component").alias("major"))
    several = staged(several.join(major, "key").withColumn("minor", F.col("component") != F.col("major")), "several")
    owners = several.where("own").select("key", F.col("fp").alias("a"), F.col("component").alias("of_a"), F.col("minor").alias("minor_a"))
    lookers = several.where("looks").select(F.col("key").alias("at"), F.col("fp").alias("b"), F.col("component").alias("of_b"), F.col("minor").alias("minor_b"))
    across = (F.col("key") == F.col("at")) & (F.col("of_a") != F.col("of_b")) & (differing(F.col("a"), F.col("b")) <= most)
    rest = [owners.join(lookers.where("minor_b"), across), owners.where("minor_a").join(lookers.where("NOT minor_b"), across)]
    return stars.union(staged(rest[0].union(rest[1]).select("a", "b").distinct(), "across"))


def near_duplicates(docs: DataFrame, k: int = 5, most: int = 3, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    documents: a row per row of ``docs`` with id, fp (the fingerprint as a long), component_id and kept. links: (a, b), the
    pairs of different fingerprints that were needed to connect the components.

    A fingerprint's bit is set if it is in over half of the XXH64 values of the text's shingles of k lower-cased (A-Z) words,
    repeats included; with fewer words the whole sequence is one shingle. Null, empty and blank texts have the fingerprint
    zero, which is linked like any other. Documents are linked when at most ``most`` bits differ. component_id is the
    smallest id that links lead to, its own included; null ids are passed over, so it is null only where no row of a
    component has an id. Rows that repeat an id are marked alike if their texts agree. Other columns aren't read; an empty
    table gives no rows.
    """
    if not 0 <= most <= MOST:
        raise ValueError(f"most is 0 to {MOST} bits")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = staged(_prints(source, k), "prints")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    found = links(nodes.select("fp"), most)
    linked = components(found).select(F.col("node").alias("fp"), "component")
    # only fingerprints that several rows have or that are linked need a label
    labels = nodes.join(linked, "fp", "left").where("n > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "fp"))
    labels = staged(labels.select("fp", "low", "component"), "labels")
    smallest = labels.groupBy("component").agg(F.min("low").alias("smallest"))
    named = staged(labels.join(smallest, "component").select("fp", "smallest", F.lit(True).alias("labelled")), "named")
    rows = prints.join(F.broadcast(named) if named.count() <= broadcast_rows else named, "fp", "left")
    component = F.when(F.col("labelled"), F.col("smallest")).otherwise(F.col("id"))
    documents = rows.select(F.col("id").alias(id_col), "fp", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
    return documents, found


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = near_duplicates(table(spark, sf_dir, "documents"), k=3, most=3)
    return documents.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
