"""Country, region and city of an address by an interval sweep.

Where ranges overlap, the one that starts last counts, of those the one that ends first: of nested ranges the innermost.
Taken in the order of their starts, the range that counts is the last one begun and not yet ended, so one stack turns
ranges into disjoint stretches of the address space, and an address needs one binary search.

A small table of ranges (counted, and summed up in bytes) is resolved once and sent to every task: no shuffle. Otherwise
distinct addresses and ranges are range-partitioned together and each partition is one merge scan. A range is at most two
rows there, in the partition where it starts and in the one where it ends. Partitions that it covers whole only need to know
the preferred one of all ranges that do: a range is filed under the few aligned groups of partitions it is made of, each
group keeps one range, and a partition asks the groups above it. So no row, task or broadcast grows with the ranges of a
network, however dense, nested or wide they are, and a frequent address is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.functions import net
from millrace.operators.lookup import lookup_join
from millrace.operators.staging import staged

GEO_FIELDS = ("geo_country", "geo_region", "geo_city")
#: Bytes of a table of ranges that may be sent to every task.
SENT_BYTES = 16 << 20
#: Addresses and range starts in a partition of the sweep, about, and keys sampled for each of its borders.
POINTS, SAMPLED = 500_000, 200

# An address lies between the start and the end of its own key, so that all three can be compared as texts.
_START, _AT, _END = b"0", b"5", b"9"


def parsed_ranges(ranges: DataFrame) -> DataFrame:
    """``lo, hi, later_end`` and the geo fields of ``start_ip, end_ip, country, region, city``; ``later_end`` is smaller the
    later the range ends. Ranges with a malformed address or that end before they start are left out, repeated ones are one."""
    parsed = ranges.selectExpr(
        f"{net.ip_key('start_ip')} AS lo", f"{net.ip_key('end_ip')} AS hi", "country AS geo_country", "region AS geo_region", "city AS geo_city"
    )
    order = "translate(hi, '0123456789ABCDEF', 'FEDCBA9876543210') AS later_end"
    return parsed.where("lo <= hi AND substring(lo, 1, 2) = substring(hi, 1, 2)").selectExpr("lo", "hi", order, *GEO_FIELDS).distinct()


#: The order in which ranges begin: of those open, the last counts.
BEGIN = ["lo", "later_end", *GEO_FIELDS]


class Stretches:
    """A sweep over ranges in the order of ``BEGIN``: which one counts from each point on."""

    def __init__(self):
        self.open: list[tuple[bytes, int]] = []
        self.points: list[bytes] = []
        self.counts: list[int] = []

    def _from(self, point: bytes) -> None:
        counts = self.open[-1][1] if self.open else -1
        if self.points and self.points[-1] == point:
            self.counts[-1] = counts
        else:
            self.points.append(point)
            self.counts.append(counts)

    def end_before(self, point: bytes) -> None:
        while self.open and self.open[-1][0] < point:
            at = self.open[-1][0]
            while self.open and self.open[-1][0] <= at:
                self.open.pop()
            self._from(at)

    def begin(self, lo: bytes, hi: bytes, number: int) -> None:
        self.end_before(lo + _START)
        self.open.append((hi + _END, number))
        self._from(lo + _START)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The points in ascending order and the number of the range that counts from each on, -1 where there is none."""
        return np.array(self.points, "S40"), np.array(self.counts, np.int64)

    def forget(self) -> None:
        """Drop the points so far but for what counts now."""
        self.points, self.counts = self.points[-1:], self.counts[-1:]


def _bytes(column: pa.Array) -> np.ndarray:
    """Keys (ASCII) as fixed-width bytes; null as empty."""
    return np.array([b"" if k is None else k.encode() for k in column.to_pylist()], "S39")


def looked_up(points: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """What ``Stretches.table`` says of each key."""
    if not len(points) or not len(keys):
        return np.full(len(keys), -1)
    at = np.searchsorted(points, np.char.add(keys, _AT), "right") - 1
    return np.where(at >= 0, counts[at], -1)


def _with_sent_ranges(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every task gets the stretches and looks its addresses up."""
    table = ranges.orderBy(*[F.col(c).asc_nulls_first() for c in BEGIN]).toArrow().combine_chunks()
    stretches = Stretches()
    for number, (lo, hi) in enumerate(zip(table.column("lo").to_pylist(), table.column("hi").to_pylist())):
        stretches.begin(lo.encode(), hi.encode(), number)
    stretches.end_before(b"~")
    fields = [pa.array(table.column(f).to_pylist(), pa.string()) for f in GEO_FIELDS]
    shared = events.sparkSession.sparkContext.broadcast((*stretches.table(), fields))  # as large as what was measured

    @F.arrow_udf(f"struct<{', '.join(f'{f}: string' for f in GEO_FIELDS)}>")
    def find(keys: pa.Array) -> pa.Array:
        points, counts, fields = shared.value
        distinct = keys.dictionary_encode()
        number = looked_up(points, counts, _bytes(distinct.dictionary))
        found = np.append(number, -1)[distinct.indices.fill_null(len(number)).to_numpy()]
        at = pa.array(found, mask=found < 0)
        return pa.StructArray.from_arrays([f.take(at) for f in fields], list(GEO_FIELDS))

    # The key is asked for twice, so that it stays a column of its own: Spark does not take a function out of a projection
    # where its argument holds lambdas. The function is marked as not deterministic for the same reason, as in schemas.py.
    df = events.withColumn("_geo", F.when(F.col("_ip").isNotNull(), find.asNondeterministic()(F.col("_ip"))))
    return df.withColumns({f: F.col(f"_geo.{f}") for f in GEO_FIELDS}).drop("_geo")


def _borders(keys: DataFrame) -> np.ndarray:
    """Keys at which the partitions of a sweep begin (but for the first), with about POINTS keys between two."""
    many = keys.count()
    parts = max(many // POINTS, keys.sparkSession.sparkContext.defaultParallelism)
    sampled = keys.sample(min(1.0, SAMPLED * parts / max(many, 1)), seed=1)  # bounded by the number of partitions
    found = np.sort(_bytes(sampled.toArrow().column(0).combine_chunks()))
    return np.unique(found[np.linspace(0, len(found), parts, endpoint=False).astype(int)[1:]]) if len(found) else found


def groups_of(first: int, last: int) -> list[tuple[int, int]]:
    """The aligned groups (size as a power of two, number) that the partitions first to last are made of."""
    out, size = [], 0
    while first <= last:
        if first % 2:
            out.append((size, first))
            first += 1
        if last % 2 == 0:
            out.append((size, last))
            last -= 1
        first, last, size = first // 2, last // 2, size + 1
    return list(dict.fromkeys(out))


def swept(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """``key`` and the geo fields of every key of ``addresses`` (``key``, distinct) that lies in a range of ``ranges``
    (as ``parsed_ranges`` gives them)."""
    ranges, addresses = staged(ranges, "ranges"), staged(addresses, "addresses")
    borders = _borders(ranges.select(F.col("lo").alias("key")).union(addresses))
    fields = [*BEGIN, "hi"]
    texts = ", ".join(f"{c} string" for c in fields)

    def parts_of(keys: pa.Array) -> np.ndarray:
        return np.searchsorted(borders, _bytes(keys), "right")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range's row in the partition where it starts, and in the one where it ends."""
        for batch in batches:
            first, last = parts_of(batch.column("lo")), parts_of(batch.column("hi"))
            later = np.flatnonzero(last > first)
            part = np.concatenate([first, last[later]])
            rows = batch.take(pa.array(np.concatenate([np.arange(len(first)), later])))
            yield pa.RecordBatch.from_arrays([pa.array(part), *[rows.column(c) for c in fields]], ["part", *fields])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range under the groups of partitions that it covers whole."""
        for batch in batches:
            first, last = parts_of(batch.column("lo")), parts_of(batch.column("hi"))
            found = [(i, *g) for i in np.flatnonzero(last > first + 1) for g in groups_of(int(first[i]) + 1, int(last[i]) - 1)]
            rows = batch.take(pa.array([f[0] for f in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()), *[rows.column(c) for c in fields]], ["size", "number", *fields]
            )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(parts_of(batch.column(0))), batch.column(0)], ["part", "key"])

    covering = ranges.mapInArrow(cover, f"size long, number long, {texts}").groupBy("size", "number").agg(F.max(F.struct(*fields)).alias("r"))
    above = {(r["size"], r["number"]): tuple(r["r"]) for r in covering.toLocalIterator()}  # two for each partition at most
    shared = ranges.sparkSession.sparkContext.broadcast(above)

    begins = ranges.mapInArrow(place, f"part long, {texts}").withColumn("key", F.col("lo"))
    points = begins.unionByName(addresses.mapInArrow(locate, "part long, key string"), allowMissingColumns=True)
    order = ["part", "key", F.col("lo").asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in BEGIN[1:]]]  # starts before addresses

    def rank(r: tuple) -> list:
        return [(v is not None, v or "") for v in r]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stretches, held, covering = None, Stretches(), [], []
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for start in np.flatnonzero(np.diff(parts, prepend=-1)):
                rows = batch.slice(start, int(np.searchsorted(parts[start:], parts[start], "right")))
                if parts[start] != part:
                    part, stretches, held = parts[start], Stretches(), []
                    covering = sorted({shared.value[g] for size in range(64) if (g := (size, int(part) >> size)) in shared.value}, key=rank)
                begins = rows.column("lo").is_valid()
                begun = rows.filter(begins)
                new = list(zip(*[begun.column(c).to_pylist() for c in fields]))
                keys = rows.filter(pc.invert(begins)).column("key")
                # what covers the whole partition began before its addresses, but maybe after ranges that only end here
                due = [r for r in covering if len(keys) or new and rank(r) < rank(new[-1])]
                covering = covering[len(due) :]
                for r in sorted([*due, *new], key=rank) if due else new:
                    stretches.begin(r[0].encode(), r[-1].encode(), len(held))
                    held.append(r[2:-1])
                if len(keys):
                    stretches.end_before(keys[-1].as_py().encode() + _AT)
                number = looked_up(*stretches.table(), _bytes(keys))
                hit = np.flatnonzero(number >= 0)
                values = list(zip(*[held[i] for i in number[hit]])) or [[], [], []]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(hit)), *[pa.array(v, pa.string()) for v in values]], ["key", *GEO_FIELDS])
                stretches.forget()
                live = {n: i for i, n in enumerate(sorted({n for _, n in stretches.open}))}  # hold on to open ranges only
                held = [held[n] for n in live]
                stretches.open = [(hi, live[n]) for hi, n in stretches.open]
                stretches.counts = [live.get(n, -1) for n in stretches.counts]

    tasks = max(len(borders) + 1, 1)
    return points.repartition(tasks, "part").sortWithinPartitions(*order).mapInArrow(scan, f"key string, {', '.join(f'{f} string' for f in GEO_FIELDS)}")


def with_geo(events: DataFrame, ranges: DataFrame, config: PipelineConfig, address: str = "address", sent_bytes: int = SENT_BYTES) -> DataFrame:
    """Add ``geo_country``, ``geo_region`` and ``geo_city``; NULL where no range holds the address.

    ``ranges`` has ``start_ip, end_ip, country, region, city``. Up to ``config.broadcast_limit_rows`` ranges of ``sent_bytes``
    together are sent to every task. More are swept with the distinct addresses, and what is found is joined to the events
    again: that reads ``events`` twice, so write them before where making them is dear.
    """
    df = events.withColumn("_ip", F.expr(net.ip_key(address)))
    parsed = parsed_ranges(ranges)
    size = " + ".join(f"coalesce(octet_length({c}), 0)" for c in ("lo", "hi", *GEO_FIELDS))
    seen = parsed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"sum({size})").alias("bytes")).first()
    if seen["n"] <= config.broadcast_limit_rows and (seen["bytes"] or 0) <= sent_bytes:
        return _with_sent_ranges(df, parsed).drop("_ip")
    keys = df.select(F.col("_ip").alias("key")).where("key IS NOT NULL").distinct()
    found = swept(keys, parsed).withColumnRenamed("key", "_ip")
    return lookup_join(df, staged(found, "found"), ["_ip"], config).drop("_ip")


def without_geo(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.lit(None).cast("string") for c in GEO_FIELDS})
