"""Event-time state of streams, counts per micro-batch, sketches and ranks."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace import PipelineConfig
from millrace.operators.carry import with_rank
from millrace.operators.sketches import daily_sketches, distinct_over
from millrace.sources import codecs
from millrace.sources.dump import DumpReader, QueueDump
from millrace.sources.queues import batch_limit, read_queue
from millrace.streaming.jobs import enrich_stream, session_counts, without_repeats

START = datetime(2024, 1, 1)
SCHEMA = "id long, usr string, ts timestamp"


def stream_of(spark, tmp_path, batches):
    """A stream that gets one batch of (id, user, minutes) at a time, and a function that runs it to its end."""
    folder = str(tmp_path / "in")
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame([(i, u, START + timedelta(minutes=m)) for i, u, m in rows], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    def run(result, name):
        query = result.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(availableNow=True).start(str(tmp_path / name))
        query.awaitTermination()
        return spark.read.schema(result.schema).parquet(str(tmp_path / name)).collect(), query

    return stream, run


def test_repeats_and_late_events(spark, tmp_path):
    batches = [[(1, "a", 0), (2, "a", 5), (1, "a", 0)], [(3, "a", 100), (2, "a", 5)], [(4, "b", 101), (3, "a", 100)], [(5, "b", 30), (6, "b", 95), (1, "a", 0)]]
    stream, run = stream_of(spark, tmp_path, batches)
    rows, query = run(without_repeats(stream, "id", "ts", "10 minutes"), "once")
    assert sorted(r["id"] for r in rows) == [1, 2, 3, 4, 6]  # 5 and the last 1 come too late, 6 does not
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert state[-1] <= 3  # what lies behind the watermark is forgotten


def test_sessions_are_given_out_once_closed(spark, tmp_path):
    batches = [[(1, "a", 0), (2, "a", 8), (3, "b", 3)], [(4, "a", 15), (5, "a", 60)], [(6, "b", 200)], [(7, "c", 400)]]
    stream, run = stream_of(spark, tmp_path, batches)
    rows, _ = run(session_counts(stream, "usr", "ts", "10 minutes", "5 minutes"), "sessions")
    got = sorted((r["usr"], int((r["start"] - START).total_seconds() // 60), int((r["end"] - START).total_seconds() // 60), r["n"]) for r in rows)
    assert got == [("a", 0, 25, 3), ("a", 60, 70, 1), ("b", 3, 13, 1), ("b", 200, 210, 1)]  # c's is still open


def test_counts_of_each_micro_batch(spark, make_raw, rules, tmp_path):
    good, bad = make_raw({"qs": "e=pv&url=x"}, {"qs": "e=pv&url=y"}), make_raw({"qs": "e=pv"})
    queue = str(tmp_path / "queue")
    for rows in (good.union(bad), bad):
        messages = codecs.encode_messages(rows, "avro").select("value")
        messages.union(spark.createDataFrame([(b"\x7f",)], "value binary")).coalesce(1).write.mode("append").parquet(queue)
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(queue)
    seen = []
    query = enrich_stream(
        stream, PipelineConfig(), lambda: rules, lambda df, n: df.count(), lambda df, n: df.count(), str(tmp_path / "c"), on_metrics=lambda found, batch: seen.append((batch, found))
    )
    query.awaitTermination()
    assert seen == [(0, {"success": 2, "error": 1, "undecodable": 1}), (1, {"success": 0, "error": 1, "undecodable": 1})]


def test_spans_from_sketches(spark):
    rows = spark.range(60_000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 6 AS INT)) AS day", "IF(id % 2 = 0, 'x', 'y') AS kind", "IF(id % 50 = 0, NULL, concat('u', id % 9000)) AS usr")
    sketches = daily_sketches(rows, "day", ["kind"], "usr")
    assert sketches.count() == 6
    for last in (1, 3, 6):
        days = F.col("day") < F.date_add(F.lit("2024-01-01").cast("date"), last)
        exact = {r["kind"]: (r["n"], r["u"]) for r in rows.where(days).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("usr").alias("u")).collect()}
        got = {r["kind"]: (r["n"], r["about"]) for r in distinct_over(sketches.where(days), ["kind"]).collect()}
        assert got.keys() == exact.keys()
        assert all(got[k][0] == exact[k][0] and abs(got[k][1] - exact[k][1]) <= 0.04 * exact[k][1] for k in exact)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_rank_of_all_rows(spark, limit):
    rng = random.Random(3)
    values = [rng.choice([None, 7, 7, 7, rng.randrange(500)]) for _ in range(2000)]
    table = spark.createDataFrame(list(enumerate(values)), "id long, v long").repartition(4)
    got = {r["id"]: r["rank"] for r in with_rank(table, "v", PipelineConfig(broadcast_limit_rows=limit)).collect()}
    key = lambda v: (v is not None, v or 0)
    order = sorted(values, key=key, reverse=True)
    first = {}
    for place, v in enumerate(order, 1):
        first.setdefault(v, place)
    assert got == {i: first[v] for i, v in enumerate(values)}
    assert with_rank(table.limit(0), "v", PipelineConfig()).collect() == []


def test_queue_names_are_checked(spark):
    df = spark.createDataFrame([(b"x", "x")], "value binary, body string")
    for fn in (codecs.to_queue_body, codecs.from_queue_body):
        with pytest.raises(ValueError, match="Unknown queue type"):
            fn(df, "others")


def test_dump_is_read_ten_messages_at_a_time_and_goes_on_after_a_restart(spark, tmp_path):
    queue = str(tmp_path / "queue")
    spark.range(57).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS value").repartition(4).write.parquet(queue)
    seen = {}

    def each(df, batch):
        assert batch not in seen or seen[batch] == sorted(int(bytes(r["value"])) for r in df.collect())
        seen[batch] = sorted(int(bytes(r["value"])) for r in df.collect())

    def run(until):
        stream = read_queue(spark, "raw", "queue_dump", {"path": queue, **batch_limit("queue_dump", 10)})
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        while until and query.isActive and len(seen) < until:
            time.sleep(0.05)
        if not until:
            query.processAllAvailable()
        query.stop()

    run(2)
    run(4)
    run(None)
    assert sorted(sum(seen.values(), [])) == list(range(57)) and max(map(len, seen.values())) == 10 and len(seen) == 6
    spark.createDataFrame([(b"57",), (b"58",)], "value binary").coalesce(1).write.parquet(str(tmp_path / "more"))
    (part,) = (tmp_path / "more").glob("*.parquet")
    part.rename(tmp_path / "queue" / "z.parquet")  # a later file
    run(None)
    assert sorted(sum(seen.values(), [])) == list(range(59))


def test_stretches_of_a_dump(spark, tmp_path):
    for name, n in (("a", 5), ("b", 0), ("c", 7)):
        pq.write_table(pa.table({"value": pa.array([f"{name}{i}".encode() for i in range(n)], pa.binary())}), tmp_path / f"{name}.parquet", row_group_size=2)
    reader = DumpReader(str(tmp_path), 4)
    offsets = [reader.initialOffset()]
    while (end := reader.latestOffset()) != offsets[-1]:
        offsets.append(end)
    assert offsets[1:] == [{"file": "a.parquet", "row": 4}, {"file": "c.parquet", "row": 3}, {"file": "c.parquet", "row": 7}]
    got = [[v.as_py() for s in reader.partitions(a, b) for batch in reader.read(s) for v in batch.column(0)] for a, b in zip(offsets, offsets[1:])]
    assert got == [[b"a0", b"a1", b"a2", b"a3"], [b"a4", b"c0", b"c1", b"c2"], [b"c3", b"c4", b"c5", b"c6"]]
    assert DumpReader(str(tmp_path / "nowhere"), 4).latestOffset() == {"file": "", "row": 0}
    with pytest.raises(ValueError):
        QueueDump({"path": "x", "limit": "0"}).streamReader(None)
