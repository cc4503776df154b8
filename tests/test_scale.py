"""How the registered queries deal their work out."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.operators.enrich import process_raw, to_atomic
from millrace.operators.shred import flatten_atomic
from millrace.plans import feed, paths, queries
from millrace.plans.queries import QUERIES
from millrace.sources import codecs
from millrace.streaming.jobs import consume_events


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Own rows: 200 events of all types on three days."""
    folder = str(tmp_path_factory.mktemp("tables"))
    kind = "element_at(array('view', 'click', 'purchase', 'signup', 'error'), CAST(1 + id % 5 AS INT))"
    at = "CAST(timestamp_seconds(1704067200 + id * 1200) AS TIMESTAMP_NTZ)"
    events = spark.range(200).selectExpr("id AS event_id", f"{at} AS ts", "id % 7 AS user_id", f"{kind} AS event_type", "id / 4 AS value", "'{}' AS props")
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_row_group_go_to_all_cores(spark, tmp_path, monkeypatch):
    # 40 MB in one row group: as many splits as cores by bytes, all rows in one of them
    rows = 400_000
    noise = pa.array([f"{(i * 2654435761) % 2**64:020d}{(i * 40503) % 2**61:080d}" for i in range(rows)])
    pq.write_table(pa.table({"id": pa.array(range(rows), pa.int64()), "noise": noise}), tmp_path / "t.parquet", compression="none", use_dictionary=False, row_group_size=rows)
    monkeypatch.setattr(feed, "TASK_ROWS", 20_000, raising=False)
    table = spark.read.parquet(str(tmp_path / "t.parquet"))
    assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    dealt = feed.spread(table)
    found = rows_by_task(dealt)
    assert len(found) == 20 and max(found) < 25_000
    assert dealt.agg(F.count_distinct("id"), F.sum("id")).first()[:] == (rows, rows * (rows - 1) // 2)


def test_well_cut_tables_and_empty_ones(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    cut = spark.range(0, 1000, 1, 2 * cores)
    assert feed.spread(cut).rdd.getNumPartitions() == 2 * cores
    assert feed.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    assert feed.spread(spark.range(0)).count() == 0


def batches_of(stream, tmp_path):
    rows = []
    stream.writeStream.foreachBatch(lambda df, n: rows.append(df.count())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    return rows


def test_a_queue_of_many_files_is_several_micro_batches(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    messages = spark.range(0, 500, 1, 5 * cores).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS value")
    rows = batches_of(paths._queue_stream(spark, messages)[0], tmp_path)
    assert len(rows) == 2 and sum(rows) == 500


def test_a_micro_batch_of_messages_has_files_for_all_cores(spark, sf, tmp_path):
    stream, out = paths._message_stream(spark, sf)
    files = spark.read.parquet(f"{out}/messages").inputFiles()
    assert len(files) == 4 * spark.sparkContext.defaultParallelism
    rows = batches_of(stream, tmp_path)
    assert len(rows) == 4 and sum(rows) == 200


def test_a_consumer_decodes_a_message_once(spark, make_raw, config, rules, tmp_path):
    atomic = to_atomic(process_raw(make_raw({"qs": "e=pv&p=web&url=u&eid=a"}), config, rules), config)
    noise = spark.sql("SELECT CAST('no event' AS BINARY) AS value")
    codecs.encode_atomic(atomic).unionByName(noise).write.parquet(str(tmp_path / "queue"))
    seen = {}

    def writer(name):
        def write(df, batch_id):
            plan = df._jdf.queryExecution().executedPlan().toString()
            seen[name] = df.count(), "InMemoryTableScan" in plan

        return write

    stream = spark.readStream.schema("value binary").parquet(str(tmp_path / "queue"))
    consume_events(stream, writer("events"), str(tmp_path / "c"), write_errors=writer("errors")).awaitTermination()
    assert seen == {"events": (1, True), "errors": (1, True)}


@pytest.mark.parametrize("name", ["busy_new_users", "view_and_click_sets", "campaign_funnel", "users_over_days", "views_and_items_per_user", "buyers_without_clicks", "enrichment_verdict"])
def test_queries_that_read_the_events_more_than_once_work_them_out_once(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan


@pytest.mark.parametrize("module, name", [(queries, "shred_all_schemas"), (paths, "stored_context_paths")])
def test_context_columns_are_looked_up_in_events_worked_out_once(spark, sf, monkeypatch, module, name):
    read = []

    def flatten(events, **options):
        read.extend(events.inputFiles())
        return flatten_atomic(events, **options)

    monkeypatch.setattr(module, "flatten_atomic", flatten)
    QUERIES[name](spark, sf).count()
    assert read and not any("events.parquet" in f for f in read)
