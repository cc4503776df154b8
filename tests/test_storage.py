import base64
import json

import pytest
from pyspark.sql import functions as F

from millrace import PipelineConfig
from millrace.functions.sqltext import lit
from millrace.model import ATOMIC, ATOMIC_COLUMNS, RAW, RAW_COLUMNS
from millrace.operators.enrich import enrich_raw
from millrace.operators.requests import split_payloads
from millrace.operators.shred import (
    FieldTransformation,
    context_columns,
    flatten_atomic,
    json_path,
    parse_whitelist,
    struct_type_for,
)
from millrace.plans.feed import PAYLOAD
from millrace.sources import codecs, queues
from millrace.sources.registry import builtin_documents, describe, load_rules, oversized, read_schema_files, registry_table
from millrace.sources.store import read_atomic, register_atomic, write_atomic, write_bucketed, write_wide
from millrace.streaming.jobs import consume_errors, consume_events, enrich_stream, parquet_batch_writer
from plainrecords import Avro

THRIFT_GOLDEN = (
    b"\x0bzi\x00\x00\x00\x41iglu:com.snowplowanalytics.snowplow/CollectorPayload/thrift/1-0-0"
    b"\x0b\x00d\x00\x00\x00\x04sdsd\n\x00\xc8\x00\x00\x00\x00\x00\x00\x00{"
    b"\x0b\x00\xd2\x00\x00\x00\x04sdsd\x0b\x00\xdc\x00\x00\x00\x04sdsd\x00"
)


def test_thrift_bytes(spark):
    row = ("x", "sdsd", 123, "sdsd", "sdsd") + (None,) * 9
    encoded = codecs.encode_messages(spark.createDataFrame([row], RAW), "thrift")
    assert bytes(encoded.first().value) == THRIFT_GOLDEN
    back = codecs.decode_messages(encoded, "thrift").first()
    assert back.err is None and back.record.timestamp == 123 and back.record.userAgent is None


def test_avro_bytes(spark):
    row = ("x", "ip", -3, "e", "c") + (None,) * 4 + (b"\x00b", ["h: 1", "h: 2"], None, "host", None)
    encoded = codecs.encode_messages(spark.createDataFrame([row], RAW), "avro")
    expected = (
        b"\x20CollectorPayload\x04ip\x05\x02e\x02c" + b"\x00" * 4 + b"\x02\x04\x00b"
        b"\x02\x04\x08h: 1\x08h: 2\x00" + b"\x00" + b"\x02\x08host" + b"\x00"
    )
    assert bytes(encoded.first().value) == expected


@pytest.mark.parametrize("n", [0, 1, -1, 63, 64, -64, -65, 300, 1702884076562, -(2**62)])
def test_varint(spark, n):
    data = bytes(spark.sql(f"SELECT {codecs.varint(f'{n}L')} AS v").first().v)
    assert Avro(data).long() == n


@pytest.mark.parametrize("fmt", ["avro", "thrift"])
def test_undecodable(spark, fmt):
    df = spark.createDataFrame([(b"\x7f",), (b"",), (b"\x02\xff\xff\xff\xff\x0f",)], "value binary")
    assert all(r.err and r.record is None for r in codecs.decode_messages(df, fmt).collect())


@pytest.fixture(scope="module")
def events(make_raw, config, rules):
    raw = make_raw({"qs": "e=pv&url=x&eid=e1&vid=4&res=1x1&dtm=1702884076500"}, {"qs": "e=pv&url=é&eid=e2"})
    return enrich_raw(raw, config, rules)[0].cache()


@pytest.mark.parametrize("fmt", ["json", "avro"])
def test_event_codecs(events, fmt):
    encoded = codecs.encode_atomic(events, fmt)
    back = codecs.decode_atomic(encoded, fmt)
    assert back.where("err IS NOT NULL").count() == 0
    columns = [c for c in ATOMIC_COLUMNS]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, events.select(columns).collect()))


def test_event_json_shape(events):
    record = json.loads(codecs.encode_atomic(events.where("event_id = 'e1'")).first().value)
    assert list(record) == ATOMIC_COLUMNS and record["tenant_id"] is None
    assert record["dvce_created_tstamp"] == "2023-12-18T07:21:16.500000Z"
    assert record["event"]["data"] == {"page_url": "x"}
    avro = codecs.encode_atomic(events, "avro").selectExpr("sum(octet_length(value)) n").first().n
    assert avro < codecs.encode_atomic(events, "json").selectExpr("sum(octet_length(value)) n").first().n


def test_event_json_rejects(spark):
    df = spark.createDataFrame([(b"{}",), (b"nope",)], "value binary")
    assert [r.err for r in codecs.decode_atomic(df).collect()] == ["a required field is missing", "message is not JSON"]


def test_error_codec(spark):
    df = spark.createDataFrame([(b"raw bytes",), (b'{"collector_domain":"d","reason":"r","tstamp":"2024-01-01T00:00:00Z","payload":"p"}',)], "value binary")
    raw, parsed = codecs.decode_errors(df).collect()
    assert bytes(raw.raw) == b"raw bytes" and parsed.reason == "r" and bytes(parsed.payload) == b"p"


def test_queue_bodies(spark):
    df = spark.createDataFrame([(b"\x00\xff",)], "value binary")
    body = codecs.to_queue_body(df, "raw")
    assert body.first().body == base64.b64encode(b"\x00\xff").decode()
    assert bytes(codecs.from_queue_body(body, "raw").first().value) == b"\x00\xff"


def test_queue_options():
    options = queues.kafka_source_options("b:9092", "t", "raw", 10)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        queues.kafka_sink_options("b", None, "errors")
    with pytest.raises(ValueError):
        queues.check_queue("other")


def test_split(spark, make_raw):
    items = [{"e": "pv", "n": "x" * (40 * (i % 5))} for i in range(60)]
    body = json.dumps({"schema": PAYLOAD, "data": items})
    empty = json.dumps({"schema": PAYLOAD, "data": [], "pad": "x" * 2000})
    raw = make_raw(
        {"body": body, "nuid": "many"}, {"body": "{}", "nuid": "small"}, {"body": empty, "nuid": "empty"},
        {"body": json.dumps({"schema": PAYLOAD, "data": ["x" * 2000]}), "nuid": "big"},
        {"body": "x" * 2000, "nuid": "text"}, {"qs": "q" * 2000, "body": "{}", "nuid": "head"},
    )
    limit = 1000
    ok, errors = split_payloads(raw, PipelineConfig(max_record_bytes=limit))
    rows = ok.withColumn("size", F.expr(f"octet_length({codecs.raw_avro()})")).collect()
    assert {r.networkUserId for r in rows} == {"many", "small", "empty"}
    assert all(r["size"] <= limit for r in rows)
    parts = [json.loads(r.body)["data"] for r in rows if r.networkUserId == "many"]
    assert [i for p in parts for i in p] == items
    base = min(r["size"] - len(r.body) for r in rows if r.networkUserId == "many")
    for part, after in zip(parts, parts[1:]):
        fuller = json.dumps({"schema": PAYLOAD, "data": [*part, after[0]]}, separators=(",", ":"))
        assert len(fuller) + base > limit - 4
    assert [r.body for r in rows if r.networkUserId == "empty"] == [None]
    assert {r.networkUserId for r in errors.collect()} == {"big", "text", "head"}


ATOMIC_ROW = {
    "event_id": "123", "collector_host": "localhost", "platform": "test", "event_vendor": "org.example",
    "event_name": "page_view", "event_version": "1-0-0", "v_collector": "t", "v_etl": "t",
    "contexts": [
        {"schema": "iglu:org.example/context/jsonschema/1-0-0", "data": '{"test":"test_c","l":[{"a":1}]}'},
        {"schema": "iglu:org.example/context/jsonschema/1-0-1", "data": '{"test":"later"}'},
        {"schema": "iglu:org.other/myThing/jsonschema/2-0-0", "data": '{"other":null}'},
    ],
    "event": {"schema": "iglu:org.example/page_view/jsonschema/1-0-0", "data": '{"test":"test_e"}'},
}


@pytest.fixture(scope="module")
def atomic(spark):
    nullable = [f.simpleString().replace(":", " ", 1) for f in ATOMIC]
    row = tuple(ATOMIC_ROW.get(c) for c in ATOMIC_COLUMNS)
    return spark.createDataFrame([row], ", ".join(nullable))


def test_flatten(atomic):
    assert context_columns(atomic, None) == ["context_org_example_context_1", "context_org_other_my_thing_2"]
    row = flatten_atomic(
        atomic, all_schemas=True,
        event_fields=[FieldTransformation("test", "event_test")],
        context_fields=[FieldTransformation("other", "none"), FieldTransformation("l.0.a", "deep")],
    ).first()
    assert json.loads(row.event) == {"test": "test_e"} and row.event_test == "test_e"
    assert json.loads(row.context_org_example_context_1) == {"test": "later"} and row.none is None
    assert row.deep is None and row.shred_error is None


def test_flatten_selected(atomic):
    row = flatten_atomic(atomic, schema_names=["iglu:org.example/context/jsonschema/1-0-0"]).first()
    assert row.event == "{}" and json.loads(row.context_org_example_context_1)["test"] == "test_c"
    assert "context_org_other_my_thing_2" not in row.asDict()


def test_flatten_clashes(atomic):
    both = flatten_atomic(atomic, all_schemas=True, event_fields=[FieldTransformation("test", "f")],
                          context_fields=[FieldTransformation("test", "f")])
    assert both.first().shred_error
    first_of_two = flatten_atomic(atomic, all_schemas=True, context_fields=[FieldTransformation("test", "g")])
    assert first_of_two.first().shred_error
    with pytest.raises(ValueError):
        flatten_atomic(atomic, all_schemas=True, event_fields=[FieldTransformation("a", "event_id")])
    with pytest.raises(ValueError):
        flatten_atomic(atomic)


def test_whitelist_names():
    assert [tuple(a) for a in parse_whitelist(["iglu:a/b", "a/b/jsonschema/1-0"])] == [("a", "b", "*"), ("a", "b", "1-0")]
    for bad in ("a", "a/b/c/d/e"):
        with pytest.raises(ValueError):
            parse_whitelist([bad])


@pytest.mark.parametrize(
    "path,expected",
    [("t.u", "3"), ("t", '{"u":"3"}'), ("t.x", None), ("l.0", "1"), ("l.-1", "2"), ("l.9", None), ("n.0", "zero")],
)
def test_json_path(spark, path, expected):
    doc = '{"t":{"u":"3"},"l":[1,2],"n":{"0":"zero"}}'
    got = spark.sql(f"SELECT CAST({json_path(f'parse_json({lit(doc)})', path)} AS STRING) AS r").first().r
    assert got == expected


def test_storage_types(config):
    atomic_type = struct_type_for(builtin_documents(config.schema_vendor)[f"iglu:{config.schema_vendor}/atomic/jsonschema/1-0-0"])
    assert atomic_type["tstamp"].dataType.simpleString() == "timestamp"
    assert atomic_type["contexts"].dataType.simpleString() == "array<struct<schema:string,data:string>>"
    schema = {"properties": {"m": {"type": "object", "additionalProperties": {"type": "string"}},
              "a": {"type": "array", "items": {"type": "array", "items": {"type": "integer"}}}, "x": {}}}
    assert struct_type_for(schema).simpleString() == "struct<m:map<string,string>,a:array<array<bigint>>,x:string>"
    with pytest.raises(ValueError):
        struct_type_for({"properties": {"m": {"type": "odd"}}})


def test_store(spark, events, tmp_path):
    path = str(tmp_path / "atomic")
    write_atomic(events, path)
    stored = read_atomic(spark, path)
    assert stored.where("event_date = DATE'2023-12-18' AND name = 'page_view'").count() == 2
    register_atomic(stored, "stored_atomic")
    row = spark.sql("SELECT contexts[0].schema AS s, get_json_object(event.data, '$.page_url') AS u FROM stored_atomic WHERE event_id = 'e1'").first()
    assert row.s.endswith("device_info/jsonschema/1-0-0") and row.u == "x"


def test_registry_tables(spark, config, tmp_path):
    folder = tmp_path / "org.example" / "thing" / "jsonschema"
    folder.mkdir(parents=True)
    (folder / "1-0-0").write_text(json.dumps({"$schema": "x", "type": "object", "properties": {"url": {}, "referrer": {}}}))
    (folder / "1-0-1").write_text(json.dumps({"$schema": "x", "pad": "x" * 200_000}))
    files = read_schema_files(spark, str(tmp_path), priority=2)
    override = registry_table(spark, {f"iglu:{config.schema_vendor}/page_view/jsonschema/1-0-0": {"$schema": "x"}}, 5)
    rules = load_rules(spark, [files, override], config.schema_vendor)
    assert [(r.uri, r.fields, r.is_object, r.invalid) for r in describe(rules.lookup_table(spark)).collect()] == [
        ("iglu:org.example/thing/jsonschema/1-0-0", ["url", "referrer"], True, None)
    ]
    assert [(r.uri, r.priority) for r in oversized([files, override]).collect()] == [("iglu:org.example/thing/jsonschema/1-0-1", 2)]
    assert "properties" in rules.documents[f"iglu:{config.schema_vendor}/page_view/jsonschema/1-0-0"]


def test_streams(spark, make_raw, config, rules, tmp_path):
    raw = make_raw({"qs": "e=pv&url=x&eid=e1"}, {"qs": "e=pv"})
    queue = str(tmp_path / "raw")
    queues.write_queue(codecs.encode_messages(raw, "avro"), "raw", "parquet", {"path": queue})
    queues.write_queue(spark.createDataFrame([(b"\x01",)], "value binary"), "raw", "parquet", {"path": queue})

    def to_queue(path, encode):
        write = parquet_batch_writer(path)
        return lambda df, batch_id: write(encode(df), batch_id)

    stream = enrich_stream(
        queues.read_queue(spark, "raw", "parquet", {"path": queue}), config, lambda: rules,
        to_queue(str(tmp_path / "events"), codecs.encode_atomic),
        to_queue(str(tmp_path / "errors"), codecs.encode_errors), str(tmp_path / "c1"),
    )
    stream.awaitTermination()
    seen = {"events": [], "errors": []}

    def collect(name):
        return lambda df, batch_id: seen[name].extend(df.collect())

    def source(name):
        return queues.read_queue(spark, name, "parquet", {"path": str(tmp_path / name)})

    consume_events(source("events"), collect("events"), str(tmp_path / "c2")).awaitTermination()
    consume_errors(source("errors"), collect("errors"), str(tmp_path / "c3")).awaitTermination()
    assert [r.event_id for r in seen["events"]] == ["e1"]
    assert sorted(r.reason.split(":")[0] for r in seen["errors"]) == ["cannot decode message", "data validation error"]
    dev = queues.dev_sink(source("events"), "events", "dev_events")
    dev.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c4")).start().awaitTermination()
    assert spark.table("dev_events").count() == 1
    assert queues.written_bytes(codecs.encode_messages(raw, "avro")).first().bytes > 0
    assert set(RAW_COLUMNS) == set(raw.columns)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('u', id % 90) AS network_userid", "id AS event_id")
    more = spark.range(500).selectExpr("IF(id % 3 = 0, 'u1', concat('u', id % 120)) AS network_userid", "id AS n")
    one = write_bucketed(rows, "bucketed_one", str(tmp_path / "one"), buckets=4)
    two = write_bucketed(more, "bucketed_two", str(tmp_path / "two"), buckets=4)
    joined = one.join(two.hint("merge"), "network_userid").groupBy("network_userid").agg(F.count("*").alias("n"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = rows.join(more, "network_userid").groupBy("network_userid").agg(F.count("*").alias("n"))
    assert sorted(joined.collect()) == sorted(want.collect())
    for table in ("bucketed_one", "bucketed_two"):
        spark.sql(f"DROP TABLE {table}")


def test_a_path_of_a_stored_context_is_read_alone(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS event_id", "IF(id % 2 = 0, 'a', 'b') AS event_name", "TIMESTAMP'2024-05-01 10:00:00' AS tstamp", "concat('{\"x\":', id, '}') AS event",
        "IF(id % 3 = 0, NULL, concat('{\"id\":\"p', id, '\",\"deep\":{\"n\":', id, ',\"s\":\"', repeat('y', 50), '\"}}')) AS context_org_page_1", "IF(id % 5 = 0, 'no json', '{}') AS context_org_other_1",
    )
    write_wide(rows, str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    assert stored.schema["context_org_page_1"].dataType.simpleString() == "variant" and stored.where("context_org_other_1 IS NULL").count() == 600
    path = stored.selectExpr("variant_get(context_org_page_1, '$.deep.n', 'bigint') AS n")
    plan = path._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<context_org_page_1:struct<0:bigint>>" in plan
    assert path.agg(F.sum("n"), F.count("n")).first() == (sum(i for i in range(3000) if i % 3), 2000)


def test_lengths_of_one_and_two_bytes_need_no_lambda(spark):
    numbers = [0, 1, 63, 64, 65, 127, 128, 8191, 8192, -1, -64, -65, 1 << 40, (1 << 63) - 1, -(1 << 63)]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").selectExpr("n", f"{codecs.varint('n')} AS b").collect()

    def plain(n):
        zz, out = (n << 1 ^ n >> 63) & (1 << 64) - 1, []
        while zz > 127:
            out.append(zz & 127 | 128)
            zz >>= 7
        return bytes([*out, zz])

    assert [(r.n, bytes(r.b)) for r in rows] == [(n, plain(n)) for n in numbers]
    sql = codecs.varint("n")
    assert sql.index("BETWEEN 64 AND 8191") < sql.index("transform(")
