"""Registered queries over paths that the plain feed does not take: unusual requests, codecs, stores, streams, joins.

``odd_requests`` turns each row of ``events`` into one of sixteen requests by ``event_id % 16``. The SQL of a query states
from the base table what has to come of them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.functions import iglu, net
from millrace.functions.sqltext import lit
from millrace.model import ATOMIC_COLUMNS, RAW_COLUMNS
from millrace.operators.auth import with_auth_subject
from millrace.operators.carry import SLICE_ROWS, ordered, with_last, with_rank, with_sessions
from millrace.operators.enrich import Dimensions, Enrichment, process_raw, to_atomic
from millrace.operators.errors import reason, to_errors, undecodable_to_errors
from millrace.operators.geo import with_geo
from millrace.operators.shred import flatten_atomic
from millrace.operators.sketches import REGISTERS, daily_sketches, distinct_over
from millrace.operators.staging import scratch_dir, staged
from millrace.plans import feed
from millrace.plans.queries import _EXPECTED_EVENTS, _NUMBER, CONFIG, DEVICE, _atomic, _context, _raw, feed_rules, query
from millrace.sources import codecs
from millrace.sources.queues import batch_limit, read_queue
from millrace.sources.registry import Rules, builtin_documents, load_rules, registry_table, resolve
from millrace.sources.store import read_atomic, write_atomic, write_bucketed, write_wide
from millrace.streaming.jobs import consume_errors, consume_events, enrich_stream, parquet_batch_writer, without_repeats

_META = "https://json-schema.org/draft/2020-12/schema"
SOCIAL = "iglu:org.example/social/jsonschema/1-0-0"
AMOUNT = "iglu:org.example/amount/jsonschema/1-0-0"
BROKEN = "iglu:org.example/broken/jsonschema/1-0-0"
TEXT_SESSION = "iglu:org.example/client_session/jsonschema/1-0-0"
ODD_DOCUMENTS = {
    SOCIAL: {
        "$schema": _META,
        "type": "object",
        "properties": {"network": {"type": "string"}, "action": {"type": "string"}},
        "required": ["network", "action"],
        "additionalProperties": False,
    },
    AMOUNT: {"$schema": _META, "type": ["number", "object"]},
    BROKEN: {"$schema": _META, "type": "nonsense"},
    TEXT_SESSION: {
        "$schema": _META,
        "type": "object",
        "properties": {"sessionId": {"type": "string"}, "sessionIndex": {"type": "string"}},
        "required": ["sessionId", "sessionIndex"],
        "additionalProperties": False,
    },
}


def odd_rules() -> Rules:
    return Rules.compile(builtin_documents(CONFIG.schema_vendor) | feed.FEED_DOCUMENTS | ODD_DOCUMENTS)


def _item(fields: dict[str, str]) -> str:
    pairs = ", ".join(f"'{k}', CAST({v} AS STRING)" for k, v in {"tv": "'t'", "p": "'web'", "eid": "concat('ev-', event_id)", **fields}.items())
    return f"to_json(named_struct('schema', {lit(feed.PAYLOAD)}, 'data', array(map({pairs}))))"


_SOCIAL_DATA = "named_struct('network', concat('net', user_id), 'action', 'like')"
_CONTEXT = (
    f"concat('{{\"schema\":\"{feed.CONTEXTS}\",\"data\":[{{\"schema\":\"{TEXT_SESSION}\",\"data\":{{\"sessionId\":\"s', user_id,"
    "'\",\"sessionIndex\":\"', IF(event_id % 32 < 16, concat(' ', user_id), 'many'), '\"}}]}')"
)
_STRUCTURED = {"e": "'se'", "se_ca": "'c'", "se_ac": "'a'"}
# Request bodies and query strings by event_id % 16.
_BODIES = {
    1: _item(_STRUCTURED | {"aid": "concat('b', user_id)"}),
    2: f"to_json({_SOCIAL_DATA})",
    3: f"to_json(named_struct('schema', {lit(SOCIAL)}, 'data', {_SOCIAL_DATA}))",
    5: _item(_STRUCTURED),
    6: _item({"e": "'ue'", "ue_pr": "'ignored'"}),
    7: _item({"e": "'pp'", "pp_mix": "event_id % 100", "pp_max": "concat(' ', user_id)", "pp_miy": "0", "pp_may": "concat('-', event_id % 7)"}),
    8: _item(_STRUCTURED | {"co": _CONTEXT}),
    9: f"to_json(named_struct('schema', {lit(AMOUNT)}, 'data', event_id))",
    10: "concat('e=pv&url=', user_id)",
    12: "concat('{\"schema\":', user_id, ',\"data\":{}}')",
    13: f"to_json(named_struct('schema', {lit(BROKEN)}, 'data', {_SOCIAL_DATA}))",
    14: f"to_json(named_struct('data', {_SOCIAL_DATA}))",
}
_QUERIES = {
    0: f"concat('schema=', url_encode({lit(SOCIAL)}), '&aid=app&network=net', user_id, '&action=like')",
    1: "'aid=q&lang=fr&p=mob'",
    2: f"concat('schema=', url_encode({lit(SOCIAL)}), '&eid=ev-', event_id)",
    3: "concat('eid=ev-', event_id)",
    4: "concat('e=pv&p=web&eid=ev-', event_id, '&url=u&vid=%09', event_id % 5, '%0A')",
    5: "'e=pv&url=outer'",
    6: f"concat('schema=', url_encode({lit(SOCIAL)}), '&network=net', user_id, '&action=like')",
    11: "concat('e=pv&p=web&url=u&eid=ev-', event_id)",
}


def _case(values: dict[int, str], kind: str) -> str:
    return "CASE event_id % 16 " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE CAST(NULL AS {kind}) END"


def odd_requests(spark: SparkSession, sf: str) -> DataFrame:
    body = f"IF(event_id % 16 = 15, unhex('FF00FE'), CAST({_case(_BODIES, 'STRING')} AS BINARY))"
    return feed.table(spark, sf, "events").selectExpr(
        "'CollectorPayload' AS schema",
        "concat('10.0.0.', event_id % 256) AS ipAddress",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp",
        "'UTF-8' AS encoding",
        "'odd' AS collector",
        "CAST(NULL AS STRING) AS userAgent",
        "CAST(NULL AS STRING) AS refererUri",
        "'/x/v1' AS path",
        f"{_case(_QUERIES, 'STRING')} AS querystring",
        f"{body} AS body",
        "array('Host: h') AS headers",
        "IF(event_id % 16 = 10, 'application/x-www-form-urlencoded', 'application/json') AS contentType",
        "IF(event_id % 16 = 11, NULL, 'h') AS hostname",
        "concat('n', event_id) AS networkUserId",
    )


_EVENT_OF = "CAST(substring(network_userid, 2) AS BIGINT)"


@query("""
SELECT event_id, CASE event_id % 16 WHEN 0 THEN 'social' WHEN 2 THEN 'social' WHEN 3 THEN 'social' WHEN 6 THEN 'social'
    WHEN 4 THEN 'page_view' WHEN 7 THEN 'page_ping' ELSE 'structured_event' END AS event_name,
  CASE event_id % 16 WHEN 0 THEN 'app' WHEN 1 THEN 'b' || user_id END AS app_id, 'web' AS platform,
  CASE WHEN event_id % 16 = 1 THEN 'fr' END AS language,
  CASE WHEN event_id % 16 IN (0) THEN 36 ELSE 3 + length(event_id::VARCHAR) END::BIGINT AS id_length,
  CASE event_id % 16 WHEN 4 THEN '{"page_url":"u"}' WHEN 7 THEN '{"pp_xoffset_max":' || user_id || ',"pp_xoffset_min":' || event_id % 100
      || ',"pp_yoffset_max":' || -(event_id % 7) || ',"pp_yoffset_min":0}'
    WHEN 1 THEN '{"action":"a","category":"c"}' WHEN 5 THEN '{"action":"a","category":"c"}' WHEN 8 THEN '{"action":"a","category":"c"}'
    ELSE '{"action":"like","network":"net' || user_id || '"}' END AS data,
  CASE WHEN event_id % 16 = 8 THEN 's' || user_id END AS session_id, CASE WHEN event_id % 16 = 8 THEN user_id END AS session_idx,
  CASE WHEN event_id % 16 = 4 THEN event_id % 5 END AS visit, true AS timed
FROM events WHERE event_id % 16 <= 7 OR (event_id % 16 = 8 AND event_id % 32 < 16)
""")
def odd_request_events(spark, sf):
    """Iglu-style GET, body with query string, whole and single bodies, type overrides, page pings, text sessions."""
    config = PipelineConfig(device_enabled=False)
    rows = to_atomic(process_raw(odd_requests(spark, sf), config, odd_rules()), config)
    return rows.selectExpr(
        f"{_EVENT_OF} AS event_id", "event_name", "app_id", "platform", "language", "CAST(length(event_id) AS BIGINT) AS id_length",
        "event.data AS data", "session_id", "session_idx", "domain_sessionidx AS visit", "etl_tstamp >= collector_tstamp AS timed",
    )


_ODD_ERRORS = f"""
SELECT event_id, CASE WHEN event_id % 16 = 11 THEN 'unknown' ELSE 'h' END AS collector_domain,
  CASE event_id % 16 WHEN 8 THEN 'invalid event data: Invalid atomic event: 1 errors in [''session_idx'']'
    WHEN 9 THEN 'invalid event data: data is not an object' WHEN 10 THEN 'unprocessable payload: form data is not supported'
    WHEN 11 THEN 'invalid event data: Invalid atomic event: 1 errors in [''collector_host'']'
    WHEN 12 THEN 'unprocessable payload: schema is not a text' WHEN 13 THEN 'invalid schema: Invalid Schema: ''nonsense'' is not a type'
    WHEN 14 THEN 'invalid event data: Missing schema in body' ELSE 'invalid event data: body is not valid JSON' END AS reason,
  CASE event_id % 16 WHEN 10 THEN hex('e=pv&url=' || user_id) WHEN 12 THEN hex('{{"schema":' || user_id || ',"data":{{}}}}') WHEN 15 THEN 'FF00FE' END AS body
FROM events WHERE event_id % 16 > 8 OR (event_id % 16 = 8 AND event_id % 32 >= 16)
"""


@query(_ODD_ERRORS)
def odd_request_errors(spark, sf):
    """Errors of odd requests through the error queue: reasons, and bodies that come back byte by byte."""
    errors = to_errors(process_raw(odd_requests(spark, sf), PipelineConfig(device_enabled=False), odd_rules()))
    back = codecs.decode_errors(codecs.encode_errors(errors)).withColumn("p", F.col("payload").cast("string"))
    body = "get_json_object(p, '$.body')"
    raw = f"IF(get_json_object(p, '$.body_encoding') = 'base64', unbase64({body}), CAST({body} AS BINARY))"
    event_id = "CAST(substring(get_json_object(p, '$.networkUserId'), 2) AS BIGINT)"
    return back.selectExpr(
        f"{event_id} AS event_id", "collector_domain", "reason", f"CASE WHEN {event_id} % 16 IN (10, 12, 15) THEN hex({raw}) END AS body"
    )


@query("SELECT event_id, 'unknown' AS collector_domain, true AS told, 'FF00' || hex(event_id::VARCHAR) AS payload FROM events")
def undecodable_round_trip(spark, sf):
    """Messages that are no records: the dead letter gives their bytes back."""
    messages = feed.table(spark, sf, "events").selectExpr("concat(unhex('FF00'), CAST(CAST(event_id AS STRING) AS BINARY)) AS value")
    errors = undecodable_to_errors(codecs.decode_messages(messages, "avro"))
    back = codecs.decode_errors(codecs.encode_errors(errors))
    return back.selectExpr(
        "CAST(CAST(substring(payload, 3) AS STRING) AS BIGINT) AS event_id", "collector_domain",
        "startswith(reason, 'cannot decode message: ') AS told", "hex(payload) AS payload",
    )


@query("SELECT doc_id, hex(encode(text)) AS raw, text AS other FROM documents")
def queue_bodies(spark, sf):
    """Text-only queues: raw messages as base64, others as they are, there and back."""
    docs = feed.table(spark, sf, "documents").selectExpr("doc_id", "CAST(text AS BINARY) AS value")
    both = docs
    for queue in ("raw", "errors"):
        body = codecs.to_queue_body(docs, queue)
        back = codecs.from_queue_body(body, queue).withColumn("n", F.md5("value"))
        both = both.withColumn("n", F.md5("value")).join(back.select(F.col("value").alias(queue), "n").dropDuplicates(["n"]), "n").drop("n")
    return both.selectExpr("doc_id", "hex(raw) AS raw", "CAST(errors AS STRING) AS other")


@query("""
SELECT event_id, 'agent ' || user_id AS agent, 'last' || event_id AS twice, event_type AS odd, 4::BIGINT AS n FROM events
""")
def header_maps(spark, sf):
    headers = (
        "array(concat('User-Agent:agent ', user_id), concat('X-Twice: first', event_id), 'no colon here',"
        " concat('X-Twice: last', event_id), concat('a.b: ', event_type, ' '), 'Colons: a:b')"
    )
    m = feed.table(spark, sf, "events").withColumn("m", F.expr(net.headers_map(headers)))
    return m.selectExpr("event_id", "m['User-Agent'] AS agent", "m['X-Twice'] AS twice", "m['a.b'] AS odd", "CAST(size(m) AS BIGINT) AS n")


@query("""
SELECT event_id % 8 AS kind, count(*) AS n, count(*) FILTER (event_id % 8 = 0) AS events, count(*) FILTER (event_id % 8 > 0) AS dead FROM events GROUP BY 1
""")
def hostile_messages(spark, sf):
    """Thrift messages that break the format in several ways are dead letters and leave the others alone."""
    raw = feed.raw_from_events(feed.spread(feed.table(spark, sf, "events")))
    # added before the mark of the record's end
    added = (
        "CASE kind WHEN 2 THEN unhex('0B015E000000026162') WHEN 3 THEN unhex('0F01900B00000000') WHEN 4 THEN unhex('0F015E08000000020000000100000002')"
        " WHEN 5 THEN unhex(concat('0F00090F00000001', repeat('0F00000001', 3000))) WHEN 6 THEN unhex('0800C800000002') WHEN 7 THEN unhex('0B019000000001FF') ELSE unhex('') END"
    )
    body = "substring(value, 1, IF(kind = 1, octet_length(value) div 2, octet_length(value) - 1))"
    kinds = raw.selectExpr(f"{codecs.raw_thrift()} AS value", "CAST(split(ipAddress, '[.]')[2] AS BIGINT) % 8 AS kind")
    messages = kinds.selectExpr("kind", f"concat({body}, {added}, IF(kind = 1, unhex(''), unhex('00'))) AS value")
    # the kind is the event's number modulo 256, modulo 8, which the message's address carries
    read = codecs.decode_messages(messages, "thrift")
    dead = undecodable_to_errors(read.where("err IS NOT NULL")).select(F.col("payload").alias("value"))
    counts = messages.groupBy("kind", F.md5("value").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    seen = read.where("err IS NULL").select(F.md5("value").alias("name"), F.lit(1).alias("events"), F.lit(0).alias("dead")).unionByName(
        dead.select(F.md5("value").alias("name"), F.lit(0).alias("events"), F.lit(1).alias("dead"))
    )
    by_name = seen.groupBy("name").agg(F.sum("events").alias("events"), F.sum("dead").alias("dead"))
    return counts.join(by_name, "name").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("events").alias("events"), F.sum("dead").alias("dead"))


# --- Registry and validation ------------------------------------------------------------------------


def _supplier_registry(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two tables with a schema per supplier; the first table has every third supplier, some documents too large."""
    suppliers = feed.table(spark, sf, "supplier")
    def document(description: str) -> str:
        field = "named_struct('type', 'string')"
        return f"to_json(named_struct('$schema', '{_META}', 'description', {description}, 'properties', map(concat('s', s_suppkey), {field})))"

    uri = "concat('iglu:org.supplier/s', s_suppkey, '/jsonschema/1-0-0')"
    large = "IF(s_suppkey % 2 = 0, repeat('x', 140000), 'first')"
    first = suppliers.where("s_suppkey % 3 = 0").selectExpr(f"{uri} AS uri", f"{document(large)} AS document", "1 AS priority")
    second = suppliers.selectExpr(f"IF(s_suppkey % 5 = 0, concat('bad:', s_suppkey), {uri}) AS uri", f"{document(lit('second'))} AS document", "2 AS priority")
    return [registry_table(spark, builtin_documents(CONFIG.schema_vendor)), first, second]


@query("""
SELECT s_suppkey AS supplier, CASE WHEN s_suppkey % 6 = 3 THEN 'first' ELSE 'second' END AS source
FROM supplier WHERE s_suppkey % 5 <> 0 OR s_suppkey % 6 = 3
""")
def registry_lookup(spark, sf):
    """One document per URI: the lower priority wins, oversized documents and malformed URIs are left out."""
    found = resolve(_supplier_registry(spark, sf)).where("vendor = 'org.supplier'")
    return found.selectExpr("CAST(substring(name, 2) AS BIGINT) AS supplier", "get_json_object(document, '$.description') AS source")


def _single_bodies(spark: SparkSession, sf: str, uri: str, data: str, more: DataFrame | None = None, on: str = "true") -> DataFrame:
    """Each event as a POST of one self-describing event; ``uri`` and ``data`` are SQL text."""
    events = feed.table(spark, sf, "events")
    events = events.join(more, F.expr(on), "left") if more is not None else events
    fields = {c: "CAST(NULL AS STRING)" for c in ("userAgent", "refererUri", "querystring", "contentType")}
    fields |= {"schema": "'CollectorPayload'", "ipAddress": "'10.0.0.1'", "timestamp": "unix_millis(CAST(ts AS TIMESTAMP))", "encoding": "'UTF-8'", "collector": "'c'", "path": "'/x/v1'"}
    fields |= {"body": f"CAST(concat('{{\"schema\":\"', {uri}, '\",\"data\":', {data}, '}}') AS BINARY)", "headers": "CAST(array() AS ARRAY<STRING>)", "hostname": "'h'", "networkUserId": "concat('n', event_id)"}
    return events.selectExpr(*[f"{fields[c]} AS {c}" for c in RAW_COLUMNS])


def _part_registry(spark: SparkSession, sf: str) -> DataFrame:
    """A schema per part: its size limits a number, its brand is the only text allowed."""
    document = (
        f"to_json(named_struct('$schema', '{_META}', 'type', 'object', 'properties', named_struct('size', named_struct('type', 'integer', 'maximum', p_size),"
        " 'brand', named_struct('const', p_brand)), 'required', array('size'), 'additionalProperties', false))"
    )
    return feed.table(spark, sf, "part").selectExpr("concat('iglu:org.part/p', p_partkey, '/jsonschema/1-0-0') AS uri", f"{document} AS document", "1 AS priority")


@query("""
WITH n AS (SELECT max(p_partkey) AS n FROM part), e AS (SELECT event_id, user_id, 1 + event_id % (SELECT n + 3 FROM n) AS k FROM events)
SELECT event_id, CASE WHEN p_partkey IS NULL THEN 'schema not found: Schema not found in any registry: iglu:org.part/p' || k || '/jsonschema/1-0-0'
  WHEN event_id % 3 = 0 THEN 'data validation error: Failed to validate iglu:org.part/p' || k || '/jsonschema/1-0-0: brand: value is not the expected value'
  WHEN user_id % 60 > p_size THEN 'data validation error: Failed to validate iglu:org.part/p' || k || '/jsonschema/1-0-0: size: number breaks maximum' END AS reason,
  CASE WHEN p_partkey IS NOT NULL AND user_id % 60 <= p_size AND event_id % 3 <> 0 THEN 'p' || k END AS event_name
FROM e LEFT JOIN part ON p_partkey = k
""")
def registry_validation(spark, sf):
    """Events against a registry with a schema per part, looked up by URI."""
    rules = load_rules(spark, [_part_registry(spark, sf)], CONFIG.schema_vendor)
    parts = feed.table(spark, sf, "part")
    last = parts.agg(F.max("p_partkey").alias("last"))
    keyed = parts.select("p_partkey", "p_brand").unionByName(last.selectExpr("explode(sequence(last + 1, last + 3)) AS p_partkey", "'none' AS p_brand"))
    n = last.first()["last"] + 3
    brand = "IF(event_id % 3 = 0, 'wrong', p_brand)"
    raw = _single_bodies(
        spark, sf, "concat('iglu:org.part/p', p_partkey, '/jsonschema/1-0-0')", f"to_json(named_struct('brand', {brand}, 'size', user_id % 60))", keyed, f"p_partkey = 1 + event_id % {n}"
    )
    processed = process_raw(raw, PipelineConfig(device_enabled=False), rules)
    errors = to_errors(processed).selectExpr("CAST(substring(get_json_object(CAST(payload AS STRING), '$.networkUserId'), 2) AS BIGINT) AS event_id", "reason", "CAST(NULL AS STRING) AS event_name")
    good = to_atomic(processed, CONFIG).selectExpr(f"{_EVENT_OF} AS event_id", "CAST(NULL AS STRING) AS reason", "event_name")
    return good.unionByName(errors)


_ADVANCED = {
    "tree": {"type": "object", "properties": {"v": {"type": "integer"}, "next": {"$ref": "#"}}, "required": ["v"], "additionalProperties": False},
    "depends": {"type": "object", "properties": {"card": {}}, "dependentSchemas": {"card": {"required": ["address"]}}},
    "either": {"type": "object", "anyOf": [{"properties": {"a": {"type": "integer"}}, "required": ["a"]}, {"properties": {"b": {}}, "required": ["b"]}], "unevaluatedProperties": False},
    "anchored": {"type": "object", "properties": {"l": {"prefixItems": [{"$ref": "#num"}], "unevaluatedItems": False}}, "$defs": {"n": {"$anchor": "num", "type": "number"}}},
    "broken": {"type": "object", "unevaluatedProperties": 5},
}


@query("""
SELECT event_id, CASE event_id % 10 WHEN 1 THEN 'data validation error: Failed to validate iglu:org.rules/tree/jsonschema/1-0-0: next: v: value is not of type integer'
  WHEN 3 THEN 'data validation error: Failed to validate iglu:org.rules/depends/jsonschema/1-0-0: address is required'
  WHEN 5 THEN 'data validation error: Failed to validate iglu:org.rules/either/jsonschema/1-0-0: c is not allowed'
  WHEN 7 THEN 'data validation error: Failed to validate iglu:org.rules/anchored/jsonschema/1-0-0: l: no value is allowed'
  WHEN 8 THEN 'invalid schema: Invalid Schema: 5 is not a schema' WHEN 9 THEN 'invalid schema: Invalid Schema: 5 is not a schema' END AS reason
FROM events
""")
def schema_keywords(spark, sf):
    """Recursive and anchored references, dependent schemas, unevaluated parts, an ill-formed document."""
    registry = registry_table(spark, {f"iglu:org.rules/{name}/jsonschema/1-0-0": {"$schema": _META, **d} for name, d in _ADVANCED.items()}, 1)
    name = "CASE event_id % 10 div 2 WHEN 0 THEN 'tree' WHEN 1 THEN 'depends' WHEN 2 THEN 'either' WHEN 3 THEN 'anchored' ELSE 'broken' END"
    data = (
        "CASE event_id % 10 WHEN 0 THEN concat('{\"v\":1,\"next\":{\"v\":', user_id, '}}') WHEN 1 THEN concat('{\"v\":1,\"next\":{\"v\":\"', user_id, '\"}}')"
        " WHEN 2 THEN concat('{\"card\":', user_id, ',\"address\":\"a\"}') WHEN 3 THEN concat('{\"card\":', user_id, '}')"
        " WHEN 4 THEN concat('{\"a\":', user_id, ',\"b\":\"', event_type, '\"}') WHEN 5 THEN concat('{\"a\":', user_id, ',\"c\":1}')"
        " WHEN 6 THEN concat('{\"l\":[', user_id, ']}') WHEN 7 THEN concat('{\"l\":[', user_id, ',2]}') ELSE '{}' END"
    )
    raw = _single_bodies(spark, sf, f"concat('iglu:org.rules/', {name}, '/jsonschema/1-0-0')", data)
    processed = process_raw(raw, PipelineConfig(device_enabled=False), load_rules(spark, [registry], CONFIG.schema_vendor))
    return processed.selectExpr("CAST(substring(networkUserId, 2) AS BIGINT) AS event_id", f"IF(err IS NULL, NULL, {reason('err')}) AS reason")


@query("""
SELECT event_id, event_id % 3 = 0 AS valid, CASE event_id % 3 WHEN 1 THEN 'collector_host is required' WHEN 2 THEN 'event' END AS about FROM events
""")
def atomic_row_validation(spark, sf):
    """Atomic rows as JSON against the schema of atomic events."""
    vendor = CONFIG.schema_vendor
    base = (
        "named_struct('event_id', CAST(event_id AS STRING), 'platform', 'web', 'event_vendor', 'v', 'event_name', event_type, 'event_version', '1-0-0',"
        " 'tstamp', CAST(ts AS STRING), 'collector_tstamp', CAST(ts AS STRING), 'etl_tstamp', CAST(ts AS STRING), 'v_collector', 'c', 'v_etl', 'e',"
        " 'domain_sessionidx', user_id, 'contexts', array(named_struct('schema', 'iglu:a/b/jsonschema/1-0-0', 'data', named_struct('a', 1))),"
        " 'collector_host', IF(event_id % 3 = 1, NULL, 'h'), 'event', named_struct('schema', IF(event_id % 3 = 2, 'nowhere', 'iglu:a/b/jsonschema/1-0-0'), 'data', named_struct('x', value)))"
    )
    uri = lit(f"iglu:{vendor}/atomic/jsonschema/1-0-0")
    rows = feed.table(spark, sf, "events").selectExpr("event_id", f"parse_json(to_json({base})) AS d", f"{uri} AS u")
    checked = rows.withColumn("bad", F.expr(feed_rules().violation("u", "d")))
    return checked.selectExpr("event_id", "bad IS NULL AS valid", "IF(startswith(bad, 'event:'), 'event', bad) AS about")


# The key pair of the queries' own tokens (RSA, 1,024 bits): modulus and private exponent in hex, and the public key.
_MODULUS = (
    "ebd0ac511895a07cf4c0891b7482d9ce3f029c77d0812887e0e0fc500a19a8311aebdcb3668ae42aa3a38b09c06fb0dcd5bfd0bace5c504e33751e4b6a45064a2a2d68833ff23f3178ac29"
    "73042aa04b505758fc49501d68c3e48c81864e3b583495eb9927225762c9a4e37bfd879e3bf87495af59ce8379367a5d6e1114888d"
)
_EXPONENT = (
    "4b761f6e641b9d9bdf06add967536837a3da460fe15d338727e3575a95a0d83dbe8bb3b8851bf51fdff5b9cc891434d8b65e07817ffff282d3dcaab11f74af29f74b21cc8e549f88353344"
    "7b89f88f74bfcacb8fb7bf3eea316065e36da9cde3a14985a5831a712698828ca0302df1b58ea7f190cc7c82e0a0b1e6de10d9da01"
)
_PUBLIC_KEY = (
    "MIGfMA0GCSqGSIb3DQEBAQUAA4GNADCBiQKBgQDr0KxRGJWgfPTAiRt0gtnOPwKcd9CBKIfg4PxQChmoMRrr3LNmiuQqo6OLCcBvsNzVv9C6zlxQTjN1HktqRQZKKi1ogz/yPzF4rClzBCqgS1BXWP"
    "xJUB1ow+SMgYZOO1g0leuZJyJXYsmk43v9h547+HSVr1nOg3k2el1uERSIjQIDAQAB"
)
_SIGNING_KEY = (int(_MODULUS, 16), int(_EXPONENT, 16), f"-----BEGIN PUBLIC KEY-----\n{_PUBLIC_KEY}\n-----END PUBLIC KEY-----")


def _signed_token(claims: dict, key: tuple[int, int, str]) -> str:
    def part(data: bytes) -> str:
        return base64.urlsafe_b64encode(data).decode().rstrip("=")

    text_ = f"{part(json.dumps({'alg': 'RS256'}).encode())}.{part(json.dumps(claims).encode())}"
    tail = bytes.fromhex("3031300d060960864801650304020105000420") + hashlib.sha256(text_.encode()).digest()
    size = (key[0].bit_length() + 7) // 8
    padded = int.from_bytes(b"\x00\x01" + b"\xff" * (size - len(tail) - 3) + b"\x00" + tail, "big")
    return f"{text_}.{part(pow(padded, key[1], key[0]).to_bytes(size, 'big'))}"


@query("""
SELECT event_id, CASE user_id % 8 WHEN 0 THEN 'user0' WHEN 1 THEN 'user1' WHEN 2 THEN 'user2' END AS subject FROM events
""")
def bearer_subjects(spark, sf):
    """Subjects of signed tokens: valid, forged, expired, for others, by an unknown issuer, nonsense, none."""
    key = _SIGNING_KEY
    good = [_signed_token({"iss": "https://a", "sub": f"user{i}", "aud": "me"}, key) for i in range(4)]
    tokens = good[:3] + [
        ".".join([*good[3].split(".")[:2], good[0].split(".")[2]]),
        _signed_token({"iss": "https://a", "sub": "late", "aud": "me", "exp": 1000}, key),
        _signed_token({"iss": "https://a", "sub": "other", "aud": "them"}, key),
        _signed_token({"iss": "https://b", "sub": "stranger", "aud": "me"}, key),
    ]
    case = " ".join(f"WHEN {i} THEN {lit(f'authorization: Bearer {t}')}" for i, t in enumerate(tokens))
    raw = _raw(spark, sf).withColumn("headers", F.expr(f"array(CASE CAST(substring(networkUserId, 2) AS BIGINT) % 8 {case} ELSE 'authorization: Basic x' END)"))
    raw = raw.withColumn("hostname", F.expr("concat(timestamp, '')"))
    issuers = spark.createDataFrame([("https://a", key[2]), ("https://a", key[2])], "issuer string, issuer_key string")
    events = feed.table(spark, sf, "events").select("event_id", "user_id")
    found = with_auth_subject(raw, PipelineConfig(auth_enabled=True, auth_audience="me"), issuers)
    by_user = found.selectExpr("CAST(substring(networkUserId, 2) AS BIGINT) AS user_id", "collector_auth AS subject").distinct()
    return events.join(by_user, "user_id").select("event_id", "subject")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, count(*) FILTER (user_id % 2 = 0) AS noted, sum(CASE WHEN user_id % 2 = 0 THEN user_id END)::BIGINT AS total
FROM x WHERE user_id % 7 <> 0 GROUP BY 1
UNION ALL SELECT 'rejected', count(*), 0, NULL FROM events WHERE (event_type <> 'error' OR event_id % 8 = 5) AND user_id % 7 = 0
""")
def enrichment_verdict(spark, sf):
    """Custom steps in the chain: one rejects payloads, one adds a context that the next reads."""
    note = "iglu:org.example/note/jsonschema/1-0-0"
    user = "CAST(substring(networkUserId, 2) AS BIGINT)"
    steps = [
        Enrichment(reject=f"IF({user} % 7 = 0, 'unwanted user', NULL)"),
        Enrichment(contexts={note: f"IF({user} % 2 = 0, to_json(named_struct('user', {user})), NULL)"}),
        Enrichment(values={"tenant_id": f"get_json_object(try_element_at(filter(it.contexts, c -> c.schema = {lit(note)}), 1).data, '$.user')"}),
    ]
    dims = Dimensions(enrichments=steps)
    processed = staged(process_raw(_raw(spark, sf), CONFIG, feed_rules(), dims), "processed")  # judged once, read twice
    good = to_atomic(processed, CONFIG, dims).groupBy("event_name").agg(
        F.count("*").alias("n"), F.count("tenant_id").alias("noted"), F.sum(F.col("tenant_id").cast("bigint")).alias("total")
    )
    bad = to_errors(processed).where("reason = 'invalid event data: unwanted user'").agg(F.count("*").alias("n"))
    return good.unionByName(bad.selectExpr("'rejected' AS event_name", "n", "0L AS noted", "CAST(NULL AS BIGINT) AS total"))


@query("""
WITH r AS (SELECT n_name, r_name, n_nationkey, n_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey),
     e AS (SELECT event_id, event_id % 2 = 1 AS v6, user_id % 256 AS o2, user_id % 8 AS g FROM events)
SELECT event_id, CASE WHEN v6 THEN coalesce(reg.r_name, 'third') ELSE coalesce(r.n_name, 'low half') END AS geo_country
FROM e LEFT JOIN r ON NOT v6 AND n_nationkey = o2 // 10 AND o2 % 10 < 5 LEFT JOIN region reg ON v6 AND r_regionkey = g
""")
def geo_wide_ranges(spark, sf):
    """Nested ranges from half of all IPv4 addresses and an eighth of all IPv6 addresses down to single networks."""
    narrow = feed.geo_ranges(feed.table(spark, sf, "nation"), feed.table(spark, sf, "region"))
    six = feed.table(spark, sf, "region").selectExpr(
        "concat('2001:db8:', r_regionkey, '::') AS start_ip", "concat('2001:db8:', r_regionkey, ':ffff:ffff:ffff:ffff:ffff') AS end_ip",
        "r_name AS country", "'r' AS region", "'c' AS city",
    )
    wide = spark.sql(
        "SELECT * FROM VALUES ('0.0.0.0', '127.255.255.255', 'low half', 'r', 'c'),"
        " ('2000::', '3fff:ffff:ffff:ffff:ffff:ffff:ffff:ffff', 'third', 'r', 'c') AS t(start_ip, end_ip, country, region, city)"
    )
    address = "IF(event_id % 2 = 1, concat('2001:db8:', user_id % 8, ':7::', event_id % 100), concat('10.', user_id % 256, '.', event_id % 256, '.9'))"
    rows = feed.table(spark, sf, "events").selectExpr("event_id", f"{address} AS address")
    return with_geo(rows, narrow.unionByName(six).unionByName(wide), CONFIG).select("event_id", "geo_country")


_AGENT_RULES = """rules AS (
  SELECT 'browser' AS kind, c_custkey AS ord, 'Client' || c_custkey || '/([0-9]+)[.]([0-9]+)' AS pattern, c_name AS family, '$1' AS major FROM customer
  UNION ALL SELECT 'browser', 1000000000, 'Client([0-9]+)/([0-9]+)', 'Client $1', '$2'
  UNION ALL SELECT 'browser', 1000000001, '^(?:x|y)+$', 'Letters', NULL
  UNION ALL SELECT 'os', n_nationkey, '; N' || n_nationkey || '(;|$)', n_name, NULL FROM nation
  UNION ALL SELECT 'device', r_regionkey, ' R' || r_regionkey || '$', r_name, '7' FROM region)"""
_AGENT = """CASE WHEN event_id % 3 = 0 THEN 'Client5/7.0 (X; N3; R1' WHEN event_id % 7 = 0 THEN 'xyx' WHEN event_id % 7 = 1 THEN 'none'
  ELSE 'Client' || (user_id % 60 * 50) || '/' || (user_id % 9) || '.1 (X; N' || (user_id % 30) || '; R' || (user_id % 8) END"""


@query(f"""
WITH {_AGENT_RULES}, e AS (SELECT event_id, {_AGENT} AS ua FROM events), agents AS (SELECT DISTINCT ua FROM e),
fits AS (SELECT ua, kind, arg_min(struct_pack(p := pattern, f := family, m := major), ord) AS r FROM agents JOIN rules ON regexp_matches(ua, pattern) GROUP BY ua, kind),
told AS (
  SELECT ua, max(kind) AS _, max(replace(r.f, '$1', regexp_extract(ua, r.p, 1))) FILTER (kind = 'browser') AS browser,
    max(CASE r.m WHEN '$1' THEN regexp_extract(ua, r.p, 1) WHEN '$2' THEN regexp_extract(ua, r.p, 2) END) FILTER (kind = 'browser') AS version,
    max(r.f) FILTER (kind = 'os') AS os, max(r.f) FILTER (kind = 'device') AS device
  FROM fits GROUP BY ua)
SELECT event_id, CASE WHEN told.ua IS NOT NULL THEN coalesce(browser, 'Other') END AS browser, version, CASE WHEN told.ua IS NOT NULL THEN coalesce(os, 'Other') END AS os,
  CASE WHEN told.ua IS NOT NULL THEN coalesce(device, 'Other') END AS device
FROM e LEFT JOIN told USING (ua)
""")
def agent_rules(spark, sf):
    """A rule for each customer and general ones after them; a third of all events have one agent."""
    for name in ("customer", "nation", "region"):
        feed.table(spark, sf, name).createOrReplaceTempView(name)
    rules = spark.sql(f"WITH {_AGENT_RULES} SELECT kind, ord, pattern, family, major FROM rules")
    views = feed.spread(feed.table(spark, sf, "events")).selectExpr(
        "'CollectorPayload' AS schema", "'10.0.0.7' AS ipAddress", "0L AS timestamp", "'UTF-8' AS encoding", "'feed-1' AS collector", f"{_AGENT} AS userAgent", "CAST(NULL AS STRING) AS refererUri", "'/i' AS path",
        "concat('e=pv&p=web&url=u&eid=ev-', event_id) AS querystring", "CAST(NULL AS BINARY) AS body", "array('Host: h') AS headers", "CAST(NULL AS STRING) AS contentType", "'h' AS hostname", "'n' AS networkUserId",
    )
    dims = Dimensions(agent_rules=rules)
    events = to_atomic(process_raw(views.select(*RAW_COLUMNS), CONFIG, feed_rules(), dims), CONFIG, dims)
    told = events.selectExpr(f"{_NUMBER} AS event_id", f"from_json({_context(DEVICE)}, 'MAP<STRING, STRING>') AS d")
    return told.selectExpr("event_id", "d['browser_family'] AS browser", "d['browser_version'] AS version", "d['os_family'] AS os", "d['device_family'] AS device")


@query("""
WITH r AS (SELECT o_orderkey % 1048576 AS k, max('o' || o_orderkey) AS country FROM orders GROUP BY 1)
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 256 < 128 THEN 'low' END ELSE coalesce(country, 'net') END AS geo_country
FROM events LEFT JOIN r ON event_id % 3 > 0 AND k = event_id * 7 % 1048576
""")
def geo_dense_ranges(spark, sf):
    """A network for each order, all inside one, and a third of the events from one network: swept, not sent to tasks."""
    block = "concat('2001:db8:', hex({0} div 16), ':', hex({0} % 16), '{1}')".format
    key = "(o_orderkey % 1048576)"
    dense = feed.table(spark, sf, "orders").selectExpr(
        f"{block(key, '000::')} AS start_ip", f"{block(key, 'fff:ffff:ffff:ffff:ffff')} AS end_ip", "concat('o', o_orderkey) AS country", "'r' AS region", "'c' AS city",
    )
    wide = spark.sql(
        "SELECT * FROM VALUES ('2001:db8::', '2001:db8:ffff:ffff:ffff:ffff:ffff:ffff', 'net', 'r', 'c'),"
        " ('203.0.113.0', '203.0.113.127', 'low', 'r', 'c') AS t(start_ip, end_ip, country, region, city)"
    )
    address = f"IF(event_id % 3 = 0, concat('203.0.113.', event_id % 256), {block('(event_id * 7 % 1048576)', '123::5')})"
    rows = feed.table(spark, sf, "events").selectExpr("event_id", f"{address} AS address")
    return with_geo(rows, dense.unionByName(wide), CONFIG, sent_bytes=0).select("event_id", "geo_country")


@query("""
SELECT event_id, 'w' || event_id % 11 AS kept, 2::BIGINT AS sent FROM events
""")
def context_collision(spark, sf):
    """Two versions of a context share a column: the last one is kept."""
    newer = feed.WEB_PAGE.replace("1-0-0", "1-0-1")
    contexts = (
        f"array(named_struct('schema', {lit(feed.WEB_PAGE)}, 'data', '{{\"id\":\"first\"}}'),"
        f" named_struct('schema', {lit(newer)}, 'data', concat('{{\"id\":\"w', event_id % 11, '\"}}')))"
    )
    event = f"named_struct('schema', {lit(feed.LINK_CLICK)}, 'data', '{{}}')"
    columns = {c: "CAST(NULL AS STRING)" for c in ATOMIC_COLUMNS} | {"event_id": "CAST(event_id AS STRING)", "contexts": contexts, "event": event}
    rows = feed.table(spark, sf, "events").selectExpr(*[f"{v} AS {c}" for c, v in columns.items()])
    column = iglu.context_column_name(feed.WEB_PAGE)
    flat = flatten_atomic(rows, all_schemas=True, columns=[column])
    return flat.selectExpr("CAST(event_id AS BIGINT) AS event_id", f"get_json_object({column}, '$.id') AS kept", "2L AS sent")


# --- Store and streams ------------------------------------------------------------------------------


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT make_timestamp((epoch_us(ts) // 1000 - CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN 1000
    WHEN event_type = 'view' AND event_id % 3 = 2 OR event_type = 'purchase' THEN 0 ELSE (event_id % 7) * 1000 END) * 1000)::DATE AS day,
  event_name AS folder, event_name, count(*) AS n, count(DISTINCT user_id) AS users FROM x GROUP BY ALL
""")
def store_round_trip(spark, sf):
    """Events written by day and name, read back, and counted from the folders."""
    path = f"{scratch_dir(spark)}/atomic"
    write_atomic(_atomic(spark, sf), path)
    stored = read_atomic(spark, path)
    return stored.groupBy(F.col("event_date").alias("day"), F.col("name").alias("folder"), "event_name").agg(
        F.count("*").alias("n"), F.countDistinct("network_userid").alias("users")
    )


def _file_stream(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    """The files of a folder as a stream of ``least`` micro-batches at least, if there are as many files.

    A micro-batch is a few files for each core, however long the stream: what a job keeps of one does not grow with it.
    """
    files = len(spark.read.parquet(path).inputFiles())
    taken = max(1, min(4 * spark.sparkContext.defaultParallelism, -(-files // least)))
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", taken).parquet(path)


def _message_stream(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Encoded payloads in files of the shared folder, a file for each task, as a stream of four micro-batches or more; and that folder."""
    out = scratch_dir(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism  # a file for each core in each of four micro-batches
    raw = feed.raw_from_events(feed.spread(feed.table(spark, sf, "events"), tasks))
    raw.select(F.expr(codecs.raw_avro()).alias("value")).write.parquet(f"{out}/messages")
    return _file_stream(spark, f"{out}/messages", 4), out


def _run(stream) -> int:
    stream.awaitTermination()
    return len([p for p in stream.recentProgress if p["numInputRows"]])


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, 0::BIGINT AS missing FROM x GROUP BY 1
UNION ALL SELECT 'errors', count(*), 0 FROM events WHERE event_type = 'error'
""")
def stream_equals_batch(spark, sf):
    """The stream in several micro-batches against the batch job over the same payloads, by event id."""
    messages, out = _message_stream(spark, sf)
    batches = _run(enrich_stream(messages, CONFIG, feed_rules, parquet_batch_writer(f"{out}/events"), parquet_batch_writer(f"{out}/errors"), f"{out}/checkpoint"))
    assert batches > 1 or not spark.read.parquet(f"{out}/messages").count()
    streamed = spark.read.parquet(f"{out}/events").select("event_name", "event_id")
    batch = _atomic(spark, sf).select("event_name", "event_id")
    both = streamed.withColumn("n", F.lit(1)).unionByName(batch.withColumn("n", F.lit(-1)))
    odd = both.groupBy("event_name", "event_id").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("here"))
    good = odd.groupBy("event_name").agg(F.sum("here").alias("n"), F.count_if(F.col("n") != 0).alias("missing"))
    bad = spark.read.parquet(f"{out}/errors").agg(F.count("*").alias("n"))
    return good.unionByName(bad.selectExpr("'errors' AS event_name", "n", "0L AS missing"))


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, count(*) AS ids FROM x GROUP BY 1
""")
def stream_replay(spark, sf):
    """Each micro-batch delivered twice, as after a crash before the commit: nothing is doubled."""
    messages, out = _message_stream(spark, sf)
    write = parquet_batch_writer(f"{out}/events")

    def twice(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        write(df, batch_id)

    _run(enrich_stream(messages, CONFIG, feed_rules, twice, parquet_batch_writer(f"{out}/errors"), f"{out}/checkpoint"))
    events = spark.read.parquet(f"{out}/events")
    return events.groupBy("event_name").agg(F.count("*").alias("n"), F.countDistinct("event_id", "event.data").alias("ids"))


def _queue_stream(spark: SparkSession, messages: DataFrame) -> tuple[DataFrame, str]:
    out = scratch_dir(spark)
    messages.select("value").write.parquet(f"{out}/messages")
    return _file_stream(spark, f"{out}/messages"), out


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, count(DISTINCT user_id) AS users FROM x GROUP BY 1
UNION ALL SELECT 'unreadable', count(*), 0 FROM region
""")
def events_consumer(spark, sf):
    """The events queue through a consumer; messages that are no events go to its error writer."""
    noise = feed.table(spark, sf, "region").selectExpr("CAST(r_name AS BINARY) AS value")
    stream, out = _queue_stream(spark, codecs.encode_atomic(_atomic(spark, sf)).select("value").unionByName(noise))
    _run(consume_events(stream, parquet_batch_writer(f"{out}/events"), f"{out}/checkpoint", write_errors=parquet_batch_writer(f"{out}/errors")))
    events = spark.read.parquet(f"{out}/events")
    good = events.groupBy("event_name").agg(F.count("*").alias("n"), F.countDistinct("network_userid").alias("users"))
    bad = spark.read.parquet(f"{out}/errors").agg(F.count("*").alias("n"))
    return good.unionByName(bad.selectExpr("'unreadable' AS event_name", "n", "0L AS users"))


@query("""
SELECT 'h' || user_id % 5 || '.example.org' AS collector_domain, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1
UNION ALL SELECT 'raw ' || r_name, 1 FROM region
""")
def errors_consumer(spark, sf):
    """The errors queue through a consumer; bytes that are no error record are handed on as they are."""
    errors = to_errors(process_raw(_raw(spark, sf), CONFIG, feed_rules()))
    noise = feed.table(spark, sf, "region").selectExpr("CAST(r_name AS BINARY) AS value")
    stream, out = _queue_stream(spark, codecs.encode_errors(errors).unionByName(noise))
    _run(consume_errors(stream, parquet_batch_writer(f"{out}/seen"), f"{out}/checkpoint"))
    seen = spark.read.parquet(f"{out}/seen").selectExpr("coalesce(collector_domain, concat('raw ', CAST(raw AS STRING))) AS collector_domain")
    return seen.groupBy("collector_domain").agg(F.count("*").alias("n"))


# --- SQL over events --------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')
SELECT p.event_id, (SELECT max(v.event_id) FROM v WHERE v.user_id = p.user_id AND v.ts = (
  SELECT max(w.ts) FROM v w WHERE w.user_id = p.user_id AND w.ts <= p.ts)) AS last_view FROM p
""")
def last_view_before_purchase(spark, sf):
    """As-of join: each purchase with the user's last view up to then, both in one order."""
    return _last_views(_atomic(spark, sf), "network_userid", SLICE_ROWS)


def _last_views(atomic: DataFrame, user: str, slice_rows: int) -> DataFrame:
    rows = atomic.where("event_name IN ('page_view', 'transaction')").selectExpr(
        f"{user} AS usr", "unix_micros(collector_tstamp) AS at", f"{_NUMBER} AS id", "IF(event_name = 'page_view', 0, 1) AS kind", f"IF(event_name = 'page_view', {_NUMBER}, NULL) AS view"
    )
    seen = with_last(ordered(rows, "usr", "at", ["kind", "id"], CONFIG, slice_rows, 60_000_000), "view", "last_view")
    return seen.where("kind = 1").selectExpr("id AS event_id", "last_view")


_HOT_USER = "IF({0} % 3 = 0, 'hot', 'n' || {1})"


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'n' || user_id END AS usr, ts, event_type FROM events WHERE event_type IN ('view', 'purchase'))
SELECT event_id, last_view FROM (
  SELECT event_id, event_type, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (
    PARTITION BY usr ORDER BY ts, event_type = 'purchase', event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_view FROM e)
WHERE event_type = 'purchase'
""")
def last_view_of_hot_user(spark, sf):
    """The same where one user has a third of all events: the user's rows are cut into slices of time."""
    return _last_views(_atomic(spark, sf), _HOT_USER.format(_NUMBER, "substring(network_userid, 2)"), 500)


@query(f"""
WITH x AS (SELECT DISTINCT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'n' || user_id END AS usr FROM ({_EXPECTED_EVENTS})),
g AS (SELECT *, lag(ts) OVER o AS previous FROM x WINDOW o AS (PARTITION BY usr ORDER BY ts, event_id))
SELECT event_id, sum((previous IS NULL OR epoch_us(ts) // 1000 - epoch_us(previous) // 1000 > 600000)::INT) OVER (PARTITION BY usr ORDER BY ts, event_id)::BIGINT AS session FROM g
""")
def session_numbers(spark, sf):
    """The number of its user's session for each payload, by a gap of ten minutes; one user has a third of them."""
    payloads = _atomic(spark, sf).selectExpr(f"{_NUMBER} AS event_id", "network_userid", "unix_micros(collector_tstamp) AS us").distinct()
    rows = payloads.selectExpr("event_id", f"{_HOT_USER.format('event_id', 'substring(network_userid, 2)')} AS usr", "us", "us div 1000 AS at")
    numbered = with_sessions(rows, "usr", "at", ["us", "event_id"], 600_000, CONFIG, slice_rows=500, stretch=60_000)
    return numbered.select("event_id", "session")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}), c AS (SELECT user_id, count(*) AS n FROM x GROUP BY 1)
SELECT 'n' || user_id AS usr, n FROM c WHERE n > (SELECT avg(n) FROM c)
  AND EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.user_id AND e.event_type = 'signup')
""")
def busy_new_users(spark, sf):
    """A common table expression, a scalar and a correlated subquery over the events."""
    events = _atomic(spark, sf).select("event_name", "network_userid")
    staged(events, "events").createOrReplaceTempView("atomic_for_subqueries")  # read three times
    return spark.sql(
        "WITH c AS (SELECT network_userid AS usr, count(*) AS n FROM atomic_for_subqueries GROUP BY 1)"
        " SELECT usr, n FROM c WHERE n > (SELECT avg(n) FROM c)"
        " AND EXISTS (SELECT 1 FROM atomic_for_subqueries a WHERE a.network_userid = c.usr AND a.event_name = 'structured_event')"
    )


@query("""
SELECT 'both' AS how, count(*) AS n FROM (SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'click')
UNION ALL SELECT 'more views', count(*) FROM (SELECT user_id FROM events WHERE event_type = 'view' EXCEPT ALL SELECT user_id FROM events WHERE event_type = 'click')
""")
def view_and_click_sets(spark, sf):
    """Users with both kinds, and views beyond a user's clicks, by set operations."""
    atomic = staged(_atomic(spark, sf).select("event_name", "network_userid"), "events")  # read four times
    views, clicks = (atomic.where(f"event_name = '{n}'").select("network_userid") for n in ("page_view", "link_click"))
    both = views.intersect(clicks).agg(F.count("*").alias("n")).selectExpr("'both' AS how", "n")
    return both.unionByName(views.exceptAll(clicks).agg(F.count("*").alias("n")).selectExpr("'more views' AS how", "n"))


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}) SELECT event_name, count(DISTINCT user_id) AS users, true AS close FROM x GROUP BY 1
""")
def approximate_users(spark, sf):
    """Distinct users by sketch, within the sketch's error of the exact count."""
    counted = _atomic(spark, sf).groupBy("event_name").agg(
        F.countDistinct("network_userid").alias("users"), F.approx_count_distinct("network_userid", 0.02).alias("about")
    )
    return counted.selectExpr("event_name", "users", "abs(about - users) <= greatest(2, 0.1 * users) AS close")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT 'h' || user_id % 5 || '.example.org' AS host, max(event_id) FILTER (ts = m) AS event_id
FROM (SELECT *, max(ts) OVER (PARTITION BY user_id % 5) AS m FROM x) GROUP BY 1
""")
def latest_event_per_host(spark, sf):
    """Top one per key by an aggregate, so that a host with most events is summed up before the shuffle."""
    atomic = _atomic(spark, sf)
    latest = atomic.groupBy(F.col("collector_host").alias("host")).agg(F.max(F.struct("collector_tstamp", F.expr(_NUMBER).alias("id"))).alias("top"))
    return latest.selectExpr("host", "top.id AS event_id")


@query("""
WITH v AS (SELECT user_id, 'c' || user_id % 3 AS campaign, min(ts) AS first FROM events WHERE event_type = 'view' AND event_id % 4 = 0 GROUP BY 1, 2),
     p AS (SELECT user_id, max(ts) AS last FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT campaign, count(*) AS users, count(p.user_id) AS buyers FROM v LEFT JOIN p ON p.user_id = v.user_id AND p.last >= v.first GROUP BY 1
""")
def campaign_funnel(spark, sf):
    """Users a campaign brought, and those of them who bought later."""
    from millrace.plans.queries import CAMPAIGN, _context

    campaign = f"get_json_object({_context(CAMPAIGN)}, '$.campaign') AS campaign"
    atomic = staged(_atomic(spark, sf).selectExpr("event_name", "network_userid", "collector_tstamp", campaign), "events")  # read twice
    views = atomic.selectExpr("network_userid AS usr", "campaign", "collector_tstamp AS at")
    firsts = views.where("campaign IS NOT NULL").groupBy("usr", "campaign").agg(F.min("at").alias("first"))
    lasts = atomic.where("event_name = 'transaction'").groupBy(F.col("network_userid").alias("buyer")).agg(F.max("collector_tstamp").alias("last"))
    funnel = firsts.join(lasts, F.expr("usr = buyer AND last >= first"), "left")
    return funnel.groupBy("campaign").agg(F.count("*").alias("users"), F.count("buyer").alias("buyers"))


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}), c AS (SELECT user_id, count(*) AS n FROM x GROUP BY 1)
SELECT 'n' || user_id AS usr, n, rank() OVER (ORDER BY n DESC) AS rnk FROM c
""")
def user_ranks(spark, sf):
    """All users by their events, without a task that sorts them all."""
    counted = _atomic(spark, sf).groupBy(F.col("network_userid").alias("usr")).agg(F.count("*").alias("n"))
    return with_rank(counted, "n", CONFIG, "rnk")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*)::BIGINT AS n, true AS close FROM x WHERE ts::DATE > (SELECT min(ts)::DATE FROM x) GROUP BY 1
""")
def users_over_days(spark, sf):
    """Distinct users of all days but the first from stored daily sketches, held against the exact number: four standard errors."""
    events = staged(_atomic(spark, sf).selectExpr("event_name", "network_userid AS usr", "to_date(collector_tstamp) AS day"), "events")  # read twice
    path = f"{scratch_dir(spark)}/sketches"
    daily_sketches(events, "day", ["event_name"], "usr").write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    first = stored.agg(F.min("day")).first()[0]
    found = distinct_over(stored.where(F.col("day") > F.lit(first)), ["event_name"])
    exact = events.where(F.col("day") > F.lit(first)).groupBy("event_name").agg(F.countDistinct("usr").alias("exact"))
    near = F.abs(F.col("about") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (REGISTERS / 2) * F.col("exact"))
    return found.join(exact, "event_name").select("event_name", "n", near.alias("close"))


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT 'success' AS outcome, count(DISTINCT event_id) AS n FROM x UNION ALL SELECT 'error', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'undecodable', count(*) FROM events WHERE event_id % 10 = 9
""")
def stream_metrics(spark, sf):
    """Payloads and messages by outcome, as each micro-batch of an enrichment stream counts them while they pass."""
    rows = feed.spread(feed.table(spark, sf, "events")).withColumn("cut", F.explode(F.expr("IF(event_id % 10 = 9, array(false, true), array(false))")))
    raw = feed.raw_from_events(rows.withColumn("ts", F.expr("IF(cut, NULL, ts)"))).withColumn("whole", F.expr("timestamp IS NOT NULL"))
    messages = raw.withColumn("timestamp", F.expr("coalesce(timestamp, 0)")).select(F.expr(f"IF(whole, {codecs.raw_avro()}, unhex('20'))").alias("value"))
    stream, out = _queue_stream(spark, messages)
    seen: list[dict[str, int]] = []
    _run(
        enrich_stream(
            stream, CONFIG, feed_rules, parquet_batch_writer(f"{out}/events"), parquet_batch_writer(f"{out}/errors"), f"{out}/checkpoint", on_metrics=lambda found, batch: seen.append(found)
        )
    )
    totals = [(k, sum(found[k] for found in seen)) for k in ("success", "error", "undecodable")]
    return spark.createDataFrame(totals, "outcome string, n long")


_TURNS = "least(CAST(floor(4 * (unix_micros(ts) - low) / (high - low + 1)) AS INT), 3)"
_SQL_TURNS = """
e AS (SELECT event_id, user_id, ts, floor(4 * (epoch_us(ts) - min(epoch_us(ts)) OVER ()) / (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1)::DOUBLE)::INT AS turn FROM events),
arrived AS (SELECT *, turn + CASE WHEN event_id % 11 = 3 THEN 2 ELSE 0 END AS batch FROM e),
latest AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS seen FROM arrived GROUP BY batch),
kept AS (
  SELECT arrived.* FROM arrived JOIN latest USING (batch)
  WHERE seen IS NULL OR epoch_us(ts) > (epoch_us(seen) // 1000 - 3600000) * 1000)"""


def _turns(spark: SparkSession, sf: str):
    """Events as a stream of files in the order of their time: every fifth is repeated at once, every seventh in the next file,
    and every eleventh only comes two files later. What a file holds is late by the watermark of the file before the last one."""
    events = feed.table(spark, sf, "events").selectExpr("event_id", "user_id", "CAST(ts AS TIMESTAMP) AS ts")
    span = events.selectExpr("min(unix_micros(ts)) AS low", "max(unix_micros(ts)) AS high")
    at = events.join(F.broadcast(span)).withColumn("turn", F.expr(_TURNS))  # one row
    first = at.withColumn("turn", F.expr("turn + IF(event_id % 11 = 3, 2, 0)"))
    repeats = first.where("event_id % 5 = 0").unionByName(first.where("event_id % 7 = 0").withColumn("turn", F.expr("turn + 1")))
    sent = first.unionByName(repeats).select("turn", "event_id", "user_id", "ts")
    out = scratch_dir(spark)
    for turn in range(7):
        sent.where(f"turn = {turn}").drop("turn").coalesce(1).write.mode("append").parquet(f"{out}/queue")
        time.sleep(0.05)  # files are read in the order of their times
    return spark.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", "1").parquet(f"{out}/queue"), out


@query(f"""
WITH {_SQL_TURNS}
SELECT event_id, turn FROM kept
""")
def stream_without_repeats(spark, sf):
    """Each event once, those that come over an hour late left out; the state is what the last hour holds."""
    stream, out = _turns(spark, sf)
    once = without_repeats(stream, "event_id", "ts", "1 hour")
    _run(once.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/once"))
    span = feed.table(spark, sf, "events").selectExpr("min(unix_micros(CAST(ts AS TIMESTAMP))) AS low", "max(unix_micros(CAST(ts AS TIMESTAMP))) AS high")
    return spark.read.schema("event_id long, user_id long, ts timestamp").parquet(f"{out}/once").join(F.broadcast(span)).selectExpr("event_id", f"{_TURNS} AS turn")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}), v AS (SELECT user_id, count(*) AS views FROM x WHERE event_name = 'page_view' GROUP BY 1),
b AS (SELECT user_id, count(*) AS bought FROM x WHERE event_name = 'transaction_item' GROUP BY 1)
SELECT 'n' || user_id AS usr, views, bought FROM v JOIN b USING (user_id)
""")
def views_and_items_per_user(spark, sf):
    """Two stored tables joined per user where their buckets lie, without a shuffle."""
    events, out = staged(_atomic(spark, sf).select("event_id", "event_name", "network_userid"), "events"), scratch_dir(spark)  # read twice
    name = f"millrace_{out.rsplit('-', 1)[1]}"
    views = write_bucketed(events.where("event_name = 'page_view'"), f"{name}_views", f"{out}/views", buckets=8)
    items = write_bucketed(events.where("event_name = 'transaction_item'"), f"{name}_items", f"{out}/items", buckets=8)
    viewed = views.groupBy("network_userid").agg(F.count("*").alias("views"))
    bought = items.groupBy("network_userid").agg(F.count("*").alias("bought"))
    return viewed.join(bought.hint("merge"), "network_userid").selectExpr("network_userid AS usr", "views", "bought")


@query("""
SELECT event_type AS kind, 'w' || event_id % 11 AS page, count(*) AS n, sum(event_id % 9)::BIGINT AS visits FROM events WHERE event_type = 'click' GROUP BY 1, 2
""")
def stored_context_paths(spark, sf):
    """Events stored with a VARIANT column for each context; two paths are read and nothing else of the contexts."""
    web, session = (iglu.context_column_name(u) for u in (feed.WEB_PAGE, feed.SESSION))
    path = f"{scratch_dir(spark)}/wide"
    write_wide(flatten_atomic(staged(_atomic(spark, sf), "events"), all_schemas=True), path)  # read twice
    stored = spark.read.parquet(path)
    paths = stored.selectExpr(f"variant_get({web}, '$.id', 'string') AS page", f"variant_get({session}, '$.sessionIndex', 'bigint') AS visits")
    return paths.where("page IS NOT NULL").groupBy(F.lit("click").alias("kind"), "page").agg(F.count("*").alias("n"), F.sum("visits").alias("visits"))


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}) SELECT event_name, count(*) AS n, count(DISTINCT event_id) AS payloads FROM x GROUP BY 1
""")
def queue_dump_stream(spark, sf):
    """A dump of the raw queue, read a third of its messages at a time, with a restart after the first micro-batch."""
    out = scratch_dir(spark)
    messages = _raw(spark, sf).select(F.expr(codecs.raw_avro()).alias("value"))
    messages.write.parquet(f"{out}/queue")
    limit = spark.read.parquet(f"{out}/queue").count() // 3 + 1
    for trigger in ({"once": True}, {"processingTime": "0 seconds"}):  # one micro-batch, then the others
        stream = read_queue(spark, "raw", "queue_dump", {"path": f"{out}/queue", **batch_limit("queue_dump", limit)})
        writers = parquet_batch_writer(f"{out}/events"), parquet_batch_writer(f"{out}/errors")
        running = enrich_stream(stream, CONFIG, feed_rules, *writers, f"{out}/checkpoint", trigger=trigger)
        running.processAllAvailable()
        running.stop()
    events = spark.read.parquet(f"{out}/events").selectExpr("event_name", f"{_NUMBER} AS id")
    return events.groupBy("event_name").agg(F.count("*").alias("n"), F.countDistinct("id").alias("payloads"))
