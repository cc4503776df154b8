"""Registered queries, each with SQL that computes the expected result straight from the base tables.

The SQL never goes through a payload: it states what the feed put in and what the job must make of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.functions import iglu, net, text
from millrace.functions.sqltext import lit
from millrace.operators.carry import ordered, with_last
from millrace.operators.enrich import Dimensions, process_raw, to_atomic
from millrace.operators.errors import outcome_counts, to_errors
from millrace.operators.extract import campaign_params
from millrace.operators.requests import requests_to_raw, sized_payloads
from millrace.operators.shred import FieldTransformation, flatten_atomic, typed_data
from millrace.operators.staging import scratch_dir, staged
from millrace.plans import feed
from millrace.session import configure
from millrace.sources import codecs
from millrace.sources.registry import Rules, builtin_documents
from millrace.sources.store import register_atomic
from millrace.streaming.jobs import enrich_stream, parquet_batch_writer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CONFIG = PipelineConfig()
PAGE_VIEW = iglu.builtin_uri(CONFIG.schema_vendor, "page_view")
CAMPAIGN = iglu.builtin_uri(CONFIG.schema_vendor, "campaign_attribution")
DEVICE = iglu.builtin_uri(CONFIG.schema_vendor, "device_info")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


# --- Inputs -----------------------------------------------------------------------------------------


def feed_rules() -> Rules:
    return Rules.compile(builtin_documents(CONFIG.schema_vendor) | feed.FEED_DOCUMENTS)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return feed.spread(feed.table(spark, sf, "events"))


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return feed.raw_from_events(_events(spark, sf))


def _atomic(spark: SparkSession, sf: str, *names: str, with_position: bool = False) -> DataFrame:
    """Events of all payloads; with ``names`` those of these names."""
    events = to_atomic(process_raw(_raw(spark, sf), CONFIG, feed_rules()), CONFIG, with_position=with_position)
    return events.where(F.col("event_name").isin(*names)) if names else events


def _context(uri: str) -> str:
    return f"try_element_at(filter(contexts, c -> c.schema = {lit(uri)}), 1).data"


_NUMBER = "CAST(regexp_extract(event_id, '^ev-([0-9]+)', 1) AS BIGINT)"
# Place in the payload; the feed writes it into the ids of transaction items.
_POS = "coalesce(try_cast(regexp_extract(event_id, '^ev-[0-9]+-([0-9]+)', 1) AS INT), 0) AS pos"


# --- Scalar functions -------------------------------------------------------------------------------


@query("""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
       nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
       nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source
FROM pages
""")
def page_query_params(spark, sf):
    pages = feed.table(spark, sf, "pages").withColumn("q", F.expr(text.parse_qs(net.url_query("url"))))
    return pages.selectExpr("page_id", "q['page'] AS page", "q['ref'] AS ref", "q['utm_source'] AS utm_source")


@query("""
SELECT event_id, user_id::VARCHAR AS a, NULL::VARCHAR AS b, 'x y z' AS c, '%zz=1' AS d, 3::BIGINT AS n FROM events
""")
def query_string_edges(spark, sf):
    qs = "concat('a=', user_id, '&b=&noise&a=', event_id, '&c=x%20y+z&d=%zz=1')"
    q = feed.table(spark, sf, "events").withColumn("q", F.expr(text.parse_qs(qs)))
    return q.selectExpr(
        "event_id", "q['a'] AS a", "q['b'] AS b", "q['c'] AS c", "q['d'] AS d", "CAST(size(q) AS BIGINT) AS n"
    )


@query("""
SELECT page_id, CASE WHEN url LIKE '%utm_source=feed%' THEN '{"source":"feed"}' END AS campaign FROM pages
""")
def page_campaigns(spark, sf):
    pages = feed.table(spark, sf, "pages")
    return pages.selectExpr("page_id", f"to_json({campaign_params('url')}) AS campaign")


@query("SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS n FROM documents")
def base64_json_documents(spark, sf):
    encoded = "rtrim('=', base64(CAST(to_json(named_struct('t', text)) AS BINARY)))"
    docs = feed.table(spark, sf, "documents").selectExpr("doc_id", f"{encoded} AS b")
    parsed = docs.withColumn("t", F.expr(f"try_variant_get({text.base64_json('b')}, '$.t', 'string')"))
    return parsed.selectExpr("doc_id", "md5(t) AS text_md5", "CAST(length(t) AS BIGINT) AS n")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN (epoch_us(ts) // 1000) WHEN 1 THEN (epoch_us(ts) // 1000) END AS at,
       event_id % 4 IN (2, 3) AS bad
FROM events
""")
def timestamp_casts(spark, sf):
    raw = (
        "CASE event_id % 4 WHEN 0 THEN CAST(ms AS STRING) WHEN 1 THEN concat(' +', ms, ' ')"
        " WHEN 2 THEN concat(ms, '.5') ELSE concat('9', ms * 100) END"
    )
    events = feed.table(spark, sf, "events").selectExpr("event_id", "unix_millis(CAST(ts AS TIMESTAMP)) AS ms")
    typed = events.withColumn("t", F.expr(raw)).withColumn("v", F.expr(text.to_tstamp("t")))
    return typed.selectExpr("event_id", "unix_millis(v) AS at", "v IS NULL AS bad")


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN user_id WHEN 1 THEN 1000 + user_id % 10 END AS i,
       CASE WHEN event_id % 4 = 3 THEN NULL ELSE value END AS f, event_id % 2 = 1 AS b
FROM events
""")
def number_casts(spark, sf):
    i = "CASE event_id % 3 WHEN 0 THEN concat(' ', user_id) WHEN 1 THEN concat('1_00', user_id % 10) ELSE '1.0' END"
    f = "CASE event_id % 4 WHEN 3 THEN concat(value, 'd') ELSE CAST(value AS STRING) END"
    typed = feed.table(spark, sf, "events").withColumn("i0", F.expr(i)).withColumn("f0", F.expr(f))
    return typed.selectExpr(
        "event_id",
        f"{text.to_int('i0')} AS i",
        f"{text.to_float('f0')} AS f",
        f"{text.to_boolean('CAST(event_id % 2 AS STRING)')} AS b",
    )


@query("""
SELECT event_id, '10.0.' || user_id % 256 || '.1' AS first_ip, '10.0.' || user_id % 256 || '.x' AS redacted,
       event_id % 2 = 0 AS valid
FROM events
""")
def ip_functions(spark, sf):
    listed = "concat('[10.0.', user_id % 256, '.1], 192.168.0.1')"
    events = feed.table(spark, sf, "events").withColumn("ip", F.expr(net.first_ip(listed)))
    odd = "IF(event_id % 2 = 0, ip, concat(ip, '.999'))"
    return events.selectExpr(
        "event_id", "ip AS first_ip", f"{net.redact_ip('ip')} AS redacted", f"{net.is_ip(odd)} AS valid"
    )


@query(f"""
SELECT event_id, CASE event_type WHEN 'view' THEN 'iglu:{CONFIG.schema_vendor}/page_view/jsonschema/1-0-0'
       WHEN 'purchase' THEN 'iglu:{CONFIG.schema_vendor}/transaction/jsonschema/1-0-0'
       WHEN 'signup' THEN 'iglu:{CONFIG.schema_vendor}/structured_event/jsonschema/1-0-0'
       WHEN 'click' THEN 'iglu:{CONFIG.schema_vendor}/page_ping/jsonschema/1-0-0' END AS uri
FROM events
""")
def event_code_schemas(spark, sf):
    code = "CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'tr' WHEN 'signup' THEN 'se' WHEN 'click' THEN 'pp' ELSE 'zz' END"
    events = feed.table(spark, sf, "events").withColumn("code", F.expr(code))
    return events.selectExpr("event_id", f"{iglu.schema_for_code('code', CONFIG.schema_vendor)} AS uri")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'org.v' || user_id END AS vendor,
       CASE event_id % 4 WHEN 0 THEN event_type || 'Seen' END AS name,
       CASE event_id % 4 WHEN 0 THEN '1-0-' || user_id END AS version,
       CASE event_id % 4 WHEN 1 THEN 'Invalid schema - only supporting iglu schemas'
         WHEN 2 THEN 'Invalid schema path: org/' || event_type WHEN 3 THEN 'Invalid schema format: avro' END AS problem,
       CASE event_id % 4 WHEN 0 THEN 'context_org_v' || user_id || '_' || event_type || '_seen_1' END AS column_name
FROM events
""")
def schema_uris(spark, sf):
    uri = (
        "CASE event_id % 4 WHEN 0 THEN concat('iglu:org.v', user_id, '/', event_type, 'Seen/jsonschema/1-0-', user_id)"
        " WHEN 1 THEN concat('http://', event_type) WHEN 2 THEN concat('iglu:org/', event_type)"
        " ELSE concat('iglu:org.v/', event_type, '/avro/1-0-0') END"
    )
    events = feed.table(spark, sf, "events").withColumn("u", F.expr(uri)).withColumn("p", F.expr(iglu.uri_parts("u")))
    return events.selectExpr(
        "event_id",
        "p.vendor",
        "p.name",
        "p.version",
        f"{iglu.uri_problem('u')} AS problem",
        f"IF(p IS NULL, NULL, {iglu.context_column('u')}) AS column_name",
    )


# --- Extraction -------------------------------------------------------------------------------------

_EXPECTED_EVENTS = """
SELECT event_id, user_id, ts, value, event_type, 0 AS pos,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'link_click'
         WHEN 'purchase' THEN 'transaction' ELSE 'structured_event' END AS event_name
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, user_id, ts, value, event_type, n AS pos, 'transaction_item'
FROM events, (VALUES (1), (2), (3)) t(n) WHERE event_type = 'purchase' AND n <= 1 + event_id % 3
"""


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, event_name, 'ev-' || event_id || CASE WHEN pos > 0 THEN '-' || pos ELSE '' END AS eid FROM x
""")
def payload_events(spark, sf):
    return _atomic(spark, sf, with_position=True).selectExpr(
        f"{_NUMBER} AS event_id", "pos", "event_name", "event_id AS eid"
    )


@query("""
SELECT event_type, count(*) AS payloads, count(*) FILTER (event_type <> 'error') AS clean,
       coalesce(sum(CASE event_type WHEN 'purchase' THEN 2 + event_id % 3 WHEN 'error' THEN 0 ELSE 1 END), 0)::BIGINT AS events
FROM events GROUP BY event_type
""")
def all_or_nothing_payloads(spark, sf):
    kind = (
        "CASE WHEN path = '/i' THEN 'view' WHEN err IS NOT NULL THEN 'error' WHEN n > 1 THEN 'purchase'"
        " WHEN name = 'link_click' THEN 'click' ELSE 'signup' END"
    )
    rows = process_raw(_raw(spark, sf), CONFIG, feed_rules()).selectExpr(
        "path", "err", "size(items) AS n", "items[0].event_name AS name"
    )
    return (
        rows.selectExpr(f"{kind} AS event_type", "err IS NULL AS ok", "IF(err IS NULL, n, 0) AS n")
        .groupBy("event_type")
        .agg(F.count("*").alias("payloads"), F.expr("count_if(ok)").alias("clean"), F.expr("sum(n)").alias("events"))
    )


_ORACLE_URL = """'http://shop.example.org/p/' || event_id % 50 || CASE event_id % 4
  WHEN 0 THEN '?utm_source=news&utm_medium=email&utm_campaign=c' || user_id % 3
  WHEN 1 THEN '?fbclid=f' || event_id || '&gclid=g' || event_id
  WHEN 2 THEN '' ELSE '?utm_term=a%20b&fbclid=f' || event_id || '&utm_term=z' END"""


@query(f"""
SELECT event_id, 'web' AS platform, 'js-3' AS v_tracker, '{CONFIG.schema_vendor}' AS event_vendor,
       '10.' || user_id % 256 || '.' || event_id % 256 || '.x' AS user_ipaddress, 'n' || user_id AS network_userid,
       'h' || user_id % 5 || '.example.org' AS collector_host, event_id % 5 AS domain_sessionidx,
       {_ORACLE_URL} AS page_url, 'P ' || event_id % 50 AS page_title
FROM events WHERE event_type = 'view'
""")
def page_view_events(spark, sf):
    return _atomic(spark, sf, "page_view").selectExpr(
        f"{_NUMBER} AS event_id",
        "platform",
        "v_tracker",
        "event_vendor",
        "user_ipaddress",
        "network_userid",
        "collector_host",
        "domain_sessionidx",
        "get_json_object(event.data, '$.page_url') AS page_url",
        "get_json_object(event.data, '$.page_title') AS page_title",
    )


@query("""
SELECT event_id, 'account' AS category, 'signup' AS action, 'plan' || user_id % 4 AS label, value AS amount
FROM events WHERE event_type = 'signup'
""")
def structured_events(spark, sf):
    return _atomic(spark, sf, "structured_event").selectExpr(
        f"{_NUMBER} AS event_id", "category", "action", "label", "CAST(value AS DOUBLE) AS amount"
    )


@query("""
SELECT event_id, 'tr_cu,tr_id,tr_tt,txn_id' AS keys, event_id::VARCHAR AS txn_id, value AS total
FROM events WHERE event_type = 'purchase'
""")
def transaction_events(spark, sf):
    rows = _atomic(spark, sf, "transaction")
    return rows.selectExpr(
        f"{_NUMBER} AS event_id",
        "array_join(array_sort(json_object_keys(event.data)), ',') AS keys",
        "get_json_object(event.data, '$.txn_id') AS txn_id",
        "CAST(get_json_object(event.data, '$.tr_tt') AS DOUBLE) AS total",
    )


@query("""
SELECT o_orderkey AS order_id, o_totalprice AS total, count(l_orderkey) AS items,
       coalesce(sum(l_quantity::BIGINT), 0)::BIGINT AS quantity,
       coalesce(sum(l_extendedprice::DECIMAL(18,2)), 0)::DOUBLE AS price
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def order_payloads(spark, sf):
    """Every order as one payload with all of its lines, through the whole job."""
    raw = feed.raw_from_orders(feed.table(spark, sf, "orders"), feed.table(spark, sf, "lineitem"))
    field = "get_json_object(event.data, '$.{0}')".format
    rows = to_atomic(process_raw(raw, CONFIG, feed_rules()), CONFIG).selectExpr(
        f"CAST(coalesce({field('tr_id')}, {field('ti_id')}) AS BIGINT) AS order_id",
        f"CAST({field('tr_tt')} AS DOUBLE) AS total",
        f"CAST({field('ti_qu')} AS BIGINT) AS quantity",
        f"CAST({field('ti_pr')} AS DECIMAL(18,2)) AS price",
        "event_name",
    )
    return rows.groupBy("order_id").agg(
        F.max("total").alias("total"),
        F.expr("count_if(event_name = 'transaction_item')").alias("items"),
        F.expr("coalesce(sum(quantity), 0)").alias("quantity"),
        F.expr("CAST(coalesce(sum(price), 0) AS DOUBLE)").alias("price"),
    )


@query("""
SELECT event_id, 'com.snowplowanalytics.snowplow' AS event_vendor, '1-0-1' AS event_version,
       'http://t.example.org/' || user_id AS target, value
FROM events WHERE event_type = 'click'
""")
def self_describing_events(spark, sf):
    return _atomic(spark, sf, "link_click").selectExpr(
        f"{_NUMBER} AS event_id",
        "event_vendor",
        "event_version",
        "get_json_object(event.data, '$.targetUrl') AS target",
        "CAST(get_json_object(event.data, '$.value') AS DOUBLE) AS value",
    )


@query("""
SELECT event_id, 'w' || event_id % 11 AS page, 's' || user_id AS session_id, event_id % 9 AS session_idx,
       CASE WHEN user_id % 6 = 5 THEN 2 ELSE 3 END::BIGINT AS contexts
FROM events WHERE event_type = 'click'
""")
def tracker_contexts(spark, sf):
    return _atomic(spark, sf, "link_click").selectExpr(
        f"{_NUMBER} AS event_id",
        f"get_json_object({_context(feed.WEB_PAGE)}, '$.id') AS page",
        "session_id",
        "session_idx",
        "CAST(size(contexts) AS BIGINT) AS contexts",
    )


_ORACLE_CAMPAIGN = """CASE event_id % 4
  WHEN 0 THEN '{"campaign":"c' || user_id % 3 || '","medium":"email","source":"news"}'
  WHEN 1 THEN '{"click_id":"g' || event_id || '","network":"google"}'
  WHEN 3 THEN '{"click_id":"f' || event_id || '","network":"facebook","term":"a b"}' END"""


@query(f"SELECT event_id, {_ORACLE_CAMPAIGN} AS campaign FROM events WHERE event_type = 'view'")
def campaign_contexts(spark, sf):
    return _atomic(spark, sf, "page_view").selectExpr(f"{_NUMBER} AS event_id", f"{_context(CAMPAIGN)} AS campaign")


_ORACLE_DEVICE = """CASE WHEN user_id % 6 < 5 THEN '{"browser_family":' || CASE user_id % 6
    WHEN 0 THEN '"Chrome","browser_version":"120","device_family":"Other","os_family":"Windows","os_version":"10"'
    WHEN 1 THEN '"Mobile Safari","browser_version":"16","device_family":"iPhone","os_family":"iOS","os_version":"16"'
    WHEN 2 THEN '"Firefox","browser_version":"118","device_family":"Other","os_family":"Linux","os_version":null'
    WHEN 3 THEN '"Chrome Mobile","browser_version":"112","device_family":"Pixel 7","os_family":"Android","os_version":"13"'
    ELSE '"Python Requests","browser_version":"2","device_family":"Other","os_family":"Other","os_version":null' END
    || CASE WHEN event_type = 'view' THEN ',"screen_resolution":"1920x1080"}' ELSE '}' END
  WHEN event_type = 'view' THEN '{"screen_resolution":"1920x1080"}' END"""


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, {_ORACLE_DEVICE} AS device FROM x
""")
def device_contexts(spark, sf):
    return _atomic(spark, sf, with_position=True).selectExpr(f"{_NUMBER} AS event_id", "pos", f"{_context(DEVICE)} AS device")


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, (epoch_us(ts) // 1000) - CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN 1000
  WHEN event_type = 'view' AND event_id % 3 = 2 OR event_type = 'purchase' THEN 0 ELSE (event_id % 7) * 1000 END AS tstamp_ms,
  CASE WHEN event_type IN ('click', 'signup') OR (event_type = 'view' AND event_id % 3 = 1)
    THEN (epoch_us(ts) // 1000) - 5000 END AS created_ms
FROM x
""")
def best_timestamps(spark, sf):
    return _atomic(spark, sf, with_position=True).selectExpr(
        f"{_NUMBER} AS event_id", "pos", "unix_millis(tstamp) AS tstamp_ms", "unix_millis(dvce_created_tstamp) AS created_ms"
    )


_RANGES = """
SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
"""


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}), e AS (SELECT event_id, pos, user_id % 256 AS o2, event_id % 256 AS o3 FROM x),
     r AS ({_RANGES})
SELECT event_id, pos, n_name AS geo_country, r_name AS geo_region,
       n_name || CASE WHEN o2 % 10 = 0 OR (o2 % 10 = 1 AND o3 < 128) THEN '-lo' ELSE '-hi' END AS geo_city,
       '10.' || o2 || '.' || o3 || '.x' AS user_ipaddress
FROM e LEFT JOIN r ON n_nationkey = o2 // 10 AND o2 % 10 < 5
""")
def geo_events(spark, sf):
    config = PipelineConfig(geo_enabled=True)
    ranges = feed.geo_ranges(feed.table(spark, sf, "nation"), feed.table(spark, sf, "region"))
    dims = Dimensions(geo_ranges=ranges)
    processed = process_raw(_raw(spark, sf), config, feed_rules(), dims)
    return to_atomic(processed, config, dims, with_position=True).selectExpr(
        f"{_NUMBER} AS event_id", "pos", "geo_country", "geo_region", "geo_city", "user_ipaddress"
    )


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, '10.' || user_id % 256 || '.' || event_id % 256 || CASE WHEN user_id % 5 % 2 = 0 THEN '.7' ELSE '.x' END
  AS user_ipaddress
FROM x
""")
def host_config_redaction(spark, sf):
    dims = Dimensions(host_config=feed.host_config(feed.table(spark, sf, "region")))
    processed = process_raw(_raw(spark, sf), CONFIG, feed_rules(), dims)
    return to_atomic(processed, CONFIG, dims, with_position=True).selectExpr(f"{_NUMBER} AS event_id", "pos", "user_ipaddress")


# --- Validation and errors --------------------------------------------------------------------------


@query("""
SELECT event_id, event_id % 5 = 0 AS valid, CASE event_id % 5 WHEN 1 THEN 'action is required'
  WHEN 2 THEN 'label: text breaks maxLength' WHEN 3 THEN 'extra is not allowed'
  WHEN 4 THEN 'category: value is not of type string' END AS violation
FROM events
""")
def schema_violations(spark, sf):
    data = (
        "CASE event_id % 5 WHEN 0 THEN concat('{\"category\":\"', event_type, '\",\"action\":\"', user_id, '\",\"label\":null}')"
        " WHEN 1 THEN '{\"category\":\"c\"}'"
        " WHEN 2 THEN concat('{\"category\":\"c\",\"action\":\"a\",\"label\":\"', repeat('x', 501), '\"}')"
        " WHEN 3 THEN '{\"category\":\"c\",\"action\":\"a\",\"extra\":1}'"
        " ELSE concat('{\"category\":', event_id, ',\"action\":\"a\"}') END"
    )
    uri = lit(iglu.builtin_uri(CONFIG.schema_vendor, "structured_event"))
    events = feed.table(spark, sf, "events").selectExpr("event_id", f"parse_json({data}) AS d", f"{uri} AS u")
    checked = events.withColumn("violation", F.expr(feed_rules().violation("u", "d")))
    return checked.selectExpr("event_id", "violation IS NULL AS valid", "violation")


_KIND = """CASE WHEN event_id % 8 IN (0, 5, 6) THEN 'validation' WHEN event_id % 8 = 1 THEN 'not_found' ELSE 'value' END"""


@query(f"SELECT {_KIND} AS error_kind, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def errors_by_kind(spark, sf):
    errors = to_errors(process_raw(_raw(spark, sf), CONFIG, feed_rules()))
    return errors.groupBy("error_kind").agg(F.count("*").alias("n"))


@query(f"""
SELECT 'h' || user_id % 5 || '.example.org' AS collector_domain, 'n' || user_id AS network_userid, (epoch_us(ts) // 1000) AS ms,
  CASE event_id % 8
    WHEN 0 THEN 'data validation error: Failed to validate {PAGE_VIEW}: page_url is required'
    WHEN 1 THEN 'schema not found: Schema not found in any registry: {feed.UNKNOWN}'
    WHEN 2 THEN 'invalid event data: body is not valid JSON'
    WHEN 3 THEN 'invalid event data: Context {feed.WEB_PAGE} already exists'
    WHEN 4 THEN 'invalid event data: a number or timestamp is malformed'
    WHEN 5 THEN 'data validation error: Failed to validate iglu:{CONFIG.schema_vendor}/structured_event/jsonschema/1-0-0: action is required'
    WHEN 6 THEN 'data validation error: Failed to validate {feed.PAYLOAD}: tv is required'
    ELSE 'invalid event data: Invalid event type: zz' END AS reason
FROM events WHERE event_type = 'error'
""")
def dead_letters(spark, sf):
    errors = to_errors(process_raw(_raw(spark, sf), CONFIG, feed_rules()))
    return errors.withColumn("p", F.col("payload").cast("string")).selectExpr(
        "collector_domain",
        "get_json_object(p, '$.networkUserId') AS network_userid",
        "CAST(get_json_object(p, '$.timestamp') AS BIGINT) AS ms",
        "reason",
    )


@query("""
SELECT count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS error FROM events
""")
def processing_outcomes(spark, sf):
    return outcome_counts(process_raw(_raw(spark, sf), CONFIG, feed_rules()))


# --- Shredding and SQL over events ------------------------------------------------------------------


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, '{{}}' AS event, CASE WHEN event_type = 'click' THEN 'w' || event_id % 11 END AS web_page, NULL::VARCHAR AS session
FROM x
""")
def shred_selected_schemas(spark, sf):
    web, session = iglu.context_column_name(feed.WEB_PAGE), iglu.context_column_name(feed.SESSION)
    flat = flatten_atomic(
        _atomic(spark, sf),
        schema_names=["com.snowplowanalytics.snowplow/web_page", f"{feed.SESSION.rsplit('/', 1)[0]}/2"],
        columns=[web, session],
    )
    return flat.selectExpr(
        f"{_NUMBER} AS event_id", _POS, "event", f"get_json_object({web}, '$.id') AS web_page", f"{session} AS session"
    )


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_id, pos, CASE WHEN event_type = 'click' THEN 'http://t.example.org/' || user_id END AS target,
       CASE user_id % 6 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Mobile Safari' WHEN 2 THEN 'Firefox'
         WHEN 3 THEN 'Chrome Mobile' WHEN 4 THEN 'Python Requests' END AS browser,
       CASE WHEN event_type = 'click' THEN '{{"sessionId":"s' || user_id || '","sessionIndex":' || event_id % 9 || '}}' END AS session,
       CASE WHEN event_type = 'click' THEN '{{"id":"w' || event_id % 11 || '"}}' END AS web_page,
       CASE WHEN event_type = 'view' THEN {_ORACLE_CAMPAIGN} END AS campaign, {_ORACLE_DEVICE} AS device, NULL::VARCHAR AS shred_error
FROM x
""")
def shred_all_schemas(spark, sf):
    """Every context schema as a column, the columns being looked up in the data."""
    flat = flatten_atomic(
        staged(_atomic(spark, sf), "events"),  # read twice
        all_schemas=True,
        event_fields=[FieldTransformation("targetUrl", "target")],
        context_fields=[FieldTransformation("browser_family", "browser")],
    )
    names = {"session": feed.SESSION, "web_page": feed.WEB_PAGE, "campaign": CAMPAIGN, "device": DEVICE}
    columns = [f"{iglu.context_column_name(uri)} AS {name}" for name, uri in names.items()]
    return flat.selectExpr(f"{_NUMBER} AS event_id", _POS, "target", "browser", *columns, "shred_error")


@query("""
SELECT 's' || user_id AS session_id, count(*) AS n, sum(event_id % 9)::BIGINT AS visits
FROM events WHERE event_type = 'click' GROUP BY 1
""")
def typed_session_contexts(spark, sf):
    column = iglu.context_column_name(feed.SESSION)
    flat = flatten_atomic(_atomic(spark, sf, "link_click"), schema_names=["com.snowplowanalytics.snowplow/client_session"], columns=[column])
    typed = flat.select(typed_data(column, feed.FEED_DOCUMENTS[feed.SESSION]).alias("s"))
    return typed.groupBy(F.col("s.sessionId").alias("session_id")).agg(
        F.count("*").alias("n"), F.sum("s.sessionIndex").alias("visits")
    )


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, count(DISTINCT user_id) AS users,
       coalesce(sum(CASE event_name WHEN 'transaction' THEN value::DECIMAL(18,2) END), 0)::DOUBLE AS revenue
FROM x GROUP BY event_name
""")
def sql_over_events(spark, sf):
    register_atomic(_atomic(spark, sf), "atomic_events")
    return spark.sql(
        "SELECT event_name, count(*) AS n, count(DISTINCT network_userid) AS users,"
        " CAST(coalesce(sum(CAST(get_json_object(event.data, '$.tr_tt') AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue"
        " FROM atomic_events GROUP BY event_name"
    )


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT ts::DATE AS day, event_name, count(*) AS n FROM x GROUP BY 1, 2
""")
def events_per_day(spark, sf):
    atomic = _atomic(spark, sf)
    return atomic.groupBy(F.expr("to_date(collector_tstamp)").alias("day"), "event_name").agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey),
     x AS (""" + _EXPECTED_EVENTS + """), e AS (SELECT user_id % 256 AS o2 FROM x)
SELECT r_name AS geo_region, n_name AS geo_country, count(*) AS n, grouping(r_name) + grouping(n_name) AS level
FROM e LEFT JOIN r ON n_nationkey = o2 // 10 AND o2 % 10 < 5 GROUP BY ROLLUP (r_name, n_name)
""")
def rollup_by_country(spark, sf):
    config = PipelineConfig(geo_enabled=True)
    dims = Dimensions(geo_ranges=feed.geo_ranges(feed.table(spark, sf, "nation"), feed.table(spark, sf, "region")))
    processed = process_raw(_raw(spark, sf), config, feed_rules(), dims)
    rolled = to_atomic(processed, config, dims).rollup("geo_region", "geo_country")
    return rolled.agg(
        F.count("*").alias("n"),
        (F.grouping("geo_region").cast("bigint") + F.grouping("geo_country").cast("bigint")).alias("level"),
    )


@query(f"""
SELECT {_ORACLE_URL} AS page_url, count(*) AS n FROM events WHERE event_type = 'view'
GROUP BY 1 ORDER BY n DESC, page_url LIMIT 10
""")
def top_pages(spark, sf):
    pages = _atomic(spark, sf, "page_view").selectExpr("get_json_object(event.data, '$.page_url') AS page_url")
    return pages.groupBy("page_url").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "page_url").limit(10)


@query(f"""
WITH x AS ({_EXPECTED_EVENTS}), c AS (SELECT 'h' || user_id % 5 || '.example.org' AS host, 'n' || user_id AS usr, count(*) AS n
           FROM x GROUP BY 1, 2)
SELECT host, usr, n, rank() OVER (PARTITION BY host ORDER BY n DESC) AS rnk FROM c
""")
def user_rank_per_host(spark, sf):
    """Users of a host by their events.

    A user's rank is one more than the users of the host with more events, so it follows from how many users have each
    count. Those sums are what the window sorts, not the users, and a host with very many users is no large group.
    """
    atomic = _atomic(spark, sf)
    counted = atomic.groupBy(F.col("collector_host").alias("host"), F.col("network_userid").alias("usr")).agg(
        F.count("*").alias("n")
    )
    users = counted.groupBy("host", "n").agg(F.count("*").alias("users"))
    above = Window.partitionBy("host").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = users.select("host", "n", (F.coalesce(F.sum("users").over(above), F.lit(0)) + 1).alias("rnk"))
    return counted.join(ranks, ["host", "n"]).select("host", "usr", "n", "rnk")


@query("""
WITH x AS (""" + _EXPECTED_EVENTS + """), g AS (SELECT user_id, (epoch_us(ts) // 1000) AS ms,
             lag((epoch_us(ts) // 1000)) OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS prev
           FROM x)
SELECT 'n' || user_id AS usr, count(*) FILTER (prev IS NULL OR ms - prev > 1800000) AS sessions, count(*) AS views
FROM g GROUP BY 1
""")
def sessions_by_gap(spark, sf):
    views = _atomic(spark, sf).selectExpr(
        "network_userid AS usr", "unix_millis(collector_tstamp) AS ms", f"{_NUMBER} AS id"
    )
    gaps = with_last(ordered(views, "usr", "ms", ["id"], CONFIG), "ms", "prev", inclusive=False)
    return gaps.groupBy("usr").agg(
        F.expr("count_if(prev IS NULL OR ms - prev > 1800000)").alias("sessions"), F.count("*").alias("views")
    )


@query("""
SELECT DISTINCT 'n' || user_id AS usr, ts::DATE AS day FROM events WHERE event_type = 'purchase'
EXCEPT SELECT 'n' || user_id, ts::DATE FROM events WHERE event_type = 'click'
""")
def buyers_without_clicks(spark, sf):
    """Buyers and the days on which they bought and did not click."""
    atomic = staged(_atomic(spark, sf).selectExpr("event_name", "network_userid AS usr", "to_date(collector_tstamp) AS day"), "events")  # read twice
    buyers = atomic.where("event_name = 'transaction'").select("usr", "day")
    clickers = atomic.where("event_name = 'link_click'").select("usr", "day")
    return buyers.distinct().join(clickers, ["usr", "day"], "left_anti")


# --- Requests, codecs, streams ----------------------------------------------------------------------


@query("""
SELECT event_id, event_type = 'error' AS anonymous,
       CASE WHEN event_type = 'error' THEN '00000000-0000-0000-0000-000000000000'
            WHEN event_type = 'view' THEN 'q' || user_id ELSE 'c' || user_id END AS user_id,
       CASE WHEN event_type = 'error' THEN 'Host,sp-anonymous,User-Agent' ELSE 'Cookie,Host,User-Agent' END AS headers,
       'agent/' || user_id AS user_agent, NULL::VARCHAR AS querystring_blank
FROM events
""")
def requests_to_payloads(spark, sf):
    headers = (
        "concat(array('Remote-Address: 10.0.0.1', 'Timeout-Access: x', 'Host: a', concat('User-Agent: agent/', user_id),"
        " concat('Cookie: z=1; sp=c', user_id)), IF(event_type = 'error', array('sp-anonymous: *'), array()))"
    )
    requests = feed.table(spark, sf, "events").selectExpr(
        "concat('10.0.0.', event_id % 256) AS client_ip",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS received_ms",
        "'/i' AS path",
        "IF(event_type = 'view', concat('e=pv&nuid=q', user_id), '') AS querystring",
        "concat('e', event_id) AS hostname",
        f"{headers} AS headers",
        "CAST('' AS BINARY) AS body",
    )
    raw = requests_to_raw(requests, CONFIG)
    names = "array_join(array_sort(transform(headers, h -> split(h, ':')[0]), (a, b) -> IF(lower(a) < lower(b), -1, 1)), ',')"
    return raw.selectExpr(
        "CAST(substring(hostname, 2) AS BIGINT) AS event_id",
        "exists(headers, h -> startswith(h, 'sp-anonymous')) AS anonymous",
        "networkUserId AS user_id",
        f"{names} AS headers",
        "userAgent AS user_agent",
        "IF(querystring = '', querystring, NULL) AS querystring_blank",
    )


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'pixel' WHEN 1 THEN 'tracker' WHEN 2 THEN 'iglu' WHEN 3 THEN 'redirect' END AS endpoint,
       CASE event_id % 5 WHEN 1 THEN 'org.v' || user_id WHEN 2 THEN 'org.v' || user_id END AS vendor,
       CASE event_id % 5 WHEN 3 THEN 'https://x.org/' || user_id END AS target
FROM events
""")
def collector_routes(spark, sf):
    path = (
        "CASE event_id % 5 WHEN 0 THEN '/i' WHEN 1 THEN concat('/org.v', user_id, '/tp2')"
        " WHEN 2 THEN concat('/org.v', user_id, '/v1') WHEN 3 THEN '/r/tp2' ELSE '/nowhere' END"
    )
    qs = "CASE event_id % 5 WHEN 3 THEN concat('u=', url_encode(concat('https://x.org/', user_id))) ELSE 'u=no-scheme' END"
    events = feed.table(spark, sf, "events").selectExpr("event_id", f"{path} AS path", f"{qs} AS qs")
    routed = events.withColumn("r", F.expr(net.route("path")))
    return routed.selectExpr("event_id", "r.endpoint", "r.vendor", f"{net.redirect_target('qs')} AS target")


@query(f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
     sized AS (SELECT doc_id, count(*) AS n, max(strlen(to_json(line)::VARCHAR)) + 58 + length(doc_id::VARCHAR)
                 + strlen('{{"schema":"{feed.PAYLOAD}","data":[]}}') <= 20000 AS fits
               FROM lines GROUP BY doc_id)
SELECT doc_id, CASE WHEN fits THEN n ELSE 0 END AS items, fits FROM sized
""")
def payload_size_split(spark, sf):
    """Documents as payloads with one item per line, split at 20 kB; a longer line is an error."""
    config = PipelineConfig(max_record_bytes=20_000)
    docs = feed.spread(feed.table(spark, sf, "documents"))
    body = f"to_json(named_struct('schema', {lit(feed.PAYLOAD)}, 'data', split(text, '\\n')))"
    raw = docs.selectExpr(
        "'CollectorPayload' AS schema",
        "'10.0.0.1' AS ipAddress",
        "1700000000000 AS timestamp",
        "'UTF-8' AS encoding",
        "'c' AS collector",
        "CAST(NULL AS STRING) AS userAgent",
        "CAST(NULL AS STRING) AS refererUri",
        "'/tp2' AS path",
        "CAST(NULL AS STRING) AS querystring",
        f"CAST({body} AS BINARY) AS body",
        "CAST(array() AS ARRAY<STRING>) AS headers",
        "CAST(NULL AS STRING) AS contentType",
        "'h' AS hostname",
        "CAST(doc_id AS STRING) AS networkUserId",
    )
    sized = sized_payloads(raw, config).selectExpr(
        "CAST(networkUserId AS BIGINT) AS doc_id",
        "IF(err IS NULL, size(try_cast(variant_get(parse_json(CAST(body AS STRING)), '$.data') AS ARRAY<VARIANT>)), 0) AS n",
        f"err IS NULL AND octet_length({codecs.raw_avro()}) <= {config.max_record_bytes} AS fits",
    )
    return sized.groupBy("doc_id").agg(F.sum("n").alias("items"), F.expr("every(fits)").alias("fits"))


_ROUND_TRIP = """
SELECT 'h' || user_id % 5 || '.example.org' AS hostname, count(*) AS n,
       count(*) FILTER (event_type IN ('click', 'purchase', 'signup') OR (event_type = 'error' AND event_id % 8 IN (1, 2, 3, 5, 6))) AS bodies,
       0::BIGINT AS changed
FROM events GROUP BY 1
"""


def _round_trip(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    raw = _raw(spark, sf)
    names = {"avro": codecs.AVRO_NAME, "thrift": codecs.THRIFT_NAME}
    before = raw.withColumn("schema", F.lit(names[fmt]))
    decoded = codecs.decode_messages(
        before.select(F.expr(codecs.RAW_ENCODERS[fmt]()).alias("value")), fmt
    )
    # Encoding what was decoded must give the same bytes.
    again = decoded.select("value", "err", "record.*")
    return (
        again.withColumn("again", F.expr(codecs.RAW_ENCODERS[fmt]()))
        .groupBy("hostname")
        .agg(
            F.count("*").alias("n"),
            F.count("body").alias("bodies"),
            F.expr("count_if(err IS NOT NULL OR again <> value)").alias("changed"),
        )
    )


@query(_ROUND_TRIP)
def avro_round_trip(spark, sf):
    return _round_trip(spark, sf, "avro")


@query(_ROUND_TRIP)
def thrift_round_trip(spark, sf):
    return _round_trip(spark, sf, "thrift")


_EVENT_COUNTS = f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, 0::BIGINT AS changed FROM x GROUP BY 1
"""


def _atomic_round_trip(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    value = {"json": f"CAST({codecs.atomic_json()} AS BINARY)", "avro": codecs.atomic_avro()}[fmt]
    decoded = codecs.decode_atomic(codecs.encode_atomic(_atomic(spark, sf), fmt), fmt)
    return (
        decoded.withColumn("again", F.expr(value))
        .groupBy("event_name")
        .agg(F.count("*").alias("n"), F.expr("count_if(err IS NOT NULL OR again <> message)").alias("changed"))
    )


@query(_EVENT_COUNTS)
def event_json_round_trip(spark, sf):
    return _atomic_round_trip(spark, sf, "json")


@query(_EVENT_COUNTS)
def event_avro_round_trip(spark, sf):
    return _atomic_round_trip(spark, sf, "avro")


@query(f"""
SELECT 'h' || user_id % 5 || '.example.org' AS collector_domain, count(*) AS n, 0::BIGINT AS unreadable
FROM events WHERE event_type = 'error' GROUP BY 1
""")
def error_json_round_trip(spark, sf):
    errors = to_errors(process_raw(_raw(spark, sf), CONFIG, feed_rules()))
    decoded = codecs.decode_errors(codecs.encode_errors(errors))
    return decoded.groupBy("collector_domain").agg(
        F.count("*").alias("n"), F.expr("count_if(raw IS NOT NULL OR tstamp IS NULL)").alias("unreadable")
    )


@query(f"""
WITH x AS ({_EXPECTED_EVENTS})
SELECT event_name, count(*) AS n, count(DISTINCT event_id) AS payloads FROM x GROUP BY 1
UNION ALL SELECT {_KIND}, count(*), count(*) FROM events WHERE event_type = 'error' GROUP BY 1
UNION ALL SELECT 'undecodable', count(*), count(*) FROM events WHERE event_id % 10 = 9
""")
def stream_enrichment(spark, sf):
    """Encoded payloads as a stream: events, errors and undecodable messages written per micro-batch."""
    schema = feed.table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    many = feed.table(spark, sf, "events").count()
    rows = rows.repartition(feed.tasks_of(many, spark.sparkContext.defaultParallelism))
    # Every tenth message is followed by a copy that was cut short.
    cut = "IF(event_id % 10 = 9, array(false, true), array(false))"
    rows = rows.withColumn("cut", F.explode(F.expr(cut))).withColumn("ts", F.expr("IF(cut, NULL, ts)"))
    raw = feed.raw_from_events(rows).withColumn("whole", F.expr("timestamp IS NOT NULL"))
    messages = raw.withColumn("timestamp", F.expr("coalesce(timestamp, 0)")).withColumn(
        "value", F.expr(f"IF(whole, {codecs.raw_avro()}, unhex('20'))")
    )
    out = scratch_dir(spark)
    stream = enrich_stream(
        messages.select("value"),
        CONFIG,
        feed_rules,
        parquet_batch_writer(f"{out}/events"),
        parquet_batch_writer(f"{out}/errors"),
        f"{out}/checkpoint",
    )
    stream.awaitTermination()
    events = spark.read.parquet(f"{out}/events").selectExpr("event_name", f"{_NUMBER} AS id")
    errors = spark.read.parquet(f"{out}/errors").selectExpr("error_kind AS event_name")
    by_name = events.groupBy("event_name").agg(F.count("*").alias("n"), F.countDistinct("id").alias("payloads"))
    by_kind = errors.groupBy("event_name").agg(F.count("*").alias("n"), F.count("*").alias("payloads"))
    return by_name.unionByName(by_kind)
