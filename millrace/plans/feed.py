"""Raw tracker payloads derived from the analytics tables, to drive the jobs at any scale.

Every row of ``events`` becomes one request, chosen by its type: a view is a GET with a query string, a
click a POST with a self-describing event and contexts, a purchase a POST with a transaction and its items,
a signup a POST with a structured event, and an error one of eight broken requests. Every row of ``orders``
becomes one POST holding the transaction and one item per order line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.sqltext import lit
from millrace.model import RAW_COLUMNS

TRACKER = "iglu:com.snowplowanalytics.snowplow"
LINK_CLICK = f"{TRACKER}/link_click/jsonschema/1-0-1"
WEB_PAGE = f"{TRACKER}/web_page/jsonschema/1-0-0"
SESSION = f"{TRACKER}/client_session/jsonschema/1-0-1"
PAYLOAD = f"{TRACKER}/payload_data/jsonschema/1-0-4"
CONTEXTS = f"{TRACKER}/contexts/jsonschema/1-0-1"
UNSTRUCT = f"{TRACKER}/unstruct_event/jsonschema/1-0-0"
UNKNOWN = "iglu:org.example/unheard_of/jsonschema/1-0-0"

_META = "https://json-schema.org/draft/2020-12/schema"
_STR = {"type": "string"}

# Schemas the feed uses that are not built in.
FEED_DOCUMENTS = {
    LINK_CLICK: {
        "$schema": _META,
        "type": "object",
        "properties": {"targetUrl": {"type": "string", "minLength": 1}, "elementId": _STR, "value": {"type": "number"}},
        "required": ["targetUrl"],
        "additionalProperties": False,
    },
    WEB_PAGE: {
        "$schema": _META,
        "type": "object",
        "properties": {"id": _STR},
        "required": ["id"],
        "additionalProperties": False,
    },
    SESSION: {
        "$schema": _META,
        "type": "object",
        "properties": {"sessionId": _STR, "sessionIndex": {"type": "integer", "minimum": 0}, "userId": _STR},
        "required": ["sessionId", "sessionIndex"],
        "additionalProperties": False,
    },
}

USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.5 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/118.0",
    "Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/112.0.0.0 Mobile Safari/537.36",
    "python-requests/2.31.0",
    "unknown-agent",
]

# Page query strings by event_id % 4, before encoding.
_PAGE_QUERY = (
    "CASE event_id % 4 WHEN 0 THEN concat('?utm_source=news&utm_medium=email&utm_campaign=c', user_id % 3)"
    " WHEN 1 THEN concat('?fbclid=f', event_id, '&gclid=g', event_id)"
    " WHEN 2 THEN '' ELSE concat('?utm_term=a%20b&fbclid=f', event_id, '&utm_term=z') END"
)
PAGE_URL = f"concat('http://shop.example.org/p/', event_id % 50, {_PAGE_QUERY})"


def _pairs(fields: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{lit(k)}, CAST({v} AS STRING)" for k, v in fields.items()) + ")"


def _self_describing(uri: str, data: str) -> str:
    return f"named_struct('schema', {lit(uri)}, 'data', {data})"


def _payload(items: str) -> str:
    return f"to_json(named_struct('schema', {lit(PAYLOAD)}, 'data', {items}))"


def _base64(json: str) -> str:
    return f"rtrim('=', base64(CAST({json} AS BINARY)))"


# Fields common to every item: tracker, platform, id, device times and visit count.
_COMMON = {"tv": "'js-3'", "p": "'web'", "eid": "concat('ev-', event_id)"}
_TIMES = {"dtm": "ms - 5000", "stm": "ms - 5000 + (event_id % 7) * 1000"}

_LINK = "named_struct('targetUrl', concat('http://t.example.org/', user_id), 'value', value)"
_CLICK = f"to_json({_self_describing(UNSTRUCT, _self_describing(LINK_CLICK, _LINK))})"
_CLICK_CONTEXTS = "to_json(" + _self_describing(
    CONTEXTS,
    "array("
    + f"named_struct('schema', {lit(WEB_PAGE)}, 'data', map('id', CAST(event_id % 11 AS STRING)))))",
)
# Two context types in one list need one JSON type, so the list is written as text.
_SESSION_CONTEXTS = (
    f"concat('{{\"schema\":\"{CONTEXTS}\",\"data\":[{{\"schema\":\"{SESSION}\",\"data\":{{\"sessionId\":\"s', user_id,"
    f" '\",\"sessionIndex\":', event_id % 9, '}}}},{{\"schema\":\"{WEB_PAGE}\",\"data\":{{\"id\":\"w', event_id % 11, '\"}}}}]}}')"
)
_TWICE = (
    f"concat('{{\"schema\":\"{CONTEXTS}\",\"data\":[{{\"schema\":\"{WEB_PAGE}\",\"data\":{{\"id\":\"1\"}}}},"
    f"{{\"schema\":\"{WEB_PAGE}\",\"data\":{{\"id\":\"2\"}}}}]}}')"
)

_VIEW = (
    "concat('e=pv&p=web&tv=js-3&eid=ev-', event_id, '&vid=', event_id % 5,"
    " CASE WHEN event_id % 3 = 0 THEN concat('&ttm=', ms - 1000)"
    " WHEN event_id % 3 = 1 THEN concat('&dtm=', ms - 5000, '&stm=', ms - 5000 + (event_id % 7) * 1000) ELSE '' END,"
    f" '&res=1920x1080&page=P+', event_id % 50, '&url=', url_encode({PAGE_URL}))"
)
_CLICK_BODY = _payload(
    "array(map_concat("
    + _pairs(_COMMON | _TIMES | {"e": "'ue'"})
    + f", CASE WHEN event_id % 2 = 0 THEN map('ue_px', {_base64(_CLICK)}, 'cx', {_base64(_SESSION_CONTEXTS)})"
    f" ELSE map('ue_pr', {_CLICK}, 'co', {_SESSION_CONTEXTS}) END))"
)
_TRANSACTION = _pairs(
    _COMMON | {"e": "'tr'", "tr_id": "concat('o', event_id)", "tr_tt": "value", "tr_cu": "'EUR'", "tid": "event_id"}
)
_ITEM = _pairs(
    {
        "tv": "'js-3'",
        "p": "'web'",
        "e": "'ti'",
        "eid": "concat('ev-', event_id, '-', n)",
        "ti_id": "concat('o', event_id)",
        "ti_sk": "concat('sku', event_id % 13)",
        "ti_pr": "value",
        "ti_qu": "n",
    }
)
_PURCHASE_BODY = _payload(
    f"concat(array({_TRANSACTION}), transform(sequence(1, CAST(1 + event_id % 3 AS INT)), n -> {_ITEM}))"
)
_SIGNUP_BODY = _payload(
    "array("
    + _pairs(
        _COMMON
        | _TIMES
        | {"e": "'se'", "se_ca": "'account'", "se_ac": "'signup'", "se_la": "concat('plan', user_id % 4)", "se_va": "value"}
    )
    + ")"
)

# Broken requests by event_id % 8: query string and body.
_BAD_QUERY = (
    "CASE event_id % 8 WHEN 0 THEN concat('e=pv&p=web&eid=ev-', event_id)"
    " WHEN 4 THEN concat('e=pv&p=web&url=u&vid=v', event_id) WHEN 7 THEN concat('e=zz&eid=ev-', event_id) END"
)
_GOOD_EVENT = _pairs(_COMMON | {"e": "'se'", "se_ca": "'a'", "se_ac": "'b'"})
_BAD_BODY = (
    "CASE event_id % 8 WHEN 1 THEN "
    + _payload(
        "array("
        + _pairs(
            _COMMON
            | {"e": "'ue'", "ue_pr": f"to_json({_self_describing(UNSTRUCT, _self_describing(UNKNOWN, _LINK))})"}
        )
        + ")"
    )
    + " WHEN 2 THEN concat('{\"schema\": ', event_id)"
    + " WHEN 3 THEN "
    + _payload("array(" + _pairs(_COMMON | {"e": "'pv'", "url": "'u'", "co": _TWICE}) + ")")
    + " WHEN 5 THEN "
    + _payload(f"array({_GOOD_EVENT}, " + _pairs(_COMMON | {"e": "'se'", "se_ca": "'a'"}) + ")")
    + " WHEN 6 THEN "
    + _payload(f"array({_GOOD_EVENT}, " + _pairs({"e": "'se'", "p": "'web'"}) + ")")
    + " END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that one task takes from a table, about: a payload goes through the whole job at some thousands a second and core.
TASK_ROWS = 50_000


def tasks_of(rows: int, cores: int) -> int:
    return max(cores, -(-rows // TASK_ROWS))


def spread(df: DataFrame, least: int = 1) -> DataFrame:
    """Use every core, and ``least`` tasks, where a table's splits leave some without rows, or one with very many.

    A file is cut by its bytes, but a split holds whole row groups: however many splits a file has, few of them may hold all rows.
    So the rows of each split are counted (from the files' footers). Tables with enough splits of a fair size are left alone.
    """
    cores = max(df.sparkSession.sparkContext.defaultParallelism, least)
    split = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    splits, rows, most = split.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return df if splits >= cores and most <= 2 * TASK_ROWS else df.repartition(tasks_of(rows, cores))


def user_agent_of(user: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {lit(ua)}" for i, ua in enumerate(USER_AGENTS))
    return f"CASE {user} % {len(USER_AGENTS)} {whens} END"


def raw_from_events(events: DataFrame) -> DataFrame:
    """One raw payload per row of ``events``."""
    query = f"CASE event_type WHEN 'view' THEN {_VIEW} WHEN 'error' THEN {_BAD_QUERY} END"
    body = (
        f"CASE event_type WHEN 'click' THEN {_CLICK_BODY} WHEN 'purchase' THEN {_PURCHASE_BODY}"
        f" WHEN 'signup' THEN {_SIGNUP_BODY} WHEN 'error' THEN {_BAD_BODY} END"
    )
    return (
        events.withColumn("ms", F.expr("unix_millis(CAST(ts AS TIMESTAMP))"))
        .selectExpr(
            "'CollectorPayload' AS schema",
            "concat('10.', user_id % 256, '.', event_id % 256, '.7') AS ipAddress",
            "ms AS timestamp",
            "'UTF-8' AS encoding",
            "'feed-1' AS collector",
            f"{user_agent_of('user_id')} AS userAgent",
            "'http://ref.example.org/' AS refererUri",
            "CASE WHEN event_type = 'view' THEN '/i' ELSE '/com.snowplowanalytics.snowplow/tp2' END AS path",
            f"{query} AS querystring",
            f"CAST({body} AS BINARY) AS body",
            "array('Accept: */*', concat('Host: h', user_id % 5, '.example.org')) AS headers",
            "CASE WHEN event_type <> 'view' THEN 'application/json' END AS contentType",
            "concat('h', user_id % 5, '.example.org') AS hostname",
            "concat('n', user_id) AS networkUserId",
        )
        .select(*RAW_COLUMNS)
    )


def raw_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One raw payload per order: its transaction and one transaction item per line."""
    item = _pairs(
        {
            "tv": "'shop-1'",
            "p": "'srv'",
            "e": "'ti'",
            "ti_id": "l_orderkey",
            "ti_sk": "l_partkey",
            "ti_pr": "l_extendedprice",
            "ti_qu": "CAST(l_quantity AS BIGINT)",
        }
    )
    lines = (
        lineitem.select("l_orderkey", "l_linenumber", F.expr(item).alias("item"))
        .groupBy("l_orderkey")
        .agg(F.expr("transform(array_sort(collect_list(struct(l_linenumber, to_json(item) AS item))), l -> l.item)").alias("items"))
    )
    head = _pairs(
        {
            "tv": "'shop-1'",
            "p": "'srv'",
            "e": "'tr'",
            "eid": "concat('o-', o_orderkey)",
            "uid": "concat('c', o_custkey)",
            "tr_id": "o_orderkey",
            "tr_tt": "o_totalprice",
        }
    )
    body = (
        f"concat('{{\"schema\":\"{PAYLOAD}\",\"data\":[', array_join(concat(array(to_json({head})),"
        " coalesce(items, array())), ','), ']}')"
    )
    # never broadcast: the lines grow with the orders, and what follows needs the shuffle's partitions
    return orders.join(lines.hint("shuffle_merge"), F.expr("o_orderkey = l_orderkey"), "left").selectExpr(
        "'CollectorPayload' AS schema",
        "concat('192.168.', o_custkey % 200, '.1') AS ipAddress",
        "unix_millis(CAST(o_orderdate AS TIMESTAMP)) AS timestamp",
        "'UTF-8' AS encoding",
        "'shop-1' AS collector",
        "CAST(NULL AS STRING) AS userAgent",
        "CAST(NULL AS STRING) AS refererUri",
        "'/com.snowplowanalytics.snowplow/tp2' AS path",
        "CAST(NULL AS STRING) AS querystring",
        f"CAST({body} AS BINARY) AS body",
        "CAST(array() AS ARRAY<STRING>) AS headers",
        "'application/json' AS contentType",
        "'shop.example.org' AS hostname",
        "CAST(NULL AS STRING) AS networkUserId",
    )


def geo_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Two address ranges per nation: 10.(10n).0.0 up to 10.(10n+4).255.255, split at 10.(10n+1).128.0."""
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "stack(2,"
        " concat('10.', n_nationkey * 10, '.0.0'), concat('10.', n_nationkey * 10 + 1, '.127.255'), n_name, r_name,"
        " concat(n_name, '-lo'),"
        " concat('10.', n_nationkey * 10 + 1, '.128.0'), concat('10.', n_nationkey * 10 + 4, '.255.255'), n_name,"
        " r_name, concat(n_name, '-hi')) AS (start_ip, end_ip, country, region, city)"
    )


def host_config(region: DataFrame) -> DataFrame:
    """Hosts h0 to h4; the even ones keep whole addresses."""
    return region.selectExpr(
        "concat('h', r_regionkey, '.example.org') AS hostname",
        "r_regionkey % 2 = 0 AS enable_full_ip",
        "false AS enable_cookies",
    )
