"""From raw payloads to candidate events.

A payload may hold many events and fails as a whole when one of them fails. Its events therefore stay an
array on the payload row until the verdict is known, so the step needs no shuffle and runs unchanged on a
stream. Each step below adds fields to the array's structs; ``explode`` comes last, on clean payloads only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.functions import iglu, net, text
from millrace.functions.sqltext import first_not_null, if_chain, let, lit
from millrace.operators.errors import ERROR_TYPE, NO_ERROR, error, uri_error, value_error, violation_error
from millrace.operators.mappings import (
    BASE_FIELDS,
    CAMPAIGN_PARAMS,
    CLICK_IDS,
    EVENT_FIELDS,
    FALLIBLE,
    bad_cast,
    cast,
)
from millrace.operators.schemas import open_document, violations
from millrace.sources.registry import PAYLOAD_PREFIX, Rules

EMPTY_MAP = "CAST(map() AS MAP<STRING, STRING>)"
NO_VARIANT = "CAST(NULL AS VARIANT)"
# Numbers and times cast once and carried along.
NUMBERS = ["created_ms", "sent_ms", "true_tstamp", "visit"]


# --- Payload level ----------------------------------------------------------------------------------


def seed_map() -> str:
    """``ip``, ``ua`` and ``nuid`` of the request, empty values left out."""
    return (
        "map_filter(map('ip', ipAddress, 'ua', userAgent, 'nuid', networkUserId),"
        " (k, v) -> coalesce(length(v) > 0, false))"
    )


def with_params(raw: DataFrame, config: PipelineConfig) -> DataFrame:
    """Request values and query string in one map, and the schema they name."""
    params = let(
        f"coalesce({text.parse_qs('querystring')}, {EMPTY_MAP})", "qp", text.merge_maps(seed_map(), "qp")
    )
    code = iglu.schema_for_code("params['e']", config.schema_vendor)
    told = net.user_agent_info("params['ua']") if config.device_enabled else "CAST(NULL AS MAP<STRING, STRING>)"
    return (
        raw.withColumn("params", F.expr(params))
        .withColumn("own_agent", F.expr(told))
        .withColumn(
            "outer_schema",
            F.expr(f"CASE WHEN coalesce(params['e'], 'ue') <> 'ue' THEN {code} ELSE params['schema'] END"),
        )
        .withColumn(
            "code_err",
            F.expr(
                "CASE WHEN coalesce(params['e'], 'ue') <> 'ue' AND outer_schema IS NULL THEN "
                + error("value", "concat('Invalid event type: ', params['e'])")
                + " END"
            ),
        )
    )


def with_items(df: DataFrame, rules: Rules) -> DataFrame:
    """The payload's events as an array of ``(params, event)``, or why the body cannot be read."""
    has_body = "coalesce(octet_length(body) > 0, false)"
    is_form = "coalesce(contains(contentType, 'application/x-www-form-urlencoded'), false)"
    body = let("try_validate_utf8(CAST(body AS STRING))", "bs", text.strict_json("bs"))
    pair = "try_cast(body_json AS STRUCT<schema: VARIANT, data: VARIANT>)"
    shape = (
        f"CASE WHEN NOT {has_body} THEN 'none' WHEN {is_form} THEN 'form' WHEN body_json IS NULL THEN 'malformed'"
        " WHEN body_pair IS NULL THEN 'not_object'"
        " WHEN body_type NOT IN ('STRING', 'VOID') THEN 'odd_schema'"
        f" WHEN body_type = 'STRING' AND startswith(CAST(body_pair.schema AS STRING), {lit(PAYLOAD_PREFIX)})"
        "  THEN CASE WHEN body_pair.data IS NULL THEN 'no_data' ELSE 'payload' END"
        " WHEN outer_schema IS NOT NULL THEN 'whole'"
        " WHEN body_pair.schema IS NULL THEN 'no_schema' WHEN body_pair.data IS NULL THEN 'no_data'"
        " ELSE 'single' END"
    )
    df = (
        df.withColumn("body_json", F.expr(f"CASE WHEN {has_body} AND NOT {is_form} THEN {body} END"))
        .withColumn("body_pair", F.expr(pair))
        .withColumn("body_type", F.expr("schema_of_variant(body_pair.schema)"))
        .withColumn("body_shape", F.expr(shape))
        .withColumn(
            "body_doc",
            F.expr(
                "CASE body_shape WHEN 'payload' THEN struct(CAST(body_pair.schema AS STRING) AS uri,"
                " body_pair.data AS value) WHEN 'whole' THEN struct(outer_schema AS uri, body_json AS value) END"
            ),
        )
    )
    if rules.looks_up:
        whole = f"array(array({open_document('body_doc.uri', 'body_doc.value')}))"
        df = df.withColumn("body_found", F.get(F.get(violations(F.expr(f"IF(body_shape = 'whole', {whole}, NULL)")), F.lit(0)), F.lit(0)))
    body_err = (
        "CASE body_shape"
        f" WHEN 'form' THEN {error('unprocessable', lit('form data is not supported'))}"
        f" WHEN 'malformed' THEN {value_error('body is not valid JSON')}"
        f" WHEN 'not_object' THEN {value_error('Invalid body (not a dict)')}"
        f" WHEN 'odd_schema' THEN {error('unprocessable', lit('schema is not a text'))}"
        f" WHEN 'no_schema' THEN {value_error('Missing schema in body')}"
        f" WHEN 'no_data' THEN {value_error('Missing data in body')}"
        " WHEN 'none' THEN NULL WHEN 'single' THEN NULL ELSE coalesce("
        + uri_error(rules, "body_doc.uri")
        + ", "
        + violation_error(rules, "body_doc.uri", "body_doc.value", "body_found" if rules.looks_up else "")
        + ") END"
    )
    merged = text.merge_maps("params", "ip")
    with_schema = let("map('schema', {0})", "sm", text.merge_maps("params", "sm"))
    items = (
        "CASE WHEN payload_err IS NOT NULL THEN NULL ELSE CASE body_shape"
        f" WHEN 'payload' THEN transform(try_cast(body_pair.data AS ARRAY<MAP<STRING, STRING>>), ip ->"
        f" named_struct('params', {merged}, 'event', {NO_VARIANT}))"
        f" WHEN 'whole' THEN array(named_struct('params', {with_schema.format('outer_schema')}, 'event', body_json))"
        " WHEN 'single' THEN array(named_struct('params', "
        + with_schema.format("CASE WHEN body_type = 'STRING' THEN CAST(body_pair.schema AS STRING) END")
        + ", 'event', body_pair.data))"
        f" ELSE array(named_struct('params', params, 'event', {NO_VARIANT})) END END"
    )
    return df.withColumn("payload_err", F.expr(f"coalesce(code_err, {body_err})")).withColumn("items", F.expr(items))


# --- Event level ------------------------------------------------------------------------------------


def _param(name: str, item: str = "it") -> str:
    return f"{item}.params[{lit(name)}]"


def rebuilt(df: DataFrame, keep: list[str], new: dict[str, str]) -> DataFrame:
    """Rebuild every struct of ``items``: keep some fields and add new ones."""
    fields = [f"'{name}', it.{name}" for name in keep] + [f"'{name}', {sql}" for name, sql in new.items()]
    return df.withColumn("items", F.expr(f"transform(items, (it, ii) -> named_struct({', '.join(fields)}))"))


def with_schema(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """Event code or explicit schema of each item, else its unwrapped self-describing event."""
    coded = f"coalesce({_param('e')}, 'ue') <> 'ue'"
    code = iglu.schema_for_code(_param("e"), config.schema_vendor)
    df = rebuilt(
        df,
        ["params", "event"],
        {
            "coded_schema": f"CASE WHEN {coded} THEN {code} ELSE {_param('schema')} END",
            "wrapped": f"CASE WHEN NOT ({coded}) AND {_param('schema')} IS NULL AND NOT map_contains_key(it.params, 'schema')"
            f" THEN CASE WHEN {_param('ue_px')} IS NOT NULL THEN {text.base64_json(_param('ue_px'))}"
            f" ELSE {text.strict_json(_param('ue_pr'))} END END",
        },
    )
    inner_uri = "variant_get(it.wrapped, '$.data.schema')"
    inner = (
        f"CASE WHEN schema_of_variant({inner_uri}) = 'STRING' THEN CAST({inner_uri} AS STRING) END"
    )
    has_schema = "(it.coded_schema IS NOT NULL OR map_contains_key(it.params, 'schema'))"
    err = (
        f"CASE WHEN {coded} AND it.coded_schema IS NULL THEN "
        + error("value", f"concat('Invalid event type: ', {_param('e')})")
        + f" WHEN {has_schema} THEN NULL"
        f" WHEN {_param('ue_px')} IS NULL AND {_param('ue_pr')} IS NULL"
        f" THEN {value_error('No schema and no self describing event')}"
        f" WHEN it.wrapped IS NULL THEN {value_error('self describing event is not valid JSON')}"
        f" WHEN variant_get(it.wrapped, '$.schema') IS NULL"
        f" THEN {value_error('Missing schema in self describing event')}"
        f" WHEN variant_get(it.wrapped, '$.data') IS NULL"
        f" THEN {value_error('Missing data in self describing event')}"
        f" WHEN {inner_uri} IS NULL THEN {value_error('Missing schema in inner self describing event')}"
        f" WHEN variant_get(it.wrapped, '$.data.data') IS NULL"
        f" THEN {value_error('Missing data in inner self describing event')} END"
    )
    return rebuilt(
        df,
        ["params", "event"],
        {
            "is_wrapped": f"NOT {has_schema}",
            "wrapped_data": "variant_get(it.wrapped, '$.data.data')",
            "schema": f"coalesce(it.coded_schema, {inner})",
            "schema_err": err,
        },
    )


def projected_data(rules: Rules, config: PipelineConfig) -> str:
    """Event data built from the parameters the schema lists, as VARIANT.

    A mapped field takes its cast value when its parameter is there, else the parameter of the same name.
    Only fields that some schema lists are spelled out.
    """

    def mapped(mapping: dict[str, tuple[str, str]]) -> dict[str, str]:
        options: dict[str, list[str]] = {}
        for key, (kind, target) in mapping.items():
            options.setdefault(target, []).insert(0, f"CAST({cast(kind, _param(key))} AS VARIANT)")
        return {t: f"coalesce({', '.join(o)}, NULL)" for t, o in options.items() if t in rules.property_names}

    def entries(values: dict[str, str]) -> str:
        pairs = ", ".join(f"{lit(name)}, {sql}" for name, sql in values.items())
        return f"map({pairs})" if pairs else "CAST(map() AS MAP<STRING, VARIANT>)"

    fixed = {
        "v_etl": f"CAST({lit(config.etl_version)} AS VARIANT)",
        "v_collector": f"CAST(coalesce({_param('cv')}, collector) AS VARIANT)",
        "collector_tstamp": f"CAST({text.millis_to_timestamp('timestamp')} AS VARIANT)",
        "collector_host": "CAST(hostname AS VARIANT)",
        "event_vendor": "CAST(it.parts.vendor AS VARIANT)",
        "event_name": "CAST(it.parts.name AS VARIANT)",
        "event_version": "CAST(it.parts.version AS VARIANT)",
        "schema": "CAST(it.schema AS VARIANT)",
    }
    common = mapped(BASE_FIELDS) | {t: v for t, v in fixed.items() if t in rules.property_names}
    named = if_chain(
        [(f"it.parts.name = {lit(name)}", entries(common | mapped(m))) for name, m in EVENT_FIELDS.items()],
        entries(common),
    )
    listed = f"map_filter({named}, (fk, fv) -> fv IS NOT NULL AND array_contains(it.fields, fk))"
    plain = (
        "transform_values(map_filter(it.params, (fk, fv) -> fv IS NOT NULL AND array_contains(it.fields, fk)),"
        " (fk, fv) -> CAST(fv AS VARIANT))"
    )
    return f"to_variant_object({let(listed, 'ld', text.merge_maps(plain, 'ld'))})"


def with_event_data(df: DataFrame, rules: Rules, config: PipelineConfig) -> DataFrame:
    """Event data: the unwrapped event, a given event, or the parameters the schema lists."""
    df = rebuilt(
        df,
        ["params", "event", "is_wrapped", "wrapped_data", "schema", "schema_err"],
        {
            "parts": iglu.uri_parts("it.schema"),
            "created_ms": text.to_int(_param("dtm")),
            "sent_ms": text.to_int(_param("stm")),
            "true_tstamp": f"IF({_param('ttm')} IS NULL, NULL, {text.to_tstamp(_param('ttm'))})",
            "visit": text.to_int(_param("vid")),
            "lookup_err": f"CASE WHEN it.schema_err IS NULL THEN {uri_error(rules, 'it.schema')} END",
            "given": f"coalesce(it.event, CAST({_param('event')} AS VARIANT))",
            "fields": f"CASE WHEN NOT it.is_wrapped AND it.event IS NULL AND {_param('event')} IS NULL"
            f" THEN {rules.fields('it.schema')} END",
        },
    )
    projected = projected_data(rules, config)
    bad_base = (
        f"({_param('dtm')} IS NOT NULL AND ({text.millis_to_timestamp('it.created_ms')}) IS NULL)"
        f" OR ({_param('stm')} IS NOT NULL AND ({text.millis_to_timestamp('it.sent_ms')}) IS NULL)"
        f" OR ({_param('ttm')} IS NOT NULL AND it.true_tstamp IS NULL)"
        f" OR ({_param('vid')} IS NOT NULL AND it.visit IS NULL)"
    )
    bad_event = if_chain(
        [
            (
                f"it.parts.name = {lit(name)}",
                " OR ".join(bad_cast(k, _param(p)) for p, (k, _) in mapping.items() if k in FALLIBLE),
            )
            for name, mapping in EVENT_FIELDS.items()
            if any(kind in FALLIBLE for kind, _ in mapping.values())
        ],
        "false",
    )
    unset = "it.lookup_err IS NULL AND NOT it.is_wrapped AND it.given IS NULL AND it.fields IS NULL"
    return rebuilt(
        df,
        ["params", "is_wrapped", "schema", "schema_err", "lookup_err", "parts", *NUMBERS],
        {
            "data": "CASE WHEN it.is_wrapped THEN it.wrapped_data WHEN it.given IS NOT NULL THEN it.given"
            f" WHEN it.fields IS NOT NULL THEN {projected} END",
            "cast_err": f"CASE WHEN {bad_base} THEN {value_error('a number or timestamp is malformed')} END",
            "event_cast_err": f"IF({bad_event}, {value_error('a number is malformed')}, NULL)",
            "projection_err": f"CASE WHEN {unset} THEN "
            + error("unprocessable", "concat('schema lists no properties: ', it.schema)")
            + " END",
        },
    )


def with_contexts(df: DataFrame, rules: Rules) -> DataFrame:
    """Contexts sent by the tracker; the event and its contexts are then checked in one pass."""
    df = rebuilt(
        df,
        [
            "params", "is_wrapped", "schema", "schema_err", "lookup_err", "parts", "data",
            "cast_err", "event_cast_err", "projection_err", *NUMBERS,
        ],
        {
            "sent": f"CASE WHEN {_param('cx')} IS NOT NULL THEN {text.base64_json(_param('cx'))}"
            f" ELSE {text.strict_json(_param('co'))} END",
        },
    )
    uri = "variant_get(cv, '$.schema')"
    listed = (
        "transform(try_cast(variant_get(it.sent, '$.data') AS ARRAY<VARIANT>), cv -> named_struct("
        f"'schema', CASE WHEN schema_of_variant({uri}) = 'STRING' THEN CAST({uri} AS STRING) END,"
        " 'data', variant_get(cv, '$.data'),"
        f" 'missing', CASE WHEN {uri} IS NULL THEN IF(try_cast(cv AS MAP<STRING, VARIANT>) IS NULL,"
        f" {error('unprocessable', lit('a context is not an object'))}, {value_error('Missing schema in contexts')})"
        f" WHEN variant_get(cv, '$.data') IS NULL THEN {value_error('Missing data in contexts')} END))"
    )
    err = (
        f"CASE WHEN {_param('cx')} IS NULL AND {_param('co')} IS NULL THEN NULL"
        f" WHEN it.sent IS NULL THEN {value_error('contexts are not valid JSON')}"
        f" WHEN variant_get(it.sent, '$.schema') IS NULL THEN {value_error('Missing schema in contexts')}"
        f" WHEN variant_get(it.sent, '$.data') IS NULL THEN {value_error('Missing data in contexts')}"
        " WHEN try_cast(variant_get(it.sent, '$.data') AS ARRAY<VARIANT>) IS NULL"
        f" THEN {error('unprocessable', lit('contexts are not a list'))} END"
    )
    no_contexts = f"CAST(array() AS ARRAY<STRUCT<schema: STRING, data: VARIANT, missing: {ERROR_TYPE}>>)"
    df = rebuilt(
        df,
        [
            "params", "is_wrapped", "schema", "schema_err", "lookup_err", "parts", "data",
            "cast_err", "event_cast_err", "projection_err", *NUMBERS,
        ],
        {"contexts_err": err, "sent_contexts": f"coalesce({listed}, {no_contexts})"},
    )
    not_object = f"NOT {rules.implies_object('dc.schema')} AND try_cast(dc.data AS MAP<STRING, VARIANT>) IS NULL"
    event_doc = f"named_struct('schema', it.schema, 'data', it.data, 'missing', {NO_ERROR})"
    found = ""
    if rules.looks_up:
        docs = f"transform(concat(array({event_doc}), it.sent_contexts), dc -> {open_document('dc.schema', 'dc.data')})"
        df = df.withColumn("found", violations(F.expr(f"transform(items, it -> {docs})")))
        found = "get(get(found, ii), di)"
    checks = (
        f"transform(concat(array({event_doc}), it.sent_contexts), (dc, di) -> named_struct("
        f"'lookup', CASE WHEN di = 0 THEN it.lookup_err ELSE coalesce(dc.missing, {uri_error(rules, 'dc.schema')}) END,"
        f" 'value', CASE WHEN dc.schema IS NOT NULL AND dc.data IS NOT NULL THEN"
        f" coalesce({violation_error(rules, 'dc.schema', 'dc.data', found)},"
        f" CASE WHEN {not_object} THEN {value_error('data is not an object')} END) END))"
    )
    df = rebuilt(
        df,
        [
            "params", "is_wrapped", "schema", "schema_err", "parts", "data",
            "cast_err", "event_cast_err", "projection_err", "contexts_err", "sent_contexts", *NUMBERS,
        ],
        {"checks": f"CASE WHEN coalesce(it.schema_err, it.cast_err) IS NULL THEN {checks} END"},
    )
    repeated = (
        "transform(it.sent_contexts, (dc, di) -> CASE WHEN array_position(it.sent_contexts.schema, dc.schema) <= di"
        f" THEN {error('value', 'concat(\'Context \', dc.schema, \' already exists\')')} END)"
    )
    context_errors = (
        "zip_with(slice(it.checks, 2, size(it.sent_contexts)), "
        + repeated
        + ", (ch, rp) -> coalesce(ch.lookup, ch.value, rp))"
    )
    return rebuilt(
        df,
        ["params", "schema", "parts", "data", "sent_contexts", *NUMBERS],
        {
            "err": "coalesce(it.schema_err, it.cast_err, it.checks[0].lookup,"
            " CASE WHEN it.is_wrapped THEN it.checks[0].value END,"
            " it.event_cast_err, it.projection_err, it.checks[0].value, it.contexts_err,"
            f" {first_not_null(context_errors)})",
        },
    )


# --- Derived contexts -------------------------------------------------------------------------------


def page_url() -> str:
    return (
        f"CASE WHEN it.parts.name = 'page_view' THEN coalesce({_param('url')}, {_param('page_url')})"
        f" ELSE {_param('page_url')} END"
    )


def campaign_params(url: str) -> str:
    """Campaign values found in the query of a URL; NULL when there are none."""
    named = ", ".join(f"struct('{field}' AS k, cq['{key}'] AS v)" for key, field in CAMPAIGN_PARAMS.items())
    networks = " ".join(f"WHEN cq['{key}'] IS NOT NULL THEN '{network}'" for key, network in CLICK_IDS.items())
    clicks = ", ".join(f"cq['{key}']" for key in CLICK_IDS)
    found = (
        f"map_from_entries(filter(array({named}, struct('network' AS k, CASE {networks} END AS v),"
        f" struct('click_id' AS k, coalesce({clicks}) AS v)), cp -> cp.v IS NOT NULL))"
    )
    query = let(text.parse_qs(net.url_query(url)), "cq", let(found, "cm", "CASE WHEN size(cm) > 0 THEN cm END"))
    return f"CASE WHEN contains({url}, '?') THEN {query} END"


def bad_url(url: str) -> str:
    """A host with only one of the two brackets of an IPv6 address."""
    host = f"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"
    return (
        f"CASE WHEN contains({url}, '[') OR contains({url}, ']')"
        f" THEN contains({host}, '[') <> contains({host}, ']') ELSE false END"
    )


def device_params(params: str, agents: bool = False) -> str:
    """Screen, viewport and user agent values; NULL when there are none. With ``agents`` the payload's map of that name tells
    of the user agents, else the built-in rules do."""
    sizes = (
        f"map_filter(map('screen_resolution', {params}['res'], 'viewport_resolution', {params}['vp']),"
        " (k, v) -> v IS NOT NULL)"
    )
    # Most events have the user agent of their payload, which is read once. Named twice, the column is not moved into the lambda.
    own = f"{params}['ua'] <=> params['ua']"
    rules = f"IF({own} AND own_agent IS NOT NULL, own_agent, IF({own}, NULL, {net.user_agent_info(f'{params}[\'ua\']')}))"
    told = f"agents[{params}['ua']]" if agents else rules
    agent = f"coalesce({told}, {EMPTY_MAP})"
    return let(f"map_concat({sizes}, {agent})", "dm", "CASE WHEN size(dm) > 0 THEN dm END")


def with_derived_contexts(df: DataFrame, config: PipelineConfig, agents: bool = False) -> DataFrame:
    """Append the campaign and device contexts; a schema the tracker already sent is an error."""
    campaign = campaign_params("pu") if config.campaign_enabled else "CAST(NULL AS MAP<STRING, STRING>)"
    device = device_params("it.params", agents) if config.device_enabled else "CAST(NULL AS MAP<STRING, STRING>)"
    campaign_uri = iglu.builtin_uri(config.schema_vendor, "campaign_attribution")
    device_uri = iglu.builtin_uri(config.schema_vendor, "device_info")
    wrong_url = let(page_url(), "pu", bad_url("pu")) if config.campaign_enabled else "false"
    ip = f"coalesce({net.first_ip(_param('ip'))}, {_param('user_ipaddress')})"
    bad_ip = let(ip, "ia", f"ia IS NOT NULL AND NOT ({net.is_ip('ia')})") if config.geo_enabled else "false"
    df = rebuilt(
        df,
        ["params", "schema", "parts", "data", "sent_contexts", "err", *NUMBERS],
        {
            "address": ip,
            "campaign": let(page_url(), "pu", campaign),
            "device": device,
            "address_err": f"CASE WHEN {bad_ip} THEN {value_error('IP address is malformed')} END",
            "url_err": f"CASE WHEN {wrong_url} THEN {value_error('page URL is malformed')} END",
        },
    )

    def clash(field: str, uri: str) -> str:
        return (
            f"CASE WHEN it.{field} IS NOT NULL AND array_contains(it.sent_contexts.schema, {lit(uri)})"
            f" THEN {value_error(f'Context {uri} already exists')} END"
        )

    def derived(field: str, uri: str) -> str:
        return (
            f"CASE WHEN it.{field} IS NOT NULL THEN"
            f" named_struct('schema', {lit(uri)}, 'data', to_variant_object(it.{field})) END"
        )

    sent = "transform(it.sent_contexts, sc -> named_struct('schema', sc.schema, 'data', sc.data))"
    return rebuilt(
        df,
        ["params", "schema", "parts", "data", "address", *NUMBERS],
        {
            "contexts": f"concat({sent}, array_compact(array({derived('campaign', campaign_uri)},"
            f" {derived('device', device_uri)})))",
            "err": f"coalesce(it.err, it.address_err, it.url_err, {clash('campaign', campaign_uri)},"
            f" {clash('device', device_uri)})",
        },
    )


# --- Atomic rows ------------------------------------------------------------------------------------


def session_values(contexts: str) -> str:
    """``struct<id, idx, id_bad, idx_bad>`` of the last session context; NULL without one."""
    named = f"filter({contexts}, sx -> contains(sx.schema, '/client_session/'))"

    def last(key: str) -> str:
        found = f"filter(transform(ss, sx -> variant_get(sx.data, '$.{key}')), sx -> sx IS NOT NULL)"
        return f"try_element_at({found}, -1)"

    index = (
        "CASE WHEN sv.xt = 'BIGINT' THEN CAST(sv.x AS BIGINT)"
        " WHEN sv.xt = 'BOOLEAN' THEN IF(CAST(sv.x AS BOOLEAN), 1L, 0L)"
        f" WHEN sv.xt = 'STRING' THEN {text.to_int('CAST(sv.x AS STRING)')}"
        " WHEN try_cast(sv.x AS DOUBLE) = floor(try_cast(sv.x AS DOUBLE)) THEN try_cast(sv.x AS BIGINT) END"
    )
    result = let(
        index,
        "si",
        "named_struct('id', IF(sv.it = 'STRING', CAST(sv.i AS STRING), NULL), 'idx', si,"
        " 'id_bad', coalesce(sv.it NOT IN ('STRING', 'VOID'), false),"
        " 'idx_bad', coalesce(sv.xt <> 'VOID', false) AND si IS NULL)",
    )
    typed = "named_struct('i', sp.i, 'x', sp.x, 'it', schema_of_variant(sp.i), 'xt', schema_of_variant(sp.x))"
    values = f"named_struct('i', {last('sessionId')}, 'x', {last('sessionIndex')})"
    return let(named, "ss", f"IF(size(ss) = 0, NULL, {let(values, 'sp', let(typed, 'sv', result))})")


def best_timestamp(true_ts: str, created_ms: str, sent_ms: str, collector_ms: str) -> str:
    """True time, else collector time corrected by the device's clock offset, else collector time."""
    corrected = f"{collector_ms} - ({sent_ms} - {created_ms})"
    return (
        f"CASE WHEN {true_ts} IS NOT NULL THEN {true_ts}"
        f" WHEN {created_ms} IS NOT NULL AND {sent_ms} IS NOT NULL"
        f" THEN {let(corrected, 'cm', text.millis_to_timestamp('cm'))}"
        f" ELSE {text.millis_to_timestamp(collector_ms)} END"
    )


def with_atomic(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """Assemble the atomic fields and check that the required ones are there."""
    structured = ["category", "action", "label", "property", "value"]
    views = ", ".join(f"{name}: VARIANT" for name in structured)
    base = {target: cast(kind, _param(key)) for key, (kind, target) in BASE_FIELDS.items()}
    # A parameter named like a time field counts as that time, but only as text.
    true_text = f"IF({_param('ttm')} IS NULL, {_param('true_tstamp')}, NULL)"
    corrected = best_timestamp("it.true_tstamp", "it.created_ms", "it.sent_ms", "timestamp")
    df = rebuilt(
        df,
        ["params", "schema", "parts", "data", "address", "contexts", "err", *NUMBERS],
        {
            "flat": f"try_cast(it.data AS STRUCT<{views}>)",
            "session": session_values("it.contexts"),
            "true_text": true_text,
            "tstamp": f"IF(({true_text}) IS NULL, {corrected}, {text.lenient_timestamp(_param('true_tstamp'))})",
            "collector_tstamp": text.millis_to_timestamp("timestamp"),
            "platform": f"IF({_param('platform')} IS NULL, coalesce({_param('p')}, 'web'), {_param('p')})",
        },
    )
    device_times = (("dtm", "dvce_created_tstamp"), ("stm", "dvce_sent_tstamp"))
    text_time = " OR ".join(f"({_param(k)} IS NULL AND {_param(f)} IS NOT NULL)" for k, f in device_times)
    both_times = " AND ".join(f"coalesce({_param(k)}, {_param(f)}) IS NOT NULL" for k, f in device_times)
    no_true = "it.true_tstamp IS NULL AND it.true_text IS NULL"
    missing = (
        "array_compact(array(IF(hostname IS NULL, 'collector_host', NULL), IF(it.platform IS NULL, 'platform', NULL),"
        " IF(it.tstamp IS NULL, 'tstamp', NULL), IF(it.session.id_bad, 'session_id', NULL),"
        " IF(it.session.idx_bad, 'session_idx', NULL)))"
    )
    incomplete = let(
        missing,
        "ms",
        "IF(size(ms) > 0, "
        + error(
            "value",
            "concat('Invalid atomic event: ', size(ms), ' errors in [\\'', array_join(ms, '\\', \\''), '\\']')",
        )
        + ", NULL)",
    )
    suspect = (
        "hostname IS NULL OR it.platform IS NULL OR it.tstamp IS NULL OR it.collector_tstamp IS NULL"
        f" OR coalesce(it.session.id_bad OR it.session.idx_bad, false) OR ({no_true} AND ({text_time}))"
    )
    problems = (
        f"coalesce(IF({no_true} AND {both_times} AND ({text_time}), "
        + error("unprocessable", lit("device times are not timestamps"))
        + ", NULL), IF(it.collector_tstamp IS NULL OR (it.tstamp IS NULL AND it.true_text IS NULL), "
        + error("unprocessable", lit("timestamp out of range"))
        + f", NULL), {incomplete})"
    )
    fields = {
        "err": f"IF(it.err IS NOT NULL, it.err, IF({suspect}, {problems}, NULL))",
        "address": "it.address",
        "event_id": f"coalesce({base['event_id']}, uuid())",
        "collector_host": "hostname",
        "collector_auth": "collector_auth",
        "app_id": base["app_id"],
        "platform": "it.platform",
        "event_vendor": "it.parts.vendor",
        "event_name": "it.parts.name",
        "event_version": "it.parts.version",
        "tstamp": "it.tstamp",
        "collector_tstamp": "it.collector_tstamp",
        "dvce_created_tstamp": text.millis_to_timestamp("it.created_ms"),
        "dvce_sent_tstamp": text.millis_to_timestamp("it.sent_ms"),
        "true_tstamp": "it.true_tstamp",
        "v_tracker": base["v_tracker"],
        "v_collector": f"coalesce({_param('cv')}, collector)",
        "v_etl": lit(config.etl_version),
        "name_tracker": base["name_tracker"],
        "user_ipaddress": f"IF(full_ip, {base['user_ipaddress']}, {net.redact_ip('it.address')})",
        "user_id": base["user_id"],
        "session_id": "it.session.id",
        "session_idx": "it.session.idx",
        "domain_userid": base["domain_userid"],
        "domain_sessionid": base["domain_sessionid"],
        "domain_sessionidx": "it.visit",
        "network_userid": base["network_userid"],
        "useragent": base["useragent"],
        "language": base["language"],
        "contexts": "transform(it.contexts, cx -> named_struct('schema', cx.schema, 'data', CAST(cx.data AS STRING)))",
        "event": "named_struct('schema', it.schema, 'data', CAST(it.data AS STRING))",
    }
    for name in structured:
        value = f"it.flat.{name}"
        fields[name] = (
            f"IF({value} IS NOT NULL, IF(schema_of_variant({value}) = 'STRING', CAST({value} AS STRING), NULL), NULL)"
        )
    return rebuilt(df, [], fields)
