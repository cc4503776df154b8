import base64
import hashlib
import json
import random

import pytest

from millrace import PipelineConfig
from millrace.operators.auth import rsa_numbers, signature_holds, with_auth_subject
from millrace.operators.enrich import Dimensions, Enrichment, context_data, enrich_raw, process_raw, to_atomic
from millrace.operators.errors import outcome_counts, to_errors
from millrace.operators.geo import groups_of, with_geo
from millrace.operators.lookup import lookup_join
from millrace.plans.feed import CONTEXTS, LINK_CLICK, PAYLOAD, SESSION, UNSTRUCT, WEB_PAGE

SOCIAL = "iglu:com.snowplowanalytics.snowplow/social_interaction/jsonschema/1-0-0"
COMMON = {"tv": "t", "p": "web"}


def b64(value):
    return base64.b64encode(json.dumps(value).encode()).decode().rstrip("=")


def wrapped(uri, data):
    return {"schema": UNSTRUCT, "data": {"schema": uri, "data": data}}


def contexts(*pairs):
    return {"schema": CONTEXTS, "data": [{"schema": s, "data": d} for s, d in pairs]}


def payload(*items):
    return json.dumps({"schema": PAYLOAD, "data": [COMMON | i for i in items]})


def run(make_raw, config, rules, *requests, dims=Dimensions()):
    rows = process_raw(make_raw(*requests), config, rules, dims).select("err", "items").collect()
    return rows if len(rows) > 1 else rows[0]


def test_page_view_with_campaign_and_device(make_raw, config, rules):
    url = "http%3A%2F%2Fe.com%2F%3Ftest%3Dok%26utm_campaign%3Dsummer%26utm_medium%3Demail%26gclid%3Dabc"
    row = run(make_raw, config, rules, {"qs": f"e=pv&p=web&url={url}"})
    (event,) = row["items"]
    assert row.err is None and event.event_name == "page_view" and event.user_ipaddress == "172.17.0.x"
    found = {c.schema.split("/")[1]: json.loads(c.data) for c in event.contexts}
    assert found["campaign_attribution"] == {
        "campaign": "summer", "medium": "email", "network": "google", "click_id": "abc",
    }
    assert found["device_info"]["browser_family"] == "Chrome" and found["device_info"]["os_family"] == "Windows"
    assert len(event.event_id) == 36


def test_user_agents_are_read_once_for_a_payload(spark, make_raw, config, rules):
    se = {"e": "se", "se_ca": "a", "se_ac": "b"}
    firefox = "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/118.0"
    body = payload(se, se | {"ua": firefox}, se | {"ua": "odd"}, se | {"ua": "odd", "res": "1x2"})
    requests = [{"body": body}, {"body": body, "ua": None}, {"body": body, "ua": "odd"}]
    told = []
    for row in run(make_raw, config, rules, *requests):
        assert row.err is None
        told.append([[json.loads(c.data) for c in event.contexts] for event in row["items"]])
    families = [[[d.get("browser_family") for d in event] for event in row] for row in told]
    assert families == [[["Chrome"], ["Firefox"], [], [None]], [[], ["Firefox"], [], [None]], [[], ["Firefox"], [], [None]]]
    assert told[0][3] == [{"screen_resolution": "1x2"}]
    # the payload's own agent stays a column beside the lambdas over its events
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = process_raw(make_raw(*requests), config, rules)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "AS own_agent" in plan


def test_several_events_in_one_payload(make_raw, config, rules):
    body = payload(
        {"e": "pv", "url": "u", "dtm": "1702884076562", "stm": "1702884076000"},
        {
            "e": "ue",
            "ue_pr": json.dumps(wrapped(LINK_CLICK, {"targetUrl": "x"})),
            "cx": b64(contexts((SESSION, {"sessionId": "s", "sessionIndex": 3}), (WEB_PAGE, {"id": "1"}))),
        },
    )
    first, second = run(make_raw, config, rules, {"body": body})["items"]
    assert (first.tstamp - first.collector_tstamp).total_seconds() == pytest.approx(0.562)
    assert second.event_name == "link_click" and second.event_vendor == "com.snowplowanalytics.snowplow"
    assert (second.session_id, second.session_idx) == ("s", 3) and len(second.contexts) == 3


def test_schema_in_query_string(make_raw, config, rules):
    row = run(make_raw, config, rules, {"qs": f"schema={SOCIAL}&p=mob&network=twitter&action=retweet"})
    (event,) = row["items"]
    assert event.platform == "mob" and json.loads(event.event.data) == {"network": "twitter", "action": "retweet"}
    assert event.action == "retweet"


def test_body_forms(make_raw, config, rules):
    single, whole = run(
        make_raw, config, rules,
        {"body": json.dumps({"schema": LINK_CLICK, "data": {"targetUrl": "q"}})},
        {"qs": f"schema={LINK_CLICK}", "body": '{"targetUrl":"q"}'},
    )
    for row in (single, whole):
        assert row.err is None and row["items"][0].event.data == '{"targetUrl":"q"}'


def test_typed_fields_reach_custom_schemas(make_raw, config, rules):
    row = run(make_raw, config, rules, {"qs": "schema=iglu:org.example/user/jsonschema/1-0-0&uid=u&vid=7&user_id=z"})
    assert json.loads(row["items"][0].event.data) == {"user_id": "u", "domain_sessionidx": 7}


def test_transaction_keeps_short_names(make_raw, config, rules):
    body = payload({"e": "tr", "tr_id": "1", "tr_tt": "1.5", "tid": "9"}, {"e": "pp", "pp_mix": "5"})
    first, second = run(make_raw, config, rules, {"body": body})["items"]
    assert json.loads(first.event.data) == {"txn_id": "9", "tr_id": "1", "tr_tt": "1.5"}
    assert json.loads(second.event.data) == {"pp_xoffset_min": 5}


FAILURES = [
    ({"qs": "e=pv"}, "validation", "page_url"),
    ({"qs": "e=xx"}, "value", "Invalid event type: xx"),
    ({"qs": "p=web"}, "value", "No schema"),
    ({"body": "{bad"}, "value", "not valid JSON"),
    ({"body": "[1]"}, "value", "not a dict"),
    ({"body": '{"schema":"iglu:a/b/jsonschema/1-0-0","data":{}}'}, "not_found", "iglu:a/b/jsonschema/1-0-0"),
    ({"body": '{"schema":"http://a","data":{}}'}, "value", "only supporting iglu"),
    ({"body": '{"schema":5,"data":{}}'}, "unprocessable", "not a text"),
    ({"body": '{"schema":"iglu:org.example/broken/jsonschema/1-0-0","data":{}}'}, "invalid_schema", "Invalid Schema"),
    ({"body": '{"data":{}}'}, "value", "Missing schema in body"),
    ({"body": "a=1", "content_type": "application/x-www-form-urlencoded"}, "unprocessable", "form"),
    ({"body": payload({"e": "ue", "ue_px": b64(wrapped(LINK_CLICK, {"t": "x"}))})}, "validation", LINK_CLICK),
    ({"body": payload({"e": "ue", "ue_px": "!!"})}, "value", "not valid JSON"),
    ({"body": payload({"e": "se", "se_ca": "c", "se_ac": "a"}, {"e": "pv"})}, "validation", "page_url"),
    ({"body": payload({"e": "ti", "ti_qu": "x"})}, "value", "malformed"),
    ({"body": payload({"e": "pv", "url": "u", "extra": "1"})}, "validation", "extra is not allowed"),
    ({"body": json.dumps({"schema": PAYLOAD, "data": []})}, "validation", "minItems"),
    (
        {"body": payload({"e": "pv", "url": "x", "co": json.dumps(contexts((WEB_PAGE, {"id": "1"}), (WEB_PAGE, {"id": "2"})))})},
        "value",
        "already exists",
    ),
    ({"body": payload({"e": "pv", "url": "x", "co": json.dumps({"schema": CONTEXTS, "data": [1]})})}, "unprocessable", "context"),
    ({"qs": "e=pv&url=x&platform=y"}, "value", "['platform']"),
    ({"qs": "e=pv&url=x", "host": None}, "value", "['collector_host']"),
    ({"qs": "e=pv&url=x&vid=z"}, "value", "malformed"),
    ({"qs": "e=pv&url=x&dvce_created_tstamp=1&stm=2"}, "unprocessable", "device times"),
    ({"qs": "e=pv&url=http://[x/"}, "value", "URL"),
]


def test_failures(make_raw, config, rules):
    rows = run(make_raw, config, rules, *[f[0] for f in FAILURES])
    found = [(r.err.kind, r.err.msg) if r.err else None for r in rows]
    for (_, kind, part), got in zip(FAILURES, found):
        assert got and got[0] == kind and part in got[1], (kind, part, got)


def test_parameter_named_like_a_time_field(make_raw, config, rules):
    row = run(make_raw, config, rules, {"qs": "e=pv&url=x&true_tstamp=2020-01-01T00:00:00Z"})
    (event,) = row["items"]
    assert event.tstamp.isoformat() == "2020-01-01T00:00:00" and event.true_tstamp is None


def test_errors_and_counts(make_raw, config, rules):
    raw = make_raw({"qs": "e=pv&url=x"}, {"qs": "e=pv"}, {"qs": "e=xx", "host": None})
    events, errors = enrich_raw(raw, config, rules)
    assert events.count() == 1
    by_reason = {r.reason.split(":")[0]: r for r in errors.collect()}
    assert set(by_reason) == {"data validation error", "invalid event data"}
    assert by_reason["invalid event data"].collector_domain == "unknown"
    record = json.loads(by_reason["data validation error"].payload)
    assert record["querystring"] == "e=pv" and "body" in record and record["body"] is None
    processed = process_raw(raw, config, rules)
    assert outcome_counts(processed).first().asDict() == {"success": 1, "error": 2}
    assert to_errors(processed).count() == 2


GEO = [
    ("3.64.0.0", "3.66.255.255", "DE", "HE", "Frankfurt am Main"),
    ("2001:db8::", "2001:db9::ffff", "FR", "IDF", "Paris"),
]


def test_geo_lookup(spark, make_raw, rules):
    config = PipelineConfig(geo_enabled=True)
    ranges = spark.createDataFrame(GEO, "start_ip string, end_ip string, country string, region string, city string")
    dims = Dimensions(geo_ranges=ranges)
    raw = make_raw(
        {"qs": "e=pv&url=a", "ip": "3.65.192.185"},
        {"qs": "e=pv&url=b", "ip": "2001:db8:1::7"},
        {"qs": "e=pv&url=c", "ip": "9.9.9.9"},
        {"qs": "e=pv&url=d", "ip": "nonsense"},
    )
    events, errors = enrich_raw(raw, config, rules, dims)
    found = {json.loads(r.event.data)["page_url"]: (r.geo_country, r.geo_city) for r in events.collect()}
    assert found == {"a": ("DE", "Frankfurt am Main"), "b": ("FR", "Paris"), "c": (None, None)}
    assert "IP address" in errors.first().reason


def test_large_lookup_is_shuffled_and_complete(spark):
    facts = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('k', id % 7)) AS k")
    table = spark.range(1, 3).selectExpr("IF(id = 1, 'hot', 'k1') AS k", "id AS v")
    small = lookup_join(facts, table, ["k"], PipelineConfig())
    large = lookup_join(facts, table, ["k"], PipelineConfig(broadcast_limit_rows=0))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.select(*small.columns).collect())
    assert large.count() == 1000


def test_geo_without_broadcast(spark):
    ranges = spark.createDataFrame(GEO, "start_ip string, end_ip string, country string, region string, city string")
    rows = spark.createDataFrame([("3.64.0.1",), ("3.67.0.0",), (None,)], "address string")
    found = with_geo(rows, ranges, PipelineConfig(broadcast_limit_rows=0))
    assert {(r.address, r.geo_country) for r in found.collect()} == {("3.64.0.1", "DE"), ("3.67.0.0", None), (None, None)}


def test_wide_and_nested_ranges(spark):
    """The innermost range counts and no row is multiplied."""
    schema = "start_ip string, end_ip string, country string, region string, city string"
    ranges = [("0.0.0.0", "127.255.255.255", "low", "r", "c"), ("10.0.0.0", "10.255.255.255", "ten", "r", "c"), ("10.1.0.0", "10.1.255.255", "in", "r", "c"), ("10.1.0.7", "10.1.0.7", "one", "r", "c")]
    ranges += [("::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "all6", "r", "c"), ("2000::", "3fff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "third", "r", "c"), ("2001:db8:1::", "2001:db8:1:ffff::", "doc", "r", "c")]
    ranges += [("9.0.0.9", "9.0.0.1", "turned", "r", "c"), ("x", "1.1.1.1", "bad", "r", "c"), ("10.0.0.0", "10.255.255.255", "ten", "r", "c")]
    table = spark.createDataFrame(ranges, schema)
    want = {"1.2.3.4": "low", "10.200.0.1": "ten", "10.1.3.4": "in", "10.1.0.7": "one", "10.1.0.8": "in", "200.0.0.1": None, "9.0.0.5": "low", "::1": "all6", "2002::1": "third", "2001:db8:1:5::": "doc", "2001:db8:2::": "third", "ffff::": "all6"}
    rows = spark.createDataFrame([(ip,) for ip in want], "address string")
    for config in (PipelineConfig(), PipelineConfig(broadcast_limit_rows=0)):
        assert sorted(map(tuple, with_geo(rows, table, config).select("address", "geo_country").collect()), key=str) == sorted(want.items(), key=str)


def _address(number, six):
    text = f"{number:032X}"
    return ":".join(text[i : i + 4] for i in range(0, 32, 4)) if six else ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))


@pytest.mark.parametrize("six", [False, True])
def test_ranges_against_all_pairs(spark, six):
    """Dense, nested, overlapping, equal and covering ranges, by the sweep and sent to tasks, against each range tried."""
    rng = random.Random(5 + six)
    top = 2**128 if six else 2**32
    base = 0x20010DB8 << 96 if six else 10 << 24
    ranges = [(0, top - 1, "all", None, "c"), (base, base + 60_000, "net", "r", None), (base, base + 60_000, "net", None, None), (base + 5, base + 60_000, None, "r", "c")]
    for i in range(1500):
        lo = base + rng.randrange(60_000)
        ranges.append((lo, lo + rng.choice([0, 1, 15, 15, 900, 40_000]), f"x{i % 700}", "r", f"c{i % 3}"))
    ranges += [(base + 40 * i, base + 40 * i + 39, f"d{i}", "r", "c") for i in range(1000)] + ranges[:40]
    numbers = [base + rng.randrange(70_000) for _ in range(2500)] + [base + 1] * 400 + [r[0] for r in ranges[:300]] + [r[1] for r in ranges[:300]] + [0, 7, top - 1]
    table = spark.createDataFrame([(_address(a, six), _address(b, six), *g) for a, b, *g in ranges], "start_ip string, end_ip string, country string, region string, city string").repartition(4)
    rows = spark.createDataFrame([(_address(n, six),) for n in numbers] + [(None,), ("x",)], "address string").repartition(3)
    order = lambda r: (r[0], -r[1], *[(g is not None, g or "") for g in r[2:]])
    ordered = sorted(ranges, key=order, reverse=True)
    want = {n: next((r[2:] for r in ordered if r[0] <= n <= r[1]), (None, None, None)) for n in set(numbers)}
    want = sorted([(_address(n, six), *want[n]) for n in numbers] + [(None,) * 4, ("x", None, None, None)], key=str)
    assert len({w[1:] for w in want}) > 100
    for sent in (0, 1 << 30):
        found = with_geo(rows, table, PipelineConfig(), sent_bytes=sent)
        assert sorted(map(tuple, found.select("address", "geo_country", "geo_region", "geo_city").collect()), key=str) == want


def test_no_task_of_the_sweep_holds_all_ranges(spark):
    """Ranges inside one network, each inside the one before: every partition gets about its share of the rows."""
    ranges = spark.range(40_000).selectExpr(
        "concat('10.', id div 65536, '.', id div 256 % 256, '.', id % 256) AS start_ip", "concat('10.255.', 255 - id div 256 % 256, '.', 255 - id % 256) AS end_ip",
        "CAST(id AS STRING) AS country", "'r' AS region", "'c' AS city",
    )
    rows = spark.range(3000).selectExpr("concat('10.', id % 7, '.', id div 12 % 256, '.', id % 256) AS address")
    small = sorted(map(tuple, with_geo(rows, ranges, PipelineConfig(), sent_bytes=1 << 30).collect()))
    large = with_geo(rows, ranges, PipelineConfig(), sent_bytes=0)
    assert sorted(map(tuple, large.collect())) == small


@pytest.mark.parametrize("first,last", [(0, 0), (1, 1), (3, 2), (0, 7), (1, 6), (5, 22), (1, 1000)])
def test_groups_of_partitions(first, last):
    found = groups_of(first, last)
    assert sorted(p for size, number in found for p in range(number << size, (number + 1) << size)) == list(range(first, last + 1))
    assert len(found) <= 20


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_no_ranges_and_no_addresses(spark, sent):
    schema = "start_ip string, end_ip string, country string, region string, city string"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([("1.0.0.0", "1.0.0.9", "a", "b", "c")], schema)
    rows = spark.createDataFrame([("1.0.0.1",)], "address string")
    assert with_geo(rows, none, PipelineConfig(), sent_bytes=sent).first()["geo_country"] is None
    assert with_geo(rows.limit(0), one, PipelineConfig(), sent_bytes=sent).collect() == []


def test_host_config(spark, make_raw, config, rules):
    hosts = spark.createDataFrame([("full", True, False)], "hostname string, enable_full_ip boolean, enable_cookies boolean")
    raw = make_raw({"qs": "e=pv&url=x", "host": "full"}, {"qs": "e=pv&url=x", "host": "other"})
    dims = Dimensions(host_config=hosts)
    events = to_atomic(process_raw(raw, config, rules, dims), config, dims)
    assert {r.collector_host: r.user_ipaddress for r in events.collect()} == {"full": "172.17.0.5", "other": "172.17.0.x"}


def test_custom_enrichment(make_raw, config, rules):
    uri = "iglu:org.example/note/jsonschema/1-0-0"
    dims = Dimensions(
        enrichments=[
            Enrichment(values={"tenant_id": "'t1'"}, contexts={uri: "to_json(map('n', it.event_name))"}),
            Enrichment(values={"user_id": context_data(uri)}, reject="IF(it.event.data LIKE '%reject%', 'not wanted', NULL)"),
        ]
    )
    events = to_atomic(process_raw(make_raw({"qs": "e=pv&url=x"}), config, rules, dims), config, dims)
    row = events.first()
    assert row.tenant_id == "t1" and row.contexts[-1].schema == uri and row.user_id == '{"n":"page_view"}'
    for name in ("nope", "contexts", "geo_city"):
        with pytest.raises(KeyError):
            Enrichment(values={name: "1"})


def test_custom_enrichment_takes_part_in_the_verdict(make_raw, config, rules):
    uri = "iglu:org.example/note/jsonschema/1-0-0"
    twice = [Enrichment(contexts={uri: "IF(it.event.data LIKE '%twice%', '{}', NULL)"})] * 2
    dims = Dimensions(enrichments=[Enrichment(reject="IF(it.event.data LIKE '%reject%', 'not wanted', NULL)"), *twice])
    raw = make_raw({"qs": "e=pv&url=fine"}, {"qs": "e=pv&url=reject"}, {"qs": "e=pv&url=twice"})
    events, errors = enrich_raw(raw, config, rules, dims)
    assert events.count() == 1
    assert sorted(r.reason for r in errors.collect()) == [f"invalid event data: Context {uri} already exists", "invalid event data: not wanted"]


# --- Bearer tokens ----------------------------------------------------------------------------------


def _prime(rng, bits):
    while True:
        n = rng.getrandbits(bits) | (1 << (bits - 1)) | 1
        if all(pow(a, n - 1, n) == 1 for a in (2, 3, 5, 7, 11)):
            return n


def _der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def _integer(n):
    return _der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


@pytest.fixture(scope="module")
def key():
    rng = random.Random(7)
    while True:
        p, q, e = _prime(rng, 512), _prime(rng, 512), 65537
        if (p - 1) % e and (q - 1) % e:
            break
    n, d = p * q, pow(e, -1, (p - 1) * (q - 1))
    algorithm = _der(0x30, bytes.fromhex("06092a864886f70d010101") + b"\x05\x00")
    bits = _der(3, b"\x00" + _der(0x30, _integer(n) + _integer(e)))
    text = base64.b64encode(_der(0x30, algorithm + bits)).decode()
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    return n, d, f"-----BEGIN PUBLIC KEY-----\n{lines}\n-----END PUBLIC KEY-----"


def _token(key, claims, alg="RS256"):
    n, d, _ = key

    def part(b):
        return base64.urlsafe_b64encode(b).decode().rstrip("=")

    text = part(json.dumps({"alg": alg}).encode()) + "." + part(json.dumps(claims).encode())
    digest = bytes.fromhex("3031300d060960864801650304020105000420") + hashlib.sha256(text.encode()).digest()
    size = (n.bit_length() + 7) // 8
    padded = b"\x00\x01" + b"\xff" * (size - len(digest) - 3) + b"\x00" + digest
    return text + "." + part(pow(int.from_bytes(padded, "big"), d, n).to_bytes(size, "big"))


def test_bearer_token(spark, make_raw, key):
    good = _token(key, {"iss": "https://a", "sub": "my_user", "aud": "x"})
    head, claims, signature = good.split(".")
    forged = ".".join([head, base64.urlsafe_b64encode(b'{"sub":"evil"}').decode().rstrip("="), signature])
    numbers = rsa_numbers(key[2])
    assert signature_holds(good, numbers) and not signature_holds(forged, numbers) and not signature_holds(good, None)

    def auth(header):
        return {"qs": "e=pv&url=x", "headers": [header]}

    raw = make_raw(
        auth(f"authorization: Bearer {good}"),
        auth(f"authorization: Bearer {forged}"),
        auth("authorization: Bearer nonsense"),
        auth(f"authorization: Bearer {_token(key, {'sub': 'late', 'exp': 1000})}"),
        auth("Host: a"),
    )
    config = PipelineConfig(auth_enabled=True, auth_public_key=key[2])
    found = [r.collector_auth for r in with_auth_subject(raw, config).collect()]
    assert found == ["my_user", None, None, None, None]
    keys = spark.createDataFrame([("https://a", key[2])], "issuer string, issuer_key string")
    by_issuer = with_auth_subject(raw, PipelineConfig(auth_enabled=True, auth_audience="x"), keys)
    assert sorted([r.collector_auth for r in by_issuer.collect()], key=str) == [None, None, None, None, "my_user"]
    twice = with_auth_subject(raw, PipelineConfig(auth_enabled=True), keys.union(keys))
    assert twice.count() == 5


def test_bearer_claims_are_taken_as_they_stand(spark, make_raw, key):
    token = _token(key, {"https://claims.example/org.user": "u'1", "aud": "o'hare"})
    raw = make_raw({"qs": "e=pv&url=x", "headers": [f"authorization: Bearer {token}"]})
    config = PipelineConfig(auth_enabled=True, auth_public_key=key[2], auth_audience="o'hare", auth_claim="https://claims.example/org.user")
    assert with_auth_subject(raw, config).first().collector_auth == "u'1"


def test_large_documents_are_not_broadcast(spark, config):
    from pyspark.sql import functions as F

    from millrace.operators import lookup, schemas

    facts = spark.createDataFrame([(["a"],), (["b"],), (["c"],)], "_named array<string>")
    entry = "named_struct('document', repeat('x', 1000), 'fields', array('f'), 'is_object', true, 'invalid', null)"
    table = facts.limit(2).select("_named", F.expr(f"CAST(map(_named[0], {entry}) AS {schemas.REG})").alias("reg"))
    found = [lookup.lookup_join(facts, table, ["_named"], config, schemas.REG_BYTES, n) for n in (2000, 1999)]
    assert [d._jdf.queryExecution().analyzed().toString().count("broadcast") for d in found] == [1, 0]
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))
