import json

import pytest
from sqlvalue import value

from millrace.functions.schema_checker import Checker, read_document, violation
from millrace.functions import iglu, jsonschema, net, text


@pytest.mark.parametrize(
    "qs,expected",
    [
        ("a=1&b=&c&a=2&d=x%20y+z&e=%zz&&f=1=2", {"a": "1", "d": "x y z", "e": "%zz", "f": "1=2"}),
        ("a=%C3%A9", {"a": "é"}),
        ("", {}),
    ],
)
def test_parse_qs(spark, qs, expected):
    assert value(spark, text.parse_qs(f"'{qs}'")) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [
        ('{"a":1}', '{"a":1}'),
        ('{"a":1} x', None),
        ('{"a":1}}', None),
        ("1,2", None),
        ("", None),
        ('{"a":1,"a":2}', '{"a":2}'),
        ("NaN", None),
    ],
)
def test_strict_json(spark, raw, expected):
    assert value(spark, f"to_json({text.strict_json(repr(raw))})") == expected


@pytest.mark.parametrize("raw", ["eyJhIjoxfQ==", "eyJhIjoxfQ", "eyJhIj!oxfQ"])
def test_base64_json(spark, raw):
    assert value(spark, f"to_json({text.base64_json(repr(raw))})") == '{"a":1}'


def test_base64_urlsafe(spark):
    assert value(spark, text.base64_text("'Pz8_'", urlsafe=True)) == "???"


@pytest.mark.parametrize(
    "fn,raw,expected",
    [
        (text.to_int, " 1_000 ", 1000),
        (text.to_int, "+5", 5),
        (text.to_int, "1.0", None),
        (text.to_int, "", None),
        (text.to_float, "1e5", 1e5),
        (text.to_float, "1d", None),
        (text.to_float, "1_0.5", 10.5),
        (text.to_float, "-inf", float("-inf")),
        (net.first_ip, "[1.2.3.4], 5.6.7.8", "1.2.3.4"),
        (net.first_ip, "[1.2.3.4]", "[1.2.3.4]"),
        (net.redact_ip, "172.17.0.5", "172.17.0.x"),
        (net.redact_ip, "::1", "::1.x"),
        (net.ip_key, "1.2.3.4", "4:01020304"),
        (net.ip_key, "::1", "6:" + "0" * 31 + "1"),
        (net.ip_key, "::ffff:1.2.3.4", "6:" + "0" * 20 + "FFFF01020304"),
        (net.ip_key, "1.2.3.400", None),
        (net.ip_key, "01.2.3.4", None),
        (net.ip_key, "1::2::3", None),
        (iglu.uri_problem, "iglu:a/b", "Invalid schema path: a/b"),
        (iglu.uri_problem, "iglu:a/b/c/1", "Invalid schema format: c"),
        (iglu.context_column, "iglu:Com.Acme/myName/jsonschema/2-0-0", "context_com_acme_my_name_2"),
        (net.redirect_target, "u=ftp", None),
        (net.redirect_target, "u=http%3A%2F%2Fx&u=https://y", "https://y"),
    ],
)
def test_scalars(spark, fn, raw, expected):
    assert value(spark, fn(repr(raw))) == expected


def test_timestamps(spark):
    assert value(spark, f"unix_millis({text.to_tstamp(repr('1702884076562'))})") == 1702884076562
    assert value(spark, text.to_tstamp("'999999999999999'")) is None
    assert value(spark, f"unix_millis({text.lenient_timestamp(repr('2024-01-01T00:00:00Z'))})") == 1704067200000
    assert value(spark, f"unix_millis({text.lenient_timestamp(repr('1702884076'))})") == 1702884076000


def test_headers(spark):
    headers = "array('Cookie: a=1; sp=abc','X-Y: 1','sp-anonymous: *','Remote-Address: 5','a:1','a: 2','none')"
    assert value(spark, net.headers_map(headers))["a"] == "2"
    assert value(spark, net.cookie_value(headers, "sp")) == "abc"
    assert value(spark, net.is_anonymous(headers)) is True
    assert value(spark, net.is_anonymous("array('anonymous: ')")) is False
    kept = value(spark, net.filter_headers(headers, "true"))
    assert [h.split(":")[0] for h in kept] == ["X-Y", "sp-anonymous", "a", "a", "none"]
    assert value(spark, net.network_user_id("true", "''", "NULL")) == net.ANONYMOUS_USER_ID
    assert value(spark, net.network_user_id("false", "'nuid=q'", "'c'")) == "q"
    assert value(spark, net.network_user_id("false", "'a=q'", "'c'")) == "c"
    assert len(value(spark, net.network_user_id("false", "''", "CAST(NULL AS STRING)"))) == 36


def test_plan_time_name_agrees(spark):
    uri = "iglu:com.acme/myLongName/jsonschema/1-2-3"
    assert iglu.context_column_name(uri) == value(spark, iglu.context_column(repr(uri)))


NESTED = {
    "type": "object",
    "properties": {
        "n": {"type": "integer", "minimum": 3},
        "l": {"type": "array", "items": {"$ref": "#/$defs/flags"}, "uniqueItems": True},
        "k": {"enum": ["a", 1.5]},
        "o": {"oneOf": [{"type": "string"}, {"type": "integer"}]},
    },
    "$defs": {"flags": {"type": "object", "additionalProperties": {"type": "boolean"}}},
    "patternProperties": {"^z": {"type": "null"}},
    "additionalProperties": False,
}


@pytest.mark.parametrize(
    "data,valid",
    [
        ({"n": 3}, True),
        ({"n": 2}, False),
        ({"n": 1.5}, False),
        ({"n": 4.0}, True),
        ({"n": True}, False),
        ({"l": [{"a": True}]}, True),
        ({"l": [{"a": 1}]}, False),
        ({"l": [{"a": True}, {"a": True}]}, False),
        ({"k": 1.5}, True),
        ({"k": 2}, False),
        ({"o": 1}, True),
        ({"o": None}, False),
        ({"zz": None}, True),
        ({"zz": 1}, False),
        ({"q": 1}, False),
        ([], False),
    ],
)
def test_json_schema(spark, data, valid):
    found = value(spark, jsonschema.violation(NESTED, f"parse_json('{json.dumps(data)}')"))
    assert (found is None) == valid
    assert found == Checker({"$schema": "x", **NESTED}).violation(data)


@pytest.mark.parametrize(
    "document,problem",
    [
        ({"$schema": "x", "type": "object"}, None),
        ({"type": "object"}, "$schema is missing"),
        ({"$schema": "x", "type": "nothing"}, "'nothing' is not a type"),
        ({"$schema": "x", "properties": {"a": {"$ref": "#"}}}, None),
        ({"$schema": "x", "properties": {"a": {"$ref": "#/$defs/b"}}}, "#/$defs/b does not exist"),
        ({"$schema": "x", "$ref": "https://elsewhere.example/s"}, "'https://elsewhere.example/s' is not a local reference"),
        ({"$schema": "x", "unevaluatedProperties": 5}, "5 is not a schema"),
        ([], "document is not an object"),
    ],
)
def test_document_check(document, problem):
    assert read_document(json.dumps(document))[1] == problem


TREE = {"type": "object", "properties": {"v": {"type": "integer"}, "next": {"$ref": "#"}}, "required": ["v"], "additionalProperties": False}
DEPENDENT = {"type": "object", "properties": {"card": {}, "address": {}}, "dependentSchemas": {"card": {"required": ["address"]}}}
EITHER = {"anyOf": [{"properties": {"a": {"type": "string"}}, "required": ["a"]}, {"properties": {"b": {"type": "integer"}}, "required": ["b"]}], "unevaluatedProperties": False}
ANCHORED = {"prefixItems": [{"$ref": "#num"}], "contains": {"const": "x"}, "unevaluatedItems": False, "$defs": {"n": {"$anchor": "num", "type": "number"}}}
NAMED = {"$id": "https://a.example/s", "items": {"$ref": "part"}, "$defs": {"p": {"$id": "part", "$dynamicAnchor": "it", "minimum": 2.5}}}


@pytest.mark.parametrize(
    "document,data,found",
    [
        (TREE, {"v": 1, "next": {"v": 2, "next": {"v": 3}}}, None),
        (TREE, {"v": 1, "next": {"v": 2, "next": {"v": "x"}}}, "next: next: v: value is not of type integer"),
        (DEPENDENT, {"address": 1}, None),
        (DEPENDENT, {"card": 1}, "address is required"),
        (EITHER, {"a": "x"}, None),
        (EITHER, {"a": "x", "b": 1}, None),
        (EITHER, {"a": "x", "b": "no"}, "b is not allowed"),
        (EITHER, {"c": 1}, "no anyOf branch holds"),
        (ANCHORED, [1, "x"], None),
        (ANCHORED, [1, "x", 2], "no value is allowed"),
        (ANCHORED, ["x"], "value is not of type number"),
        (NAMED, [3, 2.5], None),
        (NAMED, [2], "number breaks minimum"),
    ],
)
def test_rules_that_are_checked_as_data(document, data, found):
    document = {"$schema": "x", **document}
    with pytest.raises(jsonschema.NotCompiled):
        jsonschema.violation(document, "x")
    assert Checker(document).violation(data) == found


def test_odd_headers(spark):
    assert value(spark, net.header_value("array('cookie', 'a: b')", "cookie")) is None
    assert value(spark, net.headers_map("array('nothing')")) == {}


@pytest.mark.parametrize(
    "schema,data,found",
    [
        ({"type": "integer"}, "1" + "0" * 400, None),
        ({"type": "integer", "multipleOf": 7}, "1" + "0" * 400, "number breaks multipleOf"),
        ({"multipleOf": 0.5}, "1" + "0" * 400, "number breaks multipleOf"),
        ({"const": 1}, "1" + "0" * 400, "value is not the expected value"),
        ({"type": "integer"}, "1" + "0" * 5000, "value cannot be read"),
        ({"type": "array"}, "[" * 100_000 + "]" * 100_000, "value is nested too deeply"),
        ({"maximum": 5}, "1e999", "number breaks maximum"),
    ],
)
def test_data_that_would_end_a_job(schema, data, found):
    assert violation(json.dumps({"$schema": "x", **schema}), data) == found


def test_cookie_names_are_no_patterns(spark):
    headers = "array('Cookie: spxid=1; sp.id=2; a+b=3')"
    assert value(spark, net.cookie_value(headers, "sp.id")) == "2" and value(spark, net.cookie_value(headers, "a+b")) == "3"


def test_closed_flat_objects_are_checked_alike_both_ways(spark):
    """The short test of an object's type text, and the rules one by one, which a title makes the checker take."""
    names = ["a", "b", "c", "d", "e", "f", "g", "h"]
    kinds = ["string", "integer", ["string", "null"], "boolean", "string", "integer", ["integer", "null"], "string"]
    schema = {"type": "object", "properties": {n: {"type": k} for n, k in zip(names, kinds)}, "required": ["a", "b"], "additionalProperties": False}
    good = {"a": "x", "b": 1, "c": None, "d": True, "e": "", "f": -5, "g": None, "h": "y"}
    values = [good, {"a": "x", "b": 2}, {"a": "x"}, {"b": 1}, {}, [], None, "a", {**good, "i": 1}, {"a": "x", "b": 1.5}, {"a": "x", "b": 1.0}, {"a": "x", "b": 10**18}]
    values += [{**good, n: v} for n in names for v in (None, True, 3, 2.5, "t", [1], {"a": "x"})]
    docs = spark.createDataFrame([(json.dumps(v),) for v in values], "d string").selectExpr("parse_json(d) AS v")
    both = docs.selectExpr(f"{jsonschema.violation(schema, 'v')} AS short", f"{jsonschema.violation({**schema, 'title': 't'}, 'v')} AS long").collect()
    assert [r["short"] for r in both] == [r["long"] for r in both]
    assert sum(r["short"] is None for r in both) > 10
