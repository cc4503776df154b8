"""JSON Schema (2020-12) checks over VARIANT values, written as Spark SQL text.

``violation(document, x)`` yields an expression that is NULL for a valid value and otherwise names the
first broken rule. Documents are compiled once while the plan is built; ``$ref`` is inlined. A document that refers to
itself or uses a rule for which there is no such text raises ``NotCompiled``: it is checked as data instead
(``schema_checker``). ``format`` is not asserted.
"""

from __future__ import annotations

import json
import re
from itertools import count
from typing import Any, NamedTuple

from millrace.functions.sqltext import first_not_null, if_chain, let, lit, lits

TYPES = ("string", "integer", "number", "boolean", "null", "object", "array")
MAX_DOCUMENT_BYTES = 128 * 1024


class InvalidSchema(ValueError):
    """The schema document itself is malformed."""


class NotCompiled(ValueError):
    """The document is fine, but its rules cannot be written as SQL text of bounded size."""


#: Keywords that are rules, or name places that rules refer to, and are left to the checker of single values.
CHECKED_ONLY = ("unevaluatedProperties", "unevaluatedItems", "dependentSchemas", "$dynamicRef", "$anchor", "$dynamicAnchor")


def type_name(x: str) -> str:
    return f"schema_of_variant({x})"


def as_map(x: str) -> str:
    return f"try_cast({x} AS MAP<STRING, VARIANT>)"


def as_array(x: str) -> str:
    return f"try_cast({x} AS ARRAY<VARIANT>)"


class _Value(NamedTuple):
    """Names under which one value is visible: as variant, as map, as array, and the text of its type."""

    x: str
    m: str
    a: str
    t: str

    def is_type(self, name: str) -> str:
        if name == "string":
            return f"{self.t} = 'STRING'"
        if name == "boolean":
            return f"{self.t} = 'BOOLEAN'"
        if name == "null":
            return f"{self.t} = 'VOID'"
        if name == "object":
            return f"{self.m} IS NOT NULL"
        if name == "array":
            return f"{self.a} IS NOT NULL"
        numeric = f"({self.t} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({self.t}, 'DECIMAL('))"
        if name == "number":
            return numeric
        value = f"try_cast({self.x} AS DOUBLE)"
        return f"({self.t} = 'BIGINT' OR ({numeric} AND {value} = floor({value})))"


class _Compiler:
    def __init__(self, document: Any):
        self.root = document
        self.names = (f"j{i}" for i in count())
        self.open_refs: list[str] = []

    def name(self) -> str:
        return next(self.names)

    # Each rule is text that is NULL when it holds and a message when it does not.
    def violation(self, schema: Any, x: str) -> str:
        if schema is True or schema == {}:
            return "CAST(NULL AS STRING)"
        if schema is False:
            return "'no value is allowed'"
        if not isinstance(schema, dict):
            raise InvalidSchema(f"{json.dumps(schema)[:60]} is not a schema")
        if any(key in schema for key in CHECKED_ONLY) or ("$id" in schema and schema is not self.root):
            raise NotCompiled("a rule is checked as data only")
        v = _Value(self.name(), self.name(), self.name(), self.name())
        rules = self.value_rules(schema, v)
        rules += self.object_rules(schema, v)
        rules += self.array_rules(schema, v)
        rules += self.combined_rules(schema, v.x)
        if not rules:
            return "CAST(NULL AS STRING)"
        body = rules[0] if len(rules) == 1 else f"coalesce({', '.join(rules)})"
        # Bind only the views of the value that some rule reads, the costly ones only where the short test fails.
        for name, view in ((v.a, as_array(v.x)), (v.m, as_map(v.x))):
            if re.search(rf"\b{name}\b", body):
                body = let(view, name, body)
        flat = self.flat_object(schema, v)
        if flat:
            body = f"IF({flat}, CAST(NULL AS STRING), {body})"
        if re.search(rf"\b{v.t}\b", body):
            body = let(type_name(v.x), v.t, body)
        return let(x, v.x, body)

    def flat_object(self, schema: dict, v: _Value) -> str | None:
        """One test of the value's type text for a closed object with plain scalar properties.

        It is enough to prove the object valid; when it fails the full rules say why.
        """
        plain = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "BIGINT": "integer"}
        properties = schema.get("properties", {})
        if schema.get("additionalProperties") is not False or not properties or len(properties) < 8:
            return None
        if set(schema) - {"type", "properties", "required", "additionalProperties", "description", "$schema", "self"}:
            return None
        same: dict[str, list[str]] = {}
        for name, sub in properties.items():
            if not re.fullmatch(r"[a-z_]+", name) or set(sub) - {"type", "description"} or "type" not in sub:
                return None
            names = sub["type"] if isinstance(sub["type"], list) else [sub["type"]]
            if set(names) - set(plain.values()):
                return None
            same.setdefault("|".join(t for t, n in plain.items() if n in names), []).append(name)
        one = "|".join(f"(?:{'|'.join(names)}): (?:{types})" for types, names in same.items())
        tests = [f"{v.t} rlike {lit(f'^OBJECT<(?:{one})(?:, (?:{one}))*>$')}"]
        tests += [f"{v.t} rlike {lit(f'[< ]{name}: ')}" for name in schema.get("required", [])]
        return " AND ".join(tests)

    def value_rules(self, schema: dict, v: _Value) -> list[str]:
        x, t = v.x, v.t
        rules = []
        if "type" in schema:
            names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            if not names or any(n not in TYPES for n in names):
                raise InvalidSchema(f"{schema['type']!r} is not a type")
            test = " OR ".join(v.is_type(n) for n in names)
            rules.append(f"CASE WHEN NOT ({test}) THEN concat('value is not of type ', {lit(', '.join(names))}) END")
        if "enum" in schema:
            if not isinstance(schema["enum"], list):
                raise InvalidSchema("enum is not a list")
            rules.append(self.one_of_values(schema["enum"], x, "is not one of the allowed values"))
        if "const" in schema:
            rules.append(self.one_of_values([schema["const"]], x, "is not the expected value"))
        text = f"CAST({x} AS STRING)"
        for key, test in (
            ("maxLength", f"length({text}) > "),
            ("minLength", f"length({text}) < "),
        ):
            if key in schema:
                rules.append(
                    f"CASE WHEN {t} = 'STRING' AND {test}{self.number(schema, key)} THEN 'text breaks {key}' END"
                )
        if "pattern" in schema:
            pattern = self.pattern(schema["pattern"])
            rules.append(f"CASE WHEN {t} = 'STRING' AND NOT {text} rlike {pattern} THEN 'text breaks pattern' END")
        numeric = v.is_type("number")
        value = f"try_cast({x} AS DOUBLE)"
        for key, op in (
            ("minimum", "<"),
            ("maximum", ">"),
            ("exclusiveMinimum", "<="),
            ("exclusiveMaximum", ">="),
        ):
            if key in schema:
                rules.append(
                    f"CASE WHEN {numeric} AND {value} {op} {self.number(schema, key)}D THEN 'number breaks {key}' END"
                )
        if "multipleOf" in schema:
            step = f"{self.number(schema, 'multipleOf')}D"
            rules.append(
                f"CASE WHEN {numeric} AND {value} / {step} <> floor({value} / {step})"
                " THEN 'number breaks multipleOf' END"
            )
        return rules

    def object_rules(self, schema: dict, v: _Value) -> list[str]:
        properties = schema.get("properties", {})
        patterns = schema.get("patternProperties", {})
        for key in ("properties", "patternProperties"):
            if not isinstance(schema.get(key, {}), dict):
                raise InvalidSchema(f"{key} is not an object")
        required = schema.get("required", [])
        if not isinstance(required, list) or any(not isinstance(r, str) for r in required):
            raise InvalidSchema("required is not a list of names")

        m, e = v.m, self.name()
        checks = []
        if required:
            missing = f"filter(array({lits(required)}), r -> NOT map_contains_key({m}, r))"
            checks.append(
                f"CASE WHEN size({missing}) > 0 THEN concat(array_join({missing}, ', '), ' is required') END"
            )
        for key, op in (("minProperties", "<"), ("maxProperties", ">")):
            if key in schema:
                checks.append(f"CASE WHEN size({m}) {op} {self.number(schema, key)} THEN 'object breaks {key}' END")
        for name, others in schema.get("dependentRequired", {}).items():
            lacking = " OR ".join(f"NOT map_contains_key({m}, {lit(o)})" for o in others) or "false"
            checks.append(
                f"CASE WHEN map_contains_key({m}, {lit(name)}) AND ({lacking})"
                f" THEN concat({lit(name)}, ' needs other properties') END"
            )
        if "propertyNames" in schema:
            k = self.name()
            inner = self.violation(schema["propertyNames"], f"CAST({k} AS VARIANT)")
            checks.append(first_not_null(f"transform(map_keys({m}), {k} -> {inner})"))
        entry = self.entry_rule(properties, patterns, schema.get("additionalProperties", True), e)
        if entry:
            checks.append(first_not_null(f"transform(map_entries({m}), {e} -> {entry})"))
        if not checks:
            return []
        body = checks[0] if len(checks) == 1 else f"coalesce({', '.join(checks)})"
        return [f"CASE WHEN {m} IS NOT NULL THEN {body} END"]

    def entry_rule(self, properties: dict, patterns: dict, additional: Any, e: str) -> str | None:
        """Check of one key and value; properties with the same rules share one branch."""
        same: dict[str, list[str]] = {}
        for name, sub in properties.items():
            same.setdefault(self.rule_key(sub), []).append(name)
        branches = []
        for key, names in same.items():
            inner = self.violation(json.loads(key), f"{e}.value")
            branches.append((f"{e}.key IN ({lits(names)})", f"concat({e}.key, ': ', {inner})"))
        by_pattern = []
        for pattern, sub in patterns.items():
            inner = self.violation(sub, f"{e}.value")
            by_pattern.append(
                f"CASE WHEN {e}.key rlike {self.pattern(pattern)} THEN concat({e}.key, ': ', {inner}) END"
            )
        if additional is True or additional == {}:
            rest = "CAST(NULL AS STRING)"
        elif additional is False:
            rest = f"concat({e}.key, ' is not allowed')"
        else:
            rest = f"concat({e}.key, ': ', {self.violation(additional, f'{e}.value')})"
        if patterns and rest != "CAST(NULL AS STRING)":
            named = " OR ".join(f"{e}.key rlike {self.pattern(p)}" for p in patterns)
            rest = f"CASE WHEN NOT ({named}) THEN {rest} END"
        if not branches and rest == "CAST(NULL AS STRING)":
            named_rule = None
        else:
            named_rule = if_chain(branches, rest)
        rules = ([named_rule] if named_rule else []) + by_pattern
        if not rules:
            return None
        return rules[0] if len(rules) == 1 else f"coalesce({', '.join(rules)})"

    def array_rules(self, schema: dict, v: _Value) -> list[str]:
        a, i = v.a, self.name()
        checks = []
        for key, op in (("minItems", "<"), ("maxItems", ">")):
            if key in schema:
                checks.append(f"CASE WHEN size({a}) {op} {self.number(schema, key)} THEN 'array breaks {key}' END")
        if schema.get("uniqueItems") is True:
            checks.append(
                f"CASE WHEN size(array_distinct(transform({a}, {i} -> to_json({i})))) < size({a})"
                " THEN 'array breaks uniqueItems' END"
            )
        leading = schema.get("prefixItems", [])
        for n, sub in enumerate(leading):
            checks.append(f"CASE WHEN size({a}) > {n} THEN {self.violation(sub, f'{a}[{n}]')} END")
        if "items" in schema:
            if isinstance(schema["items"], list):
                raise InvalidSchema("items is a list")
            inner = self.violation(schema["items"], i)
            rest = f"slice({a}, {len(leading) + 1}, greatest(size({a}) - {len(leading)}, 0))" if leading else a
            checks.append(first_not_null(f"transform({rest}, {i} -> {inner})"))
        if "contains" in schema:
            inner = self.violation(schema["contains"], i)
            low = schema.get("minContains", 1)
            high = schema.get("maxContains")
            n = f"size(filter({a}, {i} -> ({inner}) IS NULL))"
            test = f"{n} < {low}" + (f" OR {n} > {high}" if high is not None else "")
            checks.append(f"CASE WHEN {test} THEN 'array breaks contains' END")
        if not checks:
            return []
        body = checks[0] if len(checks) == 1 else f"coalesce({', '.join(checks)})"
        return [f"CASE WHEN {a} IS NOT NULL THEN {body} END"]

    def combined_rules(self, schema: dict, x: str) -> list[str]:
        rules = [self.violation(sub, x) for sub in schema.get("allOf", [])]
        if "anyOf" in schema:
            tests = [f"({self.violation(sub, x)}) IS NULL" for sub in schema["anyOf"]]
            rules.append(f"CASE WHEN NOT ({' OR '.join(tests)}) THEN 'no anyOf branch holds' END")
        if "oneOf" in schema:
            tests = [f"CASE WHEN ({self.violation(sub, x)}) IS NULL THEN 1 ELSE 0 END" for sub in schema["oneOf"]]
            rules.append(f"CASE WHEN {' + '.join(tests)} <> 1 THEN 'not exactly one oneOf branch holds' END")
        if "not" in schema:
            rules.append(f"CASE WHEN ({self.violation(schema['not'], x)}) IS NULL THEN 'the not branch holds' END")
        if "if" in schema:
            test = f"({self.violation(schema['if'], x)}) IS NULL"
            then = self.violation(schema.get("then", True), x)
            other = self.violation(schema.get("else", True), x)
            rules.append(f"CASE WHEN {test} THEN {then} ELSE {other} END")
        if "$ref" in schema:
            ref = schema["$ref"]
            if ref in self.open_refs:
                raise NotCompiled(f"{ref} refers to itself")
            self.open_refs.append(ref)
            rules.append(self.violation(self.resolve(ref), x))
            self.open_refs.pop()
        return rules

    def resolve(self, ref: str) -> Any:
        if not isinstance(ref, str) or not ref.startswith("#"):
            raise NotCompiled(f"{ref!r} is not a pointer")
        node = self.root
        for part in filter(None, ref[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            if not isinstance(node, dict) or part not in node:
                raise NotCompiled(f"{ref} is not a pointer to a property")
            node = node[part]
        return node

    @staticmethod
    def rule_key(schema: Any) -> str:
        """Text that is equal for schemas with the same rules; notes without effect are left out."""
        if isinstance(schema, dict):
            schema = {k: v for k, v in schema.items() if k not in ("description", "title", "examples", "format")}
        return json.dumps(schema, sort_keys=True)

    @staticmethod
    def number(schema: dict, key: str) -> str:
        value = schema[key]
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise InvalidSchema(f"{key} is not a number")
        return repr(value)

    @staticmethod
    def pattern(pattern: Any) -> str:
        try:
            re.compile(pattern)
        except (re.error, TypeError) as e:
            raise InvalidSchema(f"{pattern!r} is not a pattern") from e
        return lit(pattern)

    @staticmethod
    def one_of_values(values: list, x: str, message: str) -> str:
        # Canonical JSON text compares values without regard to key order or number spelling.
        texts = ", ".join(f"to_json(parse_json({lit(json.dumps(v))}))" for v in values)
        return f"CASE WHEN NOT to_json({x}) IN ({texts}) THEN 'value {message}' END"


def violation(document: Any, x: str) -> str:
    return _Compiler(document).violation(document, x)


def property_names(document: dict) -> list[str] | None:
    """Names of the top-level properties in order; None when the document has no properties."""
    properties = document.get("properties")
    return list(properties) if isinstance(properties, dict) else None
