"""Atomic events to wide rows: one column per context schema, and lifted fields."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import iglu
from millrace.functions.sqltext import first_not_null, let, lit
from millrace.model import ATOMIC_SCALARS


class Allowed(NamedTuple):
    vendor: str
    name: str
    version: str


class FieldTransformation(NamedTuple):
    path: str
    field: str


def parse_whitelist(names: Sequence[str]) -> list[Allowed]:
    """``[iglu:]vendor/name[/format[/version]]``; without a version any version matches."""
    allowed = []
    for name in names:
        parts = name.removeprefix("iglu:").split("/")
        if not 2 <= len(parts) <= 4:
            raise ValueError(f"{name!r} does not select a schema: vendor/name, vendor/name/format or a whole URI is needed")
        allowed.append(Allowed(parts[0], parts[1], parts[3] if len(parts) == 4 else "*"))
    return allowed


def matches_whitelist(uri: str, allowed: Sequence[Allowed] | None) -> str:
    """Whether a URI is selected; ``None`` selects every schema."""
    if allowed is None:
        return "true"
    tests = []
    for a in allowed:
        test = f"startswith({uri}, {lit(f'iglu:{a.vendor}/{a.name}/')})"
        if a.version != "*":
            test += f" AND startswith(get(split({uri}, '/'), 3), {lit(a.version)})"
        tests.append(f"({test})")
    return f"({' OR '.join(tests)})" if tests else "false"


def json_path(x: str, path: str) -> str:
    """Value at a dotted path of a VARIANT, NULL where there is none.

    A numeric segment indexes a list (from the end when negative) or names a key of an object.
    """
    for i, key in enumerate(path.split(".")):
        quoted = "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"
        step = f"variant_get({{0}}, {lit(quoted)})"
        number = key.removeprefix("-")
        if number.isdigit():
            position = int(key) + 1 if int(key) >= 0 else int(key)
            item = f"try_element_at(try_cast({{0}} AS ARRAY<VARIANT>), {position})"
            node = f"jp{i}"
            x = let(x, node, f"coalesce({step.format(node)}, {item.format(node)})")
        else:
            x = step.format(x)
    return x


def _lifted(x: str, path: str) -> str:
    """Text of the value at a path; JSON null counts as absent."""
    value = json_path(x, path)
    return let(value, "lv", "IF(lv IS NULL OR schema_of_variant(lv) = 'VOID', NULL, CAST(lv AS STRING))")


def context_columns(events: DataFrame, allowed: Sequence[Allowed] | None) -> list[str]:
    """Names of the context columns the events need, found with one distinct pass over the schema URIs."""
    uris = events.selectExpr("explode(contexts.schema) AS uri").distinct()
    names = (
        uris.where(matches_whitelist("uri", allowed)).selectExpr(f"{iglu.context_column('uri')} AS name").distinct()
    )
    return sorted(r.name for r in names.collect())  # a row per column of the result


def flatten_atomic(
    events: DataFrame,
    schema_names: Sequence[str] | None = None,
    all_schemas: bool = False,
    event_fields: Sequence[FieldTransformation] = (),
    context_fields: Sequence[FieldTransformation] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One wide row per event, as a single projection.

    ``event`` holds the event data (``{}`` when its schema is not selected); each selected context becomes a
    column named after its schema, the last of equal names winning. ``columns`` names the context columns;
    left out, they are looked up in the data. ``shred_error`` tells where two sources supply the same field.
    """
    if not all_schemas and not schema_names:
        raise ValueError("select schemas by name, or all of them")
    allowed = None if all_schemas else parse_whitelist(schema_names)
    if columns is None:
        columns = context_columns(events, allowed)
    fixed = {*ATOMIC_SCALARS, "event", "contexts"}
    for t in [*event_fields, *context_fields]:
        if t.field in fixed:
            raise ValueError(f"{t.field} is an atomic column and cannot be filled from {t.path}")

    selected = f"filter(contexts, c -> {matches_whitelist('c.schema', allowed)})"
    named = f"transform({selected}, c -> struct({iglu.context_column('c.schema')} AS k, c.data AS v))"
    # Position of a name's first context, data of its last.
    last = (
        "filter(transform(_named, (c, i) -> struct(c.k AS k, element_at(filter(_named, d -> d.k = c.k), -1).v AS v,"
        " array_position(_named.k, c.k) = i + 1 AS first)), c -> c.first)"
    )
    df = (
        events.withColumn("_named", F.expr(named))
        .withColumn("_contexts", F.expr(last))
        .withColumn("_by_name", F.expr("map_from_entries(transform(_contexts, c -> struct(c.k, c.v)))"))
        .withColumn("event", F.expr(f"IF({matches_whitelist('event.schema', allowed)}, event.data, '{{}}')"))
    )
    lifted: dict[str, list[str]] = {}
    if event_fields or context_fields:
        df = df.withColumn("_event", F.expr("try_parse_json(event)"))
        df = df.withColumn("_data", F.expr("transform(_contexts, c -> try_parse_json(c.v))"))
    repeated = []
    for t in event_fields:
        lifted.setdefault(t.field, []).append(_lifted("_event", t.path))
    for t in context_fields:
        found = first_not_null(f"transform(_data, d -> {_lifted('d', t.path)})")
        # The first context that supplies the field must be the last one looked at.
        later = (
            f"coalesce(array_position(transform(_data, d -> {_lifted('d', t.path)}"
            f" IS NOT NULL), true) BETWEEN 1 AND size(_data) - 1, false)"
        )
        earlier = lifted.get(t.field, [])
        clash = " OR ".join([f"({later})"] + [f"(size(_data) > 0 AND ({e}) IS NOT NULL)" for e in earlier])
        repeated.append(f"IF({clash}, {lit(f'{t.field} has more than one source')}, NULL)")
        lifted.setdefault(t.field, []).append(found)
    for field, sources in lifted.items():
        in_event = [_lifted("_event", t.path) for t in event_fields if t.field == field]
        for n in range(1, len(in_event)):
            clash = " OR ".join(f"({e}) IS NOT NULL" for e in in_event[:n])
            repeated.append(f"IF({clash}, {lit(f'{field} has more than one source')}, NULL)")
    error = f"coalesce({', '.join(repeated)}, NULL)" if repeated else "CAST(NULL AS STRING)"
    return df.select(
        *ATOMIC_SCALARS,
        "event",
        *[F.expr(f"coalesce({', '.join(s)}, NULL)").alias(f) for f, s in lifted.items()],
        *[F.expr(f"_by_name[{lit(c)}]").alias(c) for c in columns],
        F.expr(error).alias("shred_error"),
    )


# --- Storage types ----------------------------------------------------------------------------------

_SCALARS = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
    "any": T.StringType(),
}


def _type_of(schema: dict[str, Any]) -> T.DataType:
    kind = schema.get("type", "any")
    if isinstance(kind, list):
        kind = next(k for k in kind if k != "null")
    if kind == "string" and schema.get("format") == "date-time":
        return T.TimestampType()
    if kind == "object":
        values = schema.get("additionalProperties")
        if isinstance(values, dict):
            return T.MapType(T.StringType(), _type_of(values))
        return struct_type_for(schema)
    if kind == "array":
        return T.ArrayType(_type_of(schema.get("items", {})))
    if kind not in _SCALARS:
        raise ValueError(f"Unknown type: {kind}")
    return _SCALARS[kind]


def struct_type_for(schema: dict[str, Any]) -> T.StructType:
    """Column types of the values a JSON Schema describes."""
    return T.StructType([T.StructField(n, _type_of(s)) for n, s in schema.get("properties", {}).items()])


def typed_data(column: str, schema: dict[str, Any]) -> Column:
    """A JSON column as a typed struct."""
    return F.from_json(F.col(column), struct_type_for(schema))
