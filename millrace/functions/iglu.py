"""Schema URIs of the form ``iglu:vendor/name/format/version``."""

from __future__ import annotations

import re

from millrace.functions.sqltext import case_of, let, lit

# Tracker event codes and the event schemas they stand for.
EVENT_CODES = {
    "pv": "page_view",
    "pp": "page_ping",
    "se": "structured_event",
    "tr": "transaction",
    "ti": "transaction_item",
}


def builtin_uri(vendor: str, name: str) -> str:
    return f"iglu:{vendor}/{name}/jsonschema/1-0-0"


def schema_for_code(x: str, vendor: str) -> str:
    """URI for a tracker event code; NULL for an unknown code."""
    return case_of(x, {code: lit(builtin_uri(vendor, name)) for code, name in EVENT_CODES.items()})


def uri_parts(x: str) -> str:
    """``struct<vendor, name, format, version>``, NULL when the URI is malformed."""
    return let(
        f"split(substring({x}, 6), '/')",
        "up",
        f"CASE WHEN {uri_problem(x)} IS NULL THEN"
        " struct(up[0] AS vendor, up[1] AS name, up[2] AS format, up[3] AS version) END",
    )


def uri_problem(x: str) -> str:
    """Why a URI is malformed, or NULL."""
    return let(
        f"split(substring({x}, 6), '/')",
        "pp",
        f"CASE WHEN NOT startswith({x}, 'iglu:') THEN 'Invalid schema - only supporting iglu schemas'"
        f" WHEN size(pp) <> 4 THEN concat('Invalid schema path: ', substring({x}, 6))"
        " WHEN pp[2] <> 'jsonschema' THEN concat('Invalid schema format: ', pp[2]) END",
    )


def snake_case(x: str) -> str:
    return f"lower(regexp_replace({x}, '([^A-Z_])([A-Z])', '$1_$2'))"


def context_column(x: str) -> str:
    """Column name of a context: ``context_<vendor>_<name>_<model>``."""
    return let(
        f"split(substring({x}, 6), '/')",
        "cc",
        "concat('context_', lower(replace(cc[0], '.', '_')), '_', "
        + snake_case("get(cc, 1)")
        + ", '_', split(get(cc, 3), '-')[0])",
    )


def context_column_name(uri: str) -> str:
    """The same name worked out while building a plan."""
    found = re.fullmatch(r"iglu:([^/]*)/([^/]*)/jsonschema/([^/-]*)[^/]*", uri)
    if not found:
        raise ValueError(f"{uri!r} names no JSON schema")
    vendor, name, model = found.groups()
    snake = re.sub("(?<=[^A-Z_])(?=[A-Z])", "_", name)
    return "_".join(["context", vendor.replace(".", "_").lower(), snake.lower(), model])
