"""Error values carried on a row, and the dead-letter table built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.iglu import uri_problem
from millrace.functions.sqltext import case_of, if_chain, let, lit
from millrace.model import RAW_COLUMNS
from millrace.sources.registry import Rules

ERROR_TYPE = "STRUCT<kind: STRING, msg: STRING>"
NO_ERROR = f"CAST(NULL AS {ERROR_TYPE})"

# How the reason of each kind of error starts.
REASON_PREFIX = {
    "not_found": "schema not found: ",
    "validation": "data validation error: ",
    "invalid_schema": "invalid schema: ",
    "value": "invalid event data: ",
    "unprocessable": "unprocessable payload: ",
    "too_large": "payload too large: ",
}
UNKNOWN_DOMAIN = "unknown"


def error(kind: str, msg: str) -> str:
    """``msg`` is SQL text."""
    return f"named_struct('kind', '{kind}', 'msg', {msg})"


def value_error(msg: str) -> str:
    return error("value", lit(msg))


def uri_error(rules: Rules, uri: str) -> str:
    """Error of looking up a schema: malformed URI, unknown schema or malformed document."""
    invalid = rules.invalid_reason(uri)
    checks = let(
        uri_problem(uri),
        "why",
        f"CASE WHEN why IS NOT NULL THEN {error('value', 'why')}"
        f" ELSE {error('not_found', f'concat({lit('Schema not found in any registry: ')}, {uri})')} END",
    )
    return if_chain(
        [
            (rules.is_usable(uri), NO_ERROR),
            (f"{uri} IS NULL", error("unprocessable", lit("schema is not a text"))),
            (f"NOT {rules.is_known(uri)}", checks),
        ],
        error("invalid_schema", f"concat({lit('Invalid Schema: ')}, {invalid})"),
    )


def violation_error(rules: Rules, uri: str, x: str, found: str = "") -> str:
    """Error of checking ``x`` against its schema; ``found`` is what the check as data said, if there was one."""
    compiled = rules.violation(uri, x)
    return let(
        f"coalesce({compiled}, {found})" if found else compiled,
        "bad",
        f"CASE WHEN bad IS NOT NULL THEN {error('validation', f'concat({lit('Failed to validate ')}, {uri}, {lit(': ')}, bad)')} END",
    )


def reason(err: str) -> str:
    prefixes = {kind: lit(prefix) for kind, prefix in REASON_PREFIX.items()}
    return f"concat({case_of(f'{err}.kind', prefixes, lit(''))}, {err}.msg)"


def raw_as_json(prefix: str = "") -> str:
    """The raw record as one JSON object with nulls kept.

    The body appears as text; one that is not UTF-8 as base64, which ``body_encoding`` then says.
    """

    def record(body: str, more: str = "") -> str:
        fields = ", ".join(f"{body} AS body" if c == "body" else f"{prefix}{c} AS {c}" for c in RAW_COLUMNS)
        return f"to_json(struct({fields}{more}), map('ignoreNullFields', 'false'))"

    text = f"CAST({prefix}body AS STRING)"
    encoded = record(f"base64({prefix}body)", ", 'base64' AS body_encoding")
    return f"IF({prefix}body IS NULL OR is_valid_utf8({text}), {record(text)}, {encoded})"


def to_errors(df: DataFrame, err: str = "err") -> DataFrame:
    """Dead-letter rows ``(collector_domain, reason, tstamp, payload)`` plus the kind of error."""
    return df.where(f"{err} IS NOT NULL").selectExpr(
        f"coalesce(hostname, '{UNKNOWN_DOMAIN}') AS collector_domain",
        f"{reason(err)} AS reason",
        "current_timestamp() AS tstamp",
        f"CAST({raw_as_json()} AS BINARY) AS payload",
        f"{err}.kind AS error_kind",
    )


def undecodable_to_errors(df: DataFrame, err: str = "err", value: str = "value") -> DataFrame:
    """Dead-letter rows of messages that are not a raw record."""
    return df.where(f"{err} IS NOT NULL").selectExpr(
        f"'{UNKNOWN_DOMAIN}' AS collector_domain",
        f"concat('cannot decode message: ', {err}) AS reason",
        "current_timestamp() AS tstamp",
        f"{value} AS payload",
        "'undecodable' AS error_kind",
    )


def outcome_counts(processed: DataFrame, undecodable: DataFrame | None = None) -> DataFrame:
    """Payloads fully processed and payloads in error, counting undecodable messages as errors."""
    flags = processed.selectExpr("err IS NULL AS ok")
    if undecodable is not None:
        flags = flags.unionByName(undecodable.selectExpr("false AS ok"))
    return flags.agg(F.expr("count_if(ok)").alias("success"), F.expr("count_if(NOT ok)").alias("error"))
