"""Query strings, JSON, base64 and the scalar casts applied to tracker fields."""

from __future__ import annotations

from millrace.functions.sqltext import let

_END = "~end~"

# Milliseconds of the first and the last instant a timestamp column can hold (years 1 to 9999).
MIN_MILLIS = -62135596800000
MAX_MILLIS = 253402300799999


def url_decode(x: str) -> str:
    """Percent decoding with ``+`` as space; a ``%`` not followed by two hex digits stays as it is."""
    return (
        f"CASE WHEN contains({x}, '%')"
        f" THEN try_url_decode(regexp_replace({x}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"
        f" ELSE translate({x}, '+', ' ') END"
    )


def _query_pairs(x: str, condition: str) -> str:
    return (
        f"transform(filter(transform(split({x}, '&'), p -> split(p, '=', 2)), p -> {condition}),"
        f" p -> struct({url_decode('p[0]')} AS k, {url_decode('p[1]')} AS v))"
    )


def parse_qs(x: str) -> str:
    """``a=1&b=2`` as a map. Pairs without ``=`` or with a blank value are dropped, the first key wins."""
    body = (
        "CASE WHEN size(array_distinct(qs.k)) = size(qs) THEN map_from_entries(qs)"
        " ELSE map_from_entries(filter(qs, (p, i) -> array_position(qs.k, p.k) = i + 1)) END"
    )
    return let(_query_pairs(x, "size(p) = 2 AND length(p[1]) > 0"), "qs", body)


def query_param(x: str, name: str) -> str:
    """One parameter as the collector reads it: the last occurrence counts and may be blank."""
    pairs = _query_pairs(x, "size(p) = 2")
    return f"try_element_at(filter({pairs}, p -> p.k = '{name}').v, -1)"


def merge_maps(low: str, high: str) -> str:
    """Union of two maps; a key found in both takes the value of ``high``."""
    return f"map_concat(map_filter({low}, (k, v) -> NOT map_contains_key({high}, k)), {high})"


def strict_json(x: str) -> str:
    """Parse one JSON text to a VARIANT; NULL when it is malformed or followed by anything else.

    The text is parsed as the first element of an array whose second element is a known end mark, so
    text that closes early never reaches the mark.
    """
    wrapped = f"try_parse_json(concat('[', {x}, ',\"{_END}\"]'))"
    body = f"CASE WHEN try_variant_get(js, '$[1]', 'string') = '{_END}' THEN variant_get(js, '$[0]') END"
    return let(wrapped, "js", body)


def base64_text(x: str, urlsafe: bool = False) -> str:
    """Base64 to text. Padding may be missing and characters outside the alphabet are skipped."""
    if urlsafe:
        x = f"translate({x}, '-_', '+/')"
    lenient = let(
        f"regexp_replace({x}, '[^A-Za-z0-9+/]', '')",
        "b6",
        "try_to_binary(rpad(b6, CAST(ceil(length(b6) / 4) * 4 AS INT), '='), 'base64')",
    )
    return f"try_validate_utf8(CAST(coalesce(try_to_binary({x}, 'base64'), {lenient}) AS STRING))"


def base64_json(x: str, urlsafe: bool = False) -> str:
    return let(base64_text(x, urlsafe), "bt", strict_json("bt"))


def to_int(x: str) -> str:
    """Integer text (sign, surrounding blanks and ``_`` between digits allowed) to BIGINT, else NULL."""
    return (
        f"IF({x} IS NULL, NULL, IF({x} rlike '^\\\\s*[+-]?[0-9]+(_[0-9]+)*\\\\s*$',"
        f" try_cast(regexp_replace({x}, '[_\\\\s]', '') AS BIGINT), NULL))"
    )


def to_float(x: str) -> str:
    """Float text, including ``nan``, ``inf`` and ``_`` between digits, to DOUBLE, else NULL."""
    number = r"^[+-]?([0-9]+(_[0-9]+)*\\.?([0-9]+(_[0-9]+)*)?|\\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
    word = "lower(trim(%s))" % x
    return (
        f"CASE WHEN trim({x}) rlike '{number}' THEN try_cast(replace(trim({x}), '_', '') AS DOUBLE)"
        f" WHEN {word} rlike '^[+-]?(inf|infinity|nan)$' THEN try_cast("
        f"CASE WHEN {word} LIKE '%nan' THEN 'NaN' WHEN {word} LIKE '-%' THEN '-Infinity' ELSE 'Infinity' END"
        " AS DOUBLE) END"
    )


def millis_to_timestamp(n: str) -> str:
    """Epoch milliseconds to TIMESTAMP; NULL outside years 1 to 9999."""
    return f"CASE WHEN {n} BETWEEN {MIN_MILLIS} AND {MAX_MILLIS} THEN timestamp_millis({n}) END"


def to_tstamp(x: str) -> str:
    return let(to_int(x), "ms", millis_to_timestamp("ms"))


def to_boolean(x: str) -> str:
    return f"{x} = '1'"


def to_string(x: str) -> str:
    return x


def lenient_timestamp(x: str) -> str:
    """ISO-8601 text, or a number of epoch seconds (milliseconds when large), to TIMESTAMP."""
    number = let(
        f"try_cast({x} AS DOUBLE)",
        "ep",
        "CASE WHEN abs(ep) <= 20000000000 THEN timestamp_micros(CAST(round(ep * 1000000) AS BIGINT))"
        f" WHEN ep BETWEEN {MIN_MILLIS} AND {MAX_MILLIS} THEN timestamp_micros(CAST(round(ep * 1000) AS BIGINT)) END",
    )
    return (
        f"CASE WHEN {x} rlike '^[+-]?[0-9.]+$' THEN {number}"
        f" WHEN {x} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' THEN try_cast({x} AS TIMESTAMP) END"
    )


def iso_utc(ts: str) -> str:
    """ISO-8601 in UTC with ``Z``; microseconds only when there are any."""
    pattern = r"yyyy-MM-dd\'T\'HH:mm:ss"
    return (
        f"concat(date_format({ts}, '{pattern}'),"
        f" CASE WHEN unix_micros({ts}) % 1000000 = 0 THEN '' ELSE date_format({ts}, '.SSSSSS') END, 'Z')"
    )
