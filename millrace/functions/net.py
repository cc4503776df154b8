"""IP addresses, URLs, headers, routes and user agents."""

from __future__ import annotations

import re

from millrace.functions.sqltext import if_chain, let, lit, lits
from millrace.functions.text import query_param

# --- IP addresses -----------------------------------------------------------------------------------

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4_PATTERN = rf"^({_OCTET}\\.){{3}}{_OCTET}$"


def first_ip(x: str) -> str:
    """Keep the first address of a comma separated list, without brackets; a single address is untouched."""
    return f"CASE WHEN contains({x}, ',') THEN translate(split({x}, ',')[0], '[]', '') ELSE {x} END"


def redact_ip(x: str) -> str:
    """The first three dotted parts followed by ``x``."""
    return rf"concat_ws('.', concat(slice(split({x}, '\\.'), 1, 3), array('x')))"


def ipv4_hex(x: str) -> str:
    return rf"upper(array_join(transform(split({x}, '\\.'), o -> lpad(hex(CAST(o AS BIGINT)), 2, '0')), ''))"


def _ipv6_groups(x: str) -> str:
    # An embedded IPv4 tail becomes two hex groups, then '::' is filled up to eight groups.
    tail = let(
        f"regexp_extract({x}, '([0-9.]+)$', 1)",
        "v4",
        f"CASE WHEN v4 rlike '{IPV4_PATTERN}' THEN "
        + let(
            ipv4_hex("v4"),
            "h4",
            f"concat(substring({x}, 1, length({x}) - length(v4)), substring(h4, 1, 4), ':', substring(h4, 5, 4))",
        )
        + f" ELSE {x} END",
    )
    text = f"CASE WHEN contains({x}, '.') THEN {tail} ELSE {x} END"
    sides = "transform(split(t6, '::', 2), s -> filter(split(s, ':', -1), g -> length(s) > 0))"
    fill = (
        "CASE WHEN size(s6) = 1 THEN s6[0]"
        " WHEN size(s6[0]) + size(s6[1]) < 8"
        " THEN concat(s6[0], array_repeat('0', 8 - size(s6[0]) - size(s6[1])), s6[1]) END"
    )
    return let(text, "t6", let(sides, "s6", fill))


def ip_key(x: str) -> str:
    """A sortable text key: ``4:`` or ``6:`` followed by the address in hex. NULL for a malformed address."""
    v6 = let(
        _ipv6_groups(f"split({x}, '%', 2)[0]"),
        "g6",
        "CASE WHEN size(g6) = 8 AND forall(g6, g -> g rlike '^[0-9A-Fa-f]{1,4}$')"
        " THEN concat('6:', array_join(transform(g6, g -> upper(lpad(g, 4, '0'))), '')) END",
    )
    return (
        f"CASE WHEN {x} rlike '{IPV4_PATTERN}' THEN concat('4:', {ipv4_hex(x)})"
        f" WHEN contains({x}, ':') THEN {v6} END"
    )


def is_ip(x: str) -> str:
    return f"({ip_key(x)}) IS NOT NULL"


# --- URLs -------------------------------------------------------------------------------------------

def url_query(x: str) -> str:
    """The part between ``?`` and ``#``, or an empty text."""
    return f"regexp_extract({x}, '^[^#?]*\\\\?([^#]*)', 1)"


def redirect_target(querystring: str) -> str:
    """The ``u`` parameter when it carries a URL scheme, else NULL."""
    return let(
        query_param(querystring, "u"),
        "ut",
        "CASE WHEN ut rlike '^[A-Za-z][A-Za-z0-9+.-]*:' THEN ut END",
    )


def route(path: str) -> str:
    """``struct<endpoint, vendor>`` for a collector path; both NULL when no endpoint matches."""
    vendor = f"nullif(regexp_extract({path}, '^/([^/]+)/(tp2|v1|i|r)$', 1), '')"
    endpoint = (
        f"CASE WHEN {path} = '/i' THEN 'pixel' WHEN {path} = '/event' THEN 'event'"
        f" WHEN {path} IN ('/r', '/r/tp2') THEN 'redirect'"
        f" WHEN {path} rlike '^/[^/]+/tp2$' THEN 'tracker' WHEN {path} rlike '^/[^/]+/v1$' THEN 'iglu'"
        f" WHEN {path} rlike '^/[^/]+/i$' THEN 'pixel' WHEN {path} rlike '^/[^/]+/r$' THEN 'redirect' END"
    )
    return f"struct({endpoint} AS endpoint, CASE WHEN {path} <> '/r/tp2' THEN {vendor} END AS vendor)"


# --- Headers ----------------------------------------------------------------------------------------

# Request headers never stored, and those dropped for anonymous requests.
DROPPED_HEADERS = ["remote-address", "raw-request-uri", "timeout-access"]
ANONYMOUS_DROPPED_HEADERS = ["cookie", "x-forwarded-for", "x-real-ip"]
ANONYMOUS_USER_ID = "00000000-0000-0000-0000-000000000000"


def header_value(headers: str, name: str) -> str:
    """Value of the first header with this name; names compare without case."""
    return (
        f"trim(get(split(try_element_at(filter({headers}, h -> lower(split(h, ':', 2)[0]) = {lit(name)}), 1),"
        " ':', 2), 1))"
    )


def is_anonymous(headers: str) -> str:
    return (
        f"exists(coalesce({headers}, array()), h -> lower(split(h, ':', 2)[0]) IN ('sp-anonymous', 'anonymous')"
        " AND length(trim(substring(h, length(split(h, ':', 2)[0]) + 2))) > 0)"
    )


def filter_headers(headers: str, anonymous: str) -> str:
    """Drop transport headers, and identifying ones for anonymous requests; write ``name: value``."""
    return (
        f"transform(filter({headers}, h -> NOT lower(split(h, ':', 2)[0]) IN ({lits(DROPPED_HEADERS)})"
        f" AND NOT ({anonymous} AND lower(split(h, ':', 2)[0]) IN ({lits(ANONYMOUS_DROPPED_HEADERS)}))),"
        " h -> concat(split(h, ':', 2)[0], ': ', trim(substring(h, length(split(h, ':', 2)[0]) + 2))))"
    )


def headers_map(headers: str) -> str:
    """Header lines as a map; the last duplicate wins and lines without ``:`` are skipped."""
    pairs = (
        f"transform(filter({headers}, h -> contains(h, ':')),"
        " h -> struct(trim(split(h, ':', 2)[0]) AS k, trim(split(h, ':', 2)[1]) AS v))"
    )
    return let(
        pairs,
        "hp",
        "map_from_entries(filter(hp, (p, i) -> NOT array_contains(slice(hp.k, i + 2, size(hp)), p.k)))",
    )


def cookie_value(headers: str, name: str) -> str:
    escaped = re.sub(r"([^A-Za-z0-9_])", r"\\\1", name)
    pattern = f"(?:^|.*;)\\s*{escaped}=([^;]*)"
    return f"nullif(regexp_extract({header_value(headers, 'cookie')}, {lit(pattern)}, 1), '')"


def network_user_id(anonymous: str, querystring: str, cookie: str) -> str:
    return (
        f"CASE WHEN {anonymous} THEN '{ANONYMOUS_USER_ID}'"
        f" ELSE coalesce(nullif({query_param(querystring, 'nuid')}, ''), {cookie}, uuid()) END"
    )


# --- User agents ------------------------------------------------------------------------------------

# Ordered rules (family, texts that must all occur, pattern of the major version); the first match wins.
BROWSERS = [
    ("Googlebot", ["Googlebot/"], r"Googlebot/(\d+)"),
    ("bingbot", ["bingbot/"], r"bingbot/(\d+)"),
    ("AhrefsBot", ["AhrefsBot/"], r"AhrefsBot/(\d+)"),
    ("Python Requests", ["python-requests/"], r"python-requests/(\d+)"),
    ("curl", ["curl/"], r"curl/(\d+)"),
    ("okhttp", ["okhttp/"], r"okhttp/(\d+)"),
    ("Edge Mobile", ["EdgA/"], r"EdgA/(\d+)"),
    ("Edge Mobile", ["EdgiOS/"], r"EdgiOS/(\d+)"),
    ("Edge", ["Edg/"], r"Edg/(\d+)"),
    ("Edge", ["Edge/"], r"Edge/(\d+)"),
    ("Opera Mobile", ["OPR/", "Mobile"], r"OPR/(\d+)"),
    ("Opera", ["OPR/"], r"OPR/(\d+)"),
    ("Samsung Internet", ["SamsungBrowser/"], r"SamsungBrowser/(\d+)"),
    ("Firefox iOS", ["FxiOS/"], r"FxiOS/(\d+)"),
    ("Firefox Mobile", ["Firefox/", "Mobile;"], r"Firefox/(\d+)"),
    ("Firefox", ["Firefox/"], r"Firefox/(\d+)"),
    ("Chrome Mobile iOS", ["CriOS/"], r"CriOS/(\d+)"),
    ("HeadlessChrome", ["HeadlessChrome/"], r"HeadlessChrome/(\d+)"),
    ("Chrome Mobile WebView", ["; wv)", "Chrome/"], r"Chrome/(\d+)"),
    ("Chrome Mobile", ["Chrome/", "Mobile"], r"Chrome/(\d+)"),
    ("Chrome", ["Chrome/"], r"Chrome/(\d+)"),
    ("Mobile Safari", ["Safari/", "Version/", "Mobile/"], r"Version/(\d+)"),
    ("Safari", ["Safari/", "Version/"], r"Version/(\d+)"),
    ("IE", ["MSIE "], r"MSIE (\d+)"),
    ("IE", ["Trident/", "rv:"], r"rv:(\d+)"),
]

SYSTEMS = [
    ("Windows Phone", ["Windows Phone"], r"Windows Phone (?:OS )?(\d+)"),
    ("iOS", ["iPhone OS "], r"iPhone OS (\d+)"),
    ("iOS", ["iPad", "CPU OS "], r"CPU OS (\d+)"),
    ("Android", ["Android"], r"Android (\d+)"),
    ("Windows", ["Windows NT 10.0"], "10"),
    ("Windows", ["Windows NT 6.3"], "8"),
    ("Windows", ["Windows NT 6.2"], "8"),
    ("Windows", ["Windows NT 6.1"], "7"),
    ("Windows", ["Windows NT 6.0"], "Vista"),
    ("Windows", ["Windows NT 5.1"], "XP"),
    ("Mac OS X", ["Mac OS X"], r"Mac OS X (\d+)"),
    ("Chrome OS", ["CrOS "], r"CrOS \S+ (\d+)"),
    ("Ubuntu", ["Ubuntu"], r"Ubuntu/(\d+)"),
    ("Linux", ["Linux"], r"Linux (\d+)"),
]

BOT_MARKS = ["Googlebot/", "bingbot/", "AhrefsBot/"]


def _matches(ua: str, texts: list[str]) -> str:
    return " AND ".join(f"contains({ua}, {lit(t)})" for t in texts)


def _first_rule(ua: str, rules: list[tuple[str, list[str], str]]) -> str:
    """``struct<family, major>`` of the first rule that matches."""

    def found(family: str, pattern: str) -> str:
        version = f"nullif(regexp_extract({ua}, {lit(pattern)}, 1), '')" if "(" in pattern else lit(pattern)
        return f"named_struct('family', {lit(family)}, 'major', {version})"

    return if_chain(
        [(_matches(ua, texts), found(family, pattern)) for family, texts, pattern in rules],
        "named_struct('family', 'Other', 'major', CAST(NULL AS STRING))",
    )


def browser(ua: str) -> str:
    return _first_rule(ua, BROWSERS)


def operating_system(ua: str) -> str:
    return _first_rule(ua, SYSTEMS)


def device_family(ua: str) -> str:
    bots = " OR ".join(f"contains({ua}, {lit(t)})" for t in BOT_MARKS)
    model = f"trim(regexp_extract({ua}, 'Android [^;)]*; ([^;)]+?)(?: Build/[^;)]*)?[;)]', 1))"
    return (
        f"CASE WHEN {bots} THEN 'Spider' WHEN contains({ua}, 'iPhone') THEN 'iPhone'"
        f" WHEN contains({ua}, 'iPad') THEN 'iPad'"
        f" WHEN {ua} rlike 'Android [^;)]*; Tablet' THEN 'Generic Tablet'"
        f" WHEN contains({ua}, 'Android') THEN coalesce(nullif(nullif({model}, ''), 'Mobile'), 'Generic Smartphone')"
        f" WHEN contains({ua}, 'Macintosh') THEN 'Mac' ELSE 'Other' END"
    )


def user_agent_info(ua: str) -> str:
    """Families and major versions as a map, NULL when nothing about the agent is recognised."""
    parts = f"named_struct('b', {browser('ua0')}, 's', {operating_system('ua0')}, 'd', {device_family('ua0')})"
    body = (
        "IF(uf.b.family <> 'Other' OR uf.s.family <> 'Other' OR uf.d <> 'Other', map("
        "'browser_family', uf.b.family, 'browser_version', uf.b.major,"
        " 'os_family', uf.s.family, 'os_version', uf.s.major, 'device_family', uf.d), NULL)"
    )
    return let(ua, "ua0", f"IF(ua0 IS NULL, NULL, {let(parts, 'uf', body)})")
