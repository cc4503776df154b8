"""The schema registry: built-in documents plus any number of schema tables.

A registry row is ``(uri, document, priority)``; the lowest priority wins per URI, after the built-in documents. The
few built-in documents are part of the plan. Registry tables stay tables, whatever their size: a job looks up the URIs
that its payloads name, by joins, and checks data against what it found.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.config import DEFAULT_VENDOR
from millrace.functions.iglu import uri_parts
from millrace.functions.jsonschema import (
    MAX_DOCUMENT_BYTES,
    NotCompiled,
    property_names,
    violation,
)
from millrace.functions.schema_checker import read_document
from millrace.functions.sqltext import case_of, if_chain, lits
from millrace.model import ATOMIC_COLUMNS, ATOMIC_REQUIRED

REGISTRY_SCHEMA = "uri string, document string, priority int"

_TRACKER_VENDOR = "com.snowplowanalytics.snowplow"
PAYLOAD_PREFIX = f"iglu:{_TRACKER_VENDOR}/payload_data/jsonschema/1"

# Fixed values of the tracker protocol: the fields a payload item may carry, all of them strings.
PAYLOAD_FIELDS = [
    "tna", "aid", "p", "dtm", "tz", "e", "tid", "eid", "tv", "duid", "nuid", "uid", "vid", "ip", "res",
    "url", "page", "refr", "fp", "ctype", "cookie", "lang",
    "f_pdf", "f_qt", "f_realp", "f_wma", "f_dir", "f_fla", "f_java", "f_gears", "f_ag",
    "cd", "ds", "cs", "vp", "mac", "pp_mix", "pp_max", "pp_miy", "pp_may",
    "ad_ba", "ad_ca", "ad_ad", "ad_uid",
    "tr_id", "tr_af", "tr_tt", "tr_tx", "tr_sh", "tr_ci", "tr_st", "tr_co", "tr_cu",
    "ti_id", "ti_sk", "ti_nm", "ti_na", "ti_ca", "ti_pr", "ti_qu", "ti_cu",
    "sa", "sn", "st", "sp", "se_ca", "se_ac", "se_la", "se_pr", "se_va",
    "ue_na", "ue_pr", "ue_px", "co", "cx", "ua", "tnuid", "stm", "sid", "ttm",
]

# The nullable string fields of the event and context schemas.
STRING_FIELDS = {
    "page_view": ["page_url", "page_title", "page_referrer"],
    "transaction": [
        "txn_id", "tr_id", "tr_af", "tr_tt", "tr_tx", "tr_sh", "tr_ci", "tr_st", "tr_co", "tr_cu",
    ],
    "transaction_item": [
        "ti_id", "ti_sk", "ti_na", "ti_nm", "ti_ca", "ti_pr", "ti_qu", "ti_cu",
    ],
    "campaign_attribution": [
        "campaign", "source", "medium", "term", "content", "network", "click_id",
    ],
    "device_info": [
        "screen_resolution", "viewport_resolution",
        "browser_family", "browser_version", "os_family", "os_version", "device_family",
    ],
}
# The integer fields of page pings, and the longest values of structured events.
PAGE_PING_FIELDS = ["pp_xoffset_min", "pp_xoffset_max", "pp_yoffset_min", "pp_yoffset_max"]
STRUCTURED_LIMITS = {"category": 150, "action": 500, "label": 500, "property": 500, "value": 500}

URI_PATTERN = "^iglu:[a-zA-Z0-9-_.]+/[a-zA-Z0-9-_]+/[a-zA-Z0-9-_]+/[0-9]+-[0-9]+-[0-9]+$"

_META = "https://json-schema.org/draft/2020-12/schema"
_TEXT = {"type": ["string", "null"]}


def _closed(properties: dict, required: Sequence[str] = ()) -> dict:
    document = {"type": "object", "properties": properties, "additionalProperties": False}
    return document | ({"required": list(required)} if required else {})


def _self_describing(closed: bool = True) -> dict:
    pair = {"schema": {"type": "string", "pattern": URI_PATTERN}, "data": {}}
    document = _closed(pair, ["schema", "data"])
    if not closed:
        del document["additionalProperties"]
    return document


def _atomic_document() -> dict:
    properties: dict = {}
    for name in ATOMIC_COLUMNS:
        nullable = name not in ATOMIC_REQUIRED
        kind = "integer" if name in ("session_idx", "domain_sessionidx") else "string"
        properties[name] = {"type": [kind, "null"] if nullable else kind}
        if name.endswith("tstamp"):
            properties[name]["format"] = "date-time"
    properties["contexts"] = {"type": "array", "items": _self_describing(closed=False)}
    properties["event"] = _self_describing()
    return {"type": "object", "properties": properties, "required": ATOMIC_REQUIRED}


def builtin_documents(vendor: str = DEFAULT_VENDOR) -> dict[str, dict]:
    """The documents every job knows, by URI."""
    payload = {
        "type": "array",
        "minItems": 1,
        "items": _closed({f: {"type": "string"} for f in PAYLOAD_FIELDS}, ["tv", "p", "e"]),
    }
    contexts = {"type": "array", "items": _self_describing()}
    structured = {
        name: {"type": "string" if name in ("category", "action") else ["string", "null"], "maxLength": limit}
        for name, limit in STRUCTURED_LIMITS.items()
    }
    events = {
        name: _closed({f: _TEXT for f in fields}, ["page_url"] if name == "page_view" else ())
        for name, fields in STRING_FIELDS.items()
    }
    events["page_ping"] = _closed({f: {"type": ["integer", "null"]} for f in PAGE_PING_FIELDS})
    events["structured_event"] = _closed(structured, ["category", "action"])
    events["atomic"] = _atomic_document()

    found = {f"iglu:{_TRACKER_VENDOR}/payload_data/jsonschema/1-0-{i}": payload for i in range(5)}
    found[f"iglu:{_TRACKER_VENDOR}/unstruct_event/jsonschema/1-0-0"] = _self_describing()
    for version in ("1-0-0", "1-0-1"):
        found[f"iglu:{_TRACKER_VENDOR}/contexts/jsonschema/{version}"] = contexts
    for name, document in events.items():
        found[f"iglu:{vendor}/{name}/jsonschema/1-0-0"] = document
    return {uri: {"$schema": _META, **document} for uri, document in found.items()}


def registry_table(spark: SparkSession, documents: dict[str, dict], priority: int = 0) -> DataFrame:
    rows = [(uri, json.dumps(document), priority) for uri, document in documents.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def read_schema_files(spark: SparkSession, path: str, priority: int = 1) -> DataFrame:
    """A directory tree ``vendor/name/jsonschema/version`` with one document per file."""
    tail = r"regexp_extract(_metadata.file_path, '([^/]+/[^/]+/[^/]+/[^/]+)$', 1)"
    return (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .text(path)
        .selectExpr(f"concat('iglu:', url_decode({tail})) AS uri", "value AS document", f"{priority} AS priority")
    )


def _union(tables: Iterable[DataFrame]) -> DataFrame:
    union = None
    for table in tables:
        table = table.select("uri", "document", "priority")
        union = table if union is None else union.unionByName(table)
    return union


def oversized(tables: Iterable[DataFrame], max_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """``(uri, bytes, priority)`` of the documents that ``resolve`` leaves out for their size."""
    return _union(tables).selectExpr("uri", "octet_length(document) AS bytes", "priority").where(F.col("bytes") > max_bytes)


def resolve(tables: Iterable[DataFrame], max_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """One document per URI: larger ones than ``max_bytes`` are left out (see ``oversized``), then the lowest priority wins.

    Of several documents with the lowest priority the first in text order is taken.
    """
    best = F.min(F.struct("priority", "document")).alias("best")
    return (
        _union(tables)
        .where(F.octet_length("document") <= max_bytes)
        .where(f"{uri_parts('uri')} IS NOT NULL")
        .groupBy("uri")
        .agg(best)
        .select("uri", F.expr(uri_parts("uri")).alias("parts"), F.col("best.document").alias("document"))
        .select("uri", "parts.*", "document")
    )


DESCRIBED = "uri string, document string, fields array<string>, is_object boolean, invalid string"


def describe(documents: DataFrame) -> DataFrame:
    """What a job needs to know of each ``(uri, document)``: its properties, whether it admits objects only, and why it is
    ill-formed, if it is."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri, text in zip(batch.column("uri").to_pylist(), batch.column("document").to_pylist()):
                checker, problem = read_document(text)
                root = checker.root if checker else {}
                rows.append({"uri": uri, "document": text, "fields": property_names(root), "is_object": root.get("type") == "object", "invalid": problem})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    out = T.StructType.fromDDL(DESCRIBED)
    schema = to_arrow_schema(out)
    return documents.select("uri", "document").mapInArrow(read, out)


class _Any:
    """Has every name."""

    def __contains__(self, name: object) -> bool:
        return True


@dataclass(frozen=True)
class Rules:
    """SQL text that checks a value against the schema named by a URI.

    ``documents`` and ``invalid`` are compiled into it. ``registry`` is a table ``(uri, document)`` of further schemas, and
    ``extra`` are documents that could not be compiled; a job with either of them (``looks_up``) has a column ``reg`` with
    those that a payload names, and the text refers to it.
    """

    documents: dict[str, dict]
    invalid: dict[str, str]
    extra: dict[str, dict] = field(default_factory=dict)
    registry: DataFrame | None = None

    @classmethod
    def compile(cls, documents: dict[str, object], registry: DataFrame | None = None) -> Rules:
        valid, invalid, extra = {}, {}, {}
        for uri, document in documents.items():
            _, problem = read_document(json.dumps(document))
            try:
                if problem is None:
                    violation(document, "x")
                    valid[uri] = document
            except NotCompiled:
                extra[uri] = document
            except ValueError as e:
                problem = str(e)
            if problem is not None:
                invalid[uri] = problem
        return cls(valid, invalid, extra, registry)

    @property
    def looks_up(self) -> bool:
        return bool(self.extra) or self.registry is not None

    def lookup_table(self, spark: SparkSession) -> DataFrame:
        """``(uri, document)`` of all schemas that are not compiled."""
        tables = [self.registry.select("uri", "document")] if self.registry is not None else []
        if self.extra:
            tables.append(registry_table(spark, self.extra).select("uri", "document"))
        return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])

    @cached_property
    def known(self) -> list[str]:
        return [*self.documents, *self.invalid]

    @cached_property
    def _same_rules(self) -> list[tuple[list[str], dict]]:
        same: dict[str, list[str]] = {}
        for uri, document in self.documents.items():
            rules = {k: v for k, v in document.items() if k not in ("$schema", "self", "description")}
            same.setdefault(json.dumps(rules, sort_keys=True), []).append(uri)
        return [(uris, json.loads(rules)) for rules, uris in same.items()]

    def violation(self, uri: str, x: str) -> str:
        """First broken rule of ``x`` under the schema ``uri``; NULL when valid or when the URI is unknown."""
        return if_chain(
            [(f"{uri} IN ({lits(uris)})", violation(document, x)) for uris, document in self._same_rules],
            "CAST(NULL AS STRING)",
        )

    def implies_object(self, uri: str) -> str:
        """Whether the schema itself only admits objects."""
        uris = [u for u, d in self.documents.items() if d.get("type") == "object"]
        compiled = f"coalesce({uri} IN ({lits(uris)}), false)" if uris else "false"
        return f"({compiled} OR coalesce(reg[{uri}].is_object, false))" if self.looks_up else compiled

    def fields(self, uri: str) -> str:
        """Property names of the schema; NULL when it is unknown or has no properties."""
        branches = []
        for uris, document in self._same_rules:
            names = property_names(document)
            if names is not None:
                listed = f"array({lits(names)})" if names else "CAST(array() AS ARRAY<STRING>)"
                branches.append((f"{uri} IN ({lits(uris)})", listed))
        return if_chain(branches, f"reg[{uri}].fields" if self.looks_up else "CAST(NULL AS ARRAY<STRING>)")

    @cached_property
    def property_names(self) -> set[str] | _Any:
        """Every top-level property of any schema an event can be built for."""
        if self.looks_up:
            return _Any()
        atomic = [d for u, d in self.documents.items() if u.split("/")[1] == "atomic"]
        return {n for d in self.documents.values() if d not in atomic for n in property_names(d) or []}

    def is_usable(self, uri: str) -> str:
        compiled = f"coalesce({uri} IN ({lits(self.documents)}), false)" if self.documents else "false"
        found = f"coalesce(map_contains_key(reg, {uri}) AND reg[{uri}].invalid IS NULL, false)"
        return f"({compiled} OR {found})" if self.looks_up else compiled

    def is_known(self, uri: str) -> str:
        compiled = f"coalesce({uri} IN ({lits(self.known)}), false)" if self.known else "false"
        return f"({compiled} OR coalesce(map_contains_key(reg, {uri}), false))" if self.looks_up else compiled

    def invalid_reason(self, uri: str) -> str:
        return case_of(uri, {u: lits([r]) for u, r in self.invalid.items()}, f"reg[{uri}].invalid" if self.looks_up else "CAST(NULL AS STRING)")


def load_rules(spark: SparkSession, tables: Sequence[DataFrame] = (), vendor: str = DEFAULT_VENDOR) -> Rules:
    """The built-in documents, and the given registry tables by look-up. A built-in document comes before any table's."""
    builtin = builtin_documents(vendor)
    if not tables:
        return Rules.compile(builtin)
    return Rules.compile(builtin, resolve(tables).where(~F.col("uri").isin(list(builtin))).select("uri", "document"))
