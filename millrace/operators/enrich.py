"""The enrichment job: raw payloads in, atomic events and errors out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.functions.sqltext import first_not_null, lit
from millrace.model import ATOMIC, ATOMIC_COLUMNS, RAW_COLUMNS
from millrace.operators import extract
from millrace.operators.agents import with_agents
from millrace.operators.auth import with_auth_subject
from millrace.operators.errors import NO_ERROR, error, to_errors, value_error
from millrace.operators.geo import with_geo, without_geo
from millrace.operators.lookup import lookup_join
from millrace.operators.schemas import with_registry
from millrace.sources.registry import Rules



@dataclass(frozen=True)
class Enrichment:
    """A custom step on every candidate event, before the verdict on its payload.

    All values are SQL text; ``it`` is the event with its atomic fields, and the columns of the payload are there too.
    Address lookups and the processing time come later. Steps run in the order they are listed, each on what the one
    before left, and not on events that already failed.
    """

    values: Mapping[str, str] = field(default_factory=dict)  # atomic field: new value
    contexts: Mapping[str, str] = field(default_factory=dict)  # schema: data as JSON text, NULL for no context
    event: str | None = None  # new event data as JSON text
    reject: str | None = None  # message that fails the payload, NULL for none

    def __post_init__(self) -> None:
        fixed = {"contexts", "event", "etl_tstamp", "geo_country", "geo_region", "geo_city"}
        wrong = sorted(set(self.values) - (set(ATOMIC_COLUMNS) - fixed))
        if wrong:
            raise KeyError(f"a step cannot set {', '.join(wrong)}: only plain atomic fields")


def context_data(uri: str) -> str:
    """Data of the event's context of a schema as JSON text, for use in a step; NULL without one."""
    return f"try_element_at(filter(it.contexts, c -> c.schema = {lit(uri)}), 1).data"


def with_enrichments(df: DataFrame, steps: Sequence[Enrichment]) -> DataFrame:
    """Run the steps on ``items``. A context that the event already has, or a message, becomes the event's error."""
    for step in steps:
        names = df.schema["items"].dataType.elementType.names
        ok = "it.err IS NULL"
        new = {n: f"IF({ok}, CAST({sql} AS {ATOMIC[n].dataType.simpleString()}), {f'it.{n}' if n in names else 'NULL'})" for n, sql in step.values.items()}
        if step.event is not None:
            new["event"] = f"IF({ok}, named_struct('schema', it.event.schema, 'data', CAST({step.event} AS STRING)), it.event)"
        clashes = [f"IF(({sql}) IS NOT NULL AND array_contains(it.contexts.schema, {lit(uri)}), {value_error(f'Context {uri} already exists')}, NULL)" for uri, sql in step.contexts.items()]
        rejected = [f"IF(({step.reject}) IS NOT NULL, {error('value', f'CAST({step.reject} AS STRING)')}, NULL)"] if step.reject else []
        if step.contexts:
            added = ", ".join(f"IF(({sql}) IS NOT NULL, named_struct('schema', {lit(uri)}, 'data', CAST({sql} AS STRING)), NULL)" for uri, sql in step.contexts.items())
            new["contexts"] = f"IF({ok}, concat(it.contexts, array_compact(array({added}))), it.contexts)"
        new["err"] = f"coalesce(it.err, {', '.join([*rejected, *clashes, NO_ERROR])})"
        df = extract.rebuilt(df, [n for n in names if n not in new], new)
    return df


@dataclass(frozen=True)
class Dimensions:
    """Reference tables of a job; every one is optional."""

    geo_ranges: DataFrame | None = None  # start_ip, end_ip, country, region, city
    host_config: DataFrame | None = None  # hostname, enable_full_ip, enable_cookies
    issuer_keys: DataFrame | None = None  # issuer, issuer_key
    agent_rules: DataFrame | None = None  # kind, ord, pattern, family, major; without it the built-in rules count
    enrichments: Sequence[Enrichment] = field(default_factory=tuple)


def with_host_config(df: DataFrame, host_config: DataFrame | None, config: PipelineConfig) -> DataFrame:
    """Add ``full_ip``: whether the host keeps whole addresses. Hosts without a setting, or with several of which one
    says no, do not."""
    if host_config is None:
        return df.withColumn("full_ip", F.lit(False))
    settings = host_config.groupBy("hostname").agg(F.min("enable_full_ip").alias("_full"))
    joined = lookup_join(df, settings, ["hostname"], config)
    return joined.withColumn("full_ip", F.expr("coalesce(_full, false)")).drop("_full")


def process_raw(
    raw: DataFrame, config: PipelineConfig, rules: Rules, dims: Dimensions = Dimensions()
) -> DataFrame:
    """One row per payload: the raw columns, ``items`` (its candidate events) and ``err``."""
    df = raw.select(*RAW_COLUMNS)
    df = with_host_config(df, dims.host_config, config)
    if config.auth_enabled:
        df = with_auth_subject(df, config, dims.issuer_keys)
    else:
        df = df.withColumn("collector_auth", F.lit(None).cast("string"))
    df = extract.with_params(df, config)
    if rules.looks_up:
        df = with_registry(df, rules, config)
    df = extract.with_items(df, rules)
    agents = config.device_enabled and dims.agent_rules is not None
    if agents:
        df = with_agents(df, dims.agent_rules, config)
    df = extract.with_schema(df, config)
    df = extract.with_event_data(df, rules, config)
    df = extract.with_contexts(df, rules)
    df = extract.with_derived_contexts(df, config, agents)
    df = extract.with_atomic(df, config)
    df = with_enrichments(df, dims.enrichments)
    first_item_error = first_not_null("items.err")
    return df.select(*RAW_COLUMNS, "items", F.expr(f"coalesce(payload_err, {first_item_error})").alias("err"))


def to_atomic(
    processed: DataFrame, config: PipelineConfig, dims: Dimensions = Dimensions(), with_position: bool = False
) -> DataFrame:
    """Atomic events of the payloads without an error, one row per event."""
    clean = processed.where("err IS NULL")
    rows = clean.select(F.posexplode("items").alias("pos", "item")).select("pos", "item.*").drop("err")
    if config.geo_enabled and dims.geo_ranges is not None:
        rows = with_geo(rows, dims.geo_ranges, config)
    else:
        rows = without_geo(rows)
    unset = {c: F.lit(None).cast("string") for c in ("device_id", "tenant_id") if c not in rows.columns}
    rows = rows.withColumns({"etl_tstamp": F.current_timestamp(), **unset})
    return rows.select(*(["pos"] if with_position else []), *ATOMIC_COLUMNS)


def enrich_raw(
    raw: DataFrame, config: PipelineConfig, rules: Rules, dims: Dimensions = Dimensions()
) -> tuple[DataFrame, DataFrame]:
    """``(events, errors)``. Cache or write ``process_raw`` first when both are written in full."""
    processed = process_raw(raw, config, rules, dims)
    return to_atomic(processed, config, dims), to_errors(processed)
