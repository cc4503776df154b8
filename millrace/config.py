"""Settings of the enrichment job."""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_VENDOR = "io.millrace"


@dataclass(frozen=True)
class PipelineConfig:
    """Plain settings; every field has the default the batch and stream jobs use.

    ``schema_vendor`` is the vendor part of the built-in event schemas (page_view, transaction, ...).
    Set it to the vendor your existing registry and stored events carry.
    """

    schema_vendor: str = DEFAULT_VENDOR
    etl_version: str = "millrace-0.1.0"
    collector_name: str = "millrace-0.1.0"

    geo_enabled: bool = False
    campaign_enabled: bool = True
    device_enabled: bool = True

    record_format: str = "avro"
    max_record_bytes: int = 190_000
    cookie_name: str = "sp"

    auth_enabled: bool = False
    auth_claim: str = "sub"
    auth_audience: str | None = None
    auth_public_key: str | None = None
    auth_leeway_seconds: int = 3600

    # A lookup table is broadcast only when it has no more rows than this, counted; beyond it the join shuffles.
    broadcast_limit_rows: int = 1_000_000
