"""Spark jobs that turn raw tracker payloads into a validated, enriched event table."""

from millrace.config import PipelineConfig
from millrace.session import configure

__all__ = ["PipelineConfig", "configure"]
