"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from surfacekit.plans import registry
from surfacekit.plans import url_queries  # noqa: F401
from surfacekit.plans import secret_queries  # noqa: F401
from surfacekit.plans import endpoint_queries  # noqa: F401
from surfacekit.plans import response_queries  # noqa: F401
from surfacekit.plans import infra_queries  # noqa: F401
from surfacekit.plans import report_queries  # noqa: F401
from surfacekit.plans import stream_queries  # noqa: F401
from surfacekit.plans import io_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
