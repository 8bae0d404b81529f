"""All named queries."""

from . import alert_queries, ingest_queries, ops_queries, stream_queries, window_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
