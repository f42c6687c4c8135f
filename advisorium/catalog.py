"""All registered queries and their oracles."""

from __future__ import annotations

from .plans import (  # noqa: F401  they register their queries
    queries_documents, queries_extension, queries_html, queries_nested, queries_progress, queries_scalar, queries_sources, queries_stream,
)
from .plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = "agg_window_severity"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
