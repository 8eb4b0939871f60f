"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from tidewright.plans import (  # noqa: F401
    feature_queries, model_queries, page_queries, stream_queries, table_queries, text_queries, view_queries,
)
from tidewright.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
