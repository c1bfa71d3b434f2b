"""All registered queries and oracle texts."""

from __future__ import annotations

from voltide.plans import (
    feature_queries,
    ingest_queries,
    ml_queries,
    model_queries,
    monitor_queries,
    null_key_queries,
    stream_queries,
)

MODULES = [
    ingest_queries,
    feature_queries,
    null_key_queries,
    model_queries,
    monitor_queries,
    ml_queries,
    stream_queries,
]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
