"""All registered queries."""

from __future__ import annotations

from tidemark.plans import (  # noqa: F401 - importing a module registers its queries
    source_queries,
    staging_queries,
    join_queries,
    aggregate_queries,
    window_queries,
    set_queries,
    function_queries,
    build_queries,
    snapshot_queries,
    quality_queries,
    stream_queries,
    model_queries,
    mart_queries,
)
from tidemark.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
