"""The registered queries: each a Spark callable, most with the SQL that must give the same rows."""

from registry import (  # noqa: F401
    aggregate_queries,
    io_queries,
    join_queries,
    model_queries,
    profile_queries,
    row_queries,
    spatial_queries,
)
from registry.core import QUERIES, oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
