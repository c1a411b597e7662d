"""All registered queries."""

from tidemark.plans import (  # noqa: F401
    flagship,
    job_queries,
    join_queries,
    pattern_queries,
    regression_queries,
    selection,
    stream_queries,
    table_queries,
    telemetry_queries,
    window_queries,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
