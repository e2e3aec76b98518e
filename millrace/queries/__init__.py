"""Registered queries. Importing the modules fills the registry."""

from millrace.queries import (  # noqa: F401
    aggregates,
    columns,
    dynamic,
    filters,
    incremental,
    jobs,
    nested,
    quality,
    scalars,
    scans,
    sinks,
    streams,
    versioned,
)
from millrace.queries.registry import QUERIES

__all__ = ["QUERIES"]
