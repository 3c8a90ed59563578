"""Registered queries over the test tables, each beside the SQL that states the same result."""

from labtide.catalog import (
    activity_queries,
    event_queries,
    file_queries,
    io_queries,
    report_queries,
    run_queries,
    state_queries,
    text_queries,
)
from labtide.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "activity_queries", "event_queries", "file_queries", "io_queries", "report_queries", "run_queries", "state_queries",
    "text_queries",
]
