"""Registered queries of the catalogue operators, with their SQL."""

from __future__ import annotations

from quillframe.plans import change_queries, release_queries, report_queries, snapshot_queries  # all register with report_queries

__all__ = ["change_queries", "oracle_sql", "queries", "release_queries", "snapshot_queries"]


def queries() -> dict:
    """Every query by name."""
    return dict(report_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(report_queries.SQL)
