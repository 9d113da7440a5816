"""Staged runs and the registered queries."""

from __future__ import annotations


def all_queries() -> tuple[dict, dict]:
    """The registered queries and the SQL of those that have one, by name."""
    from filingweave.plans import (  # noqa: F401  (registering)
        query_codes, query_mapping, query_markup, query_reports, query_stages,
    )
    from filingweave.plans.registry import QUERIES, SQL

    return QUERIES, SQL
