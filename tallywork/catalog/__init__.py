"""Registered queries over the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations


def all_queries() -> dict:
    """Every registered query: name -> (builder, SQL or None)."""
    from tallywork.catalog import (  # noqa: F401  (importing registers)
        chart_queries,
        model_queries,
        profile_queries,
        report_queries,
        scan_queries,
        split_queries,
        statistics_queries,
    )
    from tallywork.catalog.registry import REGISTRY

    return dict(REGISTRY)
