"""Bindings of the operators to the driver's tables, with their SQL twins."""

from __future__ import annotations


def all_queries():
    """Every registered query by name."""
    from quayside.plans import landing_queries, lake_queries, schema_queries, telemetry_queries, topic_queries  # noqa: F401
    from quayside.plans.registered import QUERIES

    return dict(QUERIES)
