"""Importing this package registers every query."""

from stepmill.plans.queries import (  # noqa: F401
    columns,
    crawl,
    dates,
    html,
    io,
    nulls,
    order,
    profile,
    records,
    strings,
)
from stepmill.plans.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
