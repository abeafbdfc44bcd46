"""All registered queries; importing the modules below registers them."""

from __future__ import annotations

from driftline.plans import (  # noqa: F401
    io_queries,
    series_queries,
    text_queries,
    traffic_queries,
)
from driftline.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
