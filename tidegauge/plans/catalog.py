"""All registered queries."""

from __future__ import annotations

from tidegauge.plans import routing_queries, sequence_queries, window_queries  # noqa: F401
from tidegauge.plans import streaming_queries  # noqa: F401  (uses the SQL of the others)
from tidegauge.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
