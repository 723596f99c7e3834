"""Loads every query module, so that the registry is complete."""

from tidegate.plans import (  # noqa: F401
    filter_queries,
    flow_queries,
    live_queries,
    payload_queries,
    record_queries,
    state_queries,
    typed_queries,
)
from tidegate.plans.registry import ORACLES, QUERIES  # noqa: F401
