"""Registered queries: each pairs an operator call with equivalent SQL."""

from __future__ import annotations

from lexigrid.catalog.registry import ORACLES, QUERIES
from lexigrid.catalog import (  # noqa: F401  (importing registers)
    corpus_queries,
    frequency_queries,
    concordance_queries,
    association_queries,
    phrase_queries,
    request_queries,
    response_queries,
)

__all__ = ["ORACLES", "QUERIES"]
