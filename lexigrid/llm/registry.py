"""Queries of this package and their SQL; the entry file adds them to the library's."""

from __future__ import annotations

from lexigrid.catalog.registry import Query

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLES[name] = sql
        return fn

    return register
