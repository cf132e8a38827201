"""All queries of the package, with their SQL where there is one."""

from __future__ import annotations

from lexigrid.llm import conversations, decontaminate, jaccard, licenses, lines, pieces, quality, secrets, simhash, substrings, topk, toxicity, whitening  # noqa: F401  (importing registers)
from lexigrid.llm.registry import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
