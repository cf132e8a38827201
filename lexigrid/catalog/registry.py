"""Registration and the SQL fragments shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


TOKENS_OF = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]')"
WORDS = TOKENS_OF.format("text")
LOWER = TOKENS_OF.format("lower(text)")

CORPUS = f"corpus AS (SELECT doc_id, lang, source, text, {LOWER} AS toks FROM documents)"
TOK = (
    "tok AS (SELECT doc_id, lang, source, unnest(toks) AS w, "
    "generate_subscripts(toks, 1) - 1 AS pos, len(toks) AS n FROM corpus)"
)
BASE = f"WITH {CORPUS}, {TOK}"
HITS = "hits AS (SELECT doc_id, lang, source, pos, pos + 1 AS \"end\" FROM tok WHERE w = 'the')"
OFFSETS = (
    "offs AS (SELECT doc_id, len(toks) AS n_tokens, "
    "coalesce(sum(len(toks)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    "::bigint AS \"offset\" FROM corpus)"
)
