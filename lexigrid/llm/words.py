"""Words of texts by built-in functions only, for the operators without Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
#: what stands between words: all ASCII but digits and letters
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column, digits: bool = True) -> Column:
    """Words with A-Z in lower case; with ``digits=False`` every digit counts as 0."""
    low = F.translate(text, UPPER, UPPER.lower()) if digits else F.translate(text, UPPER + DIGITS, UPPER.lower() + "0" * 10)
    return F.array_remove(F.split(low, BETWEEN), "")


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Mark a table for broadcast if it has at most ``rows`` rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
