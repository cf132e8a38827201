"""Small tables and plain Python versions to hold the operators against."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def low(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(low(text))


LONG = "Some words go on and on, " * 8000
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"

#: nulls, empty and long texts, repeated rows, ties, odd characters
HARD = [
    (1, "One small text. All rights reserved."),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, LONG + "!"),
    (6, "One small text. All rights reserved."),
    (6, "One small text. All rights reserved."),
    (7, f"before {PASSAGE} after\npassword = 'aB3$kk99'"),
    (8, f"É été naïve — ▁ 東京 \x00 tab\tend 🙂\n\n{PASSAGE}"),
    (None, "a row without id " + PASSAGE),
    (None, None),
    (9, "    \n .,!? \n"),
    (10, "CC BY cc by general public license, cc-by"),
]
#: names that the operators use inside or return
CLASHING = ["_id", "_key", "_text", "_row", "_set", "score", "found", "n_words", "n_lines", "selected", "_first", "lang"]


def hard_docs(spark):
    rows = [(i, t, *[f"x{n}" for n in range(len(CLASHING))]) for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))


def no_docs(spark):
    return hard_docs(spark).limit(0)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *[r[c] for c in columns]) for r in df.collect()), key=repr)
