"""Known values for text functions and patterns."""

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import text as t
from lexigrid.functions.fuzzy import fuzzy_pattern, pattern_literals
from lexigrid.operators.phrases import phrase_variants


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "c string").select(column).first()[0]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("‘’‛‹›", "'" * 5),
        ("ʺ˝ˮ˵˶̋«»“”‟", '"' * 11),
        ("abc\t\n d", "abc   d"),
        (" hello ", "hello"),
        (" x\u001c", "x"),
        ("ﬁne ①", "fine 1"),
    ],
)
def test_clean(spark, text, cleaned):
    assert value(spark, t.clean_text("c"), text) == cleaned


def test_clean_forms(spark):
    assert value(spark, t.clean_text("c", None), "ﬁne") == "ﬁne"
    assert value(spark, t.clean_text("c", "NFD"), "é") == "é"


@pytest.mark.parametrize(
    "term, atomic, forms",
    [
        ("1A-1B", False, ["1A-1B"]),
        ("1A-1B", True, ["1A-1B", "1A - 1B"]),
        ("1A--1B", False, ["1A1B", "1A 1B", "1A-1B"]),
        ("1A--1B", True, ["1A1B", "1A 1B", "1A-1B", "1A - 1B"]),
        ("plain", True, ["plain"]),
    ],
)
def test_hyphens(spark, term, atomic, forms):
    assert value(spark, t.hyphen_forms("c", atomic), term) == forms


def shape(rows):
    """alternative -> slot -> variants of terms."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.alternative, r.slot, r.variant, r.token)):
        out.setdefault(r.alternative, {}).setdefault(r.slot, {}).setdefault(r.variant, []).append(r.term)
    return [[list(s.values()) for s in a.values()] for a in out.values()]


@pytest.mark.parametrize(
    "phrase, atomic, expected",
    [
        ("1", True, [[[["1"]]]]),
        ("1A 1B", True, [[[["1A"]], [["1B"]]]]),
        ("1 | 2", True, [[[["1"]]], [[["2"]]]]),
        ("1A-1B", False, [[[["1A-1B"]]]]),
        ("1A-1B", True, [[[["1A-1B"], ["1A", "-", "1B"]]]]),
        ("1A--1B", False, [[[["1A1B"], ["1A", "1B"], ["1A-1B"]]]]),
        ("1A--1B", True, [[[["1A1B"], ["1A", "1B"], ["1A-1B"], ["1A", "-", "1B"]]]]),
        (
            "1A--1B 1C | 2",
            True,
            [[[["1A1B"], ["1A", "1B"], ["1A-1B"], ["1A", "-", "1B"]], [["1C"]]], [[["2"]]]],
        ),
        ("1A?", True, [[[["1A?"]]]]),
        ("1 * 3", True, [[[["1"]], [["*"]], [["3"]]]]),
        ("united nations | UN", False, [[[["united"]], [["nations"]]], [[["UN"]]]]),
        (
            "home--made * recipe",
            True,
            [[[["homemade"], ["home", "made"], ["home-made"], ["home", "-", "made"]], [["*"]], [["recipe"]]]],
        ),
    ],
)
def test_phrases(spark, phrase, atomic, expected):
    rows = phrase_variants(spark.createDataFrame([(1, phrase)], "phrase_id int, phrase string"), atomic)
    assert shape(rows.collect()) == expected


@pytest.mark.parametrize("char", list('"$()+[]^{}\\'))
def test_escape(spark, char):
    assert value(spark, t.escape_term("c"), char) == "\\" + char
    # the escaped term finds the character itself
    found = spark.createDataFrame([(char,), ("x",)], "w string").filter(
        F.rlike(F.col("w"), t.term_regex(F.lit(char)))
    )
    assert [r.w for r in found.collect()] == [char]


@pytest.mark.parametrize(
    "term, word, holds",
    [
        ("1A?", "1Ab", True),
        ("1A?", "1A", False),
        ("1A*", "1A", True),
        ("*", "", True),
        ("a.c", "abc", True),
        ("a+b", "a+b", True),
        ("a+b", "aab", False),
    ],
)
def test_terms(spark, term, word, holds):
    assert value(spark, t.term_predicate(F.col("c"), term), word) is holds


@pytest.mark.parametrize(
    "rule, kind",
    [
        ("[#1|#2000|#456789]", "ID"),
        ("[#1 | #2000 | #456789 ]", "ID"),
        ('[lemma="apple"]', "CQL"),
        ("", "CQL"),
    ],
)
def test_rule_kind(spark, rule, kind):
    assert value(spark, t.rule_kind("c"), rule) == kind


SENTENCES = {
    "Before yesterday, it was fine, don't you think?": [
        "Before", "yesterday", 1, "it", "was", "fine", 3, "you", "think",
    ],
    "Here's some cheese, meat, bread, apples, and pie.": [
        "some", "cheese", 1, "meat", 1, "bread", 1, "apples", 1, "and", "pie",
    ],
    "We saw 1,000.99% more visitors at www.example.com yesterday": [
        "We", "saw", 6, "more", "visitors", "at", 2, "yesterday",
    ],
    "I think there’s not (much) to do... anymore.": [
        "I", "think", 2, "not", 1, "much", 1, "to", "do", 3, "anymore",
    ],
    " Here , take this. ": ["Here", 1, "take", "this"],
    "Well (then) - we, e.g., should (I think) take the aero-plane today.": [
        "Well", 1, "then", 2, "we", 6, "should", 1, "I", "think", 1, "take", "the", 3, "today",
    ],
}


@pytest.mark.parametrize("sentence", list(SENTENCES))
def test_fuzzy(spark, sentence):
    elements = value(spark, fuzzy_pattern("c"), sentence)
    assert [e.term if e.term is not None else e.gap for e in elements] == SENTENCES[sentence]


def test_fuzzy_length(spark):
    text = " ".join(f"w{i}" if i % 3 else "--" for i in range(200))
    elements = value(spark, fuzzy_pattern("c"), text)
    assert len(elements) == 25
    assert value(spark, fuzzy_pattern("c", max_length=2), "a b c") == elements[:0] + value(
        spark, fuzzy_pattern("c"), "a b"
    )
    assert [(e.term, e.gap) for e in value(spark, fuzzy_pattern("c"), "!")] == [(None, 1)]


def test_literals(spark):
    found = value(spark, pattern_literals(fuzzy_pattern("c")), "We saw 1,000.99% more, then")
    assert [(x.t, x.g) for x in found] == [("we", 0), ("saw", 0), ("more", 6), ("then", 1)]


def test_tokens_stay_aligned(spark):
    text = "İstanbul, A B"
    words = value(spark, t.tokenize("c"), text)
    lower = value(spark, t.tokenize_lower("c"), text)
    assert words == ["İstanbul", ",", "A", "B"]
    assert [w.lower() for w in words] == lower
    assert value(spark, t.count_tokens("c"), text) == 4
