"""Texts that must not end a job: they take seconds, whatever they hold."""

import time

import pytest
from pyspark.sql import functions as F

from lexigrid.functions.fuzzy import fuzzy_pattern
from lexigrid.operators import concordance as c, match as m, phrases as p, positions as pos
from lexigrid.sources.corpus import with_tokens


def corpus(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return with_tokens(rows)


@pytest.fixture(autouse=True)
def seconds():
    start = time.perf_counter()
    yield
    assert time.perf_counter() - start < 60


def test_a_line_of_dots(spark):
    row = pos.with_sentences(corpus(spark, "a " + "." * 100_000 + " b. c")).select(F.size("sents")).first()
    assert row[0] == 3


def test_sentences_as_before(spark):
    text = "One. Two?! Three\n\n...\nFour . . five"
    sents = pos.with_sentences(corpus(spark, text)).first().sents
    assert [s.toks for s in sents] == [["one", "."], ["two", "?", "!"], ["three"], [".", ".", "."], ["four", ".", "."], ["five"]]


def test_wide_gaps(spark):
    words = " ".join(f"w{i}" for i in range(6000))
    text = f"alpha {words} beta {words} gamma"
    passage = "alpha []{,7000} beta []{,7000} gamma"
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    hits = p.relocate(corpus(spark, text, text + " end", "alpha beta"), items).collect()
    assert sorted((h.doc_id, h.pos, h.end) for h in hits) == [(0, 0, 12003), (1, 0, 12003)]


def test_a_gap_larger_than_any_text(spark):
    text = spark.createDataFrame([("a []{,2000000000} []{,2000000000} b c",)], "text string")
    got = text.select(fuzzy_pattern("text").alias("e")).first().e
    assert [(e.term, e.gap) for e in got] == [("a", None), (None, 2**31 - 1), ("b", None), ("c", None)]


def test_many_hits_in_one_document(spark):
    docs = corpus(spark, "a b " * 100_000)
    both = m.match_alternatives(docs, [[m.term("a")], [m.term("b")], [m.term("a")]])
    assert both.select(F.size("hits")).first()[0] == 200_000


def test_many_sentences_and_hits(spark):
    docs = corpus(spark, "a b. " * 20_000)
    lines = c.sentence_view(m.match(docs, [m.term("b")]))
    row = lines.agg(F.count("*").alias("n"), F.max("sent_id").alias("last"), F.min(F.size("left")).alias("left")).first()
    assert (row.n, row.last, row.left) == (20_000, 19_999, 1)
