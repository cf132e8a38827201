"""Wildcard terms meet only words that they can match; the bitmap drops nothing that is needed."""

import random
import re

from pyspark.sql import functions as F

from lexigrid.functions.text import term_regex
from lexigrid.operators import phrases as p
from lexigrid.plans.scale import bitmap, may_hold


def words_of(rng, n):
    return sorted({"".join(rng.choice("abeing") for _ in range(rng.randrange(1, 9))) for _ in range(n)} | {"e", "ing", "ab", "a", "b", "$", "é"})


def tables(spark, terms, words):
    wild = spark.createDataFrame([(t,) for t in terms], "t string")
    wild = wild.select("t", F.col("t").alias("gram"), term_regex("t").alias("re"), p._piece(F.struct("t")).alias("piece"))
    return wild, spark.createDataFrame([(w, 1) for w in words], "gram string, n long")


def test_only_matching_words_are_met(spark):
    words = words_of(random.Random(1), 3000)
    wild, vocabulary = tables(spark, ["e*", "*ing", "a*b"], words)
    met = {(r.t, r.gram) for r in p.wildcard_candidates(wild, vocabulary).select("t", "gram").collect()}
    want = {("e*", w) for w in words if w.startswith("e")} | {("*ing", w) for w in words if w.endswith("ing")}
    assert met == want | {("a*b", w) for w in words if len(w) > 1 and w[0] == "a" and w[-1] == "b"}


def test_all_kinds_of_terms(spark):
    terms = ["e*", "*ing", "a*b", "a?b", ".b", "b.", "*in*", "?in?", "a*i*g", "ab*ab", "*a", "é*", "$*", "a**b", "*g*a*"]
    words = words_of(random.Random(2), 2000)
    wild, vocabulary = tables(spark, terms, words)
    got = {(r.t, r.gram) for r in p._expanded(wild, vocabulary, ["t"]).collect()}
    forms = {t: re.compile("".join({"*": ".*", "?": ".", ".": "."}.get(c, re.escape(c)) for c in t)) for t in terms}
    assert got == {(t, w) for t in terms for w in words if forms[t].fullmatch(w)}


def test_no_terms_or_words(spark):
    wild, vocabulary = tables(spark, ["a*"], ["b"])
    assert p._expanded(wild.limit(0), vocabulary, ["t"]).count() == 0
    assert p._expanded(wild, vocabulary, ["t"]).count() == 0


def test_bitmap_keeps_its_keys_and_drops_others(spark):
    keys = spark.range(500).selectExpr("concat('w', id) AS k")
    rows = spark.range(100_000).selectExpr("concat('w', id) AS g")
    kept = rows.filter(may_hold(bitmap(keys, "k"), F.col("g")))
    assert kept.join(keys, F.col("k") == F.col("g"), "left_semi").count() == 500 and kept.count() < 700
    assert rows.filter(may_hold(bitmap(keys.limit(0), "k"), F.col("g"))).count() == 0
    full = bitmap(rows, "g", words=4)
    assert rows.filter(may_hold(full, F.col("g"), words=4)).count() == 100_000


def test_many_candidates_in_one_document(spark, monkeypatch):
    """Chunks follow the document's own candidates, and give the same hits."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(400 if i == 0 else 30))) for i in range(20)]
    table = [(i, rng.choice([f"{rng.choice(words)} {rng.choice(words)}", f"{rng.choice(words)} * {rng.choice(words)}", "w1* w*2 w?"])) for i in range(300)]
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    search = lambda: sorted(map(tuple, p.phrase_search(corpus, spark.createDataFrame(table, "phrase_id long, phrase string")).collect()))
    want = []
    for i, phrase in table:
        parts = [re.compile("".join({"*": ".*", "?": "."}.get(c, c) for c in t)) for t in phrase.split()]
        for d, text in texts:
            toks = text.split()
            want += [(i, d, a, a + len(parts)) for a in range(len(toks) - len(parts) + 1) if all(r.fullmatch(t) for r, t in zip(parts, toks[a:]))]
    assert search() == sorted(want)
    monkeypatch.setattr(p, "CHUNK", 7)
    assert search() == sorted(want)
