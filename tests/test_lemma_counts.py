"""Counts translated to lemmas against documents translated to lemmas; no table of the size of the
vocabulary is repeated for salts."""

import random

import pytest

from lexigrid.catalog import QUERIES
from lexigrid.operators import assoc as a
from lexigrid.operators import phrases as p
from lexigrid.operators.positions import lemmatized

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def words(spark):
    rng = random.Random(11)
    docs = [(i, [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 40))]) for i in range(60)]
    # "b" is a form of "a", "a" has a lemma of its own, "g" and "h" are not in the lexicon
    lexicon = [("a", "x", "N"), ("b", "a", "V"), ("c", "c", "N"), ("d", "c", "V"), ("e", "g", None), ("f", "k", "N")]
    return {
        "corpus": spark.createDataFrame(docs, "doc_id long, toks array<string>"),
        "lexicon": spark.createDataFrame(lexicon, "lc string, lemma string, tag string"),
    }


RELATIONS = {"left2": -2, "left1": -1, "noun1": (1, "^N$"), "untagged2": (2, "^$")}


@pytest.mark.parametrize("lemma", ["a", "x", "c", "g", "h", "b", "none"])
def test_sketches_of_counts(words, lemma):
    whole = lemmatized(**words)
    got = sorted(map(tuple, a.word_sketch(lemma=lemma, relations=RELATIONS, **words).collect()))
    assert got == sorted(map(tuple, a.word_sketch(whole, lemma, RELATIONS).collect()))
    got = sorted(map(tuple, a.sketch_diff(lemma=lemma, lemma2="k", relations=RELATIONS, **words).collect()))
    assert got == sorted(map(tuple, a.sketch_diff(whole, lemma, "k", RELATIONS).collect()))


@pytest.mark.parametrize("lemma", ["a", "x", "g"])
def test_thesaurus_of_counts(words, lemma):
    relations = {"left1": -1, "right2": 2}
    got = sorted(map(tuple, a.thesaurus(lemma=lemma, relations=relations, min_freq=2, **words).collect()))
    assert got and got == sorted(map(tuple, a.thesaurus(lemmatized(words["corpus"], words["lexicon"]), lemma, relations, 2).collect()))


@pytest.mark.parametrize("name", ["p3_annotate", "c2_attr_or_lemma", "a4_wsketch_sequence", "c15_attr_segments"])
def test_lexicon_is_not_repeated(spark, name):
    assert "_salt" not in QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_vocabulary_is_not_repeated(spark, monkeypatch):
    """What meets the grams of phrases in salted copies are these grams only."""
    sizes, salted = [], p.salted_join

    def counted(many, one, on, *rest):
        if on == ["gram"] and "n" in one.columns:
            sizes.append(one.count())
        return salted(many, one, on, *rest)

    monkeypatch.setattr(p, "salted_join", counted)
    corpus = spark.createDataFrame([(i, f"one two word{i} three") for i in range(200)], "doc_id long, text string")
    phrases = spark.createDataFrame([("p", "one two"), ("q", "three")], "phrase_id string, phrase string")
    assert p.phrase_search(corpus, phrases).count() == 400
    assert sizes and max(sizes) <= 4


def test_words_that_cannot_match_are_not_moved(spark):
    plan = QUERIES["c2_attr_or_lemma"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
