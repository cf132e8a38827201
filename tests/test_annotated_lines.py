"""Attributes looked up after cutting, against attributes of whole documents."""

from pyspark.sql import functions as F

from lexigrid.operators import concordance as c
from lexigrid.operators import match as m
from lexigrid.operators.positions import annotate, attribute_arrays, positions
from lexigrid.sources.corpus import with_tokens


def test_same_lines_as_from_annotated_documents(spark):
    texts = [(1, "The dogs saw the Cat. THE"), (2, ""), (3, None), (4, "no hit here"), (5, "the " * 60 + "end")]
    corpus = with_tokens(spark.createDataFrame(texts, "doc_id long, text string"), word=True)
    words = spark.createDataFrame([("the", "the", "DT"), ("dogs", "dog", "NN"), ("saw", "see", None)], "lc string, lemma string, tag string")
    layers = attribute_arrays(annotate(positions(corpus), words).fillna("X", ["tag"]))
    want = c.view_lines(m.match(layers, [m.term("the")]), 2, 3, ["#"], attrs=True)
    got = c.view_lines(m.match(corpus, [m.term("the")]), 2, 3, ["#"], lexicon=words, untagged="X")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(want) and got.count() == 63
    first = got.filter("doc_id = 1 AND pos = 3").select(F.expr("transform(line.Left, s -> s.str)")).first()[0]
    assert first == ["dogs", "/NN/dog", "saw", "/X/see"]
