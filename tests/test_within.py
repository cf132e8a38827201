"""Hits inside structures against plain Python."""

import random
import time

from pyspark.sql import functions as F

from lexigrid.functions.arrays import running_max
from lexigrid.operators import match as m
from lexigrid.operators.positions import with_structures

KIND = "doc_id long, hits array<struct<pos:int,end:int>>, spans array<struct<pos:int,end:int>>"


def test_running_max(spark):
    rng = random.Random(3)
    rows = [[rng.choice([None, *range(50)]) for _ in range(n)] for n in [0, 1, 2, 3, 7, 8, 9, 100]] + [[None, 2, None, 1]]
    got = spark.createDataFrame([(r,) for r in rows], "v array<int>").select(running_max(F.col("v")).alias("m")).collect()
    for row, out in zip(rows, got):
        want, top = [], None
        for x in row:
            top = x if top is None or (x is not None and x > top) else top
            want.append(top)
        assert out.m == want


def test_overlapping_spans_ties_and_nulls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        def spans(n):
            out = []
            for _ in range(n):
                a = rng.randrange(30)
                out.append((a, a + rng.randrange(0, 8)))
            return out

        rows.append((i, spans(rng.randrange(12)), spans(rng.randrange(8))))
    rows += [(900, [(1, 2)], None), (901, [], [(0, 9)])]
    df = spark.createDataFrame(rows, KIND)
    for negate in (False, True):
        got = {r.doc_id: [tuple(h) for h in r.hits] for r in m.within_spans(df, "spans", negate).collect()}
        for i, hits, spans in rows:
            assert got[i] == sorted(h for h in hits if any(a <= h[0] and h[1] <= b for a, b in spans or ()) != negate)


def test_structures_of_a_text(spark):
    text = "One two. Three\n \nfour!? five\nsix.\n\n"
    row = with_structures(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in row}
    assert got[1].toks == ["one", "two", ".", "three", "four", "!", "?", "five", "six", "."]
    assert [tuple(s) for s in got[1].sent] == [(0, 3), (3, 4), (4, 7), (7, 8), (8, 10)]
    assert [tuple(s) for s in got[1].par] == [(0, 4), (4, 8), (8, 10)]
    assert not got[2].sent and not got[2].par and not got[3].toks


def test_many_hits_and_spans_in_one_document(spark):
    """Sorted merge: a hundred thousand of each in seconds, not their product."""
    n = 100_000
    span = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((i * 10).cast("int").alias("pos"), (i * 10 + 6).cast("int").alias("end")))
    hit = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((i * 10 + 3).cast("int").alias("pos"), (i * 10 + 5 + i % 2 * 2).cast("int").alias("end")))
    df = spark.range(1).select(F.col("id").alias("doc_id"), hit.alias("hits"), span.alias("spans"))
    start = time.perf_counter()
    assert m.within_spans(df, "spans").select(F.size("hits")).first()[0] == n // 2
    assert time.perf_counter() - start < 30
