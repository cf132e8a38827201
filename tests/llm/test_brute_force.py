"""Queries against plain Python on the smallest tables."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest

from lexigrid.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.llm.helpers import SF, low, words
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def _rows(spark, name):
    return {r.doc_id: r for r in LLM_QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF), connect(SF), LLM_ORACLES[name]) == []


def test_op1(spark, docs):
    from lexigrid.llm.licenses import PHRASES

    got = _rows(spark, "op1_license_scan")
    assert set(got) == set(docs)
    for i, text in docs.items():
        w, places = words(text), []
        for label, phrase in PHRASES:
            p = phrase.split()
            places += [(at, label) for at in range(len(w)) if w[at : at + len(p)] == p]
        at = [a for a, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_op4(spark, docs):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    got = _rows(spark, "op4_secret_scan")
    for i, t in docs.items():
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base = ",".join(s for _, _, s in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert ",".join(s for s in got[i].spans.split(",") if not s.startswith("guess")) == base


def test_op5(spark, docs):
    got, seen = _rows(spark, "op5_substring_dedup"), set()
    for i in sorted(docs):
        b = docs[i].encode()
        covered = np.zeros(len(b) + 1, int)
        for at in range(len(b) - 99):
            w = b[at : at + 100]
            if w in seen:
                covered[at] += 1
                covered[at + 100] -= 1
            seen.add(w)
        gone = np.cumsum(covered)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]).sum())
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), int(gone.sum()), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op6(spark, docs):
    sets = {}
    for i, text in docs.items():
        w = words(text)
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)} or ({tuple(w)} if w else set())
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links, root = collections.Counter(), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, n in collections.Counter(e for g in s for e in holders[g] if e > i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = _rows(spark, "op6_jaccard_join")
    assert {i: (find(i), links[i]) for i in sets} == {i: (r.class_id, r.n_links) for i, r in got.items()}


def test_op2_learns(spark):
    got = _rows(spark, "op2_quality_classifier")
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    right = [got[r.doc_id].selected == (r.quality == 1) for r in labels]
    assert len(got) == 200 and sum(right) / len(right) > 0.95
    assert all(0 <= r.tail_prob <= 1 for r in got.values())


def test_op3_gives_texts_back(spark, docs):
    from lexigrid.llm.pieces import decode

    coded = LLM_QUERIES["op3_sentencepiece"](spark, SF)
    assert {r.doc_id: r.text for r in decode(coded).collect()} == docs
    assert all(r.lossless and r.n_pieces == len(r.piece_ids) for r in coded.collect())


def test_op9_contract(spark):
    import zlib

    got = _rows(spark, "op9_toxicity")
    assert len(got) == 200
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_op9_held_out_accuracy(spark):
    from lexigrid.llm.toxicity import toxicity

    clean, foul = "the weather is fine and we walk home together now", "you are a total moron and a clown they said"
    docs = [(i, foul if i % 3 == 0 else clean) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    held = [r for r in toxicity(df, labels).collect() if r.held_out]
    assert len(held) > 50 and all(r.predicted == (r.doc_id % 3 == 0) for r in held)


def test_op10_exact_and_fuzzy(spark):
    """Groups from all pairs of lines by edit similarity: no line goes that has to stay, and nearly
    all lines go that have to."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text.split("\n") for r in df.collect()}
    norm = lambda line: line.translate({i: i + 32 for i in range(65, 91)}).strip(" \t\r\x0b\x0c")
    places = {}
    for i in sorted(texts):
        for at, line in enumerate(texts[i]):
            if words(line):
                places.setdefault(norm(line), []).append((i, at))
    t = spark.createDataFrame([(x, len(x)) for x in places], "x string, n int").repartition(8)
    most = "cast(floor(0.2 * greatest(a.n, b.n) + 1e-9) as int)"
    near = t.alias("a").join(t.alias("b"), F.expr(f"a.x < b.x AND abs(a.n - b.n) <= {most} AND levenshtein(a.x, b.x, {most}) >= 0"))
    root = {x: x for x in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in near.select("a.x", F.col("b.x").alias("y")).collect():
        x, y = find(x), find(y)
        if x != y:
            first, other = sorted((x, y), key=lambda k: places[k][0])
            root[other] = first
    stay = {(i, at) for x, all_ in places.items() if find(x) == x for i, at in all_[:1]}
    gone = {p for all_ in places.values() for p in all_} - stay
    removed = 0
    for r in LLM_QUERIES["op10_line_dedup"](spark, SF).collect():
        left, kept = r.text.split("\n") if r.n_removed < r.n_lines else [], []
        # the lines that stayed, in order; equal lines of a document fall to the first of them
        at = 0
        for line in left:
            while texts[r.doc_id][at] != line:
                at += 1
            kept.append((r.doc_id, at))
            at += 1
        own = {(r.doc_id, n) for n in range(len(texts[r.doc_id]))}
        assert r.n_lines == len(own) and r.n_removed == len(own) - len(kept)
        assert (own - set(kept)) <= gone
        removed += r.n_removed
    assert len(gone) >= removed >= 0.97 * len(gone) > 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= before
    kept = {r.doc_id: r.text for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(kept) and all(r.lossless for r in rows)
    assert all(len(t.encode()) > 0 for t in kept.values())


def test_duckdb_is_there():
    assert duckdb.connect().execute("SELECT 1").fetchall() == [(1,)]


def test_words_are_lower():
    assert words("ÀB c-D 9x") == ["Àb", "c", "d", "9x"] and low("É A") == "É a"
