"""SimHash classes against all pairs of fingerprints, and crowds of near copies."""

import numpy as np
import pytest
import xxhash

from lexigrid.llm import simhash
from lexigrid.llm.queries import LLM_QUERIES
from tests.llm.helpers import HARD, SF, hard_docs, no_docs


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate({i: 32 for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(len(words) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    """(id, fingerprint) rows to the smallest reachable id, by comparing all pairs."""
    prints = np.array(sorted({f for _, f in rows}), np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4) + i + 1:
            root[find(i)] = find(int(j))
    where = {int(f): find(i) for i, f in enumerate(prints)}
    least = {}
    for i, f in rows:
        if i is not None:
            least[where[f]] = min(i, least.get(where[f], i))
    return sorted(((i, f"{f:016x}", least.get(where[f])) for i, f in rows), key=repr)


def collected(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_query_against_all_pairs(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_classes([(r.doc_id, plain_fingerprint(r.text)) for r in texts])
    got = collected(LLM_QUERIES["op12_simhash"](spark, SF))
    assert got == want and len({c for _, _, c in got}) < len({f for _, f, _ in got})


def test_hard_cases(spark):
    assert collected(simhash.simhash_classes(hard_docs(spark))) == plain_classes([(i, plain_fingerprint(t)) for i, t in HARD])
    assert simhash.simhash_classes(no_docs(spark)).count() == 0
    only = spark.createDataFrame([(None, "a text of its own"), (None, None)], "doc_id long, text string")
    assert {r.component_id for r in simhash.simhash_classes(only).collect()} == {None}


def test_fingerprints_count_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    for text in ("A b\x0bc  D", "one", "", None, "x " * 50, "É b c d e É\xa0b", "  a\x85b c d e"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def family(rng, centre, n, most):
    """Numbers with at most ``most`` bits flipped."""
    return [centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, most + 1)), replace=False)) for _ in range(n)]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _crowd():
    rng = np.random.default_rng(4)
    numbers = {0, (1 << 64) - 1, *(int(x) for x in rng.integers(0, 1 << 63, 300))}
    for n, most in ((400, 3), (200, 9), (50, 1)):
        numbers |= set(family(rng, int(rng.integers(0, 1 << 63)) * 2 + 1, n, most))
    return sorted(numbers)


@pytest.mark.parametrize("bucket", [8, simhash.BUCKET])
def test_crowds_link_as_all_pairs_do(spark, bucket):
    """Small buckets are cut further until whole variants are the keys."""
    numbers = _crowd()
    fps = spark.createDataFrame([(_signed(x),) for x in numbers], "fp long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(fps, bucket=bucket).collect()]
    root = {x: x for x in numbers}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    want = plain_classes([(i, x) for i, x in enumerate(numbers)])
    same = {}
    for i, _, c in want:
        same.setdefault(find(numbers[i]), set()).add(c)
    assert all(len(c) == 1 for c in same.values()) and len(same) == len({c for _, _, c in want})


def test_meet_splits_inside_a_bucket(monkeypatch):
    numbers = np.array(_crowd(), np.uint64)
    whole = simhash.meet(numbers, np.full(len(numbers), 2), 0)
    monkeypatch.setattr(simhash, "VARIANTS", 3000)
    assert (simhash.meet(numbers, np.full(len(numbers), 2), 0) == whole).all()


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=3)
