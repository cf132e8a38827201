"""Whitening against the eigenvectors of the exact covariance; rank-one updates against dense ones."""

import numpy as np
import pytest

from lexigrid.llm import whitening
from lexigrid.llm.queries import LLM_QUERIES
from tests.llm.helpers import SF


def check(got, vectors):
    """All rows of the result, against numpy on integers centred before multiplying."""
    ids = [i for i, _ in vectors]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    y = ((n * x - sums) / n).astype(float)
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1], basis[:, ::-1]
    many = min(32, x.shape[1])
    rows = {}
    for r in got.collect():
        rows.setdefault(r.component, []).append(r)
    assert sorted(rows) == list(range(1, many + 1))
    for c in range(many):
        assert sorted(r.vec_id for r in rows[c + 1]) == sorted(ids)
        assert all(r.n == n and abs(r.explained - values[c] / values.sum()) <= 1e-8 * r.explained for r in rows[c + 1])
        want = dict(zip(ids, y @ basis[:, c] / np.sqrt(values[c])))
        sign = np.sign(sum(want[r.vec_id] * r.whitened for r in rows[c + 1]))
        assert max(abs(sign * r.whitened - want[r.vec_id]) for r in rows[c + 1]) < 1e-6
        assert all(r.identity_error <= 1e-9 for r in rows[c + 1])
    want = dict(zip(ids, [int(v) for v in ((n * x - sums) ** 2).sum(axis=1)]))
    assert all(r.deviation == want[r.vec_id] for r in rows[1])


def test_query_against_dense_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(LLM_QUERIES["op13_whitening"](spark, SF), [tuple(r) for r in rows])


def test_many_partitions_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]).tolist()) for i in range(300)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "vec_id long, embedding array<double>, _x string, n int")
    check(whitening.whiten(df.repartition(40)), good)


def test_defined_cases(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])], kind)).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(None, 1, 0, None, None, None)] * 2
    # short vectors are filled up, repeated rows count twice, one dimension has no variance
    rows = [(1, [1.0]), (1, [1.0]), (2, [3.0, 0.0]), (3, [])]
    got = whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == 8 and all(r.whitened is None and r.explained == 0 for r in got if r.component == 2)
    want = 4 * 64 - (64 + 64 + 192)
    assert {r.deviation for r in got if r.vec_id == 1} == {want * want}
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in got if r.component == 1)


def test_deviation_beyond_63_bits(spark):
    rows = [(0, [0.0]), (1, [2.0**40]), (2, [2.0**20])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [0, 64 * 2**40, 64 * 2**20]
    want = {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got} == {i: v if v < 1 << 63 else None for i, v in want.items()}


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_rank_one_updates(size):
    rng = np.random.default_rng(size)
    for kind in range(5):
        values = np.sort(rng.random(size) * 10.0 ** rng.integers(-3, 6, size))
        if kind == 1:
            values[:] = values[0]
        if kind == 2:
            values[size // 2 :] = values[-1]
        basis, _ = np.linalg.qr(rng.normal(size=(size, size)))
        vector = rng.normal(size=size)
        if kind == 3:
            vector = basis[:, 0] * 3
        if kind == 4:
            vector = basis @ np.where(rng.random(size) < 0.5, 0, 1e-9)
        dense = (basis * values) @ basis.T + 2.5 * np.outer(vector, vector)
        got, turned = whitening.rank_one(values, basis, vector, 2.5)
        scale = max(1e-300, np.abs(dense).max())
        assert np.abs((turned * got) @ turned.T - dense).max() < 1e-12 * scale * size
        assert np.abs(turned.T @ turned - np.eye(size)).max() < 1e-12 * size
        assert (np.diff(got) >= 0).all()


def test_spectra_of_parts_combine():
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(500, 12)) * 100).astype(np.int64) + 1_000_000
    whole = whitening.Spectrum(12)
    for part in np.array_split(x, 7):
        own = whitening.Spectrum(12)
        for row in part:
            own.add(row)
        whole.merge(whitening.Spectrum.of(own.row()))
    y = x - x.mean(axis=0)
    assert whole.n == 500 and (whole.sums == x.sum(axis=0)).all()
    assert np.allclose(whole.values, np.linalg.eigvalsh(y.T @ y), rtol=1e-9)
