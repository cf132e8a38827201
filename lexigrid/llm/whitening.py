"""Whitening of vectors by incremental eigendecomposition.

Each partition keeps the eigendecomposition of its scatter matrix and adds every vector as a centred
rank-one update: the new eigenvalues are the roots of a secular equation between the old ones, parts
that an update does not touch and equal eigenvalues are deflated. Spectra of partitions are combined
in a tree by successive rank-one updates, one for each eigenpair and one for the distance of the
means. A last pass over all vectors refines the result (Rayleigh-Ritz): the covariance in the basis
found is summed up over the partitions, and its eigenvectors, which are close to the unit vectors,
turn the basis. What reaches the driver are sums of as many numbers as the covariance has.

Entries become the integers ``floor(scale * c) + shift``, so sums and deviations are exact.

Defined cases: vectors that are null, or hold a null or non-finite entry, take no part; shorter
vectors, empty ones included, count as filled up with entries of 0; repeated rows and rows without
id count as often as given; other columns are ignored; fewer dimensions give fewer components;
components without variance (within rounding) have a null ``whitened``, ``explained`` is null if
there is no variance at all, ``identity_error`` is null if no component has any; a deviation over 63
bits is null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.registry import query
from lexigrid.plans.scale import materialized

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: spectra that one task combines
FAN_IN = 16
EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + z z'`` for rising ``d`` and the squares ``z2`` of no zeros.

    Also returns all differences ``d[i] - eigenvalue[j]``, taken from the nearer pole of each root,
    so that small ones keep their digits. All roots are found at once, by rational steps that follow
    the two neighbouring poles, and by halving where a step leaves the bracket.
    """
    k = len(d)
    at = np.arange(k)
    last = at == k - 1
    gap = np.append(np.diff(d), z2.sum())
    origin = at.copy()
    low, high = np.zeros(k), gap.copy()
    delta = d[:, None] - d[None, :]
    middle = 1 + (z2[:, None] / (delta - gap / 2)).sum(axis=0)
    high[middle >= 0] /= 2
    right = (middle < 0) & ~last
    low[last & (middle < 0)] = gap[-1] / 2
    origin[right] += 1
    low[right], high[right] = -gap[right] / 2, 0
    delta = d[:, None] - d[origin][None, :]
    below = at[:, None] <= at[None, :]
    near, far = delta[at, at], np.where(last, 0, delta[np.minimum(at + 1, k - 1), at])
    x = (low + high) / 2
    open_ = np.ones(k, bool)
    for _ in range(100):
        gaps = delta - x
        t = z2[:, None] / gaps
        psi, phi = np.where(below, t, 0).sum(axis=0), np.where(below, 0, t).sum(axis=0)
        f = 1 + psi + phi
        t /= gaps
        dpsi, dphi = np.where(below, t, 0).sum(axis=0), np.where(below, 0, t).sum(axis=0)
        open_ &= (np.abs(f) > EPS * k * (1 + np.abs(psi) + np.abs(phi))) & (high - low > EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            break
        high = np.where(f > 0, x, high)
        low = np.where(f <= 0, x, low)
        a, b = near - x, far - x
        c = f - dpsi * a - np.where(last, 0, dphi * b)
        s, u = dpsi * a * a, np.where(last, 0, dphi * b * b)
        m = c * (a + b) + s + u
        root = np.sqrt(np.maximum(m * m - 4 * a * b * f * c, 0))
        with np.errstate(all="ignore"):
            two = np.where(m > 0, 2 * a * b * f / (m + root), (m - root) / (2 * c))
            step = np.where(last, a + s / c, two)
            moved = x + step
        inside = np.isfinite(moved) & (moved > low) & (moved < high)
        x = np.where(open_, np.where(inside, moved, (low + high) / 2), x)
    return d[origin] + x, delta - x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigendecomposition of ``basis diag(values) basis' + weight * vector vector'``; values rise."""
    z = basis.T @ vector
    size = weight * float(z @ z)
    if not size > 0:
        return values, basis
    values, basis = values.copy(), basis.copy()
    tolerance = 8 * EPS * max(abs(values[-1]), size)
    z *= np.sqrt(weight)
    # equal eigenvalues: turn the two vectors until only the upper one is touched
    upper = -1
    for i in range(len(values)):
        if abs(z[i]) * np.sqrt(size) <= tolerance:
            continue
        if upper >= 0 and values[i] - values[upper] <= tolerance:
            r = np.hypot(z[i], z[upper])
            c, s = z[i] / r, z[upper] / r
            one, two = basis[:, upper].copy(), basis[:, i].copy()
            basis[:, upper], basis[:, i] = c * one - s * two, s * one + c * two
            z[upper], z[i] = 0, r
        upper = i
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > tolerance)
    if not len(live):
        return values, basis
    d = values[live]
    roots, gaps = secular_roots(d, z[live] ** 2)
    # the vector for which these roots are exact, so that the new basis is orthogonal
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1)
    exact = np.sqrt(np.abs(np.prod(-gaps / between, axis=1)))
    turned = np.copysign(exact, z[live])[:, None] / gaps
    turned /= np.linalg.norm(turned, axis=0)
    basis[:, live] = basis[:, live] @ turned
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Number, integer sums, mean and eigendecomposed scatter of some vectors."""

    def __init__(self, size: int):
        self.n, self.sums, self.mean = 0, np.zeros(size, np.int64), np.zeros(size)
        self.values, self.basis = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        delta = x - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, delta, self.n / (self.n + 1))
        self.n += 1
        self.sums += x
        self.mean += delta / self.n

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector, float(value))
        n = self.n + other.n
        if n:
            delta = other.mean - self.mean
            self.values, self.basis = rank_one(self.values, self.basis, delta, self.n * other.n / n)
            self.mean += delta * other.n / n
        self.n, self.sums = n, self.sums + other.sums

    def row(self) -> dict:
        return {
            "n": self.n, "sums": self.sums.tolist(), "mean": self.mean.tolist(),
            "values": self.values.tolist(), "basis": self.basis.ravel().tolist(),
        }

    @classmethod
    def of(cls, row) -> "Spectrum":
        out = cls(len(row["sums"]))
        out.n, out.sums, out.mean = row["n"], np.array(row["sums"], np.int64), np.array(row["mean"])
        out.values, out.basis = np.array(row["values"]), np.array(row["basis"]).reshape(len(out.values), -1)
        return out


SPECTRUM = "_key int, n long, sums array<long>, mean array<double>, values array<double>, basis array<double>"


def _matrix(batch: pa.RecordBatch, size: int, shift: int) -> np.ndarray:
    """Rows of integers; what a shorter vector lacks is an entry of 0."""
    column = batch.column(batch.schema.get_field_index("_x"))
    offsets = np.asarray(column.offsets)
    lengths = np.diff(offsets)
    out = np.full((len(column), size), shift, np.int64)
    at = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], lengths)
    out[np.repeat(np.arange(len(column)), lengths), at] = np.asarray(column.values)[offsets[0] : offsets[-1]]
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """``<id>, _x`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.transform(vector_col, lambda c: c.cast("double")).alias("_c"))
    bad = F.exists("_c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = rows.filter(F.col("_c").isNotNull() & ~bad)
    return kept.select(F.col("_id").alias(id_col), F.transform("_c", lambda c: F.floor(c * scale) + shift).alias("_x"))


def spectrum(rows: DataFrame, size: int, shift: int = SHIFT, fan_in: int = FAN_IN) -> Spectrum:
    """Number, sums and approximate eigendecomposition of all rows of :func:`integer_vectors`."""

    def update(batches):
        own, part = Spectrum(size), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column(batch.schema.get_field_index("_key"))[0].as_py()
                for x in _matrix(batch, size, shift):
                    own.add(x)
        if part is not None:
            yield pa.RecordBatch.from_pylist([{"_key": part, **own.row()}], schema=schema)

    def combine(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda row: row["_key"])
        own = Spectrum.of(found[0])
        for row in found[1:]:
            own.merge(Spectrum.of(row))
        return pa.Table.from_pylist([{"_key": found[0]["_key"], **own.row()}], schema=schema)

    numbers = pa.list_(pa.float64())
    schema = pa.schema(
        [("_key", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("mean", numbers), ("values", numbers), ("basis", numbers)]
    )
    parts = materialized(rows.select(F.spark_partition_id().alias("_key"), "_x").mapInArrow(update, SPECTRUM))
    left = parts.count()
    groups = left
    while groups > 1:
        groups = -(-groups // fan_in)
        parts = parts.groupBy(F.pmod("_key", F.lit(groups)).alias("_group")).applyInArrow(combine, SPECTRUM)
    own = Spectrum(size)
    for row in parts.collect():  # one row
        own.merge(Spectrum.of(row))
    return own


def summed(rows: DataFrame, size: int, shift: int, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the centred rows in a basis, summed up over partitions entry by entry."""

    def add(batches):
        total = None
        for batch in batches:
            y = _centred(_matrix(batch, size, shift), n, sums) @ basis
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"_sum": total.ravel().tolist()}], schema=pa.schema([("_sum", pa.list_(pa.float64()))]))

    parts = rows.select("_x").mapInArrow(add, "_sum array<double>")
    entries = parts.select(F.posexplode("_sum").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(basis.shape[1] ** 2)
    for row in entries.collect():  # as many as the covariance has entries
        out[row["at"]] = row["value"]
    return out.reshape(basis.shape[1], -1) / n


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``: the whole part of the mean goes in integers, its fraction after that."""
    return (x - sums // n) - (sums % n) / n


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of ``(n * x - sums) ** 2`` per row, exact; null beyond 63 bits."""
    y = x - sums // n
    rest = sums % n
    if (int(np.abs(y).max(initial=0)) + 1) ** 2 * n * n * x.shape[1] < 1 << 62:
        return ((y * n - rest) ** 2).sum(axis=1).tolist()
    rest = [int(r) for r in rest]
    out = [sum((n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in y]
    return [v if v < 1 << 63 else None for v in out]


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row per vector that takes part and component: ``<id>, component, n, deviation, whitened,
    explained, identity_error``. Component 1 has the largest eigenvalue of the covariance."""
    rows = integer_vectors(vectors, id_col, vector_col, scale, shift)
    size = rows.agg(F.max(F.size("_x"))).first()[0] or 0
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    found = spectrum(rows, size, shift)
    n, sums = found.n, found.sums
    basis, _ = np.linalg.qr(found.basis)
    values, turn = np.linalg.eigh(summed(rows, size, shift, n, sums, basis))
    order = np.argsort(-values, kind="stable")
    values, basis = np.maximum(values[order], 0), (basis @ turn)[:, order]
    trace = float(values.sum())
    live = min(components, int((values > size * EPS * 16 * values[0]).sum()))
    whitening = basis[:, :live] / np.sqrt(values[:live])
    error = None
    if live:
        error = float(np.abs(summed(rows, size, shift, n, sums, whitening) - np.eye(live)).max())
    many = min(components, size)
    explained = [float(v / trace) if trace > 0 else None for v in values[:many]]

    def project(batches):
        for batch in batches:
            x = _matrix(batch, size, shift)
            flat = np.zeros((len(x), many))
            flat[:, :live] = _centred(x, n, sums) @ whitening
            empty = np.zeros((len(x), many), bool)
            empty[:, live:] = True
            own = np.repeat(np.arange(len(x)), many)
            total = len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index(id_col)).take(pa.array(own)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(total, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(own)),
                    pa.array(flat.ravel(), pa.float64(), mask=empty.ravel()),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * total, pa.float64()),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
