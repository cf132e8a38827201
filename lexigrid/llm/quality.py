"""Quality classifier: ordinal regression with cumulative links on hashed text.

Ratings are integer grades. One weight vector over hashed features is shared by all grades;
ordered thresholds turn its score into ``P(grade > k)``. Features are two families of token
rates (square roots of shares, so each family has length one): lower-case words, and the shapes
of the chunks between white space (``NDOU!!`` has shape ``A!``, ``it.`` has ``a.``).

The model is fitted on a bounded sample of rated rows (``per_level`` rows of each grade); every
document is scored on its whole text. Defined cases: a null text counts as empty; an empty text
has no features and gets the scores of the thresholds alone; without ratings, or with one grade
only, every document gets that grade (0 without ratings) with tail probability 1 and is kept;
rows are independent, so repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import Texts, each_slice, lists, prefix_hash, span_hash
from lexigrid.llm.registry import query
from lexigrid.llm.samples import sample_labels

BUCKETS = 2048
#: bytes and rows of a slice: a row has ``2 * BUCKETS`` features, however short its text is
SLICE = (1 << 18, 256)

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(texts: Texts, buckets: int = BUCKETS) -> np.ndarray:
    """A row of ``2 * buckets`` square-rooted token shares per text."""
    n = len(texts)
    low = texts.lowered()
    starts, ends, first = low.words()
    words = span_hash(prefix_hash(low.data), starts, ends)
    # shapes: one letter per run of a class
    shape = _SHAPE[texts.data]
    kept = np.ones(len(shape), bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    before = np.concatenate([[0], np.cumsum(kept)])
    short = Texts(shape[kept], before[texts.offsets])
    s, e = short.runs(~_SPACE[short.data])
    shapes = span_hash(prefix_hash(short.data), s, e)
    out = np.empty((n, 2 * buckets), np.float32)
    for i, (hashes, owner) in enumerate(
        ((words, np.repeat(np.arange(n), np.diff(first))), (shapes, short.owner(s)))
    ):
        cell = owner * buckets + (hashes % np.uint64(buckets)).astype(np.int64)
        counts = np.bincount(cell, minlength=n * buckets).reshape(n, buckets)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        out[:, i * buckets : (i + 1) * buckets] = np.sqrt(counts / total)
    return out


@dataclass
class Ordinal:
    """Shared weights and one threshold between each two neighbouring grades."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > grades[k]) in column k."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, level: np.ndarray, weight: np.ndarray,
    grades: list[int], size: int, ridge: float = 2e-5, steps: int = 250,
) -> Ordinal:
    """Maximum likelihood by Adam over sparse rows; thresholds stay ordered as sums of exponentials."""
    n, k = len(level), len(grades) - 1
    if k < 1:
        return Ordinal(grades, np.zeros(size), np.zeros(0))
    weight = weight / weight.sum()
    share = [weight[level > i].sum() for i in range(k)]
    cut = np.array([-np.log(max(s, 1e-3) / max(1 - s, 1e-3)) for s in share])
    params = np.concatenate([np.zeros(size), cut[:1], np.log(np.maximum(np.diff(cut), 0.1))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w = params[:size]
        gaps = np.exp(params[size + 1 :])
        theta = params[size] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, values * w[columns], minlength=n)
        # P(level >= j) for j = 0 .. k + 1
        tail = np.ones((n, k + 2))
        tail[:, -1] = 0
        tail[:, 1:-1] = 1 / (1 + np.exp(-np.clip(score[:, None] - theta[None, :], -40, 40)))
        at = np.arange(n)
        upper, lower = tail[at, level], tail[at, level + 1]
        likely = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        d_score = -weight * (d_upper - d_lower)
        grad = np.zeros_like(params)
        grad[:size] = np.bincount(columns, values * d_score[rows], minlength=size) + ridge * w
        d_theta = np.zeros(k + 2)
        np.add.at(d_theta, level, weight * d_upper)
        np.add.at(d_theta, level + 1, -weight * d_lower)
        inner = d_theta[1:-1]
        grad[size] = inner.sum()
        grad[size + 1 :] = np.cumsum(inner[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    gaps = np.exp(params[size + 1 :])
    return Ordinal(grades, params[:size], params[size] + np.concatenate([[0], np.cumsum(gaps)]))


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, rating: str, per_level: int, buckets: int
) -> Ordinal:
    sample = sample_labels(ratings, id_col, rating, per_level)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rated = rows.join(F.broadcast(sample), "_id").select("_level", "_weight", "_text")

    def sparse(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        x = features(texts, buckets)
        r, c = np.nonzero(x)
        bounds = np.searchsorted(r, np.arange(len(x) + 1))
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), lists(c, bounds, pa.int32()), lists(x[r, c], bounds, pa.float32())],
            ["_level", "_weight", "at", "x"],
        )

    # bounded by per_level rows for each grade, each with at most 2 * buckets numbers
    got = rated.mapInArrow(
        each_slice(sparse, "_text", *SLICE), "_level int, _weight double, at array<int>, x array<float>"
    ).toPandas()
    grades = sorted(int(g) for g in got["_level"].unique())
    if not grades:
        return Ordinal([0], np.zeros(2 * buckets), np.zeros(0))
    sizes = got["at"].str.len().to_numpy()
    return fit_ordinal(
        np.repeat(np.arange(len(got)), sizes),
        # an empty list comes without a type, and would make all of them floats
        np.concatenate(got["at"].to_numpy()).astype(np.int64),
        np.concatenate(got["x"].to_numpy()).astype(float),
        np.searchsorted(grades, got["_level"].to_numpy()),
        got["_weight"].to_numpy(),
        grades,
        2 * buckets,
    )


def quality_scores(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rating: str = "quality",
    at_least: int | None = None,
    min_tail: float = 0.5,
    per_level: int = 4000,
    buckets: int = BUCKETS,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``expected_grade``, ``tail_prob`` and ``selected``.

    ``tail_prob`` is the chance of a grade of ``at_least`` (the highest grade, if not given);
    a document is selected if it reaches ``min_tail``. ``per_level`` bounds the rated rows that
    the model sees. Columns of ``docs`` with the names of the new ones are replaced.
    """
    model = train(docs, ratings, id_col, text_col, rating, per_level, buckets)
    target = model.grades[-1] if at_least is None else at_least
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = [("expected_grade", pa.float64()), ("tail_prob", pa.float64()), ("selected", pa.bool_())]
    kept = [c for c in docs.columns if c not in {name for name, _ in new}]

    def score(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        m = shared.value
        above = m.above(features(texts, buckets) @ m.weights)
        grades = np.array(m.grades, float)
        expected = grades[0] + above @ np.diff(grades)
        below = sum(g < target for g in m.grades)
        tail = np.ones(len(texts)) if below == 0 else above[:, below - 1] if below < len(grades) else np.zeros(len(texts))
        arrays = [part.column(part.schema.get_field_index(c)) for c in kept]
        arrays += [pa.array(x, t) for x, (_, t) in zip((expected, tail, tail >= min_tail), new)]
        return pa.RecordBatch.from_arrays(arrays, [*kept, *[name for name, _ in new]])

    schema = docs.select(*kept).schema.add("expected_grade", "double").add("tail_prob", "double").add("selected", "boolean")
    return docs.select(*kept).mapInArrow(each_slice(score, text_col, *SLICE), schema)


@query("op2_quality_classifier")
def op2_quality_classifier(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "expected_grade", "tail_prob", "selected")
