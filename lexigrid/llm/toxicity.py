"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features: density and weight of lexicon words, those within three words of a second-person
pronoun, those that appear only after undoing look-alike characters, capitals, exclamation marks,
punctuation, mixed words and length. The lexicon is learned too: words much more frequent in
toxic rows than elsewhere, and starts of words, since endings and compounds vary by language.

Everything is learned from a bounded sample of labelled rows outside the held-out fifth, in four
parts. The features of each part come from the lexicon of the other three, those of unrated rows
from the lexicon of all; three parts give the trees, one the calibration. Defined cases: a null text
counts as empty and is scored like any other; without labels of both classes every score is the
share of label 1 (0 without labels); a null id is not held out; rows are independent, so repeated
rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import IS_WORD, Texts, each_slice, hash_bytes, lists, prefix_hash, span_hash
from lexigrid.llm.registry import query
from lexigrid.llm.samples import sample_labels

#: second-person words of the main languages (fixed values)
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch sie tu toi te ton vous votre usted ustedes tú vosotros".split()
NEAR = 3
#: lengths in bytes of the starts of words in the lexicon, and what tells these from whole words
STARTS, _START = (4, 5, 6, 7, 8), np.uint64(0x5A17C0DE5A17C0DE)
PARTS = 4
_LOOKALIKE = np.arange(256, dtype=np.uint8)
_LOOKALIKE[list(b"013457@$!")] = list(b"oieastasi")
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _units(texts: Texts) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, then of their starts of each length (of the word itself where that is
    shorter), and the words' places."""
    starts, ends, first = texts.words()
    sums = prefix_hash(texts.data)
    whole = span_hash(sums, starts, ends)
    begun = []
    for k in STARTS:
        long = ends - starts >= k
        begun.append(np.where(long, span_hash(sums, starts, np.minimum(starts + k, ends)) ^ _START, whole))
    return whole, begun, starts, ends, first


def _most(whole: np.ndarray, begun: list[np.ndarray], lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per word the largest weight of the word and its starts."""
    out = _weights(whole, lexicon, weights)
    for hashes in begun:
        out = np.maximum(out, _weights(hashes, lexicon, weights))
    return out


def _weights(hashes: np.ndarray, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, weights[at], 0.0)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=float)])
    return total[bounds[1:]] - total[bounds[:-1]]


def dense_features(texts: Texts, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    low = texts.lowered()
    hashes, begun, starts, ends, first = _units(low)
    n = np.maximum(np.diff(first), 1)
    weight = _most(hashes, begun, lexicon, weights)
    hit = weight > 0
    pronouns = np.sort(np.array([hash_bytes(w.encode()) for w in SECOND_PERSON], np.uint64))
    person = _weights(hashes, pronouns, np.ones(len(pronouns))) > 0
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    near = np.zeros(len(hashes), bool)
    for d in range(1, NEAR + 1):
        same = owner[d:] == owner[:-d]
        near[d:] |= person[:-d] & same
        near[:-d] |= person[d:] & same
    plain = Texts(_LOOKALIKE[low.data], low.offsets)
    h2, begun2, _, _, first2 = _units(plain)
    undone = _most(h2, begun2, lexicon, weights) > 0
    hits, hits2 = _sums(hit, first), _sums(undone, first2)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[low.data])])
    n_digits = digits[ends] - digits[starts]
    mixed = (n_digits > 0) & (n_digits < ends - starts)
    size = np.maximum(np.diff(texts.offsets), 1)
    total = _sums(weight, first)
    data = texts.data
    return np.column_stack(
        [
            hits,
            hits / n,
            total,
            total / n,
            _sums(hit & near, first),
            _sums(hit & near, first) / n,
            np.maximum(hits2 - hits, 0),
            np.maximum(hits2 - hits, 0) / n,
            _sums(person, first) / n,
            _sums(_UPPER[data], texts.offsets) / size,
            _sums(data == 33, texts.offsets) / size,
            _sums(~IS_WORD[data] & ~_SPACE[data], texts.offsets) / size,
            _sums(mixed, first) / n,
            np.log1p(np.diff(first)),
        ]
    )


@dataclass
class Trees:
    """Depth-limited regression trees as arrays: feature, cut, and leaf values in heap order."""

    base: float
    depth: int
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Boosting on logistic loss with histograms over quantile bins."""
    share = np.clip(np.average(y, weights=w), 1e-4, 1 - 1e-4)
    model = Trees(float(np.log(share / (1 - share))), depth, [])
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    w = w / w.mean()
    raw = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (p - y), w * np.maximum(p * (1 - p), 1e-6)
        inner = 2**depth - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            low = 2**level - 1
            for at in range(low, 2 * low + 1):
                own = node == at
                best = 1e-6
                gs, hs = g[own].sum(), h[own].sum()
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(binned[own, f], g[own], minlength=len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[own, f], h[own], minlength=len(c) + 1))[:-1]
                    gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                    gain[(hl < 1) | (hs - hl < 1)] = 0
                    if len(gain) and gain.max() > best:
                        best, feature[at], cut[at] = gain.max(), f, c[int(gain.argmax())]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, minlength=inner + 1), np.bincount(leaf, h, minlength=inner + 1)
        value = -rate * gs / (hs + ridge)
        model.trees.append((feature, cut, value))
        raw += value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit: pool neighbours until no mean falls."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, target, weight in zip(score[order], y[order], w[order]):
        blocks.append([target * weight, weight, s, s])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + top[0], blocks[-1][1] + top[1], blocks[-1][2], top[3]]
    at, value = [], []
    for total, weight, lo, hi in blocks:
        at += [lo, hi]
        value += [total / weight] * 2
    return np.array(at), np.array(value)


@dataclass
class Toxicity:
    lexicon: np.ndarray
    weights: np.ndarray
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float

    def score(self, texts: Texts) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        raw = self.trees.raw(dense_features(texts, self.lexicon, self.weights))
        out = np.interp(raw, *self.knots)
        # a small part of the uncalibrated score orders rows within a level of the calibration
        return np.clip(0.98 * out + 0.02 / (1 + np.exp(-raw)), 0, 1)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str,
    per_level: int, least: int, folds: int,
) -> Toxicity:
    usable = labels.filter(F.crc32(F.col(id_col).cast("string")) % folds != 0)
    usable = usable.withColumn(label, (F.col(label) > 0).cast("int"))
    sample = sample_labels(usable, id_col, label, per_level)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rated = rows.join(F.broadcast(sample), "_id").select(
        "_level", "_weight", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(PARTS)).cast("int").alias("_part"), "_text"
    )

    def distinct(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        whole, begun, _, _, first = _units(texts.lowered())
        own = [np.unique(np.concatenate([h[a:b] for h in (whole, *begun)])) for a, b in zip(first, first[1:])]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        flat = np.concatenate(own) if own else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), lists(flat.view(np.int64), bounds, pa.int64())], ["_level", "_part", "_words"]
        )

    words = rated.mapInArrow(each_slice(distinct, "_text"), "_level int, _part int, _words array<long>")
    totals = {(r["_level"], r["_part"]): r["count"] for r in rated.groupBy("_level", "_part").count().collect()}
    n = [sum(c for (level, _), c in totals.items() if level == k) for k in (0, 1)]
    if not n[0] or not n[1]:
        return Toxicity(np.empty(0, np.uint64), np.empty(0), None, None, n[1] / (n[0] + n[1]) if sum(n) else 0.0)
    in_part = lambda level, p: F.sum(((F.col("_level") == level) & (F.col("_part") == p)).cast("long"))
    counts = (
        words.select("_level", "_part", F.explode("_words").alias("word"))
        .groupBy("word")
        .agg(*[in_part(level, p).alias(f"{'ba'[level]}{p}") for level in (0, 1) for p in range(PARTS)])
    )

    def apart(left_out: int) -> tuple:
        """Odds and z of each unit without one part (without none: -1)."""
        parts = [p for p in range(PARTS) if p != left_out]
        seen = [sum((F.col(f"{c}{p}") for p in parts), F.lit(0)) for c in "ba"]
        size = [sum(totals.get((level, p), 0) for p in parts) for level in (0, 1)]
        odds = F.log((seen[1] + 0.5) / (size[1] + 1.0)) - F.log((seen[0] + 0.5) / (size[0] + 1.0))
        z = odds / F.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
        return odds, F.when((seen[1] >= least) & (z > 4), z).otherwise(0.0)

    kept = [apart(p) for p in range(-1, PARTS)]
    table = counts.select("word", *[c.alias(f"{name}{i}") for i, pair in enumerate(kept) for name, c in zip(("odds", "z"), pair)])
    table = table.withColumn("_z", F.greatest(*[f"z{i}" for i in range(len(kept))])).filter("_z > 0")
    table = table.orderBy(F.desc("_z"), "word").toPandas()  # of a bounded sample
    lexicons = []
    for i in range(len(kept)):
        own = table[table[f"z{i}"] > 0]
        hashes = own["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        lexicons.append((hashes[order], own[f"odds{i}"].to_numpy(float)[order]))
    lexicon, weights = lexicons[0]

    def dense(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        own = part.column(2).to_numpy()
        each = [dense_features(texts, *lexicons[1 + p]) for p in range(PARTS)]
        x = np.choose(own[:, None], each)
        bounds = np.arange(len(x) + 1) * x.shape[1]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), part.column(2), lists(x.ravel(), bounds, pa.float64())], ["_level", "_weight", "_part", "x"]
        )

    # bounded by 2 * per_level rows
    got = rated.mapInArrow(each_slice(dense, "_text"), "_level int, _weight double, _part int, x array<double>").toPandas()
    y, w, fit = got["_level"].to_numpy(float), got["_weight"].to_numpy(float), got["_part"].to_numpy() != PARTS - 1
    share = n[1] / sum(n)
    if len({*y[fit]}) < 2 or len({*y[~fit]}) < 2:
        return Toxicity(lexicon, weights, None, None, share)
    x = np.stack(got["x"].to_numpy())
    trees = fit_trees(x[fit], y[fit], w[fit])
    return Toxicity(lexicon, weights, trees, isotonic(trees.raw(x[~fit]), y[~fit], w[~fit]), share)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    per_level: int = 6000,
    least: int = 5,
    folds: int = 5,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted``.

    ``per_level`` bounds the labelled rows of each class that are learned from. Rows whose crc32 of the id is divisible by ``folds`` are held out.
    """
    model = train(docs, labels, id_col, text_col, label, per_level, least, folds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.score(texts), pa.float64())], ["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    scored = rows.mapInArrow(each_slice(score, "_text"), f"_id {kind}, score double")
    held = F.coalesce(F.crc32(F.col("_id").cast("string")) % folds == 0, F.lit(False))
    return scored.select(
        F.col("_id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
