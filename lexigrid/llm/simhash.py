"""Near-duplicate documents by SimHash: balls of half the radius that meet in the middle.

Fingerprints within ``radius`` bits of each other have a common variant within half the radius of
both. Every different fingerprint emits all variants within half the radius; whoever shares a
variant is compared. The shuffle is by the leading bits of the variants: a fingerprint goes once
into each bucket that any of its variants falls into, with the flips it has left, and the rest of
each variant is written out inside the bucket. Buckets with many rows are cut by further bits, down
to whole variants, which at most 2,081 fingerprints share (radius 4). A crowd at one variant is a
chain of neighbours there, not all its pairs, and a bucket hands on a spanning forest.

Defined cases: null and empty texts have no words and the fingerprint zero, which links like any
other; repeated rows come back as often as given; rows without id are linked but name no component,
unless no row of it has an id (null then); other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.llm.graph import components
from lexigrid.llm.registry import query
from lexigrid.plans.scale import join_hot, materialized

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
#: hashes counted at once
CHUNK = 1 << 14
#: variants written out at once inside a bucket
VARIANTS = 1 << 19
#: rows of an average bucket, and bits by which a crowded one is cut further
BUCKET = 1 << 16
CUT = 8


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash over all runs of ``size`` words, repeats included; fewer words are one run."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[min(size, len(words)) - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(ends), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(ends), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``id, fp`` of every row; the fingerprint's 64 bits stand in a signed number."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(text.as_py(), size) for text in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


@lru_cache(maxsize=512)
def flips(width: int, most: int) -> list[tuple[int, int]]:
    """All masks of ``width`` bits with at most ``most`` set, and how many each has."""
    return [(sum(1 << b for b in places), n) for n in range(most + 1) for places in combinations(range(width), n)]


@lru_cache(maxsize=512)
def _masks(width: int, most: int) -> np.ndarray:
    return np.array([m for m, _ in flips(width, most)], np.uint64)


def widened(rows: DataFrame, depth: int, width: int, half: int) -> DataFrame:
    """Rows of the buckets of ``depth + width`` leading bits that follow from those of ``depth``."""
    low = BITS - depth - width
    masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(n).alias("n")) for m, n in flips(width, half)])
    moved = rows.select("fp", "left", "prefix", F.explode(masks).alias("flip")).filter("flip.n <= left")
    bits: Column = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
    prefix = F.shiftleft("prefix", width).bitwiseOR(bits.bitwiseXOR(F.col("flip.mask").cast("long")))
    return moved.select("fp", (F.col("left") - F.col("flip.n")).alias("left"), prefix.alias("prefix"))


def _forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``root`` along the edges; the smaller number becomes the root."""
    while len(a):
        a, b = root[a], root[b]
        live = a != b
        a, b = np.minimum(a[live], b[live]), np.maximum(a[live], b[live])
        np.minimum.at(root, b, a)
        while (root[root] != root).any():
            root[:] = root[root]


def meet(fps: np.ndarray, left: np.ndarray, depth: int, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint of a bucket the number of the first one it is linked to there.

    Members share the leading ``depth`` bits of a variant and have ``left`` flips for the others.
    """
    root = np.arange(len(fps))
    half = radius // 2
    todo = [(np.arange(len(fps)), left, depth)]
    while todo:
        own, left, depth = todo.pop()
        if len(own) < 2:
            continue
        rest = BITS - depth
        masks = [_masks(rest, n) for n in range(half + 1)]
        if sum(int((left == n).sum()) * len(masks[n]) for n in range(half + 1)) > VARIANTS and rest > 4:
            bits = (fps[own] >> np.uint64(rest - 4)).astype(np.int64) & 15
            who, less, part = [], [], []
            for mask, n in flips(4, half):
                able = left >= n
                who.append(own[able])
                less.append(left[able] - n)
                part.append(bits[able] ^ mask)
            who, less, part = np.concatenate(who), np.concatenate(less), np.concatenate(part)
            todo += [(who[part == value], less[part == value], depth + 4) for value in range(16)]
            continue
        low_bits = np.uint64((1 << rest) - 1) if rest else np.uint64(0)
        variants, owners = [], []
        for n in range(half + 1):
            mine = own[left == n]
            variants.append(((fps[mine] & low_bits)[:, None] ^ masks[n][None, :]).ravel())
            owners.append(np.repeat(mine, len(masks[n])))
        key, owner = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        a, b = owner[same], owner[same + 1]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        _forest(root, a[near], b[near])
    return root


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: pairs of the distinct numbers ``fp`` that connect all numbers which steps of at most
    ``radius`` bits connect, and no others. The radius must be even."""
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even, so that half of it is a number of bits")
    half = radius // 2
    spark = fps.sparkSession
    n = fps.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    depth = next(w for w in range(1, 41) if w == 40 or 2**w >= max(parts, n * len(flips(w, half)) / bucket))
    rows = widened(fps.select("fp", F.lit(half).alias("left"), F.lit(0).cast("long").alias("prefix")), 0, depth, half)
    found = []
    while True:
        limit = max(4 * bucket, n * len(flips(depth, half)) // 1024)
        counts = rows.groupBy("prefix").agg(F.count("*").alias("n"))
        # fewer than 1,024 at each depth
        crowds = counts.filter(F.col("n") > limit).select("prefix") if depth < BITS else counts.limit(0).select("prefix")
        last = depth == BITS or crowds.isEmpty()
        calm = rows if last else rows.join(F.broadcast(crowds), "prefix", "left_anti")
        found.append(calm.select("fp", "left", "prefix", F.lit(depth).alias("depth")))
        if last:
            break
        rows = rows.join(F.broadcast(crowds), "prefix", "left_semi").select("fp", "left", "prefix")
        width = min(CUT, BITS - depth)
        rows = widened(rows, depth, width, half)
        depth += width
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.unionByName(more)

    def run(table: pa.Table) -> pa.Table:
        numbers = np.asarray(table.column("fp"), np.int64)
        order = np.argsort(numbers)
        numbers = numbers[order]
        root = meet(numbers.view(np.uint64), np.asarray(table.column("left"))[order], table.column("depth")[0].as_py(), radius)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": numbers[root[moved]], "b": numbers[moved]})

    return buckets.groupBy("depth", "prefix").applyInArrow(run, "a long, b long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``<id>, fingerprint, component_id`` of every row: the SimHash, and the smallest id that is
    reachable over fingerprints that differ in at most ``radius`` bits."""
    rows = materialized(with_fingerprints(docs, id_col, text_col))
    fps = materialized(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(fps, radius)).select(F.col("id").alias("fp"), "root")
    placed = materialized(fps.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = join_hot(placed.select("fp", "root"), least, "root").select("fp", "component_id")
    whole = join_hot(rows, named, "fp")
    return whole.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op12_simhash")
def op12_simhash(spark, sf_dir):
    return simhash_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
