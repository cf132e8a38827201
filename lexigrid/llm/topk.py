"""Exact top-k search by inner product over a bit-sliced index.

Components are quantised to integers. The index holds, per block of rows, one bitmap for every
attribute and bit (a slice; bit ``i`` of a bitmap is row ``i`` in order of id). For a query, each
slice counts with the bits of the query's component: the slices are added with bitmap arithmetic
(full adders over whole bitmaps), which gives the scores of all rows of the block as slices again.
The best rows are selected from the most significant slice downward, and the rows still tied at
the boundary are resolved by id. The best of all blocks are then merged per query.

Negative components count through complements of the slices; constants are added at the end.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows with a null
id take no part; shorter vectors count as filled up with zeros; a query never meets rows of its own
id; repeated ids are candidates each; a query row that is repeated with the same vector is answered
once, one repeated with another vector has its own answer, ranked by itself; fewer candidates than ``k`` give fewer rows; an empty table
gives no rows. Scores must fit into 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.registry import query
from lexigrid.plans.scale import top_per_group

BLOCK_ROWS = 32768
QUERY_ROWS = 64


def _vectors(table: pa.Table, size: int) -> np.ndarray:
    column = table.column("_v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    n = len(column)
    offsets = np.asarray(column.offsets)
    lengths = np.diff(offsets)
    out = np.zeros((n, size), np.int64)
    row = np.repeat(np.arange(n), lengths)
    flat = np.asarray(column.values)[offsets[0] : offsets[-1]]
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    return out


def slice_block(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value per attribute, and bitmaps [attribute, bit, word] of what exceeds it."""
    least = vectors.min(axis=0)
    above = (vectors - least).astype(np.uint64)
    bits = max(1, int(above.max()).bit_length())
    rows = -(-len(vectors) // 64) * 64
    maps = np.zeros((vectors.shape[1], bits, rows // 64), np.uint64)
    for b in range(bits):
        flags = np.zeros((vectors.shape[1], rows), bool)
        flags[:, : len(vectors)] = ((above >> np.uint64(b)) & np.uint64(1)).T
        maps[:, b] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
    return least, maps


def add_slices(maps: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of ``sum(|weight| * u)``, least significant first; ``u`` is the attribute, or its
    complement where the weight is negative. Three bitmaps of a place become one there and one a
    place up, until one is left."""
    size, negative = np.abs(weights), weights < 0
    places: list[list[np.ndarray]] = []
    for a in range(int(size.max(initial=0)).bit_length()):
        own = (size >> a) & 1 == 1
        plain, flipped = maps[own & ~negative], ~maps[own & negative]
        for b in range(maps.shape[1]):
            while len(places) <= a + b:
                places.append([])
            places[a + b] += [plain[:, b], flipped[:, b]]
    out, carry = [], []
    at = 0
    while at < len(places) or carry:
        stack = np.concatenate([*(places[at] if at < len(places) else []), *carry])
        carry = []
        while len(stack) > 1:
            third = len(stack) // 3
            if third:
                x, y, z = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                both = x ^ y
                carry.append((x & y) | (both & z))
                stack = np.concatenate([both ^ z, stack[3 * third :]])
            else:
                carry.append(stack[:1] & stack[1:2])
                stack = stack[:1] ^ stack[1:2]
        out.append(stack[0] if len(stack) else np.zeros(maps.shape[2], np.uint64))
        at += 1
    return out


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(slices: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best rows, from the most significant slice down; ties go to the smaller row."""
    sure, tied = np.zeros_like(allowed), allowed
    n_sure, n_tied = 0, int(np.bitwise_count(allowed).sum())
    for bitmap in reversed(slices):
        if n_sure + n_tied <= k:
            break
        high = tied & bitmap
        n = int(np.bitwise_count(high).sum())
        if n_sure + n >= k:
            tied, n_tied = high, n
        else:
            sure, n_sure = sure | high, n_sure + n
            tied, n_tied = tied & ~bitmap, n_tied - n
    return np.concatenate([_rows_of(sure), _rows_of(tied)[: k - n_sure]])


def top_scores(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the ``k`` best rows of ``vectors`` for each query row.

    Rows and queries meet in blocks of fixed size; a block of queries visits every block of rows.
    """

    def usable(df: DataFrame) -> DataFrame:
        x = df.select(F.col(id_col).cast("long").alias("_id"), F.transform(vector_col, lambda c: c.cast("double")).alias("_x"))
        bad = F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
        kept = x.filter(F.col("_id").isNotNull() & F.col("_x").isNotNull() & ~bad)
        return kept.select("_id", F.transform("_x", lambda c: F.floor(c * scale)).alias("_v"))

    rows, asked = usable(vectors), usable(queries)
    n, size = rows.agg(F.count("*"), F.max(F.size("_v"))).first()
    n_asked, size_asked = asked.agg(F.count("*"), F.max(F.size("_v"))).first()
    size = max(size or 0, size_asked or 0, 1)
    n_blocks, n_groups = -(-n // block_rows) or 1, -(-n_asked // query_rows) or 1

    def index(table: pa.Table) -> pa.Table:
        # a query block's vector order does not matter, a row block is in order of id
        table = table.sort_by("_id")
        least, maps = slice_block(_vectors(table, size))
        return pa.table(
            {
                "_block": pa.array([table.column("_block")[0].as_py()], pa.int32()),
                "_ids": pa.array([np.asarray(table.column("_id"), np.int64).tobytes()], pa.binary()),
                "_least": pa.array([least.tobytes()], pa.binary()),
                "_maps": pa.array([maps.tobytes()], pa.binary()),
            }
        )

    def pack(table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "_group": pa.array([table.column("_group")[0].as_py()], pa.int32()),
                "_asked": pa.array([np.asarray(table.column("_id"), np.int64).tobytes()], pa.binary()),
                "_rows": pa.array([np.asarray(table.column("_row"), np.int64).tobytes()], pa.binary()),
                "_weights": pa.array([_vectors(table, size).tobytes()], pa.binary()),
            }
        )

    def dealt(column: str, parts: int):
        return F.pmod(F.xxhash64(column, F.lit(5)), F.lit(parts)).cast("int")

    blocks = rows.withColumn("_block", dealt("_id", n_blocks)).groupBy("_block").applyInArrow(
        index, "_block int, _ids binary, _least binary, _maps binary"
    )
    own_row = asked.dropDuplicates(["_id", "_v"]).withColumn("_row", F.xxhash64("_id", "_v"))
    groups = own_row.withColumn("_group", dealt("_row", n_groups)).groupBy("_group").applyInArrow(
        pack, "_group int, _asked binary, _rows binary, _weights binary"
    )
    met = groups.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(blocks, "_block")

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["_ids"], np.int64)
                least = np.frombuffer(row["_least"], np.int64)
                words = -(-len(ids) // 64)
                maps = np.frombuffer(row["_maps"], np.uint64).reshape(size, -1, words)
                full = (1 << maps.shape[1]) - 1
                every = np.zeros(words * 64, bool)
                every[: len(ids)] = True
                out = [[], [], [], []]
                weights = np.frombuffer(row["_weights"], np.int64).reshape(-1, size)
                for own, number, w in zip(np.frombuffer(row["_asked"], np.int64), np.frombuffer(row["_rows"], np.int64), weights):
                    lo, hi = np.searchsorted(ids, [own, own + 1])
                    every[lo:hi] = False
                    allowed = np.packbits(every, bitorder="little").view(np.uint64)
                    every[lo:hi] = True
                    slices = add_slices(maps, w)
                    best = select_top(slices, allowed, k)
                    score = np.zeros(len(best), np.int64)
                    for i, bitmap in enumerate(slices):
                        score += ((bitmap[best >> 6] >> (best & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << i
                    # complements were taken from the full range, and every row from the smallest value
                    score += int((w * least).sum()) + int((w[w < 0]).sum()) * full
                    out[0].append(np.full(len(best), own))
                    out[1].append(np.full(len(best), number))
                    out[2].append(ids[best])
                    out[3].append(score)
                names = ["query_id", "_row", "_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], names)

    found = met.repartition(F.col("_group"), F.col("_block")).mapInArrow(search, "query_id long, _row long, _id long, score long")
    best = top_per_group(found, ["query_id", "_row"], [F.desc("score"), F.col("_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("_id").alias(id_col), "score")


TOP_SQL = """
WITH bad AS (
    SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
    WHERE x IS NULL OR isnan(x) OR isinf(x)),
q AS (
    SELECT vec_id, generate_subscripts(embedding, 1) AS d, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
    FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.v * b.v) AS BIGINT) AS score
    FROM q a JOIN q b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op8_exact_topk", TOP_SQL)
def op8_exact_topk(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_scores(vectors, vectors.filter("vec_id % 20 = 0"), 20)
