"""Jaccard join of word shingles by chosen paths.

Texts are sets of shingles (five words; a shorter text is one shingle). Equal sets are one node
with a number of copies. Sets are split along chosen paths: a run starts with one min-hash
coordinate, and the sets that share its value are a bucket; a bucket that is too large is split
again by coordinates drawn from its own path, until it is small. Small buckets are compared in
full by their min-hash sketches. In a larger one all sets are compared with one that is drawn anew for
each bucket: those alike are linked to it, and it and those close to it go no further. A branch that keeps at least half of its bucket is taken whole
as one cluster instead of being split on. Runs with fresh paths repeat until a pair at the
threshold is met with the target recall.

What the paths give are candidates: they only decide which sets are brought together. Connected
candidates are then compared exactly, shingle by shingle, all with all, in parts of at most
``part`` sets; sets whose sizes rule a link out do not meet. So links are exact within
candidates, and a pair that the paths miss is still found if both are candidates of one group.

Defined cases: null and empty texts have no shingles and stand alone; texts below five words match
equal texts only; rows with the same id and text are copies of each other; null ids are kept;
an empty table gives no rows. Class ids are the smallest document id of the class (null if all
its ids are null).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import U64, Texts, each_slice, grams, lists, mix, prefix_hash, span_hash
from lexigrid.llm.graph import components
from lexigrid.llm.registry import query
from lexigrid.llm.words import broadcast_if_small
from lexigrid.plans.scale import materialized, salted_join

COORDINATES = 64
BRANCHES = 2
SMALL_BUCKET = 64
PART = 256
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    low = texts.lowered()
    starts, ends, first = low.words()
    words = span_hash(prefix_hash(low.data), starts, ends)
    whole = grams(words, size)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        else:
            out.append(grams(words[a:b], b - a) if b > a else np.empty(0, U64))
    return out


def runs_for(threshold: float, recall: float) -> int:
    """Runs until a pair at the threshold shares a small bucket with probability ``recall``.

    A run keeps the pair with ``threshold`` at its first step; later steps have two branches, and
    such a branching process goes on with the share that solves q = 1 - (1 - t q) ** 2.
    """
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - threshold * q) ** BRANCHES
    runs = math.ceil(math.log(1 - recall) / math.log(1 - threshold * q))
    if runs > COORDINATES:
        raise ValueError(f"recall {recall} at similarity {threshold} takes {runs} runs, and a set has {COORDINATES} coordinates")
    return runs


def _signed(rows: DataFrame, size: int, runs: int) -> DataFrame:
    """Per document the id of its set, the set's size, its min-hashes and its sketch."""

    def sign(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        sets = shingle_sets(texts, size)
        n = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(n)
        flat = np.concatenate(sets) if len(sets) else np.empty(0, U64)
        heads = (np.cumsum(n) - n)[full]
        mins = np.zeros((len(sets), COORDINATES), np.int32)
        ids = np.zeros(len(sets), U64)
        if len(full):
            for i, seed in enumerate(_SEEDS):
                spread = flat * seed
                low = np.minimum.reduceat(spread ^ (spread >> U64(29)), heads)
                mins[full, i] = (mix(low) >> U64(32)).astype(np.uint32).view(np.int32)
            ids[full] = mix(np.add.reduceat(mix(flat), heads))
        bounds = np.arange(len(sets) + 1) * COORDINATES
        sketch = [row.tobytes() for row in mins.astype(np.uint8)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(ids.view(np.int64)), pa.array(n), lists(mins.ravel(), bounds, pa.int32()), pa.array(sketch, pa.binary())],
            ["_id", "_key", "_set", "_n", "_mins", "_sketch"],
        )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _key long, _set long, _n long, _mins array<int>, _sketch binary"
    return rows.select("_id", "_key", "_text").mapInArrow(each_slice(sign, "_text"), schema)


def _similar(least: int):
    """Links of each small bucket (rows sorted by bucket): a star per cluster of alike sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            bucket = table.column("_bucket").to_numpy()
            # the last bucket may go on in the next batch
            other = np.flatnonzero(bucket != bucket[-1]) if len(bucket) else []
            last = int(other[-1]) + 1 if len(other) else 0
            held = table.slice(last)
            if last:
                yield from _stars(table.slice(0, last), least)
        if held is not None and held.num_rows:
            yield from _stars(held, least)

    return run


def _stars(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    bucket, ids = table.column("_bucket").to_numpy(), table.column("_set").to_numpy()
    sketch = np.frombuffer(b"".join(table.column("_sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
    a, b, at, step = [], [], np.arange(len(ids)), 1
    while True:
        at = at[at + step < len(ids)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            break
        alike = (sketch[at] == sketch[at + step]).sum(axis=1) >= least
        a.append(at[alike])
        b.append(at[alike] + step)
        step += 1
    if a:
        x, y = np.concatenate(a), np.concatenate(b)
        label = np.arange(len(ids))
        while True:
            low = np.minimum(label[x], label[y])
            new = label.copy()
            np.minimum.at(new, x, low)
            np.minimum.at(new, y, low)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[label[moved]]), pa.array(ids[moved])], ["a", "b"])


def candidate_links(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """``a, b``: links that put every pair at the threshold into one connected part."""
    runs = runs_for(threshold, recall)
    # a sketch's share of equal bytes lies five standard deviations below the threshold at least
    least = math.floor(COORDINATES * threshold - 5 * math.sqrt(COORDINATES * threshold * (1 - threshold)))
    coordinate = lambda bucket, branch: F.pmod(F.xxhash64(bucket, F.lit(branch)), F.lit(COORDINATES)).cast("int")
    value = lambda mins, at: F.element_at(mins, at + 1)
    spread = F.posexplode(F.slice("_mins", 1, runs)).alias("_run", "_value")
    rows = sets.select("_set", spread).select("_set", F.xxhash64("_run", "_value").alias("_bucket"), F.lit(None).cast("long").alias("_parent_size"))
    # sets this near to one that is linked to all its partners share these partners' links
    close = math.ceil(COORDINATES * (1 + threshold) / 2 - math.sqrt(COORDINATES * (1 - threshold) * threshold))
    equal = F.aggregate(F.zip_with("_mins", "_of", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    found = []
    while True:
        # another middle in each bucket, so that no set is the middle of all paths
        drawn = F.min(F.struct(F.xxhash64("_bucket", "_set").alias("draw"), "_set"))
        sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"), drawn["_set"].alias("_middle")).filter("_size > 1")
        placed = materialized(rows.join(sizes, "_bucket"))
        small = placed.filter(F.col("_size") <= SMALL_BUCKET).select("_bucket", "_set")
        held = small.join(sets.select("_set", "_sketch"), "_set").repartition("_bucket").sortWithinPartitions("_bucket", "_set")
        found.append(held.mapInArrow(_similar(least), "a long, b long"))
        large = placed.filter((F.col("_size") > SMALL_BUCKET) & (F.col("_set") != F.col("_middle")))
        middles = placed.filter((F.col("_size") > SMALL_BUCKET) & (F.col("_set") == F.col("_middle"))).select("_bucket", "_set")
        middles = middles.join(sets.select("_set", F.col("_mins").alias("_of")), "_set").select("_bucket", "_of")
        met = salted_join(large.join(sets.select("_set", "_mins"), "_set"), middles, ["_bucket"])
        met = materialized(met.select("_set", "_bucket", "_size", "_parent_size", "_middle", equal.alias("_equal")))
        whole = (F.col("_parent_size").isNotNull()) & (2 * F.col("_size") >= F.col("_parent_size"))
        found.append(met.filter(whole | (F.col("_equal") >= least)).select(F.col("_middle").alias("a"), F.col("_set").alias("b")))
        active = met.filter(~whole & (F.col("_equal") < close)).select("_set", "_bucket", "_size")
        if active.isEmpty():
            break
        branch = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), coordinate(F.col("_bucket"), i).alias("at")) for i in range(BRANCHES)]))
        split = active.join(sets.select("_set", "_mins"), "_set").select("_set", "_bucket", "_size", "_mins", branch.alias("_branch"))
        rows = split.select(
            "_set",
            F.xxhash64("_bucket", "_branch.i", "_branch.at", value(F.col("_mins"), F.col("_branch.at"))).alias("_bucket"),
            F.col("_size").alias("_parent_size"),
        )
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    return links.distinct()


def _compare(threshold: float):
    """Exact links of each part (rows sorted by part): per set its number of linked documents and
    the smallest set of its cluster in the part."""

    def pairs(part: list[np.ndarray], side: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = len(part)
        if m == 2:
            shared = np.array([[n[0], 0], [0, n[1]]], float)
            shared[0, 1] = shared[1, 0] = len(np.intersect1d(part[0], part[1], assume_unique=True))
        else:
            flat = np.concatenate(part)
            _, column = np.unique(flat, return_inverse=True)
            row = np.repeat(np.arange(m), n)
            common = np.bincount(column)[column] > 1
            row, column = row[common], column[common]
            _, column = np.unique(column, return_inverse=True)
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            shared = np.zeros((m, m))
            width = 4096
            top = int(column[-1]) + 1 if len(column) else 0
            for lo in range(0, top, width):
                a, b = np.searchsorted(column, [lo, lo + width])
                block = np.zeros((m, width), np.float32)
                block[row[a:b], column[a:b] - lo] = 1
                shared += block @ block.T
        union = n[:, None] + n[None, :] - shared
        linked = shared >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if side.any():
            linked &= side[:, None] != side[None, :]
        return linked

    def judged(rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("_set").to_numpy()
        # repeated documents bring a set more than once
        rows = rows.take(np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])))
        ids, copies = rows.column("_set").to_numpy(), rows.column("_copies").to_numpy()
        side = rows.column("_side").to_numpy()
        part = [np.asarray(x.values).view(U64) for x in rows.column("_shingles")]
        linked = pairs(part, side, np.array([len(p) for p in part]))
        label = np.arange(len(ids))
        x, y = np.nonzero(linked)
        while len(x):
            new = label.copy()
            np.minimum.at(new, x, label[y])
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64)), pa.array(ids[label])], ["_set", "_links", "_peer"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            key = held.column("_part").to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
            for a, b in zip(heads, heads[1:]):
                yield judged(held.slice(a, b - a))
            if len(heads):
                held = held.slice(heads[-1])
        if held is not None and held.num_rows:
            yield judged(held)

    return run


def _parts(groups: DataFrame, threshold: float, part: int) -> DataFrame:
    """``_set, _part, _side``: where each set of a group is compared.

    A group of at most ``part`` sets is one part. A larger one is cut by size class (sets of
    classes further apart than one cannot reach the threshold) and by hash; every two cuts of the
    same or of neighbouring classes are a part.
    """
    sized = groups.withColumn("_class", F.floor(F.log(F.col("_n").cast("double")) / math.log(1 / threshold)).cast("int"))
    totals = sized.groupBy("root").agg(F.count("*").alias("_total"))
    classes = sized.groupBy("root", "_class").agg(F.ceil(F.count("*") / part).cast("int").alias("_cuts"))
    # a group has as many size classes as the logarithm of its sizes allows
    tables = classes.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("_class", "_cuts"))).alias("_cuts"))
    known = sized.join(totals, "root").join(tables, "root")
    cuts = lambda step: F.coalesce(F.try_element_at("_cuts", F.col("_class") + step), F.lit(0))
    cut = F.pmod(F.xxhash64("_set", F.lit(9)), cuts(0)).cast("int")
    known = known.withColumn("_cut", cut)
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda c, low, high, side, up: F.struct(F.xxhash64("root", c, low, high, F.lit(up)).alias("part"), side.cast("int").alias("side"))
    own = F.col("_cut")
    within = F.transform(
        numbers(cuts(0)),
        lambda o: place(F.col("_class"), F.least(o, own), F.greatest(o, own), F.when(o == own, 0).when(own < o, 1).otherwise(2), 0),
    )
    above = F.transform(numbers(cuts(1)), lambda o: place(F.col("_class"), own, o, F.lit(1), 1))
    below = F.transform(numbers(cuts(-1)), lambda o: place(F.col("_class") - 1, o, own, F.lit(2), 1))
    alone = F.array(F.struct(F.xxhash64("root").alias("part"), F.lit(0).alias("side")))
    places = F.when(F.col("_total") <= part, alone).otherwise(F.concat(within, above, below))
    return known.select("_set", "_n", "_copies", "_first", places.alias("_places"))


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, recall: float, part: int) -> DataFrame:
    """Per document ``_id, _key`` and what :func:`jaccard_classes` tells."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn("_key", F.xxhash64("_id", "_text"))
    signed = materialized(_signed(rows, size, runs_for(threshold, recall)))
    sets = signed.filter("_n > 0").groupBy("_set").agg(
        F.max("_n").alias("_n"),
        F.count("*").alias("_copies"),
        F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_key")).alias("_first"),
        F.first("_mins").alias("_mins"),
        F.first("_sketch").alias("_sketch"),
    )
    sets = materialized(sets)
    groups = components(candidate_links(sets, threshold, recall)).select(F.col("id").alias("_set"), "root")
    groups = groups.join(sets.select("_set", "_n", "_copies", "_first"), "_set")
    wanted = _parts(groups, threshold, part).withColumn("_key", F.col("_first._key")).drop("_first")
    wanted = materialized(wanted)

    def shingled(piece: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        own = shingle_sets(texts, size)
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in own])])
        flat = np.concatenate(own) if own else np.empty(0, U64)
        return pa.RecordBatch.from_arrays(
            [piece.column(0), piece.column(1), piece.column(2), lists(flat.view(np.int64), bounds, pa.int64())],
            ["_set", "_copies", "_places", "_shingles"],
        )

    place_type = "array<struct<part:long,side:int>>"
    held = rows.join(broadcast_if_small(wanted, 200_000), "_key").select("_set", "_copies", "_places", "_text")
    held = held.mapInArrow(each_slice(shingled, "_text"), f"_set long, _copies long, _places {place_type}, _shingles array<long>")
    each = held.select("_set", "_copies", "_shingles", F.explode("_places").alias("_place"))
    each = each.select("_set", "_copies", "_shingles", F.col("_place.part").alias("_part"), F.col("_place.side").alias("_side"))
    dealt = each.repartition("_part").sortWithinPartitions("_part", "_set")
    compared = materialized(dealt.mapInArrow(_compare(threshold), "_set long, _links long, _peer long"))
    links = compared.groupBy("_set").agg(F.sum("_links").alias("_links"))
    classes = components(compared.filter("_set <> _peer").select(F.col("_peer").alias("a"), F.col("_set").alias("b")))
    classes = classes.select(F.col("id").alias("_set"), "root")
    known = sets.select("_set", "_copies", "_first").join(links, "_set", "left").join(classes, "_set", "left").withColumn("root", F.coalesce("root", "_set"))
    leaders = known.groupBy("root").agg(F.min("_first").alias("_leader"))
    judged = known.join(leaders, "root").select("_set", "_copies", F.coalesce("_links", F.lit(0)).alias("_links"), "_leader")
    out = signed.select("_id", "_key", "_set", "_n").join(judged, "_set", "left")
    alone = F.col("_n") == 0
    return out.select(
        "_id",
        "_key",
        F.when(alone, F.col("_id")).otherwise(F.col("_leader._id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("_links") + F.col("_copies") - 1).cast("long").alias("n_links"),
        F.col("_n").alias("n_shingles"),
        F.when(alone, 1).otherwise(F.col("_copies")).cast("long").alias("copies"),
        (alone | (F.col("_id").eqNullSafe(F.col("_leader._id")) & (F.col("_key") == F.col("_leader._key")))).alias("first"),
    )


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999999,
    part: int = PART,
) -> DataFrame:
    """One row per document: id, ``class_id``, ``n_links`` (other documents at the threshold,
    copies included), ``n_shingles``, ``copies`` (documents with the same set) and ``first``
    (whether the row is the one document of its class to keep)."""
    found = _classes(docs, id_col, text_col, size, threshold, recall, part)
    return found.select(F.col("_id").alias(id_col), "class_id", "n_links", "n_shingles", "copies", "first")


def one_per_class(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999999,
    part: int = PART,
) -> DataFrame:
    """Rows of ``docs`` without those that repeat an earlier document of their class."""
    found = _classes(docs, id_col, text_col, size, threshold, recall, part)
    gone = found.filter("NOT first").select("_key").distinct()
    own = docs.select(F.struct("*").alias("_row"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"))
    return own.join(gone, "_key", "left_anti").select("_row.*")


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    found = jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "class_id", "n_links", "n_shingles", "copies")
