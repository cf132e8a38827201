"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has a node at every byte and an edge for every vocabulary piece that stands
there. Forward filtering adds up the weight of all paths to each node; backward sampling walks
from the end and draws each edge by its share. Draws are hashes of the row's key, the unit and
the step, so a row is segmented alike wherever and whenever it is computed.

A piece never goes on past the space after a word, so a text falls into units (spaces, then
non-spaces) with lattices of their own; equal units of a batch share one forward pass, and all
units of a batch are filtered and sampled in step. Weights follow the pieces' ranks:
``(2 + rank) ** -sharpness``. Bytes that no piece covers take byte pieces, which are a last
resort; so decoding gives back every text.

Defined cases: a null text counts as empty and has no pieces; a null key is a key like any
other; rows with equal keys and texts are segmented alike; an empty table gives no rows. Time
is linear in the text, memory in the batch and the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import U64, Texts, each_slice, hash_bytes, lists, mix, prefix_hash, span_hash
from lexigrid.llm.registry import query

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_WEIGHT = -40.0
SLICE = 1 << 20


class Vocabulary:
    """Pieces as bytes, with a table from the hash of a span to its piece."""

    def __init__(self, model: bytes, sharpness: float):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, np.int32)
        hashes, ids, lengths = [], [], set()
        for i in range(size):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[1:-1], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
                self.bytes[i] = sp.id_to_piece(i).replace("▁", " ").encode()
                hashes.append(hash_bytes(self.bytes[i]))
                ids.append(i)
                lengths.add(len(self.bytes[i]))
        order = np.argsort(np.array(hashes, U64))
        self.hashes, self.ids = np.array(hashes, U64)[order], np.array(ids, np.int32)[order]
        # where the hashes with the same leading bits begin
        self.first = np.searchsorted(self.hashes >> U64(44), np.arange((1 << 20) + 1, dtype=U64))
        self.seen = np.diff(self.first) > 0
        self.most = int(np.diff(self.first).max(initial=0))
        self.lengths = sorted(lengths, reverse=True)
        self.weight = -sharpness * np.log(2.0 + np.arange(size))
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and the ids of those."""
        at = self.first[h >> U64(44)]
        good = self.hashes[np.minimum(at, len(self.hashes) - 1)] == h
        for _ in range(1, self.most):
            rest = np.flatnonzero(~good)
            at[rest] += 1
            good[rest] = self.hashes[np.minimum(at[rest], len(self.hashes) - 1)] == h[rest]
        where = np.flatnonzero(good)
        return where, self.ids[at[where]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of pieces."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.start[ids] - (ends - size), size)]


_loaded: dict[tuple[int, float], Vocabulary] = {}


def _vocabulary(model: bytes, sharpness: float) -> Vocabulary:
    key = (hash(model), sharpness)
    if key not in _loaded:
        _loaded[key] = Vocabulary(model, sharpness)
    return _loaded[key]


class Lattices:
    """Lattices of distinct units: their edges by end node, with cumulative shares per node."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, vocabulary: Vocabulary):
        size = end - start
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - start, size)
        unit_data = data[at]
        unit_of = np.repeat(np.arange(len(size)), size)
        depth = np.arange(bounds[-1]) - bounds[unit_of]
        left = size[unit_of] - depth
        # unit i has the nodes bounds[i] + i ... bounds[i + 1] + i
        node = np.arange(bounds[-1]) + unit_of
        sums = prefix_hash(unit_data)
        nodes = bounds[-1] + len(size)
        froms, lengths, ids, weights, places = [], [], [], [], []
        # edges that end at a node so far
        count = np.zeros(nodes, np.int64)

        def ended(to: np.ndarray) -> None:
            places.append(count[to])
            count[to] += 1

        for length in vocabulary.lengths:
            where = np.flatnonzero(left >= length)
            if not len(where):
                continue
            h = span_hash(sums, where, where + length)
            likely = np.flatnonzero(vocabulary.seen[h >> U64(44)])
            found, piece = vocabulary.find(h[likely])
            froms.append(where[likely[found]])
            ids.append(piece)
            lengths.append(np.full(len(piece), length))
            weights.append(vocabulary.weight[piece])
            ended(node[froms[-1]] + length)
        froms.append(np.arange(bounds[-1]))
        ids.append(vocabulary.byte_ids[unit_data])
        lengths.append(np.ones(len(unit_data), np.int64))
        weights.append(np.full(len(unit_data), BYTE_WEIGHT))
        ended(node + 1)
        start_at, length = np.concatenate(froms), np.concatenate(lengths)
        from_node = node[start_at]
        # edges stand in order of the depth and number of their end; only the nodes are sorted
        node_depth = np.arange(nodes) - np.repeat(bounds[:-1] + np.arange(len(size)), size + 1)
        # numbers of 16 bits are sorted in linear time
        small = node_depth.astype(np.uint16) if size.max(initial=0) < 1 << 16 else node_depth
        by_depth = np.argsort(small, kind="stable")
        first = np.empty(nodes, np.int64)
        first[by_depth] = np.cumsum(count[by_depth]) - count[by_depth]
        order = np.empty(len(start_at), np.int64)
        order[first[from_node + length] + np.concatenate(places)] = np.arange(len(start_at))
        self.source = from_node[order]
        self.piece = np.concatenate(ids)[order]
        weight, to_node = np.concatenate(weights)[order], (from_node + length)[order]
        to_depth = node_depth[to_node]
        self.first_edge = np.zeros(nodes, np.int64)
        self.cumulative = np.empty(len(order))
        self.first_node = bounds[:-1] + np.arange(len(size))
        self.last_node = bounds[1:] + np.arange(len(size))
        filtered = np.zeros(nodes)
        steps = np.searchsorted(to_depth, np.arange(1, int(size.max(initial=0)) + 2))
        for lo, hi in zip(steps, steps[1:]):
            value = filtered[self.source[lo:hi]] + weight[lo:hi]
            target = to_node[lo:hi]
            heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            counts = np.diff(np.append(heads, hi - lo))
            top = np.maximum.reduceat(value, heads)
            part = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(part, heads)
            filtered[target[heads]] = top + np.log(total)
            self.first_edge[target[heads]] = lo + heads
            running = np.cumsum(part)
            before = running[heads] - part[heads]
            share = (running - np.repeat(before, counts)) / np.repeat(total, counts)
            share[np.append(heads[1:], hi - lo) - 1] = 2.0  # the last edge takes what rounding leaves
            self.cumulative[lo:hi] = share
        self.filtered = filtered


def _units(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units: a run of spaces with the non-spaces after it."""
    space = texts.data == 32
    first = np.zeros(len(space), bool)
    first[1:] = space[1:] & ~space[:-1]
    first[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(space))


def sample_pieces(texts: Texts, keys: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, and per text where its pieces begin."""
    starts, ends = _units(texts)
    if not len(starts):
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    hashes = span_hash(prefix_hash(texts.data), starts, ends)
    _, example, kind = np.unique(hashes, return_index=True, return_inverse=True)
    lattice = Lattices(texts.data, starts[example], ends[example], vocabulary)
    first_unit = np.searchsorted(starts, texts.offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(first_unit))
    seed = mix(keys[owner] + mix((np.arange(len(starts)) - first_unit[owner]).astype(U64)))
    unit, node, stop = np.arange(len(starts)), lattice.last_node[kind], lattice.first_node[kind]
    count = np.zeros(len(starts), np.int64)
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    step = 0
    while len(unit):
        draw = (mix(seed[unit] + U64(step)) >> U64(11)) * (1.0 / (1 << 53))
        edge = lattice.first_edge[node]
        todo = np.flatnonzero(lattice.cumulative[edge] <= draw)
        while len(todo):
            edge[todo] += 1
            todo = todo[lattice.cumulative[edge[todo]] <= draw[todo]]
        drawn.append((unit, lattice.piece[edge]))
        count[unit] += 1
        node = lattice.source[edge]
        going = node > stop[unit]
        unit, node = unit[going], node[going]
        step += 1
    ends_at = np.cumsum(count)
    out = np.empty(ends_at[-1], np.int32)
    for back, (units, ids) in enumerate(drawn):
        out[ends_at[units] - 1 - back] = ids
    bounds = np.concatenate([[0], ends_at])[first_unit]
    return out, bounds


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, sharpness: float = 1.0, seed: int = 0
) -> DataFrame:
    """One row per document: id, ``piece_ids`` and ``lossless`` (decoding gives the text back).

    The model file is read on the driver and sent with the task: it holds the vocabulary only.
    """
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("_row"), F.col(text_col).alias("_text")
    )

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        vocabulary = _vocabulary(shared.value, sharpness)
        keys = part.column(1).to_numpy(zero_copy_only=False).view(U64)
        ids, bounds = sample_pieces(texts, keys, vocabulary)
        back = vocabulary.decode(ids)
        sizes = np.concatenate([[0], np.cumsum(vocabulary.size[ids])])
        if np.array_equal(back, texts.data) and np.array_equal(sizes[bounds], texts.offsets):
            lossless = np.ones(len(texts), bool)
        else:
            lossless = np.array([back[sizes[a] : sizes[b]].tobytes() == texts.text(i) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))])
        return pa.RecordBatch.from_arrays(
            [part.column(0), lists(ids, bounds, pa.int32()), pa.array(lossless)], ["_id", "piece_ids", "lossless"]
        )

    done = rows.mapInArrow(each_slice(work, "_text", SLICE), f"_id {kind}, piece_ids array<int>, lossless boolean")
    return done.withColumnRenamed("_id", id_col)


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "piece_ids", model: str = MODEL) -> DataFrame:
    """One row per input row: id and ``text``; null pieces give an empty text."""
    with open(model, "rb") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(shared.value, 1.0)
        for batch in batches:
            column = batch.column(1).fill_null([])
            texts = [vocabulary.decode(np.asarray(x.values, np.int64)).tobytes().decode("utf-8") for x in column]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_id", "text"])

    picked = rows.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    return picked.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)


@query("op3_sentencepiece")
def op3_sentencepiece(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs).select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")
