"""Exact substring dedup: bytes covered by a string of ``size`` bytes that also starts earlier.

1. Every window of ``size`` bytes has an anchor, its run of ``GRAM`` bytes with the smallest hash;
   equal windows have equal anchors at the same place. Consecutive windows of one anchor are a
   block. Blocks meet by anchor; a block that repeats an earlier block is covered whole.
2. What is left are anchors with several different blocks (the ends of repeats). Their texts are
   suffix-sorted in two stages: only suffixes smaller than their successors are sorted directly,
   the others follow by scanning the buckets of first bytes in order. Common prefixes of
   neighbours then tell which windows are equal; all but the first are covered.
3. Covered bytes are merged per document.

A task sends each block only once, and an anchor with many blocks in one task is dealt out by
block instead of by anchor, so one passage in a third of all documents stays spread out. Parts that
are suffix-sorted hold at most ``part`` blocks; an anchor with more is cut by block, and the first
places of its windows are merged across the cuts.

Defined cases: ids are integers, a null id counts as the smallest; a null text counts as empty;
rows with the same id and text count as one document; rows with the same id and another text are
told apart (and ordered) by a hash of the text; texts shorter than ``size`` lose nothing; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import U64, Texts, each_slice, mix, prefix_hash, slices, span_hash, texts_of
from lexigrid.llm.registry import query
from lexigrid.llm.words import broadcast_if_small
from lexigrid.plans.scale import materialized

SIZE = 100
GRAM = 32
#: blocks of one anchor in one task from which it is dealt out by block
SPREAD = 8
#: blocks in memory before a task sends them on
HELD = 1_000_000
PART = 8_192
#: a place is 16 bits of the text's hash, then 44 bits of byte position
PLACE_BITS = 44
NO_ID = -(1 << 63)


# --- suffix sorting -----------------------------------------------------------------------


def _words_at(data: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from each position as one big-endian number; ``data`` is padded."""
    n = len(data) - depth
    out = np.zeros(n, U64)
    for i in range(8):
        out = (out << U64(8)) | data[i : i + n].astype(U64)
    return out


def _sorted_to(starts: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes, by words of eight; ties are refined."""
    order = starts[np.argsort(words[starts], kind="stable")]
    rank = words[order]
    tied = np.zeros(len(order), bool)
    same = rank[1:] == rank[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    group = np.cumsum(np.concatenate([[True], ~same]))
    at = np.flatnonzero(tied)
    offset = 8
    while len(at) and offset < depth:
        key = words[order[at] + offset]
        sub = np.lexsort((key, group[at]))
        order[at], key = order[at][sub], key[sub]
        own = group[at]
        same = (key[1:] == key[:-1]) & (own[1:] == own[:-1])
        head = np.concatenate([[True], ~same])
        # new groups keep the order of the old ones
        group[at] = np.cumsum(head) + own[0]
        tied = np.zeros(len(at), bool)
        tied[1:] |= same
        tied[:-1] |= same
        at = at[tied]
        offset += 8
    return order


def suffix_array(data: np.ndarray, depth: int = SIZE) -> np.ndarray:
    """Suffixes of ``data`` ordered by their first ``depth`` bytes at least, in two stages."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    depth = -(-depth // 8) * 8
    padded = np.concatenate([data, np.zeros(2 * depth + 16, np.uint8)])
    # a suffix is smaller than its successor if the next other byte is larger
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[-1] = -1
    known = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    smaller = step[following] > 0
    direct = _sorted_to(np.flatnonzero(smaller), _words_at(padded, depth), depth)
    first = data[direct]
    cuts = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        front = np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        own = [front]
        while len(front):
            before = front[front > 0] - 1
            front = before[data[before] == c]
            own.append(front)
        bucket = np.concatenate([*own, direct[cuts[c] : cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > c]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        heads = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(byte) else []
        for a, b in zip(heads, [*heads[1:], len(byte)]):
            induced[byte[a]].append(before[a:b])
        induced[c] = []
    return np.concatenate(out)


def equal_neighbours(data: np.ndarray, order: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Whether each suffix of ``order`` shares its first ``size`` bytes with the one before."""
    padded = np.concatenate([data, np.zeros(size + 16, np.uint8)])
    words = _words_at(padded, 8)
    out = np.zeros(len(order), bool)
    at = np.arange(1, len(order))
    for offset in [*range(0, size - 8, 8), size - 8]:
        at = at[words[order[at] + offset] == words[order[at - 1] + offset]]
    out[at] = True
    return out


# --- blocks -------------------------------------------------------------------------------


def _blocks(texts: Texts, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first window, anchor hash and block code of each block."""
    n = len(texts.data)
    wide = size - gram + 1
    lengths = np.diff(texts.offsets)
    if not (lengths >= size).any():
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, U64),) * 2
    sums = prefix_hash(texts.data)
    starts = np.arange(n - gram + 1)
    hashes = span_hash(sums, starts, starts + gram)
    bits = U64(max(n, 2).bit_length())
    low = ((hashes >> bits) << bits) | starts.astype(U64)
    step = 1
    while 2 * step <= wide:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if wide > step:
        low = np.minimum(low[: len(low) - (wide - step)], low[wide - step :])
    anchor = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
    windows = np.zeros(n + 1, np.int32)
    full = lengths >= size
    np.add.at(windows, texts.offsets[:-1][full], 1)
    np.add.at(windows, texts.offsets[1:][full] - size + 1, -1)
    valid = np.cumsum(windows)[: len(anchor)] > 0
    head = valid.copy()
    head[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(head)
    tail = valid.copy()
    tail[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    last = np.flatnonzero(tail)
    at = anchor[first]
    count, offset = (last - first).astype(U64), (at - first).astype(U64)
    code = (span_hash(sums, first, last + size) << U64(14)) | (count << U64(7)) | offset
    return texts.owner(first), first, hashes[at], code


def _send(size: int, gram: int):
    """Blocks of a task: repeats within the task are settled at once (flag 2); anchors with many
    blocks are dealt by block (flag 1) and leave a mark (flag 3) where they would have gone."""

    def settled(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, code, ids, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, ids, code, h))
        h, code, ids, place = h[order], code[order], ids[order], place[order]
        # repeated rows bring the same place again
        once = np.concatenate([[True], (place[1:] != place[:-1]) | (ids[1:] != ids[:-1]) | (code[1:] != code[:-1]) | (h[1:] != h[:-1])])
        h, code, ids, place = h[once], code[once], ids[once], place[once]
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new = new_h | np.concatenate([[True], code[1:] != code[:-1]])
        group = np.cumsum(new_h) - 1
        many = np.bincount(group[new], minlength=int(group[-1]) + 1) > SPREAD
        flag = np.where(~new, 2, np.where(many[group], 1, 0)).astype(np.int32)
        marks = np.flatnonzero(new_h & many[group])
        take = np.concatenate([np.arange(len(h)), marks])
        # of what is settled only the place counts: no hashes go along
        h = np.where(flag == 2, ids.view(U64), h)
        code = np.where(flag == 2, code & U64(16383), code)
        flag = np.concatenate([flag, np.full(len(marks), 3, np.int32)])
        return pa.RecordBatch.from_arrays(
            [pa.array(h[take].view(np.int64)), pa.array(code[take].view(np.int64)), pa.array(ids[take]), pa.array(place[take]), pa.array(flag)],
            ["_h", "_code", "_id", "_place", "_flag"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for piece, texts in slices(batch, "_text"):
                owner, first, h, code = _blocks(texts, size, gram)
                if not len(h):
                    continue
                ids, tags = piece.column(0).to_numpy(), piece.column(1).to_numpy()
                place = (tags[owner] << PLACE_BITS) | (first - texts.offsets[owner])
                parts.append((h, code, ids[owner], place))
                held += len(h)
                if held >= HELD:
                    yield settled(parts)
                    parts, held = [], 0
        if parts:
            yield settled(parts)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks sorted by anchor, block and place: repeats (kind 0, without hashes), and the first
    of each block whose anchor has several (kind 1)."""
    held: pa.Table | None = None

    def judged(table: pa.Table) -> pa.RecordBatch:
        h, code, flag = (table.column(c).to_numpy() for c in ("_h", "_code", "_flag"))
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(new_h) - 1
        plain = flag < 2
        # marks and settled repeats are no blocks of their own here
        at = np.flatnonzero(plain)
        new = np.concatenate([[True], (code[at][1:] != code[at][:-1]) | (group[at][1:] != group[at][:-1])])[: len(at)]
        n_groups = int(group[-1]) + 1
        several = np.bincount(group[at][new], minlength=n_groups) > 1
        several |= np.bincount(group, (flag == 1) | (flag == 3), minlength=n_groups) > 0
        kind = np.full(len(h), -1, np.int32)
        kind[flag == 2] = 0
        kind[at[~new]] = 0
        ids, place = table.column("_id").to_numpy()[at], table.column("_place").to_numpy()[at]
        kind[at[1:][~new[1:] & (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])]] = -1
        kind[at[new & several[group[at]]]] = 1
        kept = np.flatnonzero(kind >= 0)
        first = kind[kept] == 1
        hashes = [pa.array(np.where(first, h[kept], 0)), pa.array(np.where(first, code[kept], code[kept] & 16383))]
        return pa.RecordBatch.from_arrays(
            [pa.array(kind[kept]), *hashes] + [table.column(c).combine_chunks().take(pa.array(kept)) for c in ("_id", "_place")],
            ["_kind", "_h", "_code", "_id", "_place"],
        )

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        h = held.column("_h").to_numpy()
        other = np.flatnonzero(h != h[-1]) if len(h) else []
        if len(other):
            last = int(other[-1]) + 1
            yield judged(held.slice(0, last).combine_chunks())
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield judged(held.combine_chunks())


def _cover(starts: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged byte spans of runs of covered windows."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    lo, hi = starts[order], (starts + counts - 1 + size)[order]
    reach = np.maximum.accumulate(hi)
    head = np.concatenate([[True], lo[1:] > reach[:-1]])
    at = np.flatnonzero(head)
    return lo[at], reach[np.append(at[1:], len(lo)) - 1]


_ENTRIES = "array<struct<_kind:int,_h:long,_code:long,_place:long>>"
_SPANS = "array<struct<start:long,end:long>>"
_BLOCKS = "array<struct<h:long,code:long,start:long,text:binary>>"


def _from_documents(size: int):
    """Per document the spans of its repeated blocks, and the texts of the blocks to compare."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    block_type = pa.list_(pa.struct([("h", pa.int64()), ("code", pa.int64()), ("start", pa.int64()), ("text", pa.binary())]))
    mask = (1 << PLACE_BITS) - 1

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        listed = part.column(3)
        flat = listed.flatten()
        kind, h, code, place = (np.asarray(flat.field(i)) for i in range(4))
        bounds = np.concatenate([[0], np.cumsum(np.asarray(listed.value_lengths().fill_null(0)))])
        start, count = place & mask, ((code >> 7) & 127) + 1
        spans, blocks = [], []
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            again = a + np.flatnonzero(kind[a:b] == 0)
            lo, hi = _cover(start[again], count[again], size)
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lo, hi)])
            base, own = texts.offsets[i], []
            for j in a + np.flatnonzero(kind[a:b] == 1):
                text = texts.data[base + start[j] : base + start[j] + count[j] - 1 + size].tobytes()
                own.append({"h": int(h[j]), "code": int(code[j]), "start": int(start[j]), "text": text})
            blocks.append(own)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(spans, span_type), pa.array(blocks, block_type)], ["_id", "_tag", "_spans", "_blocks"]
        )

    return work


# --- comparing blocks ---------------------------------------------------------------------


def _compare(size: int, part: int):
    """Of blocks sorted by anchor and cut: runs of windows that also stand earlier in the part, and
    for anchors that were cut the first places of all other windows (with their hash)."""

    def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        # repeated rows bring the same block again
        ids, tags, start = (table.column(c).to_numpy() for c in ("_id", "_tag", "_start"))
        order = np.lexsort((start, tags, ids))
        new = (ids[order][1:] != ids[order][:-1]) | (tags[order][1:] != tags[order][:-1]) | (start[order][1:] != start[order][:-1])
        table = table.take(pa.array(order[np.concatenate([[True], new])])).combine_chunks()
        ids, tags, start, code, cut = (table.column(c).to_numpy() for c in ("_id", "_tag", "_start", "_code", "_cuts"))
        texts = texts_of(_binary(table.column("_block")))
        data, offsets = texts.data, texts.offsets
        count = ((code >> 7) & 127) + 1
        window = np.repeat(offsets[:-1], count) + _ramp(count)
        owned = np.full(len(data), -1, np.int64)
        owned[window] = np.repeat(np.arange(len(ids)), count)
        order = suffix_array(data, size)
        order = order[owned[order] >= 0]
        same = equal_neighbours(data, order, size)
        group = np.cumsum(~same) - 1
        block = owned[order]
        at = start[block] + (order - offsets[block])
        # the first place of each group of equal windows stays
        sort = np.lexsort((at, tags[block], ids[block], group))
        first = np.concatenate([[True], group[sort][1:] != group[sort][:-1]])
        gone = sort[~first]
        # what stands earlier, as runs of windows
        back = np.lexsort((at[gone], block[gone]))
        b, p = block[gone][back], at[gone][back]
        if len(b):
            head = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (p[1:] != p[:-1] + 1)]))
            runs = np.diff(np.append(head, len(b)))
            yield _found(ids[b[head]], tags[b[head]], p[head], runs, np.zeros(len(head), np.int64), np.zeros(len(head), bool))
        open_ = sort[first]
        open_ = open_[cut[block[open_]] > 1]
        if len(open_):
            sums = prefix_hash(data)
            w = order[open_]
            b = block[open_]
            yield _found(ids[b], tags[b], at[open_], np.ones(len(b), np.int64), span_hash(sums, w, w + size).view(np.int64), np.ones(len(b), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < part:
                continue
            held = held.combine_chunks()
            h, cut = held.column("_h").to_numpy(), held.column("_cut").to_numpy()
            other = np.flatnonzero((h != h[-1]) | (cut != cut[-1]))
            if len(other):
                last = int(other[-1]) + 1
                yield from judged(held.slice(0, last).combine_chunks())
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from judged(held.combine_chunks())

    return run


def _binary(column: pa.ChunkedArray) -> pa.Array:
    """Bytes as they are: the buffers of a binary array under a string type."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    array = array.cast(pa.large_binary())
    return pa.LargeStringArray.from_buffers(len(array), array.buffers()[1], array.buffers()[2], None, 0, array.offset)


def _ramp(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _found(ids, tags, start, run, window, open_) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(tags), pa.array(start), pa.array(run), pa.array(window), pa.array(open_)],
        ["_id", "_tag", "_start", "_run", "_window", "_open"],
    )


def _covered(blocks: DataFrame, size: int, part: int) -> DataFrame:
    """``_id, _tag, _start, _run``: runs of windows of ``blocks`` that also stand earlier."""
    sizes = blocks.groupBy("_h").agg(F.count("*").alias("_n")).filter(F.col("_n") > part)
    cuts = sizes.select("_h", F.ceil(F.col("_n") / (part // 2)).cast("int").alias("_cuts"))
    dealt = blocks.join(broadcast_if_small(cuts, 200_000), "_h", "left").withColumn("_cuts", F.coalesce("_cuts", F.lit(1)))
    dealt = dealt.withColumn("_cut", F.pmod(F.xxhash64("_code", "_id"), F.col("_cuts")).cast("int"))
    dealt = dealt.repartition("_h", "_cut").sortWithinPartitions("_h", "_cut")
    columns = dealt.select("_h", "_cut", "_cuts", "_id", "_tag", "_start", "_code", "_block")
    found = columns.mapInArrow(_compare(size, part), "_id long, _tag long, _start long, _run long, _window long, _open boolean")
    found = materialized(found)
    done = found.filter("NOT _open").select("_id", "_tag", "_start", "_run")
    place = F.struct("_id", "_tag", "_start")
    open_ = found.filter("_open").select("_window", place.alias("_place"))
    firsts = open_.groupBy("_window").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    later = open_.join(firsts, "_window").filter(F.col("_place") > F.col("_first"))
    return done.unionAll(later.select("_place._id", "_place._tag", "_place._start", F.lit(1).cast("long").alias("_run")))


def repeated_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, gram: int = GRAM, part: int = PART
) -> DataFrame:
    """One row per document: id, ``text`` as bytes, ``spans`` (covered bytes, merged).

    ``size`` may be up to ``gram + 127`` bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.col(id_col).alias("_own"), text.alias("_text"))
    rows = rows.withColumn("_tag", F.pmod(F.xxhash64("_text"), F.lit(1 << 16)))
    sent = rows.select("_id", "_tag", "_text").mapInArrow(
        _send(size, gram), "_h long, _code long, _id long, _place long, _flag int"
    )
    by_block, by_place = F.xxhash64("_h", "_code"), F.xxhash64("_id", "_place")
    route = F.when(F.col("_flag") == 1, by_block).when(F.col("_flag") == 2, by_place).otherwise(F.col("_h"))
    sorted_ = sent.repartition(route).sortWithinPartitions("_h", "_code", "_id", "_place")
    settled = sorted_.mapInArrow(_settle, "_kind int, _h long, _code long, _id long, _place long")
    tag = F.shiftright("_place", PLACE_BITS)
    listed = settled.groupBy("_id", tag.alias("_tag")).agg(F.collect_list(F.struct("_kind", "_h", "_code", "_place")).alias("_entries"))
    met = rows.select("_id", "_tag", "_text").join(listed, ["_id", "_tag"]).select("_id", "_tag", "_text", "_entries")
    state = met.mapInArrow(each_slice(_from_documents(size), "_text"), f"_id long, _tag long, _spans {_SPANS}, _blocks {_BLOCKS}")
    state = materialized(state)
    blocks = state.select("_id", "_tag", F.explode("_blocks").alias("_b"))
    blocks = blocks.select("_id", "_tag", F.col("_b.h").alias("_h"), F.col("_b.code").alias("_code"), F.col("_b.start").alias("_start"), F.col("_b.text").alias("_block"))
    runs = _covered(blocks, size, part).groupBy("_id", "_tag").agg(F.collect_list(F.struct("_start", "_run")).alias("_runs"))
    # rows with the same id and text are one document
    spans = state.select("_id", "_tag", "_spans").dropDuplicates(["_id", "_tag"]).join(runs, ["_id", "_tag"], "left")
    out = rows.join(spans, ["_id", "_tag"], "left")
    late = F.transform("_runs", lambda r: F.struct(r["_start"].alias("start"), (r["_start"] + r["_run"] - 1 + size).alias("end")))
    none = F.array().cast(_SPANS)
    return out.select(F.col("_own").alias(id_col), F.col("_text").alias("text"), F.concat(F.coalesce("_spans", none), F.coalesce(late, none)).alias("spans"))


def merged_spans(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with touching and overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def kept_text(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that are left)."""
    kind = found.schema[id_col].dataType.simpleString()

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        removed, n_spans, kept = [], [], []
        for i, pairs in enumerate(part.column(2).to_pylist()):
            spans = merged_spans([(p["start"], p["end"]) for p in pairs])
            text, at, left = texts.text(i), 0, []
            for start, end in spans:
                left.append(text[at:start])
                at = end
            left.append(text[at:])
            kept.append(b"".join(left))
            removed.append(sum(e - s for s, e in spans))
            n_spans.append(len(spans))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(texts.offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
            ["_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    rows = found.select(F.col(id_col).alias("_id"), F.col("text").alias("_text"), "spans")
    done = rows.mapInArrow(each_slice(work, "_text"), f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.withColumnRenamed("_id", id_col)


@query("op5_substring_dedup")
def op5_substring_dedup(spark, sf_dir):
    kept = kept_text(repeated_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
