"""Texts as UTF-8 byte arrays: words, hashes and code points for whole Arrow batches at once.

Used inside ``mapInArrow`` functions. A batch is cut into slices of some megabytes, so memory
depends on the slice and the longest single text, not on the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)

#: a word is a run of digits, ASCII letters and anything beyond ASCII
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES) + 1024
        for name, base in (("up", _BASE), ("down", _BACK)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any span."""
    up, _ = powers(len(data))
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``start:end``, wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def hash_bytes(value: bytes) -> int:
    data = np.frombuffer(value, np.uint8)
    return int(span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0])


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, from the words' hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.full(n, k, U64)
    for i in range(k):
        out = mix(out * U64(0x9FB21C651E98DF25) + words[i : i + n])
    return out


class Texts:
    """Some whole texts in one byte array; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def lowered(self) -> "Texts":
        return Texts(TO_LOWER[self.data], self.offsets)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of marked bytes; none crosses a text's end."""
        edges = self.offsets[:-1][np.diff(self.offsets) > 0]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = edges[edges > 0] - 1
        last[ends] = inside[ends]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and per text the number of its first word (plus the total)."""
        starts, ends = self.runs(IS_WORD[self.data])
        return starts, ends, np.searchsorted(starts, self.offsets)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Number of the text that holds each byte position."""
        return np.searchsorted(self.offsets, at, side="right") - 1

    def code_points(self) -> np.ndarray:
        """Code points before each byte of the array, counted over the whole array."""
        out = np.empty(len(self.data) + 1, np.int64)
        out[0] = 0
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out


def texts_of(column: pa.Array) -> Texts:
    """Bytes of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0])


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in parts of about ``limit`` bytes, and of at most ``rows`` rows; a longer text is a part of its own."""
    at = batch.schema.get_field_index(text)
    whole = texts_of(batch.column(at))
    start = 0
    while start < batch.num_rows:
        upto = whole.offsets[start] + limit
        end = max(start + 1, int(np.searchsorted(whole.offsets, upto, side="right")) - 1)
        end = min(end, batch.num_rows, start + (rows or batch.num_rows))
        lo, hi = whole.offsets[start], whole.offsets[end]
        yield batch.slice(start, end - start), Texts(whole.data[lo:hi], whole.offsets[start : end + 1] - lo)
        start = end


def each_slice(
    work: Callable[[pa.RecordBatch, Texts], pa.RecordBatch | None], text: str, limit: int = SLICE_BYTES, rows: int | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that applies ``work`` to each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text, limit, rows):
                out = work(part, texts)
                if out is not None:
                    yield out

    return run


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array: list ``i`` is ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))
