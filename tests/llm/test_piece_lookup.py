"""Pieces by their hash, and the order of a lattice's edges."""

import numpy as np

from lexigrid.llm import pieces
from lexigrid.llm.bytetext import U64


def _vocabulary():
    with open(pieces.MODEL, "rb") as file:
        return pieces._vocabulary(file.read(), 1.0)


def test_only_pieces_are_found():
    v = _vocabulary()
    own = v.hashes[::7]
    # neighbours share the leading bits of a piece without being one
    others = np.setdiff1d(np.concatenate([own + U64(1), own - U64(1), np.array([0, 2**64 - 1], U64)]), v.hashes)
    asked = np.concatenate([others, own, others])
    where, ids = v.find(asked)
    assert np.array_equal(where, len(others) + np.arange(len(own))) and np.array_equal(ids, v.ids[::7])


def test_edges_are_grouped_by_their_end():
    """Of each unit by depth, then by node, then longest first, as a stable sort would have them."""
    data = np.frombuffer(" the there  onward é東x".encode(), np.uint8)
    start, end = np.array([0, 4, 10]), np.array([4, 10, len(data)])
    lattice = pieces.Lattices(data, start, end, _vocabulary())
    # the last edge of each node takes what is left, and its node is entered from all sources before it
    ends = np.flatnonzero(lattice.cumulative == 2.0)
    inner = np.setdiff1d(np.arange(len(lattice.filtered)), lattice.first_node)
    assert len(ends) == len(inner) and np.array_equal(np.sort(lattice.first_edge[inner]), np.append(0, ends[:-1] + 1))
    for node in inner:
        first = lattice.first_edge[node]
        last = ends[np.searchsorted(ends, first)]
        sources = lattice.source[first : last + 1]
        # longest pieces first; the byte piece comes last and may repeat the source of a piece
        assert np.all(np.diff(sources) >= 0) and sources[-1] == node - 1
