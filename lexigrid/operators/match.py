"""Finding hits: single tokens, sequences, gaps, alternatives.

A *matched* corpus keeps one row per document and adds ``hits``, an array of
``struct<pos, end>`` with 0-based ``pos`` and exclusive ``end``. Token arrays never
leave their row: they are searched where they are, and only positions are exploded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.functions.arrays import bind, running_max
from lexigrid.functions.text import term_predicate, tokenize_lower
from lexigrid.operators.positions import located
from lexigrid.plans.scale import explode_kept

# attribute name -> token array column
ATTRIBUTES = {"lc": "toks", "word": "word", "lemma": "lemma", "tag": "tag"}


@dataclass(frozen=True)
class Slot:
    """One element: a token passing any of the ``tests`` (attr, term); none = any token.

    ``gap`` is the number of tokens that may be skipped before it.
    """

    tests: tuple[tuple[str, str], ...] = ()
    gap: int = 0

    def holds(self, at: Column) -> Column:
        """Test at an existing 0-based position."""
        found = F.lit(False)
        for attr, term in self.tests:
            found = found | term_predicate(F.try_element_at(F.col(ATTRIBUTES[attr]), at + 1), term)
        return found if self.tests else F.lit(True)


def term(value: str, attr: str = "lc") -> Slot:
    return Slot(((attr, value),))


def any_of(**attrs: str) -> Slot:
    """Either of several attributes: ``any_of(lc="a", lemma="b")``."""
    return Slot(tuple(attrs.items()))


def anything() -> Slot:
    return Slot()


def after_gap(slot: Slot, most: int) -> Slot:
    """The slot, with up to ``most`` tokens skipped before it."""
    return Slot(slot.tests, most)


def _span(pos: Column, end: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), end.cast("int").alias("end"))


def _first_positions(slot: Slot, length: Column) -> Column:
    """Positions where the first slot holds, by one pass over its token array."""
    if len(slot.tests) == 1:
        attr, value = slot.tests[0]
        marked = F.transform(
            F.col(ATTRIBUTES[attr]), lambda w, i: F.when(term_predicate(w, value), i)
        )
        return F.filter(marked, lambda i: i.isNotNull())
    every = F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(every, slot.holds) if slot.tests else every


def match(corpus: DataFrame, slots: list[Slot], base: str = "lc", hits: str = "hits") -> DataFrame:
    """Hits of a token sequence; with gaps, a hit is a distinct start and its shortest end."""
    length = F.size(ATTRIBUTES[base])
    starts = _first_positions(slots[0], length)
    if any(s.gap for s in slots[1:]):
        found = F.filter(
            F.transform(starts, lambda i: _span(i, _shortest_end(slots, i, length))),
            lambda h: h["end"].isNotNull(),
        )
    else:

        def fits(start: Column) -> Column:
            ok = start + len(slots) <= length
            for k, slot in enumerate(slots[1:], 1):
                if slot.tests:
                    ok = ok & F.coalesce(slot.holds(start + k), F.lit(False))
            return ok

        kept = starts if len(slots) == 1 else F.filter(starts, fits)
        found = F.transform(kept, lambda i: _span(i, i + len(slots)))
    return corpus.withColumn(hits, found)


def _shortest_end(slots: list[Slot], start: Column, length: Column) -> Column:
    """Follow the feasible ends slot by slot; their number is bounded by the gaps."""
    ends = F.array(start + 1)
    for slot in slots[1:]:
        ends = F.array_distinct(F.flatten(_next_ends(ends, slot, length)))
    return F.array_min(ends)


def _next_ends(ends: Column, slot: Slot, length: Column) -> Column:
    def fits(p: Column) -> Column:
        return (p < length) & F.coalesce(slot.holds(p), F.lit(False))

    return F.transform(
        ends, lambda e: F.transform(F.filter(F.sequence(e, e + slot.gap), fits), lambda p: p + 1)
    )


def match_alternatives(corpus: DataFrame, alternatives: list[list[Slot]], base: str = "lc") -> DataFrame:
    """Union of several sequences on the document row; equal hits count once."""
    out, names = corpus, []
    for n, slots in enumerate(alternatives):
        names.append(f"_hits{n}")
        out = match(out, slots, base, names[-1])
    # as one number each (position and length), so that the distinct ones are hashed and not
    # compared in pairs; position and end together would hash nearly alike
    packed = F.transform(
        F.flatten(F.array(*names)),
        lambda h: F.shiftleft(h["pos"].cast("bigint"), 32).bitwiseOR((h["end"] - h["pos"]).cast("bigint")),
    )
    union = F.transform(
        F.sort_array(F.array_distinct(packed)),
        lambda x: _span(F.shiftright(x, 32), F.shiftright(x, 32) + x.bitwiseAND(F.lit((1 << 32) - 1))),
    )
    return out.withColumn("hits", union).drop(*names)


def match_positions(positions: DataFrame, attr: str, value: str) -> DataFrame:
    """Hits on one-row-per-token data: a plain filter."""
    return positions.filter(term_predicate(F.col(attr), value))


def hit_rows(matched: DataFrame, *keep: str) -> DataFrame:
    """One narrow row per hit: ``doc_id``, kept columns, ``pos``, ``end``."""
    rows = explode_kept(matched, F.col("hits"), "hit", "doc_id", *keep)
    return rows.select(
        "doc_id",
        *keep,
        F.col("hit.pos").cast("bigint").alias("pos"),
        F.col("hit.end").cast("bigint").alias("end"),
    )


def within(corpus: DataFrame, attribute: str, value: str) -> DataFrame:
    """Restrict to documents whose text type has a value.

    Works on a corpus, a matched corpus or hits; the filter reaches the scan.
    """
    return corpus.filter(F.col(attribute) == F.lit(value))


def inside(hits: Column, spans: Column) -> Column:
    """For each hit whether some span holds it from end to end, in order of the sorted hits.

    Both are arrays of ``struct<pos, end>``, in any order; spans may overlap. They are merged by
    position: of the spans that begin at a hit or before it, the one that reaches farthest decides.
    """

    def event(x: Column, kind: int) -> Column:
        return F.struct(x["pos"].cast("int").alias("pos"), F.lit(kind).alias("kind"), x["end"].cast("int").alias("end"))

    def decided(events: Column) -> Column:
        reach = running_max(F.transform(events, lambda e: F.when(e["kind"] == 0, e["end"])))
        judged = F.zip_with(
            events,
            reach,
            lambda e, r: F.struct(e["kind"].alias("kind"), e["pos"].alias("pos"), e["end"].alias("end"), F.coalesce(r >= e["end"], F.lit(False)).alias("ok")),
        )
        return F.filter(judged, lambda e: e["kind"] == 1)

    merged = F.concat(F.transform(spans, lambda s: event(s, 0)), F.transform(hits, lambda h: event(h, 1)))
    return bind(F.array_sort(merged), decided)


def within_spans(matched: DataFrame, spans: Column | str, negate: bool = False) -> DataFrame:
    """Hits that lie in one of the document's spans (with ``negate``: in none), in order.

    ``spans`` are those of :func:`lexigrid.operators.positions.with_structures`, or the hits of
    another match on the same row. No span, or null, holds nothing.
    """
    spans = F.coalesce(F.col(spans) if isinstance(spans, str) else spans, F.array().cast("array<struct<pos:int,end:int>>"))
    kept = F.filter(inside("hits", spans), lambda e: e["ok"] != F.lit(negate))
    return matched.withColumn("hits", F.transform(kept, lambda e: _span(e["pos"], e["end"])))


def within_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Restrict hits to a table of documents."""
    return hits.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")


def by_ids(corpus: DataFrame, offsets: DataFrame, ids: DataFrame) -> DataFrame:
    """Tokens whose ``toknum`` is listed: ``doc_id, pos, w, toknum``.

    The documents are found by their range of numbers, and only those that hold a wanted token
    are tokenized. ``corpus`` has ``doc_id`` and ``text``.
    """
    places = located(offsets, ids).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "toknum")).alias("_places"))
    docs = corpus.select("doc_id", "text").join(places, "doc_id")
    docs = docs.select("doc_id", "_places", tokenize_lower(F.col("text")).alias("_toks"))
    taken = F.transform(
        "_places", lambda p: F.struct(p["pos"].alias("pos"), F.get("_toks", p["pos"].cast("int")).alias("w"), p["toknum"].alias("toknum"))
    )
    return explode_kept(docs, taken, "t", "doc_id").select("doc_id", "t.*")
