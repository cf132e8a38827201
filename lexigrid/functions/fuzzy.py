"""Sentences as forgiving patterns: literals with bounded gaps between them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigrid.functions.arrays import bind
from lexigrid.functions.text import BLANK, TOKEN_PUNCTUATION, clean_text

# Fixed values, here and below: must equal the reference's. Order matters.
ENGLISH_OVERRIDES = {
    "cannot": " []{,2} ",
    r" e\.g\.": " []{,4} ",
    r" i\.e\.": " []{,4} ",
    r"\.\.\.": " []{,3} ",
    r" et al\.": " []{,3} ",
    r"Dr\.": " []{,2} ",
    r"Mr\.": " []{,2} ",
    r"Ms\.": " []{,2} ",
    r"Mrs\.": " []{,2} ",
    r" vs\.": " []{,2} ",
    r" [pP]\.": " []{,2} ",
    r"St\.": " []{,2} ",
    r" etc\.": " []{,2} ",
}

PUNCTUATION = "[" + "".join("\\" + c for c in TOKEN_PUNCTUATION) + "]"
ALNUM = r"[\p{L}\p{N}]+"
ADDRESS = r"^(?:https?|www|\S+@\S+)[:.]"
NUMERIC = r"^.?[,.\p{Nd}]+.?$"
ELEMENTS = "array<struct<term:string,gap:int>>"


def apply_overrides(text: Column, mapping: dict[str, str] | None = None) -> Column:
    """Replace what the tokenizer is known to split, in the order of the mapping."""
    for pattern, replacement in (ENGLISH_OVERRIDES if mapping is None else mapping).items():
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _wild(n: Column | int) -> Column:
    """A gap of ``n`` tokens, as one element however large; none if ``n`` is 0."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(n > 0, _element(F.lit(None), n)).otherwise(F.array().cast(ELEMENTS))


def _occurrences(piece: Column, char: str) -> Column:
    return F.length(piece) - F.length(F.replace(piece, F.lit(char), F.lit("")))


def _emitted(piece: Column, address_wildcards: int) -> Column:
    """What one blank-separated piece stands for: terms, and gaps for wildcards."""

    def part(pattern: str) -> Column:
        return F.regexp_extract(piece, pattern, 1)

    wrapped, opened, closed = (
        f"^{PUNCTUATION}({ALNUM}){PUNCTUATION}$",
        f"^{PUNCTUATION}({ALNUM})$",
        f"^({ALNUM}){PUNCTUATION}$",
    )
    gap = _wild(1)
    marked = F.coalesce(part(r"(\p{Nd}+)[^\p{Nd}]*$").try_cast("int"), F.lit(1))
    return (
        F.when(piece.rlike(f"^{ALNUM}$") & (F.length(piece) == 1), _literal(piece))
        .when(F.length(piece) == 1, _wild(1))
        .when(piece.startswith("[]{,"), _wild(marked))
        .when(piece.rlike(ADDRESS), _wild(address_wildcards))
        .when(F.contains(piece, F.lit("-")), _wild(2 * _occurrences(piece, "-") + 1))
        .when(F.contains(piece, F.lit("'")), _wild(_occurrences(piece, "'") + 1))
        .when(piece.rlike(f"^{ALNUM}$"), _literal(piece))
        .when(piece.rlike(wrapped), F.concat(gap, _literal(part(wrapped)), gap))
        .when(piece.rlike(opened), F.concat(gap, _literal(part(opened))))
        .when(piece.rlike(closed), F.concat(_literal(part(closed)), gap))
        .when(
            piece.rlike(NUMERIC),
            _wild(F.regexp_count(piece, F.lit(r"\p{Nd}+|[^\p{Nd}]+"))),
        )
        .otherwise(_wild(1))
    )


def _enough(pieces: Column, n: int) -> Column:
    """Pieces up to the one that makes sure of ``n`` elements; all, if none does.

    A piece of letters and digits is an element of its own, so what follows the
    ``n``-th of these cannot show in the result.
    """
    plain = F.filter(
        F.transform(pieces, lambda p, i: F.when(p.rlike(f"^{ALNUM}$"), i + 1)), lambda i: i.isNotNull()
    )
    return F.slice(pieces, F.lit(1), F.coalesce(F.get(plain, F.lit(n)), F.size(pieces)))


def _literal(term: Column) -> Column:
    return _element(term, F.lit(None))


def _element(term: Column, gap: Column) -> Column:
    return F.array(F.struct(term.cast("string").alias("term"), gap.cast("int").alias("gap")))


def fuzzy_pattern(
    text: Column | str,
    overrides: dict[str, str] | None = None,
    max_length: int = 25,
    url_wildcards: int = 2,
    clean: bool = True,
    form: str | None = "NFKC",
) -> Column:
    """Array of ``struct<term, gap>``: a literal, or a gap of up to ``gap`` tokens."""
    text = F.col(text) if isinstance(text, str) else text
    text = clean_text(text, form) if clean else text
    blank = " +" if clean else BLANK + "+"
    split = F.filter(F.split(apply_overrides(text, overrides), blank), lambda p: p != "")
    pieces = bind(split, lambda ps: _enough(ps, max_length + 2))
    emitted = F.flatten(F.transform(pieces, lambda p: _emitted(p, url_wildcards)))

    def merged(acc: Column, token: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = (
            F.when(token["term"].isNotNull() | last["gap"].isNull(), F.concat(acc, F.array(token)))
            .when(
                last["gap"].isNotNull(),
                F.concat(F.slice(acc, 1, F.size(acc) - 1), _element(F.lit(None), _sum(last["gap"], token["gap"]))),
            )
            .otherwise(F.concat(acc, F.array(token)))
        )
        # two more than asked for: a gap may still be dropped at either edge
        return F.when(F.size(acc) >= max_length + 2, acc).otherwise(grown)

    runs = F.aggregate(emitted, F.array().cast(ELEMENTS), merged)

    def without_edges(r: Column) -> Column:
        first = F.when((F.size(r) > 1) & F.get(r, F.lit(0))["gap"].isNotNull(), 1).otherwise(0)
        last = F.when((F.size(r) > 1) & F.try_element_at(r, F.lit(-1))["gap"].isNotNull(), 1).otherwise(0)
        return F.slice(r, first + 1, F.least(F.size(r) - first - last, F.lit(max_length)))

    return bind(runs, without_edges)


def _sum(a: Column, b: Column) -> Column:
    """Sum of two gaps, which stays within an int."""
    return F.least(a.cast("bigint") + b, F.lit(2**31 - 1).cast("bigint"))


def pattern_text(elements: Column) -> Column:
    """Readable form of a pattern: ``the <2> of``."""
    shown = F.transform(
        elements, lambda e: F.coalesce(e["term"], F.concat(F.lit("<"), e["gap"].cast("string"), F.lit(">")))
    )
    return F.array_join(shown, " ")


def pattern_literals(elements: Column, lower: bool = True) -> Column:
    """Literals of a pattern, each with the gap before it; a gap at the end is moot."""

    def literal(e: Column, i: Column, all_: Column) -> Column:
        term = F.lower(e["term"]) if lower else e["term"]
        gap = F.coalesce(F.get(all_, i - 1)["gap"], F.lit(0))
        return F.when(e["term"].isNotNull(), F.struct(term.alias("t"), gap.alias("g")))

    return bind(
        elements,
        lambda es: F.filter(F.transform(es, lambda e, i: literal(e, i, es)), lambda x: x.isNotNull()),
    )
