"""Concordances: size, pages, samples, contexts, lines, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.functions.arrays import bind
from lexigrid.operators.match import ATTRIBUTES
from lexigrid.operators.positions import reference_array, with_sentences
from lexigrid.plans.scale import explode_kept, materialized, running_offsets, smallest, top_per_group, with_once

SEGMENT = "struct<str:string,class:string>"
PARTS = ("Left", "Kwic", "Right")


def concsize(matched: DataFrame) -> DataFrame:
    """Number of hits."""
    return matched.agg(
        F.coalesce(F.sum(F.size("hits").cast("bigint")), F.lit(0)).alias("concsize")
    )


def numbered_hits(matched: DataFrame, *keep: str) -> DataFrame:
    """Hit rows with ``hit``, their 0-based number in corpus order.

    The numbers come from per-document hit counts, never from a sort of the hits. The corpus is
    matched once; hits and kept columns are stored.
    """
    matched = materialized(matched.select("doc_id", "hits", *keep).filter(F.size("hits") > 0))
    rows = _indexed_hits(matched, *keep).join(_first_hits(matched), "doc_id")
    return _numbered(rows, *keep)


def _first_hits(matched: DataFrame) -> DataFrame:
    counted = matched.select("doc_id", F.size("hits").cast("bigint").alias("n_hits"))
    return running_offsets(counted.filter("n_hits > 0"), "doc_id", "n_hits", out="first_hit")


def _indexed_hits(matched: DataFrame, *keep: str) -> DataFrame:
    numbered = F.transform(
        F.col("hits"),
        lambda h, i: F.struct(h["pos"].alias("pos"), h["end"].alias("end"), i.alias("i")),
    )
    return explode_kept(matched, numbered, "h", "doc_id", *keep)


def _numbered(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(
        "doc_id",
        *keep,
        F.col("h.pos").cast("bigint").alias("pos"),
        F.col("h.end").cast("bigint").alias("end"),
        (F.col("first_hit") + F.col("h.i")).alias("hit"),
    )


def paged_hits(matched: DataFrame, pagesize: int = 100, *keep: str) -> DataFrame:
    """All hits with their 1-based ``page``."""
    hits = numbered_hits(matched, *keep)
    return hits.withColumn("page", F.floor(F.col("hit") / pagesize).cast("bigint") + 1)


def page(matched: DataFrame, fromp: int = 1, pagesize: int = 100, *keep: str) -> DataFrame:
    """One page of hits in corpus order.

    Documents are picked by their range of hit numbers; each has a hit on the page, so there
    are at most ``pagesize`` of them, and only their hits are looked at.
    """
    first, end = (fromp - 1) * pagesize, fromp * pagesize
    docs = _first_hits(matched).filter((F.col("first_hit") < end) & (F.col("first_hit") + F.col("n_hits") > first))
    rows = _indexed_hits(matched.join(F.broadcast(docs.select("doc_id", "first_hit")), "doc_id"), *keep, "first_hit")
    hits = _numbered(rows, *keep).filter((F.col("hit") >= first) & (F.col("hit") < end))
    return hits.withColumn("page", F.lit(fromp).cast("bigint"))


def _draw(seed: int | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id"), F.col("pos")))


def sample_hits(hits: DataFrame, n: int, seed: int | str = 0) -> DataFrame:
    """``n`` random hits, the same ones for the same seed."""
    drawn = hits.withColumn("draw", _draw(seed))
    return smallest(drawn, "draw", ["doc_id", "pos"], n).drop("draw")


def stratified_sample(hits: DataFrame, by: str, n: int, seed: int | str = 0) -> DataFrame:
    """``n`` random hits for each value of a text type."""
    drawn = hits.dropna(subset=[by]).withColumn("draw", _draw(seed))
    order = [F.col("draw"), F.col("doc_id"), F.col("pos")]
    return top_per_group(drawn, [by], order, n).drop("draw")


def _context(tokens: Column, hit: Column, left: int, right: int) -> list[Column]:
    before = F.slice(tokens, F.greatest(hit["pos"] - left, F.lit(0)) + 1, F.least(F.lit(left), hit["pos"]))
    kwic = F.slice(tokens, hit["pos"] + 1, hit["end"] - hit["pos"])
    after = F.slice(tokens, hit["end"] + 1, F.lit(right))
    return [before, kwic, after]


def kwic(matched: DataFrame, left: int, right: int, attr: str = "lc", *keep: str) -> DataFrame:
    """Hits with ``left``, ``kwic`` and ``right`` token arrays, cut at the document."""
    tokens = F.col(ATTRIBUTES[attr])

    def line(hit: Column) -> Column:
        before, inside, after = _context(tokens, hit, left, right)
        return F.struct(
            hit["pos"].cast("bigint").alias("pos"),
            hit["end"].cast("bigint").alias("end"),
            before.alias("left"),
            inside.alias("kwic"),
            after.alias("right"),
        )

    lines = explode_kept(matched, F.transform(F.col("hits"), line), "line", "doc_id", *keep)
    return lines.select("doc_id", *keep, "line.*")


def sentence_view(matched: DataFrame, *keep: str) -> DataFrame:
    """Hits with the whole sentence they start in as context."""

    # the sentence of each token, so that a hit looks its own up
    home = F.flatten(F.transform("sents", lambda s, i: F.array_repeat(i, F.size(s["toks"]))))

    def line(hit: Column) -> Column:
        own = F.get("sents", F.get("_home", hit["pos"]))
        return F.struct(hit["pos"].alias("pos"), hit["end"].alias("end"), own.alias("s"))

    homes = with_once(with_sentences(matched), "_home", home)
    rows = explode_kept(homes, F.transform(F.col("hits"), line), "h", "doc_id", *keep)
    start = (F.col("h.pos") - F.col("h.s.pos")).cast("int")
    width = F.col("h.end") - F.col("h.pos")
    return rows.select(
        "doc_id",
        *keep,
        F.col("h.pos").cast("bigint").alias("pos"),
        F.col("h.end").cast("bigint").alias("end"),
        F.col("h.s.sent").cast("bigint").alias("sent_id"),
        F.slice("h.s.toks", F.lit(1), start).alias("left"),
        F.slice("h.s.toks", start + 1, width).alias("kwic"),
        F.slice("h.s.toks", start + width + 1, F.size("h.s.toks")).alias("right"),
    )


def plain_segments(tokens: Column) -> Column:
    """Tokens as segments without attributes."""
    return F.transform(
        tokens, lambda w: F.struct(w.alias("str"), F.lit("").alias("class")).cast(SEGMENT)
    )


def attr_segments(word: Column, tag: Column, lemma: Column) -> Column:
    """Each token followed by its ``/tag/lemma`` segment of class ``attr``."""
    cells = F.arrays_zip(word.alias("word"), tag.alias("tag"), lemma.alias("lemma")).cast(
        "array<struct<word:string,tag:string,lemma:string>>"
    )
    return F.flatten(
        F.transform(
            cells,
            lambda c: F.array(
                F.struct(c["word"].alias("str"), F.lit("").alias("class")).cast(SEGMENT),
                F.struct(
                    F.concat(F.lit("/"), c["tag"], F.lit("/"), c["lemma"]).alias("str"),
                    F.lit("attr").alias("class"),
                ).cast(SEGMENT),
            ),
        )
    )


def annotated_parts(matched: DataFrame, left: int, right: int, lexicon: DataFrame, untagged: str, *keep: str) -> DataFrame:
    """Per document its lines, cut, with tags and lemmas: ``lines`` of ``pos``, ``i``, ``Left``,
    ``Kwic``, ``Right``, whose tokens are ``struct<word, tag, lemma>``.

    Only words in contexts are looked up in the lexicon (unique ``lc``; a word that it lacks is its
    own lemma), each once per document; tokens outside contexts are not moved.
    """
    tokens = F.arrays_zip("word", "toks").cast("array<struct<word:string,lc:string>>")

    def line(hit: Column, i: Column) -> Column:
        parts = _context(F.col("_tokens"), hit, left, right)
        return F.struct(hit["pos"].cast("bigint").alias("pos"), i.alias("i"), *[x.alias(n) for x, n in zip(parts, PARTS)])

    cut = with_once(matched.filter(F.size("hits") > 0), "_tokens", tokens)
    cut = materialized(cut.select("doc_id", *keep, F.transform("hits", line).alias("_lines")))
    words = F.flatten(F.transform("_lines", lambda x: F.transform(F.concat(*[x[n] for n in PARTS]), lambda c: c["lc"])))
    needed = explode_kept(cut, F.array_distinct(words), "lc", "doc_id")
    # the lexicon may be as large as the vocabulary, so it is not repeated for salts
    looked = needed.join(lexicon.select("lc", "lemma", "tag"), "lc")
    entry = F.struct("lc", F.struct("lemma", "tag"))
    maps = looked.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_known"))

    def filled(cells: Column) -> Column:
        def one(c: Column) -> Column:
            def with_known(known: Column) -> Column:
                tag = F.coalesce(known["tag"], F.lit(untagged))
                return F.struct(c["word"].alias("word"), tag.alias("tag"), F.coalesce(known["lemma"], c["lc"]).alias("lemma"))

            return bind(F.try_element_at("_known", c["lc"]), with_known)

        return F.transform(cells, one)

    def known(x: Column) -> Column:
        return F.struct(x["pos"].alias("pos"), x["i"].alias("i"), *[filled(x[n]).alias(n) for n in PARTS])

    return cut.join(maps, "doc_id", "left").select("doc_id", *keep, F.transform("_lines", known).alias("lines"))


def view_lines(
    matched: DataFrame,
    left: int,
    right: int,
    refs: list[str],
    attrs: bool = False,
    offsets: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    untagged: str = "",
) -> DataFrame:
    """Concordance lines ``toknum, Refs, Left, Kwic, Right`` as one struct per hit.

    ``matched`` carries the text types in ``refs``, and ``word`` (with ``attrs`` also ``tag`` and
    ``lemma``). Lines are cut on their row, then ``offsets`` is joined on; with its ``first_hit``
    each line also gets its number ``hit``. Without ``offsets`` tokens count from each document.
    With a ``lexicon`` (``lc, lemma, tag``) the lines have attributes, looked up after cutting.
    """
    layers = ["word", "tag", "lemma"] if attrs else ["word"]

    def line(hit: Column, i: Column) -> Column:
        cut = {a: _context(F.col(a), hit, left, right) for a in layers}
        parts = [
            attr_segments(*[cut[a][k] for a in layers]) if attrs else plain_segments(cut["word"][k])
            for k in range(3)
        ]
        return F.struct(
            hit["pos"].cast("bigint").alias("pos"),
            i.alias("i"),
            *[p.alias(name) for p, name in zip(parts, PARTS)],
        )

    def looked_up(x: Column) -> Column:
        parts = [attr_segments(*[x[n][a] for a in ("word", "tag", "lemma")]).alias(n) for n in PARTS]
        return F.struct(x["pos"].alias("pos"), x["i"].alias("i"), *parts)

    types = [r.removeprefix("=") for r in refs if r != "#"]
    if lexicon is None:
        rows = explode_kept(matched, F.transform(F.col("hits"), line), "h", "doc_id", *types)
    else:
        rows = annotated_parts(matched, left, right, lexicon, untagged, *types)
        rows = explode_kept(rows, F.transform("lines", looked_up), "h", "doc_id", *types)
    start, number = F.lit(0), []
    if offsets is not None:
        rows, start = rows.join(offsets, "doc_id"), F.col("offset")
        if "first_hit" in offsets.columns:
            number = [(F.col("first_hit") + F.col("h.i")).alias("hit")]
    rows = rows.withColumn("toknum", start + F.col("h.pos"))
    return rows.select(
        "doc_id",
        F.col("h.pos").alias("pos"),
        *number,
        F.struct(
            "toknum", reference_array(refs).alias("Refs"), "h.Left", "h.Kwic", "h.Right"
        ).alias("line"),
    )


def kwic_text(segments: Column) -> Column:
    """Text of a segment array: tokens without attributes, stripped, spaced."""
    tokens = F.filter(segments, lambda s: s["class"] != "attr")
    return F.array_join(F.transform(tokens, lambda s: F.trim(s["str"])), " ")


def make_pages(numbered_lines: DataFrame, pagesize: int = 100) -> DataFrame:
    """Lines with a hit number packed into pages; a group is one page."""
    paged = numbered_lines.withColumn("page", F.floor(F.col("hit") / pagesize).cast("bigint") + 1)
    return paged.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("hit", "line"))).alias("packed")
    ).select("page", F.transform("packed", lambda p: p["line"]).alias("Lines"))


def collect_pages(pages: DataFrame) -> DataFrame:
    """All pages of a concordance as one table of lines."""
    return explode_kept(pages, F.col("Lines"), "line", "page")


def permalink(
    rule: Column, corpname: str, base_url: str, default_attr: str = "lemma_lc"
) -> Column:
    """Link to a concordance of ``rule`` in a viewer at ``base_url``."""
    # Parameters and their order must equal the reference's.
    params = {
        "corpname": F.lit(corpname),
        "cql": rule,
        "viewmode": F.lit("sen"),
        "tab": F.lit("advanced"),
        "queryselector": F.lit("cql"),
        "showresults": F.lit("1"),
        "default_attr": F.lit(default_attr),
    }
    pairs = [F.concat(F.lit(f"{k}="), percent_encode(v)) for k, v in params.items()]
    return F.concat(F.lit(base_url.split("?")[0] + "?"), F.concat_ws("&", *pairs))


def percent_encode(text: Column) -> Column:
    """Percent-encoding; Spark's form encoding differs in three characters."""
    out = F.url_encode(text)
    for form, percent in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(form), F.lit(percent))
    return out


def export_hits(hits: DataFrame, corpname: str, base_url: str) -> DataFrame:
    """Hit rows with ``toknum`` and a permalink to that token."""
    rule = F.concat(F.lit("[#"), F.col("toknum").cast("string"), F.lit("]"))
    return hits.withColumn("permalink", permalink(rule, corpname, base_url))


