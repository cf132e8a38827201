"""Token rows, token numbers, lexicon attributes, structures, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.functions.arrays import bind, prefix_starts
from lexigrid.functions.text import (
    count_tokens,
    split_paragraphs,
    split_sentences,
    tokenize_lower,
)
from lexigrid.plans.scale import (
    explode_kept,
    posexplode_kept,
    running_offsets,
    with_once,
)


def positions(corpus: DataFrame, *keep: str) -> DataFrame:
    """One row per token: ``doc_id``, kept columns, ``pos``, ``word``, ``lc``."""
    zipped = F.arrays_zip("word", "toks")
    return posexplode_kept(corpus, zipped, "t", "doc_id", *keep).select(
        "doc_id",
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        "t.word",
        F.col("t.toks").alias("lc"),
    )


def token_rows(corpus: DataFrame, *keep: str | Column) -> DataFrame:
    """The narrow form: kept columns, ``pos``, ``w`` (lower case)."""
    return posexplode_kept(corpus, F.col("toks"), "w", *keep)


def offsets_of(corpus: DataFrame, hits: bool = False) -> DataFrame:
    """Per document ``n_tokens`` and ``offset``, the corpus number of its first token; with
    ``hits`` (of a matched corpus) also ``n_hits`` and ``first_hit``.

    Only numbers are moved. Cut hits or lines on the document row first, then join this on.
    """
    n_tokens = F.size("toks") if "toks" in corpus.columns else count_tokens("text")
    sizes = [n_tokens.cast("bigint").alias("n_tokens")]
    sums = {"n_tokens": "offset"}
    if hits:
        sizes.append(F.size("hits").cast("bigint").alias("n_hits"))
        sums["n_hits"] = "first_hit"
    return running_offsets(corpus.select("doc_id", *sizes), "doc_id", sums)


def located(offsets: DataFrame, ids: DataFrame, block: int = 4096) -> DataFrame:
    """``toknum, doc_id, pos`` of corpus numbers of tokens.

    Documents and numbers meet on blocks of numbers; a document lies in one block per ``block``
    tokens, and a block holds at most ``block`` documents.
    """
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("n_tokens") - 1) / block)
    spans = offsets.filter("n_tokens > 0").withColumn("_block", F.explode(F.sequence(first, last)))
    wanted = ids.select("toknum").distinct().withColumn("_block", F.floor(F.col("toknum") / block))
    inside = (F.col("offset") <= F.col("toknum")) & (F.col("toknum") < F.col("offset") + F.col("n_tokens"))
    return wanted.join(spans, "_block").filter(inside).select("toknum", "doc_id", (F.col("toknum") - F.col("offset")).alias("pos"))


def with_toknum(rows: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """Add ``toknum`` to token or hit rows that carry ``offset``, or join it on."""
    if offsets is not None:
        rows = rows.join(offsets.select("doc_id", "offset"), "doc_id")
    return rows.withColumn("toknum", F.col("offset") + F.col("pos")).drop("offset")


def annotate(positions: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add ``lemma`` and ``tag`` from a lexicon of ``lc, lemma, tag`` (unique ``lc``).

    A word missing from the lexicon is its own lemma. The lexicon may have as many words as the corpus,
    so it is not repeated for salts; the rows of a frequent word are split by the planner (skew joins).
    """
    out = positions.join(lexicon.select("lc", "lemma", "tag"), "lc", "left")
    return out.select(
        *positions.columns, F.coalesce("lemma", "lc").alias("lemma"), F.col("tag")
    )


def lemmatized(corpus: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Documents whose ``toks`` are lemmas, with a ``tag`` array (empty where the lexicon has none).

    What counts words then counts lemmas. A group is one document.
    """
    rows = annotate(posexplode_kept(corpus, F.col("toks"), "lc", "doc_id"), lexicon)
    cells = F.struct("pos", "lemma", F.coalesce("tag", F.lit("")).alias("tag"))
    packed = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(cells)).alias("t"))
    # made once; else every look into an array would make it anew from the cells
    arrays = with_once(packed, "_a", F.struct(F.col("t.lemma").alias("toks"), F.col("t.tag").alias("tag")))
    return arrays.select("doc_id", "_a.toks", "_a.tag")


def attribute_arrays(annotated: DataFrame, *keep: str) -> DataFrame:
    """Token rows back to one row per document, with one array per attribute.

    A group is one document, so it is no larger than a document row.
    """
    attrs = [c for c in ("word", "lc", "lemma", "tag") if c in annotated.columns]
    rows = annotated.groupBy("doc_id", *keep).agg(
        F.array_sort(F.collect_list(F.struct("pos", *attrs))).alias("t")
    )
    names = {"lc": "toks"}
    arrays = with_once(rows, "_a", F.struct(*[F.col(f"t.{a}").alias(names.get(a, a)) for a in attrs]))
    return arrays.select("doc_id", *keep, *[f"_a.{names.get(a, a)}" for a in attrs])


def with_sentences(corpus: DataFrame) -> DataFrame:
    """Add ``sents``: per sentence its paragraph, number, first position and tokens.

    A paragraph is a non-blank line. A sentence ends at ``. ! ?`` not followed by
    another of these, or with its paragraph. Both are numbered from 0 per document.
    """
    pieces = F.flatten(
        F.transform(
            split_paragraphs("text"),
            lambda p, i: F.transform(
                split_sentences(p),
                lambda s: F.struct(i.alias("par"), tokenize_lower(s).alias("toks")),
            ),
        )
    )
    corpus = corpus.withColumn("_pieces", pieces)
    sizes = F.transform(F.col("_pieces"), lambda s: F.size(s["toks"]))
    numbered = F.transform(
        F.zip_with(
            F.col("_pieces"),
            prefix_starts(sizes),
            lambda s, start: F.struct(s["par"].alias("par"), start.alias("pos"), s["toks"].alias("toks")),
        ),
        lambda s, i: F.struct(s["par"].alias("par"), i.alias("sent"), s["pos"].alias("pos"), s["toks"].alias("toks")),
    )
    return corpus.withColumn("sents", numbered).drop("_pieces")


def with_structures(corpus: DataFrame) -> DataFrame:
    """Documents with ``toks`` and the spans ``struct<pos, end>`` of their sentences (``sent``) and
    paragraphs (``par``), tokenized once."""

    def span(pos: Column, end: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), end.cast("int").alias("end"))

    def structures(sents: Column) -> Column:
        toks = F.flatten(F.transform(sents, lambda s: s["toks"]))
        first = F.filter(sents, lambda s, i: (i == 0) | (F.get(sents, i - 1)["par"] != s["par"]))
        starts = F.transform(first, lambda s: s["pos"])
        last = F.get(sents, F.size(sents) - 1)
        length = last["pos"] + F.size(last["toks"])
        pars = bind(starts, lambda at: F.transform(at, lambda p, i: span(p, F.coalesce(F.get(at, i + 1), length))))
        spans = F.transform(sents, lambda s: span(s["pos"], s["pos"] + F.size(s["toks"])))
        return F.struct(toks.alias("toks"), spans.alias("sent"), pars.alias("par"))

    # each made once: what looks into an array must not make it anew
    sents = with_once(with_sentences(corpus), "_sents", F.col("sents")).drop("sents")
    made = with_once(sents, "_made", structures(F.col("_sents")))
    return made.select(*corpus.columns, "_made.*")


def structure_rows(corpus: DataFrame) -> DataFrame:
    """One row per token with its paragraph and sentence number."""
    sents = explode_kept(with_sentences(corpus), F.col("sents"), "s", "doc_id")
    names = {"par": "par_id", "sent": "sent_id", "pos": "first"}
    place = [F.col(f"s.{k}").cast("bigint").alias(v) for k, v in names.items()]
    rows = posexplode_kept(sents, F.col("s.toks"), "w", "doc_id", *place, pos="i")
    return rows.select(
        "doc_id", "par_id", "sent_id", (F.col("first") + F.col("i")).alias("pos"), "w"
    )


def reference_array(refs: list[str]) -> Column:
    """``#`` the token number, ``=attr`` a bare value, ``attr`` a labelled value."""

    def one(ref: str) -> Column:
        if ref == "#":
            return F.concat(F.lit("#"), F.col("toknum").cast("string"))
        if ref.startswith("="):
            return F.coalesce(F.col(ref[1:]).cast("string"), F.lit(""))
        return F.concat(F.lit(f"{ref}="), F.coalesce(F.col(ref).cast("string"), F.lit("")))

    return F.array(*[one(r) for r in refs])


def with_refs(hits: DataFrame, refs: list[str]) -> DataFrame:
    """Add ``refs`` to hit rows holding ``toknum`` and the text types."""
    return hits.withColumn("refs", reference_array(refs))
