"""Frequencies, word lists and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.functions.text import count_tokens, split_paragraphs, split_sentences
from lexigrid.operators.match import ATTRIBUTES
from lexigrid.plans.scale import explode_kept, top_per_group

PER_MILLION = 1e6


def _text_type(attribute: str) -> str:
    return attribute.removeprefix("doc.")


def _is_text_type(attribute: str) -> bool:
    return attribute not in ATTRIBUTES


def per_million(count: Column, tokens: Column) -> Column:
    return F.lit(PER_MILLION) * count / tokens


def freqs(
    matched: DataFrame,
    criterion: str,
    arg: str | None = None,
    nicearg: str | None = None,
    corpname: str | None = None,
    fmaxitems: int | None = None,
) -> DataFrame:
    """Frequencies by one criterion: ``doc.source 0``, ``word 0``, ``lc 1`` ..."""
    return freqs_blocks(matched, [criterion], arg, nicearg, corpname, fmaxitems)


def freqs_blocks(
    matched: DataFrame,
    criteria: list[str],
    arg: str | None = None,
    nicearg: str | None = None,
    corpname: str | None = None,
    fmaxitems: int | None = None,
) -> DataFrame:
    """Frequencies by several criteria, one block each, in one pass.

    ``matched`` keeps documents without hits: the pass also counts the tokens behind
    each text-type value. Token criteria have ``frq`` and ``fpm`` only.
    """
    parts = [c.rsplit(" ", 1) if " " in c else (c, "0") for c in criteria]
    types = [a for a, _ in parts if _is_text_type(a)]
    places = [(a, int(k)) for a, k in parts if not _is_text_type(a)]
    n_tokens = F.size("toks").cast("bigint")
    n_hits = F.size("hits").cast("bigint")
    blocks = []
    if types:
        grouped = _type_block(matched, types, n_tokens, n_hits)
        blocks.append(grouped.filter((F.col("frq") > 0) & F.col("value").isNotNull()))
        # one block adds up to the corpus, so the totals reuse its shuffle
        first = F.col("attribute") == types[0]
        sums = grouped.agg(
            F.sum(F.when(first, F.col("n_v"))).alias("N"), F.sum(F.when(first, F.col("frq"))).alias("f")
        )
    else:
        sums = matched.agg(F.sum(n_tokens).alias("N"), F.sum(n_hits).alias("f"))
    blocks += [_place_block(matched, places)] if places else []
    counted = blocks[0] if len(blocks) == 1 else blocks[0].unionByName(blocks[1])
    whole = sums.select(F.struct("N", "f")).scalar()
    out = counted.withColumn("_all", whole)
    return _measures(out, arg, nicearg, corpname, fmaxitems)


def _type_block(matched: DataFrame, types: list[str], n_tokens: Column, n_hits: Column) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("attribute"), F.col(_text_type(a)).cast("string").alias("value"))
            for a in types
        ]
    )
    counts = matched.select(n_tokens.alias("n"), n_hits.alias("h"), pairs.alias("pairs"))
    return (
        counts.select("n", "h", F.inline("pairs"))
        .groupBy("attribute", "value")
        .agg(F.sum("h").alias("frq"), F.sum("n").alias("n_v"))
    )


def _place_block(matched: DataFrame, places: list[tuple[str, int]]) -> DataFrame:
    def values(hit: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(a).alias("attribute"), token_at(hit, a, k).alias("value"))
                for a, k in places
            ]
        )

    pairs = F.flatten(F.transform(F.col("hits"), values))
    return (
        explode_kept(matched, pairs, "p")
        .filter(F.col("p.value").isNotNull())
        .groupBy(F.col("p.attribute").alias("attribute"), F.col("p.value").alias("value"))
        .agg(F.count("*").alias("frq"))
        .withColumn("n_v", F.lit(None).cast("bigint"))
    )


def token_at(hit: Column, attr: str, offset: int) -> Column:
    """Attribute of the token ``offset`` places from the hit's first; null outside."""
    at = hit["pos"] + (offset + 1)
    return F.when(at >= 1, F.try_element_at(F.col(ATTRIBUTES[attr]), F.greatest(at, F.lit(1))))


def _measures(counted: DataFrame, arg, nicearg, corpname, fmaxitems) -> DataFrame:
    frq, n_v = F.col("frq"), F.col("n_v")
    N, f = F.col("_all.N"), F.col("_all.f")
    out = counted.select(
        "frq",
        (F.lit(100.0) * (frq / n_v) / (f / N)).alias("rel"),
        per_million(frq, n_v).alias("reltt"),
        per_million(frq, N).alias("fpm"),
        "value",
        "attribute",
        F.lit(arg).cast("string").alias("arg"),
        F.lit(nicearg).cast("string").alias("nicearg"),
        F.lit(corpname).cast("string").alias("corpname"),
        F.round(per_million(f, N), 2).alias("total_fpm"),
        f.alias("total_frq"),
        F.lit(fmaxitems).cast("bigint").alias("fmaxitems"),
    )
    return top_items(out, fmaxitems) if fmaxitems else out


def top_items(freqs: DataFrame, n: int) -> DataFrame:
    """The most frequent ``n`` items of each block; ties by value."""
    return top_per_group(freqs, ["attribute"], [F.desc("frq"), F.asc("value")], n).drop("rank")


def freqml(matched: DataFrame, criteria: list[str]) -> DataFrame:
    """Joint frequencies; the values of one hit are joined by ``|``."""
    parts = [c.rsplit(" ", 1) if " " in c else (c, "0") for c in criteria]

    def value(hit: Column) -> Column:
        cols = [
            F.col(_text_type(a)).cast("string") if _is_text_type(a) else token_at(hit, a, int(k))
            for a, k in parts
        ]
        return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols])

    counted = (
        explode_kept(matched, F.transform(F.col("hits"), value), "value")
        .groupBy("value")
        .agg(F.count("*").alias("frq"))
    )
    N = matched.agg(F.sum(F.size("toks").cast("bigint"))).scalar()
    return counted.select("value", "frq", per_million(F.col("frq"), N).alias("fpm"))


def freqtt(matched: DataFrame, attributes: list[str], **desc) -> DataFrame:
    """Frequencies over text types, one block per attribute."""
    return freqs_blocks(matched, [f"{a} 0" for a in attributes], **desc)


def wordlist(corpus: DataFrame, attr: str = "lc", n: int | None = None) -> DataFrame:
    """Frequency of each value of a token attribute, or structures per text-type value."""
    if _is_text_type(attr):
        values = corpus.select(F.col(_text_type(attr)).cast("string").alias("value")).dropna()
    else:
        values = explode_kept(corpus, F.col(ATTRIBUTES[attr]), "value")
    counted = values.groupBy("value").agg(F.count("*").alias("frq"))
    out = counted.select("value", "frq", F.lit(attr).alias("attribute"))
    out = out.orderBy(F.desc("frq"), "value")
    return out.limit(n) if n else out


def attr_vals(corpus: DataFrame, attr: str, n: int) -> DataFrame:
    """Distinct values of a text type, at most ``n``."""
    col = F.col(_text_type(attr)).cast("string").alias("value")
    return corpus.select(col).dropna().distinct().orderBy("value").limit(n)


def corp_sizes(corpus: DataFrame) -> DataFrame:
    """Number of tokens, words, documents, paragraphs and sentences, in one pass."""
    counts = {
        "token": count_tokens("text"),
        "word": F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")),
        "doc": F.lit(1),
        "par": F.size(split_paragraphs("text")),
        "sent": F.size(split_sentences("text")),
    }
    sums = corpus.agg(*[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(k) for k, c in counts.items()])
    return sums.select(
        F.stack(F.lit(len(counts)), *[x for k in counts for x in (F.lit(k), F.col(k))]).alias(
            "structure", "size"
        )
    )


def struct_attr_stats(corpus: DataFrame, attributes: list[str], approx: bool = False) -> DataFrame:
    """Number of distinct values per structure attribute; ``approx`` for sketches."""
    count = F.approx_count_distinct if approx else F.count_distinct
    sums = corpus.agg(*[count(F.col(_text_type(a))).alias(f"n{i}") for i, a in enumerate(attributes)])
    triples = [
        x
        for i, a in enumerate(attributes)
        for x in (F.lit(a.split(".")[0]), F.lit(a.split(".", 1)[1]), F.col(f"n{i}"))
    ]
    return sums.select(
        F.stack(F.lit(len(attributes)), *triples).alias("structure", "attribute", "size")
    )


def text_types_with_norms(corpus: DataFrame, attributes: list[str]) -> DataFrame:
    """Every text-type value with its documents and tokens."""
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("attribute"), F.col(_text_type(a)).cast("string").alias("value"))
            for a in attributes
        ]
    )
    return (
        corpus.select(count_tokens("text").alias("n"), pairs.alias("p"))
        .select("n", F.inline("p"))
        .dropna(subset=["value"])
        .groupBy("attribute", "value")
        .agg(F.sum("n").alias("tokens"), F.count("*").alias("docs"))
    )


def text_types(
    attributes: DataFrame, drops: tuple[str, ...] = (), position: str = "", *keep: str
) -> DataFrame:
    """Attribute names without the dropped prefixes, with an optional position suffix."""
    for prefix in drops:
        attributes = attributes.filter(~F.col("attribute").startswith(prefix))
    name = F.concat_ws(" ", "attribute", F.lit(position)) if position else F.col("attribute")
    return attributes.select(*keep, name.alias("attribute"))


def ttype_counts(refs: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Hits by text types, most frequent first; hits lacking one are left out."""
    rows = refs if where is None else refs.filter(where)
    return (
        rows.dropna(subset=columns)
        .groupBy(*columns)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), *columns)
    )


def subcorpora(corpus: DataFrame, subsets: dict[str, Column]) -> DataFrame:
    """Documents and tokens of named subsets, in one pass."""
    n = count_tokens("text").cast("bigint")
    counted = corpus.select(n.alias("n"), *[p.alias(f"p{i}") for i, p in enumerate(subsets.values())])
    sums = counted.agg(
        *[F.count(F.when(F.col(f"p{i}"), 1)).alias(f"d{i}") for i in range(len(subsets))],
        *[
            F.coalesce(F.sum(F.when(F.col(f"p{i}"), F.col("n"))), F.lit(0)).alias(f"t{i}")
            for i in range(len(subsets))
        ],
    )
    cells = [
        x for i, name in enumerate(subsets) for x in (F.lit(name), F.col(f"d{i}"), F.col(f"t{i}"))
    ]
    return sums.select(F.stack(F.lit(len(subsets)), *cells).alias("subcorpus", "docs", "tokens"))


def describe(matched: DataFrame, steps: list[tuple[str, str, Column]]) -> DataFrame:
    """Per query step: ``arg``, ``nicearg``, hits after it and their rate per million.

    Each step is ``(arg, nicearg, hits column)`` on the matched corpus.
    """
    sums = matched.agg(
        F.sum(F.size("toks").cast("bigint")).alias("N"),
        *[F.sum(F.size(h).cast("bigint")).alias(f"s{i}") for i, (_, _, h) in enumerate(steps)],
    )
    cells = [
        x
        for i, (arg, nice, _) in enumerate(steps)
        for x in (
            F.lit(i + 1).cast("bigint"),
            F.lit(arg),
            F.lit(nice),
            F.col(f"s{i}"),
            F.round(per_million(F.col(f"s{i}"), F.col("N")), 2),
        )
    ]
    return sums.select(
        F.stack(F.lit(len(steps)), *cells).alias("step", "arg", "nicearg", "size", "rel")
    )
