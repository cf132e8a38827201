"""Collocations, keywords, word sketches, sketch differences, thesaurus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexigrid.functions.arrays import bind
from lexigrid.functions.measures import (
    log_dice,
    log_likelihood,
    mutual_information,
    simple_maths,
    t_score,
)
from lexigrid.operators.freq import per_million, wordlist
from lexigrid.operators.match import match, term
from lexigrid.operators.positions import lemmatized, token_rows
from lexigrid.plans.scale import explode_kept, materialized, posexplode_kept, salted_join


@dataclass(frozen=True)
class TagPath:
    """A way over tags from a word to its collocate, of no fixed length.

    It ends at the first token to the right (``left``: to the left) whose tag matches ``tag``, and
    passes at most ``most`` tokens before it, whose tags must all match ``through``.
    """

    tag: str
    through: str = ""
    most: int = 3
    left: bool = False

    @property
    def sign(self) -> int:
        return -1 if self.left else 1


#: an offset, an offset and a pattern of tags, or a way over tags
Relation = int | tuple[int, str] | TagPath
RELATIONS: dict[str, Relation] = {"left1": -1, "right1": 1}


def _around(hit: Column, first: int, last: int) -> Column:
    """Tokens at offsets ``first``..``last``: negative before the hit, positive after it."""
    toks, parts = F.col("toks"), []
    if first < 0:
        start = F.greatest(hit["pos"] + first, F.lit(0))
        stop = F.greatest(hit["pos"] + min(last, -1) + 1, F.lit(0))
        parts.append(F.slice(toks, start + 1, stop - start))
    if last > 0:
        skip = max(first, 1) - 1
        parts.append(F.slice(toks, hit["end"] + skip + 1, F.lit(last - skip)))
    return F.concat(*parts)


def collocates(matched: DataFrame, first: int = -3, last: int = 3) -> DataFrame:
    """Words around hits: ``collocate``, ``f_xy`` (pairs of a hit and a position)."""
    words = F.flatten(F.transform(F.col("hits"), lambda h: _around(h, first, last)))
    return (
        explode_kept(matched, words, "collocate")
        .groupBy("collocate")
        .agg(F.count("*").alias("f_xy"))
    )


def score(
    colls: DataFrame, matched: DataFrame, min_freq: int = 1, n: int | None = None, by: str = "logdice"
) -> DataFrame:
    """Association measures of collocates, best ``n`` by one of them."""
    f_y = wordlist(matched, "lc").select(F.col("value").alias("collocate"), F.col("frq").alias("f_y"))
    sums = matched.agg(
        F.sum(F.size("hits").cast("bigint")).alias("f_x"), F.sum(F.size("toks").cast("bigint")).alias("N")
    )
    whole = sums.select(F.struct("f_x", "N")).scalar()
    joined = colls.filter(F.col("f_xy") >= min_freq).join(f_y, "collocate").withColumn("_all", whole)
    f_xy, f_x, f_y, N = F.col("f_xy"), F.col("_all.f_x"), F.col("f_y"), F.col("_all.N")
    out = joined.select(
        "collocate",
        "f_xy",
        "f_y",
        f_x.alias("f_x"),
        F.round(log_dice(f_xy, f_x, f_y), 6).alias("logdice"),
        F.round(mutual_information(f_xy, f_x, f_y, N), 6).alias("mi"),
        F.round(t_score(f_xy, f_x, f_y, N), 6).alias("t_score"),
        F.round(log_likelihood(f_xy, f_x, f_y, N), 6).alias("log_likelihood"),
    )
    return out.orderBy(F.desc(by), "collocate").limit(n) if n else out


def keywords(
    focus: DataFrame, reference: DataFrame, k: float = 1.0, min_freq: int = 1, n: int | None = None
) -> DataFrame:
    """Words typical of ``focus`` against ``reference``; both hold token arrays."""

    def counted(corpus: DataFrame, name: str) -> tuple[DataFrame, Column]:
        words = wordlist(corpus, "lc").select("value", F.col("frq").alias(name))
        return words, corpus.agg(F.sum(F.size("toks").cast("bigint"))).scalar()

    (mine, n_mine), (theirs, n_theirs) = counted(focus, "frq"), counted(reference, "ref_frq")
    joined = (
        mine.filter(F.col("frq") >= min_freq)
        .join(theirs, "value", "left")
        .withColumn("ref_frq", F.coalesce("ref_frq", F.lit(0)))
        .withColumn("fpm", per_million(F.col("frq"), n_mine))
        .withColumn("ref_fpm", F.coalesce(per_million(F.col("ref_frq"), n_theirs), F.lit(0.0)))
    )
    out = joined.select(
        "value",
        "frq",
        "ref_frq",
        F.round("fpm", 6).alias("fpm"),
        F.round("ref_fpm", 6).alias("ref_fpm"),
        F.round(simple_maths(F.col("fpm"), F.col("ref_fpm"), k), 6).alias("score"),
    )
    return out.orderBy(F.desc("score"), "value").limit(n) if n else out


def _slot(relation: Relation) -> tuple[int, str | None]:
    """Offset of a relation, and the pattern that the collocate's tag has to match."""
    return relation if isinstance(relation, tuple) else (relation, None)


def _slot_totals(corpus: DataFrame, relations: dict[str, Relation]) -> DataFrame:
    """f(., relation, word): how often each word fills each slot of any token."""
    paths = {name: r for name, r in relations.items() if isinstance(r, TagPath)}
    tagged = paths or any(_slot(r)[1] for r in relations.values())
    sized = corpus.withColumn("n", F.size("toks"))
    if tagged:
        heads = {f"_heads{i}": _heads(r) for i, r in enumerate(paths.values())}
        sized = sized.withColumns(heads)
        fields = ["w:string", "tag:string", *[f"{h}:int" for h in heads]]
        cells = F.arrays_zip("toks", "tag", *heads).cast(f"array<struct<{','.join(fields)}>>")
        rows = posexplode_kept(sized, cells, "c", "n").select("n", "pos", "c.*")
    else:
        rows = token_rows(sized, "n")

    def fills(relation: Relation) -> Column:
        k, tag = _slot(relation)
        start = F.col("pos") - k
        inside = (start >= 0) & (start < F.col("n"))
        return inside if tag is None else inside & F.rlike("tag", F.lit(tag))

    filled = [
        (F.sum(f"_heads{list(paths).index(name)}").cast("bigint") if name in paths else F.count(F.when(fills(r), 1))).alias(name)
        for name, r in relations.items()
    ]
    counted = rows.groupBy(F.col("w").alias("collocate")).agg(*filled)
    pairs = F.array(
        *[F.struct(F.lit(r).alias("relation"), F.col(r).alias("f_slot")) for r in relations]
    )
    return counted.select("collocate", F.inline(pairs))


def _sketches(corpus: DataFrame, lemmas: list[str], relations: dict[str, Relation]) -> DataFrame:
    """``w1, relation, collocate, f, f_rel, f_slot, logdice`` for the given words."""
    near = None
    out = corpus
    for i, lemma in enumerate(lemmas):
        out = match(out, [term(lemma)], hits=f"_h{i}")
        found = _neighbours(F.col(f"_h{i}"), lemma, relations)
        near = found if near is None else F.concat(near, found)
    triples = (
        explode_kept(out, near, "t")
        .filter(F.col("t.collocate").isNotNull())
        .groupBy("t.w1", "t.relation", "t.collocate")
        .agg(F.count("*").alias("f"))
    )
    of_word = triples.groupBy("w1", "relation").agg(F.sum("f").alias("f_rel"))
    # one row per given word and relation
    joined = triples.join(F.broadcast(of_word), ["w1", "relation"]).join(
        _slot_totals(corpus, relations), ["relation", "collocate"]
    )
    return joined.withColumn("logdice", log_dice(F.col("f"), F.col("f_rel"), F.col("f_slot")))


def _lemma_sketches(corpus: DataFrame, lexicon: DataFrame, lemmas: list[str], relations: dict[str, Relation]) -> DataFrame:
    """:func:`_sketches` of lemmas by positional slots.

    Word forms are counted, and the counts, not the tokens, meet the lexicon: a lemma and a tag
    follow from the form.
    """
    lexicon = materialized(lexicon.select("lc", "lemma", "tag"))
    slots = {name: _slot(r) for name, r in relations.items()}
    distances = sorted({abs(k) for k, _ in slots.values()})
    # the given words may lack a lemma, and be their own
    given = lexicon.filter(F.col("lemma").isin(lemmas)).agg(F.collect_set("lc")).scalar()
    pairs = _pair_counts(corpus.withColumn("_given", F.concat(given, F.array(*map(F.lit, lemmas)))), distances, F.col("_given"))
    pairs = _named(_named(pairs, lexicon, "a"), lexicon, "b")

    def reading(name: str) -> Column:
        k, tag = slots[name]
        own, other = ("a", "b") if k > 0 else ("b", "a")
        held = (F.col("d") == abs(k)) & F.col(f"{own}_lemma").isin(lemmas)
        held = held if tag is None else held & F.rlike(f"{other}_tag", F.lit(tag))
        return F.when(held, F.struct(F.col(f"{own}_lemma").alias("w1"), F.lit(name).alias("relation"), F.col(f"{other}_lemma").alias("collocate")))

    triples = explode_kept(pairs, F.array(*map(reading, slots)), "t", "f").groupBy("t.w1", "t.relation", "t.collocate").agg(F.sum("f").alias("f"))
    of_word = triples.groupBy("w1", "relation").agg(F.sum("f").alias("f_rel"))
    words = _named(_pair_totals(corpus, distances), lexicon, "w")

    def fills(name: str) -> Column:
        k, tag = slots[name]
        n = F.col(f"second{k}" if k > 0 else f"first{-k}")
        held = n if tag is None else F.when(F.rlike("w_tag", F.lit(tag)), n).otherwise(0)
        return F.struct(F.lit(name).alias("relation"), held.alias("n"))

    filled = words.select(F.col("w_lemma").alias("collocate"), F.inline(F.array(*map(fills, slots))))
    totals = filled.groupBy("relation", "collocate").agg(F.sum("n").alias("f_slot"))
    joined = triples.join(F.broadcast(of_word), ["w1", "relation"]).join(totals, ["relation", "collocate"])
    return joined.withColumn("logdice", log_dice(F.col("f"), F.col("f_rel"), F.col("f_slot")))


def _neighbours(hits: Column, lemma: str, relations: dict[str, Relation]) -> Column:
    def of(hit: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(lemma).alias("w1"),
                    F.lit(name).alias("relation"),
                    (_path_end(hit, r) if isinstance(r, TagPath) else _neighbour(hit, *_slot(r))).alias("collocate"),
                )
                for name, r in relations.items()
            ]
        )

    return F.flatten(F.transform(hits, of))


def _neighbour(hit: Column, offset: int, tag: str | None) -> Column:
    at = hit["pos"] + (offset + 1)
    place = F.greatest(at, F.lit(1))
    fits = at >= 1
    if tag is not None:
        fits = fits & F.rlike(F.try_element_at(F.col("tag"), place), F.lit(tag))
    return F.when(fits, F.try_element_at(F.col("toks"), place))


def _path_end(hit: Column, path: TagPath) -> Column:
    """The collocate that a path leads to: walking (0), stopped (-1) or there, after so many tokens."""

    def step(state: Column, k: Column) -> Column:
        tag = F.get("tag", hit["pos"] + k * path.sign)
        return (
            F.when(state != 0, state).when(F.rlike(tag, F.lit(path.tag)), k).when(F.rlike(tag, F.lit(path.through)), 0).otherwise(-1)
        )

    far = F.aggregate(F.sequence(F.lit(1), F.lit(path.most + 1)), F.lit(0), step)
    return bind(far, lambda k: F.when(k > 0, F.get("toks", hit["pos"] + k * path.sign)))


def _heads(path: TagPath) -> Column:
    """For each token from how many words a path leads to it: the next one, and those behind tokens
    that a path may pass. The state counts up; a stopped one is its complement."""
    places = F.when(F.size("toks") > 0, F.sequence(F.lit(0), F.size("toks") - 1)).otherwise(F.array().cast("array<int>"))

    def heads(place: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            tag = F.get("tag", place - k * path.sign)
            passes = F.rlike(tag, F.lit(path.through)) & ~F.rlike(tag, F.lit(path.tag))
            more = F.when(passes, state + 1).otherwise(-(state + 1) - 1)
            return F.when((state < 0) | tag.isNull(), state).otherwise(more)

        last = F.aggregate(F.sequence(F.lit(1), F.lit(path.most + 1)), F.lit(0), step)
        return F.when(F.rlike(F.get("tag", place), F.lit(path.tag)), bind(last, lambda s: F.when(s < 0, -s - 1).otherwise(s))).otherwise(0)

    return F.transform(places, heads)


def _sketched(corpus: DataFrame, lexicon: DataFrame | None, lemmas: list[str], relations: dict[str, Relation]) -> DataFrame:
    if lexicon is None:
        return _sketches(corpus, lemmas, relations)
    if any(isinstance(r, TagPath) or _slot(r)[0] == 0 for r in relations.values()):
        # a way needs the tags of all tokens in their places
        return _sketches(lemmatized(corpus, lexicon), lemmas, relations)
    return _lemma_sketches(corpus, lexicon, lemmas, relations)


def word_sketch(
    corpus: DataFrame,
    lemma: str,
    relations: dict[str, Relation] = RELATIONS,
    min_freq: int = 1,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Collocates of a word by relation.

    A relation is a positional slot, a slot and a pattern for the collocate's tag, or a
    :class:`TagPath`. On a lemmatized corpus, or with a ``lexicon`` (``lc, lemma, tag``, unique
    ``lc``) for the words of ``corpus``, the word and its collocates are lemmas.
    """
    return (
        _sketched(corpus, lexicon, [lemma], relations)
        .filter(F.col("f") >= min_freq)
        .select("relation", "collocate", "f", "f_rel", "f_slot", F.round("logdice", 6).alias("logdice"))
    )


def sketch_diff(
    corpus: DataFrame,
    lemma: str,
    lemma2: str,
    relations: dict[str, Relation] = RELATIONS,
    min_freq: int = 1,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Two sketches side by side; what one lacks counts as 0.

    Both come out of one pass, and meet in a group of at most two rows.
    """

    def of(word: str, value: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("w1") == word, F.col(value))), F.lit(0))

    both = (
        _sketched(corpus, lexicon, [lemma, lemma2], relations)
        .filter(F.col("f") >= min_freq)
        .groupBy("relation", "collocate")
        .agg(
            of(lemma, "f").alias("f1"),
            of(lemma2, "f").alias("f2"),
            F.round(of(lemma, "logdice"), 6).alias("score1"),
            F.round(of(lemma2, "logdice"), 6).alias("score2"),
        )
    )
    kind = (
        F.when((F.col("f1") > 0) & (F.col("f2") > 0), "shared")
        .when(F.col("f1") > 0, "first")
        .otherwise("second")
    )
    return both.withColumn("difference", F.round(F.col("score1") - F.col("score2"), 6)).withColumn(
        "side", kind
    )


def _pair_counts(corpus: DataFrame, distances: list[int], of: Column | None = None) -> DataFrame:
    """How often word ``b`` stands ``d`` tokens after word ``a``; on request only where one of the two
    is in the array ``of``."""
    n = F.size("toks")

    def at(d: int) -> Column:
        rest = F.greatest(n - d, F.lit(0))
        zipped = F.arrays_zip(
            F.array_repeat(F.lit(d), rest),
            F.slice("toks", F.lit(1), rest),
            F.slice("toks", F.lit(d + 1), rest),
        )
        return zipped.cast("array<struct<d:int,a:string,b:string>>")

    pairs = F.concat(*[at(d) for d in distances])
    if of is not None:
        pairs = F.filter(pairs, lambda p: F.array_contains(of, p["a"]) | F.array_contains(of, p["b"]))
    return explode_kept(corpus, pairs, "p").groupBy("p.d", "p.a", "p.b").agg(F.count("*").alias("f"))


def _pair_totals(corpus: DataFrame, distances: list[int]) -> DataFrame:
    """For each word, and each distance ``d``, in how many pairs it stands first (``first<d>``) and
    second (``second<d>``): the sums of all pair counts, without counting the pairs."""
    rows = token_rows(corpus.withColumn("n", F.size("toks")), "n")
    pos = F.col("pos")
    return rows.groupBy("w").agg(
        *[F.count(F.when(pos + d < F.col("n"), 1)).alias(f"first{d}") for d in distances],
        *[F.count(F.when(pos >= d, 1)).alias(f"second{d}") for d in distances],
    )


def _named(words: DataFrame, lexicon: DataFrame, word: str) -> DataFrame:
    """Add lemma and tag of the words in a column, ``<word>_lemma`` and ``<word>_tag``, as
    :func:`lexigrid.operators.positions.lemmatized` has them."""
    names = lexicon.select(F.col("lc").alias(word), F.col("lemma").alias("_lemma"), F.col("tag").alias("_tag"))
    joined = words.join(names, word, "left")
    return joined.withColumns(
        {f"{word}_lemma": F.coalesce("_lemma", word), f"{word}_tag": F.coalesce("_tag", F.lit(""))}
    ).drop("_lemma", "_tag")


def context_scores(
    corpus: DataFrame, relations: dict[str, int], min_freq: int, lexicon: DataFrame | None = None
) -> DataFrame:
    """``w, relation, c, s`` with positive logDice for all words, or for all lemmas of a lexicon.

    A slot to the left mirrors one to the right: pairs are counted and scored once
    per distance and then read both ways. Lemmas are put in place of words in the counts, not in the
    documents, whose tokens stay where they are.
    """
    distances = sorted({abs(k) for k in relations.values()})
    counts, totals = _pair_counts(corpus, distances), _pair_totals(corpus, distances)
    if lexicon is not None:
        # read three times
        lexicon = materialized(lexicon.select("lc", "lemma", "tag"))
        named = _named(_named(counts, lexicon, "a"), lexicon, "b")
        counts = named.groupBy("d", F.col("a_lemma").alias("a"), F.col("b_lemma").alias("b")).agg(F.sum("f").alias("f"))
        sums = [F.sum(c).alias(c) for c in totals.columns if c != "w"]
        totals = _named(totals, lexicon, "w").groupBy(F.col("w_lemma").alias("w")).agg(*sums)
    kept = counts.filter(F.col("f") >= min_freq)
    totals = materialized(totals)

    def of(word: str, place: str) -> DataFrame:
        return totals.select(F.col("w").alias(word), *[F.col(f"{place}{d}").alias(f"_{place}{d}") for d in distances])

    # a word's pairs are distinct, so none holds so many rows that they would need salts
    scored = kept.join(of("a", "first"), "a").join(of("b", "second"), "b")
    f_a, f_b = [F.coalesce(*[F.when(F.col("d") == d, F.col(f"_{place}{d}")) for d in distances]) for place in ("first", "second")]
    scored = scored.withColumn("s", log_dice(F.col("f"), f_a, f_b))
    readings = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("relation"),
                    F.lit(abs(k)).alias("d"),
                    F.col("a" if k > 0 else "b").alias("w"),
                    F.col("b" if k > 0 else "a").alias("c"),
                )
                for name, k in relations.items()
            ]
        ),
        lambda r: r["d"] == F.col("d"),
    )
    return scored.filter(F.col("s") > 0).select("s", F.explode(readings).alias("r")).select(
        "r.w", "r.relation", "r.c", "s"
    )


def thesaurus(
    corpus: DataFrame,
    lemma: str,
    relations: dict[str, int] = RELATIONS,
    min_freq: int = 1,
    n: int | None = None,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Words sharing contexts with ``lemma``, by shared over total context weight; with a ``lexicon``
    (``lc, lemma, tag``, unique ``lc``) lemmas of the words of ``corpus``.

    Each context of another word meets at most one context of ``lemma``, so the
    join adds no rows and needs no cap on frequent contexts.
    """
    # read three times: by all words, by the word itself, and for its total
    scores = materialized(context_scores(corpus, relations, min_freq, lexicon))
    own = scores.filter(F.col("w") == lemma).select("relation", "c", F.col("s").alias("s_own"))
    own_total = own.agg(F.sum("s_own")).scalar()
    met = salted_join(scores, own, ["relation", "c"], "left")
    per_word = met.groupBy("w").agg(
        F.sum("s").alias("s_total"),
        F.sum(F.when(F.col("s_own").isNotNull(), F.col("s") + F.col("s_own"))).alias("shared"),
        F.count("s_own").alias("n_shared"),
    )
    out = per_word.filter((F.col("w") != lemma) & (F.col("n_shared") > 0)).select(
        F.col("w").alias("word"),
        "n_shared",
        F.round(F.col("shared") / (own_total + F.col("s_total")), 6).alias("similarity"),
    )
    return out.orderBy(F.desc("similarity"), "word").limit(n) if n else out
