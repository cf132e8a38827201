"""Loading, tokens, attributes, structures, matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.registry import BASE, HITS, LOWER, OFFSETS, WORDS, query
from lexigrid.functions.text import tokenize
from lexigrid.operators import match as m
from lexigrid.operators.positions import (
    annotate,
    offsets_of,
    positions,
    structure_rows,
    token_rows,
    with_refs,
    with_structures,
    with_toknum,
)
from lexigrid.plans.scale import explode_kept
from lexigrid.sources.corpus import containing, load_corpus, with_tokens


def documents(spark, sf_dir, **kw):
    return with_tokens(load_corpus(spark, sf_dir), **kw)


@query(
    "s1_corpus_load",
    f"""SELECT doc_id, lang, source, quality::bigint AS quality, toxic::bigint AS toxic,
       len({LOWER}) AS n_tokens, md5(array_to_string({LOWER}, ' ')) AS tokens_md5
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def s1(spark, sf_dir):
    corpus = with_tokens(load_corpus(spark, sf_dir, labels=True))
    return corpus.select(
        "doc_id",
        "lang",
        "source",
        F.col("quality").cast("bigint").alias("quality"),
        F.col("toxic").cast("bigint").alias("toxic"),
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("toks", " ")).alias("tokens_md5"),
    )


@query(
    "t1_tokenize",
    f"""SELECT conv_id, turn, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT conv_id, turn, {WORDS} AS t FROM conversations)""",
)
def t1(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select("conv_id", "turn", F.posexplode(tokenize("text")).alias("pos", "token")).select(
        "conv_id", "turn", "token", F.col("pos").cast("bigint").alias("pos")
    )


@query(
    "p1_positions",
    f"""SELECT doc_id, unnest(t) AS word, unnest(l) AS lc, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT doc_id, {WORDS} AS t, {LOWER} AS l FROM documents)""",
)
def p1(spark, sf_dir):
    return positions(documents(spark, sf_dir, word=True))


@query(
    "p2_toknum",
    f"""{BASE}, {OFFSETS} SELECT doc_id, pos, w, "offset" + pos AS toknum
        FROM tok JOIN offs USING (doc_id)""",
)
def p2(spark, sf_dir):
    corpus = load_corpus(spark, sf_dir)
    # every token is asked for, so the text is moved, and tokenized after that
    docs = with_tokens(corpus.select("doc_id", "text").join(offsets_of(corpus).select("doc_id", "offset"), "doc_id"))
    rows = token_rows(docs, "doc_id", "offset")
    return with_toknum(rows.withColumn("pos", F.col("pos").cast("bigint")))


# A lexicon made from the corpus itself: suffix-stripped lemmas and coarse tags.
LEXICON_SQL = r"""lexicon AS (SELECT DISTINCT w AS lc, regexp_replace(w, '(.)(ing|ed|s)$', '\1') AS lemma,
  CASE WHEN regexp_matches(w, '^\p{N}+$') THEN 'CD' WHEN regexp_matches(w, '^[\p{L}\p{N}]') THEN
  'NN' || (len(w) % 3) ELSE 'SENT' END AS tag FROM tok WHERE len(w) > 1)"""


def lexicon(corpus):
    words = explode_kept(corpus, F.col("toks"), "lc").filter(F.length("lc") > 1).distinct()
    tag = (
        F.when(F.col("lc").rlike(r"^\p{N}+$"), "CD")
        .when(F.col("lc").rlike(r"^[\p{L}\p{N}]"), F.concat(F.lit("NN"), F.length("lc") % 3))
        .otherwise("SENT")
    )
    return words.select("lc", F.regexp_replace("lc", "(.)(ing|ed|s)$", "$1").alias("lemma"), tag.alias("tag"))


@query(
    "p3_annotate",
    f"""{BASE}, {LEXICON_SQL} SELECT doc_id, pos, w AS lc, coalesce(lemma, w) AS lemma, tag
        FROM tok LEFT JOIN lexicon ON w = lc""",
)
def p3(spark, sf_dir):
    corpus = documents(spark, sf_dir, word=True)
    return annotate(positions(corpus), lexicon(corpus)).select("doc_id", "pos", "lc", "lemma", "tag")


STRUCTURES = f"""{BASE}, lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS ln
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
pars AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS par_id,
  {LOWER.replace('text', 'line')} AS t FROM lines WHERE regexp_matches(line, '\\S')),
pt AS (SELECT doc_id, par_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM pars),
marked AS (SELECT *, CASE WHEN w IN ('.', '!', '?') AND coalesce(lead(w) OVER p, 'x') NOT IN ('.', '!', '?')
  OR lead(w) OVER p IS NULL THEN 1 ELSE 0 END AS closes FROM pt
  WINDOW p AS (PARTITION BY doc_id, par_id ORDER BY i))
SELECT doc_id, par_id,
  (coalesce(sum(closes) OVER (PARTITION BY doc_id ORDER BY par_id, i
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::bigint AS sent_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY par_id, i) - 1 AS pos, w FROM marked"""


@query("p4_structures", STRUCTURES)
def p4(spark, sf_dir):
    return structure_rows(load_corpus(spark, sf_dir)).select(
        "doc_id", "par_id", "sent_id", F.col("pos").cast("bigint").alias("pos"), "w"
    )


@query(
    "p5_refs",
    f"""{BASE}, {HITS}, {OFFSETS}
SELECT doc_id, pos, '#' || ("offset" + pos) || '|' || source || '|lang=' || lang AS refs
FROM hits JOIN offs USING (doc_id)""",
)
def p5(spark, sf_dir):
    docs = m.match(documents(spark, sf_dir), [m.term("the")])
    hits = with_toknum(m.hit_rows(docs, "lang", "source"), offsets_of(docs))
    return with_refs(hits, ["#", "=source", "lang"]).select(
        "doc_id", "pos", F.array_join("refs", "|").alias("refs")
    )


def hit_query(name, sql, slots, *terms, **kw):
    @query(name, sql)
    def run(spark, sf_dir):
        corpus = with_tokens(containing(load_corpus(spark, sf_dir), *terms), **kw)
        return m.hit_rows(m.match(corpus, slots))

    return run


hit_query("c1_token_match", f'{BASE}, {HITS} SELECT doc_id, pos, "end" FROM hits', [m.term("the")], "the")

hit_query(
    "c1_token_match_pattern",
    f"""{BASE} SELECT doc_id, pos, pos + 1 AS "end" FROM tok WHERE regexp_full_match(w, 'th.*')""",
    [m.term("th*")],
    "th",
)


@query(
    "c1_token_match_rows",
    f"""SELECT doc_id, pos, word FROM (
        SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents)
        WHERE word = 'The'""",
)
def c1_rows(spark, sf_dir):
    tokens = positions(documents(spark, sf_dir, word=True))
    return m.match_positions(tokens, "word", "The").select("doc_id", "pos", "word")


hit_query(
    "c2_attr_or",
    f"""SELECT doc_id, pos, pos + 1 AS "end" FROM (SELECT doc_id, unnest({LOWER}) AS lc,
        unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents)
        WHERE lc = 'of' OR word = 'The'""",
    [m.any_of(lc="of", word="The")],
    word=True,
)


@query(
    "c2_attr_or_lemma",
    f"""{BASE}, {LEXICON_SQL} SELECT doc_id, pos, w AS lc, coalesce(lemma, w) AS lemma
        FROM tok LEFT JOIN lexicon ON w = lc WHERE w = 'the' OR coalesce(lemma, w) = 'a'""",
)
def c2_lemma(spark, sf_dir):
    corpus = documents(spark, sf_dir, word=True)
    # no other word can pass the filter; these are the few forms of one lemma
    words = lexicon(corpus).filter((F.col("lemma") == "a") | F.col("lc").isin("the", "a"))
    tokens = annotate(positions(corpus), F.broadcast(words))
    return tokens.filter((F.col("lc") == "the") | (F.col("lemma") == "a")).select(
        "doc_id", "pos", "lc", "lemma"
    )


hit_query(
    "c3_sequence",
    f"""{BASE} SELECT a.doc_id, a.pos, a.pos + 3 AS "end" FROM tok a
        JOIN tok c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2 WHERE a.w = 'the' AND c.w = 'of'""",
    [m.term("the"), m.anything(), m.term("of")],
    "the",
    "of",
)

hit_query(
    "c3_sequence_any",
    f"""{BASE} SELECT doc_id, pos, pos + 2 AS "end" FROM tok WHERE w = 'the' AND pos + 2 <= n""",
    [m.term("the"), m.anything()],
    "the",
)

hit_query(
    "c4_gap_sequence",
    f"""{BASE} SELECT a.doc_id, a.pos, min(b.pos) + 1 AS "end" FROM tok a JOIN tok b
        ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 3
        WHERE a.w = 'the' AND b.w = 'of' GROUP BY a.doc_id, a.pos""",
    [m.term("the"), m.after_gap(m.term("of"), 2)],
    "the",
    "of",
)

hit_query(
    "c4_gap_sequence_three",
    f"""{BASE} SELECT a.doc_id, a.pos, min(c.pos) + 1 AS "end" FROM tok a
        JOIN tok b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 6
        JOIN tok c ON a.doc_id = c.doc_id AND c.pos BETWEEN b.pos + 1 AND b.pos + 5
        WHERE a.w = 'the' AND b.w = 'of' AND c.w = 'and' GROUP BY a.doc_id, a.pos""",
    [m.term("the"), m.after_gap(m.term("of"), 5), m.after_gap(m.term("and"), 4)],
    "the",
    "of",
    "and",
)


@query(
    "c5_alternation",
    f"""{BASE} SELECT DISTINCT * FROM (
        SELECT a.doc_id, a.pos, a.pos + 2 AS "end" FROM tok a JOIN tok b
          ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.w = 'of' AND b.w = 'the'
        UNION ALL SELECT doc_id, pos, pos + 1 FROM tok WHERE w = 'with'
        UNION ALL SELECT doc_id, pos, pos + 1 FROM tok WHERE regexp_full_match(w, 'wi.*'))""",
)
def c5(spark, sf_dir):
    alternatives = [[m.term("of"), m.term("the")], [m.term("with")], [m.term("wi*")]]
    return m.hit_rows(m.match_alternatives(documents(spark, sf_dir), alternatives))


@query("c7_within", f"{BASE}, {HITS} SELECT doc_id, source, pos FROM hits WHERE source = 'src7'")
def c7(spark, sf_dir):
    corpus = m.within(load_corpus(spark, sf_dir), "source", "src7")
    hits = m.hit_rows(m.match(with_tokens(containing(corpus, "the")), [m.term("the")]), "source")
    return hits.select("doc_id", "source", "pos")


def within_query(name, struct, column):
    """Hits of two words a few tokens apart that do not leave a structure."""

    @query(
        name,
        f"""WITH t AS ({STRUCTURES}) SELECT a.doc_id, a.pos, min(b.pos) + 1 AS "end" FROM t a JOIN t b
            ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 9 WHERE a.w = 'the' AND b.w = 'of'
            GROUP BY a.doc_id, a.pos, a.{column} HAVING arg_min(b.{column}, b.pos) = a.{column}""",
    )
    def run(spark, sf_dir):
        corpus = with_structures(containing(load_corpus(spark, sf_dir), "the", "of"))
        hits = m.match(corpus, [m.term("the"), m.after_gap(m.term("of"), 8)])
        return m.hit_rows(m.within_spans(hits, struct)).select("doc_id", "pos", "end")

    return run


within_query("c7_within_sentence", "sent", "sent_id")
within_query("c7_within_paragraph", "par", "par_id")


@query(
    "c7_within_hits",
    f"""{BASE} SELECT b.doc_id, b.pos FROM tok b WHERE b.w = 'of' AND NOT EXISTS (SELECT 1 FROM tok a JOIN tok c
          ON a.doc_id = c.doc_id AND c.pos BETWEEN a.pos + 1 AND a.pos + 12 WHERE a.doc_id = b.doc_id AND a.w = 'the' AND c.w = 'and'
          AND a.pos <= b.pos AND b.pos < (SELECT min(d.pos) + 1 FROM tok d WHERE d.doc_id = a.doc_id AND d.w = 'and'
            AND d.pos BETWEEN a.pos + 1 AND a.pos + 12))""",
)
def c7_hits(spark, sf_dir):
    """A word outside the hits of another pattern."""
    corpus = with_tokens(containing(load_corpus(spark, sf_dir), "of"))
    spans = m.match(corpus, [m.term("the"), m.after_gap(m.term("and"), 11)], hits="spans")
    hits = m.within_spans(m.match(spans, [m.term("of")]), "spans", negate=True)
    return m.hit_rows(hits).select("doc_id", "pos")


@query(
    "c7_within_documents",
    f"""{BASE}, {HITS} SELECT doc_id, pos FROM hits
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def c7_documents(spark, sf_dir):
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    corpus = m.within_documents(containing(load_corpus(spark, sf_dir), "the"), good)
    return m.hit_rows(m.match(with_tokens(corpus), [m.term("the")])).select("doc_id", "pos")


@query(
    "c8_id_lookup",
    f"""{BASE}, {OFFSETS} SELECT doc_id, pos, w, "offset" + pos AS toknum FROM tok JOIN offs USING (doc_id)
        WHERE "offset" + pos IN (SELECT event_id FROM events WHERE event_type = 'view')""",
)
def c8(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type = 'view'")
    corpus = load_corpus(spark, sf_dir)
    return m.by_ids(corpus, offsets_of(corpus), events.select(F.col("event_id").alias("toknum"))).select(
        "doc_id", "pos", "w", "toknum"
    )
