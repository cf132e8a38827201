"""Concordance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.corpus_queries import LEXICON_SQL, documents, lexicon
from lexigrid.catalog.frequency_queries import the_hits
from lexigrid.catalog.registry import BASE, HITS, LOWER, OFFSETS, WORDS, query
from lexigrid.operators import concordance as c
from lexigrid.operators import match as m
from lexigrid.operators.positions import offsets_of, with_toknum
from lexigrid.sources.corpus import containing, load_corpus, with_tokens


def the_docs(spark, sf_dir, **kw):
    """Only documents that can hold a hit."""
    corpus = with_tokens(containing(load_corpus(spark, sf_dir), "the"), **kw)
    return m.match(corpus, [m.term("the")])


def joined(*cols):
    return [F.array_join(x, " ").alias(x) for x in cols]


@query("c9_concsize", f"{BASE}, {HITS} SELECT count(*) AS concsize FROM hits")
def c9(spark, sf_dir):
    return c.concsize(the_docs(spark, sf_dir))


NUMBERED = f"{BASE}, {HITS}, num AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) - 1 AS hit FROM hits)"


@query("c10_page", f"{NUMBERED} SELECT doc_id, pos, hit FROM num WHERE hit BETWEEN 200 AND 299")
def c10(spark, sf_dir):
    return c.page(the_docs(spark, sf_dir), fromp=3, pagesize=100).select("doc_id", "pos", "hit")


@query("c10_all_pages", f"{NUMBERED} SELECT doc_id, pos, hit, hit // 100 + 1 AS page FROM num")
def c10_all(spark, sf_dir):
    return c.paged_hits(the_docs(spark, sf_dir)).select("doc_id", "pos", "hit", "page")


@query(
    "c11_sample",
    f"""{BASE}, {HITS} SELECT doc_id, pos FROM hits
        ORDER BY md5('7|' || doc_id || '|' || pos), doc_id, pos LIMIT 250""",
)
def c11(spark, sf_dir):
    return c.sample_hits(m.hit_rows(the_docs(spark, sf_dir)), 250, seed=7).select("doc_id", "pos")


@query(
    "c12_strat_sample",
    f"""SELECT doc_id, pos, source, rank FROM (SELECT *, row_number() OVER (PARTITION BY source
        ORDER BY md5('7|' || doc_id || '|' || pos), doc_id, pos) AS rank
        FROM ({BASE}, {HITS} SELECT * FROM hits)) WHERE rank <= 5""",
)
def c12(spark, sf_dir):
    hits = m.hit_rows(the_docs(spark, sf_dir), "source")
    return c.stratified_sample(hits, "source", 5, seed=7).select("doc_id", "pos", "source", "rank")


@query(
    "c13_kwic",
    f"""WITH d AS (SELECT doc_id, {LOWER} AS l, {WORDS} AS t FROM documents),
        h AS (SELECT *, unnest(list_filter(generate_series(1, len(l)), lambda i: l[i] = 'the')) AS i FROM d)
        SELECT doc_id, i - 1 AS pos, i AS "end", array_to_string(t[greatest(i - 5, 1):i - 1], ' ') AS "left",
        t[i] AS kwic, array_to_string(t[i + 1:i + 5], ' ') AS "right" FROM h""",
)
def c13(spark, sf_dir):
    lines = c.kwic(the_docs(spark, sf_dir, word=True), 5, 5, "word")
    return lines.select("doc_id", "pos", "end", *joined("left", "kwic", "right"))


@query(
    "c14_sentence_view",
    f"""WITH lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS ln
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
pt AS (SELECT doc_id, ln, unnest(t) AS w, generate_subscripts(t, 1) AS i
  FROM (SELECT doc_id, ln, {LOWER.replace('text', 'line')} AS t FROM lines)),
marked AS (SELECT *, CASE WHEN w IN ('.', '!', '?') AND coalesce(lead(w) OVER p, 'x') NOT IN ('.', '!', '?')
  OR lead(w) OVER p IS NULL THEN 1 ELSE 0 END AS closes FROM pt WINDOW p AS (PARTITION BY doc_id, ln ORDER BY i)),
placed AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY ln, i) - 1 AS pos,
  coalesce(sum(closes) OVER (PARTITION BY doc_id ORDER BY ln, i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS sent_id FROM marked),
sents AS (SELECT doc_id, sent_id, min(pos) AS first, list(w ORDER BY pos) AS s FROM placed GROUP BY 1, 2)
SELECT doc_id, pos, sent_id, array_to_string(s[1:pos - first], ' ') AS "left", w AS kwic,
  array_to_string(s[pos - first + 2:], ' ') AS "right"
FROM placed JOIN sents USING (doc_id, sent_id) WHERE w = 'the'""",
)
def c14(spark, sf_dir):
    return c.sentence_view(the_docs(spark, sf_dir)).select(
        "doc_id", "pos", "sent_id", *joined("left", "kwic", "right")
    )


@query(
    "c15_attr_segments",
    f"""{BASE}, {LEXICON_SQL}, w AS (SELECT doc_id, unnest({WORDS}) AS word,
          generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents),
        a AS (SELECT tok.doc_id, tok.pos, word, w.pos AS p, tok.w AS lc, coalesce(lemma, tok.w) AS lemma,
          coalesce(tag, 'X') AS tag FROM tok JOIN w USING (doc_id, pos) LEFT JOIN lexicon ON tok.w = lexicon.lc)
        SELECT h.doc_id, h.pos, string_agg(x.word || ' /' || x.tag || '/' || x.lemma, ' ' ORDER BY x.pos) AS segments
        FROM a h JOIN a x ON h.doc_id = x.doc_id AND x.pos BETWEEN h.pos - 2 AND h.pos + 2
        WHERE h.lc = 'the' GROUP BY 1, 2""",
)
def c15(spark, sf_dir):
    words = lexicon(documents(spark, sf_dir))
    lines = c.view_lines(the_docs(spark, sf_dir, word=True), 2, 2, ["#"], lexicon=words, untagged="X")
    parts = F.concat("line.Left", "line.Kwic", "line.Right")
    return lines.select(
        "doc_id", "pos", F.array_join(F.transform(parts, lambda s: s["str"]), " ").alias("segments")
    )


@query(
    "c16_kwic_text",
    f"""WITH d AS (SELECT doc_id, {LOWER} AS l, {WORDS} AS t FROM documents),
        h AS (SELECT *, unnest(list_filter(generate_series(1, len(l) - 1), lambda i: l[i] = 'the')) AS i FROM d)
        SELECT doc_id, i - 1 AS pos, t[i] || ' ' || t[i + 1] AS kwic FROM h""",
)
def c16(spark, sf_dir):
    matched = m.match(the_docs(spark, sf_dir, word=True), [m.term("the"), m.anything()])
    lines = c.view_lines(matched, 0, 0, ["#"])
    return lines.select("doc_id", "pos", c.kwic_text(F.col("line.Kwic")).alias("kwic"))


@query(
    "c17_all_pages",
    f"""{NUMBERED}, {OFFSETS} SELECT hit // 100 + 1 AS page, "offset" + pos AS toknum, source AS ref
        FROM num JOIN offs USING (doc_id)""",
)
def c17(spark, sf_dir):
    pages = the_pages(spark, sf_dir)
    return c.collect_pages(pages).select(
        "page", "line.toknum", F.element_at("line.Refs", 2).alias("ref")
    )


def the_lines(spark, sf_dir, left=0, right=0, refs=("#", "=source", "=lang")):
    """Concordance lines of ``the`` in document order, with token numbers."""
    matched = the_hits(spark, sf_dir, word=True)
    return c.view_lines(matched, left, right, list(refs), offsets=offsets_of(matched, hits=True))


def the_pages(spark, sf_dir, **kw):
    return c.make_pages(the_lines(spark, sf_dir, **kw), 100)


@query(
    "c19_export_hits",
    f"""WITH d AS (SELECT doc_id, source, {LOWER} AS l FROM documents),
        o AS (SELECT *, coalesce(sum(len(l)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0)::bigint AS o FROM d),
        h AS (SELECT *, unnest(list_filter(generate_series(1, len(l)), lambda i: l[i] = 'the')) AS i FROM o)
        SELECT o + i - 1 AS toknum, source, array_to_string(l[greatest(i - 3, 1):i - 1], ' ') AS "left",
        l[i] AS kwic, array_to_string(l[i + 1:i + 3], ' ') AS "right",
        'http://localhost:8080/#view?corpname=my+corpus%2F1&cql='.replace('+', '%20')
          || url_encode('[#' || (o + i - 1) || ']')
          || '&viewmode=sen&tab=advanced&queryselector=cql&showresults=1&default_attr=lemma_lc' AS permalink FROM h""",
)
def c19(spark, sf_dir):
    matched = the_hits(spark, sf_dir)
    lines = with_toknum(c.kwic(matched, 3, 3, "lc", "source"), offsets_of(matched))
    hits = lines.select("toknum", "source", *joined("left", "kwic", "right"))
    return c.export_hits(hits, "my corpus/1", "http://localhost:8080/#view?")
