"""Association queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.corpus_queries import LEXICON_SQL, documents, lexicon
from lexigrid.catalog.frequency_queries import the_hits
from lexigrid.catalog.registry import BASE, CORPUS, HITS, LOWER, ORACLES, TOK, query
from lexigrid.operators import assoc as a
from lexigrid.sources.corpus import load_corpus, with_tokens

COLLS = f"""{BASE}, {HITS}, colls AS (SELECT b.w AS collocate, count(*) AS f_xy FROM hits a JOIN tok b
  ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - 3 AND a.pos + 3 AND b.pos <> a.pos GROUP BY 1)"""


@query("a1_colloc_counts", f"{COLLS} SELECT * FROM colls")
def a1(spark, sf_dir):
    return a.collocates(the_hits(spark, sf_dir), -3, 3)


@query(
    "a1_colloc_counts_right",
    f"""{BASE}, {HITS} SELECT b.w AS collocate, count(*) AS f_xy FROM hits a JOIN tok b
        ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 2 AND a.pos + 4 GROUP BY 1""",
)
def a1_right(spark, sf_dir):
    return a.collocates(the_hits(spark, sf_dir), 2, 4)


SCORED = f"""{COLLS}, fy AS (SELECT w AS collocate, count(*) AS f_y FROM tok GROUP BY 1),
j AS (SELECT collocate, f_xy, f_y, (SELECT count(*) FROM hits) AS f_x, (SELECT count(*) FROM tok) AS n
  FROM colls JOIN fy USING (collocate) WHERE f_xy >= 5),
cells AS (SELECT *, [f_xy::double, (f_x - f_xy)::double, (f_y - f_xy)::double, (n - f_x - f_y + f_xy)::double] AS o,
  [f_x::double * f_y / n, f_x::double * (n - f_y) / n, (n - f_x)::double * f_y / n,
   (n - f_x)::double * (n - f_y) / n] AS e FROM j)
SELECT collocate, f_xy, f_y, f_x, round(14 + log2(2.0 * f_xy / (f_x + f_y)), 6) AS logdice,
  round(log2(f_xy * n::double / (f_x::double * f_y)), 6) AS mi,
  round((f_xy - f_x::double * f_y / n) / sqrt(f_xy), 6) AS t_score,
  round(2.0 * (CASE WHEN o[1] > 0 AND e[1] > 0 THEN o[1] * ln(o[1] / e[1]) ELSE 0 END
    + CASE WHEN o[2] > 0 AND e[2] > 0 THEN o[2] * ln(o[2] / e[2]) ELSE 0 END
    + CASE WHEN o[3] > 0 AND e[3] > 0 THEN o[3] * ln(o[3] / e[3]) ELSE 0 END
    + CASE WHEN o[4] > 0 AND e[4] > 0 THEN o[4] * ln(o[4] / e[4]) ELSE 0 END), 6) AS log_likelihood FROM cells"""


@query("a2_colloc_scores", SCORED)
def a2(spark, sf_dir):
    matched = the_hits(spark, sf_dir)
    return a.score(a.collocates(matched, -3, 3), matched, min_freq=5)


@query("a2_colloc_scores_top", f"{SCORED} ORDER BY logdice DESC, collocate LIMIT 50")
def a2_top(spark, sf_dir):
    matched = the_hits(spark, sf_dir)
    return a.score(a.collocates(matched, -3, 3), matched, min_freq=5, n=50)


KEYWORDS = """, focus AS (SELECT w AS value, count(*) AS frq FROM {f} GROUP BY 1),
ref AS (SELECT w AS value, count(*) AS ref_frq FROM {r} GROUP BY 1),
k AS (SELECT value, frq, coalesce(ref_frq, 0) AS ref_frq, 1e6 * frq / (SELECT count(*) FROM {f}) AS fpm,
  1e6 * coalesce(ref_frq, 0) / (SELECT count(*) FROM {r}) AS ref_fpm FROM focus LEFT JOIN ref USING (value)
  WHERE frq >= 3)
SELECT value, frq, ref_frq, round(fpm, 6) AS fpm, round(ref_fpm, 6) AS ref_fpm,
  round((fpm + 1) / (ref_fpm + 1), 6) AS score FROM k"""


@query(
    "a3_keywords",
    f"""{BASE}, en AS (SELECT * FROM tok WHERE lang = 'en'), other AS (SELECT * FROM tok WHERE lang <> 'en')
        {KEYWORDS.format(f='en', r='other')}""",
)
def a3(spark, sf_dir):
    corpus = load_corpus(spark, sf_dir)
    english = with_tokens(corpus.filter(F.col("lang") == "en"))
    other = with_tokens(corpus.filter(F.col("lang") != "en"))
    return a.keywords(english, other, k=1.0, min_freq=3)


@query(
    "a3_keywords_top",
    f"""{BASE}, bench AS (SELECT unnest({LOWER}) AS w FROM benchmark)
        {KEYWORDS.format(f='bench', r='tok')} ORDER BY score DESC, value LIMIT 50""",
)
def a3_top(spark, sf_dir):
    focus = with_tokens(load_corpus(spark, sf_dir, "benchmark"))
    return a.keywords(focus, documents(spark, sf_dir), k=1.0, min_freq=3, n=50)


def sketch_sql(word, name):
    return f"""{name} AS (SELECT relation, collocate, count(*) AS f FROM (
  SELECT 'left1' AS relation, b.w AS collocate FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos - 1 WHERE a.w = '{word}'
  UNION ALL SELECT 'right1', b.w FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.w = '{word}')
  GROUP BY 1, 2),
{name}_scored AS (SELECT relation, collocate, f, (sum(f) OVER (PARTITION BY relation))::bigint AS f_rel, f_slot,
  14 + log2(2.0 * f / (sum(f) OVER (PARTITION BY relation) + f_slot)) AS logdice
  FROM {name} JOIN slots USING (relation, collocate))"""


SLOTS = """slots AS (SELECT 'left1' AS relation, w AS collocate, count(*) AS f_slot FROM tok WHERE pos + 1 < n GROUP BY 2
  UNION ALL SELECT 'right1', w, count(*) FROM tok WHERE pos >= 1 GROUP BY 2)"""


@query(
    "a4_wsketch",
    f"""{BASE}, {SLOTS}, {sketch_sql('with', 'k')}
        SELECT relation, collocate, f, f_rel, f_slot, round(logdice, 6) AS logdice FROM k_scored WHERE f >= 2""",
)
def a4(spark, sf_dir):
    return a.word_sketch(documents(spark, sf_dir), "with", min_freq=2)


@query(
    "a5_wsdiff",
    f"""{BASE}, {SLOTS}, {sketch_sql('with', 'k')}, {sketch_sql('by', 'j')},
        p AS (SELECT * FROM k_scored WHERE f >= 2), q AS (SELECT * FROM j_scored WHERE f >= 2)
        SELECT relation, collocate, coalesce(p.f, 0) AS f1, coalesce(q.f, 0) AS f2,
        round(coalesce(p.logdice, 0), 6) AS score1, round(coalesce(q.logdice, 0), 6) AS score2,
        round(round(coalesce(p.logdice, 0), 6) - round(coalesce(q.logdice, 0), 6), 6) AS difference,
        CASE WHEN p.f > 0 AND q.f > 0 THEN 'shared' WHEN p.f > 0 THEN 'first' ELSE 'second' END AS side
        FROM p FULL JOIN q USING (relation, collocate)""",
)
def a5(spark, sf_dir):
    return a.sketch_diff(documents(spark, sf_dir), "with", "by", min_freq=2)


THES = f"""{BASE}, counts AS (SELECT a.w AS a, b.w AS b, count(*) AS f FROM tok a JOIN tok b
  ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 GROUP BY 1, 2),
fa AS (SELECT a, sum(f) AS f_a FROM counts GROUP BY 1), fb AS (SELECT b, sum(f) AS f_b FROM counts GROUP BY 1),
pairs AS (SELECT a, b, 14 + log2(2.0 * f / (f_a + f_b)) AS s FROM counts JOIN fa USING (a) JOIN fb USING (b) WHERE f >= 3),
ctx AS (SELECT a AS w, 'right1' AS relation, b AS c, s FROM pairs WHERE s > 0
  UNION ALL SELECT b, 'left1', a, s FROM pairs WHERE s > 0),
own AS (SELECT relation, c, s AS s_own FROM ctx WHERE w = 'with'),
sums AS (SELECT w AS word, count(s_own) AS n_shared, sum(s) AS s_total, sum(s + s_own) AS shared
  FROM ctx LEFT JOIN own USING (relation, c) GROUP BY 1)
SELECT word, n_shared, round(shared / ((SELECT sum(s_own) FROM own) + s_total), 6) AS similarity
FROM sums WHERE word <> 'with' AND n_shared > 0"""


@query("a6_thes", THES)
def a6(spark, sf_dir):
    return a.thesaurus(documents(spark, sf_dir), "with", min_freq=3)


@query("a6_thes_top", f"{THES} ORDER BY similarity DESC, word LIMIT 20")
def a6_top(spark, sf_dir):
    return a.thesaurus(documents(spark, sf_dir), "with", min_freq=3, n=20)


# tokens as lemmas, with tags
LEMMAS = f"""WITH {CORPUS}, {TOK.replace("tok AS", "forms AS", 1)}, {LEXICON_SQL.replace("FROM tok", "FROM forms")},
tok AS (SELECT doc_id, coalesce(lemma, w) AS w, coalesce(tag, '') AS tag, pos, n FROM forms LEFT JOIN lexicon ON w = lc)"""


def lemmas(spark, sf_dir):
    """Documents, and the lexicon of their words."""
    corpus = documents(spark, sf_dir)
    return {"corpus": corpus, "lexicon": lexicon(corpus)}


@query(
    "a4_wsketch_tag",
    f"""{LEMMAS}, slots AS (SELECT 'left1' AS relation, w AS collocate, count(*) AS f_slot FROM tok WHERE pos + 1 < n GROUP BY 2
          UNION ALL SELECT 'noun_right1', w, count(*) FROM tok WHERE pos >= 1 AND tag = 'NN1' GROUP BY 2),
        {sketch_sql('with', 'k').replace("'right1'", "'noun_right1'").replace("pos + 1 WHERE a.w = 'with'", "pos + 1 AND b.tag = 'NN1' WHERE a.w = 'with'")}
        SELECT relation, collocate, f, f_rel, f_slot, round(logdice, 6) AS logdice FROM k_scored WHERE f >= 2""",
)
def a4_tag(spark, sf_dir):
    relations = {"left1": -1, "noun_right1": (1, "^NN1$")}
    return a.word_sketch(lemma="with", relations=relations, min_freq=2, **lemmas(spark, sf_dir))


def on_lemmas(sql):
    return sql.replace(BASE, LEMMAS, 1)


@query("a5_wsdiff_lemma", on_lemmas(ORACLES["a5_wsdiff"]))
def a5_lemma(spark, sf_dir):
    return a.sketch_diff(lemma="with", lemma2="by", min_freq=2, **lemmas(spark, sf_dir))


@query("a6_thes_lemma", on_lemmas(THES))
def a6_lemma(spark, sf_dir):
    return a.thesaurus(lemma="with", min_freq=3, **lemmas(spark, sf_dir))


def path_sql(name, after, through, tag, most):
    """Pairs of a word and what a way over tags leads to from it: positions ``p`` and ``q``."""
    sign = "+" if after else "-"
    between = f"x.pos > {'a' if after else 'b'}.pos AND x.pos < {'b' if after else 'a'}.pos"
    return f"""SELECT '{name}' AS relation, a.w AS w1, b.w AS collocate FROM tok a JOIN tok b ON a.doc_id = b.doc_id
      AND b.pos {sign}0 BETWEEN a.pos {sign} {1 if after else most + 1} AND a.pos {sign} {most + 1 if after else 1}
      WHERE regexp_matches(b.tag, '{tag}') AND NOT EXISTS (SELECT 1 FROM tok x WHERE x.doc_id = a.doc_id AND {between}
        AND (NOT regexp_matches(x.tag, '{through}') OR regexp_matches(x.tag, '{tag}')))"""


PATHS = {
    "noun_after": a.TagPath("^NN1$", "^NN[02]$", 2),
    "any_noun_before": a.TagPath("^NN", "^$", 1, left=True),
    "next": 1,
}
PATHS_SQL = " UNION ALL ".join(
    [
        path_sql("noun_after", True, "^NN[02]$", "^NN1$", 2),
        path_sql("any_noun_before", False, "^$", "^NN", 1),
        "SELECT 'next', a.w, b.w FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1",
    ]
)


@query(
    "a4_wsketch_sequence",
    f"""{LEMMAS}, pairs AS ({PATHS_SQL}), slots AS (SELECT relation, collocate, count(*) AS f_slot FROM pairs GROUP BY 1, 2),
        k AS (SELECT relation, collocate, count(*) AS f FROM pairs WHERE w1 = 'with' GROUP BY 1, 2),
        s AS (SELECT relation, collocate, f, (sum(f) OVER (PARTITION BY relation))::bigint AS f_rel, f_slot,
          14 + log2(2.0 * f / (sum(f) OVER (PARTITION BY relation) + f_slot)) AS logdice FROM k JOIN slots USING (relation, collocate))
        SELECT relation, collocate, f, f_rel, f_slot, round(logdice, 6) AS logdice FROM s WHERE f >= 2""",
)
def a4_sequence(spark, sf_dir):
    return a.word_sketch(lemma="with", relations=PATHS, min_freq=2, **lemmas(spark, sf_dir))
