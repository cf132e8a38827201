"""Frequencies and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.corpus_queries import documents
from lexigrid.catalog.registry import BASE, HITS, LOWER, WORDS, query
from lexigrid.operators import freq as f
from lexigrid.operators import match as m
from lexigrid.sources.corpus import load_corpus, with_tokens

MEASURES = ["rel", "reltt", "fpm"]


def the_hits(spark, sf_dir, **kw):
    return m.match(documents(spark, sf_dir, **kw), [m.term("the")])


def rounded(df):
    return df.select(
        *[F.round(c, 6).alias(c) if c in MEASURES else F.col(c) for c in df.columns]
    )


def type_block(attr, f="(SELECT count(*) FROM hits)", n="(SELECT count(*) FROM tok)"):
    return f"""SELECT 'doc.{attr}' AS attribute, v AS value, frq,
  round(100.0 * (frq::double / n_v) / ({f}::double / {n}), 6) AS rel,
  round(1e6 * frq / n_v, 6) AS reltt, round(1e6 * frq / {n}, 6) AS fpm
  FROM (SELECT {attr} AS v, count(*) AS frq FROM hits WHERE {attr} IS NOT NULL GROUP BY 1)
  JOIN (SELECT {attr} AS v, count(*) AS n_v FROM tok GROUP BY 1) USING (v)"""


TOTALS = """round(1e6 * (SELECT count(*) FROM hits) / (SELECT count(*) FROM tok), 2) AS total_fpm,
  (SELECT count(*) FROM hits) AS total_frq"""
DESC = "'\"the\"' AS arg, 'the' AS nicearg, 'documents' AS corpname"
ARGS = {"arg": '"the"', "nicearg": "the", "corpname": "documents"}


@query(
    "f1_freqs_texttype",
    f"""{BASE}, {HITS} SELECT *, {DESC}, {TOTALS}, NULL::bigint AS fmaxitems
        FROM ({type_block('source')})""",
)
def f1(spark, sf_dir):
    return rounded(f.freqs(the_hits(spark, sf_dir), "doc.source 0", **ARGS))


PLACE = """SELECT '{attr}' AS attribute, value, count(*) AS frq, NULL::double AS rel, NULL::double AS reltt,
  round(1e6 * count(*) / (SELECT count(*) FROM tok), 6) AS fpm FROM ({values}) GROUP BY value"""
NEXT = """SELECT b.w AS value FROM hits a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + {}"""
HIT_WORDS = f"""SELECT x.word AS value FROM hits JOIN (SELECT doc_id, unnest({WORDS}) AS word,
  generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents) x USING (doc_id, pos)"""


@query(
    "f2_freqs_token",
    f"""{BASE}, {HITS} SELECT *, {DESC}, {TOTALS}, NULL::bigint AS fmaxitems
        FROM ({PLACE.format(attr='lc', values=NEXT.format(1))})""",
)
def f2(spark, sf_dir):
    return rounded(f.freqs(the_hits(spark, sf_dir), "lc 1", **ARGS))


@query(
    "f3_freqs_blocks",
    f"""{BASE}, {HITS} SELECT *, {DESC}, {TOTALS}, NULL::bigint AS fmaxitems
        FROM ({type_block('source')} UNION ALL {type_block('lang')}
        UNION ALL {PLACE.format(attr='word', values=HIT_WORDS)}
        UNION ALL {PLACE.format(attr='lc', values=NEXT.format('(-1)'))})""",
)
def f3(spark, sf_dir):
    criteria = ["doc.source 0", "doc.lang 0", "word 0", "lc -1"]
    return rounded(f.freqs_blocks(the_hits(spark, sf_dir, word=True), criteria, **ARGS))


@query(
    "f4_freqml",
    f"""{BASE}, {HITS} SELECT value, count(*) AS frq,
        round(1e6 * count(*) / (SELECT count(*) FROM tok), 6) AS fpm
        FROM (SELECT x.value || '|' || source AS value FROM hits JOIN
          (SELECT doc_id, unnest({WORDS}) AS value, generate_subscripts({WORDS}, 1) - 1 AS pos
           FROM documents) x USING (doc_id, pos)) GROUP BY value""",
)
def f4(spark, sf_dir):
    return rounded(f.freqml(the_hits(spark, sf_dir, word=True), ["word 0", "doc.source 0"]))


@query(
    "f5_freqtt",
    f"""{BASE}, {HITS} SELECT *, {DESC}, {TOTALS}, NULL::bigint AS fmaxitems
        FROM ({type_block('source')} UNION ALL {type_block('lang')})""",
)
def f5(spark, sf_dir):
    return rounded(f.freqtt(the_hits(spark, sf_dir), ["doc.source", "doc.lang"], **ARGS))


@query(
    "f6_fmaxitems",
    f"""{BASE}, {HITS}, blocks AS ({type_block('source')}
        UNION ALL {PLACE.format(attr='lc', values=NEXT.format(1))})
        SELECT *, {DESC}, {TOTALS}, 5::bigint AS fmaxitems FROM blocks
        QUALIFY row_number() OVER (PARTITION BY attribute ORDER BY frq DESC, value) <= 5""",
)
def f6(spark, sf_dir):
    criteria = ["doc.source 0", "lc 1"]
    return rounded(f.freqs_blocks(the_hits(spark, sf_dir), criteria, **ARGS, fmaxitems=5))


@query(
    "f7_wordlist",
    f"{BASE} SELECT w AS value, count(*) AS frq, 'lc' AS attribute FROM tok GROUP BY w",
)
def f7(spark, sf_dir):
    return f.wordlist(documents(spark, sf_dir), "lc")


@query(
    "f7_wordlist_top",
    f"""SELECT value, count(*) AS frq, 'word' AS attribute FROM
        (SELECT unnest({WORDS}) AS value FROM documents) GROUP BY value ORDER BY frq DESC, value LIMIT 100""",
)
def f7_top(spark, sf_dir):
    return f.wordlist(documents(spark, sf_dir, word=True, lc=False), "word", 100)


@query(
    "f8_wordlist_texttype",
    """SELECT source AS value, count(*) AS frq, 'doc.source' AS attribute FROM documents GROUP BY source""",
)
def f8(spark, sf_dir):
    return f.wordlist(load_corpus(spark, sf_dir), "doc.source")


@query("f9_attr_vals", "SELECT DISTINCT source AS value FROM documents ORDER BY 1 LIMIT 1000")
def f9(spark, sf_dir):
    return f.attr_vals(load_corpus(spark, sf_dir), "doc.source", 1000)


SENTENCES = r"[^.!?\n]*(?:[.!?][^\S\n]*)+|[^.!?\n]+"


@query(
    "f10_corp_sizes",
    f"""{BASE}, sizes AS (SELECT
  (SELECT count(*) FROM tok) AS token,
  (SELECT count(*) FROM tok WHERE regexp_matches(w, '^[\\p{{L}}\\p{{N}}]')) AS word,
  (SELECT count(*) FROM documents) AS doc,
  (SELECT count(*) FROM (SELECT unnest(string_split(text, chr(10))) AS p FROM documents)
     WHERE regexp_matches(p, '\\S')) AS par,
  (SELECT count(*) FROM (SELECT w, pid, lead(w) OVER (PARTITION BY pid ORDER BY i) AS nxt FROM
     (SELECT pid, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM
       (SELECT row_number() OVER () AS pid, {LOWER.replace('text', 'p')} AS t FROM
         (SELECT unnest(string_split(text, chr(10))) AS p FROM documents))))
     WHERE nxt IS NULL OR (w IN ('.', '!', '?') AND nxt NOT IN ('.', '!', '?'))) AS sent)
SELECT structure, size FROM (UNPIVOT sizes ON token, word, doc, par, sent INTO NAME structure VALUE size)""",
)
def f10(spark, sf_dir):
    return f.corp_sizes(load_corpus(spark, sf_dir))


ATTRS = ["doc.lang", "doc.source", "doc.quality", "doc.toxic"]


@query(
    "f11_struct_stats",
    """SELECT 'doc' AS structure, attribute, size FROM (UNPIVOT (SELECT count(DISTINCT lang) AS lang,
        count(DISTINCT source) AS source, count(DISTINCT quality) AS quality, count(DISTINCT toxic) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id))
        ON lang, source, quality, toxic INTO NAME attribute VALUE size)""",
)
def f11(spark, sf_dir):
    return f.struct_attr_stats(load_corpus(spark, sf_dir, labels=True), ATTRS)


@query(
    "f12_texttype_norms",
    f"""WITH d AS (SELECT lang, source, quality, len({LOWER}) AS n
        FROM documents LEFT JOIN labels USING (doc_id))
      SELECT 'doc.lang' AS attribute, lang AS value, sum(n)::bigint AS tokens, count(*) AS docs FROM d GROUP BY lang
      UNION ALL SELECT 'doc.source', source, sum(n)::bigint, count(*) FROM d GROUP BY source
      UNION ALL SELECT 'doc.quality', quality::varchar, sum(n)::bigint, count(*) FROM d
        WHERE quality IS NOT NULL GROUP BY quality""",
)
def f12(spark, sf_dir):
    corpus = load_corpus(spark, sf_dir, labels=True)
    return f.text_types_with_norms(corpus, ["doc.lang", "doc.source", "doc.quality"])


@query(
    "f13_texttype_list",
    """SELECT DISTINCT a || ' 0' AS attribute FROM (
        SELECT unnest(['doc.' || lang, 'doc.' || source]) AS a FROM documents) WHERE NOT starts_with(a, 'doc.src1')""",
)
def f13(spark, sf_dir):
    # the attribute names come from the data: one per language and source
    names = load_corpus(spark, sf_dir).select(
        F.explode(F.array(F.concat(F.lit("doc."), "lang"), F.concat(F.lit("doc."), "source"))).alias("attribute")
    )
    return f.text_types(names.distinct(), ("doc.src1",), "0")


def hit_refs(spark, sf_dir):
    matched = m.match(with_tokens(load_corpus(spark, sf_dir, labels=True)), [m.term("the")])
    return m.hit_rows(matched, "lang", "source", "quality", "toxic")


LABELLED = f"{BASE}, {HITS}, refs AS (SELECT hits.*, quality, toxic FROM hits LEFT JOIN labels USING (doc_id))"


def count_query(name, sql, columns, where=None):
    @query(name, sql)
    def run(spark, sf_dir):
        counted = f.ttype_counts(hit_refs(spark, sf_dir), columns, where() if where else None)
        return counted.select(
            *[F.col(c).cast("bigint").alias(c) if c in ("quality", "toxic") else c for c in columns], "count"
        )


count_query(
    "f14a_value_counts_all",
    f"""{LABELLED} SELECT lang, source, quality::bigint AS quality, toxic::bigint AS toxic, count(*) AS "count" FROM refs
        WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY ALL""",
    ["lang", "source", "quality", "toxic"],
)
count_query(
    "f14b_value_counts_one",
    f"""{LABELLED} SELECT source, count(*) AS "count" FROM refs GROUP BY ALL""",
    ["source"],
)
count_query(
    "f14c_value_counts_where",
    f"""{LABELLED} SELECT lang, source, quality::bigint AS quality, count(*) AS "count" FROM refs
        WHERE source = 'src7' AND quality IS NOT NULL GROUP BY ALL""",
    ["lang", "source", "quality"],
    lambda: F.col("source") == "src7",
)


@query(
    "f15_subcorp",
    f"""{BASE}, parts AS (SELECT 'english' AS subcorpus, * FROM corpus WHERE lang = 'en'
        UNION ALL SELECT 'long', * FROM corpus WHERE length(text) > 5000
        UNION ALL SELECT 'src1_fr', * FROM corpus WHERE lang = 'fr' AND source = 'src1')
        SELECT subcorpus, count(*) AS docs, coalesce(sum(len(toks)), 0)::bigint AS tokens FROM parts GROUP BY 1""",
)
def f15(spark, sf_dir):
    subsets = {
        "english": F.col("lang") == "en",
        "long": F.length("text") > 5000,
        "src1_fr": (F.col("lang") == "fr") & (F.col("source") == "src1"),
    }
    return f.subcorpora(load_corpus(spark, sf_dir), subsets).filter(F.col("docs") > 0)


@query(
    "f16_query_desc",
    f"""{BASE}, {HITS}, s AS (SELECT 1::bigint AS step, '"the"' AS arg, 'the' AS nicearg, (SELECT count(*) FROM hits) AS size
        UNION ALL SELECT 2, '"the" "of"', 'the of', (SELECT count(*) FROM hits a JOIN tok b
          ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 AND b.w = 'of')
        UNION ALL SELECT 3, '"the" "of" within src7', 'the of', (SELECT count(*) FROM hits a JOIN tok b
          ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 AND b.w = 'of' WHERE a.source = 'src7'))
      SELECT *, round(1e6 * size / (SELECT count(*) FROM tok), 2) AS rel FROM s""",
)
def f16(spark, sf_dir):
    matched = m.match(the_hits(spark, sf_dir), [m.term("the"), m.term("of")], hits="hits2")
    inside = F.when(F.col("source") == "src7", F.col("hits2")).otherwise(
        F.filter("hits2", lambda h: F.lit(False))
    )
    return f.describe(
        matched,
        [
            ('"the"', "the", F.col("hits")),
            ('"the" "of"', "the of", F.col("hits2")),
            ('"the" "of" within src7', "the of", inside),
        ],
    )
