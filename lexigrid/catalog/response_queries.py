"""Response-table queries.

The responses are built from native results as JSON, one small body per source,
language, document or user, and then flattened; the SQL computes the native result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.concordance_queries import the_docs, the_lines
from lexigrid.catalog.corpus_queries import LEXICON_SQL, documents, lexicon
from lexigrid.catalog.frequency_queries import the_hits
from lexigrid.catalog.registry import BASE, HITS, LOWER, OFFSETS, WORDS, query
from lexigrid.functions.arrays import struct_of_arrays
from lexigrid.functions.text import count_tokens, split_paragraphs, split_sentences
from lexigrid.operators import concordance as c
from lexigrid.operators import responses as r
from lexigrid.plans.scale import with_once
from lexigrid.sources.corpus import load_corpus, read_table


def body(*columns):
    return F.to_json(F.struct(*columns)).alias("text")


def freq_responses(spark, sf_dir):
    """One response per source: hits of ``the`` by language, then by joint values."""
    matched = the_hits(spark, sf_dir)
    counts = matched.groupBy("source", "lang").agg(
        F.sum(F.size("hits").cast("bigint")).alias("frq"), F.sum(F.size("toks").cast("bigint")).alias("n_v")
    )
    sums = F.struct(F.sum("frq").alias("f"), F.sum("n_v").alias("N"))
    item = F.struct("lang", "frq", "n_v")
    # at most one item per language
    per = counts.groupBy("source").agg(sums.alias("s"), F.array_sort(F.collect_list(item)).alias("items"))

    def items(words, full):
        def one(i):
            frq, total = i["frq"], F.col("s.N")
            measures = [frq.alias("frq"), (F.lit(1e6) * frq / total).alias("fpm")]
            if full:
                measures += [
                    (F.lit(100.0) * (frq / i["n_v"]) / (F.col("s.f") / total)).alias("rel"),
                    (F.lit(1e6) * frq / i["n_v"]).alias("reltt"),
                ]
            return F.struct(F.transform(words(i), lambda w: F.struct(w.alias("n"))).alias("Word"), *measures)

        return F.transform(F.filter("items", lambda i: i["frq"] > 0), one)

    def block(head, words, full):
        return F.struct(
            F.array(F.struct(F.lit(head).alias("id"))).alias("Head"), items(words, full).alias("Items")
        )

    blocks = F.array(
        F.to_json(block("doc.lang", lambda i: F.array(i["lang"]), True)),
        F.to_json(block("lc|doc.lang", lambda i: F.array(F.lit("the"), i["lang"]), False)),
    )
    desc = F.struct(
        F.lit('"the"').alias("arg"),
        F.lit("the").alias("nicearg"),
        F.round(F.lit(1e6) * F.col("s.f") / F.col("s.N"), 2).alias("rel"),
        F.col("s.f").alias("size"),
    )
    text = F.concat(
        F.lit('{"Blocks": ['),
        F.array_join(blocks, ", "),
        F.lit('], "Desc": ['),
        F.to_json(desc),
        F.lit('], "request": '),
        F.to_json(F.struct(F.col("source").alias("corpname"))),
        F.lit("}"),
    )
    return per.select(F.col("source").alias("key"), text.alias("text"))


PER_SOURCE = f"""{BASE}, {HITS}, f AS (SELECT source, lang, count(*) AS frq FROM hits GROUP BY 1, 2),
n AS (SELECT source, lang, count(*) AS n_v FROM tok GROUP BY 1, 2),
s AS (SELECT source, (SELECT count(*) FROM hits h WHERE h.source = t.source) AS f, count(*) AS n FROM tok t GROUP BY source),
items AS (SELECT * FROM f JOIN n USING (source, lang) JOIN s USING (source))"""


@query(
    "r1_freqs_table",
    f"""{PER_SOURCE} SELECT source AS key, frq, round(100.0 * (frq::double / n_v) / (f::double / n), 6) AS rel,
          round(1e6 * frq / n_v, 6) AS reltt, round(1e6 * frq / n, 6) AS fpm, lang AS value, 'doc.lang' AS attribute,
          '"the"' AS arg, 'the' AS nicearg, source AS corpname, round(1e6 * f / n, 2) AS total_fpm, f AS total_frq,
          NULL::varchar AS fmaxitems FROM items
        UNION ALL SELECT source, frq, NULL, NULL, round(1e6 * frq / n, 6), 'the|' || lang, 'lc|doc.lang', '"the"', 'the',
          source, round(1e6 * f / n, 2), f, NULL FROM items""",
)
def r1(spark, sf_dir):
    table = r.freqs_table(freq_responses(spark, sf_dir))
    return table.select(
        *[F.round(x, 6).alias(x) if x in ("rel", "reltt", "fpm") else x for x in table.columns]
    )


@query("r2_block_heads", "SELECT DISTINCT source AS key, 'doc.lang;lc|doc.lang' AS heads FROM documents")
def r2(spark, sf_dir):
    parsed = freq_responses(spark, sf_dir).select("key", F.from_json("text", r.FREQS).alias("j"))
    return parsed.select("key", F.array_join(r.block_heads(F.col("j.Blocks")), ";").alias("heads"))


@query(
    "r3_item_values",
    f"""{PER_SOURCE} SELECT source AS key, string_agg('the|' || lang || '=' || frq, ';' ORDER BY lang) AS vals
        FROM items GROUP BY source""",
)
def r3(spark, sf_dir):
    parsed = freq_responses(spark, sf_dir).select("key", F.from_json("text", r.FREQS).alias("j"))
    items = r.item_values(F.get("j.Blocks", F.lit(1))["Items"])
    shown = F.transform(items, lambda i: F.concat(i["value"], F.lit("="), i["frq"].cast("string")))
    return parsed.select("key", F.array_join(shown, ";").alias("vals")).filter(F.col("vals") != "")


@query(
    "r4_wordlist_table",
    """SELECT source AS key, lang AS str, count(*) AS frq, round_even(avg(n_chars), 2) AS relfreq, 'doc.lang' AS attribute
       FROM documents GROUP BY source, lang""",
)
def r4(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    counts = docs.groupBy("source", "lang").agg(F.count("*").alias("frq"), F.avg("n_chars").alias("relfreq"))
    item = F.struct(F.col("lang").alias("str"), "frq", "relfreq")
    responses = counts.groupBy("source").agg(F.collect_list(item).alias("Items")).select(
        F.col("source").alias("key"), body("Items", F.struct(F.lit("doc.lang").alias("wlattr")).alias("request"))
    )
    return r.wordlist_table(responses, "str string, frq bigint, relfreq double")


@query(
    "r5_structures_table",
    """SELECT lang AS key, 'doc' AS structure, attribute, size FROM (UNPIVOT (SELECT lang, count(DISTINCT source) AS source,
        count(DISTINCT n_chars) AS n_chars FROM documents GROUP BY lang) ON source, n_chars INTO NAME attribute VALUE size)""",
)
def r5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    stats = docs.groupBy("lang").agg(
        F.count_distinct("source").alias("source"), F.count_distinct("n_chars").alias("n_chars"), F.count("*").alias("n")
    )

    def attribute(name):
        return F.struct(
            F.lit(name).alias("name"), F.lit(name).alias("label"), F.col(name).alias("size"), F.lit("").alias("dynamic")
        )

    attributes = F.array(attribute("source"), attribute("n_chars"))

    def structure(name, attrs):
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(name).alias("label"),
            F.col("n").cast("string").alias("size"),
            attrs.alias("attributes"),
        )

    none = F.filter(attributes, lambda a: F.lit(False))
    structures = F.array(structure("doc", attributes), structure("par", none)).alias("structures")
    request = F.struct(F.lit("1").alias("struct_attr_stats")).alias("request")
    return r.structures_table(stats.select(F.col("lang").alias("key"), body(structures, request)))


def size_responses(spark, sf_dir):
    """One response per document."""
    counts = {
        "tokencount": count_tokens("text"),
        "wordcount": F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")),
        "doccount": F.lit(1),
        "parcount": F.size(split_paragraphs("text")),
        "sentcount": F.size(split_sentences("text")),
    }
    sizes = F.struct(*[v.cast("string").alias(k) for k, v in counts.items()]).alias("sizes")
    return load_corpus(spark, sf_dir).select(F.col("doc_id").cast("string").alias("key"), body(sizes))


@query(
    "r6_sizes_table",
    f"""WITH d AS (SELECT doc_id, {LOWER} AS toks, text FROM documents),
  lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS ln
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
  pt AS (SELECT doc_id, ln, unnest(t) AS w, generate_subscripts(t, 1) AS i
    FROM (SELECT doc_id, ln, {LOWER.replace('text', 'line')} AS t FROM lines)),
  nx AS (SELECT *, lead(w) OVER (PARTITION BY doc_id, ln ORDER BY i) AS nxt FROM pt),
  sn AS (SELECT doc_id, count(*) AS sent FROM nx WHERE nxt IS NULL OR (w IN ('.', '!', '?') AND nxt NOT IN ('.', '!', '?')) GROUP BY 1),
  pn AS (SELECT doc_id, count(*) AS par FROM lines WHERE regexp_matches(line, '\\S') GROUP BY 1),
  s AS (SELECT doc_id::varchar AS key, len(toks) AS token, len(list_filter(toks, lambda x: regexp_matches(x, '^[\\p{{L}}\\p{{N}}]'))) AS word,
    1::bigint AS doc, coalesce(par, 0) AS par, coalesce(sent, 0) AS sent FROM d LEFT JOIN sn USING (doc_id) LEFT JOIN pn USING (doc_id))
SELECT key, structure, size FROM (UNPIVOT s ON token, word, doc, par, sent INTO NAME structure VALUE size)""",
)
def r6(spark, sf_dir):
    return r.sizes_table(size_responses(spark, sf_dir))


@query("r6_structure_names", "SELECT doc_id::varchar AS key, 'token word doc par sent' AS structures FROM documents")
def r6_names(spark, sf_dir):
    return r.structure_names(size_responses(spark, sf_dir))


@query(
    "r7_text_types_list",
    """SELECT doc_id::varchar AS key, unnest(['doc.' || lang || ' 0', 'doc.' || source || ' 0']) AS attribute FROM documents""",
)
def r7(spark, sf_dir):
    def block(name):
        return F.struct(F.array(F.struct(name.alias("name"))).alias("Line"))

    blocks = F.array(
        block(F.concat(F.lit("doc."), "lang")),
        block(F.lit("doc.wordcount")),
        block(F.concat(F.lit("doc."), "source")),
    ).alias("Blocks")
    docs = read_table(spark, sf_dir, "documents")
    responses = docs.select(F.col("doc_id").cast("string").alias("key"), body(blocks))
    return r.text_types_list(responses, position="0")


def view_response(lines, key, corpname):
    """One response per line: a page of one hit."""
    desc = F.array(F.struct(F.lit('"the"').alias("arg"), F.lit("the").alias("nicearg")))
    return lines.select(
        key.alias("key"),
        body(
            F.struct(corpname.alias("corpname"), F.array(F.lit('aword,"the"')).alias("q")).alias("request"),
            desc.alias("Desc"),
            F.array("line").alias("Lines"),
        ),
    )


ANNOTATED = f"""{BASE}, {LEXICON_SQL}, w AS (SELECT doc_id, unnest({WORDS}) AS word,
  generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents),
a AS (SELECT tok.doc_id, tok.source, tok.pos, word, tok.w AS lc, coalesce(lemma, tok.w) AS lemma,
  coalesce(regexp_replace(tag, '\\d', '', 'g'), 'X') AS tag FROM tok JOIN w USING (doc_id, pos)
  LEFT JOIN lexicon ON tok.w = lexicon.lc WHERE TRUE)"""


def annotated_lines(spark, sf_dir):
    words = lexicon(documents(spark, sf_dir))
    return c.view_lines(the_docs(spark, sf_dir, word=True), 4, 4, ["#", "=source"], lexicon=words, untagged="X")


@query(
    "r8_line_annotations",
    f"""{ANNOTATED} SELECT h.doc_id, h.pos AS toknum, string_agg(x.word, ' ' ORDER BY x.pos) AS token,
        string_agg(x.tag, ' ' ORDER BY x.pos) AS pos, string_agg(x.lemma, ' ' ORDER BY x.pos) AS lemma
        FROM a h JOIN a x ON h.doc_id = x.doc_id AND x.pos BETWEEN h.pos - 4 AND h.pos + 4 WHERE h.lc = 'the' GROUP BY 1, 2""",
)
def r8(spark, sf_dir):
    lines = annotated_lines(spark, sf_dir)
    text = lines.select("doc_id", F.to_json("line").alias("text"))
    parsed = with_once(text, "line", F.from_json("text", r.LINE))
    parsed = with_once(parsed, "a", r.line_annotations(F.col("line")))
    return parsed.filter(~F.col("a.malformed")).select(
        "doc_id", "a.toknum", *[F.array_join(f"a.{x}", " ").alias(x) for x in ("token", "pos", "lemma")]
    )


@query(
    "r9_annotation_export",
    f"""{ANNOTATED} SELECT h.doc_id || ':' || h.pos AS key, h.pos AS toknum, h.source AS corpus,
        '#' || h.pos || '|' || h.source AS refs, 'the' AS "desc",
        string_agg((x.pos - greatest(h.pos - 4, 0)) || '=' || x.lemma, ' ' ORDER BY x.pos) AS lemma
        FROM a h JOIN a x ON h.doc_id = x.doc_id AND x.pos BETWEEN h.pos - 4 AND h.pos + 4 WHERE h.lc = 'the' GROUP BY ALL""",
)
def r9(spark, sf_dir):
    lines = annotated_lines(spark, sf_dir)
    key = F.concat_ws(":", "doc_id", "pos")
    responses = view_response(lines, key, F.get("line.Refs", F.lit(1)))
    out = r.annotations(responses)
    shown = F.transform(F.map_entries("lemma"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select(
        "key",
        "toknum",
        "corpus",
        F.array_join("refs", "|").alias("refs"),
        F.get("desc", F.lit(0))["nicearg"].alias("desc"),
        F.array_join(shown, " ").alias("lemma"),
    )


@query(
    "r10_refs_table",
    f"""{BASE}, {HITS}, {OFFSETS} SELECT "offset" + pos AS "#", source AS "doc.source", lang AS "doc.lang"
        FROM hits JOIN offs USING (doc_id)""",
)
def r10(spark, sf_dir):
    lines = the_lines(spark, sf_dir)
    responses = view_response(lines, F.concat_ws(":", "doc_id", "pos"), F.lit("documents"))
    return r.refs_table(responses, ["doc.source", "doc.lang"]).drop("key")


@query(
    "r11_list_to_columns",
    """SELECT conv_id, string_agg(turn, ';' ORDER BY turn) AS turns, string_agg(role, ';' ORDER BY turn) AS roles,
        string_agg(length(text), ';' ORDER BY turn) AS chars,
        string_agg(coalesce(CASE WHEN role = 'user' THEN md5(text) END, '-'), ';' ORDER BY turn) AS md5s
        FROM conversations GROUP BY conv_id""",
)
def r11(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    inner = F.struct(
        F.length("text").alias("chars"), F.when(F.col("role") == "user", F.md5("text")).alias("md5")
    )
    record = F.struct("turn", "role", inner.alias("body"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(record)).alias("records"))
    columns = struct_of_arrays(F.col("records"), rows.schema["records"].dataType)
    return rows.select("conv_id", columns.alias("c")).select(
        "conv_id",
        F.array_join("c.turn", ";").alias("turns"),
        F.array_join("c.role", ";").alias("roles"),
        F.array_join("c.body.chars", ";").alias("chars"),
        F.array_join("c.body.md5", ";", "-").alias("md5s"),
    )


@query("r12_vals_list", "SELECT DISTINCT user_id::varchar AS key, event_type AS value FROM events")
def r12(spark, sf_dir):
    # at most one value per event type
    users = read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("suggestions"))
    return r.attr_vals_table(users.select(F.col("user_id").cast("string").alias("key"), body("suggestions")))


@query(
    "r13_meta_flatten",
    """SELECT event_id::varchar AS key, 'http://host/run?user=' || user_id AS url, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END
        AS status, CASE WHEN event_type = 'error' THEN 'Server Error' ELSE 'OK' END AS reason, 'application/json' AS content_type,
        CASE WHEN event_type = 'signup' THEN 'timeout' ELSE '' END AS ske_error FROM events""",
)
def r13(spark, sf_dir):
    kind = F.col("event_type")
    value = F.to_json(
        F.struct(
            F.concat(F.lit("http://host/run?user="), "user_id").alias("url"),
            F.when(kind == "error", 500).otherwise(200).alias("status"),
            F.when(kind == "error", "Server Error").otherwise("OK").alias("reason"),
            F.create_map(F.lit("Content-Type"), F.lit("application/json")).alias("headers"),
            F.when(kind == "signup", "timeout").otherwise("").alias("ske_error"),
        )
    )
    files = read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), value.alias("value"))
    return r.meta_table(files).withColumn(
        "content_type", F.try_element_at("headers", F.lit("Content-Type"))
    ).drop("headers")
