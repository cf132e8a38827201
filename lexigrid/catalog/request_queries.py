"""Request-table queries; the calls are derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrid.catalog.registry import query
from lexigrid.functions.request import canonical_json, redact_json, redact_url
from lexigrid.operators import requests as r
from lexigrid.sources.calls import calls_of
from lexigrid.plans.scale import materialized, with_once
from lexigrid.sources.corpus import dealt, read_table, spread
from lexigrid.sources.responses import (
    new_responses,
    rendered,
    require_format,
    responses_of,
)
from lexigrid.functions.text import strip_bom


def events(spark, sf_dir):
    rows = dealt(read_table(spark, sf_dir, "events"), "event_id")
    return rows.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def event_calls(spark, sf_dir):
    """One call per event; the type, and which parameters are there, follow the event."""
    kind = F.col("event_type")
    word = F.concat(F.lit(' alemma,"k'), "k", F.lit('" '))
    params = {
        " corpname ": F.array(F.concat(F.lit(" docs"), F.col("user_id") % 5)),
        "q": F.when(kind == "view", F.array(word, F.concat(F.lit("r"), "user_id")))
        .when(kind.isin("click", "purchase"), F.array(word)),
        "format": F.when(F.col("k") % 7 == 0, F.array(F.lit("xlsx"))).when(
            F.col("k") % 5 != 0, F.array(F.lit("json"))
        ),
        "fcrit": F.when(
            kind == "purchase", F.array(F.when(F.col("value") > 10, "doc.source 0").otherwise(""))
        ),
        "wltype": F.when((kind == "signup") & (F.col("user_id") % 2 == 0), F.array(F.lit("simple "))),
        "wlattr": F.when(kind == "signup", F.array(F.lit("doc.source"))),
        "lemma": F.when(kind == "error", F.array(F.concat(F.lit("é\\k"), "k"))),
    }
    pairs = F.create_map(*[c for name, v in params.items() for c in (F.lit(name), v)])
    types = {"view": "View", "click": "Collx", "purchase": "Freqs", "signup": "Wordlist"}
    call_type = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in types.items()], F.lit("Wsketch"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("call_id"),
        call_type.alias("call_type"),
        F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("params"),
        # some queries are lists of one
        F.when((kind == "click") & (F.col("k") % 3 == 0), F.create_map(F.lit("q"), F.lit("list")))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("kinds"),
    )


CALLS = r"""e AS (SELECT event_id AS call_id, event_type AS kind, user_id, value,
  json_extract_string(props, '$.k')::bigint AS k FROM events),
calls AS (SELECT call_id, user_id, k, CASE kind WHEN 'view' THEN 'View' WHEN 'click' THEN 'Collx'
    WHEN 'purchase' THEN 'Freqs' WHEN 'signup' THEN 'Wordlist' ELSE 'Wsketch' END AS call_type,
  'docs' || (user_id % 5) AS corpname,
  CASE WHEN kind = 'view' THEN ['alemma,"k' || k || '"', 'r' || user_id]
    WHEN kind IN ('click', 'purchase') THEN ['alemma,"k' || k || '"'] END AS q,
  kind = 'click' AND k % 3 = 0 AS q_list,
  CASE WHEN k % 7 = 0 THEN 'xlsx' WHEN k % 5 <> 0 THEN 'json' END AS format,
  CASE WHEN kind = 'purchase' THEN CASE WHEN value > 10 THEN 'doc.source 0' ELSE '' END END AS fcrit,
  CASE WHEN kind = 'signup' AND user_id % 2 = 0 THEN 'simple' END AS wltype,
  CASE WHEN kind = 'signup' THEN 'doc.source' END AS wlattr,
  CASE WHEN kind = 'error' THEN 'é\k' || k END AS lemma FROM e)"""


def canonical_sql(with_type=False, defaults=False, lists=True):
    fmt = "coalesce(format, 'json')" if defaults else "format"

    def one(name, value):
        return f"""'"{name}": ' || to_json({value})::varchar"""

    q = """'"q": ' || CASE WHEN len(q) = 1{} THEN to_json(q[1])::varchar ELSE '[' || array_to_string(
      list_transform(list_sort(q), lambda x: to_json(x)::varchar), ', ') || ']' END""".format(" AND NOT q_list" if lists else "")
    parts = [one("asyn", "CASE WHEN call_type = 'View' THEN '0' END")] if defaults else []
    parts += [one("call_type", "call_type")] if with_type else []
    parts += [one("corpname", "corpname"), one("fcrit", "fcrit"), one("format", fmt), one("lemma", "lemma"), q]
    parts += [one("wlattr", "wlattr"), one("wltype", "wltype")]
    return "'{' || array_to_string(list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL), ', ') || '}'"


@query(
    "k1_validate",
    f"""WITH {CALLS} SELECT call_id, call_type, CASE
        WHEN coalesce(format, 'json') <> 'json' THEN 'format must be one of json, xml, csv, txt: ' || format
        WHEN call_type = 'Freqs' AND fcrit = '' THEN 'fcrit parameter missing'
        WHEN call_type = 'Wordlist' AND wltype IS NULL THEN 'wltype parameter missing' ELSE '' END AS error FROM calls""",
)
def k1(spark, sf_dir):
    calls = event_calls(spark, sf_dir)
    # the key still carries blanks here
    calls = r.normalize_calls(calls)
    return r.validate_calls(calls).select("call_id", "call_type", "error")


@query(
    "k2_normalize",
    f"""WITH {CALLS} SELECT call_id, array_to_string(list_filter(['corpname=' || corpname, 'fcrit=' || fcrit,
          'format=' || format, 'lemma=' || lemma, 'q=' || array_to_string(list_sort(q), ';'), 'wlattr=' || wlattr,
          'wltype=' || wltype], lambda x: x IS NOT NULL), '&') AS params FROM calls""",
)
def k2(spark, sf_dir):
    calls = r.normalize_calls(event_calls(spark, sf_dir), sort_lists=True)
    shown = F.transform(
        F.array_sort(F.map_keys("params")),
        lambda k: F.concat(k, F.lit("="), F.array_join(F.try_element_at("params", k), ";")),
    )
    return calls.select("call_id", F.array_join(shown, "&").alias("params"))


@query("k3_canonical", f"WITH {CALLS} SELECT call_id, {canonical_sql()} AS canonical FROM calls")
def k3(spark, sf_dir):
    return r.with_canonical(event_calls(spark, sf_dir)).select("call_id", "canonical")


NESTED = """n AS (SELECT event_id AS call_id, user_id, json_extract_string(props, '$.k')::bigint AS k FROM events),
parts AS (SELECT call_id, '"flags": [false, true]' AS flags, '"json": {"a": [' || array_to_string(list_transform(
    list_sort(['x' || user_id, 'x' || k, 'é"']), lambda x: to_json(x)::varchar), ', ') || '], "b": ' || k ||
    ', "pairs": [' || array_to_string(list_transform(list_sort([list_sort([2, k]), list_sort([1, user_id]), [k]]),
      lambda x: '[' || array_to_string(x, ', ') || ']'), ', ') || '], "z": null}' AS nested, '"q": ["w' || k || '"]' AS q FROM n)"""


def nested_calls(spark, sf_dir):
    """Calls whose parameters hold objects and lists in lists; a key stands twice, with and without blanks."""
    line = F.format_string(
        '{"call_type": "View", "json": {"b" : %d, " a ": [" x%d", "x%d ", "\\u00e9\\""], "z": null,'
        ' "pairs": [[2, %d], [1,%d],[%d] ]}, "flags": [true, false], "q": "other", " q ": [" w%d"]}',
        "k", "user_id", "k", "k", "user_id", "k", "k",
    )
    return calls_of(events(spark, sf_dir).select(F.col("event_id").alias("call_id"), line.alias("value")))


@query(
    "k3_canonical_nested",
    f"WITH {NESTED} SELECT call_id, '{{' || flags || ', ' || nested || ', ' || q || '}}' AS canonical FROM parts",
)
def k3_nested(spark, sf_dir):
    return r.with_canonical(nested_calls(spark, sf_dir)).select("call_id", "canonical")


@query(
    "k4_call_key_nested",
    f"""WITH {NESTED} SELECT call_id, md5('{{"asyn": "0", "call_type": "View", ' || flags || ', "format": "json", ' || nested ||
        ', ' || q || '}}') AS key FROM parts""",
)
def k4_nested(spark, sf_dir):
    return r.with_key(nested_calls(spark, sf_dir)).select("call_id", "key")


KEYED = f"WITH {CALLS}, keyed AS (SELECT *, md5({canonical_sql(True, True)}) AS key FROM calls)"


def keyed_calls(spark, sf_dir):
    return r.with_key(event_calls(spark, sf_dir))


@query("k4_call_key", f"{KEYED} SELECT call_id, key, md5({canonical_sql(defaults=True)}) AS legacy_key FROM keyed")
def k4(spark, sf_dir):
    calls = keyed_calls(spark, sf_dir)
    return calls.select("call_id", "key", F.md5(canonical_json(F.col("params"), F.col("kinds"))).alias("legacy_key"))


@query(
    "k4_call_key_blake2b",
    f"""WITH {CALLS}, t AS (SELECT call_id, {canonical_sql(defaults=True)} AS text FROM calls)
        SELECT call_id, min(call_id) OVER (PARTITION BY text) AS first_call, 32 AS digits FROM t""",
)
def k4_blake2b(spark, sf_dir):
    """Which calls share a key; DuckDB has no BLAKE2b, so the tests compare known keys."""
    calls = r.with_key(event_calls(spark, sf_dir), algo="blake2b", legacy=True).select("call_id", "key")
    firsts = calls.groupBy("key").agg(F.min("call_id").alias("first_call"))
    return calls.join(firsts, "key").select("call_id", "first_call", F.length("key").alias("digits"))


@query(
    "k5_cache_split",
    f"""{KEYED}, stored AS (SELECT DISTINCT key FROM keyed WHERE user_id % 3 = 0)
        SELECT call_id, key, key IN (SELECT key FROM stored) AS cached FROM keyed""",
)
def k5(spark, sf_dir):
    # read three times, and a key costs far more than keeping it
    calls = materialized(keyed_calls(spark, sf_dir).select("call_id", "key"))
    stored = calls.join(
        events(spark, sf_dir).filter("user_id % 3 = 0").select(F.col("event_id").alias("call_id")), "call_id"
    )
    cached, missing = r.split_cached(calls, stored)
    return (
        cached.select("call_id", "key", F.lit(True).alias("cached"))
        .unionByName(missing.select("call_id", "key", F.lit(False).alias("cached")))
    )


@query(
    "k6_dedupe_calls",
    f"{KEYED} SELECT key, min(call_id) AS call_id, any_value(call_type) AS call_type, count(*) AS n_calls FROM keyed GROUP BY key",
)
def k6(spark, sf_dir):
    return r.dedupe_calls(keyed_calls(spark, sf_dir)).select("key", "call_id", "call_type", "n_calls")


@query(
    "k7_expand_pages",
    f"""{KEYED}, firsts AS (SELECT key, min(call_id) AS call_id FROM keyed WHERE call_type = 'View' GROUP BY key),
        sized AS (SELECT f.call_id, f.key, 1 + k % 3 AS fromp, 10 AS pagesize, user_id * 7 AS concsize
          FROM firsts f JOIN calls USING (call_id)),
        paged AS (SELECT *, ceil(concsize / pagesize)::bigint AS n FROM sized WHERE concsize > 0)
        SELECT call_id, unnest(range(fromp, 1 + least(fromp + 4, CASE WHEN n = 1 THEN fromp ELSE n END))) AS fromp FROM paged""",
)
def k7(spark, sf_dir):
    calls = r.dedupe_calls(keyed_calls(spark, sf_dir).filter("call_type = 'View'"))
    source = events(spark, sf_dir).select(F.col("event_id").alias("call_id"), "k", "user_id")
    calls = calls.join(source, "call_id")
    calls = calls.withColumn(
        "params",
        F.map_concat(
            "params",
            F.create_map(
                F.lit("fromp"),
                F.array((1 + F.col("k") % 3).cast("string")),
                F.lit("pagesize"),
                F.array(F.lit("10")),
            ),
        ),
    )
    sizes = calls.select("key", (F.col("user_id") * 7).alias("concsize"))
    return r.expand_pages(calls.drop("k", "user_id"), sizes, max_pages=5).select("call_id", "fromp")


@query(
    "k8_expand_strata",
    """WITH t AS (SELECT item_id AS call_id, string_split(text, ' ')[1] AS w FROM benchmark),
        v AS (SELECT DISTINCT source AS value FROM documents)
        SELECT call_id, value, 'aword,"' || w || '" [] within <doc source="' || value || '" />|r5' AS q FROM t, v""",
)
def k8(spark, sf_dir):
    first = F.get(F.split("text", " "), F.lit(0))
    templates = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("call_id"),
        F.lit("View").alias("call_type"),
        F.lit("documents").alias("corpname"),
        F.lit("doc.source").alias("attribute"),
        F.array(F.concat(F.lit('aword,"'), first, F.lit('" []')), F.lit("r5")).alias("q"),
    )
    values = read_table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("corpname"), F.lit("doc.source").alias("attribute"), F.col("source").alias("value")
    )
    calls = r.expand_by_values(templates, values.distinct())
    return calls.select("call_id", "value", F.array_join("q", "|").alias("q"))


@query(
    "k9_redact_url",
    r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '([?&])utm_source=[^&#]*', '\1', 'g'),
        '\?&+', '?'), '[?&]+(#|$)', '\1') AS url FROM pages""",
)
def k9(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", redact_url("url", ["utm_source"]).alias("url"))


@query(
    "k10_redact_json",
    """SELECT event_id, '{"error":"","request":{"k":' || json_extract_string(props, '$.k') || '}}' AS body FROM events""",
)
def k10(spark, sf_dir):
    body = F.concat(
        F.lit('{"error": "", "request": {"api_key": "x", "username": "user'),
        "user_id",
        F.lit('", '),
        F.substr("props", F.lit(2)),
        F.lit("}"),
    )
    return events(spark, sf_dir).select("event_id", redact_json(body).alias("body"))


def event_responses(spark, sf_dir):
    """A response per event; errors and formats follow the event type."""
    kind = F.col("event_type")
    error = F.when(kind == "error", F.concat(F.lit("no corpus "), F.col("user_id") % 4)).when(
        kind == "signup", "timeout"
    )
    body = F.to_json(F.struct(error.alias("error"), "k"))
    fmt = F.when(kind == "view", "csv").otherwise("json")
    return events(spark, sf_dir).select(
        "event_id", "user_id", "k", fmt.alias("format"), F.when(kind == "view", "a,b").otherwise(body).alias("text")
    )


RESPONSES = """responses AS (SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'unimplemented'
  WHEN 'error' THEN 'no corpus ' || (user_id % 4) WHEN 'signup' THEN 'timeout' ELSE '' END AS error FROM events)"""


@query(
    "k11_classify_errors",
    f"WITH {RESPONSES} SELECT event_id, error, error IN ('', 'unimplemented') AS ok FROM responses",
)
def k11(spark, sf_dir):
    return r.call_errors(event_responses(spark, sf_dir)).select("event_id", "error", "ok")


@query(
    "k12_job_summary",
    f"""WITH {RESPONSES} SELECT error, count(*) AS n, (SELECT count(*) FROM responses) AS calls
        FROM responses WHERE error NOT IN ('', 'unimplemented') GROUP BY error""",
)
def k12(spark, sf_dir):
    return r.job_summary(r.call_errors(event_responses(spark, sf_dir)))


@query(
    "k13_by_type",
    f"""WITH {CALLS} SELECT * FROM (SELECT call_type, count(*) OVER (PARTITION BY call_type) AS total,
        row_number() OVER (PARTITION BY call_type ORDER BY call_id) AS rank, call_id FROM calls) WHERE rank <= 3""",
)
def k13(spark, sf_dir):
    return r.calls_by_type(event_calls(spark, sf_dir))


@query(
    "k14_step_fields",
    f"""WITH {CALLS}, s AS (SELECT call_id, unnest(q) AS t, generate_subscripts(q, 1) - 1 AS step FROM calls)
        SELECT call_id, step, CASE WHEN t LIKE 'a%' THEN 'query' ELSE 'sample' END AS kind,
        CASE WHEN t LIKE 'a%' THEN 'lemma' END AS attribute, CASE WHEN t LIKE 'a%' THEN t[8:] END AS body,
        CASE WHEN t LIKE 'a%' THEN 'CQL' END AS rule_kind, CASE WHEN t LIKE 'r%' THEN t[2:]::bigint END AS sample FROM s""",
)
def k14(spark, sf_dir):
    return r.step_fields(r.normalize_calls(event_calls(spark, sf_dir)))


# --- sources --------------------------------------------------------------------


@query(
    "s2_responses_scan",
    f"""{KEYED} SELECT k.call_id, md5(k.call_id::varchar || key) AS key, 'json' AS format, 200 AS status, 'OK' AS reason,
        'http://host/run?corpname=' || corpname AS url, 'application/json' AS content_type, '{{"n":' || k || '}}' AS text
        FROM keyed k WHERE user_id % 4 <> 0""",
)
def s2(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_id").alias("call_id"), "user_id", "k")
    keyed = keyed_calls(spark, sf_dir).select("call_id", "key", r.scalar(F.col("params"), "corpname").alias("corpname"))
    # read for bodies and for what is kept beside them, each by two readers
    calls = materialized(keyed.join(rows, "call_id"))
    name = F.md5(F.concat(F.col("call_id").cast("string"), "key"))
    bodies = calls.select(
        F.concat(name, F.lit(".json")).alias("file_name"),
        F.concat(F.lit("\ufeff"), F.to_json(F.struct(F.col("k").alias("n"), "call_id"))).alias("value"),
    )
    meta = calls.filter("user_id % 4 <> 0").select(
        F.concat(name, F.lit(".meta.json")).alias("file_name"),
        F.to_json(
            F.struct(
                F.concat(F.lit("http://host/run?corpname="), "corpname").alias("url"),
                F.lit(200).alias("status"),
                F.lit("OK").alias("reason"),
                F.create_map(F.lit("Content-Type"), F.lit("application/json")).alias("headers"),
                F.lit("").alias("ske_error"),
            )
        ).alias("value"),
    )
    out = responses_of(bodies.unionByName(meta))
    return out.select(
        F.get_json_object("text", "$.call_id").cast("bigint").alias("call_id"),
        "key",
        "format",
        "status",
        "reason",
        "url",
        F.try_element_at("headers", F.lit("Content-Type")).alias("content_type"),
        F.concat(F.lit('{"n":'), F.get_json_object("text", "$.n"), F.lit("}")).alias("text"),
    )


@query(
    "s3_calls_scan",
    f"WITH {CALLS} SELECT call_id, call_type, {canonical_sql()} AS canonical FROM calls WHERE k % 9 <> 0",
)
def s3(spark, sf_dir):
    calls = r.normalize_calls(event_calls(spark, sf_dir)).withColumn(
        "params", F.map_concat("params", F.create_map(F.lit("call_type"), F.array("call_type")))
    )
    k = events(spark, sf_dir).select(F.col("event_id").alias("call_id"), "k")
    blank_some = F.when(F.col("k") % 9 == 0, "  ").otherwise(canonical_json(F.col("params"), F.col("kinds")))
    # the text is read twice and tested for blanks, but written once
    lines = with_once(calls.join(k, "call_id"), "value", blank_some).select("call_id", "value")
    canonical = canonical_json(F.col("params"), F.col("kinds"))
    return calls_of(lines).select("call_id", "call_type", canonical.alias("canonical"))


@query(
    "s4_result_write",
    """SELECT source, '{"source":"' || source || '","docs":' || count(*) || '}' AS json, source || ',' || count(*) AS csv,
        source || chr(9) || count(*) AS txt,
        '<row><source>' || source || '</source><docs>' || count(*) || '</docs></row>' AS xml
        FROM documents GROUP BY source""",
)
def s4(spark, sf_dir):
    counts = read_table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("docs"))
    out = counts.select("source", *[rendered(counts, f).alias(f) for f in ("json", "csv", "txt", "xml")])
    return out.withColumn("xml", F.regexp_replace("xml", r"\n\s*", ""))


@query(
    "s5_store_append",
    f"""{KEYED}, j AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'bad query' WHEN k % 4 = 1 THEN 'unimplemented' ELSE '' END AS ske_error
          FROM keyed), stored AS (SELECT DISTINCT key FROM keyed WHERE user_id % 3 = 0)
        SELECT key, min(call_id) AS call_id FROM j WHERE ske_error IN ('', 'unimplemented')
        AND key NOT IN (SELECT key FROM stored) GROUP BY key""",
)
def s5(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_id").alias("call_id"), "user_id", "k")
    calls = keyed_calls(spark, sf_dir).select("call_id", "key").join(rows, "call_id")
    error = F.when(F.col("k") % 4 == 0, "bad query").when(F.col("k") % 4 == 1, "unimplemented").otherwise("")
    responses = calls.select("key", "call_id", error.alias("ske_error"))
    store = calls.filter("user_id % 3 = 0").select("key")
    return new_responses(responses, store).select("key", "call_id")


@query(
    "s5_store_append_headers",
    f"""{KEYED}, r AS (SELECT key, call_id % 4 AS turn, 'http://host/' || call_id % 3 AS url, '{{"n":' || call_id % 2 || '}}' AS text,
          'etag' || call_id % 5 AS etag FROM keyed WHERE k % 4 <> 0),
        stored AS (SELECT DISTINCT key FROM keyed WHERE user_id % 3 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY text, url, etag) AS i FROM r
          WHERE key NOT IN (SELECT key FROM stored))
        SELECT key, text, url, etag, count(*) OVER () AS n FROM ranked WHERE i = 1""",
)
def s5_headers(spark, sf_dir):
    """Scanned files, which carry headers, go into the store as they are."""
    rows = events(spark, sf_dir).select(F.col("event_id").alias("call_id"), "user_id", "k")
    calls = keyed_calls(spark, sf_dir).select("key", "call_id").join(rows, "call_id")
    meta = F.struct(
        F.concat(F.lit("http://host/"), F.col("call_id") % 3).alias("url"),
        F.lit(200).alias("status"),
        F.lit("OK").alias("reason"),
        F.create_map(F.lit("ETag"), F.concat(F.lit("etag"), F.col("call_id") % 5), F.lit("Content-Type"), F.lit("application/json")).alias("headers"),
        F.when(F.col("k") % 4 == 0, "bad query").otherwise("").alias("ske_error"),
    )
    # several responses to a key, each under a file name of its own
    name = F.concat("key", F.lit("_"), F.col("call_id").cast("string"))
    bodies = calls.select(F.concat(name, F.lit(".json")).alias("file_name"), F.format_string('{"n":%d}', F.col("call_id") % 2).alias("value"))
    metas = calls.select(F.concat(name, F.lit(".meta.json")).alias("file_name"), F.to_json(meta).alias("value"))
    scanned = responses_of(bodies.unionByName(metas)).withColumn("key", F.substring_index("key", "_", 1))
    fresh = new_responses(scanned, calls.filter("user_id % 3 = 0").select("key"))
    total = fresh.agg(F.count("*")).scalar()
    return fresh.select("key", "text", "url", F.try_element_at("headers", F.lit("ETag")).alias("etag"), total.alias("n"))


@query("s6_strip_bom", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def s6(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(strip_bom(F.concat(F.lit("\ufeff\ufeff"), "text"))).alias("text_md5"))


@query("s7_format_guard", "SELECT event_id FROM events WHERE event_type NOT IN ('view', 'click')")
def s7(spark, sf_dir):
    kind = F.col("event_type")
    rows = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", "csv").otherwise("json").alias("format"),
        F.create_map(
            F.lit("Content-Type"), F.when(kind == "click", "text/plain").otherwise("application/json; charset=utf-8")
        ).alias("headers"),
        F.lit("{}").alias("text"),
    )
    return require_format(rows, "json", strict=False).select("event_id")
