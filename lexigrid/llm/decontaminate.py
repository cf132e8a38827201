"""Benchmark decontamination by a prefix-filtered set join, with built-in functions only.

A window is ``size`` consecutive words of a benchmark item (a shorter item is one window). The
words of all windows are ordered by how often they occur in the documents; a document can hold a
window only if it holds the window's rarest word, so only that word is joined with the words of
the documents. A match fixes where the window would start; starts before the first word or ends
past the last are dropped, and the rest is verified word for word on the document's row.

Defined cases: null texts have no words; items with a null id and items without words take no
part; repeated items count once by id; a document without words has no hits; repeated documents
give repeated rows; null document ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.registry import query
from lexigrid.llm.words import broadcast_if_small, words_of
from lexigrid.plans.scale import explode_kept, materialized, posexplode_kept, with_once

SIZE = 10
#: broadcast windows and words up to this number; more are joined by shuffle
SMALL = 200_000


def item_windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``_item, _length, _window``: each distinct window of each item."""
    words = items.filter("_item IS NOT NULL").select("_item", words_of(F.col("_text")).alias("_words"))
    n = F.size("_words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    rows = words.filter(n > 0).select("_item", "_words", F.explode(starts).alias("_start"))
    window = F.expr(f"slice(_words, _start, {size})")
    return rows.select("_item", F.least(n, F.lit(size)).alias("_length"), window.alias("_window")).distinct()


def _joined(words: DataFrame, keys: DataFrame) -> DataFrame:
    """Words of documents with the entries of ``keys``; past a broadcast, skewed words are split at run time."""
    keys = broadcast_if_small(keys, SMALL)
    return words.join(keys, "_word")


def _judged(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, size: int
) -> tuple[DataFrame, DataFrame]:
    """Per document ``_id, _key, n_words, n_hit, _wids`` (windows found), and the windows by item."""
    windows = item_windows(items.select(F.col(item_col).alias("_item"), F.col(item_text).alias("_text")), size)
    windows = materialized(windows.withColumn("_wid", F.xxhash64("_length", "_window")))
    distinct = windows.groupBy("_wid").agg(F.first("_length").alias("_length"), F.first("_window").alias("_window"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn(
        "_key", F.xxhash64("_id", "_text")
    )
    # how often each word of a window occurs in all documents
    vocabulary = distinct.select(F.explode("_window").alias("_word")).distinct()
    counts = (
        _joined(explode_kept(rows, words_of(F.col("_text")), "_word"), vocabulary).groupBy("_word").agg(F.count("*").alias("_n"))
    )
    placed = distinct.select("_wid", "_length", F.posexplode("_window").alias("_at", "_word"))
    rarest = (
        placed.join(counts, "_word", "left")
        .groupBy("_wid", "_length")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_word", "_at")).alias("_rare"))
        # a word that no document holds rules its window out
        .filter("_rare._n > 0")
        .select("_wid", "_length", F.col("_rare._word").alias("_word"), F.col("_rare._at").alias("_at"))
    )
    rarest = materialized(rarest)
    tokens = rows.select("_key", words_of(F.col("_text")).alias("_words"))
    tokens = posexplode_kept(tokens.select("_key", "_words", F.size("_words").alias("_total")), F.col("_words"), "_word", "_key", "_total", pos="_pos")
    start = F.col("_pos") - F.col("_at")
    starts = (
        _joined(tokens, rarest)
        .select("_key", "_wid", "_length", "_total", start.alias("_start"))
        .filter((F.col("_start") >= 0) & (F.col("_start") + F.col("_length") <= F.col("_total")))
    )
    # the rarest word fixes one start per place, so a document has at most its length per window word
    texts = distinct.select("_wid", F.col("_window").alias("_want"))
    candidates = (
        starts.join(broadcast_if_small(texts, SMALL), "_wid")
        .groupBy("_key")
        .agg(F.collect_set(F.struct("_start", "_length", "_wid", "_want")).alias("_candidates"))
    )
    checked = rows.join(candidates, "_key", "left").select("_id", "_key", F.coalesce("_text", F.lit("")).alias("_text"), "_candidates")
    # words and spans are computed once each, also where only some columns are asked for
    checked = with_once(checked, "_words", words_of(F.col("_text"))).drop("_text")
    same = F.filter("_candidates", lambda c: F.slice(F.col("_words"), c["_start"] + 1, c["_length"]) == c["_want"])
    found = with_once(checked.withColumn("n_words", F.size("_words").cast("long")), "_found", same)
    spans = F.transform("_found", lambda c: F.sequence(c["_start"], c["_start"] + c["_length"] - 1))
    hit = F.coalesce(F.size(F.array_distinct(F.flatten(spans))), F.lit(0)).cast("long")
    wids = F.array_distinct(F.transform("_found", lambda c: c["_wid"]))
    judged = found.select("_id", "_key", "n_words", F.when(F.size("_found") > 0, hit).otherwise(0).alias("n_hit"), wids.alias("_wids"))
    return judged, windows


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items`` (sorted ids of items found).

    ``n_hit`` counts the document's words inside any occurrence of a window.
    """
    judged, windows = _judged(docs, items, id_col, text_col, item_col, item_text, size)
    each = judged.select("_id", "_key", "n_words", "n_hit", F.posexplode_outer("_wids").alias("_order", "_wid"))
    items_of = broadcast_if_small(windows.select("_wid", "_item"), SMALL)
    each = each.withColumn("_first", F.coalesce("_order", F.lit(0)) == 0)
    merged = (
        each.join(items_of, "_wid", "left")
        .groupBy("_id", "_key", "n_words", "n_hit")
        .agg(
            F.collect_set("_item").alias("items"),
            F.sum(F.col("_first").cast("int")).alias("_rows"),
            F.size(F.collect_set(F.when(F.col("_first"), F.col("_item")))).alias("_of"),
        )
    )
    # equal rows met in one group: they are given back as often as they came
    times = (F.col("_rows") / F.greatest("_of", F.lit(1))).cast("int")
    out = merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return out.select(F.col("_id").alias(id_col), "n_words", "n_hit", F.array_sort("items").alias("items"))


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """Rows of ``docs`` that hold no window of any item."""
    judged, _ = _judged(docs, items, id_col, text_col, item_col, item_text, size)
    hit = judged.filter("n_hit > 0").select("_key").distinct()
    own = docs.select(F.struct("*").alias("_row"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"))
    return own.join(hit, "_key", "left_anti").select("_row.*")


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL.format("text")} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS_SQL.format("text")} AS ws FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS p FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(list_slice(ws, p, p + 9), ' ') AS win FROM s),
dp AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS p FROM d WHERE len(ws) > 0),
dw AS (SELECT doc_id, p, n, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS win
       FROM dp, (SELECT DISTINCT n FROM w) WHERE p + n - 1 <= len(ws)),
m AS (SELECT dw.doc_id, dw.p, dw.n, w.item_id FROM dw JOIN w ON dw.win = w.win AND dw.n = w.n),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM
      (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
      (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def op7_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
