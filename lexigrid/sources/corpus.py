"""Text tables as corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigrid.functions.text import tokenize, tokenize_lower

# Per table: id column, text-type columns.
TABLES = {
    "documents": ("doc_id", ["lang", "source"]),
    "benchmark": ("item_id", []),
    "conversations": (None, ["role"]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows to as many parts as the session's ``lexigrid.parts`` says.

    For small tables in fewer splits than there are cores. Where it is unset, as it should be for
    large tables, they are read as they lie.
    """
    parts = df.sparkSession.conf.get("lexigrid.parts", None)
    return df if parts is None else df.repartition(int(parts), key)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Deal narrow rows evenly to as many parts as :func:`spread` does, or else as the session's
    shuffles have.

    For work that costs far more than moving a row: a file may hold millions of short rows in one split.
    """
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get("lexigrid.parts", None) or conf.get("spark.sql.shuffle.partitions")), key)


def load_corpus(
    spark: SparkSession,
    sf_dir: str,
    table: str = "documents",
    text_types: list[str] | None = None,
    labels: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, the text types, ``text``.

    Conversation turns are documents too; their id is ``conversation:turn``.
    ``labels`` adds the text types ``quality`` and ``toxic``.
    """
    key, types = TABLES[table]
    types = types if text_types is None else text_types
    df = spread(read_table(spark, sf_dir, table), key or "conv_id")
    doc_id = F.col(key) if key else F.concat_ws(":", "conv_id", "turn")
    corpus = df.select(doc_id.alias("doc_id"), *types, "text")
    if labels:
        # one label row per document, so no key is hot; the planner picks the join
        corpus = corpus.join(read_table(spark, sf_dir, "labels"), "doc_id", "left")
    return corpus


def with_tokens(corpus: DataFrame, word: bool = False, lc: bool = True) -> DataFrame:
    """Add the token arrays: ``toks`` (lower case) and, on request, ``word``."""
    if lc:
        corpus = corpus.withColumn("toks", tokenize_lower(F.col("text")))
    if word:
        corpus = corpus.withColumn("word", tokenize(F.col("text")))
    return corpus


def containing(corpus: DataFrame, *terms: str) -> DataFrame:
    """Documents whose text can hold all the lower-case terms.

    A cheap test on the raw text that lets most documents skip tokenization.
    """
    for term in terms:
        corpus = corpus.filter(F.contains(F.lower("text"), F.lit(term.lower())))
    return corpus
