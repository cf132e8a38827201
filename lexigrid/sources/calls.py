"""Call files as tables of calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexigrid.plans.scale import with_once

# values may be strings, numbers or lists
RAW = "map<string,variant>"


def read_calls(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON arrays (``.json``) and JSON lines (``.jsonl``); a missing file is an error."""
    parts = []
    for path in paths:
        if path.endswith(".jsonl"):
            lines = spark.read.text(path)
        else:
            whole = spark.read.text(path, wholetext=True)
            items = F.from_json("value", "array<variant>")
            lines = whole.select(F.explode(items).alias("v")).select(F.to_json("v").alias("value"))
        parts.append(lines)
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return calls_of(lines.withColumn("call_id", F.monotonically_increasing_id()))


def calls_of(lines: DataFrame) -> DataFrame:
    """``call_id, value`` (one JSON object per line, blank lines skipped) to calls.

    ``kinds`` keeps what the values were, where the arrays of ``params`` do not tell: ``list`` (of
    strings), ``numbers`` (a list of numbers), ``null``, or ``json`` (an object or any other list).
    """
    filled = lines.filter(F.col("value").rlike(r"\S"))
    raw = F.from_json("value", RAW, {"mode": "FAILFAST"})
    # the second reading keeps numbers and nested values as they are written
    written = F.from_json("value", "map<string,string>")
    # each step is read at many places, and would be put into all of them
    parsed = with_once(with_once(filled.select("call_id", "value"), "raw", raw), "written", written).select("call_id", "raw", "written")
    own = F.map_filter("raw", lambda k, v: k != "call_type")
    kinds = F.transform_values(own, lambda k, v: _kind(v, F.try_element_at("written", k)))
    values = F.transform_values(own, lambda k, v: _values(v, F.try_element_at("kinds", k), F.try_element_at("written", k)))
    return with_once(with_once(parsed, "kinds", kinds), "params", values).select(
        "call_id",
        F.variant_get(F.try_element_at("raw", F.lit("call_type")), "$", "string").alias("call_type"),
        "params",
        F.map_filter("kinds", lambda k, v: v != "").alias("kinds"),
    )


def _kind(v: Column, written: Column) -> Column:
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    numbers = kind.startswith("ARRAY<BIGINT") | kind.startswith("ARRAY<DECIMAL") | kind.startswith("ARRAY<DOUBLE")
    # what a list of strings or numbers cannot hold: nulls, truth values, lists, objects, several kinds
    filled = ~F.exists(F.from_json(written, "array<string>"), lambda x: x.isNull())
    return (
        F.when(v.isNull() | (kind == "VOID"), "null")
        .when(numbers & filled, "numbers")
        .when(((kind == "ARRAY<STRING>") & filled) | written.rlike(r"^\[\s*\]$"), "list")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), "json")
        .otherwise("")
    )


def _values(v: Column, kind: Column, written: Column) -> Column:
    """A list as it is, a scalar as a list of one (none if null), true and false as words; a nested
    value is one item, its JSON text."""
    word = F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(written)).otherwise(written)
    return (
        F.when(kind == "null", F.array().cast("array<string>"))
        .when(kind.isin("list", "numbers"), F.from_json(written, "array<string>"))
        .otherwise(F.array(word))
    )
