"""License scan by diagonal voting.

Every run of ``k`` words of every document is joined with the positions at which license
templates hold that run. A match votes for the diagonal ``document position - template
position``; votes are added per document, template and diagonal, neighbouring diagonals
(a word more or less) are merged, and each merged span is verified on the words themselves.

Short phrases vote with pairs of words and must stand word for word. Notices must keep ``min_cover``
of their words in order, on the stretch that the diagonal gives to the whole wording; they vote with
the longest runs (up to four words) of which one is left however the other words are replaced.

Defined cases: a null text counts as empty; a row is known by its id and text together, so
repeated rows give repeated results and null ids are kept; a document without a match has
null word positions, empty labels and score 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexigrid.llm.bytetext import U64, Texts, each_slice, grams, hash_bytes, lists, slices, span_hash, prefix_hash
from lexigrid.llm.registry import query

#: phrases to be found word for word (fixed values)
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
#: wordings of common notices
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
]
SHORT, LONG = 2, 4


def run_length(n: int, min_cover: float) -> int:
    """Words of the run that a notice of ``n`` words keeps wherever those it may lose stand."""
    need = max(1, ceil(n * min_cover - 1e-9))
    return min(LONG, ceil(need / (n - need + 1)))


def template_positions(phrases=None, notices=None, min_cover: float = 0.8) -> list[tuple[int, int, int, int]]:
    """(hash, template number, template position, k) of each run of words of the templates."""
    rows = []
    for number, (text, k) in enumerate(_templates(phrases, notices, min_cover)):
        hashes = np.array([hash_bytes(w.encode()) for w in text.split()], U64)
        rows += [(int(h), number, i, k) for i, h in enumerate(grams(hashes, k).astype(np.int64))]
    return rows


def _templates(phrases, notices, min_cover: float = 0.8) -> list[tuple[str, int]]:
    return [(t, SHORT) for _, t in phrases or PHRASES] + [(t, run_length(len(t.split()), min_cover)) for _, t in notices or NOTICES]


def _runs(part: pa.RecordBatch, texts: Texts, lengths: list[int]) -> pa.RecordBatch:
    """Per text all runs of the first length, then those of the next ones, and where each begin."""
    low = texts.lowered()
    starts, ends, first = low.words()
    hashes = span_hash(prefix_hash(low.data), starts, ends)
    n = np.diff(first)
    sizes = [np.maximum(n - k + 1, 0) for k in lengths]
    bounds = np.concatenate([[0], np.cumsum(sum(sizes))])
    out = np.empty(bounds[-1], U64)
    offset = np.zeros(len(n), np.int64)
    begin = []
    for k, size in zip(lengths, sizes):
        begin.append(offset.copy())
        g = grams(hashes, k)
        text = np.repeat(np.arange(len(n)), size)
        within = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        out[bounds[text] + offset[text] + within] = g[first[text] + within]
        offset += size
    begun = lists(np.column_stack(begin).ravel(), np.arange(len(n) + 1) * len(lengths), pa.int64())
    return pa.RecordBatch.from_arrays([part.column(0), begun, lists(out.view(np.int64), bounds, pa.int64())], ["_key", "_begin", "_runs"])


def _spans(rows: DataFrame, phrases, notices, slack: int, min_cover: float) -> DataFrame:
    """Per row key the merged spans of each template."""
    spark = rows.sparkSession
    positions = template_positions(phrases, notices, min_cover)
    lengths = sorted({k for *_, k in positions})
    table = spark.createDataFrame(
        [(run, t, at, k, lengths.index(k)) for run, t, at, k in positions], "_run long, _template int, _at int, _k int, _slot int"
    )
    runs = rows.select("_key", "_text").mapInArrow(
        each_slice(lambda part, texts: _runs(part, texts, lengths), "_text"), "_key long, _begin array<long>, _runs array<long>"
    )
    each = runs.select("_key", "_begin", F.posexplode("_runs").alias("_pos", "_run"))
    # the templates are a fixed list in this file (or the caller's), some hundred positions
    hits = each.join(F.broadcast(table), "_run").withColumn("_pos", F.col("_pos") - F.get("_begin", F.col("_slot")))
    # the same words hashed as a run of another length do not count
    hits = hits.filter(
        (F.col("_pos") >= 0) & (F.col("_pos") < F.coalesce(F.get("_begin", F.col("_slot") + 1), F.lit(1 << 62)) - F.get("_begin", F.col("_slot")))
    ).select("_key", "_template", "_k", "_pos", "_at")
    diagonals = (
        hits.groupBy("_key", "_template", (F.col("_pos") - F.col("_at")).alias("_diagonal"))
        .agg(F.count("*").alias("_votes"), F.min("_pos").alias("_from"), F.max(F.col("_pos") + F.col("_k")).alias("_to"))
    )
    along = Window.partitionBy("_key", "_template").orderBy("_diagonal")
    apart = (F.col("_diagonal") - F.lag("_diagonal").over(along) > slack).cast("int")
    merged = (
        diagonals.withColumn("_apart", F.coalesce(apart, F.lit(0)))
        .withColumn("_group", F.sum("_apart").over(along))
        .groupBy("_key", "_template", "_group")
        .agg(
            F.min("_from").alias("start"), F.max("_to").alias("end"), F.min("_diagonal").alias("low"), F.max("_diagonal").alias("high")
        )
    )
    return merged.groupBy("_key").agg(
        F.collect_list(F.struct(F.col("_template").alias("template"), "start", "end", "low", "high")).alias("_spans")
    )


def _kept_words(want: list[bytes], have: list[bytes]) -> int:
    """Longest common subsequence of two lists of words."""
    row = [0] * (len(want) + 1)
    for word in have:
        last = 0
        for i, w in enumerate(want, 1):
            last, row[i] = row[i], last + 1 if w == word else max(row[i], row[i - 1])
    return row[-1]


def _apart(found: list[dict]) -> list[dict]:
    """Of notices of one wording that overlap, the one that keeps most; by place."""
    out: list[dict] = []
    for f in sorted(found, key=lambda f: (-f["cover"], f["start"], f["end"])):
        if all(f["end"] <= o["start"] or o["end"] <= f["start"] for o in out):
            out.append(f)
    return sorted(out, key=lambda f: f["start"])


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] | None = None,
    notices: list[tuple[str, str]] | None = None,
    min_cover: float = 0.8,
    slack: int = 2,
) -> DataFrame:
    """One row per document: ``id``, ``n_words``, and ``found``: verified spans with the
    label, whether it is a phrase, first word, end word and the share of the wording kept."""
    base = phrases or PHRASES
    labels = [name for name, _ in base] + [name for name, _ in notices or NOTICES]
    wordings = [t.encode().split() for t, _ in _templates(phrases, notices)]
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn(
        "_key", F.xxhash64("_id", "_text")
    )
    spans = _spans(rows, phrases, notices, slack, min_cover)
    kind = rows.schema["_id"].dataType.simpleString()
    found_type = "array<struct<label:string,phrase:boolean,start:long,end:long,cover:double>>"

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow_found = pa.list_(
            pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
        )
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                low = texts.lowered()
                starts, ends, first = low.words()
                out = []
                for i, listed in enumerate(part.column(2).to_pylist()):
                    rows_out = []
                    if listed:
                        lo, n = first[i], first[i + 1] - first[i]
                        data = low.data
                        words = [data[s:e].tobytes() for s, e in zip(starts[lo : lo + n], ends[lo : lo + n])]
                        places, kept = set(), {}
                        for span in listed:
                            t = span["template"]
                            want, label = wordings[t], labels[t]
                            a, b = span["start"], min(span["end"], n)
                            if t < len(base):
                                for p in range(a, b - len(want) + 1):
                                    if words[p : p + len(want)] == want:
                                        places.add((p, p + len(want), t))
                            else:
                                # the whole wording as the diagonals place it
                                a, b = max(0, span["low"]), min(span["high"] + len(want), n)
                                have = words[max(0, a - slack) : b + slack]
                                # words out of order bound those in order
                                if (Counter(want) & Counter(have)).total() < min_cover * len(want) - 1e-9:
                                    continue
                                cover = _kept_words(want, have) / len(want)
                                if cover >= min_cover - 1e-9:
                                    kept.setdefault(t, []).append({"label": label, "phrase": False, "start": a, "end": b, "cover": min(cover, 1.0)})
                        for t in sorted(kept):
                            rows_out += _apart(kept[t])
                        rows_out += [
                            {"label": labels[t], "phrase": True, "start": p, "end": e, "cover": 1.0} for p, e, t in sorted(places)
                        ]
                    out.append(rows_out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first), pa.int64()), pa.array(out, arrow_found)],
                    ["_id", "n_words", "found"],
                )

    joined = rows.join(spans, "_key", "left").select("_id", "_text", "_spans")
    done = joined.mapInArrow(verify, f"_id {kind}, n_words long, found {found_type}")
    return done.select(F.col("_id").alias(id_col), "n_words", "found")


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    scanned = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    phrases = F.filter("found", lambda f: f["phrase"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda f: f["label"]))), ",")
    return scanned.withColumn("_phrases", phrases).select(
        "doc_id",
        "n_words",
        F.size("_phrases").cast("long").alias("n_base"),
        F.array_min(F.transform("_phrases", lambda f: f["start"])).alias("first_word"),
        F.array_max(F.transform("_phrases", lambda f: f["start"])).alias("last_word"),
        joined(F.col("_phrases")).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["cover"])), F.lit(0.0)).alias("score"),
    )
