"""Secret scan with password guess costs.

Three fixed patterns are found in every text (:data:`ASSIGN`, access keys, hex strings). Beyond
these, values in a credential context (a word such as ``pwd`` or ``passphrase`` with ``=`` or
``:``) are measured by how many guesses an attacker would need: the cheapest segmentation into
dictionary words, dates, repeats, keyboard walks and brute-force characters, found by dynamic
programming. Values at or above ``min_guesses`` (a power of ten) are spans of kind ``guess``.

Spans are counted in code points, end exclusive. Defined cases: a null text counts as empty;
rows are independent, so repeated rows give repeated results; an empty table gives no rows;
values of any length are measured whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.bytetext import Texts, each_slice
from lexigrid.llm.registry import query

KINDS = ("assign", "access", "hex", "guess")
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
CONTEXT = re.compile(
    rb"""(password|passwd|passphrase|passcode|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth)["']?\x20*[:=]\x20*["']?([!-&(-~]+)""",
    re.I,
)
CONTEXT_WORDS = (b"passw", b"passp", b"passc", b"pwd", b"secret", b"token", b"credential", b"key", b"auth")

KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?[01]\d[-/.]?[0-3]\d|[0-3]\d[-/.]?[01]\d[-/.]?(?:19|20)\d\d|(?:19|20)\d\d)")
LONGEST_WORD = 24
_ranks: dict[str, dict[str, int]] = {}


def word_ranks(path: str) -> dict[str, int]:
    """Whole words of a tokenizer's vocabulary with their rank: the rarer, the more guesses."""
    if path not in _ranks:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        words = {}
        for piece, number in vocabulary.items():
            if piece.endswith("</w>") and len(piece) >= 7 and piece[:-4].isalpha():
                words[piece[:-4]] = number + 1
        _ranks[path] = words
    return _ranks[path]


def _beside() -> set[tuple[str, str]]:
    pairs = set()
    for row in KEY_ROWS:
        pairs |= set(zip(row, row[1:])) | set(zip(row[1:], row))
    for upper, lower in zip(KEY_ROWS, KEY_ROWS[1:]):
        pairs |= set(zip(upper, lower)) | set(zip(lower, upper))
    return pairs


BESIDE = _beside()


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Power of ten of the guesses that the cheapest segmentation needs.

    Each further segment costs a factor: its own guesses. A brute-force character costs the
    size of its class; words cost their rank (twice that with capitals), dates the days of two
    centuries, repeats and walks their start times their length.
    """
    n, low = len(value), value.lower()
    best = [0.0] + [math.inf] * n
    same, walk = [1] * n, [1] * n
    for i in range(n - 2, -1, -1):
        same[i] = same[i + 1] + 1 if value[i] == value[i + 1] else 1
        walk[i] = walk[i + 1] + 1 if (low[i], low[i + 1]) in BESIDE else 1
    for i in range(n):
        here, char = best[i], value[i]
        single = math.log10(10 if char.isdigit() else 26 if char.isalpha() else 33)
        best[i + 1] = min(best[i + 1], here + single)
        for run, start in ((same[i], single), (walk[i], math.log10(47))):
            if run >= 3:
                best[i + run] = min(best[i + run], here + start + math.log10(run))
        if char.isdigit() and (date := DATE.match(value, i)):
            days = math.log10(73_000 if date.end() - i > 4 else 200)
            best[date.end()] = min(best[date.end()], here + days)
        if char.isalpha():
            for end in range(i + 3, min(n, i + LONGEST_WORD) + 1):
                rank = ranks.get(low[i:end])
                if rank is not None:
                    plain = value[i:end] == low[i:end]
                    best[end] = min(best[end], here + math.log10(rank * (1 if plain else 2)))
    return best[n]


def _places(text: bytes, words: tuple[bytes, ...]) -> list[int]:
    found = set()
    for word in words:
        at = text.find(word)
        while at >= 0:
            found.add(at)
            at = text.find(word, at + 1)
    return sorted(found)


def _leftmost(pattern: re.Pattern, text: bytes, places: list[int]):
    """Leftmost non-overlapping matches of a pattern that can only start at ``places``."""
    end = 0
    for at in places:
        if at >= end and (found := pattern.match(text, at)):
            yield found
            end = max(found.end(), at + 1)


def _hex_runs(texts: Texts, least: int) -> tuple[np.ndarray, np.ndarray]:
    data = texts.data
    starts, ends = texts.runs(((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102)))
    long = ends - starts >= least
    return starts[long], ends[long]


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_guesses: float = 10.0,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row per document: ``id`` and ``found``: kind, start, end and guesses of each span.

    The vocabulary is read once on the driver and sent with the task; it holds some ten
    thousand words.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(vocabulary))
    kind = docs.schema[id_col].dataType.simpleString()
    arrow_found = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())])
    )

    def scan(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        low = texts.lowered()
        everything = low.data.tobytes()
        raw = texts.data.tobytes()
        points = None
        spans: dict[int, list[tuple[int, int, str, float | None]]] = {}
        for s, e in zip(*_hex_runs(texts, 24)):
            spans.setdefault(int(texts.owner(s)), []).append((int(s), int(e), "hex", None))
        marked = {int(texts.owner(p)) for p in _places(everything, CONTEXT_WORDS) + _places(raw, (b"AKIA",))}
        for i in marked:
            base, text, lowered = int(texts.offsets[i]), texts.text(i), low.text(i)
            own = spans.setdefault(i, [])
            for m in _leftmost(ASSIGN, text, _places(lowered, ASSIGN_WORDS)):
                if len(m[2]) >= 6:
                    own.append((base + m.start(), base + m.end(), "assign", None))
            for m in ACCESS.finditer(text):
                if m.end() - m.start() >= 20:
                    own.append((base + m.start(), base + m.end(), "access", None))
            for m in CONTEXT.finditer(text):
                value = m[2].rstrip(b"\"',;.)")
                cost = guess_cost(value.decode("ascii"), ranks.value)
                if len(value) >= 6 and cost >= min_guesses:
                    own.append((base + m.start(2), base + m.start(2) + len(value), "guess", cost))
        if spans:
            points = texts.code_points()
        for i, own in spans.items():
            zero = points[texts.offsets[i]]
            out[i] = [
                {"kind": k, "start": int(points[s] - zero), "end": int(points[e] - zero), "guesses": g}
                for s, e, k, g in sorted(own, key=lambda x: (x[0], KINDS.index(x[2])))
            ]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(out, arrow_found)], ["_id", "found"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"_id {kind}, found array<struct<kind:string,start:long,end:long,guesses:double>>"
    return rows.mapInArrow(each_slice(scan, "_text"), schema).withColumnRenamed("_id", id_col)


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    found = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(told(F.filter("found", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda s: s["guesses"])).alias("most_guesses"),
    )
