"""Repair of conversations by Hirschberg's divide and conquer.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Every row is kept,
given the role that fits, or deleted, and rows without text may be inserted; the cheapest edits are
wanted, and of these the ones whose initials (D, I, K, R) come first in ASCII order. Four states say
how far the pattern has come. Costs of four states are carried forward from the start of a stretch
and backward from its end; they meet in the middle, where the cheapest crossing is taken, of several
the one whose edits so far come first, and both halves are solved the same way. So a stretch needs
one byte a row and four numbers, however long it is. That first edits can be told apart by the four
states' order alone follows from the end of each step: a step ends with its row's own edit, hence no
edits of one state begin with those of another.

Rows are sorted over the cluster by conversation, turn, role and text. A conversation inside one
partition is solved there. One that goes on in the next (two at most per partition) yields a step
per partition, the cost from each state to each other one; the same divide and conquer over these
steps gives the states at the partitions' ends, and then each part is solved by itself. Only the
digest of such a conversation runs through its text in one task, since SHA-256 has no other way.

Defined cases: a null role or text counts as one space; a null conversation id is a conversation of
its own; rows with a null turn come first and have no share in gaps; rows of one turn are taken in
order of role and text; equal rows are counted once and carried as a number; very long texts pass
unchanged; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexigrid.llm.registry import query
from lexigrid.llm.words import broadcast_if_small
from lexigrid.plans.scale import join_hot, materialized

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: what follows a state by the initial of a role
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: no edits lead there
NEVER = 1 << 60
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\f\r"
#: a row's code is its role (s, u, a or another) and one of these
CLEAN, CUT, DROP = range(3)
BLOCK_CHARS = 1 << 20

Step = tuple[list[list[int]], list[list[int]]]


def _filled(state: int) -> tuple[str, int]:
    """The role that an inserted or renamed row takes after a state, and the state after it."""
    role = "assistant" if state == USER else "user"
    return role, FOLLOWS[state, role[0]]


def _edits(initial: str, fault: int) -> list[list[tuple[int, str]]]:
    """Cheapest edits of a row from each state to each, with the insertions before it."""
    best = [[(NEVER, "~")] * 4 for _ in STATES]
    for p in STATES:
        state, before = p, ""
        for _ in range(3):  # two insertions reach every state that can be reached
            ways = [(DELETE, "D", state)]
            if fault != DROP:
                more = TRUNCATED if fault == CUT else 0
                ways.append((REROLE + more, "R", _filled(state)[1]))
                if (state, initial) in FOLLOWS:
                    ways.append((more, "K", FOLLOWS[state, initial]))
            for cost, edit, q in ways:
                best[p][q] = min(best[p][q], (cost + INSERT * len(before), before + edit))
            state, before = _filled(state)[1], before + "I"
    return best


def _ranks(edits: list[str]) -> list[int]:
    order = sorted(STATES, key=lambda q: edits[q])
    return [order.index(q) for q in STATES]


_TABLES = [_edits(initial, fault) for initial in ("s", "u", "a", "") for fault in (CLEAN, CUT, DROP)]
EDITS = [[[e for _, e in row] for row in table] for table in _TABLES]
STEPS: list[Step] = [([[c for c, _ in row] for row in table], [_ranks([e for _, e in row]) for row in table]) for table in _TABLES]
#: insertions after the last row, by state
ENDS = ["", "II", "I", ""]


def code(role: str, fault: int) -> int:
    return "sua".find(role[:1] or "-") % 4 * 3 + fault


def forward(steps: Sequence[Step], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Costs from ``start`` to each state over the steps, and the order of their edits."""
    cost, rank = [NEVER] * 4, [0, 1, 2, 3]
    cost[start] = 0
    for at in range(lo, hi):
        move, order = steps[at]
        found = [min((cost[p] + move[p][q], rank[p], order[p][q], p) for p in STATES) for q in STATES]
        cost = [min(f[0], NEVER) for f in found]
        ranked = sorted(STATES, key=lambda q: found[q][1:])
        rank = [0] * 4
        for place, q in enumerate(ranked):
            rank[q] = place
    return cost, rank


def backward(steps: Sequence[Step], lo: int, hi: int, end: int) -> list[int]:
    """Costs from each state to ``end`` over the steps."""
    cost = [NEVER] * 4
    cost[end] = 0
    for at in range(hi - 1, lo - 1, -1):
        move = steps[at][0]
        cost = [min(NEVER, *(move[p][q] + cost[q] for q in STATES)) for p in STATES]
    return cost


def crossings(steps: Sequence[Step], start: int, end: int) -> list[tuple[int, int]]:
    """States before and after each step on the cheapest way, the first of several."""
    out = [(start, end)] * len(steps)
    todo = [(0, len(steps), start, end)]
    while todo:
        lo, hi, p, q = todo.pop()
        if hi - lo < 2:
            if hi > lo:
                out[lo] = (p, q)
            continue
        mid = (lo + hi) // 2
        cost, rank = forward(steps, lo, mid, p)
        rest = backward(steps, mid, hi, q)
        at = min(STATES, key=lambda c: (cost[c] + rest[c], rank[c]))
        todo += [(lo, mid, p, at), (mid, hi, at, q)]
    return out


def finish(steps: Sequence[Step]) -> tuple[int, int]:
    """Least cost of all steps and the state they end in."""
    cost, rank = forward(steps, 0, len(steps), START)
    end = min(STATES, key=lambda q: (cost[q] + INSERT * len(ENDS[q]), rank[q]))
    return cost[end] + INSERT * len(ENDS[end]), end


def _solved(codes: bytes, start: int, end: int | None) -> tuple[int, int, list[tuple[int, int]]]:
    steps = [STEPS[c] for c in codes]
    cost = 0
    if end is None:
        cost, end = finish(steps)
    return cost, end, crossings(steps, start, end)


_solved_short = lru_cache(maxsize=1 << 16)(_solved)


def solve(codes: bytes, start: int = START, end: int | None = None) -> tuple[int, int, list[tuple[int, int]]]:
    """Cost (0 with a given end), last state and crossings; equal short conversations are solved once."""
    return (_solved_short if len(codes) <= 64 else _solved)(codes, start, end)


def repaired(codes: bytes, ways: list[tuple[int, int]], messages: Sequence[tuple[str, str] | None], tail: str) -> tuple[str, list[str]]:
    """The edits' initials and the lines ``role:text`` that remain."""
    audit, lines = [], []
    for c, (p, q), message in zip(codes, ways, messages):
        edits, state = EDITS[c][p][q], p
        audit.append(edits)
        for edit in edits:
            if edit == "D":
                continue
            role, after = _filled(state)
            if edit == "K":
                role, after = message[0], q
            lines.append(role + ":" + ("" if edit == "I" else message[1]))
            state = after
    state = ways[-1][1] if ways else START
    for _ in tail:
        role, state = _filled(state)
        lines.append(role + ":")
    return "".join(audit) + tail, lines


class Piece:
    """The rows of one conversation in one partition, in order."""

    def __init__(self, conv, keep: bool):
        self.conv = conv
        self.codes = bytearray()
        self.messages: list[tuple[str, str] | None] | None = [] if keep else None
        self.faults = [0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, row: dict) -> list[tuple[int, tuple[str, str] | None]]:
        """Take a row and its copies; returns their codes and what they may leave."""
        n, role = row["_n"], row["_role"]
        if not n:
            return []
        fault = 0 if row["_blank"] else 1 if row["_again"] else 2 if row["_cut"] else None
        copies = 0 if fault == 0 else 1
        if fault is not None:
            self.faults[fault] += 1
        self.faults[copies] += n - 1
        initial = role[:1]
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.first = initial if self.first is None else self.first
        self.last = initial
        if row["_turn"] is not None:
            self.turns += row["_turn"] != self.high
            self.low = row["_turn"] if self.low is None else self.low
            self.high = row["_turn"]
        kind = {None: CLEAN, 2: CUT}.get(fault, DROP)
        new = [(code(role, kind), None if kind == DROP else (role, row["_text"]))] + [(code(role, DROP), None)] * (n - 1)
        self.codes += bytes(c for c, _ in new)
        if self.messages is not None:
            self.messages += [m for _, m in new]
        return new

    def counts(self) -> dict:
        return {
            "blank": self.faults[0], "duplicate": self.faults[1], "truncated": self.faults[2], "illegal": self.illegal,
            "turns": self.turns, "low": self.low, "high": self.high, "first": self.first, "last": self.last,
        }

    def summary(self) -> dict:
        """The counts, and the piece as one step: costs between the states and the order of the edits."""
        move, order = [], []
        steps = [STEPS[c] for c in self.codes]
        for p in STATES:
            cost, rank = forward(steps, 0, len(steps), p)
            move += cost
            order += rank
        return {**self.counts(), "move": move, "order": order}


def totals(pieces: list[dict]) -> dict:
    """Counts of a conversation from the summaries of its pieces, in order."""
    out = {k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated", "illegal")}
    low = high = last = None
    turns = 0
    for p in pieces:
        if p["first"] is not None:
            out["illegal"] += last is not None and last + p["first"] not in LEGAL
            last = p["last"]
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"]
    out["gaps"] = 0 if low is None else high - low + 1 - turns
    return out


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
#: rows that the first pass gives: results, and rows and summaries of pieces
RESULT, MESSAGE, SUMMARY = range(3)
PASSED = (
    f"_kind int, _piece long, _conv KIND, {COUNTS}, audit string, repaired_sha256 string, repaired string, _code int, _role string, _text string, "
    "turns long, low long, high long, first string, last string, move array<long>, `order` array<int>"
)
PARTS = f"_own long, _piece long, _block long, _conv KIND, {COUNTS}, audit string, _body string"
RESULTS = f"_conv KIND, {COUNTS}, audit string, repaired_sha256 string, repaired string"


def _arrow(ddl: str, conv: pa.DataType) -> pa.Schema:
    """Arrow types of the simple DDL above."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "KIND": conv}
    return pa.schema([(name.strip("`"), kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _batches(rows: Iterator[dict], schema: pa.Schema, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded text."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 100 + sum(len(v) for v in row.values() if isinstance(v, str))
        if size > chars:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n``: rows dropped, emptied, cut, repeated or given to the user by
    a checksum of their id and turn. A dropped row stays as its conversation's id with ``n`` 0."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", blank)
    kept = kind != 0
    return rows.select(
        "conv_id",
        F.when(kept, F.col("turn")).alias("turn"),
        F.when(kept, F.when(kind == 4, "user").otherwise(F.coalesce("role", blank))).alias("role"),
        F.when(kept, F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)).alias("text"),
        F.when(kept, F.when(kind == 3, 2).otherwise(1)).otherwise(0).cast("long").alias("n"),
    )


def repair(rows: DataFrame, times: str | None = None, texts: bool = False) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text``: the counts of gaps in turns, of
    faults and of illegal neighbours, the cost and the initials of the edits, and the SHA-256 of the
    repaired lines ``role:text``. The column ``times`` says how often a row stands there; 0 only
    names its conversation. With ``texts`` also the lines themselves, as ``repaired``; then a
    conversation must fit into a row."""
    n = F.col(times) if times else F.lit(1)
    given = rows.select(
        F.col("conv_id").alias("_conv"),
        F.col("turn").cast("long").alias("_turn"),
        F.when(n > 0, F.coalesce("role", F.lit(" "))).alias("_role"),
        F.when(n > 0, F.coalesce("text", F.lit(" "))).alias("_text"),
        n.cast("long").alias("_n"),
    )
    kind = given.schema["_conv"].dataType.simpleString()
    end = F.right(F.rtrim("_text", F.lit(SPACES)), F.lit(1))
    conv = F.col("_conv").cast("string")
    key = F.sha2(F.concat_ws(":", F.coalesce(F.length(conv), F.lit(-1)).cast("string"), F.length("_role").cast("string"), conv, "_role", "_text"), 256)
    # keys that stand at several turns, with their first one; nulls are smaller than any number
    seen = given.filter((F.col("_n") > 0) & (end != "")).groupBy(key.alias("_key")).agg(
        F.min(F.struct("_turn")).alias("_first"), F.max(F.struct("_turn")).alias("_last")
    )
    firsts = materialized(seen.filter("_first != _last").select("_key", F.col("_first._turn").alias("_first"), F.lit(True).alias("_several")))
    counted = given.groupBy("_conv", "_turn", "_role", "_text").agg(F.sum("_n").alias("_n")).withColumn("_key", key)
    small = broadcast_if_small(firsts, 200_000)  # of two numbers and a digest
    flagged = counted.join(small, "_key", "left") if small is not firsts else join_hot(counted, firsts, "_key")
    order = ["_conv", "_turn", "_role", "_text"]
    sorted_rows = (
        flagged.select(
            *order, "_n", (end == "").alias("_blank"), (~end.isin(".", "!", "?")).alias("_cut"),
            (F.coalesce("_several", F.lit(False)) & ~F.col("_first").eqNullSafe(F.col("_turn"))).alias("_again"),
        )
        # the sample of the keys goes to the driver, so they are short; equal starts stay together
        .repartitionByRange("_conv", "_turn", F.left("_role", F.lit(20)), F.left("_text", F.lit(80)))
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )

    def first_pass(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = _arrow(PASSED, head.schema.field("_conv").type)

        def chain():
            yield head
            yield from batches

        def closed(piece: Piece) -> dict:
            cost, end, ways = solve(bytes(piece.codes))
            audit, lines = repaired(piece.codes, ways, piece.messages, ENDS[end])
            out = {"_kind": RESULT, "_conv": piece.conv, **totals([piece.counts()]), "cost": cost, "audit": audit, "repaired_sha256": _sha(lines)}
            return {**out, "repaired": "\n".join(lines)} if texts else out

        def message(number: int, conv, item) -> dict:
            role, text = item[1] or (None, None)
            return {"_kind": MESSAGE, "_piece": number, "_conv": conv, "_code": item[0], "_role": role, "_text": text}

        def run():
            piece, number = None, 0
            for row in _dicts(chain()):
                if piece is None or row["_conv"] != piece.conv:
                    if piece is not None:
                        yield {"_kind": SUMMARY, "_piece": number, "_conv": piece.conv, **piece.summary()} if piece.messages is None else closed(piece)
                    # the first conversation may have begun in an earlier partition; its rows pass through
                    piece, number = Piece(row["_conv"], piece is not None), 2 * row["_part"] + (piece is not None)
                new = piece.add(row)
                if piece.messages is None:
                    for item in new:
                        yield message(number, piece.conv, item)
            for item in zip(piece.codes, piece.messages or ()):
                yield message(number, piece.conv, item)
            yield {"_kind": SUMMARY, "_piece": number, "_conv": piece.conv, **piece.summary()}

        yield from _batches(run(), schema)

    passed = materialized(sorted_rows.mapInArrow(first_pass, PASSED.replace("KIND", kind)))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", *(["repaired"] if texts else [])]

    def meet(table: pa.Table) -> pa.Table:
        pieces = sorted(table.to_pylist(), key=lambda p: p["_piece"])
        steps = [([p["move"][4 * s : 4 * s + 4] for s in STATES], [p["order"][4 * s : 4 * s + 4] for s in STATES]) for p in pieces]
        cost, end = finish(steps)
        whole = {**totals(pieces), "cost": cost}
        out = [
            {"_piece": p["_piece"], "_own": pieces[0]["_piece"], "_from": way[0], "_to": way[1], "_end": p is pieces[-1], **whole}
            for p, way in zip(pieces, crossings(steps, START, end))
        ]
        return pa.Table.from_pylist(out, schema=_arrow(f"_piece long, _own long, _from int, _to int, {COUNTS}", pa.int64()).append(pa.field("_end", pa.bool_())))

    # two pieces per partition at most, and one number per partition in a group
    met = passed.filter(F.col("_kind") == SUMMARY).select("_piece", "_conv", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last", "move", "order")
    ways = met.groupBy("_conv").applyInArrow(meet, f"_piece long, _own long, _from int, _to int, {COUNTS}, _end boolean")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    open_rows = passed.filter(F.col("_kind") != RESULT).select("_kind", "_piece", "_conv", "_code", "_role", "_text")

    def second_pass(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = _arrow(PARTS, head.schema.field("_conv").type)

        def chain():
            yield head
            yield from batches

        def run():
            codes, messages = bytearray(), []
            for row in _dicts(chain()):
                if row["_kind"] == MESSAGE:
                    codes.append(row["_code"])
                    messages.append((row["_role"], row["_text"]))
                    continue
                _, _, way = solve(bytes(codes), row["_from"], row["_to"])
                tail = ENDS[row["_to"]] if row["_end"] else ""
                # an empty piece changes no state, but the last one still has to close the pattern
                audit, lines = repaired(codes, way or [(row["_from"], row["_to"])], messages, tail)
                out = {k: row[k] for k in ("_own", "_piece", "_conv", *counts)}
                block, size, number = [], 0, 0
                for line in lines:
                    block.append(line)
                    size += len(line)
                    if size > BLOCK_CHARS:
                        yield {**out, "_block": number, "audit": "", "_body": "\n".join(block)}
                        block, size, number = [], 0, number + 1
                yield {**out, "_block": number, "audit": audit, "_body": "\n".join(block) if block else None}
                codes, messages = bytearray(), []

        yield from _batches(run(), schema)

    def fold(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = _arrow(RESULTS, head.schema.field("_conv").type)

        def chain():
            yield head
            yield from batches

        def run():
            now, digest, audit, body, empty = None, None, [], [], True
            for row in _dicts(chain()):
                if now is None or row["_own"] != now["_own"]:
                    if now is not None:
                        yield ended(now, digest, audit, body)
                    now, digest, audit, body, empty = row, hashlib.sha256(), [], [], True
                audit.append(row["audit"])
                if row["_body"] is not None:
                    digest.update((("" if empty else "\n") + row["_body"]).encode())
                    empty = False
                    if texts:
                        body.append(row["_body"])
            if now is not None:
                yield ended(now, digest, audit, body)

        def ended(row, digest, audit, body) -> dict:
            out = {"_conv": row["_conv"], **{k: row[k] for k in counts}, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            return {**out, "repaired": "\n".join(body)} if texts else out

        yield from _batches(run(), schema)

    parts_of = open_rows.join(F.broadcast(ways), "_piece").mapInArrow(second_pass, PARTS.replace("KIND", kind))
    folded = parts_of.repartition("_own").sortWithinPartitions("_own", "_piece", "_block").mapInArrow(fold, RESULTS.replace("KIND", kind))
    result = passed.filter(F.col("_kind") == RESULT).select("_conv", *names).unionByName(folded.select("_conv", *names))
    return result.withColumnRenamed("_conv", "conv_id")


@query("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir):
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), times="n")
