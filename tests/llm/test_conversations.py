"""Conversation repair against plain Python: all edits of short rows, a table of best edits of long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from lexigrid.llm import conversations
from lexigrid.llm.queries import LLM_QUERIES
from tests.llm.helpers import SF

FORM = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        rest = text.strip(SPACE)
        out.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def best_edits(rows, faults):
    """Least (cost, audit, lines) of each state, row by row."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    fill = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserted(table):
        for _ in range(2):
            for s, (cost, audit, lines) in list(table.items()):
                way = (cost + 2, audit + "I", lines + [fill[s] + ":"])
                t = fill[s][0]
                if t not in table or way[:2] < table[t][:2]:
                    table[t] = way
        return table

    table = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for s, (cost, audit, lines) in inserted(table).items():
            more = fault == "truncated"
            ways = [(s, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                ways.append((fill[s][0], 2 + more, "R", [f"{fill[s]}:{text}"]))
                if role[:1] in after[s]:
                    ways.append((role[:1], more, "K", [f"{role}:{text}"]))
            for t, c, edit, line in ways:
                way = (cost + c, audit + edit, lines + line)
                if t not in new or way[:2] < new[t][:2]:
                    new[t] = way
        table = new
    return min(inserted(table)[s] for s in ("", "a") if s in inserted(table))


def plain(rows):
    """All results for rows (conv, turn, role, text), which may be damaged already."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of(own)
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, lines = best_edits(own, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def expected(rows):
    return {**{r[0]: NOTHING for r in rows}, **plain(damage(rows))}


KIND = "conv_id long, turn long, role string, text string"


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(LLM_QUERIES["op11_conversation_repair"](spark, SF)) == expected(rows)


def all_ways(initials, faults):
    """The cheapest edits among all, by trying them."""
    best = None
    choices = [("D",) if f in ("blank", "duplicate") else ("D", "K", "Ru", "Ra") for f in faults]
    gaps = [[g for n in range(3) for g in itertools.product("ua", repeat=n)] for _ in range(len(initials) + 1)]
    for edits in itertools.product(*choices):
        for filled in itertools.product(*gaps):
            roles, audit, cost = "", "", 0
            for edit, initial, fault, before in zip(edits, initials, faults, filled):
                roles += "".join(before) + {"D": "", "K": initial or "-"}.get(edit, edit[1:])
                audit += "I" * len(before) + edit[0]
                cost += 2 * len(before) + {"D": 3, "K": 0}.get(edit, 2) + (fault == "truncated" and edit != "D")
            roles, audit, cost = roles + "".join(filled[-1]), audit + "I" * len(filled[-1]), cost + 2 * len(filled[-1])
            if FORM.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_solve_against_all_edits(n):
    rng = random.Random(n)
    cases = itertools.product(itertools.product(["s", "u", "a", "x", ""], [None, "truncated", "blank"]), repeat=n)
    cases = list(cases)
    for case in cases if n < 3 else rng.sample(cases, 60):
        initials, faults = [c[0] for c in case], [c[1] for c in case]
        codes = bytes(conversations.code(i, {None: 0, "truncated": 1, "blank": 2}[f]) for i, f in case)
        cost, end, ways = conversations.solve(codes)
        audit, lines = conversations.repaired(codes, ways, [(i, "") for i in initials], conversations.ENDS[end])
        assert (cost, audit) == all_ways(initials, faults)
        assert FORM.fullmatch("".join(line[0] for line in lines))


def random_rows(rng, conv, n):
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "No!", "Is it", "", " \n", None, *(f"Text {i}{'.' * (i % 3 > 0)}\t" for i in range(n))]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def test_defined_cases(spark):
    rng = random.Random(5)
    rows = [r for conv in [None, *range(120)] for r in random_rows(rng, conv, rng.randrange(1, 25))]
    rows += rows[:40] + [(500, 1, "user", "x" * 300_000), (501, None, None, None), (502, None, "user", "Hi.")]
    clash = ", n long, _conv string, _n int, cost string"
    df = spark.createDataFrame([(*r, 7, "c", 0, "d") for r in rows], KIND + clash)
    assert collected(conversations.repair(conversations.damaged(df).repartition(3), times="n")) == expected(rows)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert collected(conversations.repair(df)) == plain(clean)
    none = spark.createDataFrame([], KIND)
    assert conversations.repair(none).count() == 0 and conversations.repair(conversations.damaged(none), times="n").count() == 0


def test_texts_of_ids_of_any_type(spark):
    df = spark.createDataFrame([("a", 2, "user", "Hi."), ("a", 1, "system", "Be."), ("b", 1, "assistant", "Oh.")], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: (r.audit, r.repaired) for r in conversations.repair(df, texts=True).collect()}
    # deleting costs 3 and inserting the question 2
    assert got == {"a": ("KKI", "system:Be.\nuser:Hi.\nassistant:"), "b": ("IK", "user:\nassistant:Oh.")}


def test_conversation_over_many_partitions(spark):
    """One conversation holds most rows, with equal rows, ties in turn and null turns among them."""
    rng = random.Random(6)
    rows = random_rows(rng, 3, 900) + [(3, None, "user", f"Null {i}") for i in range(100)] + [(3, 7, "user", "Same.")] * 200
    rows += [r for conv in (1, 2, 4, 5) for r in random_rows(rng, conv, 6)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = conversations.repair(conversations.damaged(df), times="n")
        assert collected(got) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
