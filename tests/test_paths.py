"""Ways over tags, relocation in several corpora, calls in folders by type."""

import random
import re
from pathlib import Path

import pytest

from lexigrid.operators import assoc as a
from lexigrid.operators import phrases as p
from lexigrid.operators import requests as r


def test_tag_paths_against_plain_walks(spark):
    rng = random.Random(7)
    docs = []
    for i in range(40):
        n = rng.randrange(0, 30)
        docs.append((i, [rng.choice("abcde") for _ in range(n)], [rng.choice(["N", "NP", "D", "J", "V", ""]) for _ in range(n)]))
    corpus = spark.createDataFrame(docs, "doc_id long, toks array<string>, tag array<string>")
    paths = {
        "object": a.TagPath("^N", "^[DJ]$", 2),
        "before": a.TagPath("^N$", "", 3, left=True),
        "near": a.TagPath("^V$", most=0),
        "far": a.TagPath("^V$", "^.*$", 40),
    }
    pairs = {name: [] for name in paths}
    for _, toks, tags in docs:
        for name, path in paths.items():
            for at in range(len(toks)):
                for k in range(1, path.most + 2):
                    to = at + k * path.sign
                    if not 0 <= to < len(toks):
                        break
                    if re.search(path.tag, tags[to]):
                        pairs[name].append((toks[at], toks[to]))
                        break
                    if not re.search(path.through, tags[to]):
                        break
    got = {(x.relation, x.collocate): (x.f, x.f_rel, x.f_slot) for x in a.word_sketch(corpus, "a", paths).collect()}
    want = {}
    for name, own in pairs.items():
        mine = [c for w, c in own if w == "a"]
        for c in set(mine):
            want[name, c] = (mine.count(c), len(mine), sum(x == c for _, x in own))
    assert got == want and len(want) > 12


def test_paths_side_by_side(spark):
    rows = [(1, ["a", "x", "b", "y"], ["V", "N", "V", "N"])]
    corpus = spark.createDataFrame(rows, "doc_id long, toks array<string>, tag array<string>")
    got = {x.collocate: (x.f1, x.f2, x.side) for x in a.sketch_diff(corpus, "a", "b", {"object": a.TagPath("^N")}).collect()}
    assert got == {"x": (1, 0, "first"), "y": (0, 1, "second")}


def test_corpora_choose_their_own_rarest_words(spark):
    one = spark.createDataFrame([(1, "the red house stands"), (2, "red red red")], "doc_id long, text string")
    two = spark.createDataFrame([("a:1", "house house"), ("1", "the red house, again the red house"), (None, "the red house")], "doc_id string, text string")
    passages = spark.createDataFrame([("p", "The red house"), ("q", "no such words"), ("r", "?!"), (None, "red house stands")], "item_id string, text string")
    got = sorted(map(tuple, p.relocate_corpora({"one": one, "two": two}, passages).collect()), key=str)
    assert got == sorted([("p", "one", "1", 0, 3), (None, "one", "1", 1, 4), ("p", "two", "1", 0, 3), ("p", "two", "1", 5, 8)], key=str)
    assert p.relocate_corpora({}, passages).count() == 0
    with pytest.raises(ValueError):
        p.relocate_corpora({"a\0b": one}, passages)


def test_calls_are_kept_by_type(spark, tmp_path):
    path = str(tmp_path / "calls")
    kind = "call_id long, call_type string, params map<string,array<string>>, kinds map<string,string>"
    rows = [(i, t, {"corpname": ["c"], "q": ["a", str(i)]}, {"q": "list"}) for i, t in enumerate(["View", "Freqs", "View", "Collx"])]
    r.write_by_type(spark.createDataFrame(rows, kind), path)
    assert sorted(x.name for x in Path(path).glob("call_type=*")) == ["call_type=Collx", "call_type=Freqs", "call_type=View"]
    before = {x: x.stat().st_mtime_ns for x in Path(path).glob("call_type=[CF]*/*.parquet")}
    r.write_by_type(spark.createDataFrame([(9, "View", {"corpname": ["d"]}, {})], kind), path)
    assert before == {x: x.stat().st_mtime_ns for x in Path(path).glob("call_type=[CF]*/*.parquet")}
    got = sorted((x.call_id, x.call_type, x.params, x.kinds) for x in r.read_by_type(spark, path).collect())
    assert got == [rows[1], rows[3], (9, "View", {"corpname": ["d"]}, {})]
    some = r.read_by_type(spark, path, ["Freqs"])
    assert [x.call_id for x in some.collect()] == [1] and "PartitionFilters: [isnotnull(call_type" in some._jdf.queryExecution().executedPlan().toString()


def test_values_are_dealt_into_lists_by_their_number(spark):
    templates = spark.createDataFrame([(i, "View", "c", f"doc.{x}", ["q", "r5"]) for i, x in enumerate("abbz")], "call_id long, call_type string, corpname string, attribute string, q array<string>")
    rows = [("c", "doc.a", f"v{i}") for i in range(25)] + [("c", "doc.b", "w")] * 3 + [("d", "doc.b", "other")]
    got = r.expand_by_values(templates, spark.createDataFrame(rows, "corpname string, attribute string, value string"), block=4).collect()
    assert sorted((x.call_id, x.value) for x in got) == sorted([(0, f"v{i}") for i in range(25)] + [(1, "w"), (2, "w")])
    assert {tuple(x.q) for x in got if x.call_id == 1} == {('q within <doc b="w" />', "r5")}


@pytest.mark.parametrize("name", ["k5_cache_split", "s2_responses_scan"])
def test_keys_are_made_once(spark, name):
    """What splits or joins keyed calls reads them kept, and does not make the keys again."""
    from lexigrid.catalog import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" in plan or "LogicalRDD" in plan
    assert "map_entries" not in plan
