"""No registered query may plan a join that compares all rows with all rows."""

import pytest

from lexigrid.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_all_pairs_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, arrays",
    [("c1_token_match", 1), ("c13_kwic", 2), ("f7_wordlist", 1), ("a1_colloc_counts", 1), ("p1_positions", 2)],
)
def test_tokenizes_once(spark, name, arrays):
    """Each token array (lower-case, and ``word`` where it is asked for) is made once."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # lower-casing has two branches: one for the odd letter, and the usual one
    assert plan.count("regexp_extract_all") == arrays + 1


def test_text_type_filter_reaches_the_scan(spark):
    plan = QUERIES["c7_within"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src7)" in plan.split("PushedFilters")[1].split("]")[0]


@pytest.mark.parametrize("name", ["c8_id_lookup", "c10_page", "c10_all_pages", "c17_all_pages", "c19_export_hits", "p5_refs", "r10_refs_table"])
def test_no_token_array_is_moved(spark, name):
    """Shuffles and broadcasts of these carry numbers, hits and cut lines only."""
    tree = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan()

    def exchanges(node):
        if "Exchange" in node.nodeName():
            yield node
        children = node.children()
        inner = [children.apply(i) for i in range(children.size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            inner = [node.initialPlan()]
        for child in inner:
            yield from exchanges(child)

    moved = set()
    for node in exchanges(tree):
        output = node.output()
        moved |= {output.apply(i).name() for i in range(output.size())}
    assert moved
    allowed = {"text"} if name == "c8_id_lookup" else set()
    assert not moved & ({"toks", "word", "text", "hits", "sents"} - allowed)


def test_calls_are_parsed_once(spark):
    """Parsed calls, their kinds and their values are read at many places, but computed at one."""
    plan = QUERIES["s3_calls_scan"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapType(StringType,VariantType") == 1
    assert plan.count("from_json(MapType(StringType,StringType") <= 1
