"""Nested JSON values against a plain recursive version."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lexigrid.functions.nested import nested_json, number_text
from lexigrid.operators.requests import normalize_calls, with_canonical, with_key
from lexigrid.sources.calls import calls_of


def plain(value):
    if isinstance(value, str):
        return value.strip()
    if isinstance(value, list):
        return sorted(map(plain, value))
    if isinstance(value, dict):
        return {k.strip(): plain(v) for k, v in value.items()}
    return value


def random_value(rng, depth, kind=None):
    """Lists hold one kind of value, so that they can be ordered."""
    kind = kind or rng.choice(["s", "s", "n", "l", "d"] if depth else ["s", "n"])
    if kind == "s":
        return rng.choice(["", " ", "a", " a", "ab", "b\n", "é ", "\U0001f642", 'q"\\', "\u2028x", "\x01", "10", "9", "long " * 30])
    if kind == "n":
        return rng.choice([0, 1, -1, 7, 10, 123456789012, True, False, 0.5, -2.25, 1e-5, 1.5e300, 12345678.5, 0.00012, 1e16, 3e15])
    if kind == "l":
        inner = rng.choice(["s", "n"])
        if depth > 1 and rng.random() < 0.4:
            return [[random_value(rng, 0, inner) for _ in range(rng.randrange(3))] for _ in range(rng.randrange(4))]
        return [random_value(rng, 0, inner) for _ in range(rng.randrange(5))]
    return {rng.choice(["a", " b ", "c", "é", '"', "\t"]) + str(i): random_value(rng, depth - 1) for i in range(rng.randrange(4))}


def test_against_plain_recursion(spark):
    rng = random.Random(1)
    values = [random_value(rng, 4, "d") for _ in range(400)] + [{}, [], [[], [[]]], {"a": [{"b": 1}]}, None, "x ", 3]
    texts = [(json.dumps(v, ensure_ascii=i % 2 == 0, indent=i % 3 or None),) for i, v in enumerate(values)]
    got = spark.createDataFrame(texts, "v string").select(nested_json(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [json.dumps(plain(v), sort_keys=True, ensure_ascii=False) for v in values]


def test_values_that_have_no_order_of_their_own(spark):
    text = '[{"b": 1}, "x", [2], null, 1, {"a": 2}, true, "X"]'
    df = spark.createDataFrame([(text,), ('{"a": 1, " a": 2, "a ": 3}',)], "v string")
    got = [tuple(r) for r in df.select(nested_json(F.col("v")), nested_json(F.col("v"), sort=False)).collect()]
    assert got[0][0] == '[null, 1, true, "X", "x", [2], {"a": 2}, {"b": 1}]'
    assert got[0][1] == '[{"b": 1}, "x", [2], null, 1, {"a": 2}, true, "X"]'
    assert got[1] == ('{"a": 3}', '{"a": 3}')


def test_numbers(spark):
    shown = ["0", "-0", "12", "1.50", "-0.0", "1e5", "1E-7", "1e22", "123456789.25", "0.0001", "0.00001234", "9007199254740993", "1e15", "2.5e15", "1.0", "-7.125e-9"]
    got = spark.createDataFrame([(x,) for x in shown], "v string").select(number_text(F.col("v"))).collect()
    assert [r[0] for r in got] == [json.dumps(json.loads(x)) for x in shown]


def test_long_lists_and_deep_values(spark):
    deep = "[" * 60 + "]" * 60
    long = json.dumps([i * 7919 % 500 for i in range(500)])
    got = spark.createDataFrame([(deep,), (long,)], "v string").select(nested_json(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [deep, json.dumps(list(range(500)))]


@pytest.fixture(scope="module")
def calls(spark):
    lines = [
        '{"json": {"b": 1, "a": [" x "]}}',
        '{"flags": [true, false], "m": [[2, 1], [1, 0]], "e": [], "n": [null], "w": ["b", null, "a"]}',
        '{" q ": ["z"]}',
        '{"q": ["z"]}',
        '{"q": "z"}',
        '{" q ": ["z"], "q": "z"}',
        '{"q": "z", " q ": ["z"]}',
    ]
    return calls_of(spark.createDataFrame(list(enumerate(lines)), "call_id long, value string"))


def test_calls_with_nested_values(calls):
    got = {r.call_id: r.canonical for r in with_canonical(calls).collect()}
    assert got[0] == '{"json": {"a": ["x"], "b": 1}}'
    assert got[1] == '{"e": [], "flags": [false, true], "m": [[0, 1], [1, 2]], "n": [null], "w": [null, "a", "b"]}'


def test_blanks_around_a_key_leave_it_a_list(calls):
    key = {r.call_id: r.key for r in with_key(calls).collect()}
    assert key[2] == key[3] == key[6] != key[4] == key[5]


def test_lists_keep_their_order_outside_the_key(calls):
    got = {r.call_id: r.params for r in normalize_calls(calls).collect()}
    assert got[1]["m"] == ["[[2, 1], [1, 0]]"] and got[0]["json"] == ['{"a": ["x"], "b": 1}']


@pytest.mark.parametrize("name", ["k3_canonical_nested", "k4_call_key_nested"])
def test_calls_are_dealt_out_and_not_folded(spark, name):
    """A file of events in one split is no single task, and no array is copied for each token."""
    from lexigrid.catalog import QUERIES

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_values_deeper_than_a_call_stack(spark):
    deep = "[" * 3000 + "]" * 3000
    got = spark.createDataFrame([(deep,), ('["\\ud800 ", -1.5, -3, 2e3, "a"]',), (None,)], "v string").select(nested_json(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [deep, '[-3, -1.5, 2000.0, "?", "a"]', None]
