"""The store of responses: appending what a scan yields, buckets, plans without a shuffle of the store."""

import json

import pytest

from lexigrid.operators.requests import split_cached
from lexigrid.sources import responses as src


def files(n, error=""):
    for i in range(n):
        yield f"key{i}.json", f'﻿{{"n": {i}}}'
        meta = {"url": f"http://host/{i}", "status": 200, "reason": "OK", "headers": {"b": "1", "Content-Type": f"x/{i}"}, "ske_error": error if i % 5 == 0 else ""}
        yield f"key{i}.meta.json", json.dumps(meta)


def scanned(spark, n, error=""):
    return src.responses_of(spark.createDataFrame(list(files(n, error)), "file_name string, value string"))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df):
    """Rows that came out of the scan of a plan that has run."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_scanned_responses_are_appended_once(spark, path):
    src.append_new(spark, scanned(spark, 20, "no corpus"), path, buckets=8)
    assert {r.key for r in src.open_store(spark, path).collect()} == {f"key{i}" for i in range(20) if i % 5}
    src.append_new(spark, scanned(spark, 30), path)
    src.append_new(spark, scanned(spark, 30), path)
    rows = src.open_store(spark, path).collect()
    assert sorted(r.key for r in rows) == sorted(f"key{i}" for i in range(30))
    assert {r.key: (r.text, r.headers["Content-Type"]) for r in rows}["key7"] == ('{"n": 7}', "x/7")


def test_of_equal_keys_the_first_is_kept(spark, path):
    rows = [("k", "json", "b", {"x": "1"}, ""), ("k", "json", "a", {"y": "0", "x": "2"}, ""), ("k", "json", "a", {"x": "1", "z": "9"}, "")]
    df = spark.createDataFrame(rows, "key string, format string, text string, headers map<string,string>, ske_error string")
    src.append_new(spark, df, path, buckets=4)
    assert [(r.text, r.headers) for r in src.open_store(spark, path).collect()] == [("a", {"x": "1", "z": "9"})]


def test_a_new_session_finds_the_store(spark, path):
    src.append_new(spark, scanned(spark, 40), path, buckets=8)
    spark.sql(f"DROP TABLE {src._store_table(path)}")
    store = src.open_store(spark, path, buckets=3)
    assert store.count() == 40
    assert "8 out of 8" in plan_of(store.groupBy("key").count())
    with pytest.raises(ValueError):
        src.open_store(spark, path + "2")


def test_store_side_has_no_exchange(spark, path):
    src.append_new(spark, scanned(spark, 40), path, buckets=8)
    store = src.open_store(spark, path)
    calls = spark.range(100).selectExpr("concat('key', id) AS key", "id AS call_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for part, n in zip(split_cached(calls, store), (40, 60)):
            assert part.count() == n
            plan = plan_of(part)
            assert plan.count("Exchange hashpartitioning(key") == 1 and "Bucketed: true" in plan
            # nothing but the calls is below the exchange
            assert "Range" in plan[plan.index("Exchange hashpartitioning(key") :].split("FileScan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_few_keys_read_their_buckets_only(spark, path):
    src.append_new(spark, scanned(spark, 40), path, buckets=8)
    store = src.open_store(spark, path)
    one = src.stored(store, spark.createDataFrame([("key3",), ("key3",), (None,)], "key string"))
    assert [r.key for r in one.collect()] == ["key3"] and scanned_rows(one) < 40 / 2
    many = src.stored(store, spark.range(2000).selectExpr("concat('key', id) AS key"))
    assert many.count() == 40 and src.stored(store, spark.createDataFrame([], "key string")).count() == 0
