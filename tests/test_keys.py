from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rinse.operators import keys


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, some have no key, the rest repeat now and then."""
    draw = random.Random(11)
    data = [
        (draw.choice(["hot", None, *[f"k{draw.randint(0, 400)}"] * 2]), draw.randint(0, 5), f"v{i}")
        for i in range(1500)
    ]
    return spark.createDataFrame(data, "k string, n int, v string"), data


def survivors(data):
    best = {}
    for k, n, v in data:
        best[k] = min(best.get(k, (n, v)), (n, v))
    return sorted([(k, n, v) for k, (n, v) in best.items()], key=repr)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_survivor_does_not_depend_on_partitioning(spark, skewed, partitions):
    df, data = skewed
    assert rows(keys.deduplicate(df.repartition(partitions), ["k"], ["n"])) == survivors(data)


def test_keys_of_other_types(spark):
    df = spark.sql(
        "select * from values (0.0d, 1, date'2024-01-01'), (-0.0d, 2, date'2024-01-01'), "
        "(double('nan'), 3, null), (double('nan'), 4, null), (1.5d, 5, null) as t(k, v, d)"
    )
    by = ["k", "d"]
    assert sorted(r["v"] for r in keys.deduplicate(df, by).collect()) == [1, 3, 5]
    assert keys.count_duplicates(df, by).first()["removed"] == 2


def test_columns_without_order_still_go(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "k int, m map<string,int>")
    assert keys.deduplicate(df, ["k"]).count() == 1


def test_maps_keep_the_survivor_by_order(spark):
    df = spark.createDataFrame(
        [(1, 9, {"a": 1}), (1, 1, {"a": 2}), (2, 5, {"a": 1, "b": 2}), (2, 5, {"b": 2, "a": 1}), (2, 6, None)],
        "k int, o int, m map<string,int>",
    )
    assert sorted((r.k, r.o, r.m) for r in keys.deduplicate(df, ["k"], ["o"]).collect()) == [
        (1, 1, {"a": 2}), (2, 5, {"a": 1, "b": 2})]
    assert keys.deduplicate(df, df.columns).count() == 4
    assert keys.count_duplicates(df, df.columns).first()["removed"] == 1
    nested = df.selectExpr("k", "array(struct(m)) as n", "parse_json(to_json(m)) as v")
    assert keys.deduplicate(nested, nested.columns).count() == 4


def test_map_side_combine_comes_before_the_shuffle(spark, skewed):
    df, _ = skewed
    plan = keys.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert plan.count("Exchange") == 1 and "partial_min" in before_shuffle


def test_whole_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b")], "k int, v string")
    assert rows(keys.deduplicate(df, keys.dedup_keys(df.columns))) == [(1, "a"), (None, "b")]
    assert tuple(keys.count_duplicates(df, ["k"]).first()) == (4, 2, 2)


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, None), (3, None, "b")], "p int, x string, y string")
    found = {r["key"]: (r["status"], r["invalid_rows"], r["rows_with_null"])
             for r in keys.check_keys(df, "p", ["x", "y"]).collect()}
    assert found == {"primary": ("not valid", 1, 1), "composite": ("not valid", 1, 3)}
    found = {r["key"]: r["status"] for r in keys.check_keys(df.filter("x = 'a'"), None, ["x", "y"]).collect()}
    assert found == {"primary": "not given", "composite": "valid"}
