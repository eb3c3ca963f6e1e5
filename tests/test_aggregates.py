import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kontora.operators.aggregates import connected_groups, exact_percentiles, histogram, wanted_ranges
from kontora.operators.ranking import latest_per_key, sample_per_key, top_per_key

P = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


@pytest.mark.parametrize("slices", [2, 64, 4096])
def test_percentiles_match_numpy(spark, slices):
    rng = random.Random(3)
    data = [("hot", rng.choice([rng.gauss(0, 50), 5.0, 1e9])) for _ in range(2000)]
    data += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("same", 3.0), ("same", 3.0), ("gap", None), ("gap", 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", P, slices).collect()}
    for k in ("hot", "one", "two", "same", "gap"):
        values = [v for key, v in data if key == k and v is not None]
        for name, p in P.items():
            assert got[k][name] == pytest.approx(float(np.percentile(values, p * 100)), rel=1e-12)


def test_percentiles_without_key_and_with_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 10.0)], "k string, v double")
    assert exact_percentiles(df, [], "v", {"m": 0.5}).first().m == 3.0
    assert {(r.k, r.m) for r in exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()} == {(None, 2.0), ("a", 10.0)}


SHAPES = {
    "outlier": [0.0] + [1.7e9 + i for i in range(3000)],
    "negative": [-(2.0**i) for i in range(60)] + [-1e6 - i / 7 for i in range(500)],
    "tiny": [i * 1e-300 for i in range(500)] + [i * 1e-5 for i in range(500)] + [1e12],
    "around": [(-1) ** i * 1.5 ** (i % 90) * (1 + i / 1e4) for i in range(1500)],
    "ties": [7.0] * 4000 + [8.0, 9.0],
    "ends": [float("inf"), float("-inf")] + [float(i) for i in range(300)],
}


def test_no_range_holds_more_values_than_one_task_may_order(spark):
    data = [(k, v) for k, values in SHAPES.items() for v in values]
    df = spark.createDataFrame(data, "k string, v double")
    inner = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    slices, ordered = 256, 4
    counts = df.groupBy("k", F.col("v").alias("_v")).agg(F.count("*").alias("_n"))
    ranges = wanted_ranges(counts, ["k"], inner, slices, ordered).collect()
    assert max(r["_distinct"] for r in ranges) <= ordered
    assert {r["k"] for r in ranges} == set(SHAPES)
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", inner, slices, ordered).collect()}
    for k, values in SHAPES.items():
        for name, p in inner.items():
            assert got[k][name] == pytest.approx(float(np.percentile(values, p * 100)), rel=1e-12), (k, name)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect() == []


def test_connected_groups_match_union_find(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)]  # one long chain
    edges += [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.group_id for r in connected_groups(df, "a", "b").collect()}
    assert got == {n: find(n) for n in parent}


def test_latest_and_top(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 2, 30), ("b", 1, 5)], "k string, t int, id int")
    assert {tuple(r) for r in latest_per_key(df, ["k"], ["t", "id"]).collect()} == {("a", 2, 30), ("b", 1, 5)}
    assert {tuple(r) for r in top_per_key(df, ["k"], [F.desc("t"), F.desc("id")], 2).collect()} == {("a", 2, 30), ("a", 2, 20), ("b", 1, 5)}


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    a = {r.id for r in sample_per_key(df, ["k"], "id", 10).collect()}
    b = {r.id for r in sample_per_key(df.repartition(17), ["k"], "id", 10).collect()}
    assert a == b and len(a) == 30


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 4.9, 5.0, 9.99, 10.0, 50.0)], "v double")
    assert {r.bucket: r.n for r in histogram(df, "v", 0, 10, 2).collect()} == {0: 1, 1: 2, 2: 2, 3: 2}
