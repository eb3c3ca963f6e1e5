import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kontora.operators.joins import (
    Child, asof_join, day_spine, full_stitch, join_children, presence, shared_attribute_links, with_each, with_row,
)


def test_fanout_modes(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    a = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "p int, x int")
    c = spark.createDataFrame([(1, 1), (1, 2), (1, 4)], "p int, y int")
    children = [Child(a, "p", {"na": F.count("*")}, {"sx": F.sum("x")}), Child(c, "p", {"my": F.max("y")}, {"sy": F.sum("y")})]
    true = {r.p: (r.na, r.sx, r.my, r.sy) for r in join_children(parent, "p", children).collect()}
    assert true == {1: (2, 30, 4, 7), 2: (1, 5, None, None), 3: (None, None, None, None)}
    written = {r.p: (r.sx, r.sy) for r in join_children(parent, "p", children, "as_written").collect()}
    naive = parent.join(a, "p", "left").join(c, "p", "left").groupBy("p").agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    assert written == {r.p: (r.sx, r.sy) for r in naive.collect()}
    with pytest.raises(ValueError):
        join_children(parent, "p", children, "other")


def _brute(probes, history, ttl=None):
    out = {}
    for pid, key, t in probes:
        best = None
        for hk, ht, v in history:
            if hk == key and ht <= t and (best is None or ht > best[0]):
                best = (ht, v)
        if best and ttl and t - best[0] > ttl:
            best = None
        out[pid] = best[1] if best else None
    return out


@pytest.mark.parametrize("ttl", [None, dt.timedelta(hours=3)])
def test_asof_against_brute_force(spark, ttl):
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    at = lambda: base + dt.timedelta(minutes=rng.randrange(3 * 1440))
    key = lambda: "hot" if rng.random() < 0.7 else rng.choice("abc")
    history = {}
    for _ in range(300):
        history[(key(), at())] = rng.random()
    history = [(k, t, v) for (k, t), v in history.items()]
    probes = [(i, key(), at()) for i in range(300)]
    probes += [(1000, history[0][0], history[0][1]), (1001, "none", base)]  # equal times match; unknown key does not
    p = spark.createDataFrame(probes, "id long, k string, t timestamp_ntz")
    h = spark.createDataFrame(history, "k string, ht timestamp_ntz, v double")
    got = asof_join(p, h, ["k"], "id", "t", "ht", ["v"], ttl)
    assert {r.id: r.v for r in got.collect()} == _brute(probes, history, ttl)
    assert got.where("ht > t").count() == 0


def test_full_stitch_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "d string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "d string, b int")
    assert {tuple(r) for r in full_stitch(a, b, ["d"]).collect()} == {(None, 1, 10), ("x", 2, None), ("y", None, 20)}
    one = full_stitch(a.agg(F.sum("a").alias("a")), b.agg(F.sum("b").alias("b")), [])
    assert [tuple(r) for r in one.collect()] == [(3, 30)]


def test_shared_attribute_links_are_one_per_member(spark):
    df = spark.createDataFrame([(1, "d"), (2, "d"), (3, "d"), (3, "d"), (4, "e"), (5, None)], "c int, a string")
    assert {tuple(r) for r in shared_attribute_links(df, "c", "a").collect()} == {("d", 2, 1, 3), ("d", 3, 1, 3)}


def test_spine_and_small_relations(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 2), dt.date(2024, 1, 1))], "id int, a date, b date")
    assert day_spine(df, "a", "b").groupBy("id").count().collect()[0][1] == 3  # an empty span gives no day
    small = spark.createDataFrame([("m",), ("n",)], "s string")
    assert with_each(df.select("id"), small, "x").count() == 4
    assert {r.x.s for r in with_row(df.select("id"), small.where("s = 'm'"), "x").collect()} == {"m"}


def test_presence(spark):
    need = spark.createDataFrame([("a",), ("b",)], "n string")
    have = spark.createDataFrame([("a",), ("a",)], "n string")
    assert {tuple(r) for r in presence(need, have, "n").collect()} == {("a", "PASS"), ("b", "FAIL")}


def test_asof_join_keeps_probes_without_a_time(spark):
    probes = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 2)), (2, "a", None)], "pid int, k string, t timestamp")
    history = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 5), ("a", None, 9)], "k string, ht timestamp, v int")
    got = asof_join(probes, history, ["k"], "pid", "t", "ht", ["v"])
    assert sorted((r.pid, r.v) for r in got.collect()) == [(1, 5), (2, None)]
