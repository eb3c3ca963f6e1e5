"""The sliced windows against the plain ones, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from kontora.operators.windows import carried, framed, numbered, over_key, positioned, range_sums, ranged, running, slice_of


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        data.append((key, rng.randrange(40), i, rng.randrange(100), rng.choice([None, "x", "y"])))
    return spark.createDataFrame(data, "k string, t int, id long, v long, c string")


def collected(df, *cols):
    return sorted(df.select("id", *cols).collect())


def slices():
    return F.floor(F.col("t") / 4)


def window():
    return Window.partitionBy("k").orderBy("t", "id")


def test_running_sum(rows):
    got = running(rows, ["k"], ["t", "id"], slices(), {"s": "v"})
    want = rows.withColumn("s", F.sum("v").over(window().rowsBetween(Window.unboundedPreceding, 0)))
    assert collected(got, "s") == collected(want, "s")


def test_numbered(rows):
    got = numbered(rows, ["k"], ["t", "id"], slices())
    assert collected(got, "rn") == collected(rows.withColumn("rn", F.row_number().over(window()).cast("long")), "rn")


@pytest.mark.parametrize("chunk", [13, 50, 10_000])
def test_framed(rows, chunk):
    def build(w):
        return {
            "prev": F.lag("v").over(w), "third": F.lag("v", 3).over(w), "n": F.count("*").over(w.rowsBetween(-11, 0)),
            "base": F.avg("v").over(w.rowsBetween(-5, -1)),
        }

    got = framed(rows, ["k"], ["t", "id"], slices(), 11, build, chunk_rows=chunk)
    want = rows.select("*", *[c.alias(n) for n, c in build(window()).items()])
    assert got.count() == rows.count()
    key = lambda r: (r.id, r.prev, r.third, r.n, r.base)
    assert sorted(map(key, got.collect()), key=lambda x: x[0]) == sorted(map(key, want.collect()), key=lambda x: x[0])


def test_frame_longer_than_chunk_is_refused(rows):
    with pytest.raises(ValueError):
        framed(rows, ["k"], ["t", "id"], slices(), 20, lambda w: {}, chunk_rows=20)


def test_carried(rows):
    got = carried(rows, ["k"], ["t", "id"], slices(), ["c"])
    want = rows.withColumn("c", F.last("c", ignorenulls=True).over(window().rowsBetween(Window.unboundedPreceding, 0)))
    pairs = lambda df: sorted(((r.id, r.c or "") for r in df.collect()))
    assert pairs(got) == pairs(want)


def test_over_key_keeps_null_key_rows(rows):
    got = over_key(rows, ["k"], {"n": F.count("*"), "m": F.max("v")})
    w = Window.partitionBy("k")
    want = rows.select("*", F.count("*").over(w).alias("n"), F.max("v").over(w).alias("m"))
    assert collected(got, "n", "m") == collected(want, "n", "m")


def test_no_key_at_all(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    got = numbered(df, [], ["x"], F.floor(F.col("x") / 7))
    assert [(r.x, r.rn) for r in got.orderBy("x").collect()] == [(i, i + 1) for i in range(100)]


@pytest.mark.parametrize("ids", ["long", "string"])
def test_slices_follow_the_order_whatever_the_ids(spark, ids):
    """Ids beyond 2^20 that do not rise with time, and NULL times."""
    rng = random.Random(5)
    data = [(rng.choice(["hot", None]), rng.randrange(7200) if rng.random() < 0.95 else None, rng.randrange(1 << 40), k) for k in range(800)]
    df = spark.createDataFrame(data, "k string, s int, i long, v long").select(
        "k", F.timestamp_seconds("s").alias("t"), (F.col("i") if ids == "long" else F.concat(F.lit("TXN"), "i")).alias("id"), "v"
    )
    w = Window.partitionBy("k").orderBy("t", "id")
    cut = slice_of(F.date_trunc("minute", "t"))
    want = df.select("id", F.row_number().over(w).alias("n"), F.sum("v").over(w).alias("s"), F.lag("t").over(w).alias("p"))
    got = framed(running(df, ["k"], ["t", "id"], cut, {"s": "v"}), ["k"], ["t", "id"], cut, 1, lambda x: {"p": F.lag("t").over(x)}, number="n")
    assert sorted(got.select("id", "n", "s", "p").collect(), key=str) == sorted(want.collect(), key=str)


def test_positions_in_the_whole_table(spark):
    df = spark.createDataFrame([(f"A{k * 7919 % 1000}",) for k in range(1000)] + [(None,)], "a string").repartition(5)
    want = df.select("a", F.row_number().over(Window.orderBy("a")).alias("n"))
    assert sorted(positioned(df, ["a"], "n").collect(), key=str) == sorted(want.collect(), key=str)
    assert positioned(df.limit(0), ["a"]).collect() == []


@pytest.mark.parametrize("width", ["minute", "hour"])
def test_frames_of_time_over_a_busy_key(spark, width):
    """A third of the rows and more in one key, ties in time, no key, no time, values that are not there."""
    rng = random.Random(11)
    data = [
        ("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), rng.randrange(90_000) if rng.random() < 0.96 else None, k, rng.choice([None, 1, 5, -3]))
        for k in range(900)
    ]
    df = spark.createDataFrame(data + [("one", 5, 900, 7)], "k string, s int, id long, v long").withColumn("t", F.timestamp_seconds(F.floor(F.col("s") / 40) * 40)).drop("s")
    reach = dt.timedelta(minutes=47)
    w = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-47 * 60 * 1_000_000, 0)
    want = df.select("id", F.count("*").over(w).alias("n"), F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.max("v").over(w).alias("m"))
    sums = range_sums(df, ["k"], "t", ["id"], reach, {"n": F.lit(1).cast("long"), "s": "v"}, width)
    assert sums.columns == ["k", "id", "v", "t", "n", "s"]
    assert collected(sums, "n", "s") == collected(want, "n", "s")
    tops = ranged(df, ["k"], "t", reach, lambda x: {"m": F.max("v").over(x)})
    assert sorted(tops.select("id", "m").collect(), key=str) == sorted(want.select("id", "m").collect(), key=str)
    assert range_sums(df.limit(0), ["k"], "t", ["id"], reach, {"s": "v"}).collect() == ranged(df.limit(0), ["k"], "t", reach, lambda x: {}).collect() == []


def test_range_sums_group_slices_once_into_all_parts(spark):
    """Slices are found in one pass over the marks, and the parts their running sums are made in are as many as set, not merged by size."""
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id", F.timestamp_seconds(F.col("id") * 600).alias("t"))
    sums = range_sums(df, ["k"], "t", ["id"], dt.timedelta(days=1), {"n": F.lit(1).cast("long")})
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 2 and plan.count("REPARTITION_BY_NUM") == 1
    assert all(r.n == min(3, r.id // 50 + 1) for r in sums.collect())  # a key's rows are eight hours and twenty minutes apart
