"""Daily states of feature values: merged ranges against the exact statistics, replaced days, folders read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kontora.plans.feature_sketches import DISTINCT_BOUND, PERCENTILES, RANK_BOUND, Sketches, daily_states, held_against, merged, read_off

D = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [("heavy", rng.paretovariate(1.1), rng.randrange(10)) for _ in range(20_000)]
    rows += [("ties", float(rng.randrange(5)), rng.randrange(10)) for _ in range(4_000)] + [("nulls", None, 2)] * 5 + [("one", 4.5, 3), ("one", None, 4)]
    rows += [("far", 1e9 + rng.random(), rng.randrange(10)) for _ in range(500)]
    df = spark.createDataFrame(rows, "feature_id string, feature_value double, d int")
    return df.select("feature_id", "feature_value", F.expr("timestamp_ntz'2024-01-01 09:00:00' + make_interval(0, 0, 0, d)").alias("feature_timestamp")).cache()


def test_ranges_of_days(spark, values, tmp_path):
    s = Sketches(spark, str(tmp_path))
    s.refresh(values)
    for first, last in ((0, 9), (2, 4), (3, 3)):
        start, end = D + dt.timedelta(days=first), D + dt.timedelta(days=last)
        some = values.where(F.to_date("feature_timestamp").between(F.lit(start), F.lit(end)))
        stats = s.statistics(start, end)
        got = {r.feature_id: r for r in stats.collect()}
        want = some.groupBy("feature_id").agg(
            F.count("*").alias("n"), F.count("feature_value").alias("c"), F.avg("feature_value").alias("m"), F.stddev_samp("feature_value").alias("sd"), F.min("feature_value").alias("lo"), F.max("feature_value").alias("hi")
        )
        for r in want.collect():
            g = got[r.feature_id]
            assert (g.total_count, g.null_count, g.min_value, g.max_value) == (r.n, r.n - r.c, r.lo, r.hi)
            assert g.mean_value == pytest.approx(r.m) and g.std_deviation == pytest.approx(r.sd)
        for r in held_against(stats, some).collect():
            assert r.rank_error is None or r.rank_error <= RANK_BOUND
            assert r.distinct_error is None or r.distinct_error <= DISTINCT_BOUND
    empty = {r.feature_id: r for r in s.statistics().collect()}["nulls"]
    assert empty.percentile_50 is None and empty.mean_value is None and empty.null_count == 5 and empty.unique_count == 0


def test_days_are_replaced_and_pruned(spark, values, tmp_path):
    s = Sketches(spark, str(tmp_path))
    s.refresh(values)
    before = s.statistics().select("feature_id", "total_count", "mean_value").orderBy("feature_id").collect()
    s.refresh(values, [D, D + dt.timedelta(days=2)])
    assert s.statistics().select("feature_id", "total_count", "mean_value").orderBy("feature_id").collect() == before
    s.refresh(values.where("false"), [D])
    assert s.read(D, D).count() == 0 and s.read().count() > 0
    plan = s.statistics(D, D)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feature_date" in plan


def test_states_merge_in_any_grouping(spark, values):
    days = daily_states(values)
    weeks = merged(days.withColumn("w", F.weekofyear("feature_date")), "feature_id", "w")
    twice = {r.feature_id: r.asDict() for r in read_off(merged(weeks, "feature_id")).collect()}
    once = {r.feature_id: r.asDict() for r in read_off(merged(days, "feature_id")).collect()}
    exact = ("total_count", "null_count", "min_value", "max_value", "unique_count")
    assert {k: [r[c] for c in exact] for k, r in twice.items()} == {k: [r[c] for c in exact] for k, r in once.items()}
    assert read_off(merged(days.limit(0), "feature_id")).collect() == [] and len(PERCENTILES) == 5
