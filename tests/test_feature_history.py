"""The stored value history: replaced days, folders read, refreshed statistics; the stratified split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kontora.plans import feature_store as fs
from kontora.plans.feature_history import History, known_to, within

D = dt.date(2024, 1, 1)


@pytest.fixture
def values(spark):
    rows = [
        (str(e), "CUSTOMER", f, float(e * d), dt.datetime(2024, 1, d, 23, 59, 59))
        for e in range(8) for f in ("x", "y") for d in range(1, 11)
    ]
    return spark.createDataFrame(rows, "entity_id string, entity_type string, feature_id string, feature_value double, feature_timestamp timestamp_ntz")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_replaced(spark, values, tmp_path):
    h = History(spark, str(tmp_path))
    assert not h.exists()
    h.store(values)
    before = h.read().count()
    third, fourth = D + dt.timedelta(days=2), D + dt.timedelta(days=3)
    again = values.withColumn("feature_value", F.lit(-1.0))
    h.store(again, [third])
    h.store(again, [third])
    assert h.read().count() == before and {r.feature_date for r in h.read().where("feature_value = -1").select("feature_date").distinct().collect()} == {third}
    h.store(values.where(F.to_date("feature_timestamp") != fourth), [fourth])  # its rows are gone from the source
    assert h.read().where(F.col("feature_date") == fourth).count() == 0 and h.read().count() == before - 16


def test_readers_open_their_days_only(spark, values, tmp_path):
    h = History(spark, str(tmp_path))
    h.store(values)
    when = dt.datetime(2024, 1, 5, 12)
    early = within(h.read(), end=when)
    assert "PartitionFilters: [isnotnull(feature_date" in plan(early) and len(early.inputFiles()) <= len(h.read().inputFiles())
    assert early.agg(F.max("feature_timestamp")).first()[0] == dt.datetime(2024, 1, 4, 23, 59, 59)
    drift = fs.drift(h.read(), dt.date(2024, 1, 11), lookback=3)
    assert "feature_date" in plan(drift).split("PartitionFilters: [")[1].split("]")[0]
    assert {tuple(r) for r in drift.collect()} == {tuple(r) for r in fs.drift(values, dt.date(2024, 1, 11), lookback=3).collect()}
    labels = spark.createDataFrame(
        [(i, str(i % 8), dt.datetime(2024, 1, 6 + i % 2, 6), i % 3 == 0) for i in range(40)], "label_id long, entity_id string, label_ts timestamp_ntz, label boolean"
    ).where("label_id < 30")
    for ttl, mark in ((None, "Subquery"), (dt.timedelta(days=2), "dynamicpruning")):
        assert mark in plan(known_to(h.read(), labels, ttl)).split("PartitionFilters: [")[1].split("\n")[0]
        got = fs.training_dataset(labels, h.read(), ["x", "y"], ttl)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, fs.training_dataset(labels, values, ["x", "y"], ttl).collect()))
    assert known_to(h.read(), labels, dt.timedelta(days=2)).select("feature_date").distinct().count() == 4
    assert fs.training_dataset(labels.limit(0), h.read(), ["x"], None).count() == 0


def test_statistics_of_some_days(spark, values, tmp_path):
    h = History(spark, str(tmp_path))
    h.store(values)
    h.refresh_statistics()
    fifth = D + dt.timedelta(days=4)
    h.store(values.withColumn("feature_value", F.col("feature_value") * 2), [fifth])
    h.refresh_statistics([fifth])
    key = ["feature_id", "computation_date"]
    got, want = h.statistics(), fs.feature_stats(h.read())
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
    assert got.groupBy(*key).count().where("count > 1").isEmpty()


def test_stratified_split(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 3 == 0, F.lit(None)).otherwise("often").alias("kind"), F.lit(1).alias("_x"))
    split = fs.stratified_split(rows, "id", "kind", 80)
    assert split.columns == ["id", "kind", "_x", "in_train"]
    shares = split.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("in_train").alias("k")).collect()
    assert sum(r.n for r in shares) == 5000 and all(abs(r.k - 0.8 * r.n) <= 0.5 for r in shares)
    again = fs.stratified_split(rows.repartition(7), "id", "kind", 80)
    assert sorted(map(str, split.collect())) == sorted(map(str, again.collect()))
    for percent, n in ((0, 0), (100, 5000)):
        assert fs.stratified_split(rows, "id", "kind", percent).where("in_train").count() == n
    assert fs.stratified_split(rows.limit(0), "id", "kind").collect() == []
