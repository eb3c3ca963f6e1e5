import datetime as dt

import pytest
from pyspark.sql import functions as F

from kontora.session import scratch_path
from kontora.sources import storage

NOW = dt.datetime(2024, 1, 31)


def test_append_goes_by_name_and_fills_defaults(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([("a1", 300, 10, 20)], "account_id string, credit_limit int, current_balance int, available_balance int")
    storage.append_rows(df, path, "accounts", NOW)
    row = storage.scan_table(spark, path, "accounts").first()
    assert (float(row.current_balance), float(row.available_balance), float(row.credit_limit)) == (10, 20, 300)
    assert row.account_status == "ACTIVE" and row.created_at == NOW and row.closing_date is None
    with pytest.raises(ValueError):
        storage.append_rows(df.withColumn("nope", F.lit(1)), path, "accounts", NOW)


def test_partitioned_append_reads_back_whole(spark):
    path = scratch_path(spark, "p")
    df = spark.range(50).select(F.col("id").cast("string").alias("advance_id"), F.when(F.col("id") < 10, "ACTIVE").alias("advance_status"))
    storage.append_rows(df, path, "cash_advances", NOW, ["advance_status"])
    assert storage.scan_table(spark, path, "cash_advances").count() == 50


def test_versions_skip_a_repeated_token(spark):
    v = storage.Versions(spark, scratch_path(spark, "v"))
    assert v.read() is None
    step = lambda old: spark.range(1) if old is None else old.unionByName(spark.range(1))
    for token in ("1", "1", "2"):
        v.change(step, token)
    assert v.current() == (2, "2") and v.read().count() == 2


def test_upsert_log(spark):
    log = storage.UpsertLog(spark, scratch_path(spark, "u"), ["k"], compact_every=3)
    rows = lambda *xs: spark.createDataFrame(list(xs), "k string, v int")
    for i, batch in enumerate([rows(("a", 1), ("b", 1)), rows(("a", 2)), rows(("c", 3)), rows(("b", 4))]):
        log.put(batch, str(i))
    log.put(rows(("a", 99)), "1")  # seen before
    log.put(rows(("a", 99)), "2")  # seen before, also after compaction
    assert {tuple(r) for r in log.read().collect()} == {("a", 2), ("b", 4), ("c", 3)}
    assert {tuple(r) for r in log.matching(rows(("b", 0))).collect()} == {("b", 4)}


def test_upsert_log_drops_what_was_folded(spark):
    log = storage.UpsertLog(spark, scratch_path(spark, "u"), ["k"], compact_every=2, keep=lambda rows: rows.where("v > 1"))
    for i in range(9):
        log.put(spark.createDataFrame([(f"k{i % 4}", i)], "k string, v int"), str(i))
    assert len(log._entries()) <= 4 and log.done("0") and not log.done("9")
    assert {tuple(r) for r in log.read().collect()} == {("k0", 8), ("k1", 5), ("k2", 6), ("k3", 7)}


def test_merge_and_overlay(spark):
    mk = lambda rows: spark.createDataFrame(rows, "entity_id string, entity_type string, feature_vector map<string,double>, last_updated timestamp_ntz")
    old_time = dt.datetime(2024, 1, 1)
    target = mk([("1", "CUSTOMER", {"a": 1.0, "b": 2.0}, old_time), ("2", "CUSTOMER", {"a": 5.0}, old_time)])
    source = mk([("1", "CUSTOMER", {"b": 9.0, "c": 3.0}, old_time), ("3", "CUSTOMER", {"c": 1.0}, NOW)])
    got = {r.entity_id: (r.feature_vector, r.last_updated) for r in storage.merge_online(target, source, NOW).collect()}
    assert got["1"] == ({"a": 1.0, "b": 9.0, "c": 3.0}, NOW)
    assert got["2"] == ({"a": 5.0}, old_time) and got["3"][0] == {"c": 1.0}


def test_update_and_retention(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)), (3, NOW)], "id int, t timestamp_ntz")
    kept, old = storage.split_by_age(df, "t", dt.datetime(2024, 1, 15))
    assert {r.id for r in kept.collect()} == {1, 3} and {r.id for r in old.collect()} == {2}
    changed = storage.update_where(df, F.col("t") < F.lit("2024-01-15").cast("timestamp_ntz"), {"id": F.lit(0)})
    assert sorted(r.id for r in changed.collect()) == [0, 1, 3]


def test_every_declared_table_takes_an_append(spark):
    from kontora.schemas import TABLES

    root = scratch_path(spark, "all")
    for name, table in TABLES.items():
        df = spark.range(1).select(*[F.lit("1").cast("string").alias(k) for k in table.key if k != "feature_timestamp"])
        storage.append_rows(df, f"{root}/{name}", name, NOW)
        back = storage.scan_table(spark, f"{root}/{name}", name)
        assert back.count() == 1 and back.columns == table.schema.names
