"""Stored rollups: equal to the answers from rows, the smallest level is read, batches are merged and replaced."""

import pytest
from pyspark.sql import functions as F

from kontora.plans import semantic as sem
from kontora.plans.rollups import Rollups

TP = sem.TRANSACTION_PAYMENT
LEVELS = [("category_group", "status", "account_type"), ("category_group", "status"), ("category_group",), ()]
METRICS = [m for m in TP.metrics]


def rows(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


def same(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y)


@pytest.fixture(scope="module")
def built(spark, bank, tmp_path_factory):
    r = Rollups(spark, str(tmp_path_factory.mktemp("rollups")))
    r.build(bank, TP, "transactions", LEVELS)
    return r


@pytest.mark.parametrize("dims", [("category_group", "status", "account_type"), ("status",), ("category_group",), ()])
def test_equal_to_the_rows(bank, built, dims):
    direct = sem.semantic_query(bank, TP, METRICS, dims)
    stored = sem.semantic_query(bank, TP, METRICS, dims, rollups=built)
    assert direct.dtypes == stored.dtypes
    text = lambda df: df.na.fill("none", list(dims)) if dims else df
    same(text(direct), text(stored))


def test_conditions_need_their_dimension(bank, built):
    ask = dict(where="{status} = 'DECLINED'", where_dimensions=["status"])
    same(sem.semantic_query(bank, TP, METRICS, ["account_type"], **ask), sem.semantic_query(bank, TP, METRICS, ["account_type"], rollups=built, **ask))


def test_the_smallest_level_is_read(bank, built):
    def level(*dims):
        return built.covering(TP, "transactions", [], dims)

    assert level().name == "total" and level().n_rows == 1
    assert level("category_group").name == "by_category_group"
    assert level("status").name == "by_category_group_status"
    assert level("account_type").name == "wide"
    assert level("merchant_state") is None
    answer = sem.semantic_query(bank, TP, ["total_transactions"], ["category_group"], rollups=built)
    assert all("level=by_category_group/" in f for f in answer.inputFiles())
    missing = sem.semantic_query(bank, TP, ["total_transactions"], ["merchant_state"], rollups=built)
    assert missing.count() == sem.semantic_query(bank, TP, ["total_transactions"], ["merchant_state"]).count()
    assert not any("rollups" in f for f in missing.inputFiles())


def test_batches_add_up_and_are_replaced(spark, bank, tmp_path):
    r, tx = Rollups(spark, str(tmp_path)), bank.transactions
    half = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == 0
    for _ in range(2):  # the second time over the first
        r.build(bank, TP, "transactions", LEVELS, "one", tx.where(half))
    r.build(bank, TP, "transactions", LEVELS, "two", tx.where(~half))
    for dims in (["status"], []):
        same(sem.semantic_query(bank, TP, METRICS, dims), sem.semantic_query(bank, TP, METRICS, dims, rollups=r))
    r.build(bank, TP, "transactions", [()], "two", tx.where(~half))  # the batches share the total only
    assert r.covering(TP, "transactions", [], ["status"]) is None


def test_a_batch_without_manifest_is_not_read(spark, bank, tmp_path):
    r = Rollups(spark, str(tmp_path))
    r.build(bank, TP, "transactions", LEVELS, "one")
    want = rows(sem.semantic_query(bank, TP, ["total_transactions"], rollups=r))
    stray = spark.read.parquet(f"{tmp_path}/transaction_payment.transactions/wide/batch=one")
    stray.write.parquet(f"{tmp_path}/transaction_payment.transactions/wide/batch=stray")
    assert rows(sem.semantic_query(bank, TP, ["total_transactions"], rollups=r)) == want


def test_sketched_distinct_counts(spark, bank, built):
    near = Rollups(spark, built.root, exact_distinct=False)
    got = sem.semantic_query(bank, TP, ["unique_merchants"], ["status"], rollups=near).collect()
    want = {r.status: r.unique_merchants for r in sem.semantic_query(bank, TP, ["unique_merchants"], ["status"]).collect()}
    assert want and all(abs(r.unique_merchants / want[r.status] - 1) <= 0.065 for r in got)


def test_another_day_is_not_answered_from_old_states(spark, bank, tmp_path):
    r, view = Rollups(spark, str(tmp_path)), sem.CUSTOMER_BANKING
    r.build(bank, view, "direct_deposits", [("frequency",)])
    moved = sem.bound_metric(bank, view.metrics["direct_deposits.monthly_deposit_volume"])
    later = view.metrics["direct_deposits.monthly_deposit_volume"].bound("DATE '1999-01-01'")
    assert r.answer(view, "direct_deposits", {"v": moved}, ["frequency"], ["frequency"], None) is not None
    assert r.answer(view, "direct_deposits", {"v": later}, ["frequency"], ["frequency"], None) is None
    assert r.answer(view, "direct_deposits", {"v": "COUNT(*)"}, [], [], None) is None  # a plain expression has no states


def test_no_rows(spark, bank, tmp_path):
    r = Rollups(spark, str(tmp_path))
    r.build(bank, TP, "transactions", LEVELS, rows=bank.transactions.limit(0))
    for dims in (["status"], ["category_group"], ["account_type"]):
        assert sem.semantic_query(bank, TP, METRICS, dims, rollups=r).collect() == []
    one = sem.semantic_query(bank, TP, METRICS, rollups=r).collect()
    assert len(one) == 1 and one[0].transactions_total_transactions == 0 and one[0].transactions_unique_merchants == 0 and one[0].transactions_transaction_volume is None
