"""Edge cases of the views on small hand-made tables."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kontora.plans import activity, customers, feature_store, monitoring

D = dt.date
AS_OF = D(2024, 1, 31)


def ago(n):
    return AS_OF - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def bank(spark):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    def txn(i, cust, days, amount, minute=0, city="X", status="COMPLETED", score=0.1, kind="DEBIT"):
        at = dt.datetime.combine(ago(days), dt.time(12, minute))
        return (i, cust * 10, cust, kind, "ATM", ago(days), at, amount, "5900", city, "S", False, score, status)

    txns = [
        txn(1, 1, 30, -50), txn(2, 1, 31, -70), txn(3, 1, 60, -70), txn(4, 1, 61, -70), txn(5, 1, 7, -1000, 0, "A"), txn(6, 1, 7, -10, 4, "B"),
        txn(7, 1, 6, 20000, 0, "B", kind="CREDIT"), txn(8, 2, 1, -5, status="PENDING"),
    ]
    return SimpleNamespace(
        spark=spark, as_of=AS_OF, now=dt.datetime(2024, 1, 31),
        customers=table(
            [(i, "F", "L", D(2020, 1, 1), D(1980, 12, 31), s, "VERIFIED", "LOW") for i, s in ((1, "ACTIVE"), (2, "ACTIVE"), (3, "CLOSED"), (4, "ACTIVE"))],
            "customer_id int, first_name string, last_name string, acquisition_date date, date_of_birth date, customer_status string, kyc_status string, risk_tier string",
        ),
        accounts=table(
            [(10, 1, "CHECKING", 100), (11, 1, "SAVINGS", 900), (20, 2, "CHECKING", 40)],
            "account_id int, customer_id int, account_type string, current_balance int",
        ).withColumn("current_balance", F.col("current_balance").cast("decimal(12,2)")).withColumn("apy_rate", F.lit(5.0)),
        transactions=table(
            txns, "transaction_id int, account_id int, customer_id int, transaction_type string, transaction_category string, transaction_date date, "
            "transaction_timestamp timestamp_ntz, amount int, merchant_category string, merchant_city string, merchant_state string, is_international boolean, "
            "fraud_score double, status string",
        ).withColumn("amount", F.col("amount").cast("decimal(12,2)")),
        direct_deposits=table(
            [(1, 1, 10, None, ago(40), ago(39), 100), (2, 1, 10, None, ago(20), ago(19), 300), (3, 1, 10, "E", ago(10), ago(10), 50), (4, 2, 20, "E", ago(46), ago(46), 10)],
            "deposit_id int, customer_id int, account_id int, employer_name string, deposit_date date, expected_date date, amount int",
        ).withColumn("amount", F.col("amount").cast("decimal(12,2)")).withColumn("early_access_used", F.lit(True)).withColumn("created_at", F.lit(None)),
        cash_advances=table([], "advance_id int, customer_id int, advance_status string, advance_amount decimal(10,2), fee_amount decimal(10,2), advance_date date, repayment_date date"),
        support_interactions=table([], "interaction_id int, customer_id int, satisfaction_score int, interaction_date date"),
        compliance_events=table([(1, 4, "SAR", ago(1))], "event_id int, customer_id int, event_type string, event_date date"),
        merchant_categories=table([("5900", True)], "mcc_code string, high_risk_category boolean"),
        external_data=table([(1, 700, 0.5)], "customer_id int, credit_score int, credit_utilization double"),
    )


def by(df, key="customer_id"):
    return {r[key]: r for r in df.collect()}


def test_customer_360_edges(bank):
    c = by(customers.customer_360(bank))
    assert len(c) == 4
    assert c[1].transactions_30d == 4  # day -30 counts, day -31 does not
    assert (c[1].value_segment, c[2].value_segment, c[3].value_segment) == ("MEDIUM_VALUE", "MINIMAL_VALUE", "MINIMAL_VALUE")
    assert c[4].total_accounts == 0 and c[4].total_deposit_balance == 0 and c[4].avg_satisfaction_score is None
    assert c[1].customer_age == 44 and c[1].advance_user_type == "ADVANCE_NEVER"


def test_churn_windows_and_missing_activity(bank):
    c = by(customers.customer_churn_risk(bank))
    assert (c[1].transactions_last_30d, c[1].transactions_prev_30d) == (4, 2)
    assert c[2].direct_deposit_at_risk and not c[1].direct_deposit_at_risk
    assert (c[3].churn_risk_level, c[4].churn_risk_level) == ("CHURNED", "ACTIVE")
    assert by(customers.customer_churn_risk(bank, no_data=True))[4].churn_risk_level == "NO_DATA"
    assert c[2].low_balance_risk and not c[4].low_balance_risk


def test_velocity_single_row_and_status(bank):
    v = by(activity.txn_velocity_30d(bank))
    assert 2 not in v  # only a pending transaction
    assert v[1].txn_count_30d == 4 and v[1].txn_stddev_amount_30d is not None


def test_fraud_flags(bank):
    f = by(activity.fraud_detection_aggs(bank))
    assert f[1].impossible_travel_flag == 1  # 4 minutes apart in two cities
    assert f[1].has_unusual_amount == 1


def test_deposit_groups_keep_missing_employer_apart(bank):
    d = by(activity.direct_deposit_analytics(bank), "deposit_id")
    assert len(d) == 4
    assert d[2].days_since_last_deposit == 20 and d[1].days_since_last_deposit is None
    assert d[3].amount_volatility is None and d[2].amount_volatility == pytest.approx(141.42135623)
    assert float(d[1].early_access_value) == 2.0 and d[2].deposits_last_12 == 2


def test_compliance_counts_signed_amounts(bank):
    c = by(activity.compliance_risk(bank))
    assert c[1].large_transactions_count == 1 and c[4].compliance_risk_level == "HIGH"
    assert c[1].high_risk_merchant_transactions == 7


def test_risk_indicators_without_advances(bank):
    r = by(activity.risk_indicators(bank))
    assert r[1].advance_default_rate == 0.0 and r[1].total_advance_amount_90d is None and r[1].advance_count_90d == 0


def test_feature_without_rows_has_no_value(bank):
    from kontora.sources.mapping import FEATURE_IDS

    bank.transactions = bank.transactions.withColumn("merchant_name", F.lit("m"))
    got = {(r.entity_id, r.feature_id): r.feature_value for r in feature_store.compute_features(bank, FEATURE_IDS).collect()}
    assert got[("1", FEATURE_IDS[0])] == 4 and got[("1", FEATURE_IDS[3])] == 500
    assert ("3", FEATURE_IDS[0]) not in got and not any(f == FEATURE_IDS[4] for _, f in got)


def test_drift_boundary_day_counts_in_both(spark):
    rows = [("f", dt.datetime(2024, 1, 24), 2.0), ("f", dt.datetime(2024, 1, 18), 4.0), ("f", dt.datetime(2024, 1, 30), 8.0)]
    v = spark.createDataFrame(rows, "feature_id string, feature_timestamp timestamp_ntz, feature_value double")
    r = feature_store.drift(v, AS_OF, 7).first()
    assert (r.baseline_mean, r.current_mean) == (3.0, 5.0) and r.alert_required


def test_training_set_never_sees_the_future(bank, spark):
    values = spark.createDataFrame(
        [("1", "f", dt.datetime(2024, 1, d), float(d)) for d in range(1, 20)], "entity_id string, feature_id string, feature_timestamp timestamp_ntz, feature_value double"
    )
    labels = spark.createDataFrame(
        [(1, "1", dt.datetime(2024, 1, 5), True), (2, "1", dt.datetime(2024, 1, 5, 0, 0, 1), True), (3, "1", dt.datetime(2023, 1, 1), False), (4, "9", dt.datetime(2024, 1, 9), False)],
        "label_id long, entity_id string, label_ts timestamp_ntz, label boolean",
    )
    got = {r.label_id: r.f for r in feature_store.training_dataset(labels, values, ["f"]).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: None, 4: None}
