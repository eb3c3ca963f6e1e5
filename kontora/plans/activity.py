"""Transaction, advance, deposit and fraud views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from kontora.functions.scalars import (
    band, clamp, count_if, date_diff, day, days_before, flag, is_weekend, mean, midnight, moment, sum_if,
)
from kontora.operators.joins import Child, join_children
from kontora.operators.windows import framed, over_key, slice_of

# Risky merchant codes (fixed values).
RISKY_CODES = ("7995", "5933", "6010")


def transaction_analytics(b) -> DataFrame:
    """Transactions with category, time-of-day and size bands."""
    hour = F.hour("transaction_timestamp")
    size = F.abs("amount")
    mc = b.merchant_categories.select(
        "mcc_code",
        F.col("category_name").alias("merchant_category_name"),
        F.col("category_group").alias("merchant_category_group"),
        "cashback_eligible", "cashback_percentage", "high_risk_category",
    )
    return b.transactions.drop("created_at").join(mc, F.col("merchant_category") == F.col("mcc_code"), "left").drop(
        "mcc_code"
    ).withColumns({
        "transaction_hour": hour,
        "transaction_day_of_week": F.date_format("transaction_date", "E"),
        "day_type": F.when(is_weekend("transaction_date"), "WEEKEND").otherwise("WEEKDAY"),
        "time_of_day": F.when(hour.between(6, 11), "MORNING").when(hour.between(12, 17), "AFTERNOON")
        .when(hour.between(18, 23), "EVENING").otherwise("NIGHT"),
        "amount_category": band(
            size, [(10, "MICRO"), (50, "SMALL"), (200, "MEDIUM"), (1000, "LARGE")], "VERY_LARGE", "<"
        ),
    })


def cash_advance_analytics(b, as_of: dt.date | None = None) -> DataFrame:
    """Advances with repayment state and the customer's advance history."""
    as_of = as_of or b.as_of
    today = day(as_of)
    ended = F.coalesce("repayment_date", today)
    status, repaid, due = F.col("advance_status"), F.col("repayment_date"), F.col("due_date")
    history = framed(
        b.cash_advances.drop("created_at"), ["customer_id"], ["advance_date", "advance_id"],
        slice_of("advance_date"), 1,
        lambda w: {"previous_advance_date": F.lag("advance_date").over(w)},
        number="advance_sequence_number",
    )
    history = over_key(history, ["customer_id"], {"total_advances_by_customer": F.count("*")}, source=b.cash_advances)
    who = b.customers.select(
        "customer_id", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
        "credit_score", "income_verified",
    )
    return history.join(who, "customer_id").withColumns({
        "days_outstanding": date_diff("day", "advance_date", ended),
        "days_past_due": date_diff("day", "due_date", ended),
        "repayment_status": F.when((status == "REPAID") & (repaid <= due), "ON_TIME")
        .when((status == "REPAID") & (repaid > due), "LATE")
        .when((status == "ACTIVE") & (today > due), "OVERDUE")
        .when(status == "ACTIVE", "CURRENT").otherwise("DEFAULTED"),
        "days_since_last_advance": date_diff("day", "previous_advance_date", "advance_date"),
    })


def direct_deposit_analytics(b) -> DataFrame:
    """Deposits with trailing counts, averages and gaps per customer and employer."""
    keys = ["customer_id", "employer_name"]
    moving = framed(
        b.direct_deposits.drop("created_at"), keys, ["deposit_date", "deposit_id"],
        slice_of("deposit_date"), 11,
        lambda w: {
            "deposits_last_12": F.count("*").over(w.rowsBetween(-11, 0)),
            "_s6": F.sum("amount").over(w.rowsBetween(-5, 0)),
            "_n6": F.count("amount").over(w.rowsBetween(-5, 0)),
            "_prev": F.lag("deposit_date").over(w),
        },
    )
    volatility = F.stddev_samp(F.col("amount").cast("double"))
    steady = over_key(moving, keys, {"amount_volatility": volatility}, source=b.direct_deposits)
    who = b.customers.select("customer_id", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"))
    return steady.join(who, "customer_id").withColumns({
        "days_early": date_diff("day", "expected_date", "deposit_date"),
        "early_access_value": F.when(F.col("early_access_used"), F.col("amount") * F.lit(0.02).cast("decimal(3,2)"))
        .otherwise(F.lit(0)),
        "avg_amount_last_6": F.try_divide(F.col("_s6").cast("double"), F.col("_n6").cast("double")),
        "days_since_last_deposit": date_diff("day", "_prev", "deposit_date"),
    }).drop("_s6", "_n6", "_prev")


def fraud_risk_daily(b, as_of: dt.date | None = None) -> DataFrame:
    """Customer-day risk patterns over 90 days."""
    as_of = as_of or b.as_of
    risky = b.merchant_categories.select("mcc_code", "high_risk_category")
    daily = (
        b.transactions.where(F.col("transaction_date") >= days_before(as_of, 90))
        .join(risky, F.col("merchant_category") == F.col("mcc_code"), "left")
        .groupBy("customer_id", "transaction_date")
        .agg(
            F.count("*").alias("daily_transaction_count"),
            F.count_distinct("merchant_category").alias("unique_merchants_daily"),
            F.count_distinct("merchant_state").alias("unique_states_daily"),
            F.sum(flag(F.col("is_international"))).alias("international_transactions"),
            F.max("fraud_score").alias("max_fraud_score_daily"),
            F.sum(flag(F.abs("amount") > 1000)).alias("high_value_transactions"),
            F.sum(flag(F.col("high_risk_category"))).alias("risky_merchant_transactions"),
            F.sum(flag(F.hour("transaction_timestamp").between(0, 5))).alias("night_transactions"),
        )
    )
    # at most 91 days per customer meet here
    trail = Window.partitionBy("customer_id").orderBy("transaction_date").rowsBetween(-30, -1)
    n = F.col("daily_transaction_count")
    who = b.customers.select("customer_id", F.col("risk_tier").alias("customer_risk_tier"), "kyc_status")
    return daily.withColumn("volume_anomaly", n > F.avg(n).over(trail) * 3).join(who, "customer_id").withColumns({
        "daily_risk_level": band("max_fraud_score_daily", [(0.7, "HIGH"), (0.4, "MEDIUM"), (0.2, "LOW")], "MINIMAL"),
        "geographic_anomaly": F.col("unique_states_daily") > 3,
        "merchant_risk_anomaly": F.col("risky_merchant_transactions") > 5,
    })


def compliance_risk(b, as_of: dt.date | None = None, fanout: str = "correct") -> DataFrame:
    """Compliance events and money-laundering indicators per customer.

    The large-transaction test looks at the signed amount, so only credits count.
    """
    as_of = as_of or b.as_of
    kind = F.col("event_type")
    atm = F.col("transaction_category") == "ATM"
    risky = b.merchant_categories.select("mcc_code", "high_risk_category")
    recent = b.transactions.where(F.col("transaction_date") >= days_before(as_of, 90)).join(
        risky, F.col("merchant_category") == F.col("mcc_code"), "left"
    )
    children = [
        Child(
            b.compliance_events, "customer_id",
            safe={
                "total_compliance_events": F.count("event_id"),
                "sar_count": count_if(kind == "SAR"),
                "ctr_count": count_if(kind == "CTR"),
                "last_compliance_event_date": F.max("event_date"),
            },
        ),
        Child(
            recent, "customer_id",
            safe={
                "days_with_large_cash_withdrawals": F.count_distinct(
                    F.when(atm & (F.abs("amount") > 1000), F.col("transaction_date"))
                ),
            },
            sums={
                "large_transactions_count": F.sum(flag(F.col("amount") > 10000)),
                "international_transactions_count": F.sum(flag(F.col("is_international"))),
                "high_risk_merchant_transactions": F.sum(flag(F.col("high_risk_category"))),
                "total_cash_withdrawals": sum_if(atm, F.abs("amount")),
            },
        ),
    ]
    base = b.customers.select(
        "customer_id", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"), "kyc_status", "risk_tier"
    )
    wide = join_children(base, "customer_id", children, fanout)
    zeroed = ["total_compliance_events", "sar_count", "ctr_count", "days_with_large_cash_withdrawals", *children[1].sums]
    wide = wide.withColumns({c: F.coalesce(c, F.lit(0)) for c in zeroed})
    return wide.withColumn(
        "compliance_risk_level",
        F.when(F.col("sar_count") + F.col("ctr_count") > 0, "HIGH")
        .when((F.col("risk_tier") == "HIGH") | (F.col("high_risk_merchant_transactions") > 10), "MEDIUM")
        .otherwise("LOW"),
    )


def txn_pattern_aggs(b, now: dt.datetime | None = None) -> DataFrame:
    """7-day and 1-hour activity from one pass."""
    now = now or b.now
    week = F.col("transaction_date") >= days_before(now.date(), 7)
    return b.transactions.where("status = 'COMPLETED'").groupBy("customer_id").agg(
        count_if(week).alias("txn_count_7d"),
        F.sum(F.when(week, F.abs("amount"))).alias("txn_volume_7d"),
        count_if(F.col("transaction_timestamp") >= moment(now - dt.timedelta(hours=1))).alias("txn_count_1h"),
    )


def with_previous(b, rows: DataFrame) -> DataFrame:
    """Add the customer's previous transaction time and city."""
    return framed(
        rows, ["customer_id"], ["transaction_timestamp", "transaction_id"],
        slice_of(F.date_trunc("minute", "transaction_timestamp")), 1,
        lambda w: {
            "prev_txn_time": F.lag("transaction_timestamp").over(w),
            "prev_merchant_city": F.lag("merchant_city").over(w),
        },
    )


def fraud_detection_aggs(b, now: dt.datetime | None = None) -> DataFrame:
    """Unusual amounts and impossible travel over the last 7 days."""
    now = now or b.now
    recent = with_previous(
        b,
        b.transactions.where(
            (F.col("transaction_timestamp") >= moment(now - dt.timedelta(days=7))) & (F.col("status") == "COMPLETED")
        ).select("customer_id", "transaction_id", "transaction_timestamp", "merchant_city", "amount"),
    )
    usual = (
        b.transactions.where(F.col("transaction_date") >= days_before(now.date(), 30))
        .groupBy("customer_id").agg(mean(F.abs("amount")).alias("avg_amount"))
    )
    travel = (date_diff("minute", "prev_txn_time", "transaction_timestamp") < 5) & (
        F.col("merchant_city") != F.col("prev_merchant_city")
    )
    size = F.abs("amount").cast("double")
    # the per-transaction extremes are grouped first; the 3x test needs only the largest amount
    grouped = recent.groupBy("customer_id").agg(
        F.max(size).alias("_largest"), F.max(flag(travel)).alias("impossible_travel_flag")
    )
    return grouped.join(usual, "customer_id", "left").select(
        "customer_id",
        flag((F.col("_largest") > F.col("avg_amount") * 3) & (F.col("_largest") > 100)).alias("has_unusual_amount"),
        "impossible_travel_flag",
    )


def txn_velocity_30d(b, as_of: dt.date | None = None) -> DataFrame:
    """30-day transaction velocity of completed transactions."""
    as_of = as_of or b.as_of
    return (
        b.transactions.where((F.col("transaction_date") >= days_before(as_of, 30)) & (F.col("status") == "COMPLETED"))
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("txn_count_30d"),
            F.sum("amount").alias("txn_amount_30d"),
            mean("amount").alias("txn_avg_amount_30d"),
            F.stddev_samp(F.col("amount").cast("double")).alias("txn_stddev_amount_30d"),
            F.count_distinct("merchant_category").alias("unique_merchants_30d"),
            F.count_distinct("transaction_date").alias("active_days_30d"),
            F.max("amount").alias("max_txn_amount_30d"),
            F.sum(flag(F.col("is_international"))).alias("intl_txn_count_30d"),
        )
        .withColumn("feature_timestamp", moment(midnight(as_of)))
    )


def risk_indicators(b, as_of: dt.date | None = None, fanout: str = "correct") -> DataFrame:
    """Advance, balance and bureau signals per customer.

    A customer without advances has a default rate of 0, not NULL.
    """
    as_of = as_of or b.as_of
    children = [
        Child(
            b.cash_advances.where(F.col("advance_date") >= days_before(as_of, 90)), "customer_id",
            safe={
                "advance_count_90d": F.count("advance_id"),
                "advance_default_rate": mean(flag(F.col("advance_status") == "DEFAULTED")),
            },
            sums={"total_advance_amount_90d": F.sum("advance_amount")},
        ),
        Child(
            b.accounts, "customer_id",
            safe={"min_balance_30d": F.min("current_balance"), "avg_balance_30d": mean("current_balance")},
        ),
        Child(
            b.external_data, "customer_id",
            safe={"latest_credit_score": F.max("credit_score"), "latest_credit_utilization": F.max("credit_utilization")},
        ),
    ]
    wide = join_children(b.customers.select("customer_id"), "customer_id", children, fanout)
    return wide.withColumns({
        "feature_timestamp": moment(midnight(as_of)),
        "advance_count_90d": F.coalesce("advance_count_90d", F.lit(0)),
        "advance_default_rate": F.coalesce("advance_default_rate", F.lit(0.0)),
    })


def transaction_risk_score(amount, international, code, risky=RISKY_CODES):
    """Rule score of one transaction, decimal(3,2) between 0.01 and 0.99."""
    raw = (
        F.lit(0.1)
        + F.when(amount.cast("decimal(38,0)") > 1000, F.lit(0.2)).otherwise(F.lit(0.0))
        + F.when(international.cast("boolean"), F.lit(0.15)).otherwise(F.lit(0.0))
        + F.when(code.cast("string").isin(*risky), F.lit(0.25)).otherwise(F.lit(0.0))
    )
    return clamp(F.round(raw, 2), 0.01, 0.99).cast("decimal(3,2)")


def score_transaction_risk(df: DataFrame, payload: str) -> DataFrame:
    """Score transactions that arrive as JSON objects."""
    v = F.try_parse_json(F.col(payload))
    return df.withColumn("_v", v).withColumn(
        "risk_score",
        transaction_risk_score(
            F.try_variant_get("_v", "$.amount", "double"),
            F.try_variant_get("_v", "$.is_international", "boolean"),
            F.try_variant_get("_v", "$.merchant_category", "string"),
        ),
    ).drop("_v")


def detect_anomalies(b, lookback_hours: int = 24, now: dt.datetime | None = None, k: int = 50) -> DataFrame:
    """Customers with many transactions or a high average score, riskiest first."""
    now = now or b.now
    recent = b.transactions.where(
        (F.col("transaction_timestamp") >= moment(now - dt.timedelta(hours=lookback_hours)))
        & (F.col("status") == "COMPLETED")
    )
    return (
        recent.groupBy("customer_id")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(F.abs("amount")).alias("total_amount"),
            F.max(F.abs("amount")).alias("max_amount"),
            mean("fraud_score").alias("avg_fraud_score"),
        )
        .where("transaction_count > 10 OR avg_fraud_score > 0.6")
        .orderBy(F.desc("avg_fraud_score"), "customer_id")
        .limit(k)
    )
