"""Customer, account and campaign views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from kontora.functions.scalars import (
    band, count_if, date_diff, day, days_before, flag, mean, months_before, ratio0, sum_if,
)
from kontora.operators.joins import Child, join_children

DEPOSIT_TYPES = ("CHECKING", "SAVINGS")
CREDIT_TYPES = ("BELIEVE_CARD", "LINE_OF_CREDIT")  # fixed values of the account_type column


def customer_360(b, as_of: dt.date | None = None, fanout: str = "correct") -> DataFrame:
    """One wide row per customer: products, balances, activity, advances, support."""
    as_of = as_of or b.as_of
    kind = F.col("account_type")
    accounts = Child(
        b.accounts, "customer_id",
        safe={
            "total_accounts": F.count("account_id"),
            "checking_accounts": count_if(kind == "CHECKING"),
            "savings_accounts": count_if(kind == "SAVINGS"),
            "credit_cards": count_if(kind == "BELIEVE_CARD"),
            "lines_of_credit": count_if(kind == "LINE_OF_CREDIT"),
            "savings_apy_rate": F.max(F.when(kind == "SAVINGS", F.col("apy_rate"))),
        },
        sums={
            "total_deposit_balance": sum_if(kind.isin(*DEPOSIT_TYPES), "current_balance"),
            "total_credit_balance": sum_if(kind.isin(*CREDIT_TYPES), F.abs("current_balance")),
        },
    )
    txn = F.col("transaction_type")
    transactions = Child(
        b.transactions.where(F.col("transaction_date") >= days_before(as_of, 30)), "customer_id",
        safe={
            "transactions_30d": F.count("transaction_id"),
            "unique_merchant_categories_30d": F.count_distinct("merchant_category"),
        },
        sums={
            "total_spend_30d": sum_if(txn == "DEBIT", F.abs("amount")),
            "total_deposits_30d": sum_if(txn == "CREDIT", "amount"),
        },
    )
    recent = F.when(F.col("deposit_date") >= months_before(as_of, 3), F.col("amount"))
    deposits = Child(
        b.direct_deposits, "customer_id",
        safe={
            "total_direct_deposits": F.count("deposit_id"),
            "last_direct_deposit_date": F.max("deposit_date"),
            "avg_monthly_direct_deposit": mean(recent),
        },
    )
    status = F.col("advance_status")
    advances = Child(
        b.cash_advances, "customer_id",
        safe={
            "total_advances_taken": F.count("advance_id"),
            "avg_advance_repayment_days": mean(
                F.when(status == "REPAID", date_diff("day", "advance_date", "repayment_date"))
            ),
        },
        sums={"outstanding_advance_balance": sum_if(status == "ACTIVE", F.col("advance_amount") + F.col("fee_amount"))},
    )
    support = Child(
        b.support_interactions, "customer_id",
        safe={
            "total_support_contacts": F.count("interaction_id"),
            "avg_satisfaction_score": mean("satisfaction_score"),
            "last_support_contact_date": F.max("interaction_date"),
        },
    )
    children = [accounts, transactions, deposits, advances, support]
    wide = join_children(b.customers, "customer_id", children, fanout)
    counts = [
        "total_accounts", "checking_accounts", "savings_accounts", "credit_cards", "lines_of_credit",
        "transactions_30d", "unique_merchant_categories_30d", "total_direct_deposits",
        "total_advances_taken", "total_support_contacts",
    ]
    # a sum over CASE ... ELSE 0 is 0 for a customer without such rows
    zeroed = [n for c in children for n in c.sums]
    wide = wide.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in counts + zeroed})
    return wide.withColumns({
        "customer_tenure_days": date_diff("day", "acquisition_date", day(as_of)),
        "customer_age": date_diff("year", "date_of_birth", day(as_of)),
        "value_segment": band(
            "total_deposit_balance",
            [(10000, "HIGH_VALUE"), (1000, "MEDIUM_VALUE"), (100, "LOW_VALUE")], "MINIMAL_VALUE", ">=",
        ),
        "engagement_level": F.when(
            (F.col("transactions_30d") >= 50) & (F.col("total_direct_deposits") > 0), "HIGHLY_ENGAGED"
        ).when(F.col("transactions_30d") >= 20, "ENGAGED")
        .when(F.col("transactions_30d") >= 5, "OCCASIONAL").otherwise("DORMANT"),
        "advance_user_type": F.when(F.col("outstanding_advance_balance") > 0, "ADVANCE_ACTIVE")
        .when(F.col("total_advances_taken") > 0, "ADVANCE_USER").otherwise("ADVANCE_NEVER"),
    })


def account_analytics(b, as_of: dt.date | None = None, fanout: str = "correct") -> DataFrame:
    """One row per account with its activity, deposits and card."""
    as_of = as_of or b.as_of
    kind = F.col("transaction_type")
    base = b.accounts.join(b.customers.select("customer_id", "first_name", "last_name"), "customer_id").select(
        "account_id", "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
        "account_type", "account_status", "opening_date", "closing_date",
        date_diff("day", "opening_date", F.coalesce("closing_date", day(as_of))).alias("account_age_days"),
        "current_balance", "available_balance", "credit_limit", "apy_rate",
    )
    children = [
        Child(
            b.transactions, "account_id",
            safe={"total_transactions": F.count("transaction_id"), "last_transaction_date": F.max("transaction_date")},
            sums={
                "debit_count": F.sum(flag(kind == "DEBIT")),
                "credit_count": F.sum(flag(kind == "CREDIT")),
                "total_debits": sum_if(kind == "DEBIT", F.abs("amount")),
                "total_credits": sum_if(kind == "CREDIT", "amount"),
            },
        ),
        Child(
            b.direct_deposits, "account_id",
            safe={"direct_deposit_count": F.count("deposit_id"), "last_direct_deposit": F.max("deposit_date")},
        ),
        Child(
            b.cards, "account_id",
            safe={"primary_card_status": F.max("card_status"), "card_activation_date": F.max("activation_date")},
        ),
    ]
    wide = join_children(base, "account_id", children, fanout)
    zeroed = ["total_transactions", "direct_deposit_count", *children[0].sums]
    return wide.withColumns({
        **{n: F.coalesce(F.col(n), F.lit(0)) for n in zeroed},
        "avg_balance_lifetime": F.col("current_balance").cast("double"),
        "min_balance_lifetime": F.col("current_balance"),
        "max_balance_lifetime": F.col("current_balance"),
    })


def customer_churn_risk(b, as_of: dt.date | None = None, fanout: str = "correct", no_data: bool = False) -> DataFrame:
    """Recency, trend and balance signals of leaving.

    A customer without transactions has no recency and counts as ACTIVE, as the
    bands say; ``no_data`` labels such customers NO_DATA instead.
    """
    as_of = as_of or b.as_of
    date = F.col("transaction_date")
    checking = F.when(F.col("account_type") == "CHECKING", F.col("current_balance"))
    children = [
        Child(
            b.transactions, "customer_id",
            safe={"_last_txn": F.max("transaction_date")},
            sums={
                "transactions_last_30d": count_if(date >= days_before(as_of, 30)),
                "transactions_prev_30d": count_if(date.between(days_before(as_of, 60), days_before(as_of, 31))),
            },
        ),
        Child(b.direct_deposits, "customer_id", safe={"_last_dep": F.max("deposit_date")}),
        Child(b.support_interactions, "customer_id", safe={"_last_sup": F.max("interaction_date")}),
        Child(
            b.accounts, "customer_id",
            safe={"avg_checking_balance": mean(checking), "min_checking_balance": F.min(checking)},
        ),
    ]
    base = b.customers.select("customer_id", "acquisition_date", "customer_status")
    wide = join_children(base, "customer_id", children, fanout)
    activity = wide.select(
        "customer_id", "acquisition_date", "customer_status",
        date_diff("day", "_last_txn", day(as_of)).alias("days_since_last_transaction"),
        date_diff("day", "_last_dep", day(as_of)).alias("days_since_last_direct_deposit"),
        date_diff("day", "_last_sup", day(as_of)).alias("days_since_last_support_contact"),
        F.coalesce("transactions_last_30d", F.lit(0)).alias("transactions_last_30d"),
        F.coalesce("transactions_prev_30d", F.lit(0)).alias("transactions_prev_30d"),
        "avg_checking_balance", "min_checking_balance",
    )
    since = F.col("days_since_last_transaction")
    level = F.when(F.col("customer_status") != "ACTIVE", "CHURNED")
    if no_data:
        level = level.when(since.isNull(), "NO_DATA")
    level = (
        level.when(since > 90, "HIGH_RISK").when(since > 60, "MEDIUM_RISK")
        .when(since > 30, "LOW_RISK").otherwise("ACTIVE")
    )

    def truth(test):
        return F.coalesce(test, F.lit(False))

    return activity.withColumns({
        "churn_risk_level": level,
        "significant_activity_decline": truth(F.col("transactions_last_30d") < F.col("transactions_prev_30d") * 0.5),
        "direct_deposit_at_risk": truth(F.col("days_since_last_direct_deposit") > 45),
        "low_balance_risk": truth(F.col("avg_checking_balance") < 50),
    })


def campaign_performance(b) -> DataFrame:
    """Funnel, rates and cost per campaign."""
    def tally(test):
        return F.sum(flag(test))

    sent = b.customer_campaigns.groupBy(F.col("campaign_id").alias("_c")).agg(
        F.count_distinct("customer_id").alias("customers_targeted"),
        tally(F.col("sent_date").isNotNull()).alias("messages_sent"),
        tally(F.col("opened")).alias("messages_opened"),
        tally(F.col("clicked")).alias("messages_clicked"),
        tally(F.col("converted")).alias("conversions"),
        F.sum("conversion_value").alias("total_conversion_value"),
    )
    wide = b.marketing_campaigns.join(sent, F.col("campaign_id") == F.col("_c"), "left").drop("_c")
    counts = ["customers_targeted", "messages_sent", "messages_opened", "messages_clicked", "conversions"]
    wide = wide.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return wide.withColumns({
        "open_rate": ratio0("messages_opened", "messages_sent"),
        "click_through_rate": ratio0("messages_clicked", "messages_opened"),
        "conversion_rate": ratio0("conversions", "messages_sent"),
        "cost_per_customer": ratio0("budget", "customers_targeted"),
        "cost_per_conversion": ratio0("budget", "conversions"),
        "return_on_spend": ratio0("total_conversion_value", "budget"),
    })


def profile_aggs(b) -> DataFrame:
    n = b.accounts.groupBy("customer_id").agg(F.count("account_id").alias("num_accounts"))
    return b.customers.select("customer_id").join(n, "customer_id", "left").select(
        "customer_id", F.coalesce("num_accounts", F.lit(0)).alias("num_accounts")
    )


def advance_risk_aggs(b) -> DataFrame:
    n = b.cash_advances.groupBy("customer_id").agg(
        F.count("advance_id").alias("total_advances_taken"),
        mean("advance_amount").alias("avg_advance_amount"),
        count_if(F.col("advance_status") == "DEFAULTED").alias("num_defaults"),
    )
    return b.customers.select("customer_id").join(n, "customer_id", "left").select(
        "customer_id",
        F.coalesce("total_advances_taken", F.lit(0)).alias("total_advances_taken"),
        "avg_advance_amount",
        F.coalesce("num_defaults", F.lit(0)).alias("num_defaults"),
    )
