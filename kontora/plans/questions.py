"""Business questions, each as one job over the banking tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from kontora.functions.scalars import (
    band, corr, count_if, date_diff, day, days_before, flag, is_weekend, mean, moment, ratio, slope, sum_if,
)
from kontora.operators.aggregates import connected_groups, exact_percentiles
from kontora.operators.joins import Child, join_children, shared_attribute_links, with_row
from kontora.operators.ranking import top_per_key
from kontora.operators.windows import numbered, over_key, running, slice_of
from kontora.plans import activity, customers, monitoring, semantic
from kontora.plans.retrieval import corpus, counted, search_topk

SCORE_BANDS = [(750, "EXCELLENT"), (700, "GOOD"), (650, "FAIR")]


def score_band(c="credit_score"):
    return band(c, SCORE_BANDS, "POOR", ">=")


def _flagged(b, rows: DataFrame, name: str) -> DataFrame:
    """customer_id and a true flag for customers that occur in rows."""
    return rows.select("customer_id").distinct().withColumn(name, F.lit(True))


def _left_flag(base: DataFrame, flags: DataFrame, name: str) -> DataFrame:
    return base.join(flags, "customer_id", "left").na.fill(False, [name])


def ltv_by_channel(b) -> DataFrame:
    """Value and retention by channel, number of products and deposit use."""
    products = b.accounts.groupBy("customer_id").agg(F.count("*").alias("product_count"))
    base = _left_flag(
        b.customers.select("customer_id", "acquisition_channel", "lifetime_value", flag(F.col("customer_status") == "ACTIVE").alias("kept")),
        _flagged(b, b.direct_deposits, "has_direct_deposit"), "has_direct_deposit",
    ).join(products, "customer_id", "left").na.fill(0, ["product_count"])
    grouped = base.groupBy("acquisition_channel", "product_count", "has_direct_deposit").agg(
        F.count("*").alias("customers"), mean("lifetime_value").alias("avg_ltv"), mean("kept").alias("retention")
    )
    link = base.groupBy("acquisition_channel").agg(
        F.round(corr(F.col("has_direct_deposit").cast("int"), "kept"), 6).alias("deposit_retention_corr")
    )
    return grouped.join(link, "acquisition_channel")


def advance_default(b) -> DataFrame:
    """Default rate, fees and profit by score band."""
    dep = b.direct_deposits.groupBy("customer_id").agg(mean("amount").alias("avg_deposit"))
    rows = b.cash_advances.join(b.customers.select("customer_id", score_band().alias("score_band")), "customer_id").join(dep, "customer_id", "left")
    bad, paid = F.col("advance_status") == "DEFAULTED", F.col("advance_status") == "REPAID"
    fees, lost = sum_if(paid, "fee_amount"), sum_if(bad, "advance_amount")
    return rows.groupBy("score_band").agg(
        F.count("*").alias("advances"), mean(flag(bad)).alias("default_rate"), mean("advance_amount").alias("avg_amount"),
        fees.alias("fees_collected"), lost.alias("default_volume"), (fees - lost).alias("profit"),
        F.round(corr("avg_deposit", flag(paid)), 6).alias("deposit_repay_corr"),
        mean(F.when(bad, date_diff("day", "advance_date", "repayment_date"))).alias("avg_days_to_default"),
    )


def fraud_24h(b) -> DataFrame:
    """Customers with a velocity spike, an unusual amount or wide geography in the last day."""
    last = b.transactions.where(F.col("transaction_timestamp") >= moment(b.now - dt.timedelta(hours=24)))
    usual = b.transactions.where(F.col("transaction_date") >= days_before(b.as_of, 30)).groupBy("customer_id").agg(
        (F.count("*").cast("double") / 30).alias("daily_rate"), mean(F.abs("amount")).alias("avg_amount")
    )
    now = last.groupBy("customer_id").agg(
        F.count("*").alias("transactions"), F.max(F.abs("amount")).alias("largest"), F.count_distinct("merchant_state").alias("states"),
        mean("fraud_score").alias("avg_fraud_score"),
    )
    out = now.join(usual, "customer_id").select(
        "customer_id", "transactions", "largest", "states", "avg_fraud_score",
        (F.col("transactions") > F.col("daily_rate") * 2).alias("velocity_spike"),
        (F.col("largest").cast("double") > F.col("avg_amount") * 1.5).alias("unusual_amount"), (F.col("states") > 3).alias("wide_geography"),
    )
    return out.where("velocity_spike OR unusual_amount OR wide_geography")


def fraud_merchants(b) -> DataFrame:
    """Every merchant's transactions and mean risk."""
    return b.transactions.groupBy("merchant_name").agg(F.count("*").alias("transactions"), mean("fraud_score").alias("avg_fraud_score"))


def feature_cost(b) -> DataFrame:
    """What every feature costs."""
    return b.feature_compute_logs.groupBy("feature_id").agg(
        F.sum("credits_used").alias("credits"), mean(date_diff("second", "compute_start", "compute_end")).alias("avg_seconds"), F.count("*").alias("runs")
    )


def deposit_loss(b) -> DataFrame:
    """Customers whose deposits shrink or have stopped."""
    at = F.datediff("deposit_date", F.lit("2024-01-01").cast("date"))
    dep = b.direct_deposits.groupBy("customer_id").agg(
        F.count("*").alias("deposits"), slope("amount", at).alias("amount_trend"),
        date_diff("day", F.max("deposit_date"), day(b.as_of)).alias("days_since_deposit"),
    )
    held = b.accounts.groupBy("customer_id").agg(F.sum("current_balance").alias("balance"))
    calls = b.support_interactions.groupBy("customer_id").agg(F.count("*").alias("contacts"))
    return dep.join(held, "customer_id").join(calls, "customer_id", "left").na.fill(0, ["contacts"]).withColumns({
        "declining": F.coalesce(F.col("amount_trend") < 0, F.lit(False)), "stopped": F.col("days_since_deposit") > 45,
    })


def limit_optimization(b) -> DataFrame:
    """Use of card limits and what to change."""
    spend = b.transactions.where(F.col("transaction_date") >= days_before(b.as_of, 30)).groupBy("account_id").agg(
        sum_if(F.col("transaction_type") == "DEBIT", F.abs("amount")).alias("spend_30d")
    )
    who = b.customers.select("customer_id", "credit_score", "income_verified")
    used, s = F.col("utilization"), F.col("credit_score")
    return (
        b.accounts.where("account_type = 'BELIEVE_CARD'").join(who, "customer_id").join(spend, "account_id", "left")
        .select(
            "account_id", "credit_score", "income_verified", "credit_limit", ratio(F.abs("current_balance"), "credit_limit").alias("utilization"),
            F.coalesce("spend_30d", F.lit(0)).alias("spend_30d"),
        )
        .withColumn("action", F.when((s >= 700) & (used > 0.5), "INCREASE").when((s < 600) & (used > 1), "REDUCE").otherwise("KEEP"))
    )


def cashback_roi(b) -> DataFrame:
    """Cashback paid per category group."""
    mc = b.merchant_categories.select("mcc_code", "category_group", "cashback_eligible", "cashback_percentage")
    size = F.abs("amount")
    paid = F.when(F.col("cashback_eligible"), size * F.col("cashback_percentage")).otherwise(F.lit(0))
    return (
        b.transactions.where("transaction_type = 'DEBIT'").join(mc, F.col("merchant_category") == F.col("mcc_code")).groupBy("category_group").agg(
            F.sum(size).alias("volume"), sum_if(F.col("cashback_eligible"), size).alias("eligible_volume"),
            (F.sum(paid).cast("double") / 100).alias("cashback_paid"), F.count_distinct("customer_id").alias("customers"),
            mean(flag(F.col("cashback_eligible"))).alias("eligible_share"),
        )
    )


def aml_patterns(b) -> DataFrame:
    """Amounts just under the reporting line, money in and out on one day, risky merchants and reports."""
    amount = F.col("amount")
    risky = b.merchant_categories.select("mcc_code", "high_risk_category")
    daily = (
        b.transactions.join(risky, F.col("merchant_category") == F.col("mcc_code"), "left").groupBy("customer_id", "transaction_date").agg(
            count_if(amount.between(8000, F.lit(9999.99).cast("decimal(12,2)"))).alias("structured"), F.max(flag(amount >= 1000)).alias("in"),
            F.max(flag(amount <= -1000)).alias("out"), count_if(F.col("high_risk_category")).alias("risky"),
        )
    )
    per = daily.groupBy("customer_id").agg(
        F.sum("structured").alias("structured_deposits"), F.sum(F.col("in") * F.col("out")).cast("long").alias("in_out_days"), F.sum("risky").alias("risky_merchants")
    )
    reports = b.compliance_events.groupBy("customer_id").agg(count_if(F.col("event_type") == "SAR").alias("sar_count"))
    return per.join(reports, "customer_id", "left").na.fill(0, ["sar_count"]).withColumn(
        "priority", F.col("sar_count") * 3 + F.col("structured_deposits") * 2 + F.col("in_out_days") + F.col("risky_merchants")
    )


def support_efficiency(b, cost_per_minute: float = 0.75) -> DataFrame:
    """Volume, speed, satisfaction and closure by channel and topic."""
    who = b.customers.select("customer_id", flag(F.col("customer_status") == "CLOSED").alias("closed"))
    minutes = F.col("resolution_time_minutes")
    return b.support_interactions.join(who, "customer_id").groupBy("interaction_type", "category").agg(
        F.count("*").alias("contacts"), mean(minutes).alias("avg_minutes"), mean(flag(F.col("issue_resolved"))).alias("resolved_share"),
        mean("satisfaction_score").alias("satisfaction"), mean("closed").alias("closed_share"), (F.sum(minutes) * cost_per_minute).alias("cost"),
    )


def cross_sell(b) -> DataFrame:
    """Product gaps per active customer."""
    kind = F.col("account_type")
    wide = join_children(
        b.customers.where("customer_status = 'ACTIVE'").select("customer_id"), "customer_id",
        [
            Child(b.accounts, "customer_id", {
                "checking": F.max(kind == "CHECKING"), "savings": F.max(kind == "SAVINGS"), "credit": F.max(kind.isin("BELIEVE_CARD", "LINE_OF_CREDIT")),
                "balance": sum_if(kind.isin("CHECKING", "SAVINGS"), "current_balance"),
            }),
            Child(b.direct_deposits, "customer_id", {"deposits": F.count("*")}),
            Child(b.cash_advances, "customer_id", {"advances": F.count("*")}),
        ],
    ).na.fill(False, ["checking", "savings", "credit"]).na.fill(0, ["deposits", "advances"])
    return wide.select(
        "customer_id", (F.col("checking") & ~F.col("savings")).alias("needs_savings"),
        F.coalesce((F.col("balance") > 5000) & ~F.col("credit"), F.lit(False)).alias("needs_credit"),
        ((F.col("deposits") > 0) & (F.col("advances") == 0)).alias("could_use_advance"),
    )


def weekend_weekday(b) -> DataFrame:
    who = b.customers.select("customer_id", "risk_tier")
    return b.transactions.join(who, "customer_id").groupBy(
        F.when(is_weekend("transaction_date"), "WEEKEND").otherwise("WEEKDAY").alias("day_type"), "risk_tier"
    ).agg(
        F.count("*").alias("transactions"), F.sum(F.abs("amount")).alias("volume"), mean(F.abs("amount")).alias("avg_amount"),
        mean("fraud_score").alias("avg_fraud_score"), F.count_distinct("merchant_category").alias("categories"),
    )


def savings_growth(b) -> DataFrame:
    age = date_diff("day", "opening_date", day(b.as_of)).cast("double")
    return b.accounts.where("account_type = 'SAVINGS'").groupBy("apy_rate").agg(
        F.count("*").alias("accounts"), mean("current_balance").alias("avg_balance"), mean(flag(F.col("auto_save_enabled"))).alias("auto_save_share"),
        F.round(corr("current_balance", age), 6).alias("balance_age_corr"),
    )


def international(b) -> DataFrame:
    return b.transactions.groupBy("is_international", "merchant_state").agg(
        F.count("*").alias("transactions"), F.sum(F.abs("amount")).alias("volume"), mean(flag(F.col("fraud_score") > 0.7)).alias("fraud_rate")
    )


def frequent_travellers(b, least: int = 3) -> DataFrame:
    return b.transactions.where("is_international").groupBy("customer_id").agg(
        F.count("*").alias("international"), F.count_distinct("merchant_state").alias("states")
    ).where(F.col("international") >= least)


def drift_impact(b) -> DataFrame:
    """Drifting features weighted by their importance in each model."""
    d = monitoring.feature_drift_monitor(b).select("feature_id", "normalized_shift", "drift_status")
    m = b.model_features.select("model_name", "feature_id", "feature_importance")
    return m.join(d, "feature_id").withColumn("impact", F.col("normalized_shift") * F.col("feature_importance"))


def drift_impact_fitted(b, importances: DataFrame) -> DataFrame:
    """Shift of every feature times its importance in a fitted model (``model_name, version, feature_id, feature_importance``)."""
    d = monitoring.feature_drift_monitor(b).select("feature_id", "normalized_shift", "drift_status")
    return importances.join(d, "feature_id").withColumn("impact", F.col("normalized_shift") * F.col("feature_importance"))


def drift_by_segment(b, days: int = 7) -> DataFrame:
    """Mean shift per feature and risk tier."""
    at, v = F.col("feature_timestamp"), F.col("feature_value")
    edge = moment(b.now - dt.timedelta(days=days))
    who = b.customers.select(F.col("customer_id").cast("string").alias("entity_id"), "risk_tier")
    return b.feature_values.join(who, "entity_id").groupBy("feature_id", "risk_tier").agg(
        F.avg(F.when(at < edge, v)).alias("before"), F.avg(F.when(at >= edge, v)).alias("after")
    ).select("feature_id", "risk_tier", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"),
             F.round(F.abs(F.col("after") - F.col("before")), 6).alias("shift"))


def attribution(b) -> DataFrame:
    """First-touch, last-touch and linear credit of every conversion.

    A conversion's path is the customer's touches up to and with it. A touch's linear credit is 1 / n for each conversion
    from it on, n being that conversion's place: the customer's total less what ran up before the touch. A busy customer's touches are
    numbered and added up by day; only a row per day meets in one task.
    """
    days = slice_of(F.to_date("sent_at"))
    order = ["sent_at", "customer_campaign_id"]
    t = b.customer_campaigns.select("customer_id", "campaign_id", "customer_campaign_id", "sent_at", "converted", "conversion_value")
    t = numbered(t, ["customer_id"], order, days, "place")
    t = t.withColumn("share", F.when(F.col("converted"), F.lit(1.0) / F.col("place")).otherwise(0.0))
    t = running(t, ["customer_id"], order, days, {"so_far": "share"})
    path = over_key(t, ["customer_id"], {
        "shares": F.sum("share"), "first_at": F.min("sent_at"), "first_campaign": F.min_by("campaign_id", F.struct(*order)),
    })
    credit = F.greatest(F.lit(0.0), F.round(F.sum(F.col("shares") - F.col("so_far") + F.col("share")), 6))
    linear = path.groupBy("campaign_id").agg(credit.alias("linear_credit"))
    sales = path.where("converted")
    first = sales.groupBy(F.col("first_campaign").alias("campaign_id")).agg(
        F.count("*").alias("first_touch"), F.sum("conversion_value").alias("first_touch_value"), mean(date_diff("hour", "first_at", "sent_at")).alias("avg_hours_to_convert")
    )
    last = sales.groupBy("campaign_id").agg(F.count("*").alias("last_touch"), F.sum("conversion_value").alias("last_touch_value"))
    out = b.marketing_campaigns.select("campaign_id", "campaign_name", "budget")
    for part in (linear, first, last):
        out = out.join(part, "campaign_id", "left")
    return out.na.fill(0, ["first_touch", "last_touch"]).withColumn("last_touch_roi", ratio("last_touch_value", "budget")).drop("budget")


def disputes(b, limit_minutes: int = 20) -> DataFrame:
    """Disputes by type: speed against the limit and customers who come back."""
    rows = b.support_interactions.where(F.col("subcategory").isin("DISPUTE", "REGULATION_E"))
    again = rows.groupBy("customer_id").agg((F.count("*") > 1).alias("repeats"))
    return rows.join(again, "customer_id").groupBy("subcategory", "interaction_type").agg(
        F.count("*").alias("disputes"), mean("resolution_time_minutes").alias("avg_minutes"),
        count_if(F.col("resolution_time_minutes") > limit_minutes).alias("over_limit"), F.count_distinct(F.when(F.col("repeats"), F.col("customer_id"))).alias("repeat_customers"),
    )


def app_engagement(b) -> DataFrame:
    """Daily users per device type, biometric share and suspicious sessions."""
    return b.device_sessions.groupBy("device_type", F.to_date("session_start").alias("day")).agg(
        F.count_distinct("customer_id").alias("daily_users"), F.count("*").alias("sessions"), F.sum("actions").alias("actions"),
        mean(flag(F.col("biometric_used"))).alias("biometric_share"), count_if(F.col("suspicious_activity_flag")).alias("suspicious"),
        F.count_distinct("geolocation").alias("locations"),
    )


def credit_building(b) -> DataFrame:
    """Score change between a customer's first and last bureau pull, by first band."""
    per = b.external_data.groupBy("customer_id").agg(
        F.min_by("credit_score", "pull_date").alias("first_score"), F.max_by("credit_score", "pull_date").alias("last_score"),
        date_diff("day", F.min("pull_date"), F.max("pull_date")).alias("days"),
    )
    gain = F.col("last_score") - F.col("first_score")
    return per.groupBy(score_band("first_score").alias("first_band")).agg(
        F.count("*").alias("customers"), mean(gain).alias("avg_gain"), mean(flag(gain > 0)).alias("improved_share"), mean("days").alias("avg_days")
    )


def serving_latency(b) -> DataFrame:
    runs = b.feature_compute_logs.select("feature_id", date_diff("second", "compute_start", "compute_end").alias("seconds"))
    return exact_percentiles(runs, ["feature_id"], "seconds", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def fraud_rings(b) -> DataFrame:
    """Customers connected by shared devices or addresses, with what they hold."""
    s = b.device_sessions
    links = shared_attribute_links(s, "customer_id", "device_id").select("customer_id", "anchor").unionByName(
        shared_attribute_links(s, "customer_id", "ip_address").select("customer_id", "anchor")
    )
    rings = connected_groups(links, "customer_id", "anchor")
    held = b.accounts.groupBy("customer_id").agg(F.sum(F.abs("current_balance")).alias("exposure"))
    return rings.join(held, F.col("node") == F.col("customer_id")).groupBy("group_id").agg(F.count("*").alias("members"), F.sum("exposure").alias("exposure"))


def cash_flow(b) -> DataFrame:
    """Income stability, a guess at the next deposit and an advance limit."""
    per = b.direct_deposits.groupBy("customer_id").agg(
        F.count("*").alias("deposits"), mean("amount").alias("avg_deposit"), F.stddev_samp(F.col("amount").cast("double")).alias("_sd"),
        F.sum("amount").alias("total_deposits"),
    )
    last = top_per_key(
        b.direct_deposits.select("customer_id", "deposit_id", "deposit_date", "amount"), ["customer_id"], [F.desc("deposit_date"), F.desc("deposit_id")], 6
    ).groupBy("customer_id").agg(mean("amount").alias("expected_next"))
    cv = F.try_divide(F.col("_sd"), F.col("avg_deposit"))
    return per.join(last, "customer_id").select(
        "customer_id", "deposits", "avg_deposit", F.round(cv, 6).alias("variation"), "expected_next",
        F.when(cv.isNull(), "UNKNOWN").when(cv < 0.4, "STABLE").otherwise("VARIABLE").alias("income"),
        F.least(F.lit(500), F.round(F.col("total_deposits") * F.lit(0.1).cast("decimal(2,1)"), 2)).cast("double").alias("advance_limit"),
    )


def seasonal_cash_flow(b, smoothing: float = 0.3) -> DataFrame:
    """A seasonal estimate of each customer's next month of deposits.

    A calendar month's factor is its mean month over the mean of all months, over all customers. Each customer's months, from the first to
    the last with a deposit and empty ones between them as zero, are divided by their factors and folded in order into a level
    that moves by ``smoothing`` towards each; the estimate is that level times the next month's factor (1 for a month never seen or
    without deposits). Months per customer are few, so the fold runs over one short array where its row is.
    """
    months = b.direct_deposits.where("deposit_date IS NOT NULL").groupBy("customer_id", F.trunc("deposit_date", "month").alias("month")).agg(F.sum("amount").alias("total"))
    spans = months.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("month", F.col("total").cast("double").alias("v")))).alias("paid"),
                                              F.min("month").alias("low"), F.max("month").alias("high"))
    each = spans.select("customer_id", "high", "paid", F.sequence("low", "high", F.expr("INTERVAL 1 MONTH")).alias("months"))
    filled = each.select(F.explode("months").alias("month"), "paid").select(F.month("month").alias("m"), F.coalesce(F.col("paid")[F.col("month")], F.lit(0.0)).cast("decimal(18,2)").alias("v"))
    sums = filled.groupBy("m").agg(F.sum("v").cast("double").alias("s"), F.count("*").alias("n"))  # at most twelve rows
    overall = sums.agg((F.sum("s") / F.sum("n")).alias("mean"))
    pairs = F.map_from_entries(F.collect_list(F.struct("m", F.try_divide(F.col("s") / F.col("n"), F.col("mean")).alias("f"))))
    factors = sums.join(overall).agg(pairs.alias("factors")).scalar()
    known = each.withColumn("factors", factors)
    factor = lambda d: F.coalesce(F.when(F.col("factors")[F.month(d)] > 0, F.col("factors")[F.month(d)]), F.lit(1.0))
    series = F.transform("months", lambda d: F.coalesce(F.col("paid")[d], F.lit(0.0)) / factor(d))
    level = F.aggregate(F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))), F.element_at("x", 1), lambda a, v: a + (v - a) * F.lit(smoothing))
    upcoming = F.add_months("high", 1)
    return known.withColumn("x", series).select(
        "customer_id", F.size("months").cast("long").alias("months"), F.round(level, 4).alias("level"), upcoming.alias("next_month"),
        F.round(level * factor(upcoming), 4).alias("expected"),
    )


def compliance_score(b) -> DataFrame:
    c = activity.compliance_risk(b)
    points = (
        flag(F.col("sar_count") > 0) * 40 + flag(F.col("ctr_count") > 0) * 20 + flag(F.col("risk_tier") == "HIGH") * 15
        + flag(F.col("high_risk_merchant_transactions") > 5) * 15 + flag(F.col("international_transactions_count") > 3) * 10
    )
    return c.select("customer_id", points.alias("score")).withColumn("review", band("score", [(70, "URGENT"), (40, "SOON")], "ROUTINE", ">="))


def balance_shift(b) -> DataFrame:
    """Monthly checking flow before and after a savings account was opened, by tier."""
    opened = b.accounts.where("account_type = 'SAVINGS'").groupBy("customer_id").agg(F.min("opening_date").alias("savings_from"))
    who = b.customers.select("customer_id", "risk_tier")
    rows = b.transactions.join(opened, "customer_id").join(who, "customer_id")
    after = F.col("transaction_date") >= F.col("savings_from")
    return rows.groupBy("risk_tier").agg(
        F.count_distinct("customer_id").alias("customers"), sum_if(~after, "amount").alias("flow_before"), sum_if(after, "amount").alias("flow_after"),
        F.sum("amount").alias("net_flow"),
    )


def support_deflection(b) -> DataFrame:
    """Tickets per topic against documents that speak of it; topics without any are gaps."""
    topics = b.support_interactions.groupBy(F.lower("category").alias("term")).agg(F.count("*").alias("tickets"), F.sum("resolution_time_minutes").alias("minutes"))
    words = ["account", "transaction", "card", "advance", "general"]
    found = counted(corpus(b.raw("documents"), "doc_id", "text"), words).groupBy("term").agg(F.count("*").alias("articles"))
    return topics.join(found, "term", "left").na.fill(0, ["articles"]).withColumn("is_gap", F.col("articles") == 0).withColumnRenamed("term", "topic")


def health_score(b, k: int = 100) -> DataFrame:
    """The k weakest customers of a weighted score of five signals."""
    c = customers.customer_360(b).where("customer_status = 'ACTIVE'")

    def part(value, full, weight):
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.cast("double"), F.lit(0.0)) / full)) * weight

    total = (
        part(F.col("total_deposit_balance"), 10000, 25) + part(F.col("transactions_30d"), 50, 25) + part(F.col("total_direct_deposits"), 10, 20)
        + part(F.col("avg_satisfaction_score"), 5, 15) + part(F.col("total_accounts"), 3, 15)
    )
    return c.select("customer_id", F.round(total, 6).alias("score"), "value_segment", "engagement_level").orderBy("score", "customer_id").limit(k)


def closure_signals(b) -> DataFrame:
    """Share of closed customers by warning sign."""
    base = b.customers.select("customer_id", flag(F.col("customer_status") == "CLOSED").alias("closed"))
    for name, rows in (("has_deposit", b.direct_deposits), ("has_activity", b.transactions), ("has_contact", b.support_interactions)):
        base = _left_flag(base, _flagged(b, rows, name), name)
    return base.groupBy("has_deposit", "has_activity", "has_contact").agg(F.count("*").alias("customers"), mean("closed").alias("closed_share"))


def early_deposit_retention(b) -> DataFrame:
    used = b.direct_deposits.groupBy("customer_id").agg(F.max("early_access_used").alias("early_user"))
    return b.customers.join(used, "customer_id").groupBy("early_user").agg(
        F.count("*").alias("customers"), mean(flag(F.col("customer_status") == "ACTIVE")).alias("retention")
    )


def direct_deposit_share(b) -> DataFrame:
    base = _left_flag(b.customers.select("customer_id", "address_state"), _flagged(b, b.direct_deposits, "has_deposit"), "has_deposit")
    return base.groupBy("address_state").agg(F.count("*").alias("customers"), mean(flag(F.col("has_deposit"))).alias("deposit_share"))


def daily_trend(b) -> DataFrame:
    return semantic.semantic_query(b, semantic.TRANSACTION_PAYMENT, ["total_transactions", "transaction_volume"], ["transaction_date"]).orderBy("transaction_date")


def acquisition_trend(b) -> DataFrame:
    return b.customers.groupBy(F.to_date(F.date_trunc("month", "acquisition_date")).alias("month"), "acquisition_channel").agg(F.count("*").alias("customers"))


def top_categories(b, k: int = 5) -> DataFrame:
    return semantic.semantic_query(b, semantic.TRANSACTION_PAYMENT, ["transaction_volume", "total_transactions"], ["category_group"]).orderBy(
        F.desc("transaction_volume"), "category_group"
    ).limit(k)


def avg_by_account_type(b) -> DataFrame:
    return semantic.semantic_query(b, semantic.TRANSACTION_PAYMENT, ["avg_transaction_amount", "avg_fraud_score"], ["account_type"])


def compliance_90d(b) -> DataFrame:
    return b.compliance_events.where(F.col("event_date") >= days_before(b.as_of, 90)).groupBy("event_type", "severity").agg(
        F.count("*").alias("events"), F.count_distinct("customer_id").alias("customers"), count_if(~F.col("resolved")).alias("unresolved")
    )


def advance_segments(b) -> DataFrame:
    """Advances, defaults and profit by risk tier, employment and channel, with each segment's part in all losses."""
    who = b.customers.select("customer_id", "risk_tier", "employment_status", "acquisition_channel")
    bad, paid = F.col("advance_status") == "DEFAULTED", F.col("advance_status") == "REPAID"
    fees, lost = sum_if(paid, "fee_amount"), sum_if(bad, "advance_amount")
    parts = b.cash_advances.join(who, "customer_id").groupBy("risk_tier", "employment_status", "acquisition_channel").agg(
        F.count("*").alias("advances"), mean(flag(bad)).alias("default_rate"), lost.alias("default_volume"), (fees - lost).alias("profit")
    )
    all_lost = parts.agg(F.sum("default_volume").alias("all_lost"))
    return with_row(parts, all_lost, "one").select(
        *parts.columns, F.try_divide(F.col("default_volume").cast("double"), F.col("one.all_lost").cast("double")).alias("share_of_losses")
    )


def advance_trend(b) -> DataFrame:
    """Advances, default rate and profit by month, against the month before that had any."""
    bad, paid = F.col("advance_status") == "DEFAULTED", F.col("advance_status") == "REPAID"
    months = b.cash_advances.groupBy(F.trunc("advance_date", "month").alias("month")).agg(
        F.count("*").alias("advances"), mean(flag(bad)).alias("default_rate"), (sum_if(paid, "fee_amount") - sum_if(bad, "advance_amount")).alias("profit")
    )
    before = F.lag("default_rate").over(Window.orderBy("month"))  # a row per month
    return months.withColumn("rate_change", F.col("default_rate") - before)


def advance_default_times(b) -> DataFrame:
    """How many defaults fell due in which week after the advance, and the share up to that week, by score band."""
    bad = b.cash_advances.where("advance_status = 'DEFAULTED' AND repayment_date IS NOT NULL")
    weeks = bad.join(b.customers.select("customer_id", score_band().alias("score_band")), "customer_id").groupBy(
        "score_band", F.floor(date_diff("day", "advance_date", "repayment_date") / 7).cast("long").alias("week")
    ).agg(F.count("*").alias("defaults"))
    band_rows = Window.partitionBy("score_band")  # a row per week
    upto = F.sum("defaults").over(band_rows.orderBy("week"))
    return weeks.withColumn("share_so_far", upto.cast("double") / F.sum("defaults").over(band_rows))


def _last_day(b) -> DataFrame:
    return b.transactions.where(F.col("transaction_timestamp") >= moment(b.now - dt.timedelta(hours=24)))


def fraud_international(b) -> DataFrame:
    """The last day's domestic and international transactions by category: volume, declines and risk."""
    return _last_day(b).groupBy("is_international", "transaction_category").agg(
        F.count("*").alias("transactions"), F.sum(F.abs("amount")).alias("volume"), mean(flag(F.col("status") == "DECLINED")).alias("declined_share"),
        mean("fraud_score").alias("avg_fraud_score"), mean(flag(F.col("fraud_score") > 0.5)).alias("risky_share"),
    )


def fraud_top(b, k: int = 10) -> DataFrame:
    """The k riskiest transactions of the last day; of equal scores the larger amount, then the lower id comes first."""
    cols = ["transaction_id", "customer_id", "amount", "merchant_name", "is_international", "fraud_score"]
    return _last_day(b).select(*cols).orderBy(F.desc_nulls_last("fraud_score"), F.desc_nulls_last(F.abs("amount")), "transaction_id").limit(k)


def support_segments(b, cost_per_minute: float = 0.75) -> DataFrame:
    """Support cost by risk tier and channel of acquisition, and how contacts go with closed accounts, over all customers."""
    own = b.support_interactions.groupBy("customer_id").agg(F.count("*").alias("contacts"), F.sum("resolution_time_minutes").alias("minutes"))
    base = b.customers.select("customer_id", "risk_tier", "acquisition_channel", flag(F.col("customer_status") == "CLOSED").alias("closed"))
    rows = base.join(own, "customer_id", "left").na.fill(0, ["contacts", "minutes"])
    return rows.groupBy("risk_tier", "acquisition_channel").agg(
        F.count("*").alias("customers"), F.sum("contacts").alias("contacts"), (F.sum("minutes") * cost_per_minute).alias("cost"),
        (F.sum("minutes") * cost_per_minute / F.count("*")).alias("cost_per_customer"), F.round(corr("contacts", "closed"), 6).alias("contact_closure_corr"),
    )


def support_resolutions(b, queries, k: int = 5) -> DataFrame:
    """Transcripts of resolved interactions that answer each query best, with channel, topic and minutes."""
    solved = b.support_interactions.where("issue_resolved").select("interaction_id", F.col("resolution_time_minutes").alias("minutes"))
    docs = corpus(b.support_transcripts.join(solved, "interaction_id"), "interaction_id", "transcript_text")
    found = search_topk(docs, queries, k)
    about = b.support_interactions.select(F.col("interaction_id").alias("doc_id"), "interaction_type", "category", F.col("resolution_time_minutes").alias("minutes"))
    return found.join(about, "doc_id").withColumnRenamed("doc_id", "interaction_id")
