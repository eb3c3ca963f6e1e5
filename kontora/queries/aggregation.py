"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontora.functions import scalars as S
from kontora.operators.aggregates import exact_percentiles, histogram
from kontora.queries.base import NOW, TODAY, avg, corr, query, share0, total

_SECS = "date_diff('second', compute_start, compute_end)"


@query("agg_count", "SELECT transaction_type, count(*) AS n, count(status) AS with_status FROM transactions GROUP BY 1")
def agg_count(b):
    return b.transactions.groupBy("transaction_type").agg(F.count("*").alias("n"), F.count("status").alias("with_status"))


@query("agg_sum_avg_min_max", f"""
SELECT customer_id, {total("amount")} AS s, {avg("amount")} AS a, CAST(min(amount) AS DOUBLE) AS lo, CAST(max(amount) AS DOUBLE) AS hi FROM transactions GROUP BY 1""")
def agg_sum_avg_min_max(b):
    return b.transactions.groupBy("customer_id").agg(
        F.sum("amount").alias("s"), S.mean("amount").alias("a"), F.min("amount").alias("lo"), F.max("amount").alias("hi")
    )


@query("agg_stddev", "SELECT customer_id, merchant_category, round(stddev_samp(CAST(amount AS DOUBLE)), 6) AS sd FROM transactions GROUP BY 1, 2")
def agg_stddev(b):
    return b.transactions.groupBy("customer_id", "merchant_category").agg(
        F.round(F.stddev_samp(F.col("amount").cast("double")), 6).alias("sd")
    )


@query("agg_median", f"SELECT pool, median({_SECS}) AS median_seconds FROM feature_compute_logs GROUP BY 1")
def agg_median(b):
    seconds = S.date_diff("second", "compute_start", "compute_end")
    return exact_percentiles(b.feature_compute_logs, ["pool"], seconds, {"median_seconds": 0.5})


_P = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


@query("agg_percentiles", "SELECT feature_id, " + ", ".join(f"round(quantile_cont(feature_value, {p}), 6) AS {n}" for n, p in _P.items()) + " FROM feature_values GROUP BY 1")
def agg_percentiles(b):
    out = exact_percentiles(b.feature_values, ["feature_id"], "feature_value", _P)
    return out.select("feature_id", *[F.round(n, 6).alias(n) for n in _P])


@query("agg_count_distinct", "SELECT customer_id, count(DISTINCT merchant_category) AS categories, count(DISTINCT merchant_state) AS states, count(DISTINCT transaction_date) AS days FROM transactions GROUP BY 1")
def agg_count_distinct(b):
    return b.transactions.groupBy("customer_id").agg(
        F.count_distinct("merchant_category").alias("categories"), F.count_distinct("merchant_state").alias("states"),
        F.count_distinct("transaction_date").alias("days"),
    )


@query("agg_count_if", "SELECT customer_id, count(CASE WHEN advance_status = 'DEFAULTED' THEN 1 END) AS defaults FROM cash_advances GROUP BY 1")
def agg_count_if(b):
    return b.cash_advances.groupBy("customer_id").agg(S.count_if(F.col("advance_status") == "DEFAULTED").alias("defaults"))


@query("agg_sum_if", "SELECT customer_id, CAST(sum(CASE WHEN account_type IN ('CHECKING', 'SAVINGS') THEN current_balance ELSE 0 END) AS DOUBLE) AS deposits FROM accounts GROUP BY 1")
def agg_sum_if(b):
    return b.accounts.groupBy("customer_id").agg(S.sum_if(F.col("account_type").isin("CHECKING", "SAVINGS"), "current_balance").alias("deposits"))


@query("agg_sum_if_null", f"SELECT customer_id, CAST(sum(CASE WHEN transaction_date >= {TODAY} - 2 THEN abs(amount) END) AS DOUBLE) AS volume FROM transactions GROUP BY 1")
def agg_sum_if_null(b):
    return b.transactions.groupBy("customer_id").agg(
        F.sum(F.when(F.col("transaction_date") >= S.days_before(b.as_of, 2), F.abs("amount"))).alias("volume")
    )


@query("agg_avg_if", f"""
SELECT customer_id, {avg("CASE WHEN account_type = 'CHECKING' THEN current_balance END")} AS checking,
  {avg("CASE WHEN account_type = 'SAVINGS' THEN 1 ELSE 0 END")} AS savings_share FROM accounts GROUP BY 1""")
def agg_avg_if(b):
    kind = F.col("account_type")
    return b.accounts.groupBy("customer_id").agg(
        S.mean(F.when(kind == "CHECKING", F.col("current_balance"))).alias("checking"), S.mean(S.flag(kind == "SAVINGS")).alias("savings_share")
    )


@query("agg_minmax_if", "SELECT customer_id, max(CASE WHEN abs(amount) > 5000 THEN 1 ELSE 0 END) AS any_large, CAST(min(CASE WHEN transaction_type = 'CREDIT' THEN amount END) AS DOUBLE) AS smallest_credit FROM transactions GROUP BY 1")
def agg_minmax_if(b):
    return b.transactions.groupBy("customer_id").agg(
        F.max(S.flag(F.abs("amount") > 5000)).alias("any_large"),
        F.min(F.when(F.col("transaction_type") == "CREDIT", F.col("amount"))).alias("smallest_credit"),
    )


@query("agg_count_distinct_if", "SELECT customer_id, count(DISTINCT CASE WHEN transaction_category = 'ATM' THEN transaction_date END) AS atm_days FROM transactions GROUP BY 1")
def agg_count_distinct_if(b):
    return b.transactions.groupBy("customer_id").agg(
        F.count_distinct(F.when(F.col("transaction_category") == "ATM", F.col("transaction_date"))).alias("atm_days")
    )


@query("agg_filter_clause", f"""
SELECT customer_id, CAST(sum(amount) FILTER (WHERE transaction_date >= {TODAY} - 30) AS DOUBLE) AS amount_sum_30d,
  count(*) FILTER (WHERE transaction_date >= {TODAY} - 30) AS transaction_count_30d,
  count(DISTINCT merchant_category) FILTER (WHERE transaction_date >= {TODAY} - 7) AS unique_merchants_7d
FROM transactions WHERE transaction_date >= {TODAY} - 90 GROUP BY customer_id""")
def agg_filter_clause(b):
    b.transactions.where(F.col("transaction_date") >= S.days_before(b.as_of, 90)).createOrReplaceTempView("recent_transactions")
    return b.spark.sql(
        """
        SELECT customer_id, sum(amount) FILTER (WHERE transaction_date >= date_sub(:as_of, 30)) AS amount_sum_30d,
          count(*) FILTER (WHERE transaction_date >= date_sub(:as_of, 30)) AS transaction_count_30d,
          count(DISTINCT merchant_category) FILTER (WHERE transaction_date >= date_sub(:as_of, 7)) AS unique_merchants_7d
        FROM recent_transactions GROUP BY customer_id
        """,
        args={"as_of": b.as_of},
    )


@query("agg_multi_window", f"""
SELECT customer_id, count(CASE WHEN transaction_timestamp >= {NOW} - INTERVAL 1 HOUR THEN 1 END) AS n_1h,
  count(CASE WHEN transaction_date >= {TODAY} - 7 THEN 1 END) AS n_7d, count(CASE WHEN transaction_date >= {TODAY} - 30 THEN 1 END) AS n_30d,
  CAST(sum(CASE WHEN transaction_date >= {TODAY} - 7 THEN abs(amount) ELSE 0 END) AS DOUBLE) AS v_7d,
  CAST(sum(CASE WHEN transaction_date >= {TODAY} - 30 THEN abs(amount) ELSE 0 END) AS DOUBLE) AS v_30d
FROM transactions WHERE transaction_date >= {TODAY} - 90 GROUP BY 1""")
def agg_multi_window(b):
    import datetime as dt

    date = F.col("transaction_date")
    d7, d30 = date >= S.days_before(b.as_of, 7), date >= S.days_before(b.as_of, 30)
    return b.transactions.where(date >= S.days_before(b.as_of, 90)).groupBy("customer_id").agg(
        S.count_if(F.col("transaction_timestamp") >= S.moment(b.now - dt.timedelta(hours=1))).alias("n_1h"),
        S.count_if(d7).alias("n_7d"), S.count_if(d30).alias("n_30d"),
        S.sum_if(d7, F.abs("amount")).alias("v_7d"), S.sum_if(d30, F.abs("amount")).alias("v_30d"),
    )


@query("agg_bool", "SELECT c.customer_id, count(DISTINCT d.deposit_id) > 0 AS has_direct_deposit FROM customers c LEFT JOIN direct_deposits d USING (customer_id) GROUP BY 1")
def agg_bool(b):
    d = b.direct_deposits.groupBy("customer_id").agg((F.count("*") > 0).alias("has_direct_deposit"))
    return b.customers.select("customer_id").join(d, "customer_id", "left").na.fill(False, ["has_direct_deposit"])


@query("agg_ratio", """
SELECT advance_status, count(*) AS n, CAST(count(CASE WHEN fee_amount > 5 THEN 1 END) AS DOUBLE) * 100.0 / count(*) AS high_fee_pct,
  CAST(count(CASE WHEN repayment_amount > 100 THEN 1 END) AS DOUBLE) / nullif(count(repayment_amount), 0) AS large_share FROM cash_advances GROUP BY 1""")
def agg_ratio(b):
    return b.cash_advances.groupBy("advance_status").agg(
        F.count("*").alias("n"),
        (S.count_if(F.col("fee_amount") > 5).cast("double") * 100.0 / F.count("*")).alias("high_fee_pct"),
        S.ratio(S.count_if(F.col("repayment_amount") > 100), F.count("repayment_amount")).alias("large_share"),
    )


@query("agg_ratio_div0", f"SELECT campaign_id, {share0('count(CASE WHEN clicked THEN 1 END)', 'count(CASE WHEN opened AND conversion_value > 480 THEN 1 END)')} AS clicks_per_big FROM customer_campaigns GROUP BY 1")
def agg_ratio_div0(b):
    return b.customer_campaigns.groupBy("campaign_id").agg(
        S.ratio0(S.count_if(F.col("clicked")), S.count_if(F.col("opened") & (F.col("conversion_value") > 480))).alias("clicks_per_big")
    )


@query("agg_unit_cost", f"""
SELECT pool, {total("credits_used")} / CAST(sum(rows_processed) AS DOUBLE) * 1000000 AS cost_per_million,
  round(avg(rows_processed / nullif({_SECS}, 0)), 6) AS rows_per_second FROM feature_compute_logs GROUP BY 1""")
def agg_unit_cost(b):
    seconds = S.date_diff("second", "compute_start", "compute_end")
    return b.feature_compute_logs.groupBy("pool").agg(
        (F.sum("credits_used").cast("double") / F.sum("rows_processed").cast("double") * 1000000).alias("cost_per_million"),
        F.round(F.avg(S.ratio("rows_processed", seconds)), 6).alias("rows_per_second"),
    )


@query("agg_spread", "SELECT feature_id, max(feature_value) - min(feature_value) AS spread FROM feature_values GROUP BY 1")
def agg_spread(b):
    return b.feature_values.groupBy("feature_id").agg((F.max("feature_value") - F.min("feature_value")).alias("spread"))


@query("agg_weighted", """
SELECT risk_tier, CAST(round(sum(score * weight) / sum(weight)) AS BIGINT) AS weighted_score FROM (
  SELECT c.risk_tier, c.credit_score AS score, CASE WHEN a.account_type = 'CHECKING' THEN 4 ELSE 3 END AS weight FROM customers c JOIN accounts a USING (customer_id)) GROUP BY 1""")
def agg_weighted(b):
    x = b.customers.join(b.accounts, "customer_id").select(
        "risk_tier", F.col("credit_score").alias("score"), F.when(F.col("account_type") == "CHECKING", 4).otherwise(3).alias("weight")
    )
    return x.groupBy("risk_tier").agg(
        F.round(F.sum(F.col("score") * F.col("weight")) / F.sum("weight")).cast("long").alias("weighted_score")
    )


@query("agg_array", "SELECT customer_id, string_agg(DISTINCT merchant_state, ', ' ORDER BY merchant_state) AS states FROM transactions GROUP BY 1")
def agg_array(b):
    return b.transactions.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_set("merchant_state")), ", ").alias("states"))


@query("agg_object_list", """
SELECT customer_id, CAST(to_json(list(struct_pack(category := transaction_category, n := n) ORDER BY transaction_category)) AS VARCHAR) AS components
FROM (SELECT customer_id, transaction_category, count(*) AS n FROM transactions GROUP BY 1, 2) GROUP BY 1""")
def agg_object_list(b):
    n = b.transactions.groupBy("customer_id", F.col("transaction_category").alias("category")).agg(F.count("*").alias("n"))
    return n.groupBy("customer_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("category", "n")))).alias("components"))


@query("agg_object", """
SELECT customer_id, concat('{', string_agg(concat('"', merchant_state, '":', CAST(n AS VARCHAR)), ',' ORDER BY merchant_state), '}') AS by_state
FROM (SELECT customer_id, merchant_state, count(*) AS n FROM transactions GROUP BY 1, 2) GROUP BY 1""")
def agg_object(b):
    n = b.transactions.groupBy("customer_id", "merchant_state").agg(F.count("*").alias("n"))
    return n.groupBy("customer_id").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("merchant_state", "n"))))).alias("by_state")
    )


@query("group_by_expr", """
SELECT CASE WHEN abs(amount) >= 1000 THEN 'LARGE' ELSE 'SMALL' END AS size, date_trunc('hour', transaction_timestamp) AS hour, count(*) AS n FROM transactions GROUP BY 1, 2""")
def group_by_expr(b):
    return b.transactions.groupBy(
        F.when(F.abs("amount") >= 1000, "LARGE").otherwise("SMALL").alias("size"),
        F.date_trunc("hour", "transaction_timestamp").cast("timestamp_ntz").alias("hour"),
    ).agg(F.count("*").alias("n"))


_WIDE = ["customer_status", "kyc_status", "risk_tier", "acquisition_channel", "employment_status"]


@query("group_by_wide", f"SELECT {', '.join(_WIDE)}, count(*) AS n, {avg('credit_score')} AS score FROM customers GROUP BY {', '.join(_WIDE)}")
def group_by_wide(b):
    return b.customers.groupBy(*_WIDE).agg(F.count("*").alias("n"), S.mean("credit_score").alias("score"))


@query("group_by_all", "SELECT account_type, account_status, count(*) AS n, CAST(max(current_balance) AS DOUBLE) AS top FROM accounts GROUP BY ALL")
def group_by_all(b):
    b.accounts.createOrReplaceTempView("all_accounts")
    return b.spark.sql("SELECT account_type, account_status, count(*) AS n, max(current_balance) AS top FROM all_accounts GROUP BY ALL")


@query("agg_global", f"SELECT count(*) AS n, {total('abs(amount)')} AS volume, {avg('fraud_score')} AS score, min(transaction_date) AS first_day, max(transaction_date) AS last_day FROM transactions")
def agg_global(b):
    return b.transactions.agg(
        F.count("*").alias("n"), F.sum(F.abs("amount")).alias("volume"), S.mean("fraud_score").alias("score"),
        F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day"),
    )


@query("having", f"SELECT customer_id, count(*) AS n, {avg('fraud_score')} AS score FROM transactions GROUP BY 1 HAVING count(*) > 70 OR {avg('fraud_score')} > 0.55")
def having(b):
    return b.transactions.groupBy("customer_id").agg(F.count("*").alias("n"), S.mean("fraud_score").alias("score")).where("n > 70 OR score > 0.55")


@query("agg_corr", f"""
SELECT transaction_category, round({corr("CAST(amount AS DOUBLE)", "CAST(fraud_score AS DOUBLE)")}, 6) AS r, round(covar_samp(CAST(amount AS DOUBLE), CAST(fraud_score AS DOUBLE)), 4) AS cov,
  (CAST(count(*) AS DOUBLE) * {total("amount * fraud_score")} - {total("fraud_score")} * {total("amount")})
    / nullif(CAST(count(*) AS DOUBLE) * {total("fraud_score * fraud_score")} - {total("fraud_score")} * {total("fraud_score")}, 0) AS slope FROM transactions GROUP BY 1""")
def agg_corr(b):
    x, y = F.col("fraud_score").cast("double"), F.col("amount").cast("double")
    return b.transactions.groupBy("transaction_category").agg(
        F.round(S.corr(y, x), 6).alias("r"), F.round(F.covar_samp(y, x), 4).alias("cov"), S.slope("amount", "fraud_score").alias("slope")
    )


@query("agg_histogram", """
SELECT CASE WHEN credit_score < 300 THEN 0 WHEN credit_score >= 860 THEN 8 ELSE CAST(floor((credit_score - 300) / 80) AS BIGINT) + 1 END AS bucket, count(*) AS n
FROM customers GROUP BY 1""")
def agg_histogram(b):
    return histogram(b.customers, "credit_score", 300, 860, 7)
