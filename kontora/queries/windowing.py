"""Windows, ordering, top-k and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from kontora.functions import scalars as S
from kontora.operators.ranking import latest_per_key, sample_per_key, top_per_key
from kontora.operators.windows import framed, numbered, over_key, positioned, range_sums, ranged, running, slice_of
from kontora.queries.base import NOW, TODAY, avg, query, total

_TXN_ORDER = ["transaction_timestamp", "transaction_id"]


def _txn_slices():
    return slice_of(F.date_trunc("minute", "transaction_timestamp"))


def _txn(b, *extra):
    return b.transactions.select("customer_id", "transaction_id", "transaction_timestamp", *extra)


_W = "OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id"


@query("win_row_number", f"SELECT transaction_id, customer_id, row_number() {_W}) AS sequence FROM transactions")
def win_row_number(b):
    return numbered(_txn(b), ["customer_id"], _TXN_ORDER, _txn_slices(), "sequence").drop("transaction_timestamp")


@query("win_latest", """
SELECT feature_id, compute_id, compute_end, compute_status FROM feature_compute_logs
QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY compute_end DESC, compute_id DESC) = 1""")
def win_latest(b):
    return latest_per_key(
        b.feature_compute_logs.select("feature_id", "compute_id", "compute_end", "compute_status"), ["feature_id"], ["compute_end", "compute_id"]
    )


@query("win_sample_per_group", """
SELECT customer_id, transaction_id FROM transactions
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY md5(concat(CAST(transaction_id AS VARCHAR), '|sample')), transaction_id) <= 3""")
def win_sample_per_group(b):
    return sample_per_key(b.transactions.select("customer_id", "transaction_id"), ["customer_id"], "transaction_id", 3)


@query("win_global_row_number", "SELECT account_id, row_number() OVER (ORDER BY account_id) AS position FROM accounts")
def win_global_row_number(b):
    return positioned(b.accounts.select("account_id"), ["account_id"], "position")


@query("win_falling_text_ids", """
SELECT concat('T', CAST(9000000 - transaction_id AS VARCHAR)) AS id, customer_id, row_number() OVER w AS sequence, lag(transaction_timestamp) OVER w AS prev_time
FROM transactions WINDOW w AS (PARTITION BY customer_id ORDER BY date_trunc('hour', transaction_timestamp), concat('T', CAST(9000000 - transaction_id AS VARCHAR)))""")
def win_falling_text_ids(b):
    # ids that are text and fall as time rises, inside the hour that leads the order
    rows = _txn(b).select(
        F.concat(F.lit("T"), (9000000 - F.col("transaction_id")).cast("string")).alias("id"), "customer_id", "transaction_timestamp",
        F.date_trunc("hour", "transaction_timestamp").alias("hour"),
    )
    return framed(
        rows, ["customer_id"], ["hour", "id"], slice_of("hour"), 1, lambda w: {"prev_time": F.lag("transaction_timestamp").over(w)}, number="sequence"
    ).select("id", "customer_id", "sequence", "prev_time")


@query("win_lag", f"SELECT transaction_id, lag(transaction_timestamp) {_W}) AS prev_time, lag(merchant_city) {_W}) AS prev_city FROM transactions")
def win_lag(b):
    return framed(
        _txn(b, "merchant_city"), ["customer_id"], _TXN_ORDER, _txn_slices(), 1,
        lambda w: {"prev_time": F.lag("transaction_timestamp").over(w), "prev_city": F.lag("merchant_city").over(w)},
    ).select("transaction_id", "prev_time", "prev_city")


@query("win_lag_n", f"""
WITH d AS (SELECT transaction_type, transaction_date, count(*) AS n FROM transactions GROUP BY 1, 2),
g AS (SELECT transaction_date, count(*) AS n FROM transactions GROUP BY 1)
SELECT transaction_type, transaction_date, n - lag(n, 7) OVER (PARTITION BY transaction_type ORDER BY transaction_date) AS change FROM d
UNION ALL SELECT 'ALL', transaction_date, n - lag(n, 7) OVER (ORDER BY transaction_date) FROM g""")
def win_lag_n(b):
    # both windows run over daily totals: one row per day
    daily = b.transactions.groupBy("transaction_type", "transaction_date").agg(F.count("*").alias("n"))
    whole = daily.groupBy("transaction_date").agg(F.sum("n").alias("n")).select(F.lit("ALL").alias("transaction_type"), "transaction_date", "n")
    w = Window.partitionBy("transaction_type").orderBy("transaction_date")
    return daily.unionByName(whole).select(
        "transaction_type", "transaction_date", (F.col("n") - F.lag("n", 7).over(w)).alias("change")
    )


@query("win_gap_days", """
SELECT deposit_id, date_diff('day', lag(deposit_date) OVER (PARTITION BY customer_id ORDER BY deposit_date, deposit_id), deposit_date) AS gap FROM direct_deposits""")
def win_gap_days(b):
    return framed(
        b.direct_deposits.select("customer_id", "deposit_id", "deposit_date"), ["customer_id"], ["deposit_date", "deposit_id"],
        slice_of("deposit_date"), 1, lambda w: {"_p": F.lag("deposit_date").over(w)},
    ).select("deposit_id", S.date_diff("day", "_p", "deposit_date").alias("gap"))


@query("win_count_partition", "SELECT advance_id, count(*) OVER (PARTITION BY customer_id) AS n FROM cash_advances")
def win_count_partition(b):
    return over_key(b.cash_advances.select("advance_id", "customer_id"), ["customer_id"], {"n": F.count("*")}).drop("customer_id")


@query("win_stddev_partition", "SELECT deposit_id, round(stddev_samp(CAST(amount AS DOUBLE)) OVER (PARTITION BY customer_id, employer_name), 6) AS sd FROM direct_deposits")
def win_stddev_partition(b):
    return over_key(
        b.direct_deposits.select("deposit_id", "customer_id", "employer_name", "amount"), ["customer_id", "employer_name"],
        {"sd": F.round(F.stddev_samp(F.col("amount").cast("double")), 6)},
    ).select("deposit_id", "sd")


@query("win_running_sum", """
SELECT t.transaction_id, t.account_id, CAST(a.current_balance + sum(t.amount) OVER (PARTITION BY t.account_id ORDER BY t.transaction_timestamp, t.transaction_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_balance FROM transactions t JOIN accounts a USING (account_id)""")
def win_running_sum(b):
    moved = running(
        b.transactions.select("account_id", "transaction_id", "transaction_timestamp", "amount"), ["account_id"], _TXN_ORDER, _txn_slices(), {"_moved": "amount"}
    )
    return moved.join(b.accounts.select("account_id", "current_balance"), "account_id").select(
        "transaction_id", "account_id", (F.col("current_balance") + F.col("_moved")).alias("running_balance")
    )


@query("win_moving_count", f"SELECT transaction_id, count(*) {_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS last_12 FROM transactions")
def win_moving_count(b):
    return framed(
        _txn(b), ["customer_id"], _TXN_ORDER, _txn_slices(), 11, lambda w: {"last_12": F.count("*").over(w.rowsBetween(-11, 0))}
    ).select("transaction_id", "last_12")


@query("win_moving_avg", f"""
SELECT transaction_id, CAST(sum(amount) {_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) {_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS avg_6 FROM transactions""")
def win_moving_avg(b):
    return framed(
        _txn(b, "amount"), ["customer_id"], _TXN_ORDER, _txn_slices(), 5,
        lambda w: {"_s": F.sum("amount").over(w.rowsBetween(-5, 0)), "_n": F.count("*").over(w.rowsBetween(-5, 0))},
    ).select("transaction_id", S.ratio("_s", "_n").alias("avg_6"))


@query("win_trailing_baseline", """
WITH d AS (SELECT customer_id, transaction_date, count(*) AS n FROM transactions GROUP BY 1, 2)
SELECT customer_id, transaction_date, n, n > avg(n) OVER (PARTITION BY customer_id ORDER BY transaction_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) * 3 AS spike FROM d""")
def win_trailing_baseline(b):
    daily = b.transactions.groupBy("customer_id", "transaction_date").agg(F.count("*").alias("n"))
    w = Window.partitionBy("customer_id").orderBy("transaction_date").rowsBetween(-30, -1)
    return daily.withColumn("spike", F.col("n") > F.avg("n").over(w) * 3)


@query("win_over_agg", f"""
WITH d AS (SELECT customer_id, date_trunc('week', transaction_timestamp) AS week, {total("abs(amount)")} AS v FROM transactions GROUP BY 1, 2)
SELECT customer_id, CAST(week AS DATE) AS week, v, v - lag(v) OVER (PARTITION BY customer_id ORDER BY week) AS change FROM d""")
def win_over_agg(b):
    weekly = b.transactions.groupBy(
        "customer_id", F.to_date(F.date_trunc("week", "transaction_timestamp")).alias("week")
    ).agg(F.sum(F.abs("amount")).cast("double").alias("v"))
    w = Window.partitionBy("customer_id").orderBy("week")  # one row per week and customer
    return weekly.withColumn("change", F.col("v") - F.lag("v").over(w))


@query("win_calendar_rolling", """
WITH d AS (SELECT customer_id, transaction_date, count(*) AS n, sum(abs(amount)) AS v FROM transactions GROUP BY 1, 2)
SELECT customer_id, transaction_date, CAST(sum(n) OVER w AS BIGINT) AS n_7d, CAST(sum(v) OVER w AS DOUBLE) AS v_7d FROM d
WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""")
def win_calendar_rolling(b):
    daily = b.transactions.groupBy("customer_id", "transaction_date").agg(F.count("*").alias("n"), F.sum(F.abs("amount")).alias("v"))
    days = F.datediff("transaction_date", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("customer_id").orderBy(days).rangeBetween(-6, 0)  # one row per day and customer
    return daily.select("customer_id", "transaction_date", F.sum("n").over(w).alias("n_7d"), F.sum("v").over(w).alias("v_7d"))


_RAW = "(PARTITION BY customer_id ORDER BY transaction_timestamp RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)"


@query("win_range_rolling", f"""
SELECT transaction_id, customer_id, count(*) OVER w AS n_7d, CAST(sum(abs(amount)) OVER w AS DOUBLE) AS v_7d FROM transactions WINDOW w AS {_RAW}""")
def win_range_rolling(b):
    """Counts and volume of the seven days before each transaction, to the microsecond."""
    return range_sums(
        _txn(b, "amount"), ["customer_id"], "transaction_timestamp", ["transaction_id"], dt.timedelta(days=7), {"n_7d": F.lit(1).cast("long"), "v_7d": F.abs("amount")}, "hour"
    ).select("transaction_id", "customer_id", "n_7d", "v_7d")


@query("win_range_extremes", f"""
SELECT transaction_id, CAST(max(amount) OVER w AS DOUBLE) AS top_7d, CAST(min(amount) OVER w AS DOUBLE) AS low_7d FROM transactions WINDOW w AS {_RAW}""")
def win_range_extremes(b):
    return ranged(
        _txn(b, "amount"), ["customer_id"], "transaction_timestamp", dt.timedelta(days=7), lambda w: {"top_7d": F.max("amount").over(w), "low_7d": F.min("amount").over(w)}
    ).select("transaction_id", "top_7d", "low_7d")


# ---------------------------------------------------------------- order, limit, top-k


@query("sort_cols", "SELECT customer_id, risk_tier, credit_score FROM customers ORDER BY risk_tier, credit_score DESC, customer_id")
def sort_cols(b):
    return b.customers.select("customer_id", "risk_tier", "credit_score").orderBy("risk_tier", F.desc("credit_score"), "customer_id")


@query("sort_case", "SELECT event_id, severity FROM compliance_events ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END, event_id")
def sort_case(b):
    s = F.col("severity")
    rank = F.when(s == "CRITICAL", 1).when(s == "HIGH", 2).when(s == "MEDIUM", 3).otherwise(4)
    return b.compliance_events.select("event_id", "severity").orderBy(rank, "event_id")


@query("limit_n", "SELECT transaction_id, CAST(abs(amount) AS DOUBLE) AS size FROM transactions ORDER BY abs(amount) DESC, transaction_id LIMIT 10")
def limit_n(b):
    return b.transactions.select("transaction_id", F.abs("amount").alias("size")).orderBy(F.desc("size"), "transaction_id").limit(10)


@query("topk_filtered", f"SELECT customer_id, count(*) AS n, {avg('fraud_score')} AS score FROM transactions GROUP BY 1 HAVING count(*) > 10 ORDER BY score DESC, customer_id LIMIT 50")
def topk_filtered(b):
    return (
        b.transactions.groupBy("customer_id").agg(F.count("*").alias("n"), S.mean("fraud_score").alias("score"))
        .where("n > 10").orderBy(F.desc("score"), "customer_id").limit(50)
    )


@query("topk_per_group", "SELECT customer_id, transaction_id, CAST(abs(amount) AS DOUBLE) AS size FROM transactions QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY abs(amount) DESC, transaction_id) <= 2")
def topk_per_group(b):
    rows = b.transactions.select("customer_id", "transaction_id", F.abs("amount").alias("size"))
    return top_per_key(rows, ["customer_id"], [F.desc("size"), F.asc("transaction_id")], 2)


@query("topk_segments", f"""
SELECT category_group, {total("abs(t.amount)")} AS volume, count(*) AS n FROM transactions t JOIN merchant_categories m ON t.merchant_category = m.mcc_code
GROUP BY 1 ORDER BY volume DESC, category_group LIMIT 5""")
def topk_segments(b):
    m = b.merchant_categories.select("mcc_code", "category_group")
    return (
        b.transactions.join(m, F.col("merchant_category") == F.col("mcc_code")).groupBy("category_group")
        .agg(F.sum(F.abs("amount")).alias("volume"), F.count("*").alias("n")).orderBy(F.desc("volume"), "category_group").limit(5)
    )


@query("point_lookup_latest", """
SELECT entity_id, feature_id, arg_max(feature_value, feature_timestamp) AS feature_value, max(feature_timestamp) AS feature_timestamp FROM feature_values GROUP BY 1, 2""")
def point_lookup_latest(b):
    return latest_per_key(
        b.feature_values.select("entity_id", "feature_id", "feature_value", "feature_timestamp"), ["entity_id", "feature_id"], ["feature_timestamp"]
    )


# ---------------------------------------------------------------- set operations


@query("union_all", "SELECT customer_id, transaction_date AS day FROM transactions UNION ALL SELECT customer_id, deposit_date FROM direct_deposits")
def union_all(b):
    return b.transactions.select("customer_id", F.col("transaction_date").alias("day")).unionByName(
        b.direct_deposits.select("customer_id", F.col("deposit_date").alias("day"))
    )


@query("union_all_hetero", f"""
SELECT 'Compute Usage' AS metric_type, pool AS resource_name, CAST(CAST(compute_start AS DATE) AS VARCHAR) AS time_period, {total("credits_used")} AS value,
  CAST(count(*) AS VARCHAR) AS additional_info FROM feature_compute_logs GROUP BY 2, 3
UNION ALL SELECT 'Row Count', 'accounts', 'Current', CAST(count(*) AS DOUBLE), concat(CAST(count(DISTINCT account_type) AS VARCHAR), ' types') FROM accounts""")
def union_all_hetero(b):
    usage = b.feature_compute_logs.groupBy("pool", F.to_date("compute_start").alias("d")).agg(
        F.sum("credits_used").cast("double").alias("value"), F.count("*").alias("n")
    ).select(
        F.lit("Compute Usage").alias("metric_type"), F.col("pool").alias("resource_name"), F.col("d").cast("string").alias("time_period"),
        "value", F.col("n").cast("string").alias("additional_info"),
    )
    size = b.accounts.agg(F.count("*").alias("n"), F.count_distinct("account_type").alias("k")).select(
        F.lit("Row Count").alias("metric_type"), F.lit("accounts").alias("resource_name"), F.lit("Current").alias("time_period"),
        F.col("n").cast("double").alias("value"), F.concat(F.col("k").cast("string"), F.lit(" types")).alias("additional_info"),
    )
    return usage.unionByName(size)
