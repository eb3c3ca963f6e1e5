"""Monitoring, comparison and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontora.plans import monitoring as m
from kontora.plans import quality as q
from kontora.queries.base import NOW, NOW_ORDERS, TODAY, avg, query, share0, total
from kontora.session import scratch_path
from kontora.sources import storage

HEALTH = f"""health AS (
SELECT fd.feature_id, fd.feature_name, fd.feature_group, fd.computation_type, fd.refresh_frequency, l.compute_end AS last_computed,
  date_diff('minute', l.compute_end, {NOW_ORDERS}) AS minutes_since_update, l.compute_status, l.rows_processed AS last_rows_processed,
  s.mean_value AS feature_mean, s.std_deviation AS feature_stddev, {share0("s.null_count", "s.total_count")} AS null_rate,
  CASE WHEN l.compute_status <> 'SUCCESS' THEN 'ERROR' WHEN computation_type = 'REAL_TIME' AND date_diff('minute', l.compute_end, {NOW_ORDERS}) > 5 THEN 'CRITICAL'
    WHEN computation_type = 'STREAMING' AND date_diff('minute', l.compute_end, {NOW_ORDERS}) > 30 THEN 'WARNING'
    WHEN computation_type = 'BATCH' AND refresh_frequency = 'HOURLY' AND date_diff('minute', l.compute_end, {NOW_ORDERS}) > 90 THEN 'WARNING'
    WHEN computation_type = 'BATCH' AND refresh_frequency = 'DAILY' AND date_diff('minute', l.compute_end, {NOW_ORDERS}) > 1500 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
FROM feature_definitions fd
LEFT JOIN (SELECT * FROM feature_compute_logs QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY compute_end DESC, compute_id DESC) = 1) l ON l.feature_id = fd.feature_id
LEFT JOIN (SELECT * FROM feature_statistics QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY computation_date DESC) = 1) s ON s.feature_id = fd.feature_id
WHERE fd.is_active)"""
_R6 = {"feature_mean", "feature_stddev"}


@query("feature_store_health", f"""WITH {HEALTH} SELECT feature_id, feature_name, feature_group, computation_type, refresh_frequency, last_computed, minutes_since_update, health_status,
  CASE WHEN null_rate > 0.5 THEN 'HIGH_NULLS' WHEN null_rate > 0.1 THEN 'MODERATE_NULLS' ELSE 'GOOD' END AS data_quality, last_rows_processed, feature_mean, feature_stddev, null_rate FROM health""")
def feature_store_health(b):
    return m.feature_store_health(b)


_PAST = f"computation_date BETWEEN {TODAY} - 30 AND {TODAY} - 7"
_LAST = f"computation_date >= {TODAY} - 7"
DRIFT = f"""drift AS (
SELECT fd.feature_id, fd.feature_name, fd.feature_group, bm AS baseline_mean, rm AS recent_mean, abs(rm - bm) AS mean_shift, {share0("abs(rm - bm)", "bs")} AS normalized_shift,
  CASE WHEN {share0("abs(rm - bm)", "bs")} > 3 THEN 'HIGH_DRIFT' WHEN {share0("abs(rm - bm)", "bs")} > 2 THEN 'MODERATE_DRIFT' WHEN {share0("abs(rm - bm)", "bs")} > 1 THEN 'MINOR_DRIFT' ELSE 'STABLE' END AS drift_status,
  {share0("rs", "bs")} AS variance_ratio, rr AS recent_volatility, baseline_days, recent_days
FROM feature_definitions fd
JOIN (SELECT feature_id, avg(mean_value) AS bm, avg(std_deviation) AS bs, count(*) AS baseline_days FROM feature_statistics WHERE {_PAST} GROUP BY 1) p ON p.feature_id = fd.feature_id
JOIN (SELECT feature_id, avg(mean_value) AS rm, avg(std_deviation) AS rs, max(mean_value) - min(mean_value) AS rr, count(*) AS recent_days FROM feature_statistics WHERE {_LAST} GROUP BY 1) r ON r.feature_id = fd.feature_id
WHERE fd.is_active)"""
_DR = ["baseline_mean", "recent_mean", "mean_shift", "normalized_shift", "variance_ratio", "recent_volatility"]


@query("feature_drift_monitor", f"WITH {DRIFT} SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in _DR)}) FROM drift")
def feature_drift_monitor(b):
    return m.feature_drift_monitor(b).withColumns({c: F.round(c, 4) for c in _DR})


def _model(fan: str) -> str:
    return f"""perf AS (
SELECT *, {share0("high_risk_flagged", "prediction_count")} AS flag_rate, {share0("high_risk_declined", "high_risk_flagged")} AS precision,
  avg_risk_score - lag(avg_risk_score, 7) OVER (PARTITION BY model_name ORDER BY prediction_date) AS score_change_7d FROM (
  SELECT mf.model_name, mf.model_version, t.transaction_date AS prediction_date, count(*) AS prediction_count,
    sum(CASE WHEN fraud_score > 0.7 THEN 1 ELSE 0 END)::BIGINT AS high_risk_flagged,
    sum(CASE WHEN fraud_score > 0.7 AND status = 'DECLINED' THEN 1 ELSE 0 END)::BIGINT AS high_risk_declined,
    sum(CASE WHEN fraud_score <= 0.3 AND status = 'DECLINED' THEN 1 ELSE 0 END)::BIGINT AS low_risk_declined, {avg("fraud_score")} AS avg_risk_score
  FROM transactions t, {fan} mf WHERE mf.model_name = 'FRAUD_DETECTION_MODEL' AND t.transaction_date >= {TODAY} - 30 GROUP BY 1, 2, 3))"""


PERF = _model("(SELECT DISTINCT model_name, model_version FROM model_features)")


@query("model_performance", f"WITH {PERF} SELECT * REPLACE (round(score_change_7d, 6) AS score_change_7d) FROM perf")
def model_performance(b):
    return m.model_performance(b).withColumn("score_change_7d", F.round("score_change_7d", 6))


@query("model_performance_as_written", f"WITH {_model('model_features')} SELECT model_name, prediction_date, prediction_count, high_risk_flagged, high_risk_declined, low_risk_declined, flag_rate, precision FROM perf")
def model_performance_as_written(b):
    return m.model_performance(b, fanout="as_written").select(
        "model_name", "prediction_date", "prediction_count", "high_risk_flagged", "high_risk_declined", "low_risk_declined", "flag_rate", "precision"
    )


SERVING = f"""serving AS (
SELECT date_trunc('hour', last_updated) AS serving_hour, entity_type, count(*) AS requests_served, {avg(f"date_diff('millisecond', last_updated, {NOW})")} AS avg_latency_ms,
  max(last_updated) AS last_request FROM online_features WHERE last_updated >= {NOW} - INTERVAL 1 DAY GROUP BY 1, 2)"""


@query("serving_metrics", f"""WITH {SERVING} SELECT serving_hour, entity_type, requests_served, avg_latency_ms,
  CASE WHEN avg_latency_ms < 10 THEN 'EXCELLENT' WHEN avg_latency_ms < 50 THEN 'GOOD' WHEN avg_latency_ms < 100 THEN 'ACCEPTABLE' ELSE 'POOR' END AS latency_rating,
  CAST(requests_served AS DOUBLE) / 3600.0::DOUBLE AS requests_per_second, date_diff('minute', last_request, {NOW}) AS minutes_since_last_request FROM serving""")
def serving_metrics(b):
    return m.serving_metrics(b)


_RAW = ["customers", "accounts", "transactions", "cash_advances", "direct_deposits"]
_ALL = " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in _RAW)


@query("resource_usage", f"""
SELECT 'Compute Usage' AS metric_type, pool AS resource_name, CAST(CAST(compute_start AS DATE) AS VARCHAR) AS time_period, {total("credits_used")} AS value, 'credits' AS unit,
  CAST(count(DISTINCT compute_id) AS VARCHAR) AS additional_info FROM feature_compute_logs WHERE compute_start >= {NOW_ORDERS} - INTERVAL 7 DAY GROUP BY 2, 3
UNION ALL SELECT 'Storage Usage', 'RAW', 'Current', CAST(sum(n) AS DOUBLE), 'rows', concat(CAST(CAST(sum(n) AS BIGINT) AS VARCHAR), ' rows in ', count(*), ' tables') FROM ({_ALL})""")
def resource_usage(b):
    return m.resource_usage(b)


ALERTS = f"""alerts AS (SELECT * FROM (
  SELECT 'Stale Features' AS alert_type, 'WARNING' AS severity, count(*) AS issue_count, 'Features not updated within expected timeframe' AS description,
    string_agg(feature_name, ', ' ORDER BY feature_name) AS affected_items_list FROM health WHERE health_status IN ('WARNING', 'CRITICAL', 'ERROR')
  UNION ALL SELECT 'Feature Drift', 'WARNING', count(*), 'Features showing significant distribution drift', string_agg(feature_name, ', ' ORDER BY feature_name)
    FROM drift WHERE drift_status IN ('HIGH_DRIFT', 'MODERATE_DRIFT')
  UNION ALL SELECT 'Data Completeness', 'ERROR', count(*), 'Tables with unexpected low row counts', string_agg(t, ', ' ORDER BY t)
    FROM (SELECT 'customers' AS t, count(*) AS n FROM customers UNION ALL SELECT 'accounts', count(*) FROM accounts UNION ALL SELECT 'transactions', count(*) FROM transactions) WHERE n < 1000)
WHERE issue_count > 0)"""


@query("data_quality_alerts", f"WITH {HEALTH}, {DRIFT}, {ALERTS} SELECT *, {NOW} AS alert_timestamp FROM alerts")
def data_quality_alerts(b):
    return m.data_quality_alerts(b)


def _business(join: str, cond: str) -> str:
    return f"""
WITH d AS (SELECT t.transaction_date AS metric_date, count(DISTINCT t.customer_id) AS daily_active_users, count(*) AS transaction_count, sum(abs(amount)) AS tv,
  {avg("abs(amount)")} AS avg_transaction_size, {share0("sum(CASE WHEN fraud_score > 0.7 THEN 1 ELSE 0 END)", "count(*)")} * 100 AS high_risk_transaction_pct,
  {share0("sum(CASE WHEN fraud_score > 0.7 THEN abs(amount) ELSE 0 END)", "sum(abs(amount))")} * 100 AS high_risk_volume_pct {join}
FROM transactions t {cond} WHERE t.transaction_date >= {TODAY} - 30 GROUP BY 1)"""


_BM_TAIL = """
  daily_active_users - lag(daily_active_users, 7) OVER (ORDER BY d.metric_date) AS dau_change_wow,
  CAST(tv - lag(tv, 7) OVER (ORDER BY d.metric_date) AS DOUBLE) AS volume_change_wow"""


@query("business_metrics", _business("", "") + f"""
SELECT d.metric_date, daily_active_users, transaction_count, CAST(tv AS DOUBLE) AS transaction_volume, avg_transaction_size, high_risk_transaction_pct, high_risk_volume_pct,{_BM_TAIL},
  coalesce(a.u, 0) AS advance_users, a.v AS advance_volume, a.e AS avg_eligibility_score
FROM d LEFT JOIN (SELECT advance_date, count(DISTINCT customer_id) AS u, {total("advance_amount")} AS v, {avg("eligibility_score")} AS e FROM cash_advances GROUP BY 1) a ON a.advance_date = d.metric_date""")
def business_metrics(b):
    return m.business_metrics(b)


@query("business_metrics_as_written", _business(
    f", count(DISTINCT ca.customer_id) AS advance_users, {total('ca.advance_amount')} AS advance_volume", "LEFT JOIN cash_advances ca ON t.transaction_date = ca.advance_date"
) + """
SELECT metric_date, daily_active_users, transaction_count, CAST(tv AS DOUBLE) AS transaction_volume, round(avg_transaction_size, 6) AS avg_transaction_size, round(high_risk_transaction_pct, 6) AS high_risk_transaction_pct,
  advance_users, advance_volume FROM d""")
def business_metrics_as_written(b):
    return m.business_metrics(b, fanout="as_written").select(
        "metric_date", "daily_active_users", "transaction_count", "transaction_volume", F.round("avg_transaction_size", 6).alias("avg_transaction_size"),
        F.round("high_risk_transaction_pct", 6).alias("high_risk_transaction_pct"), "advance_users", "advance_volume",
    )


_PARTS = f"""parts AS (
  SELECT 'Feature Store' AS component, 0.4 AS weight, CAST(100 - count(CASE WHEN health_status <> 'HEALTHY' THEN 1 END) * 5 AS DOUBLE) AS score FROM health
  UNION ALL SELECT 'ML Models', 0.3, CAST(avg(CASE WHEN precision > 0.9 THEN 100 WHEN precision > 0.8 THEN 85 WHEN precision > 0.7 THEN 70 ELSE 50 END) AS DOUBLE) FROM perf WHERE prediction_date = {TODAY} - 1
  UNION ALL SELECT 'System Performance', 0.2, CAST(CASE WHEN avg(avg_latency_ms) < 50 THEN 100 WHEN avg(avg_latency_ms) < 100 THEN 85 WHEN avg(avg_latency_ms) < 200 THEN 70 ELSE 50 END AS DOUBLE)
    FROM serving WHERE serving_hour >= {NOW} - INTERVAL 6 HOUR
  UNION ALL SELECT 'Data Quality', 0.1, CAST(100 - count(*) * 10 AS DOUBLE) FROM alerts),
overall AS (SELECT round(sum(round(score * weight, 6))) AS overall_health_score,
  CAST(to_json(list(struct_pack(component := component, score := CAST(round(score) AS BIGINT)) ORDER BY component)) AS VARCHAR) AS component_scores FROM parts)"""


@query("system_health_score", f"""WITH {HEALTH}, {DRIFT}, {ALERTS}, {PERF}, {SERVING}, {_PARTS} SELECT overall_health_score, component_scores,
  CASE WHEN overall_health_score >= 90 THEN 'EXCELLENT' WHEN overall_health_score >= 80 THEN 'GOOD' WHEN overall_health_score >= 70 THEN 'FAIR' ELSE 'POOR' END AS health_status, {NOW} AS assessment_time FROM overall""")
def system_health_score(b):
    return m.system_health_score(b)


@query("monitor_system_health", f"""WITH {HEALTH}, {DRIFT}, {ALERTS}, {PERF}, {SERVING}, {_PARTS}, x AS (SELECT CAST(overall_health_score AS BIGINT) AS health_score,
  (SELECT count(*) FROM alerts WHERE severity = 'ERROR') AS critical_alerts FROM overall)
SELECT health_score, critical_alerts, CASE WHEN health_score < 70 OR critical_alerts > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS status,
  CASE WHEN health_score < 70 OR critical_alerts > 0 THEN concat('ALERT: System health score is ', health_score, ' with ', critical_alerts, ' critical issues.')
    ELSE concat('System health is good. Score: ', health_score) END AS message FROM x""")
def monitor_system_health(b):
    return m.monitor_system_health(b).drop("report")


_SECS = "date_diff('second', compute_start, compute_end)"
_RUNS = f"""runs AS (SELECT *, {_SECS} AS seconds, CASE WHEN pool = 'FEATURE_POOL' THEN 'Feature Store' ELSE 'Previous Platform' END AS platform FROM feature_compute_logs
  WHERE (pool = 'FEATURE_POOL' AND compute_start >= {NOW_ORDERS} - INTERVAL 30 DAY) OR pool = 'LEGACY_POOL')"""


@query("platform_comparison", f"""WITH {_RUNS} SELECT platform, count(DISTINCT compute_id) AS total_computations, {avg("seconds")} AS avg_compute_time_sec, median(seconds) AS median_compute_time_sec,
  {avg("rows_processed")} AS avg_rows_processed, {avg("credits_used")} AS avg_credits_per_compute, {total("credits_used")} AS total_credits_used,
  round(avg(rows_processed / nullif(seconds, 0)), 6) AS rows_per_second, CAST(count(CASE WHEN compute_status = 'FAILED' THEN 1 END) AS DOUBLE) * 100.0 / count(*) AS failure_rate_pct,
  {avg(f"date_diff('second', compute_start, {NOW_ORDERS})")} / 60.0 AS avg_data_freshness_minutes FROM runs GROUP BY 1""")
def platform_comparison(b):
    return m.platform_comparison(b).withColumn("rows_per_second", F.round("rows_per_second", 6))


@query("feature_perf_by_feature", f"""WITH {_RUNS} SELECT fd.feature_name, fd.feature_group, platform, count(*) AS computation_count, {avg("seconds")} AS avg_compute_time_sec,
  {avg("credits_used")} AS avg_cost_per_compute, {avg("rows_processed")} AS avg_rows_processed, max(compute_end) AS last_computed
FROM feature_definitions fd JOIN runs ON runs.feature_id = fd.feature_id GROUP BY 1, 2, 3""")
def feature_perf_by_feature(b):
    return m.feature_perf_by_feature(b)


@query("cost_comparison", f"""SELECT CASE WHEN pool = 'FEATURE_POOL' THEN 'Feature Store' ELSE 'Previous Platform' END AS platform,
  CASE WHEN pool = 'FEATURE_POOL' THEN 'Pay-per-use' ELSE 'Fixed costs' END AS cost_model, count(*) AS total_feature_computations, {total("credits_used")} AS total_credits,
  {avg("credits_used")} AS avg_credits_per_feature, CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed,
  {total("credits_used")} / CAST(sum(rows_processed) AS DOUBLE) * 1000000 AS cost_per_million_rows, {avg(_SECS)} AS avg_latency_seconds
FROM feature_compute_logs WHERE compute_status = 'SUCCESS' GROUP BY 1, 2""")
def cost_comparison(b):
    return m.cost_comparison(b)


# ---------------------------------------------------------------- validation


@query("check_objects", """
SELECT r.t AS table_name, CASE WHEN x.n > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (VALUES ('customers'), ('accounts'), ('transactions'), ('loan_ledger')) r(t)
LEFT JOIN (SELECT 'customers' AS t, count(*) AS n FROM customers UNION ALL SELECT 'accounts', count(*) FROM accounts UNION ALL SELECT 'transactions', count(*) FROM transactions) x ON x.t = r.t""")
def check_objects(b):
    required = b.spark.createDataFrame([(t,) for t in ("customers", "accounts", "transactions", "loan_ledger")], "table_name string")
    actual = storage.catalog_counts({t: getattr(b, t) for t in ("customers", "accounts", "transactions")}).where("row_count > 0")
    return q.check_objects(required, actual, "table_name")


def _count_sql(table, name, threshold, noun):
    return f"""SELECT '{name}' AS check_name, count(*) AS actual_count, CASE WHEN count(*) > {threshold} THEN concat('PASS - ', count(*), ' {noun}')
      ELSE concat('WARN - Only ', count(*), ' {noun}') END AS status FROM {table}"""


@query("check_row_count", _count_sql("customers", "Customer Count", 1000000, "customers") + " UNION ALL " + _count_sql("transactions", "Transaction Count", 5000, "transactions"))
def check_row_count(b):
    return q.row_count(b.customers, "Customer Count", 1000000, "customers").unionByName(
        q.row_count(b.transactions, "Transaction Count", 5000, "transactions")
    )


@query("check_freshness", f"""
WITH x AS (SELECT date_diff('minute', max(created_at), {NOW}) AS m FROM feature_values WHERE created_at > {NOW} - INTERVAL 1 DAY)
SELECT 'Feature Freshness' AS check_name, m AS minutes_since_update, CASE WHEN m < 120 THEN concat('PASS - Features updated ', m, ' minutes ago')
  ELSE concat('FAIL - Features not updated for ', m, ' minutes') END AS status FROM x""")
def check_freshness(b):
    return q.freshness(b.feature_values, "created_at", b.now)


_ORPHAN = """SELECT '{name}' AS check_name, count(*) AS orphan_count, CASE WHEN count(*) = 0 THEN 'PASS - No orphaned {text}' ELSE concat('FAIL - ', count(*), ' {text}') END AS status
FROM {child} c LEFT JOIN {parent} p ON c.{col} = p.{key} WHERE p.{key} IS NULL"""


@query("check_orphans", " UNION ALL ".join([
    _ORPHAN.format(name="Orphaned Accounts", text="accounts", child="accounts", parent="customers", col="customer_id", key="customer_id"),
    _ORPHAN.format(name="Orphaned Transactions", text="transactions", child="transactions", parent="accounts", col="account_id", key="account_id"),
    _ORPHAN.format(name="Orphaned Categories", text="categories", child="transactions", parent="merchant_categories", col="merchant_category", key="mcc_code"),
]))
def check_orphans(b):
    return (
        q.orphans(b.accounts, b.customers, "customer_id", "customer_id", "Orphaned Accounts", "accounts")
        .unionByName(q.orphans(b.transactions, b.accounts, "account_id", "account_id", "Orphaned Transactions", "transactions"))
        .unionByName(q.orphans(b.transactions, b.merchant_categories, "merchant_category", "mcc_code", "Orphaned Categories", "categories"))
    )


@query("check_summary", f"""
WITH f AS (SELECT date_diff('minute', max(created_at), {NOW}) AS m FROM feature_values WHERE created_at > {NOW} - INTERVAL 1 DAY),
o AS (SELECT (SELECT count(*) FROM accounts a LEFT JOIN customers c USING (customer_id) WHERE c.first_name IS NULL)
  + (SELECT count(*) FROM transactions t LEFT JOIN accounts a ON a.account_id = t.account_id WHERE a.account_id IS NULL) AS n),
r AS (SELECT 'Database Objects' AS category, CASE WHEN (SELECT count(*) FROM customers) > 0 AND (SELECT count(*) FROM accounts) > 0 AND (SELECT count(*) FROM transactions) > 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
  UNION ALL SELECT 'Data Quality', 'PASS' UNION ALL SELECT 'Feature Store', CASE WHEN m < 120 THEN 'PASS' ELSE 'FAIL' END FROM f
  UNION ALL SELECT 'Foreign Keys', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END FROM o)
SELECT *, CASE WHEN overall_status = 'PASS' THEN '✓' ELSE '✗' END AS symbol FROM r""")
def check_summary(b):
    return q.summary(q.checks(b))


def _unique_sql(name, table, key):
    return f"""SELECT '{name}' AS check_name, count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows, count(CASE WHEN n > 1 THEN 1 END) AS repeated_keys,
  CASE WHEN count(CASE WHEN n > 1 THEN 1 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"""


@query("check_unique_key", _unique_sql("transactions", "transactions", "transaction_id") + " UNION ALL " + _unique_sql("transactions_large", "transactions_large", "order_id, line_number")
       + " UNION ALL " + _unique_sql("feature_values", "feature_values", "entity_id, feature_id, feature_timestamp"))
def check_unique_key(b):
    return (
        q.unique_key(b.transactions, ["transaction_id"], "transactions")
        .unionByName(q.unique_key(b.transactions_large, ["order_id", "line_number"], "transactions_large"))
        .unionByName(q.unique_key(b.feature_values, ["entity_id", "feature_id", "feature_timestamp"], "feature_values"))
    )


@query("check_smoke_insert", """
SELECT transaction_type, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM (
  SELECT transaction_type, amount FROM transactions UNION ALL SELECT 'DEBIT', -100 FROM accounts WHERE account_type = 'CHECKING') GROUP BY 1""")
def check_smoke_insert(b):
    """One purchase per checking account is inserted after the table; then it is counted."""
    path = scratch_path(b.spark, "smoke")
    cols = ["transaction_id", "account_id", "customer_id", "transaction_type", "amount", "transaction_date"]
    storage.append_rows(b.transactions.select(*cols), path, "transactions", b.now)
    new = b.accounts.where("account_type = 'CHECKING'").select(
        F.concat(F.lit("NEW-"), F.col("account_id").cast("string")).alias("transaction_id"), "account_id", "customer_id",
        F.lit("DEBIT").alias("transaction_type"), F.lit(-100).alias("amount"), F.lit(b.as_of).alias("transaction_date"),
    )
    storage.append_rows(new, path, "transactions", b.now)
    return storage.scan_table(b.spark, path, "transactions").groupBy("transaction_type").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
