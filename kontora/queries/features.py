"""Feature-store queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kontora.functions import scalars as S
from kontora.operators.ranking import latest_per_key
from kontora.plans import feature_store as fs
from kontora.plans import registry
from kontora.plans.feature_history import History, within
from kontora.plans.feature_sketches import DISTINCT_BOUND, RANK_BOUND, Sketches, held_against
from kontora.queries.base import NOW, NOW_ORDERS, TODAY, avg, query, total
from kontora.session import scratch_path
from kontora.sources import storage
from kontora.sources.mapping import FEATURE_IDS
from kontora.sources.storage import catalog_counts

_DAYS = [dt.date(2024, 1, 25) + dt.timedelta(days=i) for i in range(7)]
COUNT, AMOUNT, MERCHANTS, BALANCE, UTIL, FRAUD = FEATURE_IDS
_LATE = f"transaction_date >= {TODAY}"
_FEATURE_SQL = {
    COUNT: f"SELECT customer_id, CAST(count(*) AS DOUBLE) AS value FROM transactions WHERE {_LATE} - 30 GROUP BY 1",
    AMOUNT: f"SELECT customer_id, {total('abs(amount)')} AS value FROM transactions WHERE {_LATE} - 30 GROUP BY 1",
    MERCHANTS: f"SELECT customer_id, CAST(count(DISTINCT merchant_name) AS DOUBLE) AS value FROM transactions WHERE {_LATE} - 30 GROUP BY 1",
    BALANCE: f"SELECT customer_id, {avg('current_balance')} AS value FROM accounts GROUP BY 1",
    UTIL: "SELECT customer_id, CAST(count(CASE WHEN advance_status <> 'DEFAULTED' THEN 1 END) AS DOUBLE) / count(*) AS value FROM cash_advances GROUP BY 1",
    FRAUD: f"SELECT customer_id, {avg('CASE WHEN fraud_score > 0.5 THEN 1 ELSE 0 END')} AS value FROM transactions WHERE {_LATE} - 90 GROUP BY 1",
}


def _long(ids):
    return " UNION ALL ".join(
        f"SELECT CAST(customer_id AS VARCHAR) AS entity_id, 'CUSTOMER' AS entity_type, '{f}' AS feature_id, value AS feature_value, {NOW} AS feature_timestamp FROM ({_FEATURE_SQL[f]}) x"
        for f in ids
    )


def _one(feature_id):
    def run(b):
        return fs.compute_features(b, [feature_id]).select(F.col("entity_id").cast("long").alias("customer_id"), F.col("feature_value").alias("value"))

    return run


for _key, _fid in {
    "f_txn_count_30d": COUNT, "f_txn_amount_30d": AMOUNT, "f_unique_merchants_30d": MERCHANTS,
    "f_avg_balance": BALANCE, "f_advance_utilization": UTIL, "f_fraud_ratio_90d": FRAUD,
}.items():
    query(_key, _FEATURE_SQL[_fid])(_one(_fid))

query("compute_batch_features", _long([COUNT, AMOUNT, MERCHANTS, UTIL]))(lambda b: fs.compute_batch_features(b, "DAILY"))
query("compute_streaming_features", _long([BALANCE, FRAUD]))(lambda b: fs.compute_features(b, [BALANCE, FRAUD]))


@query("compute_and_log", f"""
SELECT feature_id, count(*) AS rows_processed, 'SUCCESS' AS compute_status FROM ({_long([COUNT, AMOUNT, MERCHANTS, UTIL])}) GROUP BY 1""")
def compute_and_log(b):
    values, log = scratch_path(b.spark, "values"), scratch_path(b.spark, "log")
    for _ in range(2):  # a repeated run leaves one copy
        fs.run_batch(b, "DAILY", values, log)
    return b.spark.read.parquet(log).select("feature_id", "rows_processed", "compute_status")


@query("feature_registry", """
SELECT d.feature_id, d.feature_group, d.computation_type, d.refresh_frequency, d.version, d.is_active, coalesce(v.n, 0) AS stored_values
FROM feature_definitions d LEFT JOIN (SELECT feature_id, count(*) AS n FROM feature_values GROUP BY 1) v USING (feature_id)""")
def feature_registry(b):
    n = b.feature_values.groupBy("feature_id").agg(F.count("*").alias("stored_values"))
    return b.feature_definitions.join(n, "feature_id", "left").na.fill(0, ["stored_values"]).select(
        "feature_id", "feature_group", "computation_type", "refresh_frequency", "version", "is_active", "stored_values"
    )


@query("feature_set", """
SELECT s.feature_set_id, s.use_case, s.fid AS feature_id, coalesce(v.n, 0) AS entities
FROM (SELECT feature_set_id, use_case, unnest(feature_ids) AS fid FROM feature_sets) s
LEFT JOIN (SELECT feature_id, count(DISTINCT entity_id) AS n FROM feature_values GROUP BY 1) v ON v.feature_id = s.fid""")
def feature_set(b):
    n = b.feature_values.groupBy("feature_id").agg(F.count_distinct("entity_id").alias("entities"))
    return b.feature_sets.select("feature_set_id", "use_case", F.explode("feature_ids").alias("feature_id")).join(n, "feature_id", "left").na.fill(0, ["entities"])


@query("feature_values_long", "SELECT entity_id, entity_type, feature_id, feature_value, feature_timestamp FROM feature_values")
def feature_values_long(b):
    history = History(b.spark, scratch_path(b.spark, "feature-values"))
    history.store(b.feature_values)
    history.store(b.feature_values, _DAYS[:2])  # a second run for two days replaces them
    return history.read().select("entity_id", "entity_type", "feature_id", "feature_value", "feature_timestamp")


@query("feature_vector_wide", f"SELECT entity_id, entity_type, {COUNT}, {AMOUNT}, {FRAUD} FROM online_features")
def feature_vector_wide(b):
    return fs.vector_wide(b.feature_values, [COUNT, AMOUNT, FRAUD])


@query("feature_view_profile", """
SELECT customer_id, updated_at AS feature_timestamp, date_of_birth, acquisition_date, credit_score, CAST(income_verified AS DOUBLE) AS income_verified
FROM customers WHERE customer_status = 'ACTIVE'""")
def feature_view_profile(b):
    return fs.view_profile(b)


_PATTERN = f"""p AS (SELECT customer_id, count(CASE WHEN {_LATE} - 7 THEN 1 END) AS n7, sum(CASE WHEN {_LATE} - 7 THEN abs(amount) END) AS v7,
  count(CASE WHEN transaction_timestamp >= {NOW} - INTERVAL 1 HOUR THEN 1 END) AS n1 FROM transactions WHERE status = 'COMPLETED' GROUP BY 1)"""
_PATTERN_COLS = "coalesce(n7, 0) AS txn_count_7d, CAST(coalesce(v7, 0) AS DOUBLE) AS txn_volume_7d, coalesce(n1, 0) AS txn_count_1h"


@query("feature_view_txn_pattern", f"WITH {_PATTERN} SELECT customer_id, {NOW} AS feature_timestamp, {_PATTERN_COLS} FROM p")
def feature_view_txn_pattern(b):
    return fs.view_txn_pattern(b)


@query("feature_view_txn_pattern_as_written", f"""
WITH {_PATTERN} SELECT DISTINCT t.customer_id, t.created_at AS feature_timestamp, {_PATTERN_COLS}
FROM transactions t LEFT JOIN p ON p.customer_id = t.customer_id WHERE t.status = 'COMPLETED'""")
def feature_view_txn_pattern_as_written(b):
    return fs.view_txn_pattern(b, history="as_written")


@query("feature_view_advance", f"""
SELECT c.customer_id, c.updated_at AS feature_timestamp, coalesce(v.n, 0) AS total_advances_taken, coalesce(v.a, 0) AS avg_advance_amount, coalesce(v.d, 0) AS num_defaults
FROM customers c LEFT JOIN (SELECT customer_id, count(*) AS n, {avg("advance_amount")} AS a, count(CASE WHEN advance_status = 'DEFAULTED' THEN 1 END) AS d
  FROM cash_advances GROUP BY 1) v ON v.customer_id = c.customer_id WHERE c.customer_status = 'ACTIVE'""")
def feature_view_advance(b):
    return fs.view_advance(b)


_FRAUD = f"""
r AS (SELECT t.*, lag(transaction_timestamp) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS pt,
    lag(merchant_city) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS pc
  FROM transactions t WHERE transaction_timestamp >= {NOW} - INTERVAL 7 DAY AND status = 'COMPLETED'),
u AS (SELECT customer_id, {avg("abs(amount)")} AS avg_amount FROM transactions WHERE {_LATE} - 30 GROUP BY 1),
fr AS (SELECT r.customer_id, max(CASE WHEN abs(r.amount) > u.avg_amount * 3 AND abs(r.amount) > 100 THEN 1 ELSE 0 END) AS unusual,
  max(CASE WHEN date_diff('minute', pt, transaction_timestamp) < 5 AND merchant_city <> pc THEN 1 ELSE 0 END) AS travel
  FROM r LEFT JOIN u ON r.customer_id = u.customer_id GROUP BY r.customer_id)"""


@query("feature_view_fraud", f"""
WITH {_FRAUD} SELECT DISTINCT t.customer_id, {NOW} AS feature_timestamp, coalesce(unusual, 0) AS has_unusual_amount, coalesce(travel, 0) AS impossible_travel_flag
FROM transactions t LEFT JOIN fr ON fr.customer_id = t.customer_id WHERE t.status = 'COMPLETED'""")
def feature_view_fraud(b):
    return fs.view_fraud(b)


@query("feature_stats", "SELECT * FROM feature_statistics")
def feature_stats(b):
    return b.feature_statistics


@query("feature_stats_refresh", "SELECT * FROM feature_statistics")
def feature_stats_refresh(b):
    """Stored statistics: first without the last days' values, then those days are stored and only they are computed."""
    history = History(b.spark, scratch_path(b.spark, "feature-stats"))
    history.store(b.feature_values.where(F.to_date("feature_timestamp") < _DAYS[0]))
    history.refresh_statistics()
    late = b.feature_values.where(F.to_date("feature_timestamp") >= _DAYS[0])
    days = [_DAYS[0] + dt.timedelta(days=i) for i in range(8)]
    history.store(late, days)
    history.refresh_statistics(days)
    return history.statistics()


@query("feature_stats_sketched", f"""
SELECT feature_id, count(*) AS total_count, count(*) - count(feature_value) AS null_count, round(avg(feature_value), 6) AS mean_value,
  round(stddev_samp(feature_value), 6) AS std_deviation, min(feature_value) AS min_value, max(feature_value) AS max_value,
  true AS ranks_in_bound, true AS distinct_in_bound
FROM feature_values WHERE CAST(feature_timestamp AS DATE) BETWEEN DATE '{_DAYS[0]}' - 20 AND DATE '{_DAYS[-1]}' GROUP BY 1""")
def feature_stats_sketched(b):
    """Statistics of four weeks from stored daily states, one day of which is computed twice; answers within bounds are held against the values."""
    start, end = _DAYS[0] - dt.timedelta(days=20), _DAYS[-1]
    sketches = Sketches(b.spark, scratch_path(b.spark, "feature-sketches"))
    sketches.refresh(b.feature_values)
    sketches.refresh(b.feature_values, [_DAYS[2]])
    stats = sketches.statistics(start, end)
    values = b.feature_values.where(F.to_date("feature_timestamp").between(F.lit(start), F.lit(end)))
    return stats.join(held_against(stats, values), "feature_id").select(
        "feature_id", "total_count", "null_count", F.round("mean_value", 6).alias("mean_value"), F.round("std_deviation", 6).alias("std_deviation"),
        "min_value", "max_value", (F.col("rank_error") <= RANK_BOUND).alias("ranks_in_bound"), (F.col("distinct_error") <= DISTINCT_BOUND).alias("distinct_in_bound"),
    )


_LABELS_SQL = "lab AS (SELECT event_id AS label_id, CAST(user_id AS VARCHAR) AS entity_id, ts AS label_ts, value > 50 AS label FROM events WHERE event_type = 'purchase')"


def labels_from(b):
    return b.raw("events").where("event_type = 'purchase'").select(
        F.col("event_id").alias("label_id"), F.col("user_id").cast("string").alias("entity_id"), F.col("ts").alias("label_ts"), (F.col("value") > 50).alias("label")
    )


@query("training_dataset", f"""
WITH {_LABELS_SQL}
SELECT lab.*, a.feature_value AS {COUNT}, v.feature_value AS {AMOUNT}, f.feature_value AS {FRAUD} FROM lab
ASOF LEFT JOIN (SELECT * FROM feature_values WHERE feature_id = '{COUNT}') a ON a.entity_id = lab.entity_id AND a.feature_timestamp <= lab.label_ts
ASOF LEFT JOIN (SELECT * FROM feature_values WHERE feature_id = '{AMOUNT}') v ON v.entity_id = lab.entity_id AND v.feature_timestamp <= lab.label_ts
ASOF LEFT JOIN (SELECT * FROM feature_values WHERE feature_id = '{FRAUD}') f ON f.entity_id = lab.entity_id AND f.feature_timestamp <= lab.label_ts""")
def training_dataset(b):
    return fs.training_dataset(labels_from(b), b.feature_history, [COUNT, AMOUNT, FRAUD])


@query("training_dataset_ttl", f"""
WITH {_LABELS_SQL}
SELECT lab.*, CASE WHEN a.feature_timestamp >= lab.label_ts - INTERVAL 2 DAY THEN a.feature_value END AS {COUNT} FROM lab
ASOF LEFT JOIN (SELECT * FROM feature_values WHERE feature_id = '{COUNT}') a ON a.entity_id = lab.entity_id AND a.feature_timestamp <= lab.label_ts""")
def training_dataset_ttl(b):
    return fs.training_dataset(labels_from(b), b.feature_history, [COUNT], ttl=dt.timedelta(days=2))


@query("training_record", f"""
WITH {_LABELS_SQL}
SELECT 'purchase_value-2024-01-31' AS dataset_id, 'purchase_value' AS dataset_name, 'FRAUD_DETECTION_MODEL' AS model_name, 'fraud_detection_v1' AS feature_set_id,
  DATE '2024-01-01' AS start_date, {TODAY} AS end_date, count(DISTINCT entity_id) AS entity_count, count(*) AS row_count, 'memory' AS dataset_location,
  false AS is_stratified, 0.8::DOUBLE AS train_test_split_ratio FROM lab""")
def training_record(b):
    data = fs.training_dataset(labels_from(b), b.feature_history, [COUNT])
    return fs.training_record(
        "purchase_value", "FRAUD_DETECTION_MODEL", "fraud_detection_v1", data, "memory", dt.date(2024, 1, 1), b.as_of
    )


@query("train_test_split", """
SELECT label_id, CASE WHEN CAST(concat('0x', substr(md5(concat(CAST(label_id AS VARCHAR), '|split-42')), 1, 8)) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS part
FROM (SELECT event_id AS label_id FROM events WHERE event_type = 'purchase')""")
def train_test_split(b):
    train, test = fs.split_rows(labels_from(b).select("label_id"), "label_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("train_test_split_stratified", f"""
WITH {_LABELS_SQL}, h AS (SELECT label_id, label, CAST(concat('0x', substr(md5(concat(CAST(label_id AS VARCHAR), '|split-42')), 1, 12)) AS BIGINT) AS h FROM lab),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, label_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM h)
SELECT label_id, label, k <= round(n * 0.8) AS in_train FROM r""")
def train_test_split_stratified(b):
    return fs.stratified_split(labels_from(b).select("label_id", "label"), "label_id", "label")


@query("time_travel_read", """
SELECT entity_id, feature_id, arg_max(feature_value, feature_timestamp) AS feature_value, max(feature_timestamp) AS feature_timestamp
FROM feature_values WHERE feature_timestamp <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1, 2""")
def time_travel_read(b):
    from kontora.operators.joins import asof_at

    when = dt.datetime(2024, 1, 15, 12)
    rows = within(b.feature_history, end=when).select("entity_id", "feature_id", "feature_value", "feature_timestamp")
    return asof_at(rows, ["entity_id", "feature_id"], "feature_timestamp", when)


@query("pit_features", f"""
WITH known AS (SELECT entity_id, feature_id, arg_max(feature_value, feature_timestamp) AS v FROM feature_values
  WHERE feature_timestamp <= TIMESTAMP '2024-01-20 00:00:00' AND feature_id IN ('{COUNT}', '{FRAUD}')
    AND entity_id IN (SELECT CAST(customer_id AS VARCHAR) FROM customers WHERE risk_tier <> 'LOW') GROUP BY 1, 2)
SELECT entity_id, max(CASE WHEN feature_id = '{COUNT}' THEN v END) AS {COUNT}, max(CASE WHEN feature_id = '{FRAUD}' THEN v END) AS {FRAUD} FROM known GROUP BY 1""")
def pit_features(b):
    who = b.customers.where("risk_tier <> 'LOW'").select(F.col("customer_id").cast("string").alias("entity_id"))
    out = fs.pit_features(b.feature_history, who, [COUNT, FRAUD], dt.datetime(2024, 1, 20))
    return out.select("entity_id", *[F.col("features")[f].alias(f) for f in (COUNT, FRAUD)])


@query("get_customer_features", f"""
SELECT entity_id, last_updated, {COUNT}, {AMOUNT}, {FRAUD} FROM online_features WHERE entity_id IN (SELECT CAST(customer_id AS VARCHAR) FROM customers WHERE customer_status = 'ACTIVE')""")
def get_customer_features(b):
    out = fs.get_customer_features(b.online_features, b.customers.where("customer_status = 'ACTIVE'"))
    return out.select("entity_id", "last_updated", *[F.col("feature_vector")[f].alias(f) for f in (COUNT, AMOUNT, FRAUD)])


_L = 7
_BASE = f"feature_timestamp BETWEEN {NOW} - INTERVAL {2 * _L} DAY AND {NOW} - INTERVAL {_L} DAY"
_CURR = f"feature_timestamp >= {NOW} - INTERVAL {_L} DAY"
_DRIFT = f"""d AS (SELECT feature_id, avg(CASE WHEN {_BASE} THEN feature_value END) AS bm, stddev_samp(CASE WHEN {_BASE} THEN feature_value END) AS bs,
  avg(CASE WHEN {_CURR} THEN feature_value END) AS cm, stddev_samp(CASE WHEN {_CURR} THEN feature_value END) AS cs FROM feature_values GROUP BY 1)"""


@query("feature_drift", f"""
WITH {_DRIFT} SELECT feature_id, round(bm, 6) AS baseline_mean, round(cm, 6) AS current_mean, round(abs(cm - bm) / bs, 6) AS drift_score, abs(cm - bm) / bs > 0.15 AS alert_required FROM d""")
def feature_drift(b):
    d = fs.drift(b.feature_history, b.as_of, _L)
    return d.select("feature_id", *[F.round(c, 6).alias(c) for c in ("baseline_mean", "current_mean", "drift_score")], "alert_required")


@query("feature_monitoring", f"""
WITH {_DRIFT} SELECT concat(feature_id, '-DRIFT-2024-01-31') AS monitor_id, feature_id, 'DRIFT' AS monitor_type, {TODAY} AS monitor_date,
  round(bs, 6) AS baseline_stddev, round(cs, 6) AS current_stddev, round(abs(cm - bm) / bs, 6) AS drift_score, abs(cm - bm) / bs > 0.15 AS alert_triggered,
  CASE WHEN abs(cm - bm) / bs > 0.15 THEN 'HIGH' ELSE 'LOW' END AS alert_severity FROM d""")
def feature_monitoring(b):
    rows = fs.monitoring_rows(b.feature_history, b.as_of, _L)
    return rows.select(
        "monitor_id", "feature_id", "monitor_type", "monitor_date", F.round(F.col("baseline_stats")["stddev"], 6).alias("baseline_stddev"),
        F.round(F.col("current_stats")["stddev"], 6).alias("current_stddev"), F.round("drift_score", 6).alias("drift_score"), "alert_triggered", "alert_severity",
    )


@query("feature_freshness", f"""
WITH x AS (SELECT feature_id, max(feature_timestamp) AS last_computed, date_diff('minute', max(feature_timestamp), {NOW}) AS minutes_stale FROM feature_values GROUP BY 1)
SELECT *, CASE WHEN minutes_stale > 120 THEN 'CRITICAL' WHEN minutes_stale > 60 THEN 'WARNING' ELSE 'OK' END AS freshness_status FROM x""")
def feature_freshness(b):
    return fs.freshness(b.feature_values, b.now)


@query("feature_coverage_test", f"""
WITH e AS (SELECT count(*) AS expected FROM customers WHERE customer_status = 'ACTIVE'),
a AS (SELECT feature_id, count(DISTINCT CASE WHEN feature_timestamp >= {NOW} - INTERVAL 2 HOUR THEN entity_id END) AS actual FROM feature_values GROUP BY 1)
SELECT feature_id, actual, expected, CASE WHEN actual >= expected * 0.95 THEN concat('PASSED: ', actual, ' of ', expected, ' entities have features')
  ELSE concat('FAILED: Only ', actual, ' of ', expected, ' entities have features') END AS result FROM a, e""")
def feature_coverage_test(b):
    return fs.coverage(b)


_EDGES = """
edges AS (SELECT DISTINCT * FROM (
  SELECT feature_id AS node, unnest(source_tables) AS parent FROM feature_definitions
  UNION ALL SELECT feature_set_id, unnest(feature_ids) FROM feature_sets
  UNION ALL SELECT model_name, feature_id FROM model_features))"""


@query("feature_lineage", f"""
WITH RECURSIVE {_EDGES},
walk(node, parent, depth) AS (SELECT node, parent, 1 FROM edges UNION ALL SELECT w.node, e.parent, w.depth + 1 FROM walk w JOIN edges e ON e.node = w.parent WHERE w.depth < 10),
sizes AS (SELECT 'transactions' AS t, count(*) AS n FROM transactions UNION ALL SELECT 'accounts', count(*) FROM accounts UNION ALL SELECT 'cash_advances', count(*) FROM cash_advances)
SELECT node, parent, min(depth) AS depth, max(n) AS parent_rows FROM walk LEFT JOIN sizes ON t = parent GROUP BY 1, 2""")
def feature_lineage(b):
    edges = (
        registry.lineage(b.spark).select(F.col("feature_id").alias("node"), "parent")
        .unionByName(b.feature_sets.select(F.col("feature_set_id").alias("node"), F.explode("feature_ids").alias("parent")))
        .unionByName(b.model_features.select(F.col("model_name").alias("node"), F.col("feature_id").alias("parent")))
    )
    sizes = catalog_counts({t: getattr(b, t) for t in ("transactions", "accounts", "cash_advances")}).select(
        F.col("table_name").alias("parent"), F.col("row_count").alias("parent_rows")
    )
    return registry.lineage_closure(edges).join(sizes, "parent", "left").select("node", "parent", "depth", "parent_rows")


@query("model_features", """
SELECT m.model_name, m.feature_id, m.feature_importance::DOUBLE AS feature_importance, count(v.feature_id) AS stored_values
FROM model_features m LEFT JOIN feature_values v ON v.feature_id = m.feature_id GROUP BY 1, 2, 3""")
def model_features(b):
    n = b.feature_values.groupBy("feature_id").agg(F.count("*").alias("stored_values"))
    return b.model_features.select("model_name", "feature_id", "feature_importance").join(n, "feature_id", "left").na.fill(0, ["stored_values"])


@query("compute_log", """
SELECT compute_id, feature_id, compute_start, compute_status FROM feature_compute_logs WHERE compute_status = 'FAILED'""")
def compute_log(b):
    return fs.recent_runs(b.feature_compute_logs.select("compute_id", "feature_id", "compute_start", "compute_status"), "FAILED")


@query("backfill", """
SELECT t.customer_id, CAST(d.as_of AS DATE) AS as_of, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS txn_amount, CAST(max(amount) AS DOUBLE) AS max_amount
FROM transactions t JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-25', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS as_of) d
  ON t.transaction_date BETWEEN CAST(d.as_of AS DATE) - 10 AND CAST(d.as_of AS DATE)
WHERE status = 'COMPLETED' GROUP BY 1, 2""")
def backfill(b):
    return fs.backfill(b, _DAYS, days=10)


@query("refresh_full", "SELECT account_type, count(*) AS n FROM accounts GROUP BY 1")
def refresh_full(b):
    table = storage.Versions(b.spark, scratch_path(b.spark, "accounts-by-type"))
    for token in ("1", "2", "2"):  # the third call repeats the second and changes nothing
        table.change(lambda _: b.accounts.groupBy("account_type").agg(F.count("*").alias("n")), token)
    return table.read()


@query("sync_offline_online", f"WITH {_PATTERN} SELECT customer_id, {NOW} AS feature_timestamp, {_PATTERN_COLS} FROM p")
def sync_offline_online(b):
    view = fs.VIEWS.get("TRANSACTION_PATTERN_FEATURES")
    offline = storage.Versions(b.spark, scratch_path(b.spark, "offline"))
    online = storage.Versions(b.spark, scratch_path(b.spark, "online"))
    return fs.sync_online(view, fs.refresh_view(b, view.name, offline), online)
