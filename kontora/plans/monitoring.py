"""Health, drift, serving, usage and cost views over the feature store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from kontora.functions.scalars import (
    band, count_if, date_diff, day, days_before, flag, mean, midnight, moment, ratio, ratio0, sum_if,
)
from kontora.operators.aggregates import exact_percentiles
from kontora.operators.ranking import latest_per_key
from kontora.session import scratch_path
from kontora.sources.storage import catalog_counts

CURRENT_POOL = "FEATURE_POOL"
LEGACY_POOL = "LEGACY_POOL"


def feature_store_health(b, now: dt.datetime | None = None) -> DataFrame:
    """Freshness and null rate of every active feature, worst first."""
    now = now or midnight(b.as_of_orders)
    logs = latest_per_key(
        b.feature_compute_logs.select("feature_id", "compute_id", "compute_end", "rows_processed", "compute_status"),
        ["feature_id"], ["compute_end", "compute_id"],
    )
    stats = latest_per_key(
        b.feature_statistics.select("feature_id", "computation_date", "mean_value", "std_deviation", "null_count", "total_count"),
        ["feature_id"], ["computation_date"],
    )
    kind, every, late = F.col("computation_type"), F.col("refresh_frequency"), F.col("minutes_since_update")
    wide = (
        b.feature_definitions.where("is_active").join(logs, "feature_id", "left").join(stats, "feature_id", "left")
        .withColumn("minutes_since_update", date_diff("minute", "compute_end", moment(now)))
        .withColumn("null_rate", ratio0("null_count", "total_count"))
    )
    status = (
        F.when(F.col("compute_status") != "SUCCESS", "ERROR")
        .when((kind == "REAL_TIME") & (late > 5), "CRITICAL")
        .when((kind == "STREAMING") & (late > 30), "WARNING")
        .when((kind == "BATCH") & (every == "HOURLY") & (late > 90), "WARNING")
        .when((kind == "BATCH") & (every == "DAILY") & (late > 1500), "WARNING")
        .otherwise("HEALTHY")
    )
    out = wide.select(
        "feature_id", "feature_name", "feature_group", "computation_type", "refresh_frequency",
        F.col("compute_end").alias("last_computed"), "minutes_since_update", status.alias("health_status"),
        band("null_rate", [(0.5, "HIGH_NULLS"), (0.1, "MODERATE_NULLS")], "GOOD").alias("data_quality"),
        F.col("rows_processed").alias("last_rows_processed"), F.col("mean_value").alias("feature_mean"),
        F.col("std_deviation").alias("feature_stddev"), "null_rate",
    )
    h = F.col("health_status")
    rank = F.when(h == "ERROR", 1).when(h == "CRITICAL", 2).when(h == "WARNING", 3).otherwise(4)
    return out.orderBy(rank, F.desc("minutes_since_update"), "feature_id")


def feature_drift_monitor(b, as_of: dt.date | None = None) -> DataFrame:
    """Last 7 days of feature statistics against days -30 to -7; day -7 counts in both."""
    as_of = as_of or b.as_of
    date = F.col("computation_date")
    past, now = date.between(days_before(as_of, 30), days_before(as_of, 7)), date >= days_before(as_of, 7)

    def avg_if(test, c):
        return F.avg(F.when(test, F.col(c)))

    stats = (
        b.feature_statistics.where(date >= days_before(as_of, 30)).groupBy("feature_id").agg(
            avg_if(past, "mean_value").alias("baseline_mean"), avg_if(past, "std_deviation").alias("baseline_stddev"),
            count_if(past).alias("baseline_days"),
            avg_if(now, "mean_value").alias("recent_mean"), avg_if(now, "std_deviation").alias("recent_stddev"),
            (F.max(F.when(now, F.col("mean_value"))) - F.min(F.when(now, F.col("mean_value")))).alias("recent_volatility"),
            count_if(now).alias("recent_days"),
        ).where("baseline_days > 0 AND recent_days > 0")
    )
    shift = F.abs(F.col("recent_mean") - F.col("baseline_mean"))
    return (
        b.feature_definitions.where("is_active").select("feature_id", "feature_name", "feature_group").join(stats, "feature_id")
        .withColumn("mean_shift", shift)
        .withColumn("normalized_shift", ratio0(shift, "baseline_stddev"))
        .withColumn("drift_status", band("normalized_shift", [(3, "HIGH_DRIFT"), (2, "MODERATE_DRIFT"), (1, "MINOR_DRIFT")], "STABLE"))
        .withColumn("variance_ratio", ratio0("recent_stddev", "baseline_stddev"))
        .drop("recent_stddev", "baseline_stddev")
        .orderBy(F.desc("normalized_shift"), "feature_id")
    )


def model_performance(b, as_of: dt.date | None = None, model: str = "FRAUD_DETECTION_MODEL", fanout: str = "correct") -> DataFrame:
    """Daily risk decisions per model version over 30 days.

    As written, every transaction counts once per input feature of the model.
    """
    as_of = as_of or b.as_of
    score = F.col("fraud_score")
    declined = F.col("status") == "DECLINED"
    daily = (
        b.transactions.where(F.col("transaction_date") >= days_before(as_of, 30))
        .groupBy(F.col("transaction_date").alias("prediction_date")).agg(
            F.count("*").alias("prediction_count"), F.sum(flag(score > 0.7)).alias("high_risk_flagged"),
            F.sum(flag((score > 0.7) & declined)).alias("high_risk_declined"),
            F.sum(flag((score <= 0.3) & declined)).alias("low_risk_declined"), mean(score).alias("avg_risk_score"),
        )
    )
    versions = b.model_features.where(F.col("model_name") == model).groupBy("model_name", "model_version").agg(F.count("*").alias("_features"))
    from kontora.operators.joins import with_each

    x = with_each(daily, versions, "_m").select(
        "_m.model_name", "_m.model_version", "_m._features", *daily.columns
    )
    counts = ["prediction_count", "high_risk_flagged", "high_risk_declined", "low_risk_declined"]
    if fanout == "as_written":
        x = x.withColumns({c: F.col(c) * F.col("_features") for c in counts})
    week = Window.partitionBy("model_name").orderBy("prediction_date")  # one row per day
    return x.withColumns({
        "flag_rate": ratio0("high_risk_flagged", "prediction_count"),
        "precision": ratio0("high_risk_declined", "high_risk_flagged"),
        "score_change_7d": F.col("avg_risk_score") - F.lag("avg_risk_score", 7).over(week),
    }).drop("_features").orderBy("model_name", F.desc("prediction_date"))


def serving_metrics(b, now: dt.datetime | None = None) -> DataFrame:
    """Online rows touched per hour in the last day, and how old they are."""
    now = now or b.now
    age = date_diff("millisecond", "last_updated", moment(now))
    hourly = (
        b.online_features.where(F.col("last_updated") >= moment(now - dt.timedelta(days=1)))
        .groupBy(F.date_trunc("hour", "last_updated").cast("timestamp_ntz").alias("serving_hour"), "entity_type")
        .agg(F.count("*").alias("requests_served"), mean(age).alias("avg_latency_ms"), F.max("last_updated").alias("_last"))
    )
    return hourly.select(
        "serving_hour", "entity_type", "requests_served", "avg_latency_ms",
        band("avg_latency_ms", [(10, "EXCELLENT"), (50, "GOOD"), (100, "ACCEPTABLE")], "POOR", "<").alias("latency_rating"),
        (F.col("requests_served") / 3600.0).cast("double").alias("requests_per_second"),
        date_diff("minute", "_last", moment(now)).alias("minutes_since_last_request"),
    ).orderBy(F.desc("serving_hour"))


def resource_usage(b, now: dt.datetime | None = None) -> DataFrame:
    """Compute cost per pool and day, and rows per table group."""
    now = now or midnight(b.as_of_orders)
    usage = (
        b.feature_compute_logs.where(F.col("compute_start") >= moment(now - dt.timedelta(days=7)))
        .groupBy("pool", F.to_date("compute_start").alias("d"))
        .agg(F.sum("credits_used").cast("double").alias("value"), F.count_distinct("compute_id").alias("n"))
        .select(
            F.lit("Compute Usage").alias("metric_type"), F.col("pool").alias("resource_name"), F.col("d").cast("string").alias("time_period"),
            "value", F.lit("credits").alias("unit"), F.col("n").cast("string").alias("additional_info"),
        )
    )
    raw = ["customers", "accounts", "transactions", "cash_advances", "direct_deposits"]
    stored = catalog_counts({t: getattr(b, t) for t in raw}).agg(
        F.sum("row_count").alias("rows"), F.count("*").alias("tables")
    ).select(
        F.lit("Storage Usage").alias("metric_type"), F.lit("RAW").alias("resource_name"), F.lit("Current").alias("time_period"),
        F.col("rows").cast("double").alias("value"), F.lit("rows").alias("unit"),
        F.concat(F.col("rows").cast("string"), F.lit(" rows in "), F.col("tables").cast("string"), F.lit(" tables")).alias("additional_info"),
    )
    return usage.unionByName(stored).orderBy("metric_type", F.desc("time_period"), "resource_name")


def _once(b, df: DataFrame, label: str) -> DataFrame:
    """A small view that several parts of a report read, written to the shared folder and read back."""
    path = scratch_path(b.spark, label)
    df.write.parquet(path)
    return b.spark.read.schema(df.schema).parquet(path)


def data_quality_alerts(b, min_rows: int = 1000, health: DataFrame | None = None) -> DataFrame:
    """Stale features, drifting features and tables that are too small. ``health`` is the feature store's health, if it is at hand."""
    health = feature_store_health(b) if health is None else health
    def alert(rows, name_col, kind, severity, text):
        return rows.agg(
            F.count("*").alias("issue_count"), F.array_join(F.sort_array(F.collect_list(name_col)), ", ").alias("affected_items_list")
        ).select(F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"), "issue_count", F.lit(text).alias("description"), "affected_items_list")

    small = catalog_counts({t: getattr(b, t) for t in ("customers", "accounts", "transactions")}).where(F.col("row_count") < min_rows)
    parts = [
        alert(
            health.where(F.col("health_status").isin("WARNING", "CRITICAL", "ERROR")), "feature_name",
            "Stale Features", "WARNING", "Features not updated within expected timeframe",
        ),
        alert(
            feature_drift_monitor(b).where(F.col("drift_status").isin("HIGH_DRIFT", "MODERATE_DRIFT")), "feature_name",
            "Feature Drift", "WARNING", "Features showing significant distribution drift",
        ),
        alert(small, "table_name", "Data Completeness", "ERROR", "Tables with unexpected low row counts"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("issue_count > 0")
    s = F.col("severity")
    return out.withColumn("alert_timestamp", moment(b.now)).orderBy(F.when(s == "ERROR", 1).when(s == "WARNING", 2).otherwise(3), "alert_type")


def business_metrics(b, as_of: dt.date | None = None, fanout: str = "correct") -> DataFrame:
    """Daily activity, risk share and advances over 30 days."""
    as_of = as_of or b.as_of
    since = days_before(as_of, 30)
    size, risky = F.abs("amount"), F.col("fraud_score") > 0.7
    t = (
        b.transactions.where(F.col("transaction_date") >= since).groupBy(F.col("transaction_date").alias("metric_date")).agg(
            F.count_distinct("customer_id").alias("daily_active_users"), F.count("*").alias("transaction_count"),
            F.sum(size).alias("transaction_volume"), mean(size).alias("avg_transaction_size"),
            F.sum(flag(risky)).alias("_rn"), sum_if(risky, size).alias("_rv"),
        )
    )
    a = b.cash_advances.where(F.col("advance_date") >= since).groupBy(F.col("advance_date").alias("metric_date")).agg(
        F.count("*").alias("_an"), F.count_distinct("customer_id").alias("advance_users"), F.sum("advance_amount").alias("advance_volume"),
        mean("eligibility_score").alias("avg_eligibility_score"),
    )
    x = t.join(a, "metric_date", "left").withColumn("advance_users", F.coalesce("advance_users", F.lit(0)))
    x = x.withColumns({
        "high_risk_transaction_pct": ratio0("_rn", "transaction_count") * 100,
        "high_risk_volume_pct": ratio0("_rv", "transaction_volume") * 100,
    })
    if fanout == "as_written":
        rows, advances = F.col("transaction_count"), F.greatest(F.lit(1), F.coalesce("_an", F.lit(0)))
        x = x.withColumns({
            "advance_volume": F.col("advance_volume") * rows, "transaction_volume": F.col("transaction_volume") * advances,
            "transaction_count": rows * advances,
        })
    w = Window.partitionBy().orderBy("metric_date")  # at most 31 daily rows
    return x.select(
        "metric_date", "daily_active_users", "transaction_count", "transaction_volume", "avg_transaction_size",
        "high_risk_transaction_pct", "high_risk_volume_pct",
        (F.col("daily_active_users") - F.lag("daily_active_users", 7).over(w)).alias("dau_change_wow"),
        (F.col("transaction_volume") - F.lag("transaction_volume", 7).over(w)).alias("volume_change_wow"),
        "advance_users", "advance_volume", "avg_eligibility_score",
    ).orderBy(F.desc("metric_date"))


def health_components(b, alerts: DataFrame | None = None, health: DataFrame | None = None) -> DataFrame:
    """The four weighted parts of the health score, one row each. Views that the caller has at hand are not built again."""
    if health is None:
        health = _once(b, feature_store_health(b), "health")
    if alerts is None:
        alerts = data_quality_alerts(b, health=health)
    def part(df, name, weight, score):
        return df.agg(score.cast("double").alias("score")).select(F.lit(name).alias("component"), F.lit(weight).alias("weight"), "score")

    p, ms = F.col("precision"), F.avg("avg_latency_ms")
    return (
        part(health, "Feature Store", 0.4, F.lit(100) - count_if(F.col("health_status") != "HEALTHY") * 5)
        .unionByName(part(
            model_performance(b).where(F.col("prediction_date") == days_before(b.as_of, 1)), "ML Models", 0.3,
            F.avg(F.when(p > 0.9, 100).when(p > 0.8, 85).when(p > 0.7, 70).otherwise(50)),
        ))
        .unionByName(part(
            serving_metrics(b).where(F.col("serving_hour") >= moment(b.now - dt.timedelta(hours=6))), "System Performance", 0.2,
            F.when(ms < 50, 100).when(ms < 100, 85).when(ms < 200, 70).otherwise(50),
        ))
        .unionByName(part(alerts, "Data Quality", 0.1, F.lit(100) - F.count("*") * 10))
    )


def system_health_score(b, alerts: DataFrame | None = None, health: DataFrame | None = None) -> DataFrame:
    """Weighted score. A part without rows is NULL and drops out; no serving rows score 50."""
    total = health_components(b, alerts, health).agg(
        F.round(F.sum(F.round(F.col("score") * F.col("weight"), 6))).alias("overall_health_score"),
        F.to_json(F.sort_array(F.collect_list(F.struct("component", F.round("score").cast("long").alias("score"))))).alias("component_scores"),
    )
    return total.withColumn(
        "health_status", band("overall_health_score", [(90, "EXCELLENT"), (80, "GOOD"), (70, "FAIR")], "POOR", ">=")
    ).withColumn("assessment_time", moment(b.now))


def monitor_system_health(b) -> DataFrame:
    """One alert row with a JSON report. The store's health and the alerts are built once and read by all parts."""
    health = _once(b, feature_store_health(b), "health")
    alerts = _once(b, data_quality_alerts(b, health=health), "alerts")
    critical = alerts.where("severity = 'ERROR'").agg(F.count("*").alias("n"))
    x = system_health_score(b, alerts, health).select(
        F.col("overall_health_score").cast("long").alias("health_score"), F.coalesce(critical.scalar(), F.lit(0)).alias("critical_alerts")
    )
    bad = (F.col("health_score") < 70) | (F.col("critical_alerts") > 0)
    s, c = F.col("health_score").cast("string"), F.col("critical_alerts").cast("string")
    x = x.withColumn("status", F.when(bad, "WARNING").otherwise("HEALTHY")).withColumn(
        "message",
        F.when(bad, F.concat(F.lit("ALERT: System health score is "), s, F.lit(" with "), c, F.lit(" critical issues.")))
        .otherwise(F.concat(F.lit("System health is good. Score: "), s)),
    )
    return x.withColumn("report", F.to_json(F.struct("status", "health_score", "critical_alerts", "message")))


# ---------------------------------------------------------------- platform comparison


def _population(b, now: dt.datetime) -> DataFrame:
    """Runs of both platforms with their label; the current one over 30 days."""
    recent = F.col("compute_start") >= moment(now - dt.timedelta(days=30))
    pool = F.col("pool")
    return b.feature_compute_logs.where(((pool == CURRENT_POOL) & recent) | (pool == LEGACY_POOL)).withColumn(
        "platform", F.when(pool == CURRENT_POOL, "Feature Store").otherwise("Previous Platform")
    ).withColumn("seconds", date_diff("second", "compute_start", "compute_end"))


def platform_comparison(b, now: dt.datetime | None = None) -> DataFrame:
    now = now or midnight(b.as_of_orders)
    runs = _population(b, now)
    stats = runs.groupBy("platform").agg(
        F.count_distinct("compute_id").alias("total_computations"), mean("seconds").alias("avg_compute_time_sec"),
        mean("rows_processed").alias("avg_rows_processed"), mean("credits_used").alias("avg_credits_per_compute"),
        F.sum("credits_used").alias("total_credits_used"), F.avg(ratio("rows_processed", "seconds")).alias("rows_per_second"),
        (count_if(F.col("compute_status") == "FAILED").cast("double") * 100.0 / F.count("*")).alias("failure_rate_pct"),
        (mean(date_diff("second", "compute_start", moment(now))) / 60.0).alias("avg_data_freshness_minutes"),
    )
    return stats.join(exact_percentiles(runs, ["platform"], "seconds", {"median_compute_time_sec": 0.5}), "platform")


def feature_perf_by_feature(b, now: dt.datetime | None = None) -> DataFrame:
    now = now or midnight(b.as_of_orders)
    perf = _population(b, now).groupBy("feature_id", "platform").agg(
        F.count("*").alias("computation_count"), mean("seconds").alias("avg_compute_time_sec"), mean("credits_used").alias("avg_cost_per_compute"),
        mean("rows_processed").alias("avg_rows_processed"), F.max("compute_end").alias("last_computed"),
    )
    return b.feature_definitions.select("feature_id", "feature_name", "feature_group").join(perf, "feature_id").drop("feature_id").orderBy(
        "feature_name", "platform"
    )


def cost_comparison(b) -> DataFrame:
    current = F.col("pool") == CURRENT_POOL
    return (
        b.feature_compute_logs.where((F.col("compute_status") == "SUCCESS") & F.col("pool").isin(CURRENT_POOL, LEGACY_POOL))
        .groupBy(
            F.when(current, "Feature Store").otherwise("Previous Platform").alias("platform"),
            F.when(current, "Pay-per-use").otherwise("Fixed costs").alias("cost_model"),
        )
        .agg(
            F.count("*").alias("total_feature_computations"), F.sum("credits_used").alias("total_credits"),
            mean("credits_used").alias("avg_credits_per_feature"), F.sum("rows_processed").alias("total_rows_processed"),
            (F.sum("credits_used").cast("double") / F.sum("rows_processed").cast("double") * 1000000).alias("cost_per_million_rows"),
            mean(date_diff("second", "compute_start", "compute_end")).alias("avg_latency_seconds"),
        )
    )
