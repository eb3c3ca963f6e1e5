"""Feature definitions, feature sets, model features and lineage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

# Seeded registry rows (fixed values).
DEFINITION_COLUMNS = [
    "feature_id", "feature_name", "feature_group", "computation_type", "refresh_frequency",
    "source_tables", "version", "is_active",
]
DEFINITION_ROWS: list[tuple] = [
    ("customer_txn_count_30d", "Customer Transaction Count 30 Days", "transaction_patterns", "BATCH", "DAILY", ["transactions"], 1, True),
    ("customer_txn_amount_30d", "Customer Transaction Amount 30 Days", "transaction_patterns", "BATCH", "DAILY", ["transactions"], 1, True),
    ("customer_unique_merchants_30d", "Customer Unique Merchants 30 Days", "transaction_patterns", "BATCH", "DAILY", ["transactions"], 1, True),
    ("customer_avg_daily_balance", "Customer Average Daily Balance", "customer_profile", "STREAMING", "REAL_TIME", ["accounts"], 1, True),
    ("customer_advance_utilization", "Customer Cash Advance Utilization", "risk_indicators", "BATCH", "DAILY", ["cash_advances"], 1, True),
    ("customer_fraud_transaction_ratio", "Customer Fraud Transaction Ratio", "risk_indicators", "STREAMING", "HOURLY", ["transactions"], 1, True),
]
SET_COLUMNS = ["feature_set_id", "feature_set_name", "use_case", "feature_ids", "is_active"]
SET_ROWS: list[tuple] = [
    ("fraud_detection_v1", "Fraud Detection Model V1", "fraud_detection",
     ["customer_txn_count_30d", "customer_txn_amount_30d", "customer_unique_merchants_30d", "customer_fraud_transaction_ratio"], True),
    ("credit_risk_v1", "Credit Risk Assessment V1", "credit_risk",
     ["customer_avg_daily_balance", "customer_advance_utilization", "customer_txn_amount_30d"], True),
]
MODEL_COLUMNS = ["model_name", "model_version", "feature_id", "feature_importance", "feature_type"]
MODEL_ROWS: list[tuple] = [
    ("FRAUD_DETECTION_MODEL", "v1", "customer_txn_count_30d", 0.25, "INPUT"),
    ("FRAUD_DETECTION_MODEL", "v1", "customer_txn_amount_30d", 0.25, "INPUT"),
    ("FRAUD_DETECTION_MODEL", "v1", "customer_unique_merchants_30d", 0.25, "INPUT"),
    ("FRAUD_DETECTION_MODEL", "v1", "customer_fraud_transaction_ratio", 0.25, "INPUT"),
    ("ADVANCE_ELIGIBILITY_MODEL", "v1", "customer_avg_daily_balance", 0.25, "INPUT"),
    ("ADVANCE_ELIGIBILITY_MODEL", "v1", "customer_advance_utilization", 0.25, "INPUT"),
    ("ADVANCE_ELIGIBILITY_MODEL", "v1", "customer_txn_amount_30d", 0.25, "INPUT"),
    ("ADVANCE_ELIGIBILITY_MODEL", "v1", "customer_txn_count_30d", 0.25, "INPUT"),
]


def definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DEFINITION_ROWS,
        "feature_id string, feature_name string, feature_group string, computation_type string, "
        "refresh_frequency string, source_tables array<string>, version int, is_active boolean",
    )


def feature_sets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SET_ROWS,
        "feature_set_id string, feature_set_name string, use_case string, feature_ids array<string>, is_active boolean",
    )


def model_features(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MODEL_ROWS,
        "model_name string, model_version string, feature_id string, feature_importance double, feature_type string",
    )


def lineage(spark: SparkSession) -> DataFrame:
    """Direct parents: every definition depends on its source tables."""
    return definitions(spark).select(
        "feature_id", F.explode("source_tables").alias("parent"), F.lit("DIRECT").alias("dependency_type")
    )


def lineage_closure(edges: DataFrame) -> DataFrame:
    """All ancestors of every node, with the shortest distance.

    ``edges`` holds (node, parent). One join per level, until no level adds a
    pair; pairs already found are left out, so a cycle ends too.
    """
    from kontora.session import shared_dir

    shared_dir(edges.sparkSession)
    direct = edges.select("node", "parent").distinct().checkpoint()
    found = direct.withColumn("depth", F.lit(1))
    front = found
    step = direct.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    depth = 1
    while True:
        depth += 1
        grown = (
            front.join(step, "parent").select("node", F.col("above").alias("parent")).distinct()
            .join(found, ["node", "parent"], "left_anti")
            .withColumn("depth", F.lit(depth))
            .checkpoint()
        )
        if grown.isEmpty():
            return found
        found = found.unionByName(grown).checkpoint()
        front = grown


@dataclass(frozen=True)
class FeatureView:
    """A named feature query: entity keys, time column and how fresh it is kept."""

    name: str
    entity: str
    keys: tuple[str, ...]
    timestamp: str
    build: Callable[..., DataFrame] = field(repr=False)
    refresh: str = "1 hour"
    online_lag: str = "5 minutes"
    version: str = "v1"


class ViewRegistry:
    """Feature views by name and version."""

    def __init__(self) -> None:
        self._views: dict[tuple[str, str], FeatureView] = {}

    def register(self, view: FeatureView) -> FeatureView:
        self._views[(view.name, view.version)] = view
        return view

    def get(self, name: str, version: str = "v1") -> FeatureView:
        return self._views[(name, version)]

    def all(self) -> list[FeatureView]:
        return list(self._views.values())
